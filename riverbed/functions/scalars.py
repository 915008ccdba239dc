"""Scalar cleaning functions (F1-F32) as native Column expressions.

Each function takes and returns ``pyspark.sql.Column`` so every one of them
stays inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
# ---------------------------------------------------------------------------

# Characters removed by a Python ``str.strip()`` (every code point whose
# ``isspace()`` is true), built from that rule rather than listed by hand.
WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())

# Country aliases (relational feed).  Fixed values.
COUNTRY_ALIASES = {
    "VIETNAM": "VIETNAM", "VIET NAM": "VIETNAM",
    "USA": "USA", "UNITED STATES": "USA", "US": "USA",
}
# Document feed additionally maps VN.  Fixed value.
DOC_COUNTRY_ALIASES = dict(COUNTRY_ALIASES, VN="VIETNAM")

# Media types and the clean bucket each one is routed to.  Fixed values.
TARGET_BUCKET_BY_TYPE = {
    "image": "clean-images",
    "video": "clean-videos",
    "audio": "clean-audio",
    "document": "clean-documents",
}
# Extension sets used when neither bucket nor MIME type decides.  Fixed values.
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "webp", "gif", "bmp", "tiff"]
VIDEO_EXTENSIONS = ["mp4", "mov", "avi", "mkv", "webm"]
AUDIO_EXTENSIONS = ["mp3", "wav", "ogg", "flac", "m4a"]

DEFAULT_CONTENT_TYPE = "application/octet-stream"
DEFAULT_SOURCE_TYPE = "manual_import"
UNKNOWN = "UNKNOWN"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1 -------------------------------------------------------------------------
def clean_str(c) -> Column:
    """Strip all Unicode whitespace from both ends; empty becomes NULL."""
    return F.nullif(F.btrim(_c(c), F.lit(WHITESPACE)), F.lit(""))


# F2 / F3 ------------------------------------------------------------------
def clean_email(c) -> Column:
    return F.lower(clean_str(c))


def email_domain(email) -> Column:
    """Text after the first '@'; NULL when there is none ('a@' gives '')."""
    e = _c(email)
    pos = F.instr(e, "@")
    return F.when(pos > 0, e.substr(pos + 1, F.lit(1 << 30)))


# F4 -------------------------------------------------------------------------
def clean_phone(c) -> Column:
    """Keep Unicode decimal digits and '+'; empty becomes NULL."""
    return F.nullif(F.regexp_replace(F.coalesce(_c(c), F.lit("")),
                                     r"[^\p{Nd}+]", ""), F.lit(""))


# F5 / F6 ------------------------------------------------------------------
def _alias_map(aliases: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(aliases.items()) for x in kv])


def normalize_country(c, aliases: dict = COUNTRY_ALIASES) -> Column:
    """strip, upper, alias lookup; missing or empty becomes UNKNOWN."""
    up = F.upper(clean_str(c))
    return F.coalesce(F.try_element_at(_alias_map(aliases), up), up,
                      F.lit(UNKNOWN))


def normalize_doc_country(c) -> Column:
    return normalize_country(c, DOC_COUNTRY_ALIASES)


# F11 / F15 ----------------------------------------------------------------
def normalize_upper(c, default: str | None = None) -> Column:
    up = F.upper(clean_str(c))
    return up if default is None else F.coalesce(up, F.lit(default))


def clean_status(c) -> Column:
    return normalize_upper(c, "NEW")


# F10 / F30 ----------------------------------------------------------------
def total_amount(unit_price, qty) -> Column:
    """price x quantity, half-even to 2 dp, computed from the unrounded price."""
    return F.bround(_c(unit_price) * _c(qty), 2)


def round3(c) -> Column:
    """Python ``round(float(x or 0), 3)``: half-even, NULL becomes 0."""
    return F.bround(F.coalesce(_c(c).cast("double"), F.lit(0.0)), 3)


# F16 ------------------------------------------------------------------------
def clean_list(c) -> Column:
    """Strip each element, drop empties, de-duplicate keeping first-seen order."""
    # Looking each end up among all whitespace characters is slow, so only texts
    # that do not begin and end in a visible ASCII character after the spaces go
    # are.  Two transforms: what a lambda names twice is worked out twice.
    visible = lambda x: (x >= F.lit("!")) & (x < F.lit("\x7f"))
    cleaned = F.transform(F.transform(_c(c), lambda x: F.trim(x)), lambda t: F.when(
        visible(t) & visible(F.right(t, F.lit(1))), t).otherwise(F.btrim(t, F.lit(WHITESPACE))))
    kept = F.array_except(cleaned, F.array(F.lit(""), F.lit(None).cast("string")))
    return F.coalesce(kept, F.array().cast("array<string>"))


# F21 ------------------------------------------------------------------------
def stable_hash(*parts) -> Column:
    """sha256 over the parts joined with '|', NULL parts as ''."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(_c(p).cast("string"), F.lit(""))
                                     for p in parts]), 256)


# F22 ------------------------------------------------------------------------
def file_name(key) -> Column:
    return F.element_at(F.split(_c(key), "/"), -1)


def file_extension(name) -> Column:
    """Last suffix, lower case, without the dot; dot-files have none."""
    return F.lower(F.regexp_extract(_c(name), r"^\.*[^.].*\.([^.]*)$", 1))


# F24 ------------------------------------------------------------------------
def media_type_for(bucket, object_key, content_type) -> Column:
    """bucket suffix or MIME prefix (image, video, audio), then extension."""
    b = F.lower(_c(bucket))
    ct = F.lower(F.coalesce(_c(content_type), F.lit("")))
    ext = file_extension(file_name(F.lower(_c(object_key))))
    return (F.when(b.endswith("images") | ct.startswith("image/"), "image")
            .when(b.endswith("videos") | ct.startswith("video/"), "video")
            .when(b.endswith("audio") | ct.startswith("audio/"), "audio")
            .when(ext.isin(IMAGE_EXTENSIONS), "image")
            .when(ext.isin(VIDEO_EXTENSIONS), "video")
            .when(ext.isin(AUDIO_EXTENSIONS), "audio")
            .otherwise("document"))


# F25 / F26 ----------------------------------------------------------------
def normalize_media_type(c) -> Column:
    m = F.lower(F.coalesce(clean_str(c), F.lit("document")))
    return F.when(m.isin(list(TARGET_BUCKET_BY_TYPE)), m).otherwise("document")


def target_bucket(media_type) -> Column:
    return F.try_element_at(_alias_map(TARGET_BUCKET_BY_TYPE), _c(media_type))
