"""Typed access to semi-structured change images.

Change-event images arrive as JSON.  They are parsed once into Spark's VARIANT
type; every field is then read with the *JSON type* in hand, which is what
the source's coercion rules depend on (``int(2.7)`` is 2, ``int("2.7")``
fails, ``bool("false")`` is true ...).  All of it is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import WHITESPACE, clean_str

INT_MAX = 2_147_483_647
# Epoch millis of the years 1 to 9999; other values are not dates anywhere.
MS_MIN, MS_MAX = -62_135_596_800_000, 253_402_300_799_999
_NUMBER_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_INT_TEXT = r"^[+-]?[0-9]+$"


#: Members of Extended JSON that wrap a scalar, in the order they are looked for.
WRAPPERS = ["$numberInt", "$numberLong", "$numberDouble", "$numberDecimal", "$oid"]


class Fld:
    """A pre-extracted image field: variant value, JSON type and text form,
    each materialised once as its own column (see ``operators.clean``), and
    where those of its inner scalar and of its date are found."""

    def __init__(self, v: Column, t: Column, s: Column, plain=None, date=None):
        self.v, self.t, self.s, self.plain, self.date = v, t, s, plain, date


def _c(x) -> Column:
    if isinstance(x, Fld):
        return x.v
    return F.col(x) if isinstance(x, str) else x


def _vts(x) -> tuple[Column, Column, Column]:
    if isinstance(x, Fld):
        return x.v, x.t, x.s
    x = _c(x)
    return x, vtype(x), as_str(x)


def members(v, names: list[str]) -> Column:
    """The sub-variants of an object's members as a struct, found in one pass:
    NULL for what is no object, a member that is absent is NULL.  (Every path
    to an absent member costs an exception per row.)"""
    return F.try_variant_get(_c(v), "$", "struct<" + ", ".join(f"`{n}`: variant" for n in names) + ">")


def field(v, name: str) -> Column:
    """Sub-variant at ``$.name`` (NULL when absent, variant-null for JSON null)."""
    return members(v, [name]).getField(name)


def unwrapped(wrapper: Column, x: Column) -> Column:
    """The inner scalar of ``x``, whose ``WRAPPERS`` are in ``wrapper``, else ``x``."""
    return F.coalesce(*[wrapper.getField(k) for k in WRAPPERS], x)


def vtype(x) -> Column:
    """JSON type name: NULL (absent), VOID (json null), BOOLEAN, BIGINT,
    DECIMAL(p,s), DOUBLE, STRING, OBJECT<..>, ARRAY<..>."""
    if isinstance(x, Fld):
        return x.t
    return F.coalesce(F.schema_of_variant(_c(x)), F.lit("NULL"))


def is_missing(x) -> Column:
    return _c(x).isNull() | F.is_variant_null(_c(x))


def is_number(t: Column) -> Column:
    return (t == "BIGINT") | (t == "DOUBLE") | t.startswith("DECIMAL")


def as_str(x) -> Column:
    """``str(value)`` for scalars (numbers keep their JSON text)."""
    if isinstance(x, Fld):
        return x.s
    return F.try_variant_get(_c(x), "$", "string")


def null_if_json_null(x) -> Column:
    return F.when(~F.is_variant_null(_c(x)), _c(x))


# ------------------------------------------------------------ Extended JSON
def unwrap_ejson(x):
    """``{"$numberInt": "5"}`` / ``$numberLong`` / ``$numberDouble`` /
    ``$numberDecimal`` / ``$oid`` -> the inner scalar; others unchanged."""
    if isinstance(x, Fld) and x.plain:
        return x.plain()
    x = _c(x)
    return unwrapped(members(x, WRAPPERS), x)


def _millis(ms: Column) -> Column:
    """Timestamp of epoch millis, NULL outside the years 1 to 9999."""
    return F.when(ms.between(MS_MIN, MS_MAX), F.timestamp_millis(F.greatest(F.lit(MS_MIN), F.least(F.lit(MS_MAX), ms))))


def ejson_date(x) -> tuple[Column, Column]:
    """``{"$date": millis | {"$numberLong": s} | iso}`` or plain millis/ISO ->
    (timestamp, flag for a ``$date`` that is none)."""
    d, wrapped = x.date() if isinstance(x, Fld) and x.date else _date_parts(_c(x))
    val = _ejson_date(d)
    return val, wrapped & val.isNull()


def _date_parts(x: Column) -> tuple[Fld, Column]:
    date = field(x, "$date")
    d = unwrap_ejson(F.coalesce(date, x))
    return Fld(d, vtype(d), as_str(d)), date.isNotNull()


def _ejson_date(x: Fld) -> Column:
    d, t = x.v, x.t
    txt = F.when(t == "STRING", x.s)
    return (F.when(is_number(t), _millis(F.try_variant_get(d, "$", "bigint")))
            .when(txt.rlike(_INT_TEXT), _millis(txt.try_cast("bigint")))
            .when(t == "STRING", F.try_to_timestamp(txt)))


def doc_id_text(x) -> Column:
    """Document id as text: ObjectId hex, or the number / string itself."""
    return as_str(unwrap_ejson(x))


# --------------------------------------------------------- Python coercions
def py_int(x) -> tuple[Column, Column]:
    """``int(value)`` -> (value or NULL when int() raises, overflow flag).

    Numbers truncate toward zero, booleans are 1/0, strings must be integer
    text (surrounding whitespace allowed); anything else raises.  The text
    form is only produced for STRING values.
    """
    x, t, s = _vts(x)
    s = F.when(t == "STRING", F.btrim(s, F.lit(WHITESPACE)))
    int_text = F.coalesce(s.rlike(_INT_TEXT), F.lit(False))
    val = (F.when(is_number(t), F.try_variant_get(x, "$", "bigint"))
           .when(t == "BOOLEAN", F.when(F.try_variant_get(x, "$", "boolean"), 1).otherwise(0).cast("bigint"))
           .when(int_text, s.try_cast("bigint")))
    overflow = val.isNull() & (is_number(t) | int_text)
    return val, overflow


def safe_int(x, default: int = 0, minimum: int | None = None,
             maximum: int | None = None) -> Column:
    """int(value) or default, then clamped (document cleaners).  A number
    beyond 64 bits is clamped like any other, to the limits or else to the
    ends of BIGINT (``beyond_bigint`` flags those)."""
    x = unwrap_ejson(x)
    val, over = py_int(x)
    below = F.coalesce(F.ltrim(as_str(x)).startswith("-"), F.lit(False))
    huge = F.when(below, F.lit(-(1 << 63))).otherwise(F.lit((1 << 63) - 1)).cast("bigint")
    r = F.coalesce(val, F.when(over, huge), F.lit(default).cast("bigint"))
    if minimum is not None:
        r = F.greatest(r, F.lit(minimum).cast("bigint"))
    if maximum is not None:
        r = F.least(r, F.lit(maximum).cast("bigint"))
    return r


def beyond_bigint(x) -> Column:
    """A whole number that no 64-bit field can store and no limit clamps
    (negative ones are clamped to 0)."""
    x = unwrap_ejson(x)
    _, over = py_int(x)
    return F.coalesce(over & ~F.ltrim(as_str(x)).startswith("-"), F.lit(False))


def truthy(x) -> Column:
    """Python truthiness of a JSON value (``clean_bool``)."""
    x, t, s = _vts(x)
    return (F.when(t == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
            .when(is_number(t), F.try_variant_get(x, "$", "double") != 0)
            .when(t == "STRING", F.length(s) > 0)
            .when(t.startswith("ARRAY"), F.size(F.try_variant_get(x, "$", "array<variant>")) > 0)
            .when(t.startswith("OBJECT"), F.to_json(x) != "{}")
            .otherwise(F.lit(False)))


def to_decimal(x, precision: int = 28, scale: int = 10) -> tuple[Column, Column]:
    """``Decimal(str(value))`` -> (value or NULL, overflow flag for numbers
    that do not fit)."""
    x, t, s = _vts(x)
    dt = f"decimal({precision},{scale})"
    val = (F.when(is_number(t), F.try_variant_get(x, "$", dt))
           .when(t == "STRING", F.btrim(s, F.lit(WHITESPACE)).try_cast(dt)))
    numeric = F.when(t == "STRING", F.btrim(s, F.lit(WHITESPACE)).rlike(_NUMBER_TEXT)).otherwise(is_number(t))
    return val, F.coalesce(numeric, F.lit(False)) & val.isNull()


def to_timestamp(x) -> tuple[Column, Column]:
    """Epoch millis (UTC) or ISO text -> (timestamp, invalid flag)."""
    x, t, s = _vts(x)
    iso = F.when(t == "STRING", F.try_to_timestamp(s))
    ms = F.when(is_number(t), F.try_variant_get(x, "$", "double"))
    val = (F.when(t == "BIGINT", _millis(F.try_variant_get(x, "$", "bigint")))
           .when(ms.between(MS_MIN, MS_MAX),
                 F.timestamp_micros(F.round(F.greatest(F.lit(float(MS_MIN)), F.least(F.lit(float(MS_MAX)), ms)) * 1000).cast("bigint")))
           .otherwise(iso))
    invalid = (((t == "STRING") | is_number(t)) & val.isNull()) | t.startswith("OBJECT") | t.startswith("ARRAY")
    return val, invalid


def text(x) -> Column:
    """``clean_str(value)`` on a JSON scalar."""
    return clean_str(x.s if isinstance(x, Fld) else as_str(x))


def str_list(x) -> Column:
    """A JSON array as array<string> (elements stringified); NULL if not an array."""
    x, t, _ = _vts(x)
    return F.when(t.startswith("ARRAY"), F.try_variant_get(x, "$", "array<string>"))


def int_field(x, bits: int = 32) -> tuple[Column, Column]:
    """An integer column the target database would store: (value, out-of-range)."""
    val, overflow = py_int(x)
    if bits == 32:
        bad = overflow | (val > INT_MAX) | (val < -INT_MAX - 1)
        return F.when(~bad, val).cast("int"), F.coalesce(bad, F.lit(False))
    return val, overflow


def raw_to_date(x) -> Column:
    """the date of a raw field as text.  A number is epoch milliseconds, in
    UTC; a text that begins with an ISO date, or is one written without
    dashes, gives that date (its own, whatever offset follows); any other text
    of 10 or more characters gives its first 10; all else is NULL."""
    x, t, s = _vts(x)
    ms = F.try_variant_get(x, "$", "double")
    number = F.when(ms.between(MS_MIN, MS_MAX), F.date_format(F.timestamp_millis(F.floor(ms)), "yyyy-MM-dd"))
    compact = F.when(F.rlike(s, F.lit(r"^\d{8}(T.*)?$")), F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2)))
    text = F.coalesce(F.when(compact.try_cast("date").isNotNull(), compact), F.when(F.char_length(s) >= 10, F.substring(s, 1, 10)))
    return F.when(is_number(t), number).when(t == "STRING", text)
