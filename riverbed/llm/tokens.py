"""Token ids of whole texts as the tokenizers library gives them.

Byte-level files: where a file's merges are ranks (every merge makes a token of
its own, in the order of their ids), tiktoken over the file's own vocabulary
gives the same ids several times faster; it takes whole texts of characters
whose classes no Unicode version changes, without anything that could be a
special token.  All other texts and files go unit by unit.

Word-level files: whole texts of such characters are cut into pre-tokens by one
pass of the file's own pattern, and the ids of a pre-token come from a cache of
bounded size; tiktoken merges those that are new, with the file's end-of-word
mark as one more byte behind the last.

Units.  A vocabulary file's pre-tokenizer never joins a character that is not white
space with white space after it.  A text may therefore be cut before every
space that follows such a character, and the ids of the units, each encoded
alone, are those of the whole text.  Units repeat, so their ids are kept in a
cache of bounded size per worker process.  A unit of plain letters, digits and
signs is cut further by the file's own pattern, and its pre-tokens go straight
to the library's BPE model; any other unit is encoded by the library whole.
"""

from __future__ import annotations

import array
import json
import re
import unicodedata

import regex
import tiktoken
from tokenizers import Tokenizer

# fixed values: the patterns of the two pre-tokenizers that are known here
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Characters whose class, case and composition no Unicode version changes.
_PLAIN = re.compile("[\t\n\r -;=-~¡-¬®-įı-ž]*")
_MARKS = frozenset(".,;:!?")
_PLAIN_TEXT = re.compile("[\t\n\r -~¡-¬®-įı-ž]*")
_ODD_SPACE = re.compile(r"\s ")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level
    vocabulary: itself where printable, else the next of 256, 257, ..."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """The vocabulary of a byte-level file as tiktoken's ranks, if merging by
    lowest id is what the file's merges say."""
    byte = {c: b for b, c in enumerate(_byte_letters())}
    vocab = spec["model"]["vocab"]
    special = {t["content"] for t in spec.get("added_tokens", [])}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    made = [vocab.get(a + b) for a, b in pairs]
    single = [vocab.get(c) for c in byte]
    if None in made or None in single or any(x >= y for x, y in zip(made, made[1:])) or max(single) >= made[0]:
        return None
    return {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}


#: A byte that UTF-8 never has: the end-of-word mark in tiktoken's ranks.
_END = b"\xff"
#: Longer texts are cut into pre-tokens part by part.
_PART = 1 << 20


def _word_ranks(spec: dict) -> dict[bytes, int] | None:
    """The vocabulary of a word-level file as tiktoken's ranks, if its merges
    are in the order of their ids and come after all single letters."""
    model, byte = spec["model"], {c: b for b, c in enumerate(_byte_letters())}
    suffix = model.get("end_of_word_suffix")
    if not suffix or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("unk_token"):
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}

    def raw(token: str) -> bytes:
        end = token.endswith(suffix)
        return bytes(byte[c] for c in (token[:-len(suffix)] if end else token)) + (_END if end else b"")

    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab.get(a + b) for a, b in pairs]
    single = [vocab.get(c + e) for c in byte for e in ("", suffix)]
    if None in made or None in single or any(x >= y for x, y in zip(made, made[1:])) or max(single) >= made[0]:
        return None
    return {raw(t): i for t, i in vocab.items() if t not in special}


def _plain_words() -> re.Pattern:
    """WORD_LEVEL over the characters of ``_PLAIN_TEXT``."""
    plain = [chr(c) for c in range(0x180) if _PLAIN_TEXT.fullmatch(chr(c))]
    letters, numbers = (re.escape("".join(c for c in plain if unicodedata.category(c)[0] == k)) for k in "LN")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+")


class _Cache(dict):
    """Two generations of at most ``most`` entries each."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, units: int = 250_000, pieces: int = 500_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.letters = _byte_letters()
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        self.kind = None
        if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            self.kind, self.pattern = "byte", regex.compile(BYTE_LEVEL)
        elif norm and pre.get("type") == "Sequence" and \
                [n.get("type") for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and \
                pre["pretokenizers"][0].get("pattern", {}).get("Regex") == WORD_LEVEL and \
                [p.get("type") for p in pre["pretokenizers"]] == ["Split", "ByteLevel"]:
            self.kind, self.pattern = "word", regex.compile(WORD_LEVEL)
        if spec.get("model", {}).get("type") != "BPE":
            self.kind = None
        self.fast = None
        if self.kind == "byte" and (ranks := _ranks(spec)):
            self.fast = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.words = None
        if self.kind == "word" and (ranks := _word_ranks(spec)):
            self.words, self.cut = tiktoken.Encoding("file", pat_str=WORD_LEVEL, mergeable_ranks=ranks, special_tokens={}), _plain_words()
        self.pieces = _Cache(self._word if self.words else self._piece, pieces)
        self.head = _Cache(self._unit, units)                       # a unit at the start of a text
        self.rest = _Cache(lambda u: self._unit(" " + u), units)    # one after a space

    def _whole(self, text: str) -> bytes:
        return array.array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        letters = self.letters
        return array.array("I", [t.id for t in self.model.tokenize(
            "".join([letters[b] for b in piece.encode()]))]).tobytes()

    def _word(self, piece: str) -> bytes:
        return array.array("I", self.words._encode_single_piece(piece.encode() + _END)).tobytes()

    def _unit(self, unit: str) -> bytes:
        if self.kind is None or not _PLAIN.fullmatch(unit):         # a "<" might begin a special token
            return self._whole(unit)
        if self.kind == "word":
            unit = unit.lower()
        # most units are a word, or a word and one mark: what the pattern would find
        word = unit[1:] if unit[:1] == " " else unit
        if word.isalpha():
            return self.pieces[unit]
        if word[-1:] in _MARKS and word[:-1].isalpha():
            return self.pieces[unit[:-1]] + self.pieces[word[-1]]
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(unit)))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.fast is not None and "<|" not in text and _PLAIN_TEXT.fullmatch(text):
            return array.array("I", self.fast.encode_ordinary(text)).tobytes()
        if self.words is not None and "<|" not in text and _PLAIN_TEXT.fullmatch(text):
            out, at = [], 0
            while at < len(text):
                to = text.find(" ", at + _PART)                     # no pre-token spans white space
                part, at = (text[at:], len(text)) if to < 0 else (text[at:to], to)
                out += map(self.pieces.__getitem__, self.cut.findall(part.lower()))
            return b"".join(out)
        if self.kind == "word":
            # white space parts pre-tokens and is dropped
            return b"".join(map(self.head.__getitem__, text.replace("\n", " ").split(" ")))
        if self.kind == "byte" and not _ODD_SPACE.search(text):
            first, *rest = text.split(" ")
            if rest and not rest[-1]:                               # a space at the end stays with its unit
                rest[-2:] = [rest[-2] + " "] if len(rest) > 1 else []
                if not rest:
                    first += " "
            return self.head[first] + b"".join(map(self.rest.__getitem__, rest))
        if self.kind == "byte":
            # cut only before a space that follows a character which is not white space
            return b"".join(map(self.head.__getitem__, _CUT.split(text)))
        return self._whole(text)


_CUT = re.compile(r"(?<=\S)(?= )")
_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


