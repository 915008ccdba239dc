"""Edit-aware token counts: every document keeps a segment tree over runs of
pre-tokens, with the characters and tokens below each node.  An edit finds its
leaves by descending on characters; only the text of these leaves, and of
neighbours while a cut beside them no longer holds, is encoded again, and the
sums on the paths to the root follow.

A leaf ends where a space follows a character that is not white space; the
pre-tokenizer never joins the two, so counts of leaves add up to the count of
the whole text (see ``tokens``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import free_name, ship_package
from riverbed.llm.tokens import Encoder, encoder

_CUT = re.compile(r"(?<=\S)(?= )")


class CountTree:
    """Leaves in order, padded to a power of two; node k has children 2k and
    2k + 1, the root is 1."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.leaves = len(chars) // 2

    @classmethod
    def over(cls, sizes: list[tuple[int, int]]) -> CountTree:
        width = 1
        while width < len(sizes):
            width *= 2
        chars, tokens = np.zeros(2 * width, np.int64), np.zeros(2 * width, np.int64)
        if sizes:
            chars[width:width + len(sizes)], tokens[width:width + len(sizes)] = zip(*sizes)
        while width > 1:
            half = width // 2
            for a in (chars, tokens):
                a[half:width] = a[width:2 * width:2] + a[width + 1:2 * width:2]
            width = half
        return cls(chars, tokens)

    @classmethod
    def from_bytes(cls, data: bytes) -> CountTree:
        a = np.frombuffer(data, "<i8").reshape(2, -1)
        return cls(a[0].copy(), a[1].copy())

    def to_bytes(self) -> bytes:
        return np.stack((self.chars, self.tokens)).astype("<i8").tobytes()

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def sizes(self) -> list[int]:
        return self.chars[self.leaves:].tolist()

    def leaf_at(self, at: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds character
        ``at``, the last leaf with characters for the end of the text."""
        node, start = 1, 0
        at = min(at, int(self.chars[1]) - 1)
        while node < self.leaves:
            node *= 2
            if at - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.leaves, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.leaves
        more_c, more_t = chars - int(self.chars[node]), tokens - int(self.tokens[node])
        while node and (more_c or more_t):
            self.chars[node] += more_c
            self.tokens[node] += more_t
            node //= 2


def _count(enc: Encoder, text: str) -> int:
    return len(enc.encode(text)) // 4


def _runs(text: str, least: int) -> list[str]:
    """The text in runs of whole pre-tokens of ``least`` characters or more
    (the last may be shorter)."""
    out, held, size = [], [], 0
    for unit in _CUT.split(text):
        held.append(unit)
        size += len(unit)
        if size >= least:
            out.append("".join(held))
            held, size = [], 0
    return out + (["".join(held)] if held else [])


class CountedText:
    """A text as leaves with its tree."""

    def __init__(self, enc: Encoder, text: str, least: int, tree: CountTree | None = None):
        self.enc, self.least, self.encoded, self.parts, self.tree = enc, least, 0, [], tree
        if tree is None:
            self._grow(_runs(text, least))
        else:
            at = 0
            for n in tree.sizes():
                self.parts.append(text[at:at + n])
                at += n
            if at != len(text):
                raise ValueError("the tree is of another text")

    def _grow(self, parts: list[str], known: dict[str, int] | None = None) -> None:
        sizes = []
        for p in parts:
            n = (known or {}).get(p)
            if n is None:
                n = _count(self.enc, p)
                self.encoded += len(p)
            sizes.append((len(p), n))
        self.tree = CountTree.over(sizes)
        self.parts = parts + [""] * (self.tree.leaves - len(parts))

    @property
    def text(self) -> str:
        return "".join(self.parts)

    def edit(self, at: int, drop: int, add: str) -> None:
        """Replace ``drop`` characters from ``at`` on by ``add``; both are
        held to the text's range."""
        total = int(self.tree.chars[1])
        at = min(max(at, 0), total)
        drop = min(max(drop, 0), total - at)
        if not total:
            self._grow(_runs(add, self.least))
            return
        first, start = self.tree.leaf_at(at)
        last = self.tree.leaf_at(at + drop - 1)[0] if drop else first
        old = "".join(self.parts[first:last + 1])
        new = old[:at - start] + add + old[at - start + drop:]
        # the region must begin and end at a cut, or at an end of the text
        while first > 0 and not new.startswith(" "):
            first -= 1
            new = self.parts[first] + new
        while last + 1 < len(self.parts) and (not new or new[-1].isspace()):
            last += 1
            new += self.parts[last]
        runs = _runs(new, self.least)
        room = last - first + 1
        if len(runs) > 2 * room:                # the tree needs more leaves; no other leaf is encoded again
            known = {p: int(n) for p, n in zip(self.parts, self.tree.tokens[self.tree.leaves:])}
            self._grow([p for p in self.parts[:first] + runs + self.parts[last + 1:] if p], known)
            return
        each = -(-len(runs) // room)
        for k in range(room):
            part = "".join(runs[k * each:(k + 1) * each])
            n = _count(self.enc, part)
            self.encoded += len(part)
            self.parts[first + k] = part
            self.tree.put(first + k, len(part), n)


def _rows(b: pa.RecordBatch, name: str) -> list:
    return b.column(b.schema.get_field_index(name)).to_pylist()


def _build(path: str, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            trees = [CountedText(enc, t or "", least).tree for t in _rows(b, "t")]
            arrays = [*b.columns, pa.array([t.to_bytes() for t in trees], pa.binary()),
                      pa.array([t.n_tokens for t in trees], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*b.schema.names, "tree", "n"])
    return run


def _mapped(df: DataFrame, text: str, extra: list, fn, added: str) -> DataFrame:
    """mapInArrow over all columns of ``df`` under names c0.., the text as t
    and ``extra`` (column, name) pairs; only the columns come back, then
    ``added``."""
    base = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)],
                     F.col(f"`{text}`").alias("t"), *[c.alias(n) for c, n in extra])
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(fn, f"{ddl}, {added}")


def build_trees(docs: DataFrame, path: str, text: str = "text", least: int = 128) -> DataFrame:
    """``docs`` with ``tree`` (the segment tree, binary) and ``n_tokens``;
    names that clash get underscores before them.  A null text has an empty
    tree and no tokens."""
    ship_package(docs.sparkSession)
    out = _mapped(docs, text, [], _build(path, least), "tree binary, n long")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)],
                      F.col("tree").alias(free_name(docs, "tree")), F.col("n").alias(free_name(docs, "n_tokens")))


def _apply(path: str, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            out = {"text": [], "tree": [], "before": [], "after": [], "encoded": []}
            for t, tree, edits in zip(_rows(b, "t"), _rows(b, "old"), _rows(b, "edits")):
                old = CountTree.from_bytes(tree) if tree is not None else CountedText(enc, t or "", least).tree
                doc = CountedText(enc, t or "", least, old)
                out["before"].append(old.n_tokens)
                for e in edits or ():
                    if e is not None:
                        doc.edit(e["at"] or 0, e["drop"] or 0, e["add"] or "")
                out["text"].append(doc.text if t is not None or edits else None)
                out["tree"].append(doc.tree.to_bytes())
                out["after"].append(doc.tree.n_tokens)
                out["encoded"].append(doc.encoded)
            arrays = [*b.columns, pa.array(out["text"], pa.string()), pa.array(out["tree"], pa.binary()),
                      *[pa.array(out[k], pa.int64()) for k in ("before", "after", "encoded")]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*b.schema.names, "text", "tree", "before", "after", "encoded"])
    return run


def apply_edits(counted: DataFrame, edits, path: str, text: str = "text", tree: str = "tree", n_tokens: str = "n_tokens",
                least: int = 128) -> DataFrame:
    """``counted`` (from ``build_trees`` or an earlier call) after its edits:
    the text, tree and count are replaced, and ``tokens_before`` and
    ``chars_encoded`` (characters encoded again) added.

    ``edits`` is a column of array<struct<at, drop, add>>: in order, each in
    the text that those before it left, in code points, held to the text's
    range; null is none.  A feed of edits by document is gathered into such an
    array and joined by id first.  Null texts take edits as empty texts do.
    """
    ship_package(counted.sparkSession)
    out = _mapped(counted, text, [(F.col(f"`{tree}`"), "old"), (edits, "edits")], _apply(path, least),
                  "text string, tree binary, before long, after long, encoded long")
    put = {text: "text", tree: "tree", n_tokens: "after"}
    return out.select(*[F.col(put.get(c, f"c{i}")).alias(c) for i, c in enumerate(counted.columns)],
                      F.col("before").alias(free_name(counted, "tokens_before")),
                      F.col("encoded").alias(free_name(counted, "chars_encoded")))
