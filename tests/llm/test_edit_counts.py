import random
import zlib

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from riverbed.llm import edit_counts as E
from riverbed.llm.catalog import edits_of, op10_edit_token_counts
from riverbed.llm.tokens import Encoder

PARTS = ["a", "word", "É", " ", "  ", "\n", "!", "'s", " the", " of", " x", "foo "]


def applied(text, edits):
    for at, drop, add in edits:
        at = min(max(at, 0), len(text))
        text = text[:at] + add + text[at + max(drop, 0):]
    return text


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_random_edits_equal_encoding_anew(file):
    enc, rng = Encoder(P.path(file)), random.Random(7)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        doc = E.CountedText(enc, text, 8)
        for _ in range(5):
            edit = (rng.randint(-1, len(text) + 2), rng.choice([-1, 0, 0, 1, 3, 10, 50]), "".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 2, 30]))))
            doc.edit(*edit)
            text = applied(text, [edit])
            assert doc.text == text
            assert doc.tree.n_tokens == len(enc.tok.encode(text, add_special_tokens=False).ids)
            again = E.CountTree.from_bytes(doc.tree.to_bytes())
            assert (again.chars == doc.tree.chars).all() and again.chars[1] == len(text)
            for k in range(1, again.leaves):                                # sums on every path
                assert again.tokens[k] == again.tokens[2 * k] + again.tokens[2 * k + 1]
            doc = E.CountedText(enc, text, 8, again)


def test_a_small_edit_of_a_long_text_encodes_little():
    enc = Encoder(P.path("byte_bpe_50k.json"))
    doc = E.CountedText(enc, " ".join(f"word{i}" for i in range(50_000)), 128)
    doc.encoded = 0
    doc.edit(200_000, 3, "xyz")
    assert 0 < doc.encoded < 1000


def test_query_equals_brute_force(spark, sf, docs):
    enc = Encoder(P.path("byte_bpe_50k.json"))
    count = lambda t: len(enc.tok.encode(t, add_special_tokens=False).ids)
    edits = {r["doc_id"]: [tuple(e) for e in r["e"]] for r in docs.select("doc_id", edits_of(F.col("text"), F.col("doc_id")).alias("e")).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = op10_edit_token_counts(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r["doc_id"]]
        new = applied(t, edits[r["doc_id"]])
        assert (r["tokens_before"], r["n_tokens"], r["n_chars"], r["text_crc32"]) == (count(t), count(new), len(new), zlib.crc32(new.encode()))


def test_state_is_kept_over_batches_of_edits(spark, edge, empty, clashing):
    path = P.path("byte_bpe_50k.json")
    enc = Encoder(path)
    first = F.expr("array(named_struct('at', 2, 'drop', 3, 'add', ' new text'), named_struct('at', -5, 'drop', null, 'add', 'x'), null)")
    second = F.expr("array(named_struct('at', 100000, 'drop', 3, 'add', ' the end'))")
    state = E.apply_edits(E.build_trees(edge, path), first, path)
    state = E.apply_edits(state.drop("tokens_before", "chars_encoded"), second, path)
    want = sorted(((r["doc_id"], applied(r["text"] or "", [(2, 3, " new text"), (-5, 0, "x"), (100000, 3, " the end")])) for r in edge.collect()), key=repr)
    rows = state.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in rows), key=repr) == want
    assert all(r["n_tokens"] == len(enc.tok.encode(r["text"], add_special_tokens=False).ids) for r in rows)
    none = E.apply_edits(E.build_trees(edge, path), F.lit(None).cast("array<struct<at:int,drop:int,add:string>>"), path)
    assert sorted((repr((r["doc_id"], r["text"])) for r in none.collect())) == sorted(repr((r["doc_id"], r["text"])) for r in edge.collect())
    assert E.build_trees(empty, path).count() == 0
    named = E.build_trees(clashing, path)
    assert {"tree", "_tree", "n_tokens", "_n_tokens"} <= set(named.columns)
    done = E.apply_edits(named, first, path, tree="_tree", n_tokens="_n_tokens")
    assert done.where("tree = 'mine' and n_tokens = 'mine'").count() == edge.count()


def test_a_tree_of_another_text_is_refused():
    enc = Encoder(P.path("byte_bpe_50k.json"))
    tree = E.CountedText(enc, "one two", 8).tree
    with pytest.raises(ValueError):
        E.CountedText(enc, "one", 8, tree)
