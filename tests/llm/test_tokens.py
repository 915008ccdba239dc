import array
import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverbed.llm.tokens import Encoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ENC = {f: Encoder(P.path(f), units=50, pieces=50) for f in FILES}       # small caches, so that they turn over
PARTS = ["a", "B", "é", "É", "İ", "ı", "ſ", "Σ", "σς", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "​", "　", "'s", "'S", "!", "<|endoftext|>",
         "<", "|", "1", "²", "½", "日本", "é", "́", "🙂", "\r\n", "ǅ", "µ", "ª", "·", "­", "-", "don't", " \n ", "hello", "WORLD", ".", ",", ". ", ", ", "*", "×", "¿"]


def whole(enc, text):
    return array.array("I", enc.tok.encode(text, add_special_tokens=False).ids).tobytes()


@pytest.mark.parametrize("file", FILES)
def test_known_kinds(file):
    assert ENC[file].kind is not None and (ENC[file].fast is not None) == file.startswith("byte")


def test_units_of_byte_level_files_too():
    """The unit route, which texts of other characters take, on every text."""
    slow = Encoder(P.path(FILES[0]), units=50, pieces=50)
    slow.fast = None
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
        assert slow.encode(text) == whole(slow, text) == ENC[FILES[0]].encode(text)


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=1500, deadline=None)
@given(parts=st.lists(st.sampled_from(PARTS), max_size=14))
def test_units_give_the_ids_of_the_whole(file, parts):
    text = "".join(parts)
    assert ENC[file].encode(text) == whole(ENC[file], text)


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=400, deadline=None)
@given(text=st.text(max_size=30))
def test_any_text(file, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENC[file].encode(text) == whole(ENC[file], text)


@pytest.mark.parametrize("file", FILES)
def test_documents(file, docs):
    for r in docs.limit(60).collect():
        assert ENC[file].encode(r["text"]) == whole(ENC[file], r["text"])
