import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SECRET = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def edge_rows():
    """Null and repeated ids, null, empty and blank texts, a long text, copies,
    non-ASCII text, odd white space, secrets."""
    words = " ".join(f"word{i % 977}x{i % 13}" for i in range(40_000))
    plain = "The quick brown fox jumps over the lazy dog while nobody looks at all today"
    texts = [None, "", " ", "\n\t ", "one", "one two", plain, plain, plain.upper(), plain + " " + plain, words,
             f"a {SECRET} b", "É é ÀB 日本 🙂 naïve", "x  y z   w", "<|endoftext|> hello", "a\r\nb\r\n\r\nc",
             "line one two\nline one two\nline one two\n", "$$$ ### %%% &&& *** |||"]
    rows = [(i, t, "en", "s", 0 if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, plain, None, None, None), (None, None, None, None, None), (6, plain, "en", "s", len(plain)),
             (6, "another text under the same id", "en", "s", 30)]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows_of():
    def run(df, *keys):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return run


@pytest.fixture(scope="session")
def clashing(edge):
    """The edge rows with columns named like the operators' own."""
    names = ("n_words", "spans", "score", "kept", "tree", "n_tokens", "fp", "items", "id", "block", "__base", "hit_spans")
    return edge.select("*", *[F.lit("mine").alias(n) for n in names])
