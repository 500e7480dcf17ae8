import pytest

SF01 = "/root/testdata/sf0.01"
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, `Shard` int, `ids` string, `n.lines` string, rid string"


def edge_rows():
    """Nulls in every column, empty, blank and very long texts, copies,
    repeated rows, repeated and missing ids, and columns with clashing names."""
    long = " ".join(f"Wort{i % 977}é" for i in range(30_000))
    texts = [None, "", " \t\n", "a", "A  b", "a b", "a\tb", long, long, "one two three four five six seven eight nine ten",
             "one two three four five six seven eight nine ten", "x", "😀 ß <|endoftext|> don't 12,5\r\n\r\n  é"]
    rows = [(i, t, "en", "src", 1, 3, "i", "l", "r") for i, t in enumerate(texts)]
    rows += [(3, "a", "en", "src", 1, None, None, None, None)] * 2
    rows += [(None, "a", None, None, None, None, None, None, None), (None, "only here", None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None), (5, "another text of document five", "en", None, 1, 1, "", "", "")]
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), DOC_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def docs01(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()}
