import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with every awkward case: nulls, empty and long texts, repeated rows, clashing columns."""
    base = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the silent river bank at dawn"
    words = base.split()
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    rows = [
        (1, base), (2, base), (2, base), (3, base.upper()), (4, base.replace("lazy", "idle")), (5, ""), (6, None), (None, base + " tail"), (None, None), (7, long), (8, long + " end"),
        (9, "one two"), (10, "one two"), (11, "ONE two"), (12, " ".join(reversed(words))), (13, "!!! ... 123"), (14, "é" * 300), (15, "x" * 1000), (16, "x" * 1000 + "y"),
        (17, (base + " ") * 6), (18, "\n\t  \x0b"), (19, "a\x00b " * 60), (20, "Grüße aus München und Köln, ß und Ä " * 9),
    ]
    return spark.createDataFrame([(i, t, "x", "y", "z", 0, 1) for i, t in rows], "doc_id long, text string, text_hash string, spans string, shard string, _k int, n int")


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
