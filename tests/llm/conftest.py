import pytest

SCHEMA = "doc_id long, text string"


@pytest.fixture
def corpus(spark):
    """Documents from ``(doc_id, text)`` pairs, with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    def build(rows, parts=3):
        frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        return frame.select("doc_id", "text", *(F.lit("x").alias(name) for name in ("ids", "score", "row", "n", "bucket", "kind", "_row_key", "key", "_stays", "stays", "own", "text_sha256", "component_id")))

    return build


EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (5, "one two three"), (5, "another text here"),
    (None, "no name at all"), (None, None), (6, "Ünïcode dass über ça và, 123!"), (7, "word " * 20000), (8, "x" * 300000),
    (9, "a b c d e f g"), (10, "a b c d e f g"), (-3, "a b c d e f g h"),
]


@pytest.fixture
def edges():
    return EDGES
