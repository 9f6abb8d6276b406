import random

from weftline.llm import quality_rules as Q


def test_all_trusted_documents_count(spark):
    """Labels of other documents, however many, change no ratio."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(50 + i)}" for _ in range(60))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.range(100_001).selectExpr("id AS doc_id", "1 - CAST(id % 2 AS INT) AS quality", "0 AS toxic")
    many, few = ({r["doc_id"]: r["ratio"] for r in Q.quality_rules(docs, x).collect()} for x in (labels, labels.where("doc_id < 60")))
    assert many == few and any(many.values())
