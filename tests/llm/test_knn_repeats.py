import numpy as np

from test_knn_join import brute
from weftline.llm import knn_join as K


def test_repeated_query_ids_with_different_vectors(spark):
    """A query id's own long vectors in many cells must not count towards its bound."""
    rng = np.random.default_rng(3)
    draw = lambda size: [float(np.float32(x)) for x in rng.normal(0, size, 4)]
    rows = [(0, draw(4.0)) for _ in range(40)] + [(i, draw(0.3)) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in K.knn_join(df, pivots=32).collect()} == brute(rows)
