"""Search keeps every row that shares a vec_id, as query and as candidate."""

import numpy as np
from pyspark.sql import functions as F

from terrace.llm import one_bit_ann


def test_rows_that_share_an_id_all_count(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.integers(-9, 9, 6).astype(float).tolist()) for i in [*range(1, 30), 5, 5, 40, 40, 60]]
    rows.append((5, rows[4][1]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = one_bit_ann.search(df, F.col("vec_id") % 20 == 0, k=100, vector_block=10, query_block=2).collect()
    want = []
    for at, (query, v) in enumerate(rows):
        if query % 20 == 0:
            near = sorted((-float(np.dot(v, w)), i) for other, (i, w) in enumerate(rows) if other != at)
            want += [(query, rank, i, -s) for rank, (s, i) in enumerate(near, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == sorted(want)
