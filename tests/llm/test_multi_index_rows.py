"""Every query gets as many neighbours as there are."""

import numpy as np


def test_stray_queries_among_copies_get_all_ranks(spark):
    from hirelake.llm.multi_index import search
    one = np.eye(40)
    x = [np.concatenate([one[i % 40], one[i % 40]]) for i in range(1200)]  # groups of 30 equal vectors
    x += [np.zeros(80) for _ in range(21)]
    x[1200], x[1220] = np.concatenate([one[3], one[9]]), np.concatenate([one[5], one[1]])  # alone in their cells; zero vectors take no part
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found: dict[int, list] = {}
    for r in search(vectors).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert {q: len(v) for q, v in found.items()} == {q: 20 for q in range(0, 1221, 20)}
    assert all(q not in v for q, v in found.items())
