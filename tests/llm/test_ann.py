"""Nearest neighbours: recall against brute force, exact scores, odd vectors."""

import numpy as np
from postlens.llm import ann


def brute(rows, modulus, count=20):
    out = {}
    for q, x in rows.items():
        if q % modulus == 0:
            near = sorted(((-float(np.dot(x, y)), i) for i, y in rows.items() if i != q))
            out[q] = [i for _, i in near[:count]]
    return out


def test_recall_and_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    got = ann.nearest(table.withColumn("node", ann.F.lit(1)), 20).collect()
    want = brute(rows, 20)
    found = {q: [r for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in want}
    hits = [len({r.vec_id for r in found[q]} & set(want[q])) for q in want]
    assert sum(hits) / (20 * len(want)) >= 0.95
    for q, mine in found.items():
        assert [r.rank for r in mine] == list(range(1, 21)) and q not in {r.vec_id for r in mine}
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        assert all(abs(r.score - np.dot(rows[q], rows[r.vec_id])) < 1e-12 for r in mine)


def test_odd_vectors_lengths_and_copies(spark):
    rng = np.random.default_rng(4)
    rows = {i: (rng.standard_normal(8) * rng.choice([0.1, 1, 5])).tolist() for i in range(60)}
    rows |= {100 + i: rows[7] for i in range(40)}
    odd = [(200, None), (220, []), (240, [0.0] * 8), (260, [1.0, None] * 4), (280, [float("nan")] * 8)]
    odd += [(300, [float("inf")] * 8), (320, [1.0] * 3), (None, [1.0] * 8), (0, rows[0])]
    table = spark.createDataFrame(list(rows.items()) + odd, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in sorted(ann.nearest(table, 20).collect(), key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute({i: np.array(v) for i, v in rows.items()}, 20)
    assert got.keys() == want.keys()
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.95 * 20 * len(want)


def test_few_and_no_rows(spark):
    table = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(table, 20).collect()]
    assert sorted(got) == [(20, 1, 1, 0.5), (20, 2, 2, -1.0)]
    assert ann.nearest(table.limit(0), 20).count() == 0
    assert ann.nearest(table.where("vec_id = 20"), 20).count() == 0
