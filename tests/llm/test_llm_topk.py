import numpy as np

from quarrylake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score long"


def plain(rows, every, k):
    whole = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v, *_ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, qv in whole:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(qv, cv, strict=True)), c) for c, cv in whole if c != q and len(cv) == len(qv))
            out |= {(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:k], 1)}
    return out


def search(spark, rows, every, k):
    vectors = topk.whole_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    found = topk.top_k(topk.index(vectors), vectors.filter(f"vec_id % {every} = 0"), k)
    return {tuple(r) for r in found.collect()}


def vectors(n, dims=16, seed=0):
    draw = np.random.default_rng(seed)
    values = draw.normal(size=(n, dims)).astype(np.float32) * np.geomspace(0.4, 0.05, dims, dtype=np.float32)
    return [(i, v.tolist(), 0, 1) for i, v in enumerate(values)]


def test_exact_over_many_small_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 100)
    monkeypatch.setattr(topk, "BLOCK", 7)
    rows = vectors(700)
    assert search(spark, rows, 10, 5) == plain(rows, 10, 5)


def test_ties_go_to_the_smaller_id_and_short_tables_give_all(spark):
    rows = [(i, [0.5, -0.25], 0, 0) for i in range(30)] + [(100, [0.5, -0.25], 0, 0), (101, [-1.0, 1.0], 0, 0)]
    assert search(spark, rows, 10, 4) == plain(rows, 10, 4)
    assert search(spark, rows, 10, 50) == plain(rows, 10, 50)
    assert search(spark, rows[:1], 10, 4) == set()


def test_unusable_vectors_take_no_part(spark):
    rows = vectors(60, 3) + [
        (200, None, 0, 0), (300, [], 0, 0), (400, [1.0, None, 1.0], 0, 0), (500, [float("nan"), 0.0, 0.0], 0, 0),
        (600, [float("inf"), 0.0, 0.0], 0, 0), (None, [1.0, 1.0, 1.0], 0, 0), (700, [1.0, 1.0], 0, 0), (800, [2.0, -1.0], 0, 0), (801, [0.0, 0.0], 0, 0),
    ]
    assert search(spark, rows, 20, 3) == plain(rows, 20, 3)


def test_a_proof_ends_reading_before_the_last_segment():
    draw = np.random.default_rng(4)
    values = (draw.normal(size=(4000, 24)) * np.geomspace(400, 2, 24)).astype(np.int64)
    order = np.ascontiguousarray(np.argsort(-values, axis=0, kind="stable").astype(np.uint16).T)
    shard = topk.Shard(24, np.arange(4000).tobytes(), values.tobytes(), order.tobytes())
    read = []
    scored = shard.vectors
    shard.vectors = type("Seen", (), {"__getitem__": lambda _, rows: read.append(len(rows)) or scored[rows]})()
    for q in range(0, 4000, 500):
        got = shard.best(q, values[q], 10, None)
        every = sorted((-int(values[c] @ values[q]), c) for c in range(4000) if c != q)[:10]
        assert got == [(-s, c) for s, c in every]
    assert max(read) < 1000


def test_an_id_repeated_more_often_than_k_leaves_the_others_whole():
    draw = np.random.default_rng(6)
    values = (draw.normal(size=(4000, 64)) * 300).astype(np.int64)
    for copies in (12, 1300):
        for q in range(20):
            ids, rows = np.arange(4000), values.copy()
            ids[:copies], rows[:copies] = 0, values[q]
            order = np.ascontiguousarray(np.argsort(-rows, axis=0, kind="stable").astype(np.uint16).T)
            shard = topk.Shard(64, ids.tobytes(), rows.tobytes(), order.tobytes())
            scores = rows @ values[q]
            every = sorted((-int(scores[c]), c) for c in range(copies, 4000))[:10]
            assert shard.best(0, values[q], 10, None) == [(-s, c) for s, c in every]


def test_an_empty_table(spark):
    assert search(spark, [], 10, 4) == set()
