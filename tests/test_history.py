import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarrylake.operators.history import OPEN_END, History, build_history
from quarrylake.plans import gold

SNAPSHOT = History("id", "at", ("x", "y"), "sk")
LOG = History("id", "at", ("x", "y"), "sk", op="op")
START = datetime(2026, 1, 1)
SCHEMA = "id string, at timestamp, op string, x string, y string"


def expected_versions(rows, with_ops):
    """The same history, worked out one entity at a time."""
    out = []
    for entity in {r[0] for r in rows}:
        opened, before, turn = [], None, None
        for _, at, op, x, y in sorted((r for r in rows if r[0] == entity), key=lambda r: r[1]):
            if with_ops:
                turn = op if op in ("I", "D") else turn
                if op == "U" and turn == "D":
                    continue
            state = ("gone",) if with_ops and op == "D" else (x, y)
            if state != before:
                opened.append((at, op, x, y))
            before = state
        for i, (at, op, x, y) in enumerate(opened):
            end = opened[i + 1][0] if i + 1 < len(opened) else datetime.fromisoformat(OPEN_END)
            if not (with_ops and op == "D"):
                out.append((entity, at, op, x, y, end, end.year == 9999))
    return sorted(out, key=str)


def random_log(seed, hot_share=0.5, n=400):
    """Unique moments per entity; one entity holds `hot_share` of the rows, a null one some more."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        entity = "hot" if rng.random() < hot_share else rng.choice(["a", "b", "c", None])
        # moments bunch up, so that equal-depth cuts are far from equal-width ones
        at = START + timedelta(seconds=int(rng.paretovariate(0.7) * 1000) * 1000 + i)
        rows.append((entity, at, rng.choice("IUUUUD"), rng.choice(["1", "2", None]), rng.choice(["p", None])))
    return rows


def built(spark, rows, spec, hot_rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = build_history(df, spec, hot_rows=hot_rows)
    return sorted(
        (tuple(r) for r in got.select("id", "at", "op", "x", "y", "valid_to_ts", "is_current").collect()), key=str
    ), got


@pytest.mark.parametrize("spec, with_ops", [(SNAPSHOT, False), (LOG, True)])
@pytest.mark.parametrize("hot_rows", [10, 60, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_history_is_right_whatever_counts_as_hot(spark, spec, with_ops, hot_rows, seed):
    rows = random_log(seed)
    assert built(spark, rows, spec, hot_rows)[0] == expected_versions(rows, with_ops)


def test_hot_entities_are_cut(spark):
    rows = random_log(3)
    _, cut = built(spark, rows, SNAPSHOT, 10)
    _, whole = built(spark, rows, SNAPSHOT, 10_000)

    def plan(df):
        return df._jdf.queryExecution().toString()

    assert "_chunk" in plan(cut) and "_chunk" not in plan(whole)


def test_history_takes_one_shuffle_on_the_entity(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame(random_log(4), SCHEMA).write.parquet(path)
    for spec in (SNAPSHOT, LOG):
        plan = build_history(spark.read.parquet(path), spec)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_one_moment_for_all_rows_of_a_hot_entity(spark):
    rows = [("hot", START, "I", "1", "p")] + [(f"e{i}", START, "I", "1", "p") for i in range(20)]
    assert built(spark, rows, SNAPSHOT, 1)[0] == expected_versions(rows, False)


def test_first_version_is_kept_and_unchanged_ones_are_not(spark):
    rows = [("a", START + timedelta(days=d), "U", x, None) for d, x in enumerate(["1", "1", "2", None, None])]
    got, _ = built(spark, rows, SNAPSHOT, 100)
    assert [(r[1].day, r[3], r[6]) for r in got] == [(1, "1", False), (3, "2", False), (4, None, True)]


def test_null_positions_are_a_change(spark):
    rows = [("a", START, "U", "1", None), ("a", START + timedelta(days=1), "U", None, "1")]
    assert len(built(spark, rows, SNAPSHOT, 100)[0]) == 2


def test_deletes_close_and_only_inserts_reopen(spark):
    ops = [("I", "1"), ("D", "1"), ("U", "2"), ("U", "3"), ("I", "1"), ("U", "1"), ("D", None), ("D", None)]
    rows = [("a", START + timedelta(days=d), op, x, None) for d, (op, x) in enumerate(ops)]
    for hot_rows in (1, 100):
        got, _ = built(spark, rows, LOG, hot_rows)
        assert [(r[1].day, r[5].day, r[6]) for r in got] == [(1, 2, False), (5, 7, False)]


def test_ties_leave_one_row_per_moment(spark):
    rows = [("a", START, "U", x, "p") for x in ("3", "1", "2")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = build_history(df, SNAPSHOT, ties=[F.col("x").desc()])
    assert [(r["x"], r["is_current"]) for r in got.collect()] == [("3", True)]


def test_rider_dimension(spark):
    rows = [
        ("R1", "I", START, "ES", True, "P", "OP", "C"),
        ("R1", "U", START + timedelta(days=1), "ES", True, "P", "OP", "C"),
        ("R1", "D", START + timedelta(days=2), None, None, None, None, None),
        ("R1", "U", START + timedelta(days=3), None, None, None, None, None),
        ("R2", "I", START, None, True, "P", "OP", "C"),
        ("R2", "D", START, None, None, None, None, None),
    ]
    schema = """rider_id string, op string, op_ts timestamp, country string, marketing_consent boolean,
                plan_id string, operator_id string, home_city_id string"""
    dim = gold.riders(spark.createDataFrame(rows, schema)).orderBy("rider_id").collect()
    assert [(r["rider_id"], r["valid_to_ts"] and r["valid_to_ts"].day, r["is_current"]) for r in dim] == [
        (None, None, None), ("R1", 3, False)]
    assert dim[0]["riders_sk"] == "-1"
