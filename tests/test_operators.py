from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarrylake.operators import dimensions, quality
from quarrylake.operators.dedupe import distinct_records, keep_latest, keep_one
from quarrylake.operators.lookup import add_attributes, keep_members, keep_strangers, mark_members
from quarrylake.operators.skew import NONE_HOT, find_hot, join_unique
from quarrylake.plans import gold, silver


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keyed_rows(spark):
    return spark.range(900).select(
        F.when(F.col("id") < 300, "hot").when(F.col("id") < 400, None)
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), "id")


def test_find_hot_names_the_key_of_a_third_of_all_rows_and_null(spark):
    df = keyed_rows(spark)
    hot = find_hot(df, ["k"], 50)
    assert hot.rows == 400 and hot.keys == 2
    assert hot.rows_of(df, ["k"]).count() == 400 and hot.others(df, ["k"]).count() == 500
    assert not find_hot(df, ["k"], 1000)


def test_no_number_of_hot_keys_is_too_many(spark):
    df = spark.range(30_000).select((F.col("id") % 6000).alias("k"))
    hot = find_hot(df, ["k"], 5)
    assert hot.keys == 6000 and hot.rows == 30_000
    assert hot.others(df, ["k"]).isEmpty()


def test_hot_join_has_the_rows_of_the_plain_one(spark):
    left = keyed_rows(spark)
    right = left.where("id >= 250 AND id <= 700").select("k").distinct().where("k IS NOT NULL").withColumn("v", F.lit(1))
    hot = find_hot(left, ["k"], 50)
    plain = sorted(map(tuple, join_unique(left, right, ["k"]).collect()), key=str)
    assert sorted(map(tuple, join_unique(left, right, ["k"], hot).collect()), key=str) == plain
    assert len(plain) == 900


def test_only_hot_rows_are_broadcast_joined(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = keyed_rows(spark)
        right = left.select("k").where("k IS NOT NULL").distinct().withColumn("v", F.lit(1))
        joined = plan(join_unique(left, right, ["k"], find_hot(left, ["k"], 50)))
        assert "BroadcastHashJoin" in joined and "SortMergeJoin" in joined
        assert "BroadcastHashJoin" not in plan(join_unique(left, right, ["k"], NONE_HOT))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_membership(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    members = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [tuple(r) for r in mark_members(df, "k", members, "m").orderBy("id").collect()] == [
        (1, "a", True), (2, None, False), (3, "z", False)]
    assert [r.id for r in keep_members(df, "k", members).collect()] == [1]
    assert sorted(r.id for r in keep_strangers(df, "k", members).collect()) == [2, 3]
    named = add_attributes(df, "k", spark.createDataFrame([("a", 9)], "k string, v int"), ["v"])
    assert named.columns == ["id", "k", "v"]
    assert [r.v for r in named.orderBy("id").collect()] == [9, None, None]


def test_parts_are_the_whole_table(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    rules = [quality.Rule("negative", F.col("v") < 0), quality.Rule("any", F.col("v").isNotNull())]
    kept, rejected, _ = quality.part(quality.tag(df, rules))
    assert [r.id for r in kept.collect()] == [2]
    assert sorted((r.id, r._reject_reason) for r in rejected.collect()) == [(1, "any"), (3, "negative")]
    described = quality.describe_rejects(rejected, "t", F.lit(datetime(2026, 4, 2, 23)))
    assert {(r._table, str(r.reject_date)) for r in described.collect()} == {("t", "2026-04-02")}


def test_an_earlier_reason_stays(spark):
    df = spark.createDataFrame([(1, "x")], "id int, n string")
    tagged = quality.tag_unreadable(quality.tag(df, [quality.Rule("first", F.lit(True))]), {"n": "int"})
    row = tagged.first()
    assert row._reject_reason == "first" and row._raw == '{"id":1,"n":"x"}'


@pytest.mark.parametrize("partitions", [1, 7])
def test_survivors_do_not_depend_on_the_partitioning(spark, partitions):
    rows = [("a", 1, "x"), ("a", 1, "b"), ("a", None, "c"), ("b", None, "d"), (None, 2, "e"), (None, 3, "f")]
    df = spark.createDataFrame(rows, "k string, t int, v string").repartition(partitions)
    assert sorted(map(tuple, keep_latest(df, ["k"], "t").collect()), key=str) == [
        ("a", 1, "b"), ("b", None, "d"), (None, 3, "f")]
    assert {r.v for r in keep_one(df, ["k"]).collect()} == {"c", "d", "e"}


def test_keep_one_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3).repartition(4)
    assert plan(keep_one(df, ["k"])).count("WindowGroupLimit") == 2


def test_copies_are_combined_before_the_shuffle(spark):
    copies = spark.range(1000).select(F.lit("same").alias("k"), F.lit("f").alias("_source_file")).repartition(4)
    deduped = distinct_records(copies)
    assert deduped.count() == 1 and plan(deduped).count("SortAggregate") == 2


def test_distinct_records_look_past_provenance(spark):
    rows = [("a", None, "t2", "f2"), ("a", None, "t1", "f9"), ("b", 1, "t1", "f1")]
    df = spark.createDataFrame(rows, "k string, v int, _ingest_ts string, _source_file string")
    assert sorted(map(tuple, distinct_records(df).collect())) == [("a", None, "t1", "f9"), ("b", 1, "t1", "f1")]
    assert distinct_records(df.select("k", "v")).count() == 2


def test_calendar_and_clock(spark):
    dates = gold.dates(spark)
    assert dates.count() == 366 and dates.select("date_sk").distinct().count() == 366
    first = dates.where("date = DATE '2026-01-01'").first()
    assert (first.month, first.year, first.day, first.day_week, first.is_weekend) == (1, 2026, 1, 3, False)
    assert dates.where("is_weekend").count() == 104
    clock = gold.time_of_day(spark)
    assert clock.count() == 86401 and clock.where("time_sk = '-1'").count() == 1
    got = clock.where("time = TIMESTAMP '1970-01-01 23:59:59'").select(
        F.col("time_sk") == F.sha2(F.lit("1970-01-01 23:59:59"), 256))
    assert got.first()[0]


def test_enumerated_and_junk_members(spark):
    df = spark.createDataFrame([("a", True), ("b", None), ("a", True)], "x string, y boolean")
    methods = dimensions.enumerated_dimension(df, "y", "sk").collect()
    assert len(methods) == 3 and len({r.sk for r in methods}) == 3
    junk = dimensions.junk_dimension(df, ["x", "y"], "sk").collect()
    assert {(r.x, r.y) for r in junk if r.sk != "-1"} == {("a", True), ("a", None), ("b", True), ("b", None)}
    assert len({r.sk for r in junk}) == 5


def test_a_junk_dimension_has_no_bound_and_no_single_task(spark):
    df = spark.range(1100).withColumn("x", F.col("id") + 1)
    made = dimensions.combinations(df, ["id", "x"])
    assert made.count() == 1100 * 1100
    assert "SinglePartition" not in plan(made)


def test_rows_without_a_key_are_no_duplicates(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 2), ("a", 1), ("a", 2)], "k string, v int")
    assert sorted(map(tuple, keep_one(df, ["k"], nulls_apart=True).collect()), key=str) == [("a", 1), (None, 1), (None, 2)]


def test_a_parent_listed_twice_does_not_fan_out(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    twice = spark.createDataFrame([("a", 2), ("a", 1), (None, 3)], "k string, v int")
    assert sorted(map(tuple, add_attributes(df, "k", twice, ["v"]).collect()), key=str) == [("a", 1), ("b", None), (None, None)]


def test_deleted_riders_are_blanked_everywhere(spark):
    schema = """op string, op_ts string, rider_id string, operator_id string, email string, country string,
                signup_date string, marketing_consent string, account_status string, birth_year string, dt string"""
    rows = [
        ("I", "2026-04-02T10:00:00Z", "R1", "OP-1", " A@B.C ", "esp", "2026-04-01", "true", "active", "1990", "d"),
        ("D", "2026-04-03T10:00:00Z", "R1", "OP-1", "REDACTED", "esp", "2026-04-01", "true", "deleted", "1990", "d"),
        ("I", "2026-04-02T10:00:00Z", "R2", "OP-1", " X@Y.Z ", "FR", "2026-04-01", "true", "active", "1990", "d"),
        ("I", "2026-04-02T10:00:00Z", "R2", "OP-1", " X@Y.Z ", "FR", "2026-04-01", "true", "active", "1990", "e"),
        ("I", "2026-04-02T10:00:00Z", "R3", "OP-9", "q", "FR", "2026-04-01", "true", "active", "1990", "d"),
        ("I", "2026-04-02T10:00:00Z", "R4", "OP-1", "q", "Mars", "2026-04-01", "true", "active", "1990", "d"),
        ("I", "2026-04-02T10:00:00Z", "R5", "OP-1", "q", None, "2026-04-01", "often", "active", "1990", "d"),
    ]
    operators = spark.createDataFrame([("OP-1",)], "operator_id string")
    kept, rejected, _ = silver.riders(spark.createDataFrame(rows, schema), operators)
    got = {(r.rider_id, r.op, r.email, r.country, r.birth_year, r.is_active) for r in kept.collect()}
    assert got == {("R1", "I", "REDACTED", None, None, False), ("R1", "D", "REDACTED", None, None, False),
                   ("R2", "I", "x@y.z", "FR", 1990, True)}
    assert kept.count() == 3
    assert {r.rider_id: r._reject_reason for r in rejected.collect()} == {
        "R3": "invalid_fk_operator", "R4": "Unknown country", "R5": "Unreadable value"}


@pytest.mark.parametrize("hot_rows", [2, 300, 1000])
def test_survivors_do_not_depend_on_what_is_hot(spark, hot_rows):
    df = keyed_rows(spark).withColumn("t", F.col("id") % 7).unionByName(keyed_rows(spark).withColumn("t", F.col("id") % 5))
    hot = find_hot(df, ["k"], hot_rows)
    for nulls_apart in (False, True):
        wanted = keep_latest(df, ["k"], "t", nulls_apart=nulls_apart)
        got = keep_latest(df, ["k"], "t", nulls_apart=nulls_apart, hot=hot)
        assert got.columns == df.columns and sorted(got.collect(), key=str) == sorted(wanted.collect(), key=str)


def test_rows_of_rare_keys_are_sorted_once_behind_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 90)
    shown = plan(keep_latest(df, ["k"], "id", nulls_apart=True, hot=NONE_HOT))
    assert shown.count("Sort [") == 1 and shown.count("Exchange hashpartitioning") == 1
    assert shown.index("Sort [") < shown.index("Exchange hashpartitioning")


def test_a_junk_dimension_reads_its_table_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(50).selectExpr("id % 3 AS x", "id % 2 AS y", "id % 5 AS z")
        shown = plan(dimensions.combinations(df, ["x", "y", "z"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert shown.count("Range (") == 1 and shown.count("ReusedExchange") == 2
