from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarrylake.functions import amounts, columns, keys, text, times


def values(spark, rows, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*exprs).collect()]


def one(spark, value, kind, expr):
    return values(spark, [(value,)], f"v {kind}", expr(F.col("v")).alias("r"))[0][0]


@pytest.mark.parametrize("written, zone, expected", [
    ("1784936157000", "Europe/Lisbon", "2026-07-24 23:35:57"),
    ("2026-07-25 00:12:11", "Europe/Madrid", "2026-07-24 22:12:11"),
    ("2026-03-29 02:30:00", "Europe/Madrid", "2026-03-29 01:30:00"),
    ("2026-10-25 02:30:00", "Europe/Madrid", "2026-10-25 00:30:00"),
    ("2026-04-11T13:08:50+02:00", None, "2026-04-11 11:08:50"),
    ("2026-04-11T13:08:50Z", "Europe/Paris", "2026-04-11 13:08:50"),
    ("11/04/2026 11:56", "Europe/Paris", "2026-04-11 09:56:00"),
    ("31/13/2026 11:56", "Europe/Paris", None),
    ("2026-02-30 10:00:00", "Europe/Paris", None),
    ("2026-99-11T13:08:50Z", "Europe/Paris", None),
    ("2026-04-11", "Europe/Paris", None),
    ("2026-04-11 10:00", "Europe/Paris", None),
    ("99999999999999999999", "Europe/Paris", None),
    ("2026-07-25 00:12:11", None, None),
    ("soon", "Europe/Paris", None),
    ("", "Europe/Paris", None),
    (None, "Europe/Paris", None),
])
def test_instant(spark, written, zone, expected):
    got = values(spark, [(written, zone)], "t string, z string",
                 times.instant(F.col("t"), F.col("z")).cast("string"))
    assert got == [(expected,)]


def test_instant_does_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame([("2026-07-25 00:12:11",)], "t string")
    millis = F.unix_millis(times.instant(F.col("t"), F.lit("Europe/Madrid")))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert rows.select(millis).first()[0] == 1784931131000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("written, expected", [
    ("1976", 1976.0), ("0.35km", 350.0), ("0.35 km", 350.0), ("-12.5", 12.5), ("-1km", 1000.0),
    ("350m", None), ("far", None), ("", None), (None, None),
])
def test_metres(spark, written, expected):
    assert one(spark, written, "string", amounts.metres) == expected


def test_money(spark):
    rows = [("10.00", "SEK"), ("10.00", "EUR"), ("10.00", None), (None, "SEK")]
    got = values(spark, rows, "a string, c string",
                 amounts.in_euros(F.col("a").cast("decimal(10,2)"), F.col("c")).cast("decimal(10,2)"))
    assert [r[0] for r in got] == [Decimal("0.88"), Decimal("10.00"), Decimal("10.00"), None]
    assert one(spark, 1234, "bigint", amounts.from_minor_units) == Decimal("12.34")
    assert one(spark, -5, "bigint", amounts.from_minor_units) == Decimal("-0.05")
    assert one(spark, 2**62, "bigint", amounts.from_minor_units) is None


@pytest.mark.parametrize("value, expected", [("50.3", "0.5030"), ("0.5034", "0.5034"), ("1", "1.0000"), (None, None)])
def test_fraction(spark, value, expected):
    got = values(spark, [(value,)], "v string", amounts.as_fraction(F.col("v").cast("decimal(10,4)")).cast("string"))
    assert got == [(expected,)]


def test_null_island_needs_both_zeros(spark):
    lat, lon = F.col("lat"), F.col("lon")
    got = values(spark, [(0.0, 0.0), (0.0, 1.0), (None, 0.0)], "lat double, lon double",
                 amounts.off_null_island(lat, lat, lon), amounts.off_null_island(lon, lat, lon))
    assert got == [(None, None), (0.0, 1.0), (None, 0.0)]


def test_text(spark):
    assert [one(spark, v, "string", text.country_code) for v in ("esp", "France", "SWE", "PT", "Atlantis", None)] == [
        "ES", "FR", "SE", "PT", None, None]
    assert [one(spark, v, "string", text.person_name) for v in (" jane DOE ", " Unknown", "o'NEIL", None)] == [
        "Jane Doe", None, "O'neil", None]
    assert one(spark, "  A@B.C ", "string", text.email_address) == "a@b.c"
    assert [one(spark, v, "string", text.empty_to_null) for v in ("", "x", None)] == [None, "x", None]
    assert [one(spark, v, "string", lambda c: text.is_value(c, "active")) for v in ("active", "no", None)] == [
        True, False, False]


def test_paths(spark):
    path = "s3a://b/rides/dt=2026-04-05/rides_CTY-GOT_2026-04-05.csv"
    assert one(spark, path, "string", text.city_of_file) == "CTY-GOT"
    assert one(spark, "s3a://b/other.csv", "string", text.city_of_file) is None
    assert one(spark, path, "string", lambda c: text.path_key(c, "dt")) == "2026-04-05"
    assert one(spark, "/k=a%2Fb+c/x", "string", lambda c: text.path_key(c, "k")) == "a/b+c"
    assert one(spark, "/k=100%/x", "string", lambda c: text.path_key(c, "k")) == "100%"


def test_duration(spark):
    rows = [(None, datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 1, 0, 500000)), (7, None, None),
            (None, datetime(2026, 1, 1), None)]
    got = values(spark, rows, "m int, s timestamp, e timestamp", times.duration(F.col("m"), F.col("s"), F.col("e")))
    assert [r[0] for r in got] == [60.5, 7.0, None]


def test_hashed_tells_null_positions_apart(spark):
    got = values(spark, [("a", None), ("a", "~~"), (None, "a")], "x string, y string", keys.hashed(F.col("x"), F.col("y")))
    assert len({r[0] for r in got}) == 3


def test_flatten(spark):
    df = spark.sql("""SELECT 1 AS id, named_struct('a', named_struct('b', true, 'c', null), 'l', array(1, 2)) AS s,
                      'later' AS s_a_b""")
    flat = columns.flatten(df)
    assert flat.columns == ["id", "s_a_b", "s_a_c", "s_l"]
    assert tuple(flat.first()) == ("1", "later", None, "[1,2]")
    assert {t for _, t in flat.dtypes} == {"string"}


def test_cast_and_unreadable(spark):
    types = {"d": "date", "n": "int"}
    df = spark.createDataFrame([("2026-04", "1"), ("", " "), ("no", "2"), (None, "x")], "d string, n string")
    got = columns.cast_columns(df.withColumn("bad", columns.unreadable(df, types)), types).collect()
    assert [tuple(r) for r in got] == [(date(2026, 4, 1), 1, False), (None, None, False), (None, 2, True), (None, None, True)]


def test_column_layout(spark):
    df = spark.createDataFrame([(1, "x", "y")], "c int, a string, b string")
    assert columns.key_first(df, "b").columns == ["b", "c", "a"]
    assert columns.sorted_columns(df).columns == ["a", "b", "c"]
    assert columns.with_declared(df, ["a", "z"]).columns == ["c", "a", "b", "z"]
    blanked = columns.blank_where(df, F.col("a") == "x", ["a"]).first()
    assert tuple(blanked) == (None, "x", None)
    both = columns.union_by_name(df.select("c", "a"), df.select("b", "c"))
    assert sorted(map(tuple, both.collect()), key=str) == [(1, "x", None), (1, None, "y")]


def test_epoch_texts_of_any_length(spark):
    from quarrylake.functions import times

    texts = ["0", "1784936157000", "000000000001784936157000", "9223372036854775", "9223372036854776", "1" * 19, "9" * 40, "12a", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(times.epoch_millis(F.col("t")).alias("n"), times.beyond_timestamps(F.col("t")).alias("lost")).collect()
    assert [r.lost for r in got] == [False, False, False, False, True, True, True, False, False, False]
    assert [r.n for r in got[:4]] == [0, 1784936157000, 1784936157000, 9223372036854775]
    assert [r.n for r in got[4:]] == [None] * 6
    moments = df.select(F.unix_micros(times.instant(F.col("t"), F.lit("UTC"))).alias("us")).collect()
    assert [r.us for r in moments] == [0, 1784936157000000, 1784936157000000, 9223372036854775000] + [None] * 6
