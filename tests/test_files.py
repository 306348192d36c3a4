import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarrylake.plans import bronze
from quarrylake.session import scratch_path
from quarrylake.sources import files, readers, tables
from quarrylake.spec import SOURCES, Lake, Source
from quarrylake.streaming.ingest import ingest_available


def put(base, name, content):
    path = Path(base) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content, encoding="utf-8")
    return str(path)


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    put(tmp_path, "dt=1/a.csv", 'id,name,note\n1,"a, b",\n2,"say ""x""",y\n')
    put(tmp_path, "dt=2/b.csv", "name,promo,id\nc,P,3\n")
    put(tmp_path, "dt=3/c.csv", "id,name,note\n4,é,z\n")
    df = readers.read_csv(spark, str(tmp_path))
    assert rows(df, "id", "name", "note", "promo") == [
        ("1", "a, b", None, None), ("2", 'say "x"', "y", None), ("3", "c", None, "P"), ("4", "é", "z", None)]
    assert {t for _, t in df.dtypes} == {"string"}


def test_csv_fields_may_run_over_line_ends(spark, tmp_path):
    put(tmp_path, "a.csv", 'id,note\n1,"two\nlines"\n2,x\n')
    put(tmp_path, "b.csv", "id,note\n3,y\n")
    assert rows(readers.read_csv(spark, str(tmp_path)), "id", "note") == [("1", "two\nlines"), ("2", "x"), ("3", "y")]


def test_csv_of_one_header_needs_no_union(spark, tmp_path):
    put(tmp_path, "a.csv", "id,v\n1,2\n")
    put(tmp_path, "b.csv", "id,v\n3,4\n")
    assert rows(readers.read_csv(spark, str(tmp_path)), "id", "v") == [("1", "2"), ("3", "4")]
    assert rows(readers.read_csv(spark, str(tmp_path), same_header=True), "id", "v") == [("1", "2"), ("3", "4")]


def test_ndjson_is_flattened_and_keeps_number_text(spark, tmp_path):
    put(tmp_path, "city=X/a.json", '{"id":1,"v":1.50,"o":{"a":true,"b":null},"l":["x"]}\n\n{"id":2,"late":"y"}\n')
    source = Source("t", "S", "ndjson", "t", ("city",))
    df = readers.read_source(spark, str(tmp_path), source)
    assert rows(df, "id", "v", "o_a", "l", "late", "city") == [
        ("1", "1.50", "true", '["x"]', None, "X"), ("2", None, None, None, "y", "X")]
    assert df.columns == sorted(df.columns)


def test_a_broken_line_is_kept_beside_the_good_ones(spark, tmp_path):
    put(tmp_path, "a.json", '{"id":1}\n{"id":\n')
    df = readers.read_ndjson(spark, str(tmp_path))
    assert rows(df, "id", "_corrupt_record") == [("1", None), (None, '{"id":')]


def test_documents(spark, tmp_path):
    doc = {"source": "outer", "period": "2026-04", "days": [{"d": 1, "source": "inner", "x": {"y": 2}}, {"d": 2}]}
    put(tmp_path, "a.json", json.dumps(doc, indent=2))
    put(tmp_path, "b.json", json.dumps({"source": "o2", "period": "2026-05", "days": []}))
    wide = readers.read_documents(spark, str(tmp_path), "days", envelope=True)
    assert rows(wide, "d", "source", "period", "x_y") == [
        ("1", "inner", "2026-04", "2"), ("2", None, "2026-04", None)]
    bare = readers.read_documents(spark, str(tmp_path), "days")
    assert set(bare.columns) == {"d", "source", "x_y", readers.FILE}


def test_xml(spark, tmp_path):
    put(tmp_path, "period=2026-04/m.xml", """<?xml version="1.0"?><events>
      <event id="007" kind="k"><cost currency="EUR">12.50</cost><part>a</part><part n="2">b</part><who/></event>
      <event id="8"><cost>3</cost></event></events>""")
    df = readers.read_source(spark, str(tmp_path), SOURCES["maintenance"])
    assert rows(df, "id", "kind", "cost", "cost_currency", "part", "part_n", "period") == [
        ("007", "k", "12.50", "EUR", "b", "2", "2026-04"), ("8", None, "3", None, None, None, "2026-04")]


def test_whole_file_text(spark, tmp_path):
    put(tmp_path, "a.txt", "é\nü\n")
    assert rows(readers.read_text(spark, str(tmp_path)), "value") == [("é\nü\n",)]


def test_inventory_leaves_empty_files_out(spark, tmp_path):
    put(tmp_path, "dt=2026-01-01/city=A/x.csv", "a\n")
    put(tmp_path, "dt=2026-01-01/city=A/empty.csv", "")
    put(tmp_path, "dt=2026-01-02/city=B/y.csv", "a\n")
    put(tmp_path, "dt=2026-01-02/city=B/y.json", "{}")
    found = files.list_files(spark, str(tmp_path), "*.csv")
    assert rows(files.key_inventory(found, ["city", "dt"]), "city", "dt", "files") == [
        ("A", "2026-01-01", 1), ("B", "2026-01-02", 1)]
    assert {r[:2] for r in rows(files.first_key(found), "key", "value")} == {("dt", "2026-01-01"), ("dt", "2026-01-02")}


def test_bound_partition_is_pruned(spark, tmp_path):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    tables.write_table(df, str(tmp_path / "t"), ["k"])
    bound = files.bind(spark.read.parquet(str(tmp_path / "t")), k=1)
    assert bound.count() == 5
    plan = bound._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan


def lake_with_orders(tmp_path):
    return Lake(str(tmp_path / "lake"), sources={"orders": Source("orders", "Shop", "csv", "orders", ("dt",))}, references={})


def test_load_takes_each_file_once_and_late_files_too(spark, tmp_path):
    lake = lake_with_orders(tmp_path)
    assert bronze.load_new(spark, lake, "orders") == 0 and bronze.read_bronze(spark, lake, "orders") is None
    put(lake.landing("orders"), "dt=1/a.csv", "id,v\n1,x\n")
    assert bronze.load_new(spark, lake, "orders") == 1
    put(lake.landing("orders"), "dt=1/late.csv", "id,w\n2,y\n")
    assert bronze.load_new(spark, lake, "orders") == 1
    assert bronze.load_new(spark, lake, "orders") == 0
    df = bronze.read_bronze(spark, lake, "orders")
    assert [tuple(map(str, r)) for r in rows(df, "id", "v", "w", "dt", "_source_system")] == [
        ("1", "x", "None", "1", "Shop"), ("2", "None", "y", "1", "Shop")]
    assert df.select("_ingest_ts").distinct().count() == 2


def test_a_load_takes_all_files_however_small_its_batches(spark, tmp_path):
    lake = lake_with_orders(tmp_path)
    for i in range(5):
        put(lake.landing("orders"), f"dt={i}/a.csv", f"id,v\n{i},x\n")
    assert bronze.load_new(spark, lake, "orders", files_per_batch=2) == 5
    assert len(rows(bronze.read_bronze(spark, lake, "orders"), "id")) == 5


def test_a_load_that_dies_before_its_commit_leaves_no_trace(spark, tmp_path, monkeypatch):
    lake = lake_with_orders(tmp_path)
    put(lake.landing("orders"), "dt=1/a.csv", "id,v\n1,x\n")
    bronze.load_new(spark, lake, "orders")
    put(lake.landing("orders"), "dt=2/b.csv", "id,v\n2,y\n")

    def die(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(bronze, "record", die)
        with pytest.raises(RuntimeError):
            bronze.load_new(spark, lake, "orders")
    assert rows(bronze.read_bronze(spark, lake, "orders"), "id") == [("1",)]
    assert bronze.load_new(spark, lake, "orders") == 1
    assert rows(bronze.read_bronze(spark, lake, "orders"), "id") == [("1",), ("2",)]


def test_missing_reference_fails_before_anything_is_written(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    put(lake.at("landing", "reference"), "cities.csv", "city_id\nA\n")
    with pytest.raises(FileNotFoundError, match="operators, plans, zones"):
        bronze.load_references(spark, lake)
    assert not Path(lake.at("bronze")).exists()


def test_stream_load_is_incremental(spark, tmp_path):
    lake = lake_with_orders(tmp_path)
    source = lake.sources["orders"]
    put(lake.landing("orders"), "dt=1/a.csv", "id,v\n1,x\n")
    ingest_available(spark, lake, source, ["id", "v"])
    put(lake.landing("orders"), "dt=1/b.csv", "id,v\n2,y\n")
    for _ in range(2):
        ingest_available(spark, lake, source, ["id", "v"])
    df = spark.read.parquet(lake.bronze("orders"))
    assert rows(df, "id", "v", "_source_system") == [("1", "x", "Shop"), ("2", "y", "Shop")]


def test_only_written_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, k string")
    tables.write_table(df, path, ["k"])
    tables.write_table(df.where("k = 'b'").withColumn("v", F.lit(9)), path, ["k"])
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 1), ("b", 9), (None, 3)]


def test_rejects_are_added(spark, tmp_path):
    path = str(tmp_path / "q")
    for day in ("2026-04-02", "2026-04-02", "2026-04-03"):
        tables.append_rejects(spark.createDataFrame([(1, day)], "v int, reject_date string"), path)
    assert spark.read.parquet(path).count() == 3


def test_a_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 200_000, numPartitions=8).withColumn("k", F.lit("one")).withColumn("v", F.sha2(F.col("id").cast("string"), 256))
        tables.write_table(df, path, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(Path(path, "k=one").glob("*.parquet"))) > 1
    assert spark.read.parquet(path).count() == 200_000


def test_scratch_lies_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert scratch_path(spark, "x").startswith(f"{shared.rstrip('/')}/x-")
    for rows_now in (3, 2):
        assert tables.staged(spark.range(rows_now), "x").count() == rows_now


def test_a_cluster_without_a_shared_folder_is_refused():
    class Session:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session, "x")
    Session.sparkContext.master = "local[2]"
    assert scratch_path(Session, "x") != scratch_path(Session, "x")


def test_attributes_of_an_earlier_repeated_child_stay(spark, tmp_path):
    put(tmp_path, "a.xml", '<all><e><part n="1">a</part><part>b</part></e><e><part>c</part><part n="2" m="x">d</part></e></all>')
    df = readers.read_xml(spark, str(tmp_path), "e")
    assert rows(df, "part", "part_n", "part_m") == [("b", "1", None), ("d", "2", "x")]


def test_folder_keys_above_the_base_are_not_taken(spark, tmp_path):
    base = tmp_path / "dt=2020-01-01" / "env=prod" / "landing"
    put(base, "dt=2026-01-01/a.txt", "x")
    found = files.list_files(spark, str(base))
    assert rows(files.first_key(found, str(base)), "key", "value") == [("dt", "2026-01-01")]
    assert [r.dt for r in files.with_path_keys(found, ["dt"]).collect()] == ["2026-01-01"]


def test_declared_lines_in_one_pass(spark, tmp_path):
    put(tmp_path, "a.json", '{"id":1,"v":1.50,"o":{"a":true,"b":{"c":2,"d":null}},"l":["x"],"new":{"q":1}}\n\n{"id":2,"o":7}\n{"id":\n[1]\n{"id":3,"x":1,"x":2}\n')
    df = readers.declared_ndjson(spark, str(tmp_path), ("id", "v", "o.a", "o.b.c", "l"))
    got = {r.id or r._corrupt_record: r for r in df.collect()}
    assert df.columns == ["id", "v", "o_a", "o_b_c", "l", "_rescued", "_source_file", "_corrupt_record"]
    assert tuple(got["1"])[:6] == ("1", "1.5", "true", "2", '["x"]', '{"new":"{\\"q\\":1}","o_b_d":null}')
    assert got["2"]._rescued == '{"o":"7"}' and got["3"]._rescued == '{"x":"2"}'
    assert set(got) == {"1", "2", "3", '{"id":', "[1]"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("envelope", [False, True])
def test_declared_documents_in_one_pass(spark, tmp_path, envelope):
    docs = [
        {"source": "outer", "period": "p", "days": [{"d": 1, "source": "inner", "x": {"y": 2}}, {"d": 2, "n": 5}]},
        {"days": []}, {"days": [1, 2]}, {"days": {"a": 1}}, {"e": 1}, {"days": [None, {"d": 3}]},
    ]
    for i, doc in enumerate(docs):
        put(tmp_path, f"{i}.json", json.dumps(doc, indent=1))
    put(tmp_path, "cut.json", '{"days": [{"d": 9, ')
    df = readers.declared_documents(spark, str(tmp_path), "days", ("d", "source", "period", "x.y"), envelope)
    good = rows(df.where("_corrupt_record IS NULL"), "d", "source", "period", "x_y", "_rescued")
    outer = ("outer", "p") if envelope else (None, None)
    assert good == [("1", "inner", outer[1], "2", None), ("2", *outer, None, '{"n":"5"}')]
    unread = sorted(r._source_file.split("/")[-1] for r in df.where("_corrupt_record IS NOT NULL").collect())
    assert unread == ["2.json", "3.json", "4.json", "5.json", "cut.json"]
    assert df.where("_corrupt_record IS NOT NULL AND d IS NOT NULL").count() == 0


def test_declared_xml_in_one_pass(spark, tmp_path):
    put(tmp_path, "m.xml", """<?xml version="1.0"?><events>
      <event id="007"><cost currency="EUR">12.50</cost><part n="1">a</part><part>b</part><who/><odd a="1">x</odd></event>
      <event id="8"><cost>3</cost></event></events>""")
    df = readers.declared_xml(spark, str(tmp_path), "event", ("@id", "cost", "cost.@currency", "part", "part.@n", "who"))
    assert rows(df, "id", "cost", "cost_currency", "part", "part_n", "who") == [
        ("007", "12.50", "EUR", "b", "1", None), ("8", "3", None, None, None, None)]
    assert [r[0] is not None and "x" in r[0] for r in rows(df.orderBy("id"), "_rescued")].count(True) == 1
