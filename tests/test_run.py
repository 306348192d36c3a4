import json

import pytest

from quarrylake.plans import refresh, run
from quarrylake.spec import Lake
from test_files import put, rows

CITIES = """city_id,city_name,country,timezone,currency,centre_lat,centre_lon,population_k,launched_on
C-M,Madrid,esp,Europe/Madrid,EUR,40.4,-3.7,2879,2025-02-12
C-G,Goteborg,SWE,Europe/Stockholm,SEK,57.7,11.9,600,2025-02-12
C-X,Nowhere,Atlantis,Europe/Madrid,EUR,1,1,1,2025-02-12
"""
RIDES = """ride_id,operator_id,vehicle_id,rider_id,start_ts,end_ts,distance_m,duration_s,unlock_channel,end_reason,fare_amount,currency,is_test,updated_at,start_lat,start_lon,end_lat,end_lon
R1,OP-1,V1,RD1,2026-04-10 10:00:00,2026-04-10 10:10:00,100,600,app_qr,user_ended,10.0,SEK,false,2026-04-10T23:00:00Z,1,2,3,4
R1,OP-1,V1,RD1,2026-04-10 10:00:00,2026-04-10 10:10:00,0.35km,,app_qr,user_ended,20.0,SEK,false,2026-04-11T23:00:00Z,1,2,3,4
R2,OP-1,V1,RD1,2026-04-10T10:00:00+02:00,,-50,,app_nfc,user_ended,5,EUR,true,2026-04-10T23:00:00Z,1,2,3,4
R3,OP-1,V1,RD1,,,1,1,app_qr,user_ended,5,EUR,false,2026-04-10T23:00:00Z,1,2,3,4
R4,OP-1,V1,RD1,10/04/2026 12:00,2026-04-10T08:00:00Z,1,1,app_qr,user_ended,5,EUR,false,2026-04-10T23:00:00Z,1,2,3,4
"""


def land(lake):
    put(lake.at("landing", "reference"), "cities.csv", CITIES)
    put(lake.at("landing", "reference"), "operators.csv",
        "operator_id,operator_name,revenue_share_pct,active_from\nOP-1,One,62.55,2024-05-15\n")
    put(lake.at("landing", "reference"), "plans.csv",
        "plan_id,version,unlock_fee_eur,per_minute_eur,monthly_fee_eur,valid_from,valid_to\nP,1,1.0,0.24,0.0,2023-03-01,2026-05-31\nP,2,1.0,0.28,0.0,2026-06-01,\n")
    put(lake.at("landing", "reference"), "zones.csv",
        "zone_id,centroid_lat,centroid_lon,is_current,area_km2,parking_capacity,valid_from,valid_to\nZ,1.5,2.5,true,3.254,10,2026-01-01,\n")
    put(lake.landing("rides"), "dt=2026-04-10/rides_C-G_2026-04-10.csv", RIDES)
    put(lake.landing("payments"), "dt=2026-04-10/p.json", json.dumps({"records": [
        {"payment_id": "P1", "external_ref": "R1", "amount_minor": 1234, "currency": "SEK", "type": "charge",
         "status": "captured", "captured_at": "2026-04-10T10:00:00Z", "method": "card", "customer_country": "SE"},
        {"payment_id": "P1", "external_ref": "R1", "amount_minor": 1234, "currency": "SEK", "type": "charge",
         "status": "captured", "captured_at": "2026-04-10T10:00:00Z", "method": "card", "customer_country": "SE"},
        {"payment_id": "P2", "external_ref": "R3", "amount_minor": 5, "currency": "EUR", "type": None,
         "status": None, "captured_at": "bad", "method": None, "customer_country": "SE"}]}))
    for day, firmware in (("2026-04-09", "1"), ("2026-04-10", "1"), ("2026-04-11", "2")):
        put(lake.landing("vehicles"), f"snapshot_date={day}/v.json", json.dumps({"vehicles": [
            {"vehicle_id": "V1", "operator_id": "OP-1", "battery_wh": 500, "top_speed_kph": 25.0, "odometer_km": 1.5,
             "purchase_date": "2025-01-01", "firmware_version": firmware, "home_city_id": "C-M", "qr_code": "q",
             "model": None, "vehicle_type": "s", "manufacturer": "f", "status": "ok"},
            {"vehicle_id": "V2", "operator_id": "OP-9", "battery_wh": 500, "top_speed_kph": 25.0, "odometer_km": 1.5,
             "purchase_date": "2025-01-01", "firmware_version": "1", "home_city_id": "C-M", "qr_code": "q",
             "model": None, "vehicle_type": "s", "manufacturer": "f", "status": "ok"}]}))
    event = {"event_id": "e1", "vehicle_id": "V1", "ts": "2026-07-25 00:12:11", "lat": 0, "lon": 0.0, "speed_kph": 1.5,
             "battery": 50.3, "is_locked": False}
    put(lake.landing("telemetry"), "city=C-M/dt=2026-07-25/hour=00/a.json",
        json.dumps(event) + "\n" + json.dumps(event) + "\n"
        + json.dumps({**event, "event_id": "e2", "vehicle_id": "V2", "battery": 0.5, "ts": "1784936157000", "lat": 1}))
    put(lake.landing("telemetry"), "city=C-M/dt=2026-07-28/hour=00/b.json",
        json.dumps({**event, "event_id": "e3", "firmware_version": "9"}))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    land(lake)
    return lake, run.run(spark, lake)


def test_what_was_built(lake):
    _, done = lake
    assert done["files"] == {"maintenance": 0, "payments": 1, "riders_cdc": 0, "rides": 1, "telemetry": 2,
                             "vehicles": 3, "weather": 0}
    assert "riders_cdc" not in done["tables"] and "telemetry" in done["tables"]
    assert "dim_ride_context" in done["dimensions"]


def test_rides(spark, lake):
    lake, _ = lake
    rides = spark.read.parquet(lake.silver("rides"))
    assert rows(rides, "ride_id", "distance_m", "duration_s", "open_ride", "fare_amount_euros", "city_id") == [
        ("R1", 350.0, 600.0, False, 20.0 * 0.088, "C-G"), ("R2", 50.0, None, True, 5.0, "C-G")]
    assert [str(r[0]) for r in rows(rides.where("ride_id = 'R1'"), "start_ts")] == ["2026-04-10 08:00:00"]
    rejected = spark.read.parquet(lake.quarantine("rides"))
    assert rows(rejected, "ride_id", "_reject_reason", "_table") == [
        ("R3", "Missing Start_ts and End_ts", "rides"), ("R4", "Impossible End and Start Timestamps", "rides")]
    assert [str(t) for t in rides.schema["ride_date"].dataType.typeName().split()] == ["date"]


def test_payments_and_their_orphans(spark, lake):
    lake, _ = lake
    kept = spark.read.parquet(lake.silver("payments"))
    assert [tuple(map(str, r)) for r in rows(kept, "payment_id", "amount", "amount_euros", "is_charge", "payment_date")] == [
        ("P1", "12.34", "1.09", "True", "2026-04-10")]
    assert "customer_country" not in kept.columns
    assert rows(spark.read.parquet(lake.quarantine("payments")), "payment_id", "_reject_reason") == [("P2", "Invalid ride_id")]


def test_telemetry(spark, lake):
    lake, _ = lake
    df = spark.read.parquet(lake.silver("telemetry"))
    got = [tuple(map(str, r)) for r in rows(df, "event_id", "ts", "battery", "lat", "is_registered_vehicle", "firmware_version")]
    assert got == [("e1", "2026-07-24 22:12:11", "0.5030", "None", "True", "None"),
                   ("e2", "2026-07-24 23:35:57", "0.5000", "1.0", "False", "None"),
                   ("e3", "2026-07-24 22:12:11", "0.5030", "None", "True", "9")]


def test_references_and_their_rejects(spark, lake):
    lake, _ = lake
    assert rows(spark.read.parquet(lake.gold("dim_cities")), "city_id", "country") == [
        ("C-G", "SE"), ("C-M", "ES"), (None, None)]
    assert rows(spark.read.parquet(lake.quarantine("cities")), "city_id", "_reject_reason") == [("C-X", "Unknown country")]
    plans = spark.read.parquet(lake.gold("dim_plans"))
    assert plans.select("plans_sk").distinct().count() == 3
    assert dict(plans.dtypes)["unlock_fee_eur"] == "decimal(10,2)"


def test_vehicle_history(spark, lake):
    lake, _ = lake
    dim = spark.read.parquet(lake.gold("dim_vehicles"))
    got = [tuple(map(str, r)) for r in rows(dim, "vehicle_id", "firmware_version", "valid_from_ts", "valid_to_ts", "is_current")]
    assert got == [("V1", "1", "2026-04-09 00:00:00", "2026-04-11 00:00:00", "False"),
                   ("V1", "2", "2026-04-11 00:00:00", "9999-12-31 00:00:00", "True"),
                   ("None", "None", "None", "None", "None")]
    assert dim.columns[0] == "vehicle_sk"


def test_a_second_run_finds_nothing_new_and_changes_nothing(spark, lake):
    lake, _ = lake
    before = spark.read.parquet(lake.silver("telemetry")).count()
    assert set(run.run_bronze(spark, lake).values()) == {0}
    assert "telemetry" in run.run_silver(spark, lake)
    assert spark.read.parquet(lake.silver("telemetry")).count() == before


def test_a_second_delivery_replaces_what_it_corrects(spark, tmp_path):
    """A ride moves to another day, a reject stays one reject, a deleted rider is blank everywhere."""
    lake = Lake(str(tmp_path))
    land(lake)
    riders = "op,op_ts,rider_id,operator_id,first_name,email,country,account_status,marketing_consent,plan_id,home_city_id\n"
    put(lake.landing("riders_cdc"), "dt=2026-04-10/a.csv",
        riders + "I,2026-04-10T08:00:00Z,RD1,OP-9,Anna,anna@x.org,ESP,active,true,P,C-M\nI,2026-04-10T08:00:00Z,RD2,OP-1,Berta,berta@x.org,ESP,active,true,P,C-M\n")
    run.run(spark, lake)
    first = sorted(map(str, spark.read.parquet(lake.quarantine("rides")).collect()))
    run.run(spark, lake)
    assert sorted(map(str, spark.read.parquet(lake.quarantine("rides")).collect())) == first
    assert "Anna" in {r.first_name for r in spark.read.parquet(lake.quarantine("riders_cdc")).collect()}
    moved = RIDES.splitlines()[0] + "\n" + RIDES.splitlines()[2].replace("2026-04-10 10", "2026-04-12 10").replace("2026-04-11T23", "2026-04-13T23") + "\n"
    put(lake.landing("rides"), "dt=2026-04-12/rides_C-G_2026-04-12.csv", moved)
    put(lake.landing("riders_cdc"), "dt=2026-04-11/a.csv",
        riders + "D,2026-04-11T08:00:00Z,RD1,OP-9,Anna,anna@x.org,ESP,active,true,P,C-M\nD,2026-04-11T08:00:00Z,RD2,OP-1,Berta,berta@x.org,ESP,active,true,P,C-M\n")
    run.run(spark, lake)
    rides = spark.read.parquet(lake.silver("rides"))
    assert rides.count() == rides.select("ride_id").distinct().count()
    assert [str(r.ride_date) for r in rides.where("ride_id = 'R1'").collect()] == ["2026-04-12"]
    assert len(spark.read.parquet(lake.quarantine("rides")).collect()) == len(first)
    for path in (lake.silver("riders_cdc"), lake.quarantine("riders_cdc"), lake.gold("dim_riders")):
        text = str(spark.read.parquet(path).collect())
        assert "Anna" not in text and "anna@" not in text and "Berta" not in text and "berta@" not in text


def test_nothing_unreadable_is_lost(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake)
    put(lake.landing("telemetry"), "city=C-M/dt=2026-07-26/hour=00/bad.json", '{"event_id": "e9", "vehicle_id": "V1", "ts": "1784936157000"}\n{"event_id": \nnot json\n')
    put(lake.landing("payments"), "dt=2026-04-11/truncated.json", '{"records": [{"payment_id": "P7", ')
    put(lake.landing("payments"), "dt=2026-04-12/empty.json", '{"records": []}')
    files = run.run(spark, lake)["files"]
    assert files["payments"] == 3 and files["telemetry"] == 3
    lost = spark.read.parquet(lake.quarantine("telemetry")).where("_reject_reason = 'Missing key'")
    assert lost.count() == 2 and lost.where("_source_file LIKE '%bad.json'").count() == 2
    lost = spark.read.parquet(lake.quarantine("payments")).where("_reject_reason = 'Missing key'")
    assert [r._source_file.split("/")[-1] for r in lost.collect()] == ["truncated.json"]
    assert run.run_bronze(spark, lake)["payments"] == 0


def test_a_source_of_empty_documents_only_loads_no_rows(spark, tmp_path):
    lake = Lake(str(tmp_path))
    put(lake.landing("payments"), "dt=2026-04-12/empty.json", '{"records": []}')
    from quarrylake.plans import bronze

    assert bronze.load_new(spark, lake, "payments") == 1
    assert bronze.load_new(spark, lake, "payments") == 0


def folder_times(path):
    from pathlib import Path

    return {f.name: max(p.stat().st_mtime_ns for p in f.iterdir()) for f in Path(path).iterdir() if f.is_dir()}


def whole(spark, path, *leave):
    df = spark.read.parquet(path)
    return sorted(map(str, df.select(*[c for c in sorted(df.columns) if c not in leave]).collect()))


def test_a_load_rewrites_its_own_folders_and_equals_a_full_rebuild(spark, tmp_path):
    """Rides move, come and go; payments gain and lose their ride; an event's vehicle is registered later."""
    lake = Lake(str(tmp_path))
    land(lake)
    header, body = RIDES.splitlines()[0], RIDES.splitlines()[2]
    other = lambda n, day: body.replace("R1,", f"{n},").replace("2026-04-10", day).replace("2026-04-11T23", "2026-04-12T23")
    put(lake.landing("rides"), "dt=2026-04-08/rides_C-M_2026-04-08.csv", "\n".join([header, other("R7", "2026-04-08"), other("R8", "2026-04-07")]) + "\n")
    pay = {"currency": "EUR", "type": "charge", "status": "captured", "method": "card", "amount_minor": 5}
    put(lake.landing("payments"), "dt=2026-04-11/q.json", json.dumps({"records": [
        {**pay, "payment_id": "P7", "external_ref": "R7", "captured_at": "2026-04-08T10:00:00Z"},
        {**pay, "payment_id": "P9", "external_ref": "R9", "captured_at": "2026-04-09T10:00:00Z"}]}))
    run.run(spark, lake)
    before = {t: folder_times(lake.silver(t)) for t in ("rides", "payments", "telemetry")}
    dims = folder_times(lake.at("gold"))
    assert run.run(spark, lake)["tables"] and before == {t: folder_times(lake.silver(t)) for t in before}
    assert folder_times(lake.at("gold")) == dims

    late = other("R9", "2026-04-09")
    gone = other("R7", "2026-04-08").replace("2026-04-12T23", "2026-04-14T23").replace(",2026-04-08 10:00:00,2026-04-08 10:10:00,", ",,,")
    moved = other("R8", "2026-04-06").replace("2026-04-12T23", "2026-04-14T23")
    put(lake.landing("rides"), "dt=2026-04-14/rides_C-M_2026-04-14.csv", "\n".join([header, late, gone, moved]) + "\n")
    put(lake.landing("vehicles"), "snapshot_date=2026-04-12/v.json", json.dumps({"vehicles": [
        {"vehicle_id": "V2", "operator_id": "OP-1", "battery_wh": 500}]}))
    run.run(spark, lake)
    rides = spark.read.parquet(lake.silver("rides"))
    assert rows(rides, "ride_id", "ride_date") == rows(rides.selectExpr("ride_id", "CAST(start_ts AS DATE) AS ride_date"), "ride_id", "ride_date")
    assert [r[0] for r in rows(rides, "ride_id")] == ["R1", "R2", "R8", "R9"]
    assert rows(spark.read.parquet(lake.silver("payments")), "payment_id") == [("P1",), ("P9",)]
    assert rows(spark.read.parquet(lake.quarantine("payments")), "payment_id") == [("P2",), ("P7",)]
    assert rows(spark.read.parquet(lake.silver("telemetry")), "event_id", "is_registered_vehicle") == [("e1", True), ("e2", True), ("e3", True)]
    after = {t: folder_times(lake.silver(t)) for t in before}
    assert {d for d, at in folder_times(lake.at("gold")).items() if at != dims[d]} == {"dim_vehicles", "dim_payment_method", "dim_ride_context"}
    changed = {t: {f for f in after[t] if after[t][f] != before[t].get(f)} for t in before}
    assert changed == {
        "rides": {"ride_date=2026-04-06", "ride_date=2026-04-07", "ride_date=2026-04-08", "ride_date=2026-04-09"},
        "payments": {"payment_date=2026-04-08", "payment_date=2026-04-09"},
        "telemetry": {"event_date=2026-07-24"},
    }
    places = [lake.silver(t) for t in run.CLEANERS if t in ("rides", "payments", "telemetry", "vehicles", "cities")]
    places += [lake.quarantine(t) for t in ("rides", "payments")]
    refreshed = [whole(spark, p) for p in places]
    run.run_silver(spark, lake, whole=True)
    assert refreshed == [whole(spark, p) for p in places]


def test_first_rejection_survives_new_columns(spark, tmp_path):
    lake = Lake(str(tmp_path))
    land(lake)
    run.run(spark, lake)
    first = {r.ride_id: r._reject_ts for r in spark.read.parquet(lake.quarantine("rides")).collect()}
    header, bad = RIDES.splitlines()[0], RIDES.splitlines()[4]
    put(lake.landing("rides"), "dt=2026-04-15/rides_C-G_2026-04-15.csv", f"{header},weather\n{bad.replace('R3', 'R5')},rain\n")
    run.run(spark, lake)
    got = spark.read.parquet(lake.quarantine("rides"))
    assert "weather" in got.columns and "weather" in spark.read.parquet(lake.silver("rides")).columns
    again = {r.ride_id: r._reject_ts for r in got.collect()}
    assert set(again) == {"R3", "R4", "R5"} and {k: again[k] for k in first} == first and again["R5"] > max(first.values())


def test_references_are_loaded_when_they_change(spark, tmp_path):
    import os
    from pathlib import Path

    from quarrylake.plans import bronze

    lake = Lake(str(tmp_path))
    land(lake)
    assert bronze.load_references(spark, lake) == ["cities", "operators", "plans", "zones"]
    assert bronze.load_references(spark, lake) == []
    plans = Path(lake.landing("plans"))
    os.utime(plans, (plans.stat().st_mtime + 60,) * 2)
    assert bronze.load_references(spark, lake) == []
    plans.write_text(plans.read_text().replace("P,2", "P,3"))
    os.utime(plans, (plans.stat().st_mtime + 120,) * 2)
    assert bronze.load_references(spark, lake) == ["plans"]
    assert rows(bronze.read_bronze(spark, lake, "plans"), "plan_id", "version") == [("P", "1"), ("P", "3")]


def test_stream_and_batch_share_one_bronze(spark, tmp_path):
    from quarrylake.plans import bronze
    from quarrylake.streaming.ingest import ingest_available

    lake = Lake(str(tmp_path))
    land(lake)
    vehicles = lake.sources["vehicles"]
    assert ingest_available(spark, lake, vehicles, files_per_batch=2) == 3
    assert bronze.load_new(spark, lake, "vehicles") == 0
    put(lake.landing("vehicles"), "snapshot_date=2026-04-13/v.json", json.dumps({"vehicles": [{"vehicle_id": "V3", "colour": "red"}]}))
    assert bronze.load_new(spark, lake, "vehicles") == 1
    put(lake.landing("vehicles"), "snapshot_date=2026-04-14/v.json", json.dumps({"vehicles": []}))
    assert ingest_available(spark, lake, vehicles) == 1
    assert bronze.load_new(spark, lake, "vehicles") == 0 and ingest_available(spark, lake, vehicles) == 0
    got = bronze.read_bronze(spark, lake, "vehicles")
    assert [r[0] for r in rows(got, "vehicle_id")] == ["V1"] * 3 + ["V2"] * 3 + ["V3"]
    assert rows(got.where("vehicle_id = 'V3'"), "_rescued") == [('{"colour":"red"}',)]
    # a checkpoint that is lost hands over every file again, and none is loaded twice
    fresh = Lake(str(tmp_path), {**lake.sources})
    object.__setattr__(fresh, "at", lambda layer, *names: Lake.at(fresh, f"{layer}-new" if layer == "_checkpoints" else layer, *names))
    assert ingest_available(spark, fresh, vehicles) == 0
    assert bronze.read_bronze(spark, lake, "vehicles").count() == 7


def test_every_row_is_staged_once_per_table_and_columns_cost_no_rows(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    land(lake)
    owners, sizes, plans = [], [], []
    stage, (clean, needs) = refresh.staged, run.CLEANERS["rides"]

    def noted(df, owner):
        owners.append(owner.removeprefix(lake.root))
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, owner)

    def counted(raw, *parents):
        sizes.append(raw.count())
        return clean(raw, *parents)

    monkeypatch.setattr(refresh, "staged", noted)
    monkeypatch.setitem(run.CLEANERS, "rides", (counted, needs))
    run.run(spark, lake)
    of_rides = [(o, p) for o, p in zip(owners, plans, strict=True) if o.endswith("/rides")]
    assert [o for o, _ in of_rides] == ["/silver/rides", "/_first_seen/rides"]
    assert "Join" not in of_rides[1][1]  # nothing was seen before
    header, other = RIDES.splitlines()[0], RIDES.splitlines()[1].replace("R1,", "R6,")
    put(lake.landing("rides"), "dt=2026-04-16/rides_C-G_2026-04-16.csv", f"{header}\n{other}\n")
    owners.clear()
    run.run_bronze(spark, lake)
    run.run_silver(spark, lake)
    assert not any(o.endswith("_quarantine/rides-fresh") for o in owners)
    assert sizes == [5, 0, 1]
