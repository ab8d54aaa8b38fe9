"""Loads that lose and double nothing: manifest, payload registry, chunk
coverage, payload order, reject store."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from raceline import schemas
from raceline.plans import loaders
from raceline.sources import landing, ledger, manifest, payloads, rejects
from raceline.sources.raw import read_raw_tables
from tests.conftest import frame, ts

PIT = schemas.RAW["pit"]


def pit_rows(spark, laps, session=1):
    return frame(spark, "pit", [{"session_key": session, "driver_number": 4, "lap_number": n, "pit_duration": 20.0 + n, "date": ts("2024-03-01 10:00:00")} for n in laps])


def cut_off(df, path, load_id="cut-off"):
    """What a load leaves that died in the middle of its commit."""
    df.write.parquet(f"{path}/load_id={load_id}")


def test_cut_off_load_is_loaded_again(spark, tmp_path):
    root = str(tmp_path)
    path = f"{root}/pit"
    cut_off(pit_rows(spark, range(3)), path)
    assert read_raw_tables(spark, root)["pit"].count() == 0
    new = loaders.load_pit(pit_rows(spark, range(10)), read_raw_tables(spark, root)["pit"])
    assert loaders.run_load(new, path) == 10
    assert read_raw_tables(spark, root)["pit"].count() == 10
    assert loaders.load_pit(pit_rows(spark, range(10)), read_raw_tables(spark, root)["pit"]).count() == 0


def test_models_see_published_rows_only(spark, tmp_path):
    root = str(tmp_path)
    loaders.run_load(pit_rows(spark, range(10)), f"{root}/pit")
    cut_off(pit_rows(spark, range(3), session=2), f"{root}/pit")
    assert read_raw_tables(spark, root)["pit"].count() == 10


def test_empty_load_and_plain_table(spark, tmp_path):
    root = str(tmp_path)
    assert loaders.run_load(pit_rows(spark, []), f"{root}/pit") == 0
    assert read_raw_tables(spark, root)["pit"].count() == 0
    pit_rows(spark, range(4)).write.parquet(f"{root}/old/pit")  # a table of files, without loads
    assert read_raw_tables(spark, f"{root}/old")["pit"].count() == 4
    loaders.run_load(pit_rows(spark, range(2), session=2), f"{root}/old/pit")
    assert read_raw_tables(spark, f"{root}/old")["pit"].count() == 6


def test_compaction_keeps_rows_and_bounds_folders(spark, tmp_path):
    path = str(tmp_path / "pit")
    for session in range(5):
        loaders.run_load(pit_rows(spark, range(3), session), path)
    before = sorted(map(tuple, manifest.read_published(spark, path, PIT).collect()))
    assert manifest.compact(spark, path, PIT, ["session_key"])
    assert len(manifest.published_loads(spark, path)) == 1
    assert sorted(map(tuple, manifest.read_published(spark, path, PIT).collect())) == before
    assert len(manifest.vacuum(spark, path)) == 5
    assert sorted(map(tuple, manifest.read_published(spark, path, PIT).collect())) == before
    loaders.run_load(pit_rows(spark, range(3), 9), path)
    assert manifest.read_published(spark, path, PIT).count() == 18


def test_skip_opens_only_loads_that_may_hold_a_key(spark, tmp_path):
    path = str(tmp_path / "pit")
    for session in range(6):
        loaders.run_load(pit_rows(spark, range(5), session), path)
    landed = pit_rows(spark, range(8), 2).unionByName(pit_rows(spark, range(8), 77))
    target = loaders.target_for(landed, path)
    whole = manifest.read_published(spark, path, PIT)
    assert len(whole.inputFiles()) >= 6
    assert len(target.inputFiles()) <= len(whole.inputFiles()) // 3  # session 2's load, rarely one more
    new = [sorted(map(tuple, loaders.load_pit(landed, t).collect())) for t in (target, whole)]
    assert new[0] == new[1] and len(new[0]) == 8
    # A load without a sketch is always opened; a landing without the key opens all.
    manifest.publish_load(pit_rows(spark, range(4), 77), path, "plain")
    assert loaders.load_pit(landed, loaders.target_for(landed, path)).count() == 0
    assert loaders.target_for(landed.drop("session_key"), path).count() == 34
    # Compaction makes the sketch anew where all loads have one.
    manifest.compact(spark, path, PIT)
    assert len(manifest.vacuum(spark, path)) == 7
    assert loaders.load_pit(landed, loaders.target_for(landed, path)).count() == 0


def test_sketch_denies_no_key(spark, tmp_path):
    """NULL keys, other types and an empty load; loads that hold nothing asked for are few."""
    radio = [{"session_key": s, "driver_number": n, "recording_url": u} for s in range(40) for n in (1, None) for u in ("a", None)]
    path = str(tmp_path / "team_radio")
    for part in range(4):
        loaders.run_load(frame(spark, "team_radio", [r for r in radio if r["session_key"] % 4 == part]), path)
    loaders.run_load(frame(spark, "team_radio", []), path)
    asked = frame(spark, "team_radio", radio).withColumn("session_key", F.col("session_key").cast("string"))
    assert loaders.target_for(asked, path).count() == len(radio)
    assert loaders.load_team_radio(frame(spark, "team_radio", radio), loaders.target_for(asked, path)).count() == 0
    for r in radio[:6]:
        one = frame(spark, "team_radio", [r])
        assert loaders.load_team_radio(one, loaders.target_for(one, path)).count() == 0
    strange = frame(spark, "team_radio", [{"session_key": s, "driver_number": 9, "recording_url": "z"} for s in range(1000, 1010)])
    assert loaders.target_for(strange, path).count() < len(radio)


def land(folder, key, text):
    where = folder.joinpath(*(f"{k}={v}" for k, v in key.items()))
    where.mkdir(parents=True)
    (where / "payload.json").write_text(text)


LOCATION = ("session_key", "driver_number")


def location_payload(n):
    return json.dumps([{"date": f"2024-03-01T10:00:{i:02}Z", "x": i, "y": 0, "z": 0} for i in range(n)])


def test_registry_tells_payloads_apart(spark, tmp_path):
    answers = {1: location_payload(3), 2: "[]", 3: '{"detail": "none"}', 4: '[{"date": "2024-03-01T10:00:00Z", "x": 1}]', 5: '[{"x": 1', 6: '[{"x": "far"}]'}
    for car, text in answers.items():
        land(tmp_path, {"session_key": 1, "driver_number": car}, text)
    rows, registry = payloads.read_registered(spark, str(tmp_path), schemas.RAW["location"], LOCATION, schemas.columns("location"), multi_line=True)
    got = {r.driver_number: (r.status, r.n_rows, r.n_rejected) for r in registry.collect()}
    # the key columns come from the path and count as there only where the objects have them
    assert {k: v[0] for k, v in got.items()} == {1: "lacking", 2: "empty", 3: "error", 4: "lacking", 5: "rejected", 6: "rejected"}
    assert got[1][1:] == (3, 0) and got[5][1:] == (0, 1)
    rows, registry = payloads.read_registered(spark, str(tmp_path), schemas.RAW["location"], LOCATION, ("date", "x", "y", "z"), multi_line=True)
    assert {r.driver_number for r in registry.where("status = 'rows'").collect()} == {1}
    assert {r.driver_number for r in payloads.failed(registry, LOCATION).collect()} == {5, 6}
    assert {(r.session_key, r.driver_number) for r in landing.drop_error_envelopes(rows).collect()} == {(1, 1), (1, 4)}


def test_pair_without_payload_stays_open(spark, tmp_path):
    sessions = frame(spark, "sessions", [{"session_key": 1, "session_type": "Race"}])
    drivers = frame(spark, "drivers", [{"session_key": 1, "driver_number": n} for n in (1, 2, 3)])
    table, led, landed = str(tmp_path / "location"), str(tmp_path / "ledger"), tmp_path / "landing"
    land(landed, {"session_key": 1, "driver_number": 1}, location_payload(2))
    land(landed, {"session_key": 1, "driver_number": 3}, "[]")

    def run():
        rows, registry = payloads.read_registered(spark, str(landed), schemas.RAW["location"], LOCATION, multi_line=True)
        rows = rows.withColumn("_fields", F.concat("_fields", F.array(*map(F.lit, LOCATION))))  # the request key stands in the path
        return loaders.run_location_backfill(spark, rows, sessions, drivers, table, led, registry=registry)

    assert run() == 2
    done = {r.driver_number for r in ledger.read_ledger(spark, led).collect()}
    assert done == {1, 3}  # the empty answer closes its pair, the missing one doesn't
    land(landed, {"session_key": 1, "driver_number": 2}, location_payload(7))
    assert run() == 1
    got = manifest.read_published(spark, table, schemas.RAW["location"])
    assert got.where("driver_number = 2").count() == 7 and got.count() == 9
    assert run() == 0


def car_rows(spark, hours, car=1):
    return frame(spark, "car_data", [{"session_key": 1, "driver_number": car, "date": ts(f"2024-03-01 {h}:{m}:00"), "speed": 100 + m} for h in hours for m in (10, 40)])


@pytest.fixture
def race(spark):
    sessions = frame(spark, "sessions", [{"session_key": 1, "session_type": "Race", "date_start": ts("2024-03-01 10:00:00"), "date_end": ts("2024-03-01 12:30:00")}])
    return sessions, frame(spark, "drivers", [{"session_key": 1, "driver_number": 1}])


@pytest.mark.parametrize("registered", [False, True])
def test_missing_hour_comes_later_and_once(spark, tmp_path, race, registered):
    table, led = str(tmp_path / "car"), str(tmp_path / "ledger")

    def run(hours):
        registry = None
        if registered:
            kind = "session_key int, driver_number int, request_from string, request_to string, status string"
            ends = {10: "2024-03-01 11:00:00", 11: "2024-03-01 12:00:00", 12: "2024-03-01 12:30:00"}
            registry = spark.createDataFrame([(1, 1, f"2024-03-01 {h}:00:00", ends[h], "rows") for h in hours], kind)
        return loaders.run_car_data_backfill(spark, car_rows(spark, hours).where("minute(date) < 30 OR hour(date) < 12"), *race, table, led, registry=registry)

    def speeds():
        return sorted(r.date.hour for r in manifest.read_published(spark, table, schemas.RAW["car_data"]).collect())

    assert run([10, 12]) == 1
    assert speeds() == [10, 10, 12] and ledger.read_ledger(spark, led).count() == 0
    assert run([10, 12]) == 0
    assert run([10, 11, 12]) == 1
    assert speeds() == [10, 10, 11, 11, 12] and ledger.read_ledger(spark, led).count() == 1
    assert run([10, 11, 12]) == 0


def test_empty_hour_closes_with_registry(spark, tmp_path, race):
    table, led = str(tmp_path / "car"), str(tmp_path / "ledger")
    kind = "session_key int, driver_number int, request_from string, request_to string, status string"
    hours = [("10:00", "11:00", "rows"), ("11:00", "12:00", "empty"), ("12:00", "12:30", "error")]
    told = spark.createDataFrame([(1, 1, f"2024-03-01 {a}:00", f"2024-03-01 {b}:00", s) for a, b, s in hours], kind)
    assert loaders.run_car_data_backfill(spark, car_rows(spark, [10]), *race, table, led, registry=told) == 1
    assert ledger.read_ledger(spark, led).count() == 1


def test_tiles(spark):
    spans = spark.createDataFrame([(1, 0, 10), (2, 0, 10), (3, 0, 10), (4, 5, 5), (5, 0, 10), (6, 0, 10)], "k int, s int, e int")
    parts = [(1, 0, 4), (1, 4, 10), (2, 0, 4), (2, 5, 10), (3, -5, 20), (5, 1, 10), (6, 0, 8), (6, 2, 3), (6, 8, 10)]
    got = payloads.tiled(spark.createDataFrame(parts, "k int, lo int, hi int"), spans, ["k"], "lo", "hi", "s", "e")
    assert sorted(r.k for r in got.collect()) == [1, 3, 4, 6]


def test_first_row_of_a_payload_is_kept(spark, tmp_path):
    row = {"session_key": 1, "driver_number": 4, "lap_number": 3, "pit_duration": 22.5}
    lines = [[{**row, "date": "2024-03-01T11:00:00Z"}, {**row, "date": "2024-03-01T10:00:00Z"}], [{**row, "date": "2024-03-01T09:00:00Z"}]]
    (tmp_path / "pit.json").write_text("\n".join(map(json.dumps, lines)))
    landed = landing.read_landing(spark, str(tmp_path / "pit.json"), PIT, origin=True)
    for parts in (1, 7):
        got = loaders.load_pit(landed.repartition(parts)).collect()
        assert [r.date for r in got] == [ts("2024-03-01 11:00:00")] and "_origin" not in got[0].asDict()
    plain = loaders.load_pit(landing.read_landing(spark, str(tmp_path / "pit.json"), PIT)).collect()
    assert [r.date for r in plain] == [ts("2024-03-01 09:00:00")]  # without origin: by date


def test_rejects_are_stored_once_and_replayed(spark, tmp_path):
    bad = '{"session_key": 1, "driver_number": 4, "lap_number": "x", "pit_duration": 22.5}'
    (tmp_path / "pit.json").write_text("\n".join([bad, '{"session_key": 2, "driver_number": 4, "lap_number": 1}', '{"sess']))
    landed = landing.read_landing(spark, str(tmp_path / "pit.json"), PIT)
    table, store = str(tmp_path / "pit"), str(tmp_path / "rejects")
    for _ in range(2):
        loaders.run_load(loaders.load_pit(landed, manifest.read_stored(spark, table, PIT)), table, landing=landed, reject_path=store)
    assert rejects.read_rejects(spark, store).count() == 2
    for _ in range(2):
        mended = rejects.replay(spark, store, PIT, lambda t: F.replace(t, F.lit('"x"'), F.lit("7")))
        assert landing.rejected(mended).count() == 1
        loaders.run_load(loaders.load_pit(mended, manifest.read_stored(spark, table, PIT)), table)
    rows = manifest.read_stored(spark, table, PIT).collect()
    assert sorted((r.session_key, r.lap_number) for r in rows) == [(1, 7), (2, 1)]
