from __future__ import annotations

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.operators import classify as C
from plumbline.operators import upsert as U
from plumbline.plans.controlled_load import MASTER, REJECTIONS, RUN_TABLES, ControlledLoad, LandingError
from plumbline.session import LISTING_TASKS, few_listing_tasks, hashed_joins
from plumbline.sources.store import StateStore
from plumbline.streaming.landing_stream import load_new_files

HEAD = "﻿F11.1  EXCHANGE RATES\nTitle,A$1=USD\nSeries ID,FXRUSD,FXREUR\n"


def land(folder, name, body, head=HEAD):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes((head + body).encode())
    return str(folder)


def make(spark, tmp_path, origin="feed://a"):
    return ControlledLoad(spark, StateStore(spark, str(tmp_path / "state")), origin, "FX")


def counts(load):
    cols = ["staged_count", "valid_count", "invalid_count", "new_count", "changed_count", "unchanged_count"]
    return {
        r["fp"]: tuple(r[c] for c in cols)
        for r in load.registry().select(F.regexp_extract("source_url", r"([^/]+)$", 1).alias("fp"), *cols).collect()
    }


def rates(load):
    return {(str(r.rate_date), r.series_id): r.rate for r in load.master().collect()}


def test_increments_skip_resume_and_rollback(spark, tmp_path):
    load, folder = make(spark, tmp_path), tmp_path / "landing"
    path = land(folder, "1.csv", "03-Jan-2023,0.6828,0.6397\n,,\n04-Jan-2023,,0.6411\n")
    out = load.load(path).collect()
    assert [r.outcome for r in out] == ["PROCESSED"]
    assert counts(load) == {"1.csv": (4, 3, 1, 3, 0, 0)}
    assert [r.outcome for r in load.load(path).collect()] == ["SKIPPED"]

    # Two overlapping increments and a copy land together and load as if in order.
    land(folder, "2.csv", "03-Jan-2023,0.6828,0.6397\n04-Jan-2023,0.7,0.6411\n")
    land(folder, "3.csv", "03-Jan-2023,0.6828,0.64\n04-Jan-2023,0.7,0.6411\n05-Jan-2023,bad\n")
    land(folder, "3b.csv", "03-Jan-2023,0.6828,0.64\n04-Jan-2023,0.7,0.6411\n05-Jan-2023,bad\n")
    land(folder, "4.csv", "no header here\n", head="")
    done = {r.run_id: r for r in load.load(path).collect()}
    assert sorted((r.outcome, r.copies) for r in done.values()) == [
        ("PROCESSED", 1), ("PROCESSED", 2), ("REJECTED", 1), ("SKIPPED", 1),
    ]
    assert counts(load) == {
        "1.csv": (4, 3, 1, 3, 0, 0),
        "2.csv": (4, 4, 0, 1, 0, 3),
        "3.csv": (4, 4, 0, 0, 1, 3),
        "4.csv": (None,) * 6,
    }
    assert rates(load)[("2023-01-03", "FXREUR")] == Decimal("0.64")
    assert {r.status for r in load.registry().where("staged_count is null").collect()} == {"RUNNING"}
    codes = [r.error_code for r in load.table("structural_exceptions").collect()]
    assert sorted(codes) == ["HEADER_NOT_FOUND", "WRONG_FIELD_COUNT"]
    assert load.history().where("count_reconciliation = 'FAIL'").isEmpty()
    report = load.verify().where("status = 'SUCCESS'").collect()
    assert len(report) == 3
    for r in report:
        assert r.staging_reconciles and r.staging_duplicate_key_count == 0
        assert r.exception_duplicate_key_count == r.validated_duplicate_business_key_count == 0
        assert r.master_duplicate_business_key_count == 0

    # Compaction changes nothing that a reader sees.
    before = sorted(load.master().collect())
    load.compact()
    assert load.store._versions("master", "v=") and sorted(load.master().collect()) == before

    # Rolling back the run that changed a rate restores it from the base run.
    runs = {r["n"]: r.run_id for r in load.registry().select(
        "run_id", F.regexp_extract("source_url", r"([^/]+)$", 1).alias("n")).collect()}
    with pytest.raises(AssertionError, match="rollback aborted"):
        load.rollback(runs["2.csv"], runs["1.csv"])
    load.rollback(runs["3.csv"], runs["1.csv"])
    assert rates(load)[("2023-01-03", "FXREUR")] == Decimal("0.6397")
    assert runs["3.csv"] not in {r.run_id for r in load.registry().collect()}
    for table in ("staging", "exceptions", "validated", "bronze"):
        assert load.table(table).where(F.col("run_id") == runs["3.csv"]).isEmpty()


def test_crash_between_upsert_and_close_keeps_first_classification(spark, tmp_path, monkeypatch):
    load = make(spark, tmp_path)
    path = land(tmp_path / "landing", "1.csv", "03-Jan-2023,0.6828,0.6397\n")
    monkeypatch.setattr(ControlledLoad, "_close", lambda self, work: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        load.load(path)
    assert len(rates(load)) == 2
    monkeypatch.undo()
    assert [r.outcome for r in load.load(path).collect()] == ["PROCESSED"]
    assert counts(load) == {"1.csv": (2, 2, 0, 2, 0, 0)}
    assert load.table("staging").count() == load.table("validated").count() == 2


def test_gates(spark, tmp_path, monkeypatch):
    body = "03-Jan-2023,0.6828,0.6397\n"
    path = land(tmp_path / "landing", "1.csv", body)
    load = make(spark, tmp_path)
    load.files_expected, load.signature = 1, "F11.1"
    assert [r.outcome for r in load.load(path).collect()] == ["PROCESSED"]
    land(tmp_path / "landing", "2.csv", "04-Jan-2023,1,2\n")
    with pytest.raises(LandingError, match="2 files"):
        load.load(path)
    load.files_expected = None
    other = land(tmp_path / "other", "x.csv", body, head="Something else\nSeries ID,FXRUSD\n")
    with pytest.raises(LandingError, match="begin"):
        load.load(other)
    with pytest.raises(LandingError, match="0 files"):
        ControlledLoad(spark, load.store, "o", "FX", files_expected=1).load(path, glob="none*.csv")
    assert load.registry().count() == 1

    # An unsound header is a verdict of its own, and the file is not parsed again.
    load.signature = None
    bad = land(tmp_path / "bad", "b.csv", "no header\n", head="")
    assert [r.outcome for r in load.load(bad).collect()] == ["REJECTED"]
    monkeypatch.setattr(ControlledLoad, "_process", lambda *_: pytest.fail("parsed again"))
    assert [r.outcome for r in load.load(bad).collect()] == ["REJECTED"]
    monkeypatch.undo()
    strict = ControlledLoad(spark, StateStore(spark, str(tmp_path / "strict")), "s", "FX", strict=True)
    with pytest.raises(Exception, match="HEADER_NOT_FOUND"):
        strict.load(bad)


def test_a_file_that_changes_meanwhile_loads_what_was_fingerprinted(spark, tmp_path, monkeypatch):
    load = make(spark, tmp_path)
    path = land(tmp_path / "landing", "1.csv", "03-Jan-2023,0.6828,0.6397\n")
    process = ControlledLoad._process

    def changed(self, *args):
        land(tmp_path / "landing", "1.csv", "03-Jan-2023,9.6828,0.6397\n")
        process(self, *args)

    monkeypatch.setattr(ControlledLoad, "_process", changed)
    load.load(path)
    assert rates(load)[("2023-01-03", "FXRUSD")] == Decimal("0.6828")
    monkeypatch.undo()
    assert [r.outcome for r in load.load(path).collect()] == ["PROCESSED"]
    assert rates(load)[("2023-01-03", "FXRUSD")] == Decimal("9.6828")
    assert load.registry().count() == 2


def test_an_unclosed_quote_rejects_its_file_alone(spark, tmp_path):
    load, folder = make(spark, tmp_path), tmp_path / "landing"
    load.max_record = 200
    land(folder, "bad.csv", '03-Jan-2023,"0.6828,0.6397\n' + "04-Jan-2023,1,2\n" * 30)
    path = land(folder, "good.csv", "03-Jan-2023,0.6828,0.6397\n")
    outcomes = {r.source_fingerprint: r.outcome for r in load.load(path).collect()}
    assert sorted(outcomes.values()) == ["PROCESSED", "REJECTED"]
    assert [r.error_code for r in load.table("structural_exceptions").collect()] == ["RECORD_TOO_LARGE"]
    assert len(rates(load)) == 2 and load.table("bronze").count() == (3 + 31) + (3 + 1)


def test_a_file_without_rows_is_rejected_and_raises_in_strict_mode(spark, tmp_path, monkeypatch):
    load, folder = make(spark, tmp_path), tmp_path / "landing"
    land(folder, "1.csv", "\n,,\n")
    path = land(folder, "2.csv", "03-Jan-2023,1\n")
    assert [r.outcome for r in load.load(path).collect()] == ["REJECTED"] * 2
    assert [r.status for r in load.registry().collect()] == ["RUNNING"] * 2 and load.master().isEmpty()
    monkeypatch.setattr(ControlledLoad, "_process", lambda *_: pytest.fail("parsed again"))
    assert [r.outcome for r in load.load(path).collect()] == ["REJECTED"] * 2
    monkeypatch.undo()
    strict = ControlledLoad(spark, StateStore(spark, str(tmp_path / "strict")), "s", "FX", strict=True)
    with pytest.raises(ValueError, match="1.csv: NO_DATA_ROWS"):
        strict.load(path)


def test_other_origin_gives_a_second_run_with_nothing_new(spark, tmp_path):
    path = land(tmp_path / "landing", "1.csv", "03-Jan-2023,0.6828,0.6397\n")
    make(spark, tmp_path).load(path)
    other = make(spark, tmp_path, origin="shortcut://b")
    assert [r.outcome for r in other.load(path).collect()] == ["PROCESSED"]
    rows = other.registry().select("source", "new_count", "unchanged_count").collect()
    assert sorted(tuple(r) for r in rows) == [("feed://a", 2, 0), ("shortcut://b", 0, 2)]


def test_stream_loads_only_new_files(spark, tmp_path):
    load, folder = make(spark, tmp_path), tmp_path / "landing"
    path = land(folder, "1.csv", "03-Jan-2023,0.6828,0.6397\n")
    for name, body in (("2.csv", "04-Jan-2023,0.69,0.64\n"), (None, None)):
        query = load_new_files(load, path, str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        assert query.exception() is None
        if name:
            land(folder, name, body)
    assert len(rates(load)) == 4
    assert load.history().where("status = 'SUCCESS'").count() == 2


def test_store_ignores_incomplete_snapshots(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    store.ensure("master", MASTER)
    store.ensure("master", MASTER)
    assert store._versions("master", "v=") == [1]
    (tmp_path / "state" / "master" / "v=2").mkdir()
    assert store.read("master", MASTER).isEmpty()
    assert store.publish("master", store.read("master", MASTER)) == 3


def test_a_load_opens_its_own_folders_and_periods_only(spark, tmp_path, monkeypatch):
    load, folder = make(spark, tmp_path), tmp_path / "landing"
    load.load(land(folder, "1.csv", "03-Jan-2021,0.6828,0.6397\n03-Jan-2022,0.7,0.6\n"))
    seen = {}
    read, current = StateStore.read_runs, StateStore.current

    def read_runs(self, name, schema, loads=None):
        out = read(self, name, schema, loads)
        seen.setdefault(name, set()).update(out.inputFiles())
        return out

    def of_periods(self, name, schema, keys=C.MASTER_KEY, periods=None):
        out = current(self, name, schema, keys, periods)
        seen["plan"] = out._jdf.queryExecution().executedPlan().toString()
        seen["periods"] = periods
        return out

    monkeypatch.setattr(StateStore, "read_runs", read_runs)
    monkeypatch.setattr(StateStore, "current", of_periods)
    load.load(land(folder, "2.csv", "04-Jan-2022,0.69,0.64\n03-Jan-2022,0.71,0.6\n"))
    assert seen["periods"] == (2022, 2022)
    assert "PartitionFilters: [isnotnull(period" in seen["plan"]
    for name in ("staging", "validated", "exceptions"):
        assert all("load_id=2/" in f for f in seen[name]), seen[name]
    monkeypatch.undo()
    assert counts(load) == {"1.csv": (4, 4, 0, 4, 0, 0), "2.csv": (4, 4, 0, 2, 1, 1)}
    assert load.store.total("master").first()["rows"] == load.master().count() == 6
    load.compact()
    assert load.store.total("master").first()["rows"] == load.master().count() == 6
    assert sorted(p.name for p in (tmp_path / "state" / "master").glob("v=*/period=*")) == ["period=2021", "period=2022"]


def test_run_folders_are_listed_once_after_each_write(spark, tmp_path, monkeypatch):
    opened, read = Counter(), StateStore.read_runs

    def counted(self, name, *rest):
        opened[name] += 1
        return read(self, name, *rest)

    load = make(spark, tmp_path)
    path = land(tmp_path / "landing", "1.csv", "03-Jan-2023,0.6828,0.6397\n04-Jan-2023,,0.6411\n")
    monkeypatch.setattr(StateStore, "read_runs", counted)
    load.load(path)
    assert [opened[t] for t in ("staging", "exceptions", "validated")] == [1, 2, 2]
    assert counts(load) == {"1.csv": (4, 3, 1, 3, 0, 0)}


def test_many_folders_are_listed_in_few_tasks(spark):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    with few_listing_tasks(spark):
        assert int(spark.conf.get(name)) <= LISTING_TASKS
    assert spark.conf.get(name) == before


def land_three(load, folder):
    for i in (1, 2, 3):
        path = land(folder, f"{i}.csv", f"0{i}-Jan-2023,0.6{i},0.5\n")
    land(folder, "bad.csv", "no header\n", head="")
    load.load(path)
    names = load.registry().select("run_id", F.regexp_extract("source_url", r"([^/]+)$", 1).alias("n")).collect()
    return path, {r.n: r.run_id for r in names}


def test_a_load_has_one_folder_in_each_table_however_many_runs(spark, tmp_path):
    load = make(spark, tmp_path)
    land_three(load, tmp_path / "landing")
    for name in ("bronze", "structural_exceptions", "staging", "validated"):
        assert [p.name for p in (tmp_path / "state" / name).iterdir() if p.is_dir()] == ["load_id=1"]
        assert not list((tmp_path / "state" / name).glob("**/run_id=*"))
    assert load.table("staging").select("run_id").distinct().count() == 3


def test_dropping_a_run_keeps_the_others_of_its_load(spark, tmp_path):
    load = make(spark, tmp_path)
    path, runs = land_three(load, tmp_path / "landing")
    kept = {n: load.table(n).where(F.col("run_id") != runs["2.csv"]).count() for n in ("bronze", "staging", "validated")}
    load.store.drop_run(runs["2.csv"], {**RUN_TABLES, **REJECTIONS})
    for name, rows in kept.items():
        left = load.table(name)
        assert left.count() == rows > 0 and left.where(F.col("run_id") == runs["2.csv"]).isEmpty()
        assert [p.name for p in (tmp_path / "state" / name).glob("load_id=*")] == ["load_id=2"]
    assert {r.run_id for r in load.store.newest_loads().collect()} == set(runs.values()) - {runs["2.csv"]}
    assert {r.run_id for r in load._rejected().collect()} == {runs["bad.csv"]}


def test_a_resumed_run_belongs_to_the_new_load_alone(spark, tmp_path, monkeypatch):
    load = make(spark, tmp_path)
    monkeypatch.setattr(ControlledLoad, "_close", lambda self, work: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        land_three(load, tmp_path / "landing")
    monkeypatch.undo()
    bronze = load.table("bronze").count()
    land(tmp_path / "landing", "4.csv", "01-Jan-2023,0.61,0.7\n")
    load.load(str(tmp_path / "landing"))
    assert {r.load_id for r in load.store.newest_loads().collect()} == {1, 2}  # the rejected file isn't taken up again
    assert load.table("bronze").count() == bronze + 4
    assert counts(load)["1.csv"] == (2, 2, 0, 2, 0, 0) and counts(load)["4.csv"] == (2, 2, 0, 0, 1, 1)
    assert load.table("validated").count() == 8


def test_joins_of_a_load_leave_the_setting_as_it_was(spark):
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name)
    with hashed_joins(spark):
        assert spark.conf.get(name) != before
    assert spark.conf.get(name) == before


def test_last_candidates_by_run_number(spark):
    rows = [("FX", d, s, n, Decimal(f"{v}.00000000"), f"r{n}") for d, s, n, v in (
        ("2023-01-01", "A", 3, 5), ("2023-01-01", "A", 1, 9), ("2023-01-01", "A", 2, 7), ("2023-01-02", "A", 2, 1), (None, "A", 1, 4), (None, "A", 3, 2))]
    df = spark.createDataFrame(rows, "source string, rate_date string, series_id string, load_order bigint, rate decimal(20,8), run_id string")
    runs = df.select("run_id", "load_order").distinct()
    want = U.last_candidates(df, "load_order")
    got = U.last_candidates(df, "load_order", runs=runs)
    assert got.columns == want.columns and Counter(got.collect()) == Counter(want.collect()) and got.count() == 3


def test_a_log_without_a_snapshot_is_read_entry_over_entry(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    schema = "source string, rate_date string, series_id string, rate int"
    for rows in ([("a", 1), ("b", 1), ("c", 1)], [("b", 2), ("d", 2)], [("d", 3), ("c", 3)]):
        store.log_changes("m", spark.createDataFrame([("FX", "d", s, v) for s, v in rows], schema))
    assert {(r.series_id, r.rate) for r in store.current("m", schema).collect()} == {("a", 1), ("b", 2), ("c", 3), ("d", 3)}
    store.compact("m", schema)
    store.log_changes("m", spark.createDataFrame([("FX", "d", "a", 4)], schema))
    assert {(r.series_id, r.rate) for r in store.current("m", schema).collect()} == {("a", 4), ("b", 2), ("c", 3), ("d", 3)}
