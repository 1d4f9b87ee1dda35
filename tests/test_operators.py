from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.operators import classify as C
from plumbline.operators import keys as K
from plumbline.operators import monitor as M
from plumbline.operators import quality as Q
from plumbline.operators import reconcile as V
from plumbline.operators import registry as R
from plumbline.operators import reshape as S
from plumbline.operators import upsert as U
from plumbline.plans import drill as D
from plumbline.plans import fixtures as X

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, exact copies among them; some keys are incomplete."""
    rows = [("hot", 1, "x")] * 40 + [("warm", 2, str(i)) for i in range(9)]
    rows += [(f"k{i}", i % 3, "y") for i in range(50)] + [(f"k{i}", i % 3, "z") for i in range(0, 50, 7)]
    rows += [(None, 1, "n")] * 5 + [("k1", None, "n")] * 4
    return rows, spark.createDataFrame(rows, "a string, b int, c string").repartition(4)


# Thresholds that make the hot path serve no key, one key, and every key.
HOT = [{"hot_rows": 10**6}, {"hot_rows": 2, "hot_keys": 1}, {"hot_rows": 1, "hot_keys": 1000}]


@pytest.mark.parametrize("hot", HOT)
def test_key_multiplicity_against_brute_force(skewed, hot):
    rows, df = skewed
    n = Counter((a, b) for a, b, _ in rows)
    expected = Counter((a, b, c, 0 if a is None or b is None else n[(a, b)]) for a, b, c in rows)
    got = Counter(tuple(r) for r in K.key_multiplicity(df, ["a", "b"], "n", **hot).collect())
    assert got == expected
    dup = Counter(tuple(r) for r in K.duplicate_rows(df, ["a", "b"], **hot).collect())
    single = Counter(tuple(r) for r in K.non_duplicate_rows(df, ["a", "b"], **hot).collect())
    assert dup == Counter(r for r in rows if None not in r and n[r[:2]] > 1)
    assert dup + single == Counter(rows)


@pytest.mark.parametrize("hot", HOT)
def test_referential_split_against_brute_force(spark, skewed, hot):
    rows, df = skewed
    known = {"hot", "k3", "k4", "absent"}
    members = spark.createDataFrame([(k,) for k in known], "a string")
    orphans = Counter(tuple(r) for r in K.referential_orphans(df, members, "a", **hot).collect())
    clean = Counter(tuple(r) for r in K.referential_members(df, members, "a", **hot).collect())
    assert clean == Counter(r for r in rows if r[0] in known)
    assert orphans + clean == Counter(rows)


def test_precounted_repeated_keys_give_the_same(skewed):
    _, df = skewed
    repeated = K.repeated_keys(df, ["a", "b"])
    one = K.key_multiplicity(df, ["a", "b"], repeated=repeated)
    assert Counter(one.collect()) == Counter(K.key_multiplicity(df, ["a", "b"]).collect())


def test_missing_key_parts(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    assert [tuple(r) for r in K.duplicate_keys(df, ["x", "y"]).collect()] == [("a", None, 2)]
    assert K.duplicate_rows(df, ["x", "y"]).isEmpty() and K.non_duplicate_rows(df, ["x", "y"]).count() == 3
    assert df.agg(K.duplicate_count("x", "y")).first()[0] == 1


def test_quality_laws(spark):
    flags = X.flags(spark, SF).cache()
    exceptions = Q.exception_rows(
        flags, ["run_id", "source", "source_row_no", "raw_rate_date", "series_id", "raw_rate"]
    )
    total = Q.quality_summary(flags).first()
    assert (total.staged_count, total.valid_count, total.invalid_count) == (1500, 1271, 229)
    sums = Q.rule_totals(flags).first()
    assert [sums[c] for c in Q.RULE_CODES] == [32, 16, 16, 17, 17, 19, 38, 36, 36, 22]
    assert Q.invalid_agreement(flags, exceptions).first().agrees
    by_flag = C.valid_by_flag(flags)
    by_exceptions = C.valid_by_exceptions(Q.typed_rows(X.stg(spark, SF)), exceptions, Q.RECORD_KEY)
    assert Counter(by_flag.collect()) == Counter(by_exceptions.collect())
    assert Q.new_exceptions(exceptions, exceptions).isEmpty()


def test_staging_twice_inserts_nothing(spark):
    rows = [("r", 1, None, "a", 1), ("r", 1, None, "b", 2), ("r", 1, "S", "c", 3), ("r", 2, "S", "d", 4)]
    batch = spark.createDataFrame(
        rows, "run_id string, source_row_no int, series_id string, raw_rate string, ordinal int"
    )
    empty = batch.drop("ordinal").where(F.lit(False))
    first = S.staging_inserts(batch, empty)
    assert sorted(r.raw_rate for r in first.collect()) == ["a", "c", "d"]
    assert S.staging_inserts(batch, first).isEmpty()
    summary = S.staging_load_summary(batch, first).first()
    assert (summary.received_count, summary.inserted_count, summary.duplicate_skipped) == (4, 3, 1)
    with pytest.raises(ValueError):
        S.require_non_empty(empty, "No normalized records received")


VALID = "run_id string, source string, rate_date date, series_id string, rate decimal(20,8)"
MASTER = (
    "source string, rate_date date, series_id string, rate decimal(20,8), "
    "first_loaded_run_id string, last_changed_run_id string, updated_at timestamp"
)
DAY, THEN = date(2023, 1, 3), datetime(2023, 1, 4)


def valid_rows(spark, *rows):
    return spark.createDataFrame(
        [(run, "S", DAY, s, None if r is None else Decimal(r)) for run, s, r in rows], VALID
    )


def master_rows(spark, *rows):
    return spark.createDataFrame(
        [("S", DAY, s, None if r is None else Decimal(r), "m", "m", THEN) for s, r in rows], MASTER
    )


def test_classify_treats_a_missing_master_value_as_changed(spark):
    valid = valid_rows(spark, ("r", "A", "1"), ("r", "B", "2"), ("r", "C", "3"), ("r", "D", None))
    master = master_rows(spark, ("A", "1.00"), ("B", None), ("D", None))
    got = {r.series_id: r.load_action for r in C.classify(valid, master).collect()}
    assert got == {"A": "UNCHANGED", "B": "CHANGED", "C": "NEW", "D": "UNCHANGED"}


def test_ordered_batch_equals_runs_loaded_one_by_one(spark):
    runs = {
        "r1": [("A", "1"), ("B", "5"), ("C", "7")],
        "r2": [("A", "2"), ("B", "5")],
        "r3": [("A", "1"), ("C", "8"), ("E", "9")],
    }
    now = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    start = master_rows(spark, ("A", "1"), ("C", "7"), ("D", "4"))
    batch = valid_rows(spark, *[(run, s, r) for run, rows in runs.items() for s, r in rows])

    master, actions = start, {}
    for run, rows in runs.items():
        classified = C.classify(valid_rows(spark, *[(run, s, r) for s, r in rows]), master)
        actions |= {(run, r.series_id): r.load_action for r in classified.collect()}
        after = U.upsert(master, C.upsert_candidates(classified), now)
        master = spark.createDataFrame(after.collect(), MASTER)

    ordered = C.classify_in_order(batch, start, "run_id")
    assert {(r.run_id, r.series_id): r.load_action for r in ordered.collect()} == actions
    candidates = U.last_candidates(C.upsert_candidates(ordered), "run_id")
    changes = U.master_changes(start, candidates, now)
    values = ("source", "rate_date", "series_id", "rate", "first_loaded_run_id")
    assert Counter(U.overlay(start, changes).select(*values).collect()) == Counter(
        master.select(*values).collect()
    )


def _ordered_by_hand(rows, master):
    """Actions of (key, order, value) rows taken in order, one after the other."""
    held, out = dict(master), {}
    for key, at, value in sorted(rows, key=lambda r: r[1]):
        out[key, at] = "NEW" if key not in held else "CHANGED" if held[key] != value else "UNCHANGED"
        held[key] = value
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_a_key_in_half_of_the_rows_is_split_over_ranges(spark, partitions):
    rows = [("hot", at, at // 3 % 5) for at in range(20_000)]
    rows += [(f"k{i % 3000}", 7 * i, None if i % 11 == 0 else i % 4) for i in range(20_000)]
    master = [("hot", 0), ("k1", 3), ("k2", None), ("absent", 1)]
    batch = spark.createDataFrame(rows, "k string, at bigint, v int").repartition(5)
    known = spark.createDataFrame(master, "k string, v int")
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        got = C.classify_in_order(batch, known, "at", ["k"], ["v"]).collect()
        ranges = C.carried_in_ranges(batch, ["k"], "at", ["v"]).groupBy("_part").count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert {(r.k, r["at"]): r.load_action for r in got} == _ordered_by_hand(rows, master)
    assert len(got) == len(rows)
    sizes = sorted(r["count"] for r in ranges)
    assert len(sizes) == partitions and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_ordered_classification_of_missing_keys_and_of_nothing(spark):
    rows = [(None, 1, 5), (None, 2, 5), (None, 3, None), ("a", 1, None), ("a", 2, None), ("a", 3, 1)]
    batch = spark.createDataFrame(rows, "k string, at bigint, v int")
    known = spark.createDataFrame([(None, 5)], "k string, v int")
    got = {(r.k, r["at"]): r.load_action for r in C.classify_in_order(batch, known, "at", ["k"], ["v"]).collect()}
    # A missing key part never meets the master, but it goes on within the batch.
    assert got == {
        (None, 1): "NEW", (None, 2): "UNCHANGED", (None, 3): "CHANGED",
        ("a", 1): "NEW", ("a", 2): "UNCHANGED", ("a", 3): "CHANGED",
    }
    assert C.classify_in_order(batch.limit(0), known, "at", ["k"], ["v"]).collect() == []


def test_upsert_twice_is_upsert_once(spark):
    now = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    later = F.lit(datetime(2025, 1, 1)).cast("timestamp")
    master = master_rows(spark, ("A", "1"), ("B", None), ("Z", "9"))
    candidates = valid_rows(spark, ("r", "A", "2"), ("r", "B", "3"), ("r", "C", "4"))
    once = U.upsert(master, candidates, now)
    assert Counter(U.upsert(once, candidates, later).collect()) == Counter(once.collect())
    assert U.master_changes(once, candidates, later).isEmpty()
    assert Counter(U.overlay(master, U.master_changes(master, candidates, now)).collect()) == Counter(once.collect())
    lineage = {r.series_id: (r.first_loaded_run_id, r.last_changed_run_id, r.updated_at) for r in once.collect()}
    new = datetime(2024, 1, 1)
    assert lineage == {"A": ("m", "r", new), "B": ("m", "r", new), "C": ("r", "r", new), "Z": ("m", "m", THEN)}
    assert U.mismatches(candidates, once).isEmpty()
    assert {r.load_action for r in C.classify(candidates, once).collect()} == {"UNCHANGED"}


def drill(spark):
    series = spark.range(1, 1001).withColumnRenamed("id", "s")
    return D.drill_source(series, F.lit("b"), F.lit(1000)), D.drill_master(series, F.lit("a"))


def test_drill_gives_the_published_numbers(spark):
    rows, master = drill(spark)
    assert rows.select("source_row_no").distinct().count() == 300_000
    report = V.reconciliation_report(rows, master).first().asDict()
    assert report == {
        "supplier_rows": 300_000, "duplicate_business_keys": 5_000, "duplicate_affected_rows": 10_000,
        "excess_duplicate_rows": 5_000, "invalid_key_rows": 10_000, "clean_supplier_rows": 280_000,
        "source_only_rows": 45_000, "changed_rows": 25_000, "unchanged_rows": 210_000,
        "raw_reconciles": True, "clean_reconciles": True,
    }


def raw_rows(spark, *rows):
    return spark.createDataFrame(
        [("S", d, s, r) for d, s, r in rows], "source string, raw_rate_date string, series_id string, raw_rate string"
    )


def test_report_edge_cases(spark):
    master = master_rows(spark, ("A", "1"), ("B", "2"))
    day = "03-Jan-2023"
    # A repeated key without a date counts as a key, but its rows go on as clean rows.
    report = V.reconciliation_report(
        raw_rows(spark, (None, "A", "1"), (None, "A", "2"), (day, "A", "1"), (day, "B", "3"), ("x", "Q", "y"), (day, None, "1")),
        master,
    ).first()
    assert (report.duplicate_business_keys, report.duplicate_affected_rows, report.excess_duplicate_rows) == (1, 0, 1)
    assert (report.invalid_key_rows, report.clean_supplier_rows) == (2, 4)
    assert (report.source_only_rows, report.changed_rows, report.unchanged_rows) == (2, 1, 1)
    empty = V.reconciliation_report(raw_rows(spark, (day, "A", "1")).where(F.lit(False)), master).first()
    assert empty.supplier_rows == 0 and empty.excess_duplicate_rows is None and empty.raw_reconciles
    with pytest.raises(Exception, match="unconvertible"):
        V.reconciliation_report(raw_rows(spark, ("x", "A", "1")), master).collect()
    doubled = V.reconciliation_report(raw_rows(spark, (day, "A", "1")), master.unionByName(master)).first()
    assert doubled.raw_reconciles and not doubled.clean_reconciles
    assert (doubled.clean_supplier_rows, doubled.unchanged_rows) == (1, 2)
    # The source is known to have sent one row more than arrived.
    short = V.reconciliation_report(raw_rows(spark, (day, "A", "1")), master, expected=2).first()
    assert short.supplier_rows == 2 and short.clean_reconciles and not short.raw_reconciles


def test_series_of_another_source_are_unknown(spark):
    day = "03-Jan-2023"
    rows = raw_rows(spark, (day, "A", "1"), (day, "Z", "2"))
    master = master_rows(spark, ("A", "1")).unionByName(master_rows(spark, ("Z", "2")).withColumn("source", F.lit("T")))
    report = V.reconciliation_report(rows, master).first()
    assert (report.invalid_key_rows, report.clean_supplier_rows, report.source_only_rows) == (1, 1, 0)
    found = V.reconciled_rows(rows.withColumn("source_row_no", F.lit(1)), master).collect()
    assert [(r.series_id, r.reconciliation_status) for r in found] == [("A", "UNCHANGED")]


def test_repeated_members_do_not_repeat_rows(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    members = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    for hot in ({}, {"hot_rows": 1, "hot_keys": 2}):
        assert K.referential_members(rows, members, "k", **hot).count() == 2
        assert K.referential_orphans(rows, members, "k", **hot).count() == 1


def test_registry_and_monitoring(spark):
    now = F.lit(THEN).cast("timestamp")
    empty = spark.createDataFrame([], R.REGISTRY_SCHEMA)
    files = spark.createDataFrame(
        [("s", "f1", "u1"), ("s", "f1", "u0"), ("s", "f2", "u2")], "source string, source_fingerprint string, source_url string"
    )
    contents = R.distinct_contents(files)
    registry = spark.createDataFrame(R.register(contents, empty, now).collect(), R.REGISTRY_SCHEMA)
    assert registry.count() == 2 and R.resolve(contents, registry).where("should_process").count() == 2
    first = registry.where("source_fingerprint = 'f1'").select("run_id")
    counts = spark.createDataFrame([(first.first()[0], 1, 4, 2, 1, 1, 1, 0)], "run_id string, " + ", ".join(f"{c} bigint" for c in R.COUNTERS))
    closed = spark.createDataFrame(R.complete(registry, counts, first, now).collect(), R.REGISTRY_SCHEMA)
    assert R.completion_check(closed, registry).where("completed").count() == 1
    assert {r.source_fingerprint: r.outcome for r in R.detect_duplicates(contents, closed).collect()} == {
        "f1": "SKIPPED", "f2": "RUNNING",
    }
    assert [r.source_fingerprint for r in R.work_list(contents, closed).collect()] == ["f2"]
    # The open run has no verdict; 4 <> 2 + 1 fails.
    verdicts = {r.status: r.count_reconciliation for r in M.monitor_history(closed).collect()}
    assert verdicts == {"RUNNING": None, "SUCCESS": "FAIL"}
    with pytest.raises(AssertionError):
        M.assert_no_failures(M.monitor_history(closed))
    recent = {r.status: (r.staged_records, r.counts_reconcile) for r in M.monitor_recent(closed, "s").collect()}
    assert recent == {"RUNNING": (0, None), "SUCCESS": (4, False)}
    # A closed run does not close again, and keeps its counters.
    other = counts.withColumn("staged_count", F.lit(9).cast("bigint"))
    assert R.complete(closed, other, first, now).where("staged_count = 9").isEmpty()
    assert R.finalize(closed, other, first, now).where("staged_count = 9").count() == 1


def test_rules_follow_from_declared_fields(spark):
    feed = Q.Feed(
        fields=(
            Q.Field("sku", "raw_sku", "NO_SKU", (Q.shaped("BAD_SKU", r"\A[A-Z]{2}\z"), Q.barred("TEST_SKU", ("ZZ",)))),
            Q.Field(
                "units", "raw_units", None, (Q.above("NO_UNITS", 0), Q.within("MANY_UNITS", 0, 99)),
                lambda text: text.try_cast("int"), "BAD_UNITS",
            ),
        ),
        key=("run_id", "clean_sku"),
        repeated="TWICE",
        details={c: c.lower() for c in ("NO_SKU", "BAD_SKU", "TEST_SKU", "NO_UNITS", "MANY_UNITS", "BAD_UNITS", "TWICE")},
    )
    rows = [
        (1, "AB", "5"), (2, "CD", None), (3, " ", "x"), (4, "abc", "0"), (5, "ZZ", "100"),
        (6, "EF", "7"), (7, " EF", "-1"), (8, None, None),
    ]
    raw = spark.createDataFrame([("r", *r) for r in rows], "run_id string, n int, raw_sku string, raw_units string")
    flags = Q.flag_rows(raw, feed)
    found = Q.exception_rows(flags, ["n"], feed.details).collect()
    assert sorted((r.n, r.error_code, r.error_detail) for r in found) == [
        (3, "BAD_UNITS", "bad_units"), (3, "NO_SKU", "no_sku"), (4, "BAD_SKU", "bad_sku"), (4, "NO_UNITS", "no_units"),
        (5, "MANY_UNITS", "many_units"), (5, "TEST_SKU", "test_sku"), (6, "TWICE", "twice"),
        (7, "NO_UNITS", "no_units"), (7, "TWICE", "twice"), (8, "NO_SKU", "no_sku"),
    ]
    values = {r.n: (r.clean_sku, r.parsed_units) for r in flags.where("is_valid").collect()}
    assert values == {1: ("AB", 5), 2: ("CD", None)}
    with pytest.raises(ValueError, match="one code"):
        Q.Feed(feed.fields, feed.key, "TWICE", {"TWICE": "x"})


def test_drill_series_grow_in_many_tasks(spark, tmp_path):
    spark.range(2500).select(F.col("id").alias("s_suppkey")).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    series = X.drill_series(spark, str(tmp_path))
    assert series.rdd.getNumPartitions() == 3
    assert sorted(r["s"] for r in series.collect()) == list(range(1, 2501))


def _raw_rows(spark):
    return spark.range(0, 100, 1, 1).selectExpr(
        "'r' AS run_id", "'S' AS source", "'01-Jan-2025' AS raw_rate_date",
        "concat('X', if(id < 90, 0, id)) AS series_id", "'1' AS raw_rate", "id AS source_row_no",
    )


def _held(spark):
    return spark.sql("SELECT 'S' AS source, DATE'2025-01-01' AS rate_date, 'X99' AS series_id, CAST(1 AS decimal(20,8)) AS rate")


def _rebalanced(df):
    return "RebalancePartitions" in df._jdf.queryExecution().optimizedPlan().toString()


def test_report_counts_keys_in_parts_of_bounded_size(spark):
    report = V.reconciliation_report(_raw_rows(spark), _held(spark))
    assert _rebalanced(report)
    row = report.first()
    assert (row["supplier_rows"], row["duplicate_affected_rows"], row["invalid_key_rows"], row["unchanged_rows"]) == (100, 90, 9, 1)


def test_classified_rows_meet_in_parts_of_bounded_size(spark):
    found = V.reconciled_rows(_raw_rows(spark), _held(spark))
    assert _rebalanced(found)
    assert [(r["source_row_no"], r["reconciliation_status"]) for r in found.collect()] == [(99, "UNCHANGED")]
