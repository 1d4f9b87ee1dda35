"""Registered queries: one per operator, over the driver's tables.

Compared columns carry no clock and no random id.  Decimals leave as doubles,
dates and times as text, so any SQL engine can produce the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import classify as C
from plumbline.operators import keys as K
from plumbline.operators import monitor as M
from plumbline.operators import quality as Q
from plumbline.operators import reconcile as V
from plumbline.operators import registry as R
from plumbline.operators import reshape as S
from plumbline.operators import rollback as B
from plumbline.operators import upsert as U
from plumbline.plans import drill as D
from plumbline.plans import fixtures as X
from plumbline.plans.controlled_load import ControlledLoad
from plumbline.session import cut_lineage, shared_folder
from plumbline.sources import batches, blocks, landing, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text."""
    casts = {"decimal": "double", "date": "string", "timestamp": "string", "timestamp_ntz": "string"}

    def out(name: str, kind: str) -> Column:
        to = casts.get(kind.split("(")[0])
        return F.col(name).cast(to).alias(name) if to else F.col(name)

    return df.select(*[out(n, k) for n, k in df.dtypes])


# Landed files ---------------------------------------------------------------


@registered
def landing_files(spark, sf_dir):
    """Documents landed as text files per language, read back as bytes."""
    path = shared_folder(spark, "landing")
    X.table(spark, sf_dir, "documents").select("lang", "text").write.option(
        "lineSep", "\n"
    ).option("maxRecordsPerFile", 1_000_000).partitionBy("lang").text(path)
    files = landing.read_landing(spark, path)
    return files.groupBy(F.regexp_extract("path", "lang=([^/]*)/", 1).alias("lang")).agg(
        F.sum("length").alias("landed_bytes"),
        F.sum(F.length("content")).cast("bigint").alias("read_bytes"),
    )


@registered
def landing_cardinality(spark, sf_dir):
    """Files per feed; a feed is sound when exactly one file landed for it."""
    k = F.col("doc_id")
    feed = k - k % 4 + F.when(k % 4 == 3, 3).otherwise(0)
    return landing.match_counts(X.docs(spark, sf_dir), feed)


@registered
def text_source_check(spark, sf_dir):
    return landing.check_text_source(X.docs(spark, sf_dir), min_lines=20)


@registered
def signature_check(spark, sf_dir):
    return landing.check_signature(X.docs(spark, sf_dir))


@registered
def fingerprint(spark, sf_dir):
    return landing.with_fingerprint(X.docs(spark, sf_dir)).select("path", "source_fingerprint")


@registered
def bronze_lines(spark, sf_dir):
    files = landing.with_fingerprint(X.docs(spark, sf_dir)).withColumn(
        "run_id", R.run_id_of(F.col("source"), F.col("source_fingerprint"))
    )
    lines = landing.with_provenance(
        landing.bronze_lines(files),
        F.col("path"),
        F.col("source_fingerprint"),
        F.col("run_id"),
        X.at(X.NOW),
    )
    return plain(
        lines.select("source_url", "source_sha256", "ingested_at", "run_id", "line_number", "raw_line")
    )


@registered
def strip_metadata(spark, sf_dir):
    return landing.strip_metadata(X.csv_files(spark, sf_dir)).select("path", "header_line", "csv_text")


def _parsed(spark, sf_dir):
    return landing.parse_csv(landing.strip_metadata(X.csv_files(spark, sf_dir)))


def _csv_rows(spark, sf_dir):
    return landing.csv_rows(_parsed(spark, sf_dir))


@registered
def parse_csv_rows(spark, sf_dir):
    return _csv_rows(spark, sf_dir).select(
        "path",
        "source_row_no",
        F.array_join("headers", "|").alias("headers"),
        F.array_join("values", "|").alias("row_values"),
        "arity_ok",
    )


@registered
def csv_block_rows(spark, sf_dir):
    """Rows of landed files that are parsed by blocks, in as many tasks as they have blocks."""
    path = shared_folder(spark, "landed")
    X.landed_csv(spark, sf_dir, path)
    return blocks.csv_block_rows(spark, path).select(
        F.regexp_extract("path", "file=([0-9]+)/", 1).cast("bigint").alias("file"),
        "source_row_no",
        F.array_join("headers", "|").alias("headers"),
        F.array_join("values", "|").alias("row_values"),
        "arity_ok",
    )


@registered
def header_check(spark, sf_dir):
    return landing.header_check(_parsed(spark, sf_dir))


@registered
def arity_check(spark, sf_dir):
    return landing.arity_check(_csv_rows(spark, sf_dir))


@registered
def structural_exceptions(spark, sf_dir):
    rows = landing.csv_rows(_parsed(spark, sf_dir), keep_rejected=True)
    return landing.structural_exceptions(rows)


@registered
def json_batch(spark, sf_dir):
    rows = batches.decode_batch(X.json_batches(spark, sf_dir), "batch")
    return rows.withColumn("bad_fields", F.array_join("bad_fields", ","))


# Reshape and staging --------------------------------------------------------


@registered
def wide_to_long(spark, sf_dir):
    values = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    items = X.table(spark, sf_dir, "lineitem")
    ids = [c for c in items.columns if c not in values]
    return plain(S.to_long(items, ids, values))


@registered
def csv_to_long(spark, sf_dir):
    return S.rows_to_long(_csv_rows(spark, sf_dir))


@registered
def cardinality_check(spark, sf_dir):
    rows = _csv_rows(spark, sf_dir)
    return S.check_cardinality(
        S.rows_to_long(rows), rows.where("arity_ok"), F.size("headers") - 1, ["path"]
    )


@registered
def staging_rows(spark, sf_dir):
    long_rows = S.rows_to_long(_csv_rows(spark, sf_dir))
    return S.to_staging(long_rows, R.run_id_of(F.lit("ORD"), F.col("path")), F.lit("ORD"))


def _staging_load(spark, sf_dir):
    staged = X.stg_multi(spark, sf_dir).where("source_row_no % 5 = 0")
    batch = X.staging_batch(spark, sf_dir)
    return batch, S.staging_inserts(batch, staged)


@registered
def staging_inserts(spark, sf_dir):
    return _staging_load(spark, sf_dir)[1]


@registered
def staging_load(spark, sf_dir):
    return S.staging_load_summary(*_staging_load(spark, sf_dir))


@registered
def preview_topn(spark, sf_dir):
    return S.preview(X.stg(spark, sf_dir), ["source_row_no"], 10)


@registered
def write_readback(spark, sf_dir):
    """Staging rows written per run, read back and compared by count and checksum."""
    rows = X.stg_multi(spark, sf_dir)
    state = store.StateStore(spark, shared_folder(spark, "state"))
    state.replace_runs("staging", rows)
    return store.verify_readback(rows, state.read_runs("staging", rows.schema))


@registered
def typed_rows(spark, sf_dir):
    well_formed = F.coalesce(F.col("fault_date") == "INVALID_DATE_VALUE", F.lit(True))
    return plain(
        Q.typed_rows(X.stg(spark, sf_dir)).select(
            "source_row_no",
            "clean_date",
            "clean_series",
            "clean_rate",
            well_formed.alias("date_format_ok"),
            "parsed_date",
            "parsed_rate",
        )
    )


@registered
def key_multiplicity(spark, sf_dir):
    items = X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.nullif("l_linenumber", F.lit(7)).alias("l_linenumber"), "l_partkey"
    )
    return K.key_multiplicity(items, ["l_orderkey", "l_linenumber"], "key_count")


# Quality --------------------------------------------------------------------

_RAW = ["run_id", "source_row_no", "raw_rate_date", "series_id", "raw_rate"]


def _register_rule(code: str) -> None:
    def query(spark, sf_dir):
        rows = Q.typed_rows(X.stg(spark, sf_dir))
        if code == "DUPLICATE_BUSINESS_KEY":
            rows = K.key_multiplicity(rows, Q.RUN_KEY)
        rule = next(r for r in Q.feed_rules() if r.code == code)
        return rows.where(rule.fails).select(*_RAW)

    name = "rule_duplicate_key" if code == "DUPLICATE_BUSINESS_KEY" else f"rule_{code.lower()}"
    query.__name__ = name
    query.__doc__ = f"Rows that fail {code}."
    QUERIES[name] = query


for _code in Q.RULE_CODES:
    _register_rule(_code)


@registered
def dq_flags(spark, sf_dir):
    return X.flags(spark, sf_dir).select(
        "source_row_no", "business_key_count", *Q.RULE_CODES, "is_valid"
    )


@registered
def dq_valid_split(spark, sf_dir):
    return Q.quality_summary(X.flags_multi(spark, sf_dir))


@registered
def dq_rule_totals(spark, sf_dir):
    return Q.rule_totals(X.flags(spark, sf_dir))


def _exceptions(flags: DataFrame) -> DataFrame:
    return Q.exception_rows(
        flags,
        ["run_id", "source", "source_row_no", "raw_rate_date", "series_id", "raw_rate"],
    )


@registered
def dq_exceptions(spark, sf_dir):
    return _exceptions(X.flags(spark, sf_dir))


@registered
def exception_load(spark, sf_dir):
    detected = cut_lineage(_exceptions(X.flags_multi(spark, sf_dir)))
    logged = detected.where("source_row_no % 3 = 0")
    return Q.exception_load_summary(detected, Q.new_exceptions(detected, logged))


@registered
def exceptions_by_code(spark, sf_dir):
    return Q.exceptions_by_code(_exceptions(X.flags(spark, sf_dir)))


@registered
def invalid_record_count(spark, sf_dir):
    return Q.invalid_record_count(_exceptions(X.flags_multi(spark, sf_dir)))


@registered
def invalid_agreement(spark, sf_dir):
    flags = cut_lineage(X.flags_multi(spark, sf_dir))
    return Q.invalid_agreement(flags, _exceptions(flags))


# Classification and upsert --------------------------------------------------


@registered
def valid_by_flag(spark, sf_dir):
    return plain(C.valid_by_flag(X.flags(spark, sf_dir)))


@registered
def valid_by_antijoin(spark, sf_dir):
    exceptions = _exceptions(X.flags(spark, sf_dir))
    typed = Q.typed_rows(X.stg(spark, sf_dir))
    return plain(C.valid_by_exceptions(typed, exceptions, Q.RECORD_KEY))


@registered
def classify(spark, sf_dir):
    return plain(C.classify(*X.loads(spark, sf_dir)))


def _ordered_runs(spark, sf_dir):
    flags, master = X.multi_flags(spark, sf_dir)
    return C.classify_in_order(C.valid_by_flag(flags), master, "run_id"), master


@registered
def classify_in_order(spark, sf_dir):
    """Four runs classified in one job as if loaded one after the other."""
    return plain(_ordered_runs(spark, sf_dir)[0])


_STICKY_KEY = ["run_id", "source_row_no", "series_id"]


def _sticky(spark, sf_dir):
    """Every third row was classified before, as NEW."""
    valid, master = X.loads(spark, sf_dir)
    existing = valid.where("source_row_no % 3 = 0").withColumn("load_action", F.lit("NEW"))
    return C.classify(valid, master), existing


@registered
def classify_sticky(spark, sf_dir):
    return plain(C.sticky_classifications(*_sticky(spark, sf_dir), _STICKY_KEY))


@registered
def classify_summary(spark, sf_dir):
    classified, existing = _sticky(spark, sf_dir)
    inserted = C.first_classifications(classified, existing, _STICKY_KEY)
    return C.classification_summary(existing.unionByName(inserted), inserted)


@registered
def upsert_candidates(spark, sf_dir):
    return plain(C.upsert_candidates(C.classify(*X.loads(spark, sf_dir)), "r0"))


def _upsert(spark, sf_dir):
    """Valid rows, their classification, the master before and after the upsert."""
    valid, master = X.loads(spark, sf_dir)
    classified = C.classify(valid, master)
    after = U.upsert(master, C.upsert_candidates(classified), X.at(X.NOW))
    return valid, classified, master, after


@registered
def upsert_master(spark, sf_dir):
    after = _upsert(spark, sf_dir)[3]
    return plain(after.select("source", "rate_date", "series_id", "rate"))


@registered
def upsert_lineage(spark, sf_dir):
    return plain(_upsert(spark, sf_dir)[3])


@registered
def upsert_changes(spark, sf_dir):
    """Only the rows an upsert of four ordered runs writes."""
    classified, master = _ordered_runs(spark, sf_dir)
    candidates = U.last_candidates(C.upsert_candidates(classified), "run_id")
    return plain(U.master_changes(master, candidates, X.at(X.NOW)))


@registered
def upsert_overlay(spark, sf_dir):
    """Snapshot plus change log give the same master as the join-based upsert."""
    valid, master = X.loads(spark, sf_dir)
    candidates = C.upsert_candidates(C.classify(valid, master))
    log = U.master_changes(master, candidates, X.at(X.NOW)).withColumn("seq", F.lit(1))
    return plain(U.overlay(master, U.latest_changes(log, "seq")))


@registered
def upsert_summary(spark, sf_dir):
    valid, master = X.loads(spark, sf_dir)
    classified = C.classify(valid, master)
    changes = U.master_changes(master, C.upsert_candidates(classified), X.at(X.NOW))
    return U.upsert_summary(classified, changes)


@registered
def upsert_verify(spark, sf_dir):
    _, classified, _, after = _upsert(spark, sf_dir)
    return U.verify_against_master(C.upsert_candidates(classified), after)


@registered
def upsert_mismatches(spark, sf_dir):
    """Candidates that the master before the upsert lacks or holds differently."""
    valid, master = X.loads(spark, sf_dir)
    candidates = C.upsert_candidates(C.classify(valid, master)).drop("load_action")
    return plain(U.mismatches(candidates, master))


@registered
def reclassify_after_upsert(spark, sf_dir):
    valid, _, _, after = _upsert(spark, sf_dir)
    again = C.classify(valid, after)
    return again.groupBy("run_id").agg(F.count("*").alias("accepted_count"), *C.action_counts())


@registered
def changed_roundtrip(spark, sf_dir):
    """The first master row with a rate, changed by 0.01: CHANGED, and after its upsert UNCHANGED."""
    held = X.loads(spark, sf_dir)[1].where("rate is not null")
    original = S.preview(held, ["rate_date", "series_id"], 1)
    incoming = original.select(
        F.lit("t1").alias("run_id"),
        "source",
        "rate_date",
        "series_id",
        (F.col("rate") + F.expr("0.01BD")).cast("decimal(20,8)").alias("rate"),
    )
    first = C.classify(incoming, original, out="before_action")
    merged = U.upsert(original, incoming, X.at(X.NOW))
    return plain(C.classify(first, merged, out="after_action"))


# Reconciliation -------------------------------------------------------------


_RECORD = ("source_row_no", "series_id")


def _run_tables(spark, sf_dir):
    """Staging, exceptions and classified rows of four runs, and the master."""
    flags, master = X.multi_flags(spark, sf_dir)
    staging = X.stg_multi(spark, sf_dir)
    return staging, _exceptions(flags), C.classify(C.valid_by_flag(flags), master), master


def _counts(spark, sf_dir):
    *tables, _ = _run_tables(spark, sf_dir)
    return R.run_counts(*tables, F.struct(*_RECORD))


@registered
def reconcile_counts(spark, sf_dir):
    *tables, master = _run_tables(spark, sf_dir)
    return V.reconcile_counts(R.run_counts(*tables, F.struct(*_RECORD)), master)


@registered
def verify_master(spark, sf_dir):
    return U.verify_against_master(*X.loads(spark, sf_dir))


@registered
def verify_run(spark, sf_dir):
    """Closed runs checked for duplicate keys; some rows are doubled on purpose."""
    staging, exceptions, classified, master = _run_tables(spark, sf_dir)
    validated = cut_lineage(classified)
    counts = R.run_counts(staging, exceptions, validated, F.struct(*_RECORD))
    registry = X.run_registry(spark, sf_dir)
    closed = R.finalize(registry, counts, registry.select("run_id"), X.at(X.NOW))

    def doubled(df: DataFrame, every: int) -> DataFrame:
        return df.unionByName(df.where(F.col("source_row_no") % every == 0))

    return V.verify_runs(
        closed,
        doubled(staging, 50),
        doubled(exceptions, 40),
        doubled(validated, 30),
        master.unionByName(master.where("series_id = 'FXR000007'")),
        ("run_id", "source_row_no", "series_id"),
        ("run_id", "source_row_no", "series_id", "error_code"),
    )


# Registry and monitoring ----------------------------------------------------


@registered
def duplicate_sources(spark, sf_dir):
    return R.detect_duplicates(
        X.contents(spark, sf_dir).select("source", "source_fingerprint", "copies"),
        X.reg(spark, sf_dir),
    )


@registered
def work_list(spark, sf_dir):
    contents = X.contents(spark, sf_dir).select("source", "source_fingerprint", "copies")
    return R.work_list(contents, X.reg(spark, sf_dir))


@registered
def register_or_resume(spark, sf_dir):
    """All contents are landed again; the registry also knows runs of another source."""
    contents = X.contents(spark, sf_dir).withColumn(
        "source_url", F.concat(F.lit("again/"), F.col("source_url"))
    )
    known = X.reg(spark, sf_dir)
    old = known.withColumns({c: F.concat(F.lit("old-"), c) for c in ("source", "run_id")})
    registered_runs = R.register(contents, known.unionByName(old), X.at(X.NOW), F.lit("x1"))
    resolved = R.resolve(contents, registered_runs).select(
        *R.REGISTRY_KEY, F.col("should_process")
    )
    return plain(
        registered_runs.join(resolved, list(R.REGISTRY_KEY), "left").select(
            "run_id",
            "source",
            "source_fingerprint",
            "source_url",
            "execution_id",
            "status",
            "staged_count",
            "recorded_at",
            "last_attempt_at",
            "should_process",
        )
    )


@registered
def latest_run(spark, sf_dir):
    """Every content was attempted twice; the later attempt counts."""
    registry = X.reg(spark, sf_dir)
    retried = registry.where("run_id like '%7'").withColumns(
        {
            "run_id": F.concat(F.col("run_id"), F.lit("-retry")),
            "recorded_at": F.col("recorded_at") + F.expr("interval 1 day"),
        }
    )
    return plain(
        R.latest_runs(registry.unionByName(retried)).select(
            "source", "source_fingerprint", "run_id", "status", "recorded_at"
        )
    )


@registered
def finalize_run(spark, sf_dir):
    registry = X.run_registry(spark, sf_dir)
    return plain(
        R.finalize(
            registry, _counts(spark, sf_dir), registry.where("run_id <> 'r2'"), X.at(X.NOW)
        ).select("run_id", "source", "source_fingerprint", "status", *R.COUNTERS, "completed_at")
    )


@registered
def complete_run(spark, sf_dir):
    registry = X.run_registry(spark, sf_dir)
    asked = registry.where("run_id <> 'r2'").select("run_id")
    done = R.complete(registry, _counts(spark, sf_dir), asked, X.at(X.NOW))
    return plain(
        done.join(R.completion_check(done, registry), "run_id").select(
            "run_id", "status", *R.COUNTERS, "completed_at", "completed_rows", "completed"
        )
    )


@registered
def monitor_recent(spark, sf_dir):
    return plain(M.monitor_recent(X.reg(spark, sf_dir), "src3", 20))


@registered
def monitor_history(spark, sf_dir):
    return plain(M.monitor_history(X.reg(spark, sf_dir)))


@registered
def monitor_failures(spark, sf_dir):
    return plain(M.failed_runs(M.monitor_history(X.reg(spark, sf_dir))))


# Supplier drill -------------------------------------------------------------


def _drill(spark, sf_dir):
    """Registry, master and staging of the drill, one series per supplier."""
    series = X.drill_series(spark, sf_dir)
    empty = spark.createDataFrame([], R.REGISTRY_SCHEMA)
    registry = R.register(X.drill_contents(spark, sf_dir), empty, X.at(X.NOW))

    def run_of(fingerprint: str) -> Column:
        return R.run_id_of(F.lit(D.SOURCE), F.lit(fingerprint))

    master = D.drill_master(series, run_of(D.BASELINE_FINGERPRINT))
    stride = series.agg(F.max("s")).scalar()
    staging = D.drill_source(series, run_of(D.SUPPLIER_FINGERPRINT), stride)
    return registry, master, staging


def _drill_rows(spark, sf_dir):
    """Rows of the supplier's run and a master that holds a second source, stored as they lie ready in use."""
    registry, master, staging = _drill(spark, sf_dir)
    master = cut_lineage(master.unionByName(D.other_source(X.drill_series(spark, sf_dir))))
    registry, staging = cut_lineage(registry), cut_lineage(staging)
    which = (F.col("source") == D.SOURCE) & (F.col("source_fingerprint") == D.SUPPLIER_FINGERPRINT)
    return V.rows_of_runs(staging, registry, which), master


@registered
def drill_master(spark, sf_dir):
    return plain(_drill(spark, sf_dir)[1])


@registered
def drill_source(spark, sf_dir):
    return _drill(spark, sf_dir)[2]


@registered
def drill_seed_check(spark, sf_dir):
    return D.seed_check(*_drill(spark, sf_dir))


@registered
def drill_report(spark, sf_dir):
    return V.reconciliation_report(*_drill_rows(spark, sf_dir))


@registered
def drill_classify(spark, sf_dir):
    return plain(V.reconciled_rows(*_drill_rows(spark, sf_dir)))


@registered
def delete_by_source(spark, sf_dir):
    key = ["source", "rate_date", "series_id", "rate"]
    both = X.loads(spark, sf_dir)[1].select(*key).unionByName(_drill(spark, sf_dir)[1].select(*key))
    return plain(B.delete_source(both, D.SOURCE))


_ITEM = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _items(spark, sf_dir):
    """Line items; line number 7 is missing."""
    return X.table(spark, sf_dir, "lineitem").select(
        *[F.nullif("l_linenumber", F.lit(7)).alias(c) if c == "l_linenumber" else c for c in _ITEM]
    )


_ITEM_KEY = ["l_orderkey", "l_linenumber"]


@registered
def duplicate_keys(spark, sf_dir):
    return K.duplicate_keys(_items(spark, sf_dir), _ITEM_KEY)


@registered
def duplicate_rows(spark, sf_dir):
    return K.duplicate_rows(_items(spark, sf_dir), _ITEM_KEY)


@registered
def non_duplicate_rows(spark, sf_dir):
    return K.non_duplicate_rows(_items(spark, sf_dir), _ITEM_KEY)


@registered
def referential_invalid(spark, sf_dir):
    rows, members = X.orphans(spark, sf_dir)
    return K.referential_orphans(rows, members, "l_partkey")


@registered
def referential_clean(spark, sf_dir):
    rows, members = X.orphans(spark, sf_dir)
    clean = V.strict_types(K.referential_members(rows, members, "l_partkey"))
    return plain(clean.select("l_orderkey", "l_linenumber", "l_partkey", "rate_date", "rate"))


# Rollback -------------------------------------------------------------------

_BASE, _BAD = "r0", "r9"


def _bad_load(spark, sf_dir, with_new: bool):
    """Master after a base run and a bad run, and both runs' validated rows.

    The bad run changes every tenth row; with_new lets it also add rows.
    """
    base, master = X.loads(spark, sf_dir)
    tenth = F.col("source_row_no") % 10
    known = base.where(tenth != 0)
    loaded = U.upsert(master.where(F.lit(False)), known, X.at(X.LOADED))
    bad = (base if with_new else known).withColumns(
        {
            "run_id": F.lit(_BAD),
            "rate": F.when(tenth == 1, F.col("rate") + F.expr("0.01BD"))
            .otherwise(F.col("rate"))
            .cast("decimal(20,8)"),
        }
    )
    master = cut_lineage(U.upsert(loaded, bad, X.at(X.LOADED)))
    return master, known.unionByName(bad)


@registered
def rollback_restore(spark, sf_dir):
    master, validated = _bad_load(spark, sf_dir, with_new=True)
    return plain(B.restore(master, validated, _BAD, _BASE, X.at(X.NOW)))


@registered
def rollback_changes(spark, sf_dir):
    """Only the master rows the restore writes."""
    master, validated = _bad_load(spark, sf_dir, with_new=True)
    return plain(B.restored_rows(master, validated, _BAD, _BASE, X.at(X.NOW)))


@registered
def rollback_guard(spark, sf_dir):
    master, validated = _bad_load(spark, sf_dir, with_new=True)
    return B.rollback_guard(B.restore(master, validated, _BAD, _BASE, X.at(X.NOW)), _BAD)


@registered
def rollback_delete(spark, sf_dir):
    return B.delete_run(X.stg_multi(spark, sf_dir), "r2")


@registered
def rollback_report(spark, sf_dir):
    """Report on the first master key after restoring and deleting the bad run."""
    master, validated = _bad_load(spark, sf_dir, with_new=False)
    restored = B.restore(master, validated, _BAD, _BASE, X.at(X.NOW))
    first = S.preview(master.where("last_changed_run_id = 'r9'"), ["rate_date", "series_id"], 1)
    staging = X.stg(spark, sf_dir).unionByName(X.stg(spark, sf_dir, F.lit(_BAD)))
    exceptions = _exceptions(X.flags(spark, sf_dir))
    registry = X.run_registry(spark, sf_dir)
    report = B.rollback_report(
        B.delete_run(registry, _BAD),
        B.delete_run(staging, _BAD),
        B.delete_run(exceptions, _BAD),
        B.delete_run(validated, _BAD),
        restored,
        _BAD,
        {
            "rate_date": first.select("rate_date").scalar(),
            "series_id": first.select("series_id").scalar(),
        },
    )
    return plain(report)


# The whole load ---------------------------------------------------------------


def _loaded(spark, sf_dir) -> tuple[ControlledLoad, DataFrame]:
    """Two increments from two origins loaded one after the other; what a reload of the first gives."""
    first, second = X.increments(spark, sf_dir, shared_folder(spark, "landed"))
    state = store.StateStore(spark, shared_folder(spark, "state"))
    lake, shortcut = (ControlledLoad(spark, state, origin, "FX", now=X.at(X.NOW)) for origin in ("lake", "shortcut"))
    lake.load(f"{first}/*")
    shortcut.load(f"{second}/*")
    return lake, lake.load(f"{first}/*")


@registered
def controlled_load(spark, sf_dir):
    """Counters, count law and structural exceptions of every run, and what loading its file again gives."""
    load, again = _loaded(spark, sf_dir)
    file = F.regexp_extract("source_url", "file=([0-9]+)/", 1).cast("bigint").alias("file")
    unsound = load.table("structural_exceptions").groupBy("run_id").agg(F.count("*").alias("structural_count"))
    laws = load.history().select("run_id", "count_reconciliation")
    return (
        load.registry()
        .join(unsound, "run_id", "left")
        .join(laws, "run_id", "left")
        .join(again.select("run_id", F.col("outcome").alias("again")), "run_id", "left")
        .select(
            F.col("source").alias("origin"), file, "status", *R.COUNTERS,
            F.coalesce("structural_count", F.lit(0)).cast("bigint").alias("structural_count"),
            "count_reconciliation", "again",
        )
    )


@registered
def controlled_load_master(spark, sf_dir):
    """The master after both increments, with the origins that first brought and last changed a rate."""
    load, _ = _loaded(spark, sf_dir)
    runs = load.registry().select("run_id", F.col("source").alias("origin"))
    first, last = (runs.toDF(f"{of}_run_id", f"{of}_origin") for of in ("first_loaded", "last_changed"))
    return plain(
        load.master()
        .join(first, "first_loaded_run_id")
        .join(last, "last_changed_run_id")
        .select("source", "rate_date", "series_id", "rate", "first_loaded_origin", "last_changed_origin")
    )


@registered
def second_feed(spark, sf_dir):
    """Another feed's declared rules over raw line items: failures by code, and the valid rows' values."""
    flags = cut_lineage(Q.flag_rows(X.raw_items(spark, sf_dir), X.ITEM_FEED))
    texts = Q.exception_rows(flags, ["run_id", "l_orderkey", "l_linenumber"], X.ITEM_FEED.details)
    failed = texts.groupBy("error_code", "error_detail").agg(F.count("*").alias("row_count"))
    valid = flags.where("is_valid").agg(F.count("*").alias("row_count"), F.sum("parsed_quantity").alias("total"))
    return failed.withColumn("total", F.lit(None).cast("bigint")).unionByName(
        valid.select(F.lit("VALID").alias("error_code"), F.lit("").alias("error_detail"), "row_count", "total")
    )
