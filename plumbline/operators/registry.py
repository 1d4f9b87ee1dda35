"""Run registry: one row per distinct content of a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classify import action_counts

# Run states.
OPEN = "RUNNING"
DONE = "SUCCESS"
SKIPPED = "SKIPPED"

REGISTRY_KEY = ("source", "source_fingerprint")
REGISTRY_SCHEMA = (
    "run_id string, source string, source_fingerprint string, source_url string, "
    "execution_id string, status string, source_row_count bigint, staged_count bigint, "
    "valid_count bigint, invalid_count bigint, new_count bigint, changed_count bigint, "
    "unchanged_count bigint, recorded_at timestamp, last_attempt_at timestamp, "
    "completed_at timestamp"
)
COUNTERS = (
    "source_row_count", "staged_count", "valid_count", "invalid_count",
    "new_count", "changed_count", "unchanged_count",
)


def run_id_of(source: Column, fingerprint: Column) -> Column:
    """Run id that every retry of the same content computes again."""
    return F.substr(F.sha2(F.concat_ws("|", source, fingerprint), 256), F.lit(1), F.lit(32))


def distinct_contents(files: DataFrame) -> DataFrame:
    """Files grouped by origin and fingerprint; copies combine before the shuffle.

    `files` has source (the physical origin), source_fingerprint and source_url.
    """
    return files.groupBy(*REGISTRY_KEY).agg(
        F.count("*").alias("copies"), F.min("source_url").alias("source_url")
    )


def detect_duplicates(contents: DataFrame, registry: DataFrame) -> DataFrame:
    """Successful runs of each content; content without one is to be processed."""
    done = (
        registry.where(F.col("status") == DONE)
        .groupBy(*REGISTRY_KEY)
        .agg(F.count("*").alias("_runs"))
    )
    return (
        contents.join(done, list(REGISTRY_KEY), "left")
        .withColumn("successful_runs", F.coalesce("_runs", F.lit(0)).cast("bigint"))
        .drop("_runs")
        .withColumn("should_process", F.col("successful_runs") == 0)
        .withColumn("outcome", F.when(F.col("should_process"), OPEN).otherwise(SKIPPED))
    )


def work_list(contents: DataFrame, registry: DataFrame) -> DataFrame:
    """Contents that no successful run covers."""
    done = registry.where(F.col("status") == DONE).select(*REGISTRY_KEY)
    return contents.join(done, list(REGISTRY_KEY), "left_anti")


def register(
    contents: DataFrame, registry: DataFrame, now: Column, execution_id: Column | None = None
) -> DataFrame:
    """Next registry: unseen contents open a run, seen ones note the new attempt."""
    execution_id = F.lit(None).cast("string") if execution_id is None else execution_id
    key = list(REGISTRY_KEY)
    known = registry.select(
        *key, F.struct(*[c for c in registry.columns if c not in key]).alias("r")
    )
    seen = contents.select(*key, F.struct("source_url").alias("c"))
    joined = known.join(seen, key, "full_outer")
    is_new, touched = F.col("r").isNull(), F.col("c").isNotNull()
    changed = {
        "run_id": F.when(is_new, run_id_of(F.col("source"), F.col("source_fingerprint"))),
        "status": F.when(is_new, F.lit(OPEN)),
        "recorded_at": F.when(is_new, now),
        "source_url": F.when(touched, F.col("c.source_url")),
        "execution_id": F.when(touched, execution_id),
        "last_attempt_at": F.when(touched, now),
    }
    overwritten = ("source_url", "execution_id", "last_attempt_at")

    def pick(name: str) -> Column:
        old = F.col(f"r.{name}")
        if name not in changed:
            return old.alias(name)
        if name in overwritten:
            return F.when(touched, changed[name]).otherwise(old).alias(name)
        return F.coalesce(old, changed[name]).alias(name)

    return joined.select(*[F.col(c) if c in key else pick(c) for c in registry.columns])


def resolve(contents: DataFrame, registered: DataFrame) -> DataFrame:
    """The run of each content after registering, and whether to process it."""
    runs = registered.select(*REGISTRY_KEY, "run_id", "status")
    return (
        contents.select(*REGISTRY_KEY)
        .join(runs, list(REGISTRY_KEY))
        .withColumn("should_process", F.col("status") != DONE)
    )


def latest_runs(registry: DataFrame) -> DataFrame:
    """The most recently recorded run of each content, combined map-side."""
    others = [c for c in registry.columns if c not in REGISTRY_KEY]
    latest = F.max_by(F.struct(*others), F.struct("recorded_at", "run_id"))
    return registry.groupBy(*REGISTRY_KEY).agg(latest.alias("_run")).select(*REGISTRY_KEY, "_run.*")


def run_counts(
    staging: DataFrame, exceptions: DataFrame, validated: DataFrame, record: Column
) -> DataFrame:
    """The seven counters of every run; each table is aggregated once by run."""
    staged = staging.groupBy("run_id").agg(
        F.count_distinct("source_row_no").alias("source_row_count"),
        F.count("*").alias("staged_count"),
    )
    invalid = exceptions.groupBy("run_id").agg(F.count_distinct(record).alias("invalid_count"))
    valid = validated.groupBy("run_id").agg(F.count("*").alias("valid_count"), *action_counts())
    joined = staged.join(invalid, "run_id", "full_outer").join(valid, "run_id", "full_outer")
    return joined.select(
        "run_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTERS]
    )


def finalize(registry: DataFrame, counts: DataFrame, run_ids: DataFrame, now: Column) -> DataFrame:
    """Next registry: the named runs become SUCCESS with their counters.

    A run without rows counts 0 everywhere; the first completion time stays.
    """
    return _close(registry, counts, run_ids, now, F.lit(True))


def complete(registry: DataFrame, counts: DataFrame, run_ids: DataFrame, now: Column) -> DataFrame:
    """Like `finalize`, but only an open run changes."""
    return _close(registry, counts, run_ids, now, F.col("status") == OPEN)


def _close(
    registry: DataFrame, counts: DataFrame, run_ids: DataFrame, now: Column, allowed: Column
) -> DataFrame:
    named = run_ids.select("run_id").distinct().join(counts, "run_id", "left")
    packed = named.select("run_id", F.struct(*COUNTERS).alias("_counts"))
    closes = F.col("_counts").isNotNull() & allowed
    new = {
        "status": F.lit(DONE),
        "completed_at": F.coalesce(F.col("completed_at"), now),
        **{c: F.coalesce(F.col(f"_counts.{c}"), F.lit(0)).cast("bigint") for c in COUNTERS},
    }
    return registry.join(packed, "run_id", "left").select(
        *[
            F.when(closes, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
            for c in registry.columns
        ]
    )


def completion_check(registry: DataFrame, run_ids: DataFrame) -> DataFrame:
    """Per named run: is exactly one registry row of it complete?"""
    done = registry.groupBy("run_id").agg(F.count_if(F.col("status") == DONE).alias("_done"))
    return (
        run_ids.select("run_id").distinct()
        .join(done, "run_id", "left")
        .select("run_id", F.coalesce("_done", F.lit(0)).cast("bigint").alias("completed_rows"))
        .withColumn("completed", F.col("completed_rows") == 1)
    )
