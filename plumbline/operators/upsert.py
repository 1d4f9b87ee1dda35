"""Conditional upsert with run lineage, and its verification.

A plain file table has no MERGE, so an upsert is a join.  `master_changes`
yields only the rows to write (for an append-only change log), `upsert` the
whole next snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classify import MASTER_KEY, VALUES, action_counts, classify

LINEAGE = ("first_loaded_run_id", "last_changed_run_id", "updated_at")


def last_candidates(
    candidates: DataFrame,
    order: str,
    keys: Sequence[str] = MASTER_KEY,
    values: Sequence[str] = VALUES,
    runs: DataFrame | None = None,
) -> DataFrame:
    """One candidate per key when several runs are loaded together.

    The last run gives values and `run_id`; `first_run_id` is the first run's.  Where
    the order is a number of the run, `runs` (order, run_id) lets rows combine by fixed
    width, without a sort, and gives the ids afterwards.
    """
    if runs is not None:
        found = candidates.groupBy(*keys).agg(
            F.max(order).alias("_to"), F.min(order).alias("_from"), *[F.max_by(v, order).alias(v) for v in values]
        )
        last, first = (runs.select(F.col(order).alias(at), F.col("run_id").alias(out)) for at, out in (("_to", "run_id"), ("_from", "first_run_id")))
        return found.join(last, "_to").join(first, "_from").select(*keys, "run_id", *values, "first_run_id")
    return (
        candidates.groupBy(*keys)
        .agg(
            F.max_by(F.struct("run_id", *values), order).alias("_last"),
            F.min_by("run_id", order).alias("first_run_id"),
        )
        .select(*keys, "_last.*", "first_run_id")
    )


def _first_run(candidates: DataFrame) -> Column:
    return F.col("c.first_run_id") if "first_run_id" in candidates.columns else F.col("c.run_id")


def master_changes(
    master: DataFrame,
    candidates: DataFrame,
    now: Column,
    keys: Sequence[str] = MASTER_KEY,
    values: Sequence[str] = VALUES,
) -> DataFrame:
    """After-images of the master rows an upsert writes: absent keys and real changes."""
    held = master.select(
        *keys, F.struct(*values, "first_loaded_run_id").alias("m")
    )
    joined = candidates.alias("c").join(held, list(keys), "left")
    same = F.struct(*[F.col(f"c.{v}") for v in values]).eqNullSafe(
        F.struct(*[F.col(f"m.{v}") for v in values])
    )
    first = F.when(F.col("m").isNull(), _first_run(candidates)).otherwise(
        F.col("m.first_loaded_run_id")
    )
    return joined.where(F.col("m").isNull() | ~same).select(
        *keys,
        *[F.col(f"c.{v}").alias(v) for v in values],
        first.alias("first_loaded_run_id"),
        F.col("c.run_id").alias("last_changed_run_id"),
        now.alias("updated_at"),
    )


def upsert(
    master: DataFrame,
    candidates: DataFrame,
    now: Column,
    keys: Sequence[str] = MASTER_KEY,
    values: Sequence[str] = VALUES,
) -> DataFrame:
    """Next master snapshot: absent keys inserted, values replaced only on a real change.

    One full outer join on the unique business key; unchanged rows keep their
    lineage and time stamp.
    """
    old = master.select(*keys, F.struct(*values, *LINEAGE).alias("m"))
    new = candidates.alias("c").select(
        *keys,
        F.struct(
            *values,
            F.col("run_id").alias("last_changed_run_id"),
            _first_run(candidates).alias("first_loaded_run_id"),
        ).alias("c"),
    )
    same = F.struct(*[F.col(f"c.{v}") for v in values]).eqNullSafe(
        F.struct(*[F.col(f"m.{v}") for v in values])
    )
    write = F.col("c").isNotNull() & (F.col("m").isNull() | ~same)

    def pick(name: str, written: Column) -> Column:
        return F.when(write, written).otherwise(F.col(f"m.{name}")).alias(name)

    return old.join(new, list(keys), "full_outer").select(
        *keys,
        *[pick(v, F.col(f"c.{v}")) for v in values],
        pick(
            "first_loaded_run_id",
            F.when(F.col("m").isNull(), F.col("c.first_loaded_run_id")).otherwise(
                F.col("m.first_loaded_run_id")
            ),
        ),
        pick("last_changed_run_id", F.col("c.last_changed_run_id")),
        pick("updated_at", now),
    )


def overlay(
    snapshot: DataFrame, changes: DataFrame, keys: Sequence[str] = MASTER_KEY
) -> DataFrame:
    """Snapshot with the rows of `changes` (unique per key) put in place of its own."""
    columns = snapshot.columns
    kept = snapshot.join(changes.select(*keys), list(keys), "left_anti")
    return kept.select(*columns).unionByName(changes.select(*columns))


def latest_changes(log: DataFrame, order: str, keys: Sequence[str] = MASTER_KEY) -> DataFrame:
    """The last after-image of each key in a change log."""
    others = [c for c in log.columns if c not in (*keys, order)]
    return (
        log.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), order).alias("_row"))
        .select(*keys, "_row.*")
    )


def upsert_summary(validated: DataFrame, changes: DataFrame) -> DataFrame:
    """Per run: rows per action from the classification, writes from the upsert itself."""
    actions = validated.groupBy("run_id").agg(*action_counts())
    writes = changes.groupBy(F.col("last_changed_run_id").alias("run_id")).agg(
        F.count("*").alias("_writes")
    )
    return (
        actions.join(writes, "run_id", "left")
        .withColumn("writes_applied", F.coalesce("_writes", F.lit(0)).cast("bigint"))
        .drop("_writes")
    )


def mismatches(
    rows: DataFrame,
    master: DataFrame,
    keys: Sequence[str] = MASTER_KEY,
    values: Sequence[str] = VALUES,
) -> DataFrame:
    """Rows missing from the master or different in it; none after a sound upsert."""
    return classify(rows, master, keys, values, ("MISSING", "DIFFERENT", "EQUAL"), "_state").where(
        "_state <> 'EQUAL'"
    ).withColumnRenamed("_state", "mismatch")


def verify_against_master(
    rows: DataFrame,
    master: DataFrame,
    keys: Sequence[str] = MASTER_KEY,
    values: Sequence[str] = VALUES,
) -> DataFrame:
    """One verdict row: how many rows were checked, and how many mismatch."""
    states = classify(rows, master, keys, values, ("MISSING", "DIFFERENT", "EQUAL"), "_state")
    return states.agg(
        F.count("*").alias("checked_rows"),
        F.count_if(F.col("_state") == "MISSING").alias("missing_rows"),
        F.count_if(F.col("_state") == "DIFFERENT").alias("different_rows"),
        (F.count_if(F.col("_state") != "EQUAL") == 0).alias("passed"),
    )
