"""Change classification of valid rows against a keyed master."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import cut_lineage

# Class labels of a load and of a two-sided reconciliation.
LOAD_ACTIONS = ("NEW", "CHANGED", "UNCHANGED")
RECONCILE_LABELS = ("SOURCE_ONLY", "CHANGED", "UNCHANGED")

MASTER_KEY = ("source", "rate_date", "series_id")
VALUES = ("rate",)


def differs(left: str, right: str, values: Sequence[str]) -> Column:
    """Null-safe inequality of any value column."""
    return reduce(
        lambda a, b: a | b, (~F.col(f"{left}.{v}").eqNullSafe(F.col(f"{right}.{v}")) for v in values)
    )


def valid_by_flag(flags: DataFrame) -> DataFrame:
    """Typed rows that passed every rule."""
    return flags.where("is_valid").select(
        "run_id",
        "source",
        "source_row_no",
        F.col("parsed_date").alias("rate_date"),
        F.col("clean_series").alias("series_id"),
        F.col("parsed_rate").alias("rate"),
    )


def valid_by_exceptions(
    typed: DataFrame, exceptions: DataFrame, record_key: Sequence[str]
) -> DataFrame:
    """Typed rows that no exception names; missing key parts compare as equal."""
    t, e = typed.alias("t"), exceptions.alias("e")
    same = reduce(
        lambda a, b: a & b, (F.col(f"t.{k}").eqNullSafe(F.col(f"e.{k}")) for k in record_key)
    )
    return t.join(e, same, "left_anti").select(
        "run_id",
        "source",
        "source_row_no",
        F.col("parsed_date").alias("rate_date"),
        F.col("clean_series").alias("series_id"),
        F.col("parsed_rate").alias("rate"),
    )


def _with_master(
    valid: DataFrame, master: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Valid rows plus the master's values as struct `m`; NULL where the key is absent.

    Presence is the struct itself, so a master row with NULL values still counts
    as present.
    """
    known = master.select(*keys, F.struct(F.lit(True).alias("present"), *values).alias("m"))
    return valid.join(known, list(keys), "left").select(*valid.columns, "m")


def classify(
    valid: DataFrame,
    master: DataFrame,
    keys: Sequence[str] = MASTER_KEY,
    values: Sequence[str] = VALUES,
    labels: Sequence[str] = LOAD_ACTIONS,
    out: str = "load_action",
) -> DataFrame:
    """Absent from the master, different from it, or equal to it."""
    new, changed, unchanged = labels
    held = F.struct(*[F.col(f"m.{v}") for v in values])
    action = (
        F.when(F.col("m").isNull(), new)
        .when(~F.struct(*values).eqNullSafe(held), changed)
        .otherwise(unchanged)
    )
    return _with_master(valid, master, keys, values).withColumn(out, action).drop("m")


def carried_in_ranges(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Rows in ranges of (keys, order), kept, with the values that the row before brings.

    Adds `_part` (the range), `_nth` (place in it, from 0), `_ends` (whether it is the
    range's last row) and `_before`: the values of the row before as a struct, NULL where
    that one has other keys or lies in an earlier range.  Keys lie in the order of their
    hash, which mostly decides a comparison at once.  Each range is sorted and read once
    as a stream that holds two batches; a key with very many rows takes several ranges.
    Missing key parts compare as equal; keys of floating numbers aren't meant.
    """
    held = T.StructType([T.StructField("present", T.BooleanType()), *[T.StructField(v, df.schema[v].dataType) for v in values]])
    added = [
        T.StructField("_part", T.IntegerType()),
        T.StructField("_nth", T.LongType()),
        T.StructField("_before", held),
        T.StructField("_ends", T.BooleanType()),
    ]
    columns, keys, values = df.columns, list(keys), list(values)
    names = [*columns, "_part", "_nth", "_before", "_ends"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nth, ready = None, 0, None

        def marked(ends: bool) -> Iterator[pa.RecordBatch]:
            if ready is not None:
                mark = np.zeros(len(ready[0]), bool)
                mark[-1] = ends
                yield pa.RecordBatch.from_arrays([*ready, pa.array(mark)], names=names)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            seen = pa.Table.from_batches([batch] if last is None else [last, batch])
            skip = seen.num_rows - n
            place = np.arange(skip, skip + n)
            known = place > 0
            previous = pa.array(place - 1, pa.int64(), mask=~known)
            same = known
            for k in keys:
                whole = seen.column(k).combine_chunks()
                here, there = whole.slice(skip), whole.take(previous)
                equal = pc.or_(pc.fill_null(pc.equal(here, there), False), pc.and_(here.is_null(), there.is_null()))
                same = same & equal.to_numpy(zero_copy_only=False)
            brought = [seen.column(v).combine_chunks().take(previous) for v in values]
            before = pa.StructArray.from_arrays(
                [pa.array(np.ones(n, bool)), *brought], names=["present", *values], mask=pa.array(~same)
            )
            numbers = pa.array(np.arange(nth, nth + n, dtype=np.int64))
            yield from marked(False)
            ready = [*(batch.column(c) for c in columns), batch.column("_part"), numbers, before]
            last, nth = batch.slice(n - 1), nth + n
        yield from marked(True)

    by = ("_hash", *keys, order)
    ranges = df.withColumn("_hash", F.xxhash64(*keys)).repartitionByRange(*by).sortWithinPartitions(*by).drop("_hash")
    numbered = ranges.withColumn("_part", F.spark_partition_id())
    return cut_lineage(numbered.mapInArrow(work, T.StructType([*df.schema.fields, *added])))


def with_previous(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Adds `_before`: the values of the same key's previous row by `order`, NULL if it is the first.

    What a range ends with goes on to the next one; there is one such row per range, which
    bounds the broadcast.
    """
    rows = carried_in_ranges(df, keys, order, values)
    ends = rows.where("_ends").select("_part", F.struct(*keys, *values).alias("_end"))
    following = F.lead("_part").over(Window.partitionBy(F.lit(0)).orderBy("_part"))
    ends = ends.select(following.alias("_part"), "_end").where("_part is not null").withColumn("_nth", F.lit(0).cast("bigint"))
    goes_on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col("_end")[k]) for k in keys))
    handed = F.when(
        F.col("_end").isNotNull() & goes_on,
        F.struct(F.lit(True).alias("present"), *[F.col("_end")[v].alias(v) for v in values]),
    )
    joined = rows.join(F.broadcast(ends), ["_part", "_nth"], "left")
    return joined.select(*df.columns, F.coalesce("_before", handed).alias("_before"))


def classify_in_order(
    valid: DataFrame,
    master: DataFrame,
    order: str,
    keys: Sequence[str] = MASTER_KEY,
    values: Sequence[str] = VALUES,
    out: str = "load_action",
) -> DataFrame:
    """Classify many runs in one job as if they were loaded one after the other.

    A row compares with the same key's previous run in the batch.  Only the first row
    of a key meets the master, so however often a key occurs, that join has it once.
    Valid rows are unique per run and key.
    """
    _, changed, unchanged = LOAD_ACTIONS
    rows = with_previous(valid, keys, order, values)
    held = F.struct(*[F.col("_before")[v].alias(v) for v in values])
    later = rows.where("_before is not null").withColumn(
        out, F.when(~F.struct(*values).eqNullSafe(held), changed).otherwise(unchanged)
    )
    first = classify(rows.where("_before is null").drop("_before"), master, keys, values, out=out)
    return first.unionByName(later.drop("_before"))


def first_classifications(
    classified: DataFrame, existing: DataFrame, record_key: Sequence[str]
) -> DataFrame:
    """Classified rows to append: those whose record has no classification yet."""
    c, e = classified.alias("c"), existing.alias("e")
    same = reduce(
        lambda a, b: a & b, (F.col(f"c.{k}").eqNullSafe(F.col(f"e.{k}")) for k in record_key)
    )
    return c.join(e, same, "left_anti")


def sticky_classifications(
    classified: DataFrame, existing: DataFrame, record_key: Sequence[str]
) -> DataFrame:
    """All classifications after the load; the first one of a record stays."""
    return existing.unionByName(first_classifications(classified, existing, record_key))


def action_counts(action: str = "load_action") -> list[Column]:
    """Aggregates: rows per load action."""
    new, changed, unchanged = LOAD_ACTIONS
    return [
        F.count_if(F.col(action) == new).alias("new_count"),
        F.count_if(F.col(action) == changed).alias("changed_count"),
        F.count_if(F.col(action) == unchanged).alias("unchanged_count"),
    ]


def classification_summary(persisted: DataFrame, inserted: DataFrame) -> DataFrame:
    """Accepted rows per action and newly classified rows, per run."""
    totals = persisted.groupBy("run_id").agg(F.count("*").alias("accepted_count"), *action_counts())
    new = inserted.groupBy("run_id").agg(F.count("*").alias("_new"))
    return (
        totals.join(new, "run_id", "left")
        .withColumn("newly_classified_count", F.coalesce("_new", F.lit(0)).cast("bigint"))
        .drop("_new")
    )


def upsert_candidates(validated: DataFrame, run_id: str | None = None) -> DataFrame:
    """New and changed rows, of one run or of all."""
    new, changed, _ = LOAD_ACTIONS
    rows = validated.where(F.col("load_action").isin(new, changed))
    return rows if run_id is None else rows.where(F.col("run_id") == run_id)
