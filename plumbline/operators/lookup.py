"""Lookups that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is heavy from HOT_ROWS rows on; at most HOT_KEYS of them, the heaviest,
# are ever broadcast, so the broadcast side has a fixed bound at any data size
# and every other key holds at most a HOT_KEYS-th of the rows.
HOT_ROWS = 100_000
HOT_KEYS = 10_000


def all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))


def heaviest(counts: DataFrame, count: str, hot_rows: int, hot_keys: int) -> DataFrame:
    """The heaviest of already counted keys, never more than `hot_keys` rows; ties go by key."""
    keys = [c for c in counts.columns if c != count]
    return counts.where(F.col(count) >= hot_rows).orderBy(F.desc(count), *keys).limit(hot_keys)


def heavy_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """Keys that hold very many rows; counting combines map-side first."""
    counts = df.where(all_present(keys)).groupBy(*keys).agg(F.count("*").alias("_rows"))
    return heaviest(counts, "_rows", hot_rows, hot_keys).select(*keys)


def bounded_answers(hot: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each hot key the matching row of `right`, or NULL; as many rows as `hot`.

    `hot` is the broadcast side, so `right` is filtered where it lies.
    """
    found = right.join(F.broadcast(hot), list(keys)).select(
        *keys, F.struct(*right.columns).alias("_answer")
    )
    return hot.join(F.broadcast(found), list(keys), "left")


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    answers: DataFrame,
    into: str = "match",
) -> DataFrame:
    """Left rows plus `into`: the matching right row as a struct, or NULL.

    `right` is unique on `keys`, compared by plain equality; `answers` gives the
    result (`_answer`) for a bounded number of hot keys.  Their rows are served by
    a broadcast of that bounded set.  All other rows meet `right` in an ordinary
    join that Spark may plan by size; there, hot rows and rows without a
    complete key carry the id of the input partition as an extra join key, so
    they spread evenly, match nothing and never pile up in one task.  The
    partition id does not change when a task is run again.
    """
    names = left.columns
    keys = list(keys)
    answers = answers.select(*keys, F.lit(True).alias("_hot"), "_answer")
    found = right.select(
        *keys, F.lit(0).alias("_spread"), F.struct(*right.columns).alias("_found")
    )
    tagged = left.join(F.broadcast(answers), keys, "left").withColumn(
        "_spread",
        F.when(
            F.col("_hot").isNotNull() | ~all_present(keys), F.spark_partition_id() + 1
        ).otherwise(0),
    )
    return tagged.join(found, [*keys, "_spread"], "left").select(
        *names, F.when(F.col("_hot"), F.col("_answer")).otherwise(F.col("_found")).alias(into)
    )
