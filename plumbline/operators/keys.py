"""Business-key multiplicity, duplicates and referential membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import HOT_KEYS, HOT_ROWS, all_present, bounded_answers, heaviest, heavy_keys, lookup


def repeated_keys(df: DataFrame, keys: Sequence[str], count: str = "row_count") -> DataFrame:
    """Complete keys held by more than one row, with their row counts."""
    counts = df.where(all_present(keys)).groupBy(*keys).agg(F.count("*").alias(count))
    return counts.where(F.col(count) > 1)


def key_multiplicity(
    df: DataFrame,
    keys: Sequence[str],
    out: str = "business_key_count",
    repeated: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Rows per key on every row; 0 where the key is incomplete.

    A window would sort each key's rows into one task.  Counting first combines
    map-side, leaves only the repeated keys to look up, and lets rows without a
    complete key stay out.  `repeated` may pass in repeated keys counted before.
    """
    if repeated is None:
        repeated = repeated_keys(df, keys, "_n")
    else:
        repeated = repeated.select(*keys, F.col("row_count").alias("_n"))
    answers = heaviest(repeated, "_n", hot_rows, hot_keys).select(
        *keys, F.struct(*repeated.columns).alias("_answer")
    )
    tagged = lookup(df, repeated, keys, answers, "_repeated")
    return tagged.select(
        *df.columns,
        F.when(all_present(keys), F.coalesce(F.col("_repeated._n"), F.lit(1)))
        .otherwise(0)
        .cast("bigint")
        .alias(out),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; missing key parts group together."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def duplicate_rows(df: DataFrame, keys: Sequence[str], **hot: int) -> DataFrame:
    """Every copy of a repeated key.  Rows with a missing key part never qualify."""
    return key_multiplicity(df, keys, "_n", **hot).where("_n > 1").drop("_n")


def non_duplicate_rows(df: DataFrame, keys: Sequence[str], **hot: int) -> DataFrame:
    """Rows of no repeated key, rows with a missing key part included."""
    return key_multiplicity(df, keys, "_n", **hot).where("_n <= 1").drop("_n")


def duplicate_count(*keys: str):
    """Aggregate: rows beyond the first of each key, missing key parts compared as values."""
    return F.count("*") - F.count_distinct(F.struct(*keys))


def dimension(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(column).distinct()


def _with_membership(
    df: DataFrame, members: DataFrame, column: str, hot_rows: int, hot_keys: int
) -> DataFrame:
    hot = heavy_keys(df, [column], hot_rows, hot_keys)
    members = dimension(members, column)  # a repeated member must not repeat rows
    return lookup(df, members, [column], bounded_answers(hot, members, [column]), "_member")


def referential_orphans(
    df: DataFrame,
    members: DataFrame,
    column: str,
    hot_rows: int = HOT_ROWS,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Rows whose value is missing or not among the members."""
    return _with_membership(df, members, column, hot_rows, hot_keys).where(
        F.col("_member").isNull()
    ).drop("_member")


def referential_members(
    df: DataFrame,
    members: DataFrame,
    column: str,
    hot_rows: int = HOT_ROWS,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Rows whose value is among the members."""
    return _with_membership(df, members, column, hot_rows, hot_keys).where(
        F.col("_member").isNotNull()
    ).drop("_member")
