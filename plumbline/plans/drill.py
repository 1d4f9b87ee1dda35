"""Deterministic supplier drill: a master and a source run with known answers.

Both tables grow from a DataFrame of series numbers (`s`), each number giving
its own days, so generation is one narrow pass.  With 1,000 series the drill
has 250,000 master and 300,000 source rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOURCE = "SUPPLIER_DRILL"
# Fingerprints and addresses of the two synthetic runs.
BASELINE_FINGERPRINT = "a" * 64
SUPPLIER_FINGERPRINT = "b" * 64
BASELINE_URL = "synthetic://supplier-drill/master-250k"
SUPPLIER_URL = "synthetic://supplier-drill/source-300k"


@dataclass(frozen=True)
class DrillDays:
    """Days of each cohort; the master covers the first four."""

    unchanged: int = 210
    changed: int = 25
    duplicated: int = 5
    hidden: int = 10
    source_only: int = 45
    invalid: int = 10

    @property
    def master(self) -> int:
        return self.unchanged + self.changed + self.duplicated + self.hidden

    @property
    def blocks(self) -> int:
        """Source rows per series."""
        return (
            self.unchanged + self.changed + 2 * self.duplicated + self.source_only + self.invalid
        )


def _rate(day: Column, series: Column) -> Column:
    cents = F.lit(1) + day * F.expr("0.0001BD") + series * F.expr("0.000001BD")
    return cents.cast("decimal(20,8)")


def _date(day: Column) -> Column:
    return F.date_add(F.lit("2025-01-01").cast("date"), day)


def _series_id(prefix: Column | str, series: Column) -> Column:
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    text = series.cast("string")
    return F.concat(prefix, F.lpad(text, F.greatest(F.length(text), F.lit(6)), F.lit("0")))


def drill_master(series: DataFrame, run_id: Column, days: DrillDays = DrillDays()) -> DataFrame:
    """One master row per series and day."""
    return series.select(
        "s", F.explode(F.sequence(F.lit(0), F.lit(days.master - 1))).alias("d")
    ).select(
        F.lit(SOURCE).alias("source"),
        _date(F.col("d")).alias("rate_date"),
        _series_id("FXR", F.col("s")).alias("series_id"),
        _rate(F.col("d"), F.col("s")).alias("rate"),
        run_id.alias("first_loaded_run_id"),
        run_id.alias("last_changed_run_id"),
    )


def other_source(series: DataFrame, day: int = 295) -> DataFrame:
    """Master rows of another source under the series that the supplier sends by mistake."""
    return series.select(
        F.lit("OTHER").alias("source"),
        _date(F.lit(day)).alias("rate_date"),
        _series_id("BAD", F.col("s")).alias("series_id"),
        F.lit(1).cast("decimal(20,8)").alias("rate"),
        F.lit("other").alias("first_loaded_run_id"),
        F.lit("other").alias("last_changed_run_id"),
    )


def drill_source(
    series: DataFrame, run_id: Column, stride: Column, days: DrillDays = DrillDays()
) -> DataFrame:
    """Source rows in blocks of one day: six cohorts, unique row numbers.

    Block by block: unchanged days, changed days, duplicated days twice, days
    beyond the master, and days of unknown series.  `stride` is the number of
    series, so block b holds row numbers b * stride + 1 and on.
    """
    first_changed = days.unchanged
    first_copy = first_changed + days.changed + days.duplicated
    first_beyond = first_copy + days.duplicated
    first_invalid = first_beyond + days.source_only
    block = F.col("b")
    day = (
        F.when(block < first_copy, block)
        .when(block < first_beyond, block - days.duplicated)
        .otherwise(block - first_beyond + days.master)
    )
    is_changed = (block >= first_changed) & (block < first_changed + days.changed)
    rate = _rate(F.col("d"), F.col("s")) + F.when(is_changed, F.expr("0.01BD")).otherwise(
        F.expr("0.00BD")
    )
    prefix = F.when(block < first_invalid, "FXR").otherwise("BAD")
    return (
        series.select("s", F.explode(F.sequence(F.lit(0), F.lit(days.blocks - 1))).alias("b"))
        .withColumn("d", day)
        .select(
            run_id.alias("run_id"),
            (block * stride + F.col("s")).cast("bigint").alias("source_row_no"),
            F.date_format(_date(F.col("d")), "dd-MMM-yyyy").alias("raw_rate_date"),
            _series_id(prefix, F.col("s")).alias("series_id"),
            rate.cast("decimal(20,8)").cast("string").alias("raw_rate"),
            F.lit(SOURCE).alias("source"),
        )
    )


def seed_check(registry: DataFrame, master: DataFrame, staging: DataFrame) -> DataFrame:
    """Run ids of the two synthetic runs, and the rows loaded for them."""
    runs = registry.where(F.col("source") == SOURCE)

    def run_of(fingerprint: str) -> Column:
        return F.max(F.when(F.col("source_fingerprint") == fingerprint, F.col("run_id")))

    supplier = runs.where(F.col("source_fingerprint") == SUPPLIER_FINGERPRINT).select("run_id")
    return runs.agg(
        run_of(BASELINE_FINGERPRINT).alias("baseline_run_id"),
        run_of(SUPPLIER_FINGERPRINT).alias("supplier_run_id"),
    ).select(
        "baseline_run_id",
        "supplier_run_id",
        master.where(F.col("source") == SOURCE).agg(F.count("*")).scalar().alias("master_rows"),
        staging.join(supplier, "run_id").agg(F.count("*")).scalar().alias("supplier_rows"),
    )
