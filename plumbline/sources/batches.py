"""JSON array batches decoded into typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The record definition of a staging batch.
BATCH_SCHEMA = T.StructType(
    [
        T.StructField("source_row_no", T.IntegerType()),
        T.StructField("raw_rate_date", T.StringType()),
        T.StructField("series_id", T.StringType()),
        T.StructField("raw_rate", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


def decode_batch(
    df: DataFrame, json: str, schema: T.StructType = BATCH_SCHEMA, strict: bool = False
) -> DataFrame:
    """One row per array element, in order, with the batch's other columns.

    Elements are read as text and then cast safely, so a badly typed field is
    seen: its name goes to `bad_fields`.  A batch that is no JSON array gives one
    row with `bad_fields` = [json column].  Strict mode raises on either.
    """
    others = [c for c in df.columns if c != json]
    as_text = T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in schema]))
    rows = df.withColumn("_items", F.from_json(json, as_text)).select(
        *others,
        (F.col("_items").isNull() & F.col(json).isNotNull()).alias("_unreadable"),
        F.posexplode_outer("_items").alias("_pos", "_item"),
    )

    def bad(field: T.StructField) -> Column:
        text = F.col("_item")[field.name]
        return text.isNotNull() & text.try_cast(field.dataType).isNull()

    bad_fields = F.array_compact(
        F.array(
            F.when(F.col("_unreadable"), F.lit(json)),
            *[F.when(bad(f), F.lit(f.name)) for f in schema],
        )
    )
    out = rows.where(F.col("_pos").isNotNull() | F.col("_unreadable")).select(
        *others,
        (F.col("_pos") + 1).cast("bigint").alias("ordinal"),
        *[F.col("_item")[f.name].try_cast(f.dataType).alias(f.name) for f in schema],
        bad_fields.alias("bad_fields"),
    )
    if strict:
        out = out.withColumn(
            "bad_fields",
            F.when(F.size("bad_fields") == 0, F.col("bad_fields")).otherwise(
                F.raise_error(
                    F.concat(F.lit("badly typed batch element: "), F.array_join("bad_fields", ", "))
                )
            ),
        )
    return out
