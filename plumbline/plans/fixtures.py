"""Deterministic inputs derived from the driver's tables.

Every fixture is a narrow view over a whole table, so it grows with the table.
The oracle writes the same expressions in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import BOM
from plumbline.operators.quality import Feed, Field, above, flag_rows, listed, shaped, within
from plumbline.operators.classify import valid_by_flag
from plumbline.operators.registry import REGISTRY_SCHEMA
from plumbline.session import cut_lineage
from plumbline.plans.drill import (
    BASELINE_FINGERPRINT,
    BASELINE_URL,
    SOURCE,
    SUPPLIER_FINGERPRINT,
    SUPPLIER_URL,
)

NOW = "2026-02-01 00:00:00"
LOADED = "2026-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def choose(on: Column, cases: dict[int, Column | str | None], otherwise: Column) -> Column:
    out = otherwise
    for value, result in reversed(list(cases.items())):
        out = F.when(on == value, result if isinstance(result, Column) else F.lit(result)).otherwise(out)
    return out


def stg(spark: SparkSession, sf_dir: str, run_id: Column | None = None) -> DataFrame:
    """Dirty staging rows, one per order."""
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    series = F.lpad((F.col("o_custkey") % 50).cast("string"), 6, "0")
    return orders.select(
        (F.lit("r0") if run_id is None else run_id).alias("run_id"),
        k.alias("source_row_no"),
        choose(
            k % 97,
            {3: None, 4: "   ", 5: F.date_format("o_orderdate", "yyyy-MM-dd"), 6: "31-Feb-2023"},
            F.date_format("o_orderdate", "dd-MMM-yyyy"),
        ).alias("raw_rate_date"),
        choose(
            k % 89,
            {3: "", 4: F.concat(F.lit("BAD"), series)},
            F.concat(F.lit(" FXR"), series, F.lit(" ")),
        ).alias("series_id"),
        choose(
            k % 83,
            {3: None, 4: "NaN", 5: "-inf", 6: "n/a", 7: "1234567890123", 8: "-1.5", 9: "0.000000001"},
            F.col("o_totalprice").cast("decimal(20,8)").cast("string"),
        ).alias("raw_rate"),
        F.lit("ORD").alias("source"),
    )


def stg_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as four runs at once."""
    return stg(
        spark, sf_dir, F.concat(F.lit("r"), (F.col("o_orderkey") % 4).cast("string"))
    )


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_rows(stg(spark, sf_dir))


def flags_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_rows(stg_multi(spark, sf_dir))


def master_of(valid_rows: DataFrame) -> DataFrame:
    """Master that lacks every tenth row, holds another rate for the next and none for the one after."""
    tenth = F.col("source_row_no") % 10
    return valid_rows.where(tenth != 0).select(
        "source",
        "rate_date",
        "series_id",
        F.when(tenth == 1, F.col("rate") + F.expr("0.01BD"))
        .when(tenth != 2, F.col("rate"))
        .cast("decimal(20,8)")
        .alias("rate"),
        F.lit("m0").alias("first_loaded_run_id"),
        F.lit("m0").alias("last_changed_run_id"),
        at(LOADED).alias("updated_at"),
    )


def loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows, computed once and written, and the master derived from them."""
    valid = cut_lineage(valid_by_flag(flags(spark, sf_dir)))
    return valid, master_of(valid)


def multi_flags(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Flagged rows of the four runs, computed once and written, and a master.

    The master comes from the last run's valid row of each key.
    """
    flagged = cut_lineage(flags_multi(spark, sf_dir))
    last = (
        valid_by_flag(flagged)
        .groupBy("source", "rate_date", "series_id")
        .agg(F.max_by(F.struct("source_row_no", "rate"), "run_id").alias("v"))
        .select("source", "rate_date", "series_id", "v.*")
    )
    return flagged, master_of(last)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as landed files, some with BOM, blank lead, heading or marker."""
    k = F.col("doc_id")
    content = F.concat(
        F.when(k % 7 == 0, BOM).otherwise(""),
        F.when(k % 11 == 0, " \n\t ").otherwise(""),
        F.when(k % 3 == 0, "F11.1  EXCHANGE RATES\n").otherwise(""),
        F.when(k % 5 == 0, "Series ID,FXRA\n").otherwise(""),
        F.col("text"),
        F.when(k % 5 == 1, "\nSeries ID,FXRB").otherwise(""),
    )
    return table(spark, sf_dir, "documents").select(
        k.alias("doc_id"),
        F.concat(F.lit("landing/doc-"), k.cast("string"), F.lit(".csv")).alias("path"),
        F.col("source"),
        content.cast("binary").alias("content"),
    )


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct document contents per source; `first_doc` drives the registry fixture."""
    return (
        table(spark, sf_dir, "documents")
        .select(
            "doc_id",
            "source",
            F.sha2(F.col("text").cast("binary"), 256).alias("source_fingerprint"),
        )
        .groupBy("source", "source_fingerprint")
        .agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"))
        .withColumn("source_url", F.concat(F.lit("landing/doc-"), F.col("first_doc").cast("string")))
    )


def reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry over two thirds of the contents: done, open, absent in turn."""
    k = F.col("first_doc")
    done = k % 3 == 0
    staged = F.lit(1000) + k % 500
    invalid = k % 100

    def counter(c: Column) -> Column:
        return F.when(done, c).cast("bigint")

    columns = {
        "run_id": F.concat(F.lit("run-"), k.cast("string")),
        "source": F.col("source"),
        "source_fingerprint": F.col("source_fingerprint"),
        "source_url": F.col("source_url"),
        "execution_id": F.lit(None).cast("string"),
        "status": F.when(done, "SUCCESS").otherwise("RUNNING"),
        "source_row_count": counter(staged),
        "staged_count": counter(staged),
        "valid_count": counter(staged - invalid - F.when(k % 10 == 0, 1).otherwise(0)),
        "invalid_count": counter(invalid),
        "new_count": counter(k % 50),
        "changed_count": counter(k % 7),
        "unchanged_count": counter(staged - invalid - k % 50 - k % 7),
        "recorded_at": F.timestamp_seconds(F.unix_timestamp(at(LOADED)) + k),
        "last_attempt_at": F.timestamp_seconds(F.unix_timestamp(at(LOADED)) + k),
        "completed_at": F.when(done, F.timestamp_seconds(F.unix_timestamp(at(LOADED)) + k + 5)),
    }
    return contents(spark, sf_dir).where(k % 3 != 2).select(
        *[c.alias(n) for n, c in columns.items()]
    )


def run_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows of the four staged runs; r3 is already closed."""
    runs = stg_multi(spark, sf_dir).select("run_id").distinct()
    closed = F.col("run_id") == "r3"
    given = {
        "run_id": F.col("run_id"),
        "source": F.lit("ORD"),
        "source_fingerprint": F.sha2(F.col("run_id").cast("binary"), 256),
        "source_url": F.concat(F.lit("landing/"), F.col("run_id")),
        "status": F.when(closed, "SUCCESS").otherwise("RUNNING"),
        "recorded_at": at(LOADED),
        "last_attempt_at": at(LOADED),
        "completed_at": F.when(closed, at(LOADED)),
    }
    types = [part.strip().split(" ") for part in REGISTRY_SCHEMA.split(",")]
    return runs.select(
        *[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in types]
    )


def landed_csv(spark: SparkSession, sf_dir: str, path: str, files: int = 8) -> None:
    """Landed CSV files of any size below `path`: every order's row, by order, in one of `files` files.

    Some fields are quoted, some hold a comma or a line break, some rows are blank
    or lack a field.
    """
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "dd-MMM-yyyy")
    price = F.col("o_totalprice").cast("decimal(20,8)").cast("string")
    row = choose(
        k % 29,
        {3: ",,", 4: F.concat(day, F.lit(",1")), 5: F.concat(day, F.lit(',"1,5","a""b"'))},
        F.when(k % 29 == 6, F.concat(day, F.lit(',"12\n'), k.cast("string"), F.lit('\n",x'))).otherwise(
            F.concat(day, F.lit(","), price, F.lit(","), F.col("o_custkey").cast("string"))
        ),
    )
    orders = table(spark, sf_dir, "orders").select((k % files).alias("file"), k.alias("_k"), row.alias("value"))
    first = spark.range(files).select(
        F.col("id").alias("file"),
        F.lit(-1).cast("bigint").alias("_k"),
        F.lit('Title,"open\nSeries ID,FXRUSD, FXREUR').alias("value"),
    )
    lines = orders.unionByName(first).repartition("file").sortWithinPartitions("file", "_k")
    lines.select("file", "value").write.partitionBy("file").text(path)


def increments(spark: SparkSession, sf_dir: str, path: str) -> tuple[str, str]:
    """Two increments of landed CSV files over all orders, as folders; a file holds 4,000 orders' days.

    The second one brings other prices for every tenth order, and the thirteenth orders
    that the first one lacks.  Some rows are blank or short, some lack their date or hold
    no number, some are sent twice.
    """
    k, n = F.col("o_orderkey"), F.col("n")
    day = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (k % 4000).cast("int")), "dd-MMM-yyyy")
    price = F.col("o_totalprice").cast("decimal(20,8)") + F.when((n == 2) & (k % 10 == 1), 1).otherwise(0)
    second = F.when(k % 89 == 4, "NaN").otherwise(F.col("o_custkey").cast("string"))
    row = F.concat_ws(",", F.when(k % 97 == 3, "").otherwise(day), price.cast("decimal(20,8)").cast("string"), second)
    row = F.when(k % 83 == 5, F.concat(day, F.lit(",1"))).when(k % 101 == 7, ",,").otherwise(row)
    copies = F.array_repeat(row, F.when(k % 79 == 6, 2).otherwise(1))
    orders = table(spark, sf_dir, "orders").withColumn("file", F.floor(k / 4000).cast("bigint"))
    numbered = orders.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).where((n == 2) | (k % 13 != 0))
    lines = numbered.select("n", "file", k.alias("_k"), F.explode(copies).alias("value"))
    f = F.col("file").cast("string")
    head = F.concat(F.lit("Rates\nSeries ID,FXR"), f, F.lit("A,FXR"), f, F.lit("B"))
    heads = lines.select("n", "file").distinct().select("n", "file", F.lit(-1).cast("bigint").alias("_k"), head.alias("value"))
    both = lines.unionByName(heads).repartition("n", "file").sortWithinPartitions("n", "file", "_k")
    both.select("n", "file", "value").write.partitionBy("n", "file").text(path)
    return f"{path}/n=1", f"{path}/n=2"


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small landed CSV per order: metadata, own header, blank and odd rows."""
    k = F.col("o_orderkey")
    wide = k % 2 == 1
    extra = F.when(wide, ",").otherwise("")
    day = F.date_format("o_orderdate", "dd-MMM-yyyy")
    none = F.lit(None).cast("string")
    no_rows = k % 23 == 8
    header = choose(
        k % 23,
        {5: none, 6: "Series ID,FXRUSD,FXRUSD", 7: "Series ID,FXRUSD,,FXREUR"},
        F.when(wide, "Series ID, FXRUSD ,FXREUR,FXRJPY").otherwise("Series ID,FXRUSD,FXREUR"),
    )
    price = F.col("o_totalprice").cast("decimal(20,8)").cast("string")
    rows = [
        F.concat(day, F.lit(","), price, F.lit(","), F.col("o_custkey").cast("string"), extra),
        F.lit(",,"),
        F.lit("  "),
        F.concat(day, F.lit(',"1,234.5","a""b"'), extra),
        F.when(k % 13 == 3, F.concat(day, F.lit(",1"))),
        F.lit(""),
        F.when(k % 17 == 4, F.concat(day, F.lit(',"12\n34",x'), extra)),
    ]
    lines = F.array_compact(
        F.concat(
            F.array(
                F.concat(F.when(k % 7 == 0, BOM).otherwise(""), F.lit("F11.1  EXCHANGE RATES")),
                F.concat(F.lit("Title,Order "), k.cast("string")),
            ),
            F.array_repeat(F.lit("Note"), (k % 4).cast("int")),
            F.array(header),
            F.array(*[F.when(~no_rows, r) if i not in (1, 2, 5) else r for i, r in enumerate(rows)]),
        )
    )
    text = F.when(k % 3 == 0, F.array_join(lines, "\r\n")).otherwise(F.array_join(lines, "\n"))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("landing/order-"), k.cast("string"), F.lit(".csv")).alias("path"),
        text.cast("binary").alias("content"),
    )


def json_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON batch per order, some elements badly typed, some batches unreadable."""
    k = F.col("o_orderkey")
    element = F.format_string(
        '{"source_row_no":%d,"raw_rate_date":"%s","series_id":"FXR%d","raw_rate":"%s","source":"ORD"}',
        k * 10,
        F.date_format("o_orderdate", "dd-MMM-yyyy"),
        F.col("o_custkey") % 50,
        F.col("o_totalprice").cast("decimal(20,8)").cast("string"),
    )
    partial = F.format_string('{"source_row_no":%d,"series_id":null}', k * 10 + 1)
    bad = F.when(k % 19 == 3, '{"source_row_no":"x","source":"ORD"}')
    text = F.concat(
        F.lit("["), F.array_join(F.array_compact(F.array(element, partial, bad)), ","), F.lit("]")
    )
    return table(spark, sf_dir, "orders").select(
        k.alias("batch_id"), F.when(k % 31 == 4, "not json").otherwise(text).alias("batch")
    )


def staging_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows as an ordered batch, every sixth row sent again with another rate."""
    rows, k = stg_multi(spark, sf_dir), F.col("source_row_no")
    first = rows.withColumn("ordinal", k * 2)
    again = (
        rows.where(k % 6 == 0).withColumn("ordinal", k * 2 + 1).withColumn("raw_rate", F.lit("9.9"))
    )
    return first.unionByName(again)


#: A feed of line items: whole quantities, a discount, ISO days and one of three flags.
ITEM_FEED = Feed(
    fields=(
        Field(
            "quantity", "raw_quantity", "MISSING_QUANTITY", (above("NO_QUANTITY", 0),),
            lambda text: text.try_cast("bigint"), "INVALID_QUANTITY",
        ),
        Field(
            "discount", "raw_discount", None, (within("DISCOUNT_RANGE", 0, 0.08),),
            lambda text: text.try_cast("decimal(6,4)"), "INVALID_DISCOUNT",
        ),
        Field(
            "day", "raw_day", "MISSING_DAY", (shaped("DAY_FORMAT", r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"),),
            lambda text: F.try_to_date(text, "yyyy-MM-dd"), "INVALID_DAY",
        ),
        Field("flag", "raw_flag", "MISSING_FLAG", (listed("UNKNOWN_FLAG", ("A", "N", "R")),)),
    ),
    key=("run_id", "l_orderkey", "l_linenumber", "parsed_day"),
    repeated="REPEATED_ITEM",
    details={
        "MISSING_QUANTITY": "no quantity", "INVALID_QUANTITY": "no whole number", "NO_QUANTITY": "quantity of 0 or less",
        "INVALID_DISCOUNT": "no decimal number", "DISCOUNT_RANGE": "discount outside 0 to 0.08",
        "MISSING_DAY": "no day", "DAY_FORMAT": "not like 2024-01-31", "INVALID_DAY": "no day of the calendar",
        "MISSING_FLAG": "no flag", "UNKNOWN_FLAG": "flag other than A, N, R", "REPEATED_ITEM": "sent more than once",
    },
)


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as dirty text."""
    k = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        F.lit("r0").alias("run_id"),
        "l_orderkey",
        "l_linenumber",
        choose(k % 31, {3: "", 4: "ten", 5: "0"}, F.col("l_quantity").cast("int").cast("string")).alias("raw_quantity"),
        choose(k % 37, {3: " ", 4: "1/2"}, F.col("l_discount").cast("decimal(6,4)").cast("string")).alias("raw_discount"),
        choose(
            k % 41,
            {3: None, 4: F.date_format("l_shipdate", "dd-MMM-yyyy"), 5: "2023-02-30"},
            F.date_format("l_shipdate", "yyyy-MM-dd"),
        ).alias("raw_day"),
        choose(k % 43, {3: " ", 4: "X"}, F.lower("l_returnflag")).alias("raw_flag"),
    )


def orphans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw line items, and the part keys that count as known."""
    members = table(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.concat(F.lit(" "), F.date_format("l_shipdate", "dd-MMM-yyyy")).alias("raw_rate_date"),
        F.concat(F.col("l_extendedprice").cast("decimal(20,8)").cast("string"), F.lit(" ")).alias("raw_rate"),
    )
    return rows, members.distinct()


# A task of the drill grows the rows of about this many series.
SERIES_A_TASK = 1000


def drill_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series numbers of the drill, one per supplier, dealt over as many tasks as they need.

    Each number grows into hundreds of rows, so those of one small file are too many for a task.
    """
    series = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1).alias("s"))
    return series.repartition(1 + series.count() // SERIES_A_TASK, "s")


def drill_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drill's two synthetic contents, to be registered."""
    runs = F.array(
        F.struct(F.lit(BASELINE_FINGERPRINT).alias("f"), F.lit(BASELINE_URL).alias("u")),
        F.struct(F.lit(SUPPLIER_FINGERPRINT).alias("f"), F.lit(SUPPLIER_URL).alias("u")),
    )
    return (
        drill_series(spark, sf_dir)
        .agg(F.count("*").alias("n"))
        .select(F.explode(runs).alias("r"))
        .select(
            F.lit(SOURCE).alias("source"),
            F.col("r.f").alias("source_fingerprint"),
            F.col("r.u").alias("source_url"),
        )
    )
