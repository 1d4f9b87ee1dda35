"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import shared_folder  # noqa: F401  used here and by others

#: White space between words: fixed by the contracts of the queries.
SPACE = r"[\x20\x09-\x0D]+"
#: Buckets of ids that a broadcast marks, 64 in a row of it: 262,144 rows at most.
MARKS = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write a table once to the shared folder and read it back.

    Lost executors then cost only the tasks that ran on them, and values that
    depend on the split of the input (partition ids) stay as they were written.
    """
    path = shared_folder(df.sparkSession, "llm")
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def row_key() -> Column:
    """A number per row; stable once stored.  The upper bits are the partition."""
    return F.monotonically_increasing_id()


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have, whatever the case of its names."""
    taken = {x.lower() for x in df.columns}
    while name in taken:
        name += "_"
    return name


def parted(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of `docs` whose doc_id may be in the one column of `ids`, and those whose doc_id surely isn't.

    A broadcast of the marked buckets of ids tells them apart, so that texts needn't be shuffled;
    a missing id has a bucket, too.  The fuller the buckets, the more rows are in the first part.
    """
    word, marks = unused(docs, "word"), unused(docs, "marks")

    def bucket(i: Column) -> Column:
        return F.pmod(F.xxhash64(i.cast("bigint")), F.lit(MARKS).cast("bigint"))

    own, here = bucket(F.col(ids.columns[0])), bucket(F.col("doc_id"))
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), (own % 64).cast("int"))
    marked = F.broadcast(ids.select(F.shiftright(own, 6).alias(word), mark.alias(marks)).groupBy(word).agg(F.bit_or(marks).alias(marks)))
    hit = (F.shiftright(here, 6) == F.col(word)) & (F.getbit(F.col(marks), (here % 64).cast("int")) == 1)
    return docs.join(marked, hit, "left_semi"), docs.join(marked, hit, "left_anti")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id isn't in the one column of `gone`, all columns; rows without id stay."""
    name = unused(docs, "gone")
    ids = stored(gone.toDF(name).where(F.col(name).isNotNull()).distinct())
    asked, clear = parted(docs, ids)
    return clear.unionByName(asked.join(ids, F.col("doc_id").cast("bigint") == F.col(name), "left_anti"))


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each slice holds about `most` bytes of the text column, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at, step = 0, max(1, int(most * batch.num_rows / max(1, batch.column(text).nbytes)))
        while at < batch.num_rows:
            yield batch.slice(at, step)
            at += step


def mapped(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """`work` turns an iterator of Arrow batches into dicts of columns, one dict per output batch."""
    arrow = pa.schema(
        [(n, _ARROW[t]) for n, t in (x.split() for x in schema.split(","))]
    )

    def run(batches):
        for columns in work(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                    for f in arrow
                    for c in [columns[f.name]]
                ],
                schema=arrow,
            )

    return df.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in (x.split() for x in schema.split(","))))


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<string>": pa.list_(pa.string()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<binary>": pa.list_(pa.binary()),
}
