"""Exact duplicates by a tree-merge of sorted digest runs.

Every partition first turns its rows into a run: digests in order, each once,
with its smallest row and its number of rows.  The partitions then exchange runs
in binomial rounds, as in a recursive halving: in round r a partition meets the
`2**bits - 1` others whose numbers differ from its own only in the r-th group of
`bits` bits, and each of them receives the digests whose r-th group of bits names
it.  The receiver merges the sorted pieces and again keeps one entry per digest.
After the last round all runs of a digest have met; no partition ever holds more
than its share of the digests, and a text that fills a third of the corpus costs
one entry per run.  The answers go back to the rows over the first runs, so no
join key is hot either.

An entry is verified at each level: equal digests merge only when length and a
second, independent hash agree too.

Defined results: a null text counts as empty.  A row without id stays behind all
ids of its group, so `keep_id` is null only where no row of the group has an id.
Of repeated rows with one id and equal texts, one stays.  An empty table gives an
empty table.  Columns besides `doc_id` and `text` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import SPACE, mapped, parted, row_key, stored, unused

_ENTRY = "run bigint,digest binary,n_bytes bigint,second bigint,no_id boolean,keep_id bigint,keep_row bigint,size bigint"
_ORDER = ("run", "digest", "n_bytes", "second")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One entry per (run, digest, length, second hash) from rows in that order: a stream, one entry held."""
    key = best = None
    size = 0
    out: list[tuple] = []
    for batch in batches:
        for *k, no_id, keep_id, keep_row, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rank = (no_id, keep_id or 0, keep_row)
            if k == key:
                size += n
                if rank < best:
                    best, kept = rank, keep_id
            else:
                if key is not None:
                    out.append((*key, best[0], kept, best[2], size))
                key, best, kept, size = k, rank, keep_id, n
        if len(out) >= 50_000:
            yield dict(zip(_NAMES, zip(*out, strict=True), strict=True))
            out = []
    if key is not None:
        out.append((*key, best[0], kept, best[2], size))
        yield dict(zip(_NAMES, zip(*out, strict=True), strict=True))


_NAMES = [x.split()[0] for x in _ENTRY.split(",")]


def merged(entries: DataFrame) -> DataFrame:
    return mapped(entries.select(_NAMES).sortWithinPartitions(*_ORDER), merge_sorted, _ENTRY)


def exact_groups(docs: DataFrame, rounds: int = 2, bits: int = 4) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, row.

    `2**(rounds * bits)` merge places; each round is one exchange among groups of
    `2**bits` places.
    """
    places = 1 << (rounds * bits)
    text = normalised(F.col("text"))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
            F.octet_length(text).cast("bigint").alias("n_bytes"),
            F.xxhash64(text).alias("second"),
        )
        .withColumn("row", row_key())
        .withColumn("part", F.spark_partition_id().cast("bigint"))
    )
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    runs = stored(
        rows.groupBy(F.col("part").alias("run"), "digest", "n_bytes", "second")
        .agg(smallest.alias("least"), F.count("*").alias("size"))
        .select(
            "run", "digest", "n_bytes", "second", "least.no_id",
            F.col("least.doc_id").alias("keep_id"), F.col("least.row").alias("keep_row"), "size",
        )
    )
    level = runs.withColumn("run", F.col("run") % places)
    lead = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("bigint") % places
    for r in range(rounds):
        own = F.lit(((1 << bits) - 1) << (r * bits))
        target = F.col("run").bitwiseAND(F.bitwise_not(own)).bitwiseOR(lead.bitwiseAND(own))
        level = merged(level.withColumn("run", target).repartition("run"))
    answer = level.select(
        "digest", "n_bytes", "second", "keep_id", "keep_row", F.col("size").alias("group_size")
    )
    by_run = runs.select(F.col("run").alias("part"), "digest", "n_bytes", "second").join(
        answer, ["digest", "n_bytes", "second"]
    )
    return rows.join(by_run, ["part", "digest", "n_bytes", "second"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    names = docs.columns
    own, key, sha, stays, rows = (unused(docs, x) for x in ("own", "key", "sha", "stays", "rows"))
    verdict = stored(
        exact_groups(docs)
        .groupBy(F.col("doc_id").alias(key), F.col("text_sha256").alias(sha))
        .agg(F.max("kept").alias(stays), F.count("*").alias(rows))
        .where(~F.col(stays) | (F.col(rows) > 1))
    )
    sha256 = F.sha2(normalised(F.col("text")).cast("binary"), 256)
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(key)) & (F.col(own) == F.col(sha))
    # Only rows whose id may have a verdict are hashed again and shuffled.
    asked, clear = parted(docs, verdict.select(key))
    single = asked.withColumn(own, sha256).join(verdict, same, "left_anti").select(names)
    # Repeated rows with one id: one of them stays.
    twice = verdict.where(F.col(stays))
    repeated = parted(docs, twice.select(key))[0].withColumn(own, sha256).join(twice, same, "left_semi")
    return clear.unionByName(single).unionByName(repeated.dropDuplicates(["doc_id", own]).select(names))
