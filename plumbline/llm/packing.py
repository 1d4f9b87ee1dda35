"""Best-fit packing planned over the histogram of lengths.

Documents are tokenised once into pieces of at most `limit` tokens and stored.
How many pieces there are of each length is all that the plan needs: at most
`limit` counts.  Best-fit decreasing runs over these counts, with groups of
equally filled sequences instead of single ones, so its work depends on `limit`
alone.  It gives runs: so many pieces of one length, by rank, go to consecutive
sequences at one offset.  The pieces then take their places by a join on rank
within length.  A rank is the piece's number in the task that made it plus the
number of pieces of that length in earlier tasks, so no length is ever gathered
or sorted in one place.

Ids are those of the tokenizer `name`.  `ranks` may name the rank file of the same
vocabulary: words of Latin characters that no cache holds are encoded by it, with the
same ids.

Only documents longer than `limit` are cut; their first piece takes the
remainder.  A null text counts as empty: the closing id alone.  Ids may be null
or repeated; every row is packed.  An empty table gives an empty table.  Columns
besides `doc_id` and `text` are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Mapping
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import mapped, slices, stored
from plumbline.llm.pretokens import Units, packed

#: The plan is broadcast up to so many runs; a larger one is joined by Spark's own choice.
BROADCAST_RUNS = 50_000
_PIECES = "doc_id bigint,piece int,start bigint,length bigint,ids_crc32 bigint,part bigint,nth bigint"
_OPEN: dict[str, Units] = {}


def pieces(docs: DataFrame, name: str, closing: int, limit: int, ranks: str | None, with_ids: bool) -> DataFrame:
    """Pieces of at most `limit` ids; `part` and `nth` number those of a length within a task."""
    schema = _PIECES + ",ids binary" * with_ids
    names = [x.split()[0] for x in schema.split(",")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        if name not in _OPEN:
            _OPEN[name] = Units(name, packed, b"x", ranks=ranks)
        units, part = _OPEN[name], TaskContext.get().partitionId()
        nth: dict[int, int] = defaultdict(int)
        end = np.array([closing], "<u4").tobytes()
        for batch in slices(batches, "text", 4 << 20):
            rows = []
            for doc_id, values in zip(batch.column("doc_id").to_pylist(), units.many(batch.column("text").to_pylist()), strict=True):
                values.append(end)
                ids = b"".join(values)
                total = len(ids) // 4
                if total <= limit:
                    row = (doc_id, 0, 0, total, crc32(ids), part, nth[total])
                    rows.append((*row, ids) if with_ids else row)
                    nth[total] += 1
                    continue
                at = 0
                for k in range(-(-total // limit)):
                    size = (total % limit or limit) if k == 0 else limit
                    own = ids[4 * at : 4 * (at + size)]
                    row = (doc_id, k, at, size, crc32(own), part, nth[size])
                    rows.append((*row, own) if with_ids else row)
                    nth[size] += 1
                    at += size
            yield dict(zip(names, zip(*rows, strict=True), strict=True))

    return mapped(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")),
        cut,
        schema,
    )


def best_fit_plan(histogram: Mapping[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, number, first sequence, offset) by best-fit decreasing over counts.

    Sequences that hold the same lengths form a group (first sequence, number).
    Each step either places all pieces left of a length or fills a whole group,
    so a group is split at most once per length.
    """
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by room that is left
    rooms: list[int] = []  # rooms with groups, ascending
    runs, opened = [], 0

    def keep(room: int, group: tuple[int, int]) -> None:
        if room:
            if not free[room]:
                rooms.insert(bisect_left(rooms, room), room)
            free[room].append(group)

    for length in sorted((x for x in histogram if histogram[x]), reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, size = free[room].pop()
                if not free[room]:
                    rooms.pop(at)
            else:  # as many new sequences as the rest of this length fills
                room, first = limit, opened
                size = -(-left // (limit // length))
                opened += size
            took = min(size, left)
            if took < size:
                keep(room, (first + took, size - took))
            runs.append((length, rank, took, first, limit - room))
            keep(room - length, (first, took))
            left -= took
            rank += took
    return runs


def pack(found: DataFrame, limit: int) -> DataFrame:
    """Stored pieces with sequence_id and offset."""
    spark = found.sparkSession
    counts = stored(found.groupBy("part", "length").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = best_fit_plan(histogram, limit)
    plan = spark.createDataFrame(
        runs, "length bigint, first_rank bigint, number bigint, first_sequence bigint, offset bigint"
    )
    if len(runs) <= BROADCAST_RUNS:
        plan = F.broadcast(plan)
    # One row per task and length: the sum over earlier tasks needs no rows of documents.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return (
        found.join(before, ["part", "length"])
        .withColumn("rank", F.col("before") + F.col("nth"))
        .join(plan, "length")
        .where(F.col("rank").between(F.col("first_rank"), F.col("first_rank") + F.col("number") - 1))
        .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first_rank"))
        .drop("rank", "first_rank", "number", "first_sequence", "before", "part", "nth")
    )


def pack_documents(
    docs: DataFrame,
    name: str = "byte_bpe_50k.json",
    closing: int = 2,
    limit: int = 1024,
    ranks: str | None = "byte_bpe_50k.tiktoken",
    with_ids: bool = True,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, ids (little-endian unsigned 32-bit), sequence_id, offset.

    Without `with_ids` the ids stay where they are made; their crc32 tells what they are.
    """
    found = stored(pieces(docs, name, closing, limit, ranks, with_ids))
    return pack(found, limit)
