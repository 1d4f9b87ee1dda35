"""Token counts by a map-side two-tier lookup.

Tier one is a table of the pre-tokens that are frequent in the whole corpus, with
their numbers of tokens, broadcast as one text and one array and opened as a hash
table once per worker.  Tier two is each worker's own bounded cache: a unit that
the table lacks is encoded there.  Texts are mapped where they lie; no pre-token
is shuffled.  Only candidates for the table are: every partition counts all its
units and hands on at most `table_size` of those that it has seen twice.  The
table decides nothing but speed.

Defined results: a null text counts as empty and has no tokens.  Ids may be null
or repeated; there is one row per row.  Columns besides `doc_id` and `text` are
not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import mapped, slices
from plumbline.llm.pretokens import LONGEST, Units, lengths

#: Units that a partition keeps count of at most; the rarest are let go beyond it.
COUNTED = 200_000
#: Stands for a unit that can't be cut out; no number of tokens.
BAD = -1
#: The worker's table and cache, kept from task to task.
_OPEN: dict = {}


def frequent_units(docs: DataFrame, table_size: int) -> DataFrame:
    """(unit, n): units that are frequent in some partition, by their count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: Counter = Counter()
        for part in slices(batches, "text", 4 << 20):
            for text in part.column("text").to_pylist():
                if text:
                    seen.update(text.split(" ")[1:])
            if len(seen) > COUNTED:
                seen = Counter({u: n for u, n in seen.items() if n > 1})
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 2)))
        top = [(u, n) for u, n in seen.most_common(table_size) if n > 1 and len(u) <= LONGEST and u.strip() == u != ""]
        if top:
            units, n = zip(*top, strict=True)
            yield {"unit": units, "n": n}

    return mapped(docs.select("text"), count, "unit string,n bigint").groupBy("unit").agg(F.sum("n").alias("n"))


def token_counts(
    docs: DataFrame, name: str = "byte_bpe_50k.json", limit: int = 1024, table_size: int = 50_000
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit.

    The table's bound: `table_size` units of at most 48 characters.
    """
    spark = docs.sparkSession
    top = frequent_units(docs, table_size).orderBy(F.desc("n"), "unit").limit(table_size)
    units = [r["unit"] for r in top.select("unit").toLocalIterator()]
    sizes = Units(name, lengths, BAD).encoded(units)
    sent = spark.sparkContext.broadcast((" ".join(units), np.array([sizes[u] for u in units], np.uint8)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        text, n = sent.value
        if _OPEN.get("of") is not n:
            given = dict(zip(text.split(" "), n.tolist(), strict=True)) if text else {}
            _OPEN.update(of=n, units=Units(name, lengths, BAD, given))
        table = _OPEN["units"]
        for part in slices(batches, "text", 4 << 20):
            texts = part.column("text").to_pylist()
            n = [sum(x) for x in table.many(texts)]
            yield {
                "doc_id": part.column("doc_id"),
                "n_bytes": [len(x.encode()) if x else 0 for x in texts],
                "n_tokens": n,
                "over_limit": [x > limit for x in n],
            }

    return mapped(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")),
        count,
        "doc_id bigint,n_bytes bigint,n_tokens bigint,over_limit boolean",
    )
