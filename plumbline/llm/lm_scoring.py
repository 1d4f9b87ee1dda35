"""LM scoring of a corpus by online logistic context mixing (see `context_mixing`).

Gathered from all texts: the 6-grams of their bytes with counts, in training texts
and in all.  These are ordinary sums by key that are combined within tasks first;
the number of keys follows the corpus.  One part in six of the training texts only
trains the mixing weights: against logits of the other texts, so that the weights
learn how far each order can be trusted on text not seen, in several online passes
over shards of the 6-grams whose weights are averaged.  The logits used for scores
are from the counts of all training texts.

No contexts share a place.  Those of up to two bytes have dense tables of a fixed 16
MB, which are broadcast.  For longer ones the 6-grams that share the last three bytes
of context lie together, which holds all contexts of three to five bytes whole, and
each 6-gram gets the logits of its nodes there and then its costs.  The costs of a
bounded number of the most frequent 6-grams are broadcast; all others of a text are
joined with the table of costs.

Beside it stands a unigram model of words with one added to every count.  Words
are counted over all training texts.  A bounded number of the most frequent is
broadcast; all others of a text are joined with the counts.

Defined results: a null text counts as empty: the end alone, for both models.  A
row without id is a row whose id is the empty text, for its part in training.
Repeated ids are scored row by row.  Without training texts all tokens are unknown
and all logits are 0.  Columns besides `doc_id` and `text` are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm import context_mixing as M
from plumbline.llm.common import mapped, remainder, row_key, slices, stored
from plumbline.llm.shingles import bytes_of

#: Remainder of the training rows that train weights only.
WEIGHTS_PART = 5
SHARDS = 16
#: 6-grams whose costs are broadcast: 32 MB.
GRAMS = 2_000_000
#: Bits of the tables of places by which a task finds them, and the hash of each: 20 MB.
PLACES = ((22, 0x9E3779B97F4A7C15), (20, 0xD6E8FEB86659FD93))
#: 6-grams whose nodes are counted at a time, at least.
BLOCK = 200_000
#: Words that are broadcast, and their longest length in bytes.
HEAD, LONGEST = 150_000, 64


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c) over the texts of `rows`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: Counter = Counter()
        for batch in slices(batches, "text", 4 << 20):
            for raw in bytes_of(batch.column("text")):
                if raw:
                    seen.update(raw.lower().split())
            if len(seen) > 300_000:
                yield {"word": pa.array(seen.keys(), pa.binary()), "c": list(seen.values())}
                seen.clear()
        if seen:
            yield {"word": pa.array(seen.keys(), pa.binary()), "c": list(seen.values())}

    return mapped(rows.select("text"), work, "word binary,c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def gram_counts(rows: DataFrame) -> DataFrame:
    """(gram, a, b, n): 6-grams with their counts in texts for the logits, in texts for the weights and in all."""

    def merged(parts: list[np.ndarray]) -> list[np.ndarray]:
        gram = np.concatenate([p[0] for p in parts])
        order = np.argsort(gram, kind="stable")
        gram = gram[order]
        cut = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        return [gram[cut], *(np.add.reduceat(np.concatenate([p[i] for p in parts])[order], cut) for i in (1, 2, 3))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        parts: list = []
        for batch in slices(batches, "text", 2 << 20):
            texts, use = bytes_of(batch.column("text")), batch.column("use").to_pylist()
            for which in (0, 1, 2):
                keys, _ = M.keys_of([t for t, x in zip(texts, use, strict=True) if x == which])
                if len(keys):
                    gram, n = np.unique(keys, return_counts=True)
                    none = np.zeros_like(n)
                    parts.append([gram, n if which == 0 else none, n if which == 1 else none, n])
            if sum(len(p[0]) for p in parts) > 2_500_000:
                parts = [merged(parts)]
                if len(parts[0][0]) > 1_500_000:
                    yield from out(parts.pop())
        if parts:
            yield from out(merged(parts))

    def out(part: list[np.ndarray]) -> Iterator[dict]:
        for at in range(0, len(part[0]), 200_000):
            gram, a, b, n = (x[at : at + 200_000] for x in part)
            yield {"gram": pa.array(gram.view(np.int64)), "a": pa.array(a), "b": pa.array(b), "n": pa.array(n)}

    return (
        mapped(rows.select("text", "use"), work, "gram bigint,a bigint,b bigint,n bigint")
        .groupBy("gram")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("n").alias("n"))
    )


_FIRST, _SECOND = [[f"{x}{k}" for k in range(M.LOW, len(M.ORDERS))] for x in "fs"]


def low_tables(grams: DataFrame) -> list[list[np.ndarray]]:
    """The dense logits of the low orders, from the texts for the logits and from all training texts."""
    last = F.col("gram").bitwiseAND(F.lit((1 << (8 * M.LOW)) - 1)).alias("gram")
    sums = grams.where("a + b > 0").groupBy(last).agg(F.sum("a").alias("a"), F.sum(F.col("a") + F.col("b")).alias("c"))
    rows = sums.toArrow()
    keys = rows.column("gram").to_numpy().astype(np.uint64)
    return [[M.dense(keys, rows.column(c).to_numpy(), k) for k in range(M.LOW)] for c in ("a", "c")]


def high_logits(grams: DataFrame) -> DataFrame:
    """(gram, b, n, f…, s…): the eight logits of each higher order as one number, from the texts for them and from all."""

    def out(gram: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> Iterator[dict]:
        keys = gram.view(np.uint64)
        columns = {"gram": gram, "b": b, "n": n}
        for k, first, second in zip(M.ORDERS[M.LOW :], _FIRST, _SECOND, strict=True):
            columns[first] = np.where(b > 0, M.path_logits(keys, a, k).view(np.int64)[:, 0], 0)
            columns[second] = M.path_logits(keys, a + b, k).view(np.int64)[:, 0]
        for at in range(0, len(gram), BLOCK):
            yield {c: pa.array(v[at : at + BLOCK]) for c, v in columns.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        parts: list = []
        for batch in batches:
            parts.append([batch.column(c).to_numpy() for c in ("gram", "a", "b", "n")])
            if sum(len(p[0]) for p in parts) >= BLOCK:
                whole = [np.concatenate(x) for x in zip(*parts, strict=True)]
                near = (whole[0] >> 8) & 0xFFFFFF
                cut = int(np.searchsorted(near, near[-1]))
                if cut:
                    yield from out(*(x[:cut] for x in whole))
                parts = [[x[cut:] for x in whole]]
        if parts:
            yield from out(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    # Grams that share the last three bytes of context lie together, and so do all longer contexts.
    near = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFFFF))
    ready = grams.repartition(near).sortWithinPartitions(near)
    names = ",".join(f"{c} bigint" for c in ("gram", "b", "n", *_FIRST, *_SECOND))
    return mapped(ready, work, names)


def _exact(low: list[np.ndarray], columns: list[np.ndarray]) -> M.Exact:
    high = [np.ascontiguousarray(c).view(np.int8).reshape(-1, 8) for c in columns]
    return M.Exact(low, np.stack(high, axis=1))


def gram_costs(nodes: DataFrame, low: list[np.ndarray], weights: list[np.ndarray]) -> DataFrame:
    """(gram, n, x, y): what the byte of each 6-gram costs each mixer."""
    sent = nodes.sparkSession.sparkContext.broadcast((low, weights))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            tables, mixers = sent.value
            gram = batch.column("gram").to_numpy()
            table = _exact(tables, [batch.column(c).to_numpy() for c in _SECOND])
            cost = M.cost(table, mixers, gram.view(np.uint64)).astype(np.float64)
            yield {"gram": batch.column("gram"), "n": batch.column("n"), "x": cost[:, 0], "y": cost[:, 1]}

    return mapped(nodes.select("gram", "n", *_SECOND), work, "gram bigint,n bigint,x double,y double")


def frequent_grams(costs: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `most` 6-grams, sorted, with their costs: all with at least some count."""
    level = F.floor(8 * F.log2("n"))
    left, least = most, None
    for r in sorted(costs.groupBy(level.alias("level")).agg(F.count("*").alias("c")).collect(), reverse=True):
        left -= r["c"]
        if left < 0:
            break
        least = r["level"]
    head = costs.where(level >= least if least is not None else F.lit(False)).select("gram", "x", "y").toArrow()
    gram = head.column("gram").to_numpy().astype(np.uint64)
    order = np.argsort(gram)
    return gram[order], np.stack([head.column(c).to_numpy()[order].astype(np.float32) for c in "xy"], axis=1)


def mixing_weights(grams: DataFrame, low: list[np.ndarray]) -> list[np.ndarray]:
    """Weights learned online on each shard of the 6-grams set aside, averaged by the bits that each set saw."""
    sent = grams.sparkSession.sparkContext.broadcast(low)
    shard = F.pmod(F.xxhash64("gram"), F.lit(SHARDS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, parts = None, []

        def out() -> Iterator[dict]:
            if parts:
                gram, n, *high = (np.concatenate(x) for x in zip(*parts, strict=True))
                weights, seen = M.learn(_exact(sent.value, high), gram.view(np.uint64), n)
                for m, (w, s) in enumerate(zip(weights, seen, strict=True)):
                    hit = np.flatnonzero(s)
                    flat = [(m, int(g), i, float(w[g, i] * s[g]), float(s[g])) for g in hit for i in range(w.shape[1])]
                    yield dict(zip(("mixer", "gate", "input", "sum", "mass"), zip(*flat, strict=True), strict=True))

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            for s in np.unique(shards).tolist():
                if s != now:
                    yield from out()
                    now, parts = s, []
                here = shards == s
                parts.append([batch.column(c).to_numpy()[here] for c in ("gram", "b", *_FIRST)])
        yield from out()

    rows = grams.where("b > 0").select("gram", "b", *_FIRST, shard.alias("shard"), F.xxhash64("gram", F.lit(7)).alias("o"))
    ready = rows.repartition("shard").sortWithinPartitions("shard", "o")
    sums = mapped(ready, work, "mixer int,gate int,input int,sum double,mass double")
    weights = M.fresh_weights()
    # At most as many rows as there are weights.
    for r in sums.groupBy("mixer", "gate", "input").agg(F.sum("sum").alias("s"), F.sum("mass").alias("m")).collect():
        weights[r["mixer"]][r["gate"], r["input"]] = r["s"] / r["m"]
    return weights


_OPEN: dict = {}


def _opened(sent, key: str, build):
    """What a worker builds from a broadcast value, kept from task to task."""
    value = sent.value
    if key not in _OPEN or _OPEN[key][0] is not value:
        _OPEN[key] = (value, build(value))
    return _OPEN[key][1]


class Grams:
    """Places of 6-grams: a table by hash, a second one for those whose slot is taken, the few left by search."""

    def __init__(self, grams: np.ndarray):
        self.grams, self.tables = grams, []
        left = np.arange(len(grams), dtype=np.int32)
        for bits, factor in PLACES:
            table = np.full(1 << bits, -1, np.int32)
            slots = self._slots(grams[left], bits, factor)
            table[slots] = left
            self.tables.append(table)
            left = left[table[slots] != left]
        self.left, self.rest = left, grams[left]

    @staticmethod
    def _slots(keys: np.ndarray, bits: int, factor: int) -> np.ndarray:
        return ((keys * np.uint64(factor)) >> np.uint64(64 - bits)).view(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those that aren't there."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.grams):
            return out
        open_ = None  # keys whose slots so far are taken by others
        for table, (bits, factor) in zip(self.tables, PLACES, strict=True):
            here = keys if open_ is None else keys[open_]
            at = table[self._slots(here, bits, factor)]
            hit = self.grams[at] == here
            hit &= at >= 0
            if open_ is None:
                out = np.where(hit, at, np.int32(-1))
                open_ = np.flatnonzero(~hit & (at >= 0))
            else:
                out[open_[hit]] = at[hit]
                open_ = open_[~hit & (at >= 0)]
        if len(self.rest) and len(open_):
            here = keys[open_]
            at = np.minimum(np.searchsorted(self.rest, here), len(self.rest) - 1)
            hit = self.rest[at] == here
            out[open_[hit]] = self.left[at[hit]]
        return out


def _score(batches: Iterator[pa.RecordBatch], model, head) -> Iterator[dict]:
    known = _opened(head, "head", lambda v: dict(zip(v[0], np.log10(v[1] + 1.0).tolist(), strict=True)))
    sorted_grams, costs = model.value
    grams = Grams(sorted_grams)  # for this task alone: kept, the worker would hold it in later stages too
    for batch in slices(batches, "text", 2 << 20):
        texts = bytes_of(batch.column("text"))
        keys, ends = M.keys_of(texts)
        at = grams.places(keys)
        there = at >= 0
        each = np.zeros((len(keys), 2))
        each[there] = costs[at[there]]
        each = np.add.reduceat(each, np.append(0, ends[:-1]), axis=0)
        owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[~there]
        rest = keys[~there]
        order = np.lexsort((rest, owner))
        rest, owner = rest[order], owner[order]
        cut = np.flatnonzero(np.append(True, (rest[1:] != rest[:-1]) | (owner[1:] != owner[:-1]))) if len(rest) else np.zeros(0, np.int64)
        times_of = np.diff(np.append(cut, len(rest)))
        bounds = np.searchsorted(owner[cut], np.arange(len(ends) + 1)).astype(np.int32)
        n, n_known, total, words, times = [], [], [], [], []
        for raw in texts:
            w = raw.lower().split() if raw else []
            logs = [known.get(x) for x in w]
            others = Counter(x for x, v in zip(w, logs, strict=True) if v is None)
            missing = others.total()
            n.append(len(w) + 1)
            n_known.append(len(w) - missing)
            total.append(math.fsum(v for v in logs if v is not None))
            words.append(list(others.keys()))
            times.append(list(others.values()))
        flat = [x for w in words for x in w]
        cuts = np.cumsum([0, *map(len, words)]).astype(np.int32)
        yield {
            "doc_id": batch.column("doc_id"),
            "row": batch.column("row"),
            "n_bytes": [len(x or b"") for x in texts],
            "n_tokens": n,
            "n_known": n_known,
            "total": total,
            "x": each[:, 0],
            "y": each[:, 1],
            "grams": pa.ListArray.from_arrays(bounds, pa.array(rest[cut].view(np.int64))),
            "counts": pa.ListArray.from_arrays(bounds, pa.array(times_of.astype(np.int64))),
            "words": pa.ListArray.from_arrays(cuts, pa.array(flat, pa.binary())),
            "times": pa.ListArray.from_arrays(cuts, pa.array([x for t in times for x in t], pa.int64())),
        }


def lm_scores(docs: DataFrame, held_out: Column | None = None, most_grams: int = GRAMS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    part = remainder(F.col("doc_id"), 7)
    held = part == 2 if held_out is None else held_out
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        held.alias("held_out"),
        F.when(~held, F.when(part == WEIGHTS_PART, 1).otherwise(0)).otherwise(2).alias("use"),
    )
    train = rows.where(~F.col("held_out"))
    spark = docs.sparkSession

    counts = stored(word_counts(train))
    totals = counts.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    ends = train.count()
    vocabulary = totals["v"] + (ends > 0)
    tokens = (totals["n"] or 0) + ends
    frequent = counts.where(F.length("word") <= LONGEST).orderBy(F.desc("c"), "word").limit(HEAD).select("word", "c").toPandas()
    head = spark.sparkContext.broadcast(
        ([bytes(x) for x in frequent["word"]], frequent["c"].to_numpy(np.int64))
    )

    grams = stored(gram_counts(rows))
    first, second = low_tables(grams)
    nodes = stored(high_logits(grams))
    costs = stored(gram_costs(nodes, second, mixing_weights(nodes, first)))
    model = spark.sparkContext.broadcast(frequent_grams(costs, most_grams))

    work = partial(_score, model=model, head=head)
    each = stored(
        mapped(
            rows.select("doc_id", "text").withColumn("row", row_key()),
            work,
            "doc_id bigint,row bigint,n_bytes bigint,n_tokens bigint,n_known bigint,total double,x double,y double,grams array<bigint>,counts array<bigint>,words array<binary>,times array<bigint>",
        )
    )
    rare = (
        each.select("row", F.explode(F.arrays_zip("words", "times")).alias("x"))
        .select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
        .join(counts, "word")
        .groupBy("row")
        .agg(F.sum("times").alias("_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("_total"))
    )
    seldom = (
        each.select("row", F.explode(F.arrays_zip("grams", "counts")).alias("g"))
        .select("row", F.col("g.grams").alias("gram"), F.col("g.counts").alias("counts"))
        .join(costs.select("gram", F.col("x").alias("cx"), F.col("y").alias("cy")), "gram")
        .groupBy("row")
        .agg(F.sum(F.col("counts") * F.col("cx")).alias("_x"), F.sum(F.col("counts") * F.col("cy")).alias("_y"))
    )
    x, y = (F.col(c) + F.coalesce(f"_{c}", F.lit(0.0)) for c in "xy")
    # log10 of the mean of the two products.
    score = (F.log1p(F.exp(-F.abs(x - y))) - F.least(x, y) - math.log(2)) / math.log(10)
    ended = math.log10(ends + 1)
    base = (
        F.col("total") + F.coalesce("_total", F.lit(0.0)) + ended - F.col("n_tokens") * math.log10(tokens + vocabulary + 1)
    )
    again = remainder(F.col("doc_id"), 7) == 2 if held_out is None else held_out
    return each.join(rare, "row", "left").join(seldom, "row", "left").withColumn("score", score).select(
        "doc_id",
        again.alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        (-F.col("score") / math.log10(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
