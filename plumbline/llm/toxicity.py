"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

*Folding.*  Letters that look like Latin ones, full-width letters and digits or
signs in place of letters become the letter meant; letters that share a substitute
(i, l) become one.  What is left is the sequence of words between blanks.

*Lexicon.*  Learned from labelled rows.  Entries are whole words and beginnings
of words.  A weight is the logarithm of how much more often an entry stands in
texts labelled toxic than in others; of a word's entries the one with the largest
weight stays, the shorter one first.  An entry must be the strongest of enough
toxic texts, or within `margin` of it, so that words which merely stand beside
toxic ones drop out.  Equal texts count once.

*Exceptions.*  A matched word with its neighbour is an exception phrase when the
pair occurs often enough in texts that aren't toxic and never in toxic ones, or
when the caller names it.  A match inside an exception phrase doesn't count.

*Score.*  The sum of the longest matches' weights, as such and divided by the
number of words, enters a logistic curve, fitted to counts over all labelled rows
in cells of these two numbers.

Defined results: a null or empty text has no match and gets the score of no match.
Ids may be null or repeated; each row is scored.  Labels that are null don't
count; of several labels of one id the largest does.  Without a toxic or a clean
labelled text the lexicon is empty and the score 0; an empty table gives no rows.  A
text's matches are sorted against its exception phrases, however long it is.  Columns besides `doc_id` and
`text` (`toxic` of the labels) are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import mapped, remainder, slices, stored, unused

#: Look-alikes and the letters meant.
LOOKALIKES = {
    "a": "аαɑ4@", "b": "вьß8", "c": "сϲ", "d": "ԁ", "e": "еεё3", "g": "ɡ9", "h": "һн", "i": "іιíıl1|", "j": "ј",
    "k": "кκ", "m": "м", "n": "ո", "o": "оοσ0", "p": "рρ", "q": "ԛ", "s": "ѕ5$", "t": "тτ7", "u": "υս", "v": "ν",
    "w": "ԝ", "x": "хχ", "y": "уγ",
}
_FOLD = {ord(x): to for to, many in LOOKALIKES.items() for x in many if x not in "ßíё"}
_FOLD |= {0xFF41 + i: chr(97 + i) if i != 11 else "i" for i in range(26)}
_FOLD |= {x: None for x in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
_FOLD_ASCII = str.maketrans("l1|0345789@$", "iiioeastbgas")
_WORD = re.compile(r"[^\W\d_]+")

#: Lengths of word beginnings that may become entries; longer words enter whole too.
BEGIN, LONGEST = range(4, 8), 32


def folded(text: str | None) -> list[str]:
    """Words of the folded text."""
    if not text:
        return []
    if text.isascii():
        return _WORD.findall(text.lower().translate(_FOLD_ASCII))
    return _WORD.findall(text.lower().translate(_FOLD))


def entries(word: str) -> list[str]:
    """What a word may be matched by: its beginnings, then itself between blanks."""
    return [" " + word[:k] for k in BEGIN if k < len(word)] + [f" {word[:LONGEST]} " if len(word) <= LONGEST else " " + word[:LONGEST]]


def prefix(word: str) -> str:
    """What all entries of a word have in common; parts of a lexicon are dealt by it."""
    return word[: BEGIN[0]]


@dataclass
class Part:
    """A share of a table of keys, as the tasks get it."""

    weights: dict[str, float]
    exceptions: list[str]


class Table:
    """Keys (head, key, toxic, clean, phrase) where they lie, dealt by `head` into parts of about `most` keys.

    All entries of a word and the phrases it is matched in lie in one part, so parts
    can be matched one after the other and their sums added.
    """

    def __init__(self, keys: DataFrame, toxic: int, clean: int, most: int, named: Sequence[str] = ()):
        self.keys, self.toxic, self.clean, self.named = keys, toxic, clean, sorted(named)
        self.parts = max(1, math.ceil(keys.count() / most))

    def part(self, i: int) -> Part:
        mine = self.keys.where(F.pmod(F.xxhash64("head"), F.lit(self.parts)) == i)
        weights, phrases = {}, set(self.named)
        for r in mine.select("key", "toxic", "clean", "phrase").toLocalIterator():
            if r["phrase"]:
                phrases.add(r["key"])
            else:
                weights[r["key"]] = weighed(r["toxic"], r["clean"], self.toxic, self.clean)
        return Part(weights, sorted(phrases))

    def __iter__(self) -> Iterator[Part]:
        return (self.part(i) for i in range(self.parts))


@dataclass
class Model:
    """What scoring needs; the lexicon stays a table and is sent in parts."""

    table: Table | None
    curve: tuple[float, float, float]

    @property
    def weights(self) -> dict[str, float]:
        return {k: w for p in self.table or () for k, w in p.weights.items()}

    @property
    def exceptions(self) -> frozenset[str]:
        return frozenset(x for p in self.table or () for x in p.exceptions)


def weighed(n: int, also: int, toxic: int, clean: int) -> float:
    return math.log((n + 0.5) / (toxic + 1)) - math.log((also + 0.5) / (clean + 1))


class Matcher:
    def __init__(self, weights: dict[str, float], exceptions: Sequence[str]):
        self.found = ahocorasick.Automaton()
        for x in exceptions:
            self.found.add_word(x, (len(x), 0.0, True))
        for x, w in weights.items():
            self.found.add_word(x, (len(x), w, False))
        self.empty = not len(self.found)
        if not self.empty:
            self.found.make_automaton()

    def hits(self, words: list[str]) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the longest match at each word, outside exception phrases."""
        if self.empty or not words:
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight, exception) in self.found.iter(f" {' '.join(words)} "):
            start = end + 1 - size
            if exception:
                spared.append((start, end))
            elif start not in best or size > best[start][0]:
                best[start] = (size, weight)
        # A match is spared if some phrase that begins no later ends no earlier.
        spared.sort()
        begins = [a for a, _ in spared]
        reach = [0, *accumulate((b for _, b in spared), max)]
        return [
            (s, s + size - 1, w)
            for s, (size, w) in best.items()
            if reach[bisect_right(begins, s)] < s + size - 1
        ]


def features(total: float, n_words: int) -> tuple[float, float]:
    """Weight as such and by length."""
    return math.log1p(total), math.log1p(100 * total / max(1, n_words))


def counted(rows: DataFrame, of: Callable[..., Iterator[str]], floor: int, *more: str) -> DataFrame:
    """(key, toxic, clean): texts that `of(words, toxic, *more)` names a key for, counted within tasks first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen = (Counter(), Counter())

        def out() -> Iterator[dict]:
            keys = list(seen[0].keys() | seen[1].keys())
            if keys:
                yield {"key": keys, "toxic": [seen[1][k] for k in keys], "clean": [seen[0][k] for k in keys]}
            seen[0].clear()
            seen[1].clear()

        for batch in slices(batches, "text", 4 << 20):
            for text, toxic, *x in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", *more)), strict=True):
                seen[toxic].update(of(folded(text), toxic, *x))
            if len(seen[0]) + len(seen[1]) > 400_000:
                yield from out()
        yield from out()

    sums = mapped(rows.select("text", "toxic", *more), work, "key string,toxic bigint,clean bigint")
    sums = sums.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return sums.where(F.col("toxic") + F.col("clean") >= floor)


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(text, toxic 0 or 1): labelled rows, equal texts once."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("text")).where(
        "_id is not null and text is not null"
    )
    known = (
        labels.where(F.col(label).isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("_id"))
        .agg((F.max(label) > 0).cast("int").alias("toxic"))
    )
    digest = rows.select("_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("n"))
    once = (
        digest.join(known, "_id").groupBy("h", "n").agg(F.min("_id").alias("_id"), F.max("toxic").alias("toxic"))
    )
    once = once.groupBy("_id").agg(F.max("toxic").alias("toxic"))
    return rows.join(once, "_id").select("text", "toxic")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    support: int = 5,
    least: float = 2.0,
    margin: float = 1.0,
    most: int = 5_000,
    exceptions: Sequence[str] = (),
) -> Model:
    """Lexicon, exceptions and curve from the labelled rows among `docs`.

    No key is left out for the number of keys: counts are joined and filtered where
    they lie.  `most` sizes what is sent at a time, ten times as many keys; a larger
    lexicon is matched in several passes.
    """
    rows = stored(labelled(docs, labels, label))
    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    if not toxic or not clean:
        return Model(None, (-40.0, 0.0, 0.0))

    def candidates(words: list[str], _: int) -> Iterator[str]:
        return {e for w in set(words) for e in entries(w)}

    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    head = F.substring(F.trim("key"), 1, BEGIN[0]).alias("head")
    heavy = counted(rows, candidates, support).where((F.col("toxic") >= support) & (weight >= least))
    heavy = stored(heavy.select(head, "key", "toxic", "clean", F.lit(False).alias("phrase")))
    strong = _strongest(rows.where("toxic = 1"), Table(heavy, toxic, clean, 10 * most), support, margin)
    lexicon = stored(heavy.join(strong, "key", "left_semi"))
    phrases = _spared(rows, Table(lexicon, toxic, clean, 10 * most), support)
    named = {f" {' '.join(folded(x))} " for x in exceptions if folded(x)}
    table = Table(stored(lexicon.unionByName(phrases)), toxic, clean, 10 * most, named)
    return Model(table, _curve(rows, table))


def _strongest(rows: DataFrame, table: Table, support: int, margin: float) -> DataFrame:
    """(key): entries that are the strongest of enough texts, or within `margin` of it."""
    spark = rows.sparkSession

    def best(weights: dict[str, float], words: list[str]) -> list[tuple[float, int, str]]:
        own = [[(weights[e], -len(e), e) for e in entries(w) if e in weights] for w in set(words)]
        return [max(x) for x in own if x]

    top = rows.withColumn("top", F.lit(float("-inf")))
    for part in table if table.parts > 1 else ():
        sent = spark.sparkContext.broadcast(part.weights)

        def raised(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[dict]:
            for batch in slices(batches, "text", 4 << 20):
                text, before = batch.column("text"), batch.column("top").to_pylist()
                found = (best(sent.value, folded(t)) for t in text.to_pylist())
                yield {
                    "text": text,
                    "toxic": batch.column("toxic"),
                    "top": [max([b, *(w for w, _, _ in f)]) for b, f in zip(before, found, strict=True)],
                }

        top = stored(mapped(top, raised, "text string,toxic int,top double"))
        sent.destroy()

    found = []
    for part in table:
        sent = spark.sparkContext.broadcast(part.weights)

        def credited(words: list[str], _: int, known: float, sent=sent) -> Iterator[str]:
            of = best(sent.value, words)
            least = max([known, *(w for w, _, _ in of)]) - margin
            return {e for w, _, e in of if w >= least}

        found.append(stored(counted(top, credited, support, "top").select("key")))
        sent.destroy()
    return reduce(DataFrame.unionByName, found)


def _spared(rows: DataFrame, table: Table, support: int) -> DataFrame:
    """Phrases of a matched word and a neighbour that only clean texts have, as rows of a table of keys."""
    found = []
    for part in table:
        sent = rows.sparkSession.sparkContext.broadcast(part.weights)

        def pairs(words: list[str], _: int, sent=sent) -> Iterator[str]:
            weights = sent.value
            hit = [any(e in weights for e in entries(w)) for w in words]
            return {
                f"{prefix(words[i] if hit[i] else words[i + 1])}\t {words[i]} {words[i + 1]} "
                for i in range(len(words) - 1)
                if hit[i] != hit[i + 1] and len(words[i]) + len(words[i + 1]) <= 2 * LONGEST
            }

        found.append(stored(counted(rows, pairs, support).where("toxic = 0")))
        sent.destroy()
    at = F.split("key", "\t")
    each = reduce(DataFrame.unionByName, found).select(at[0].alias("head"), at[1].alias("key"), "toxic", "clean")
    # Two words that are matched in different parts name their phrase twice: no neighbour there.
    once = each.groupBy("key").agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in ("head", "toxic", "clean")))
    return once.where("_n = 1").select("head", "key", "toxic", "clean", F.lit(True).alias("phrase"))


def _summed(rows: DataFrame, table: Table) -> tuple[DataFrame, str, object]:
    """`rows` with the sums of all parts but the last in a new column, its name, and the last part, sent."""
    into = unused(rows, "_sum")
    schema = T.StructType([*rows.schema.fields, T.StructField(into, T.DoubleType())])
    at = [x.lower() for x in rows.columns].index("text")
    out = rows.withColumn(into, F.lit(0.0))
    for i, part in enumerate(table):
        sent = rows.sparkSession.sparkContext.broadcast((part.weights, part.exceptions))
        if i < table.parts - 1:

            def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                for batch in slices(batches, batch_text, 4 << 20):
                    texts, before = batch.column(at).cast(pa.string()).to_pylist(), batch.column(-1).to_pylist()
                    now = [b + _sum(sent, folded(t)) for b, t in zip(before, texts, strict=True)]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(now, pa.float64())], names=batch.schema.names)

            batch_text = rows.columns[at]
            out = stored(out.mapInArrow(work, schema))
            sent.destroy()
    return out, into, sent


def _sum(sent, words: list[str]) -> float:
    return sum(w for _, _, w in _matcher(sent).hits(words))


def _curve(rows: DataFrame, table: Table) -> tuple[float, float, float]:
    """Logistic curve by Newton steps over counts in cells of the two features."""
    ready, into, sent = _summed(rows, table)

    def cell(words: list[str], _: int, before: float) -> Iterator[str]:
        x, y = features(before + _sum(sent, words), len(words))
        return {f"{round(4 * x)}:{round(4 * y)}"}

    cells = counted(ready, cell, 1, into).collect()  # at most some hundred: both features are logarithms
    x = np.array([[1.0, *(int(v) / 4 for v in r["key"].split(":"))] for r in cells])
    n1, n0 = (np.array([r[k] for r in cells], float) for k in ("toxic", "clean"))
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (n1 - (n1 + n0) * p) - 0.1 * beta
        curvature = (x * ((n1 + n0) * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        move = np.linalg.solve(curvature, gradient)
        beta += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return tuple(beta.tolist())


_OPEN: dict = {}


def _matcher(sent) -> Matcher:
    """The automaton of a broadcast (weights, exceptions), built once per worker."""
    value = sent.value
    if _OPEN.get("of") is not value:
        _OPEN.update(of=value, matcher=Matcher(*value))
    return _OPEN["matcher"]


def scored(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """`docs` with a score from 0 to 1; the score is a function of `text` alone."""
    a, b, c = model.curve
    at = [x.lower() for x in docs.columns].index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())])
    none = docs.sparkSession.createDataFrame([], "head string,key string,toxic bigint,clean bigint,phrase boolean")
    ready, _, sent = _summed(docs, model.table or Table(none, 0, 0, 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, docs_text, 4 << 20):
            out = []
            texts, before = batch.column(at).cast(pa.string()).to_pylist(), batch.column(-1).to_pylist()
            for text, s in zip(texts, before, strict=True):
                words = folded(text)
                x, y = features(s + _sum(sent, words), len(words))
                out.append(1 / (1 + math.exp(-min(40.0, max(-40.0, a + b * x + c * y)))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.float64())], names=[*batch.schema.names[:-1], into]
            )

    docs_text = docs.columns[at]
    return ready.mapInArrow(work, schema)


def is_held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 4) == 2


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted; labels of held-out rows are not learned from."""
    model = fit(docs.where(~is_held_out(F.col("doc_id"))), labels)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scored(rows, model).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` that score below the threshold, with all their columns."""
    model = fit(docs.where(~is_held_out(F.col("doc_id"))), labels)
    score = unused(docs, "score")
    return scored(docs, model, score).where(F.col(score) < threshold).drop(score)
