"""Benchmark decontamination: BM25 over the test items, searched with block-max WAND.

The test items are the inverted index; every passage of every training document
is a query.  A word's weight in an item is its BM25 part divided by the item's own
score, so a passage that holds a whole item scores 1 for it and one threshold fits
all items.  Postings lie in blocks with their largest weight.  Passages are
windows of twice the longest item, starting every longest item, so an item that
occurs in a text lies whole in one of them.

For all passages of a slice at once, the sums of the block maxima of their distinct
words show which of them can reach the threshold in any block of items.  Words of
very many items count in this first test by what they give any one item together,
which is little.  The passages left are searched with WAND: lists in the order of their next
item, a pivot where the bounds reach the threshold, then the bounds of the blocks
there, and only then the weights.  Every item that a passage scores at or above
the threshold for is retrieved, none is cut off by rank.

Retrieved pairs are verified: the passage must hold the question and the answer.  It
holds a part when the share of the part's word shingles that it has reaches
`overlap`, or that of the words left when it is edited, by whole words, into some
run of the passage's words.  A part of two words or more may also differ in one word
if the item as a whole reaches `overlap`, so one changed word never hides an item of
five words or more that is retrieved.  The answer is the last line of an item, or its
last sentence if it has one line; an item of one sentence is a question alone.

The index is broadcast.  Items beyond `index_bytes` of text go to further indexes,
each of which all passages are asked against.  Numbers of items, their mean and
largest length and the words' frequencies are taken over all items, so scores and
passages are the same for any number of indexes.

Defined results: null or empty texts and items match nothing; empty tables give no
rows.  Equal items are each found.  Ids may be null or repeated: results carry them as
they are.  Columns besides the ids and texts are not read.  Very long texts are read
on in portions of bounded numbers of words and passages.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import mapped, slices, stored, without
from plumbline.llm.shingles import bytes_of

K1, B = 1.2, 0.75
BLOCK = 32
#: What common words may give an item together, of the 1 that it can score.
COMMON = 0.3
#: Blocks of items in the first test at most: its table has so many columns.
FIRST_BLOCKS = 256
#: Sums of passages and blocks, and words, that the first test holds at once.
CELLS, WORDS = 1 << 20, 1 << 15
#: Bytes of a text that are split into words at once.
PORTION = 1 << 20
#: ASCII punctuation and white space part words; letters of other scripts don't.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: bytes | str | None) -> list[bytes]:
    """Words without ASCII punctuation, A-Z lower-cased."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(_PLAIN).split()


def question_and_answer(item: str) -> tuple[str, str]:
    lines = [x for x in item.splitlines() if words(x)]
    if len(lines) < 2:
        lines = [x for x in re.split(r"(?<=[.?!])\s+", item) if words(x)]
    return (" ".join(lines[:-1]), lines[-1]) if len(lines) > 1 else (item, "")


def shingled(w: Sequence[bytes], size: int) -> set[tuple[bytes, ...]]:
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def edits(part: Sequence[bytes], text: Sequence[bytes]) -> int:
    """Words to change, drop or add until `part` is some run of the words of `text`."""
    number: dict[bytes, int] = {}
    wanted = [number.setdefault(x, len(number)) for x in part]
    have = np.array([number.get(x, -1) for x in text], np.int64)
    places = np.arange(len(have) + 1)
    row = np.zeros(len(have) + 1, np.int64)
    for done, x in enumerate(wanted, 1):
        changed = np.minimum(row[1:] + 1, row[:-1] + (have != x))
        row = np.minimum.accumulate(np.concatenate(([done], changed)) - places) + places
    return int(row.min())


class Figures(NamedTuple):
    """What BM25 takes from all items: their number, mean and largest length, and the items of a word."""

    items: int
    mean: float
    longest: int
    seen: Mapping[bytes, int]


class Index:
    """Items as an inverted index with blocks: what is broadcast."""

    def __init__(self, items: Sequence[tuple[int | None, str]], size: int, figures: Figures):
        kept = [(i, t, w) for i, t in items if (w := words(t))]
        self.ids = [i for i, _, _ in kept]
        n_items, mean, self.longest, seen = figures
        counts = [Counter(w) for _, _, w in kept]
        self.terms = {x: k for k, x in enumerate(sorted({x for c in counts for x in c}))}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for at, ((_, _, w), count) in enumerate(zip(kept, counts, strict=True)):
            part = {
                x: math.log(1 + (n_items - seen[x] + 0.5) / (seen[x] + 0.5))
                * n * (K1 + 1) / (n + K1 * (1 - B + B * len(w) / mean))
                for x, n in count.items()
            }
            own = sum(part.values())
            for x, weight in part.items():
                postings[self.terms[x]].append((at, weight / own))
        self.items = [array("i", (a for a, _ in p)) for p in postings]
        self.weights = [array("d", (b for _, b in p)) for p in postings]
        self.block_max = [array("d", (max(b[k : k + BLOCK]) for k in range(0, len(b), BLOCK))) for b in self.weights]
        self.bound = np.array([max(b) for b in self.weights] + [0.0])  # last: words of no item
        # The words of most items together give no item more than `common_most`: in the first
        # test it stands for all of them.  Of other words the test knows the blocks' maxima.
        self.rare, self.common_most = np.ones(len(postings) + 1, bool), 0.0
        self.rare[-1] = False
        of_item = np.zeros(len(kept))
        for k in sorted(range(len(postings)), key=lambda k: -len(postings[k])):
            for a, b in postings[k]:
                of_item[a] += b
            if of_item.max() > COMMON:
                break
            self.rare[k], self.common_most = False, float(of_item.max())
        self.blocks = min(FIRST_BLOCKS, max(1, len(kept)))
        block, most, cuts = [], [], [0]
        for k, p in enumerate(postings):
            top: dict[int, float] = {}
            for a, b in p if self.rare[k] else ():
                at = a * self.blocks // len(kept)
                top[at] = max(top.get(at, 0.0), b)
            block += top.keys()
            most += top.values()
            cuts.append(len(block))
        self.block, self.most, self.cuts = np.array(block, np.int64), np.array(most), np.array(cuts)
        self.parts = [[words(x) for x in question_and_answer(t)] for _, t, _ in kept]
        self.grams = [[shingled(x, size) for x in parts] for parts in self.parts]

    def shares(self, at: int, text: Sequence[bytes], grams: set, size: int, overlap: float) -> list[float] | None:
        """How much of an item's parts a passage holds; None if that is too little."""
        shares, changed = [], 0
        for part, own in zip(self.parts[at], self.grams[at], strict=True):
            if not part:
                shares.append(1.0)
                continue
            pool = shingled(text, len(part)) if len(part) < size else grams
            share = len(own & pool) / len(own)
            if share < 1:
                n = edits(part, text)
                share = max(share, 1 - n / len(part))
                if share < overlap and (n > 1 or len(part) < 2):
                    return None
                changed += n
            shares.append(share)
        whole = 1 - changed / sum(map(len, self.parts[at]))
        return shares if min(shares) >= overlap or whole >= overlap else None

    def search(self, terms: Sequence[int], threshold: float) -> list[tuple[int, float]]:
        """Items that a query of distinct terms scores at least `threshold` for, by block-max WAND."""
        lists = [[0, t] for t in terms]  # position and term of each list
        found = []

        def item(x) -> int:
            return self.items[x[1]][x[0]]

        while lists:
            lists.sort(key=item)
            total, pivot = 0.0, -1
            for k, (_, t) in enumerate(lists):
                total += self.bound[t]
                if total >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                break
            at = item(lists[pivot])
            while pivot + 1 < len(lists) and item(lists[pivot + 1]) == at:
                pivot += 1
            for x in lists[: pivot + 1]:  # to the block that may hold the pivot's item
                x[0] = bisect_left(self.items[x[1]], at, x[0])
            live = [x for x in lists if x[0] < len(self.items[x[1]])]
            first = [x for x in lists[: pivot + 1] if x[0] < len(self.items[x[1]])]
            if sum(self.block_max[t][p // BLOCK] for p, t in first) >= threshold:
                score = sum(self.weights[t][p] for p, t in first if self.items[t][p] == at)
                if score >= threshold:
                    found.append((at, score))
            for x in live:
                if item(x) == at:
                    x[0] += 1
            lists = [x for x in live if x[0] < len(self.items[x[1]])]
        return found


def spans(first: np.ndarray, size: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of some ranges its numbers, and its value as often."""
    ends = np.cumsum(size)
    number = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(first, size)
    return number, np.repeat(value, size)


def portions(text: bytes, stride: int, width: int, most: int) -> Iterator[tuple[int, list[bytes]]]:
    """A text's words in overlapping portions of at most `most` passages: number of the first passage, words."""
    plain, at, first, held = text.translate(_PLAIN), 0, 0, []
    full = (most - 1) * stride + width
    while at < len(plain):
        cut = plain.find(b" ", at + PORTION)
        cut = len(plain) if cut < 0 else cut
        held += plain[at:cut].split()
        at = cut
        while len(held) > full:
            yield first, held[:full]
            held, first = held[most * stride :], first + most
    if held:
        yield first, held


def together(batch: pa.RecordBatch, stride: int, width: int, most: int) -> Iterator[list[tuple[int, int, list[bytes]]]]:
    """Portions of all texts of a batch with their row, in groups of about `most` passages."""
    group, size = [], 0
    for row, text in enumerate(bytes_of(batch.column("text"))):
        for first, w in portions(text or b"", stride, width, most):
            group.append((row, first, w))
            size += passages(len(w), stride, width)
            if size >= most:
                yield group
                group, size = [], 0
    if group:
        yield group


def passages(n, stride: int, width: int):
    """Passages of a text of so many words, at least one."""
    return np.maximum(1, -(-(n - width) // stride) + 1)


def hits(docs: DataFrame, index: Index, size: int, threshold: float, overlap: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        ix = sent.value
        other, stride, width = len(ix.terms), ix.longest, 2 * ix.longest
        get = ix.terms.get
        floor = threshold - 1e-6
        most = max(1, min(CELLS // ix.blocks, WORDS // stride))

        def verified(text: list[bytes], places: list[int], before: int, term: np.ndarray, best: dict) -> None:
            for k in places:
                span = slice(k * stride, k * stride + width)
                here = np.unique(term[span])
                found = ix.search(here[here < other].tolist(), floor)
                grams = shingled(text[span], size) if found else set()
                for at, score in found:
                    shares = ix.shares(at, text[span], grams, size, overlap)
                    if shares and score > best.get(at, (0.0,))[0]:
                        best[at] = (score, before + k, *shares)

        def search(group: list[tuple[int, int, list[bytes]]], best: dict[int, dict]) -> None:
            texts = [w for _, _, w in group]
            n = np.array([len(w) for w in texts])
            term = np.fromiter((get(x, other) for w in texts for x in w), np.int32, int(n.sum()))
            starts = np.cumsum(n) - n
            doc = np.repeat(np.arange(len(n)), n)
            known = np.flatnonzero(ix.rare[term])
            # A word counts in a passage where it stands first: from the start after its last place on.
            order = known[np.lexsort((known, term[known], doc[known]))]
            last = np.full(len(term), -1, np.int64)
            same = (term[order[1:]] == term[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
            last[order[1:][same]] = order[:-1][same]
            place = known - starts[doc[known]]
            before = np.where(last[known] < 0, -1, last[known] - starts[doc[known]])
            windows = passages(n, stride, width)
            at = np.cumsum(windows) - windows
            low = np.maximum(place - width, -1) // stride + 1  # first passage that holds the place
            low = np.maximum(low, before // stride + 1)  # and that its last place isn't in
            high = np.minimum(place // stride, windows[doc[known]] - 1)
            ok = low <= high
            at_passage, at_term = spans((at[doc[known]] + low)[ok], (high - low + 1)[ok], term[known][ok])
            size_of = np.diff(ix.cuts)
            entry, place = spans(ix.cuts[:-1][at_term], size_of[at_term], at_passage)
            total = int(windows.sum())
            sums = np.bincount(place * ix.blocks + ix.block[entry], ix.most[entry], total * ix.blocks)
            may = np.flatnonzero(sums.reshape(total, ix.blocks).max(axis=1, initial=0.0) >= floor - ix.common_most)
            owner = np.searchsorted(at + windows, may, side="right")
            for d in np.unique(owner).tolist():
                row, first, text = group[d]
                places = (may[owner == d] - at[d]).tolist()
                verified(text, places, first, term[starts[d] : starts[d] + n[d]], best.setdefault(row, {}))

        for batch in slices(batches, "text", 2 << 20):
            best: dict[int, dict] = {}
            for group in together(batch, stride, width, most):
                search(group, best)
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[row], ix.ids[i], *x) for row, found in best.items() for i, x in found.items()]
            if rows:
                names = ("doc_id", "item_id", "score", "passage", "question_overlap", "answer_overlap")
                yield dict(zip(names, zip(*rows, strict=True), strict=True))

    return mapped(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")),
        work,
        "doc_id bigint,item_id bigint,score double,passage int,question_overlap double,answer_overlap double",
    )


def counted(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of items with their shard: (shard, word, n) the items of a word by task, and (items, words, longest) by task."""

    def per_word(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text"):
            seen: Counter = Counter()
            for shard, text in zip(batch.column("shard").to_pylist(), bytes_of(batch.column("text")), strict=True):
                seen.update((shard, w) for w in set(words(text)))
            yield {"shard": [s for s, _ in seen], "word": [w for _, w in seen], "n": list(seen.values())}

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text"):
            sizes = [n for t in bytes_of(batch.column("text")) if (n := len(words(t)))]
            yield {"items": [len(sizes)], "words": [sum(sizes)], "longest": [max(sizes, default=0)]}

    totals = mapped(items, lengths, "items bigint,words bigint,longest bigint")
    return mapped(items, per_word, "shard int,word binary,n bigint"), totals


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    size: int = 5,
    threshold: float = 0.6,
    overlap: float = 0.8,
    index_bytes: int = 16 << 20,
) -> DataFrame:
    """Per document and test item that it holds: doc_id, item_id, score, passage, question_overlap, answer_overlap."""
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(total / index_bytes))
    items = stored(items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int")))
    by_word, totals = counted(items)
    by_word = stored(by_word)
    n, length, longest = totals.agg(F.sum("items"), F.sum("words"), F.max("longest")).first()
    overall = by_word.groupBy("word").agg(F.sum("n").alias("n"))
    found = []
    for k in range(shards):
        some = items.where(F.col("shard") == k).orderBy("item_id", "text").collect()
        # As many words as the shard has: its text bounds them.
        own = by_word.where(F.col("shard") == k).select("word").distinct().join(overall, "word").collect()
        figures = Figures(n or 0, (length or 0) / max(1, n or 0), longest or 1, {bytes(r["word"]): r["n"] for r in own})
        index = Index([(r["item_id"], r["text"]) for r in some], size, figures)
        found.append(hits(docs, index, size, threshold, overlap))
    return reduce(DataFrame.unionByName, found)


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that hold no test item, with all their columns; rows without id stay."""
    return without(docs, contaminated(docs, items, **options).select("doc_id"))
