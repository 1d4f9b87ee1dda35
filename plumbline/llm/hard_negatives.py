"""Hard negatives by lists that a cluster of anchors shares.

Anchors are clustered by direction.  A cluster knows its centre and the largest
angle of a member to it, so the product of any member with a row is at most

    |member| |row| cos(max(0, angle(row, centre) - largest angle)).

A task takes its rows in blocks.  For each cluster it sorts the block's rows by this
bound once; every member of the cluster walks the same list, and ends when the
bound of what is left lies below the score that a row must reach.

Rows are searched twice.  First every anchor looks for its positives, the best rows
of its own label; then, for each positive, for the best rows of other labels whose
score lies in the positive's window.  Each search runs over a share of the rows
first, chosen by hash; what it finds there is a floor for the search over all rows,
which decides.  So a task hands on few rows besides those that count, and what
matches at all is never left out.

Anchors are sent to the tasks in portions of at most `portion` anchors, clusters
together, one pass over the rows for each.  Centres are fitted on at most `fitted`
anchors; they decide speed, not results.  In a block, rows with one vector and label
are held by their smallest ids only, as many as an answer can take.

Scores are integer inner products of floor(256 x).  They are exact: in doubles
where these hold them, else in Python's integers; a score beyond 64 bits is given
as the nearest 64-bit number, and 256 x beyond 1e300 as 1e300.

Defined results: rows without id, label or components, or with a component that is
null, NaN or infinite, take no part; neither do rows whose vector has another length than
most rows have (of equally many, the longer).  A row that repeats id, label and
vector counts once.  Rows that share an id are never each other's partners.
Anchors without positives, and positives without negatives, give no row.  An empty
table gives an empty table.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import mapped, stored

#: Rows of a block, and the first step of a walk.
BLOCK, STEP = 32_768, 512
#: One row in so many is searched first.
SHARE = 64
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1

_ANCHORS = "anchor bigint,vec_id bigint,label bigint,vec binary,cluster bigint,angle double"
_FOUND = "slot bigint,other bigint,score bigint"


class Slots(NamedTuple):
    """What members look for: `want` rows with scores from `low` to `high`."""

    member: np.ndarray
    name: np.ndarray
    low: np.ndarray
    high: np.ndarray


# Vectors ------------------------------------------------------------------------


def matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, as 64-bit integers."""
    top = lambda x: float(np.abs(x).max(initial=0))
    if a.shape[1] * top(a) * top(b) < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x.tolist()], object)
    exact = whole(a) @ whole(b).T
    return np.clip(exact, _LOW, _HIGH).astype(np.int64)


def lengths(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, initial=0, keepdims=True)
    big[big == 0] = 1
    return np.sqrt(((x / big) ** 2).sum(axis=1)) * big[:, 0]


def directions(x: np.ndarray) -> np.ndarray:
    n = lengths(x)
    n[n == 0] = 1
    return x / n[:, None]


def fitted_centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Directions of k clusters of directions, farther ones first to begin with."""
    unit = directions(x)
    chosen = [0]
    near = unit @ unit[0]
    for _ in range(1, min(k, len(unit))):
        i = int(near.argmin())
        chosen.append(i)
        near = np.maximum(near, unit @ unit[i])
    centres = unit[chosen]
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        kept = np.abs(sums).max(axis=1) > 0
        centres = np.where(kept[:, None], directions(sums), centres)
    return centres


def clean_rows(df: DataFrame, vec_id: str, vector: str, label: str, noisy: int, labels: int) -> DataFrame:
    """vec_id, label (each `noisy`-th id's moved on by one) and vec: whole numbers as little-endian doubles."""
    ready = df.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("v")
    ).where("vec_id is not null and label is not null and size(v) > 0")
    ready = ready.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    moved = F.when(F.col("vec_id") % noisy == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            vectors = batch.column("v")
            flat = np.floor(256 * vectors.flatten().to_numpy(zero_copy_only=False)).clip(-1e300, 1e300).astype("<f8")
            ends = np.cumsum([len(x) for x in vectors]).tolist()
            yield {
                "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                "vec": [flat[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)],
            }

    out = stored(mapped(ready.withColumn("label", moved), work, "vec_id bigint,label bigint,vec binary"))
    size = out.groupBy(F.length("vec").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return out.where(F.length("vec") == (size["size"] if size else 0))


# The walk ------------------------------------------------------------------------


def few_of_each(ids: np.ndarray, labels: np.ndarray, vectors: list[bytes], most: int) -> np.ndarray:
    """Places of the rows with the `most` smallest ids of each vector and label; repeated rows count once."""
    _, same = np.unique(np.array(vectors, object), return_inverse=True)
    order = np.lexsort((ids, labels, same))
    a, b, c = same[order], labels[order], ids[order]
    group = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    new = group | np.append(True, c[1:] != c[:-1])
    order, group = order[new], group[new]
    start = np.flatnonzero(group)
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[rank < most]


class Best:
    """The best rows found so far for each slot, by score, then smaller id; `floor` is what a row must reach."""

    def __init__(self, slots: Slots, want: int):
        self.want, self.floor = want, slots.low.copy()
        self.slot, self.other, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, other: np.ndarray, score: np.ndarray) -> None:
        if not len(slot):
            return
        slot, other, score = (np.concatenate(x) for x in ((self.slot, slot), (self.other, other), (self.score, score)))
        # ~score turns the order round without overflow.
        order = np.lexsort((other, ~score, slot))
        slot, other, score = slot[order], other[order], score[order]
        new = np.append(True, (slot[1:] != slot[:-1]) | (other[1:] != other[:-1]) | (score[1:] != score[:-1]))
        slot, other, score = slot[new], other[new], score[new]
        start = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        rank = np.arange(len(slot)) - np.repeat(start, np.diff(np.append(start, len(slot))))
        keep = rank < self.want
        self.slot, self.other, self.score = slot[keep], other[keep], score[keep]
        last = rank == self.want - 1
        self.floor[slot[last]] = np.maximum(self.floor[slot[last]], score[last])


class Portion:
    """Some anchors with what they look for, clusters together."""

    def __init__(self, anchors: dict[str, np.ndarray], centres: np.ndarray, slots: Slots, same_label: bool, want: int):
        self.ids, self.labels, self.vectors = anchors["vec_id"], anchors["label"], anchors["vectors"]
        self.sizes = lengths(self.vectors)
        self.slots, self.same_label, self.want = slots, same_label, want
        self.block, self.step = BLOCK, STEP
        self.clusters = []
        slot_order = np.argsort(slots.member, kind="stable")
        first = np.searchsorted(slots.member[slot_order], np.arange(len(self.ids) + 1))
        for c in np.unique(anchors["cluster"]):
            members = np.flatnonzero(anchors["cluster"] == c)
            own = np.concatenate([slot_order[first[m] : first[m + 1]] for m in members]) if len(members) else members
            if len(own):
                self.clusters.append((centres[c], float(anchors["angle"][members].max()), own))

    def search(self, best: Best, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        """Every cluster walks the block's rows in the order of its bound."""
        unit, size = directions(rows), lengths(rows)
        for centre, widest, own in self.clusters:
            angle = np.arccos(np.clip(unit @ centre, -1, 1))
            # A little more than the bound: rounding must not end a walk too early.
            reach = size * np.cos(np.clip(angle - widest - 1e-6, 0, math.pi)) + 1e-7 * size
            order = np.argsort(-reach, kind="stable")
            reach = reach[order]
            at, step = 0, self.step
            active = own
            while at < len(order):
                longest = self.sizes[self.slots.member[active]]
                # What is left can reach: a negative bound shrinks with the member's length, so 0 serves there.
                top = np.maximum(reach[at], 0) * longest * (1 + 1e-9) + 1
                active = active[best.floor[active] <= top]
                if not len(active):
                    break
                part = order[at : at + step]
                self._meet(best, active, ids[part], labels[part], rows[part])
                at, step = at + step, min(2 * step, 8192)

    def _meet(self, best: Best, active: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        """Scores of slots with some rows; those that reach the floor are kept."""
        for first in range(0, len(active), 256):
            own = active[first : first + 256]
            members, back = np.unique(self.slots.member[own], return_inverse=True)
            score = products(self.vectors[members], rows)[back]
            fits = (score >= best.floor[own][:, None]) & (score <= self.slots.high[own][:, None])
            near = self.labels[members][back][:, None] == labels[None, :]
            fits &= near if self.same_label else ~near
            fits &= self.ids[members][back][:, None] != ids[None, :]
            slot, row = np.nonzero(fits)
            best.add(own[slot], ids[row], score[slot, row])


def searched(rows: DataFrame, portion: Portion) -> DataFrame:
    """Per slot the best rows of every task: slot, other, score."""
    sent = rows.sparkSession.sparkContext.broadcast(portion)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        look: Portion = sent.value
        best = Best(look.slots, look.want)
        ids, labels, vectors = [], [], []

        def close() -> None:
            i, own, raw = np.array(ids, np.int64), np.array(labels, np.int64), vectors
            keep = few_of_each(i, own, raw, look.want + 1)
            look.search(best, i[keep], own[keep], matrix([raw[k] for k in keep.tolist()]))

        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            labels += batch.column("label").to_pylist()
            vectors += batch.column("vec").to_pylist()
            if len(ids) >= look.block:
                close()
                ids, labels, vectors = [], [], []
        if ids:
            close()
        if len(best.slot):
            yield {"slot": pa.array(look.slots.name[best.slot]), "other": pa.array(best.other), "score": pa.array(best.score)}

    return mapped(rows.select("vec_id", "label", "vec"), work, _FOUND)


def best_of(found: DataFrame, want: int) -> DataFrame:
    """(slot, rank, other, score): the first `want` of each slot, merged from what the tasks found."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, seen, rank = None, None, 0
        for batch in batches:
            rows = []
            for slot, other, score in zip(*(batch.column(c).to_pylist() for c in ("slot", "other", "score")), strict=True):
                if slot != now:
                    now, seen, rank = slot, None, 0
                if (other, score) != seen:
                    seen = (other, score)
                    rank += 1
                    if rank <= want:
                        rows.append((slot, rank, other, score))
            if rows:
                yield dict(zip(("slot", "rank", "other", "score"), zip(*rows, strict=True), strict=True))

    dealt = found.repartition("slot").sortWithinPartitions("slot", F.desc("score"), "other")
    return mapped(dealt, work, "slot bigint,rank int,other bigint,score bigint")


def least_of(found: DataFrame, want: int) -> DataFrame:
    """(slot, floor): the score of the last of `want` rows, where so many were found."""
    last = best_of(found, want).where(F.col("rank") == want)
    return last.select("slot", F.col("score").alias("floor"))


# Anchors -------------------------------------------------------------------------


def clustered(rows: DataFrame, is_anchor: Column, fitted: int, size: int, most: int) -> tuple[DataFrame, np.ndarray]:
    """Anchors with a number, their cluster and the angle to its centre; the centres."""
    anchors = stored(rows.where(is_anchor).distinct().withColumn("anchor", F.monotonically_increasing_id()))
    n = anchors.count()
    if not n:
        return anchors.select("anchor", "vec_id", "label", "vec", F.lit(0).cast("bigint").alias("cluster"), F.lit(0.0).alias("angle")), np.zeros((0, 0))
    by_hash = anchors.withColumn("h", F.xxhash64("vec_id", "vec"))
    share = by_hash.where(F.pmod("h", F.lit(1 << 20)) < F.lit(math.ceil((1 << 20) * min(1, fitted / n)))).limit(fitted)
    sample = [bytes(r["vec"]) for r in share.select("vec", "h").orderBy("h").collect()]
    if not sample:
        sample = [bytes(anchors.first()["vec"])]
    centres = fitted_centres(matrix(sample), max(1, min(most, len(sample) // size)))
    sent = rows.sparkSession.sparkContext.broadcast(centres)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                unit = directions(matrix(batch.column("vec").to_pylist()))
                near = np.clip(unit @ sent.value.T, -1, 1)
                own = near.argmax(axis=1)
                yield {
                    **{c: batch.column(c) for c in ("anchor", "vec_id", "label", "vec")},
                    "cluster": pa.array(own), "angle": pa.array(np.arccos(near[np.arange(len(own)), own])),
                }

    return stored(mapped(anchors.select("anchor", "vec_id", "label", "vec"), work, _ANCHORS)), centres


def portions(anchors: DataFrame, portion: int) -> list[Column]:
    """Conditions that deal the anchors into portions of about `portion`: clusters whole, large ones by hash."""
    counts = {r["cluster"]: r["n"] for r in anchors.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    out: list[Column] = []
    room, now = portion, None
    for cluster, n in sorted(counts.items()):
        pieces = -(-n // portion)
        for piece in range(pieces):
            here = F.col("cluster") == cluster
            if pieces > 1:
                here &= F.pmod(F.xxhash64("anchor"), F.lit(pieces)) == piece
            size = -(-n // pieces)
            if now is not None and size > room:
                out.append(now)
                room, now = portion, None
            now = here if now is None else now | here
            room -= size
    return [*out, now] if now is not None else out


def _brought(anchors: DataFrame) -> dict[str, np.ndarray]:
    table = anchors.select("anchor", "vec_id", "label", "cluster", "angle", "vec").toArrow().sort_by("anchor")
    columns = {c: table.column(c).to_numpy() for c in ("anchor", "vec_id", "label", "cluster", "angle")}
    return columns | {"vectors": matrix(table.column("vec").to_pylist())}


def _search(rows: DataFrame, first: DataFrame, anchors: dict, centres: np.ndarray, slots: Slots, same: bool, want: int) -> DataFrame:
    """The first `want` rows of each slot over all rows; a share of them sets the floors."""
    found = least_of(searched(first, Portion(anchors, centres, slots, same, want)), want).toPandas()
    low = slots.low.copy()
    at = np.searchsorted(slots.name, found["slot"].to_numpy(np.int64))
    low[at] = np.maximum(low[at], found["floor"].to_numpy(np.int64))
    return best_of(searched(rows, Portion(anchors, centres, slots._replace(low=low), same, want)), want)


def hard_negatives(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    noisy: int = 7,
    labels: int = 10,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    fitted: int = 8192,
    cluster_size: int = 32,
    clusters: int = 256,
    portion: int = 8192,
) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by `every`.  `window`: percent of the
    positive's score that a negative's must reach and may not pass.
    """
    spark = df.sparkSession
    rows = clean_rows(df, vec_id, vector, label, noisy, labels)
    anchors, centres = clustered(rows, F.col("vec_id") % every == 0, fitted, cluster_size, clusters)
    parts = max(1, rows.rdd.getNumPartitions() // SHARE)
    first = stored(rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(SHARE)) == 0).coalesce(parts))

    out = None
    for here in portions(anchors, portion):
        own = _brought(anchors.where(here))
        n = len(own["anchor"])
        low, high = np.full(n, _LOW), np.full(n, _HIGH)
        look = Slots(np.arange(n), np.arange(n), low, high)
        pairs = stored(_search(rows, first, own, centres, look, True, positives))
        found = pairs.toArrow().sort_by([("slot", "ascending"), ("rank", "ascending")])
        member, score = found.column("slot").to_numpy(), found.column("score").to_numpy()
        # Rounded up, and down, so that 100 score lies between; in Python's integers.
        least = np.array([min(max(-(-window[0] * s // 100), _LOW), _HIGH) for s in score.tolist()], np.int64)
        most = np.array([min(max(window[1] * s // 100, _LOW), _HIGH) for s in score.tolist()], np.int64)
        look = Slots(member, np.arange(len(member)), least, most)
        some = np.flatnonzero(least <= most)
        look = Slots(*(x[some] for x in look))
        negative = _search(rows, first, own, centres, look, False, negatives)
        named = spark.createDataFrame(
            pa.table(
                {
                    "slot": pa.array(np.arange(len(member))),
                    "anchor_id": pa.array(own["vec_id"][member]),
                    "positive_id": found.column("other"),
                    "positive_score": found.column("score"),
                }
            )
        )
        answer = stored(
            negative.join(F.broadcast(named), "slot").select(
                "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            )
        )
        out = answer if out is None else out.unionByName(answer)
    if out is None:
        return spark.createDataFrame(
            [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        )
    return out
