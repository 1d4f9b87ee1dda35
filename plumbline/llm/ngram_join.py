"""Similarity join on word shingles with signature trees.

Two sets of shingles link when 100 * |intersection| >= share * |union|.

*Classes.*  Documents with equal sets are one class, found by digest; copies are
never paired.

*Families.*  For the join to be split over tasks, sets that may link must meet.
If they link, their symmetric difference has at most d = (100 - share) * (n + m)
/ (100 + share) shingles.  Shingles are dealt by hash into d + 1 + e parts; then
at least 1 + e parts hold the same shingles in both sets.  A set emits a key for
each part that isn't empty, and for its empty ones only if it has more than e of
them, so no link is lost and an accidental meeting takes several equal shingles.
Shingles of many texts are left out of the parts: the bound on the difference
holds for the rest as well, and passages that many texts share make nobody meet.
Sets with few other shingles deal all of theirs; in between, sets do both, so
that linked sets always have one way in common.  Sizes are split into bands with a scheme of parts each; a set near a border emits
under both.  At most d of a set's parts differ from those of a set linked to it, so
they share all its filled parts but d.  Long texts share a part with many others by
chance, but not that many: of a key of few sets all pairs are counted, and those with
too few keys in common are no candidates.  A key of many sets makes all of them
candidates.  The components of candidates are families.

*Trees.*  A family is one block, or if it is too large, blocks by size band and
hash that meet in pairs.  In each meeting the sets lie in the order of size and
least shingle, as leaves of trees whose nodes hold the OR of the token bitmaps
below them and the range of sizes.  A dual traversal drops a pair of nodes when
the overlap that their bitmaps allow is less than what their smallest sizes need,
or when the sizes are too far apart, or when all below is linked already.  At the
leaves the bitmaps give the intersection itself.  Bitmaps number the shingles
that occur twice in the meeting, so they are exact.  Only links that join two
groups leave a task: no pairs within a group of copies or near copies.

Defined results: a null or empty text has an empty set and links with nothing.
Rows without id link with nothing and have no component.  Repeated ids are one
document with the links of all its rows.  Columns besides `doc_id` and `text` are
not read.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import mapped, parted, row_key, slices, stored, without
from plumbline.llm.components import components
from plumbline.llm.shingles import bytes_of, mix, shingle_sets

_U = np.uint64
#: A block's shingles and sets; a meeting of two holds twice that.
BLOCK_SHINGLES, BLOCK_SETS = 500_000, 1_000
FANOUT = 8
#: Sets of a key of which all pairs are counted; a key of more makes a star.
GROUP = 8
#: Sets with a larger share of rare shingles meet by these alone.
MOSTLY_RARE = 0.6


# Candidate keys ---------------------------------------------------------------


def bands(share: int, largest: int, ratio: float = 1.5) -> list[tuple[int, int]]:
    """Sizes (from, to) of each band, up to `largest`."""
    out, low = [], 1
    while low <= largest:
        high = max(low, math.ceil(low * ratio) - 1)
        out.append((low, high))
        low = high + 1
    return out


_BANDS: dict[int, list[tuple[int, int]]] = {}


def schemes(n: int, share: int) -> list[tuple[int, int]]:
    """(band, most shingles that may differ) of the schemes that a set of size n emits under."""
    if share not in _BANDS or _BANDS[share][-1][1] < 4 * n:
        _BANDS[share] = bands(share, max(4 * n, 1 << 20))
    out = []
    for b, (low, high) in enumerate(_BANDS[share]):
        if n > high:
            continue
        if 100 * n < share * low:
            break
        out.append((b, 2 * (100 - share) * high // (100 + share)))
    return out


def dealt(spread: np.ndarray, apart: int, spare: int, name: int) -> tuple[np.ndarray, int]:
    """Keys of the parts of one scheme: of those with shingles, and of all if more than `spare` have none.

    Then how many of them a linked set has at least.
    """
    parts = apart + 1 + spare
    part = (spread % _U(parts)).astype(np.int64)
    sums = np.zeros(parts, np.uint64)
    np.add.at(sums, part, spread | _U(1))
    full = np.bincount(part, minlength=parts) > 0
    keys = mix(sums ^ mix(np.arange(parts, dtype=np.uint64) + _U(name << 32)))
    filled = int(full.sum())
    return keys if parts - filled > spare else keys[full], max(1, filled - apart)


def keys_of(shingles: np.ndarray, share: int, frequent: np.ndarray) -> np.ndarray:
    """Keys of a set: sets that link share at least one, unless they are equal.  frequent: sorted."""
    return keys_and_least(shingles, share, frequent)[0]


def keys_and_least(shingles: np.ndarray, share: int, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """Keys of a set, and how many of them every other set that it links with has at least."""
    n, out = len(shingles), []
    if 100 * n < share * (n + 1):
        return np.zeros(0, np.int64), 1  # so small that only equal sets link
    spread = mix(shingles ^ _U(0x5851F42D4C957F2D))
    rare = spread
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        rare = spread[frequent[at] != shingles]
    # Linked sets differ in at most `apart` rare shingles too.  The shares of rare ones in two
    # linked sets are so close that one of the two ways is open to both.
    by_rare = len(rare) >= _least_rare(share) * n
    by_all = len(rare) <= MOSTLY_RARE * n
    for band, apart in schemes(n, share):
        if by_rare:
            out.append(dealt(rare, apart, apart // 3 + 1, 2 * band))
        if by_all:
            out.append(dealt(spread, apart, apart // 12 + 1, 2 * band + 1))
    # Which scheme two linked sets have in common isn't known here.
    return np.concatenate([keys for keys, _ in out]).view(np.int64), min(least for _, least in out)


def _least_rare(share: int) -> float:
    """What the share of rare shingles is at least in a set linked to one with more than MOSTLY_RARE."""
    t = share / 100  # the other set may lack rare shingles, or have more of the frequent ones
    return min((MOSTLY_RARE - (1 - t)) / t, MOSTLY_RARE * t) - 0.005


def frequent_shingles(docs: DataFrame, size: int, floor: int = 16, most: int = 500_000) -> np.ndarray:
    """Shingles of about `floor` texts or more, the most frequent first to be taken; at most `most`, sorted.

    Counted where a slice of a partition has them twice.  Which they are decides
    who meets, not who links.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text", 4 << 20):
            found = list(shingle_sets(bytes_of(batch.column("text")), size))
            shingle, n = np.unique(np.concatenate(found), return_counts=True)
            often = n > 1
            yield {"shingle": pa.array(shingle[often].view(np.int64)), "n": pa.array(n[often])}

    counts = mapped(docs.select(F.col("text").cast("string").alias("text")), work, "shingle bigint,n bigint")
    top = counts.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= floor)
    chosen = top.orderBy(F.desc("n"), "shingle").limit(most).select("shingle").toPandas()["shingle"]
    return np.sort(chosen.to_numpy(np.int64).view(np.uint64))


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """Per row: doc_id, row, n_shingles, set_id, part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text", 2 << 20):
            found = list(shingle_sets(bytes_of(batch.column("text")), size))
            yield {
                "doc_id": batch.column("doc_id"),
                "row": batch.column("row"),
                "n_shingles": [len(s) for s in found],
                "set_id": [set_id(s) for s in found],
            }

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    numbered = rows.withColumn("row", row_key())
    schema = "doc_id bigint,row bigint,n_shingles bigint,set_id bigint"
    return mapped(numbered, work, schema).withColumn("part", F.shiftright("row", 33))


def candidate_keys(docs: DataFrame, size: int, share: int) -> DataFrame:
    """(set_id, least, key) of all sets; a task gives the keys of equal sets once."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, size))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        given: set[int] = set()
        for batch in slices(batches, "text", 2 << 20):
            ids, leasts, keys = [], [], []
            for s in shingle_sets(bytes_of(batch.column("text")), size):
                i = set_id(s)
                if i not in given:
                    given.add(i)
                    found, least = keys_and_least(s, share, sent.value)
                    ids.append(i)
                    leasts.append(least)
                    keys.append(found)
            if ids:
                each = [len(k) for k in keys]
                yield {
                    "set_id": pa.array(np.repeat(np.array(ids, np.int64), each)),
                    "least": pa.array(np.repeat(np.array(leasts, np.int32), each)),
                    "key": pa.array(np.concatenate(keys)),
                }

    texts = docs.where("doc_id is not null").select(F.col("text").cast("string").alias("text"))
    return mapped(texts, work, "set_id bigint,least int,key bigint")


def pairs_of(key: np.ndarray, ids: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Rows a, b, need: pairs of sets of a key, and of how many keys in common they are candidates.

    The rows are in the order of key and id, each once.  Sets of a key of many, and those that
    need one key only, make a star around the first of them.
    """
    new = np.append(True, key[1:] != key[:-1])
    run = np.cumsum(new) - 1
    many = (np.bincount(run) > GROUP)[run]
    sure = many | (least <= 1)
    at = np.flatnonzero(sure)
    first = np.append(True, run[at][1:] != run[at][:-1])[: len(at)]
    centre = ids[at[first]][np.cumsum(first) - 1]
    apart = ids[at] != centre
    out = [np.stack([ids[at][apart], centre[apart], np.ones(int(apart.sum()), np.int64)])]
    for k in range(1, min(GROUP, len(key))):
        i = np.flatnonzero((run[k:] == run[:-k]) & ~many[k:] & ~(sure[k:] & sure[:-k]))
        out.append(np.stack([ids[i + k], ids[i], np.maximum(least[i + k], least[i]).astype(np.int64)]))
    return np.concatenate(out, axis=1)


def candidate_edges(keys: DataFrame) -> DataFrame:
    """(a, b, n, need): pairs of sets with how many keys they share here, in one stream over one exchange.

    Pairs with need or more in all are candidates; `need` may be less in a part where they are sure.
    """
    if "least" not in keys.columns:
        keys = keys.withColumn("least", F.lit(1))

    def summed(parts: list[np.ndarray]) -> Iterator[dict]:
        a, b, need = np.concatenate(parts, axis=1)
        if len(a):
            order = np.lexsort((b, a))
            a, b, need = a[order], b[order], need[order]
            cut = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            n = np.diff(np.append(cut, len(a)))
            yield {"a": pa.array(a[cut]), "b": pa.array(b[cut]), "n": pa.array(n), "need": pa.array(np.minimum.reduceat(need, cut))}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, parts = None, []  # held: rows of the key that the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy() for c in ("key", "set_id", "least")]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            key, ids, _ = rows
            once = np.append(True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]))
            rows = [x[once] for x in rows]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                parts.append(pairs_of(*(x[:cut] for x in rows)))
            held = [x[cut:] for x in rows]
            if len(held[0]) > GROUP:
                parts.append(pairs_of(*held))
                # Enough to know it by; its last row, too, lest it come again.
                held = [np.append(x[:GROUP], x[-1]) for x in held]
            if sum(x.shape[1] for x in parts) > 500_000:
                yield from summed(parts)
                parts = []
        if held is not None:
            yield from summed([*parts, pairs_of(*held)])

    dealt_out = keys.select("set_id", "least", "key").repartition("key").sortWithinPartitions("key", "set_id")
    return mapped(dealt_out, work, "a bigint,b bigint,n bigint,need bigint")


def set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


# Signature trees --------------------------------------------------------------


def upwards(leaves: np.ndarray, combine: np.ufunc, levels: int) -> list[np.ndarray]:
    """Values of the nodes of each level, from those of the leaves."""
    out = [leaves]
    while len(out) < levels:
        out.append(combine.reduceat(out[-1], np.arange(0, len(out[-1]), FANOUT), axis=0))
    return out


def joined(bits: np.ndarray, sizes: np.ndarray, sides: np.ndarray, share: int) -> np.ndarray:
    """Groups that the links among some sets make, by dual traversal of their tree.

    sides: 1 or 2; where both occur, only sets of different sides are compared.
    """
    levels = 1
    while FANOUT ** (levels - 1) < len(sizes):
        levels += 1
    word = upwards(bits, np.bitwise_or, levels)
    low, high = upwards(sizes, np.minimum, levels), upwards(sizes, np.maximum, levels)
    side = upwards(sides, np.bitwise_or, levels)
    across = bool((sides != sides[0]).any())
    root = list(range(len(sizes)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    def labels() -> np.ndarray:
        now = np.array(root)
        while not np.array_equal(up := now[now], now):
            now = up
        return now

    def pruned(level: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of nodes below which a link that joins two groups may lie."""
        first, last = (upwards(labels(), f, level + 1)[level] for f in (np.minimum, np.maximum))
        one = (first[x] == last[x]) & (first[y] == last[y]) & (first[x] == first[y])
        near = ~one & (100 * high[level][x] >= share * low[level][y]) & (100 * high[level][y] >= share * low[level][x])
        if across:
            near &= (side[level][x] | side[level][y]) == 3
        x, y = x[near], y[near]
        overlap = np.bitwise_count(word[level][x] & word[level][y]).sum(axis=1, dtype=np.int64)
        enough = (100 + share) * overlap >= share * (low[level][x] + low[level][y])
        return x[enough], y[enough]

    def children(level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of nodes, and for each its node's index."""
        first = node * FANOUT
        n = np.minimum(FANOUT, len(low[level - 1]) - first)
        owner = np.repeat(np.arange(len(node)), n)
        return first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n), owner

    def visit(level: int, a: np.ndarray, b: np.ndarray) -> None:
        step = max(64, 1_000_000 // word[level].shape[1])
        for at in range(0, len(a), step):
            x, y = pruned(level, a[at : at + step], b[at : at + step])
            if level == 0:
                for i, j in zip(x.tolist(), y.tolist(), strict=True):
                    i, j = find(i), find(j)
                    root[max(i, j)] = min(i, j)
            elif len(x):
                c, owner = children(level, x)
                d, owner2 = children(level, y[owner])
                c, same = c[owner2], (x == y)[owner][owner2]
                keep = ~same | (c < d) | ((c == d) & (level > 1))  # below a node with itself, each pair once
                visit(level - 1, c[keep], d[keep])

    if levels > 1:
        visit(levels - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))
    return labels()


def meeting(sets: list[np.ndarray], sides: list[int], share: int) -> np.ndarray:
    """For each set the index of one set of its group."""
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sets)), sizes)
    use = shared[where]
    owner, bit = owner[use], number[where[use]]
    # Neighbours in the order are alike: by size on a coarse scale, then by least shared shingle.
    least = np.full(len(sets), np.iinfo(np.int64).max)
    np.minimum.at(least, owner, bit)
    side = np.array(sides, np.uint8)
    order = np.lexsort((sizes, least, (np.log2(sizes) * 4).astype(int), side))
    place = np.empty(len(sets), np.int64)
    place[order] = np.arange(len(sets))
    bits = np.zeros((len(sets), int(shared.sum()) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (place[owner], bit >> 6), _U(1) << (bit & 63).astype(np.uint64))
    return order[joined(bits, sizes[order], side[order], share)][place]


def links(members: DataFrame, share: int) -> DataFrame:
    """(a, b): links that hold the groups of every meeting together.

    members: meeting, side, set_id and shingles, in the order of meeting and set_id.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, ids, sides, sets = None, [], [], []

        def close() -> Iterator[dict]:
            if len(ids) > 1:
                first = meeting(sets, sides, share)
                linked = np.flatnonzero(first != np.arange(len(ids)))
                if len(linked):
                    all_ids = np.array(ids, np.int64)
                    yield {"a": all_ids[linked], "b": all_ids[first[linked]]}

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("meeting", "set_id", "side", "shingles"))
            for m, i, side, raw in zip(*columns, strict=True):
                if m != now:
                    yield from close()
                    now, ids, sides, sets = m, [], [], []
                if not ids or ids[-1] != i:
                    ids.append(i)
                    sides.append(side)
                    sets.append(np.frombuffer(raw, np.uint64))
        yield from close()

    return mapped(members, work, "a bigint,b bigint")


def near_groups(docs: DataFrame, size: int = 5, share: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    rows = stored(sets_of(docs, size))
    sets = stored(
        rows.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"))
    )
    pairs = candidate_edges(candidate_keys(docs, size, share)).groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("need").alias("need"))
    family = components(pairs.where("n >= need").select("a", "b"))
    family = family.unionByName(family.select(F.col("root").alias("node"), "root").distinct())
    members = stored(sets.join(family, sets["set_id"] == family["node"]).select("root", "set_id", "least", "n"))

    # Blocks of families, and the meetings that each block takes part in.
    band = F.floor(F.log(F.col("n")) / (1.0001 * math.log(100 / share))).cast("int")
    members = members.withColumn("band", band)
    whole = members.groupBy("root").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    whole = whole.where(f"c <= {BLOCK_SETS} and s <= {BLOCK_SHINGLES}").select("root")
    in_one = members.join(whole, "root").select("set_id", "least", F.lit(1).alias("side"), F.xxhash64("root").alias("meeting"))
    rest = members.join(whole, "root", "left_anti")
    split = F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    blocks = stored(rest.groupBy("root", "band").agg(split.alias("k")))
    other = blocks.select("root", F.col("band").alias("band2"), F.col("k").alias("k2"))
    placed = rest.join(blocks, ["root", "band"]).withColumn("mine", F.pmod(F.xxhash64("set_id"), F.col("k")).cast("int"))
    met = (
        placed.withColumn("band2", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
        .join(other, ["root", "band2"])
        .withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col("k2") - 1)))
    )
    one = F.struct(F.col("band").alias("band"), F.col("mine").alias("i"))
    two = F.struct(F.col("band2").alias("band"), F.col("theirs").alias("i"))
    in_pairs = met.select(
        "set_id", "least", F.when(one <= two, 1).otherwise(2).alias("side"),
        F.xxhash64("root", F.least(one, two), F.greatest(one, two)).alias("meeting"),
    )
    calls = stored(in_one.unionByName(in_pairs))

    # The shingles of the sets that meet, computed again from texts whose id may be
    # wanted; others than the wanted drop out at the join.
    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        done = set()
        for batch in slices(batches, "text", 2 << 20):
            found = {set_id(s): s for s in shingle_sets(bytes_of(batch.column("text")), size)}
            new = [i for i in found if i not in done]
            done.update(new)
            if new:
                yield {"set_id": new, "shingles": [found[i].tobytes() for i in new]}

    texts = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    asked = parted(texts, calls.select("least"))[0].select("text")
    found = mapped(asked, again, "set_id bigint,shingles binary")
    ready = calls.select("set_id", "side", "meeting").join(found, "set_id").repartition("meeting")
    linked = components(links(ready.sortWithinPartitions("meeting", "set_id"), share))

    # Smallest document of each group; then back to the rows over each part's sets.
    named = sets.join(linked, sets["set_id"] == linked["node"], "left").select(
        "set_id", "least", F.coalesce("root", "set_id").alias("root")
    )
    group = named.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = named.join(group, "root").select("set_id", "component_id")
    here = rows.where("n_shingles > 0").select("part", "set_id").distinct().join(answer, "set_id")
    out = rows.join(here, ["part", "set_id"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
    return out


def drop_near_duplicates(docs: DataFrame, size: int = 5, share: int = 80) -> DataFrame:
    """The rows of `docs` that stay, all columns: of each group the document with the smallest id; rows without id."""
    return without(docs, near_groups(docs, size, share).where("doc_id <> component_id").select("doc_id"))
