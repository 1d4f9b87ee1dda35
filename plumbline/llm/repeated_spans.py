"""Removal of byte strings that stand more than once in a corpus, by suffix sorting.

A byte goes if a string of `length` bytes covers it that also starts anywhere else.

*Meeting.*  Suffixes of a whole corpus can't be sorted in one place, so windows of
`length` bytes meet by content: a window belongs to the gram of 32 bytes in it
with the least hash.  Neighbouring windows mostly share it and travel together, as
one segment of text aligned at the gram.  Equal windows have equal grams at equal
places, so they always meet.  A gram that occurs once has no segment to send; which
ones occur more often the tasks learn from a table of bits of fixed size, where a
false bit costs work but no result.

*Frequent grams.*  The gram of a passage that very many texts share would bring
together all that stands around it.  Its windows are dealt further by how far they
reach to the left of the gram, in ranges that double, and by the bytes that all
windows of the range hold in common; equal windows still meet.

*Sorting.*  A task takes the segments that meet in portions, writes each as 8-byte
symbols counted from its gram and sorts their suffixes by Lyndon groups
(`suffix_groups`).  Symbols that stand once in the portion end a string.  Suffixes
that agree in all symbols a window holds whole are neighbours then; the up to seven
bytes before and after these symbols decide which windows are equal.  Equal segments
are sent once by a task and sorted once.

Spans go back to the texts by digest, so copies of a text are cut alike.

Defined results: a null text is empty; an empty text, or one shorter than `length`,
loses nothing.  Ids may be null or repeated; every row is returned, and repeated
rows are copies of each other.  Very long texts are cut into stretches that overlap,
so memory depends on a stretch, and on the text itself where it is put together.  An
empty table gives an empty table.  Columns besides `doc_id` and `text` are not read.
Texts and segments are told apart by 128-bit digests.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import mapped, slices, stored
from plumbline.llm.shingles import bytes_of, mix
from plumbline.llm.suffix_groups import suffix_array

_U = np.uint64
#: Bytes of a symbol.
WIDTH = 8
#: Bits of a place in a stretch of text.
PLACE = 21
#: Bits of the tables of grams that occur more often than once, and of texts that lose something: 16 and 2 MB.
GRAM_BITS, TEXT_BITS = 1 << 27, 1 << 24
#: A gram of so many segments is dealt further, or one that has more than a share of all; so many are at most.
FREQUENT, MOST_FREQUENT = 2_000, 500_000


class Sizes(NamedTuple):
    """Bytes of a string and of a gram; windows of a stretch; bytes of segments to sort together, if more meet than that."""

    length: int = 200
    gram: int = 32
    stretch: int = 1 << 20
    portion: int = 1 << 20


_BYTE = np.random.default_rng(20250307).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_PIECE = "text_id binary,lo bigint,id binary,key bigint,gram bigint,windows bigint,segment binary"


# Segments ------------------------------------------------------------------------


def stretches(texts: list[bytes], by: Sizes) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, offset, bytes) in lists of about a stretch; a longer text in stretches whose windows don't overlap."""
    now, size = [], 0
    for i, x in enumerate(texts):
        for at in range(0, max(1, len(x) - by.length + 1), by.stretch):
            piece = x[at : at + by.stretch + by.length - 1]
            if len(piece) < by.length:
                continue
            if now and size + len(piece) > by.stretch + by.length:
                yield now
                now, size = [], 0
            now.append((i, at, piece))
            size += len(piece)
    if now:
        yield now


_POWERS: dict[str, np.ndarray] = {}


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram from each byte on."""
    if len(_POWERS.get("up", ())) < len(raw):
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(len(raw), 1 << 20), base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _POWERS["up"][: len(raw)], out=sums[1:])
    n = len(raw) - gram + 1
    return mix((sums[gram:] - sums[:n]) * _POWERS["down"][:n])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row."""
    n = len(x) - width + 1
    rows = -(-len(x) // width) + 1
    full = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(x)] = x
    blocks = full.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(pieces: list[tuple[int, int, bytes]], by: Sizes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined bytes, and per segment: number of its piece, first and last window, place of the gram, its hash."""
    joined = b"".join(x for *_, x in pieces)
    raw = np.frombuffer(joined, np.uint8)
    hashes = gram_hashes(raw, by.gram)
    low = _U((1 << PLACE) - 1)
    least = sliding_least((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), by.length - by.gram + 1)
    gram = (least & low).astype(np.int64)
    ends = np.cumsum([len(x) for *_, x in pieces])
    owner = np.repeat(np.arange(len(pieces)), [len(x) for *_, x in pieces])[: len(gram)]
    window = np.flatnonzero(np.arange(len(gram)) + by.length <= ends[owner])
    at = gram[window]
    new = np.append(True, (at[1:] != at[:-1]) | (owner[window][1:] != owner[window][:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    return joined, owner[window][first], window[first], window[last], at[first], hashes[at[first]]


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & _U(64 * len(bits) - 1)
    return (bits[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1) == 1


def gram_counts(texts: DataFrame, by: Sizes) -> DataFrame:
    """(h, n) of all grams that windows belong to."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text", by.stretch):
            for pieces in stretches([x or b"" for x in bytes_of(batch.column("text"))], by):
                h, n = np.unique(segments(pieces, by)[-1], return_counts=True)
                yield {"h": pa.array(h.view(np.int64)), "n": pa.array(n)}

    return mapped(texts, work, "h bigint,n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def dealt(joined: bytes, lo: int, hi: int, gram: int, h: int, length: int) -> Iterator[tuple[int, int, int]]:
    """(key, first window, last window): a frequent gram's windows by range of how far they reach left of it."""
    name = h.to_bytes(8, "little")
    near, far = 0, 1
    while near <= gram - lo:
        a, b = max(lo, gram - far + 1), min(hi, gram - near)
        if a <= b:
            common = joined[gram - near : gram + length - far + 1]
            yield xxhash.xxh3_64_intdigest(name + near.to_bytes(4, "little") + common), a, b
        near, far = far, min(2 * far, length)


def sent_segments(texts: DataFrame, by: Sizes, tables: Broadcast) -> DataFrame:
    """Segments of grams that are marked (tables: bits, and the frequent ones): where they stand, and once a task their bytes; a key where they count."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table, often = tables.value
        seen_texts: dict[bytes, int] = {}
        seen: dict[bytes, int] = {}
        names = [x.split()[0] for x in _PIECE.split(",")]
        for batch in slices(batches, "text", by.stretch):
            own, ids = [], []
            for x in bytes_of(batch.column("text")):
                if x and len(x) >= by.length:
                    text_id = hashlib.sha256(x).digest()[:16]
                    times = seen_texts[text_id] = seen_texts.get(text_id, 0) + 1
                    if times < 3:
                        own.append(x)
                        ids.append(text_id if times == 1 else None)  # the second one is there to be counted
            for pieces in stretches(own, by):
                joined, owner, first, last, gram, hashes = segments(pieces, by)
                use = np.flatnonzero(marked(table, hashes))
                heavy = np.isin(hashes[use], often).tolist()
                starts = np.cumsum([0] + [len(x) for *_, x in pieces])
                shift = (np.array([at for _, at, _ in pieces]) - starts[:-1])[owner[use]].tolist()
                rows = []
                columns = (owner[use], first[use], last[use], gram[use], hashes[use])
                for o, lo, hi, g, h, hot, move in zip(*(c.tolist() for c in columns), heavy, shift, strict=True):
                    text_id = ids[pieces[o][0]]
                    for key, a, b in dealt(joined, lo, hi, g, h, by.length) if hot else ((h, lo, hi),):
                        part = joined[a : b + by.length]
                        name = xxhash.xxh3_128_digest(b"%d %d %d " % (key, g - a, b - a) + part)
                        times = seen[name] = seen.get(name, 0) + 1
                        if text_id is not None or times < 3:
                            some = (key - (1 << 63), g - a, b - a + 1) if times < 3 else (None, None, None)
                            rows.append((text_id, a + move, name, *some, part if times == 1 else None))
                if rows:
                    yield dict(zip(names, zip(*rows, strict=True), strict=True))
                if len(seen) > 1_000_000:  # bounded; forgotten segments are sent again
                    seen = {}
                if len(seen_texts) > 1_000_000:
                    seen_texts = {}

    return mapped(texts, work, _PIECE)


# Sorting ---------------------------------------------------------------------------


def repeated_windows(parts: list[tuple[int, int, bytes]], length: int) -> list[np.ndarray]:
    """Per segment (place of its gram, number of windows, bytes) whether each window stands in another one too."""
    out = [np.zeros(n, bool) for _, n, _ in parts]
    whole = length // WIDTH - 1  # symbols that a window holds whole, wherever it begins
    rest = length - whole * WIDTH  # bytes before and after them: one symbol's
    if rest != WIDTH:
        raise ValueError(f"length must be a multiple of {WIDTH}")
    # Symbols counted from the gram; one more at either side for the bytes beyond the whole ones.
    buffers, shifts = [], []
    for gram, _, raw in parts:
        before = WIDTH + -gram % WIDTH
        after = -(before + len(raw)) % WIDTH + WIDTH
        buffers.append(bytes(before) + raw + bytes(after))
        shifts.append(before)
    sizes = np.array([len(x) // WIDTH for x in buffers])
    symbol = np.frombuffer(b"".join(buffers), ">u8").astype(np.uint64)
    owner = np.repeat(np.arange(len(parts)), sizes)
    begins = np.cumsum(sizes) - sizes
    offset = (np.arange(len(symbol)) - begins[owner]) * WIDTH - np.array(shifts)[owner]
    windows = np.array([n for _, n, _ in parts])[owner]
    valid = (offset >= 0) & (offset < windows + WIDTH - 1)
    _, rank, times = np.unique(symbol, return_inverse=True, return_counts=True)
    alone = np.concatenate([[0], np.cumsum(times[rank] < 2)])
    place = np.flatnonzero(valid)
    place = place[alone[place + whole] == alone[place]]
    if len(place) < 2:
        return out

    # The text to sort: stretches of symbols that the live suffixes need.
    need = np.zeros(len(symbol) + 1, np.int64)
    np.add.at(need, place, 1)
    np.add.at(need, place + whole, -1)
    needed = np.flatnonzero(np.cumsum(need[:-1]) > 0)
    gap = np.flatnonzero(np.append(False, (needed[1:] != needed[:-1] + 1) | (owner[needed][1:] != owner[needed][:-1])))
    text = np.append(np.insert(rank[needed] + 2, gap, 1), [1, 0])
    source = np.append(np.insert(needed, gap, -1), [-1, -1])
    live = np.zeros(len(symbol), bool)
    live[place] = True
    order = np.array(suffix_array(text.tolist()))
    origin = source[order]
    keep = (origin >= 0) & live[origin]
    order, origin = order[keep], origin[keep]

    # Neighbours that agree in all whole symbols are one group.
    same = np.arange(len(order) - 1)
    for k in range(whole):
        same = same[text[order[same] + k] == text[order[same + 1] + k]]
    joined = np.zeros(len(order), bool)
    joined[same + 1] = True
    group = np.cumsum(~joined)
    big = np.bincount(group)[group] > 1
    group, origin = group[big], origin[big]
    for e in range(WIDTH):
        window = offset[origin] - e
        fits = np.flatnonzero((window >= 0) & (window < windows[origin]))
        at = origin[fits]
        edge = symbol[at + whole] >> _U(8 * e)
        if e:
            edge |= symbol[at - 1] << _U(64 - 8 * e)
        by = np.lexsort((edge, group[fits]))
        a, b = group[fits][by], edge[by]
        same = np.flatnonzero((a[1:] == a[:-1]) & (b[1:] == b[:-1]))
        twin = np.zeros(len(by), bool)
        twin[same] = twin[same + 1] = True
        for i in fits[by[twin]].tolist():
            out[owner[origin[i]]][window[i]] = True
    return out


def spans_of(windows: np.ndarray, length: int) -> np.ndarray:
    """(start, end) of the bytes that windows cover, merged."""
    edges = np.diff(np.concatenate([[0], windows.view(np.int8), [0]]))
    return merged_spans(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + length - 1)


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sorted spans of which none touches the next."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(starts)) - 1
    return np.stack([starts[new], reach[last]], axis=1)


def repeated_spans(found: DataFrame, by: Sizes) -> DataFrame:
    """(id, spans): what of a segment is repeated; segments in the order of key and id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        ids, times, parts, size, now = [], [], [], 0, None

        def close() -> Iterator[dict]:
            names, spans = [], []
            for name, n, part, windows in zip(ids, times, parts, repeated_windows(parts, by.length), strict=True):
                if n > 1:
                    windows[:] = True
                if windows.any():
                    names.append(name)
                    spans.append(spans_of(windows, by.length).astype("<i8").tobytes())
            if names:
                yield {"id": names, "spans": spans}

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "id", "gram", "windows", "segment"))
            for key, name, gram, windows, raw in zip(*columns, strict=True):
                if key != now and size > by.portion:
                    yield from close()
                    ids, times, parts, size = [], [], [], 0
                if key == now and ids and ids[-1] == name:
                    times[-1] += 1
                    parts[-1] = (gram, windows, parts[-1][2] or raw)
                    continue
                now = key
                ids.append(name)
                times.append(1)
                parts.append((gram, windows, raw))
                size += windows + by.length
        if ids:
            yield from close()

    dealt_out = found.where("key is not null").select("key", "id", "gram", "windows", "segment").repartition("key")
    return mapped(dealt_out.sortWithinPartitions("key", "id"), work, "id binary,spans binary")


def filter_of(hashes: DataFrame, n: int) -> np.ndarray:
    """The table of `n` bits of a column h."""
    bit = F.col("h").bitwiseAND(F.lit(n - 1))
    cells = hashes.select(
        F.shiftright(bit, 6).alias("cell"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int")).alias("one")
    ).groupBy("cell").agg(F.bit_or("one").alias("one"))
    found = cells.toPandas()
    bits = np.zeros(n // 64, _U)
    bits[found["cell"].to_numpy(np.int64)] = found["one"].to_numpy(np.int64).view(_U)
    return bits


def without_repeats(docs: DataFrame, length: int = 200, sizes: Sizes | None = None, frequent_from: int = FREQUENT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    by = sizes or Sizes(length)
    if by.stretch + by.length > 1 << PLACE:
        raise ValueError("a stretch has too many windows")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = rows.select("text")
    counts = stored(gram_counts(texts, by).where("n > 1"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    bound = max(frequent_from, math.ceil(total / MOST_FREQUENT))
    frequent = np.sort(counts.where(F.col("n") >= bound).select("h").toPandas()["h"].to_numpy(np.int64).view(_U))
    tables = docs.sparkSession.sparkContext.broadcast((filter_of(counts.select("h"), GRAM_BITS), frequent))
    found = stored(sent_segments(texts, by, tables))
    tables.destroy()  # what it was for is kept
    repeated = repeated_spans(found, by)

    places = found.where("text_id is not null").select("text_id", "lo", "id").join(repeated, "id")
    cuts = stored(text_spans(places.select("text_id", "lo", "spans")))
    lead = F.conv(F.substring(F.hex("text_id"), 1, 14), 16, 10).cast("bigint")
    return cut_texts(rows, cuts, filter_of(cuts.select(lead.alias("h")), TEXT_BITS))


def text_spans(places: DataFrame) -> DataFrame:
    """(text_id, spans): all that goes from a text, merged in a stream over its places."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, own, ids, out = None, [], [], []

        def close() -> None:
            if now is not None:
                ids.append(now)
                out.append(merged_spans(*np.concatenate(own).T).astype("<i8").tobytes())

        for batch in batches:
            for text_id, lo, spans in zip(*(batch.column(c).to_pylist() for c in ("text_id", "lo", "spans")), strict=True):
                if text_id != now:
                    close()
                    now, own = text_id, []
                own.append(np.frombuffer(spans, "<i8").reshape(-1, 2) + lo)
            if len(ids) >= 1000:
                yield {"text_id": ids, "spans": out}
                ids, out = [], []
        close()
        if ids:
            yield {"text_id": ids, "spans": out}

    return mapped(places.repartition("text_id").sortWithinPartitions("text_id"), work, "text_id binary,spans binary")


def cut_texts(rows: DataFrame, cuts: DataFrame, bits: np.ndarray) -> DataFrame:
    """Every row with its text cut; texts that nothing goes from stay where they are."""
    sent = rows.sparkSession.sparkContext.broadcast(bits)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    schema = "doc_id bigint,n_bytes bigint,n_removed bigint,n_spans bigint,kept_sha256 string,kept binary"

    def leads(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        ids = [hashlib.sha256(x).digest() for x in texts]
        return ids, marked(sent.value, np.array([int.from_bytes(i[:7], "big") for i in ids], np.uint64))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text"):
            texts = bytes_of(batch.column("text"))
            ids, some = leads(texts)
            each = zip(batch.column("doc_id").to_pylist(), texts, ids, some.tolist(), strict=True)
            out = [(i, len(x), 0, 0, d.hex(), x) for i, x, d, cut in each if not cut]
            if out:
                yield dict(zip(names, zip(*out, strict=True), strict=True))

    def those(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text"):
            texts = bytes_of(batch.column("text"))
            ids, some = leads(texts)
            at = np.flatnonzero(some).tolist()
            if at:
                doc_id = batch.column("doc_id").to_pylist()
                yield {"doc_id": [doc_id[i] for i in at], "text": [texts[i] for i in at], "text_id": [ids[i][:16] for i in at]}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text"):
            out = []
            for i, x, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans")), strict=True):
                spans = np.frombuffer(own or b"", "<i8").tolist()
                edges = [0, *spans, len(x)]
                kept = b"".join(x[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((i, len(x), len(x) - len(kept), len(spans) // 2, hashlib.sha256(kept).hexdigest(), kept))
            yield dict(zip(names, zip(*out, strict=True), strict=True))

    moved = mapped(rows, those, "doc_id bigint,text binary,text_id binary").join(cuts, "text_id", "left")
    return mapped(rows, whole, schema).unionByName(mapped(moved.select("doc_id", "text", "spans"), cut, schema))
