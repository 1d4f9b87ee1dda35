"""Phrases whose words stand together more often than chance, by counts in burstable tries.

Phrases of 1 to 5 words are counted, one length after another: every task counts its
phrases in a trie of word ids (`hat_trie`), which spills whole subtrees as sorted
runs; runs are cut into parts by prefix, the first two words, and the runs of a part are
merged there.  A row is the run of a part, not a phrase of it: every task has most of the
frequent phrases, and a larger corpus has more tasks and more phrases of `least`.

Most phrases are too rare to matter, and two things keep them out of the tries.  A
phrase can be frequent only if both phrases of one word less in it are.  And the
phrases that are left are counted by a 32-bit cell of their hash first, as sorted
packed cells: a phrase whose cell holds less than `least` is rare.  What may be
frequent is told to the tasks by a table of bits of fixed size; a false bit costs
counting, no result, as the tries count by the words themselves.

Per language n is the number of all words and f(phrase) that of its occurrences
within pieces, overlaps included.  A candidate has a = f >= `least`.  Each cut
after its first words gives l and r, the counts of both parts, and the score
floor(1000 a n / (l r)), in 38-digit decimals.  The lowest score counts, of equal
ones the first cut.  Candidates inside a longer one with 100 f(longer) >= `share` a
drop out.  A language returns its first `most` by score, a, then phrase in byte order.

Defined results: a null text is empty, a null language is `und`.  Ids are not used,
so repeated rows count each time.  An empty table gives an empty table, and a text
of one huge word or piece is one word or piece.  Columns besides `text` and `lang`
are not read.  Words are told apart by 64-bit hashes within a language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import mapped, slices, stored
from plumbline.llm.hat_trie import WIDTH, HatTrie
from plumbline.llm.shingles import bytes_of, mix, powers

_U = np.uint64
#: Bits of the table that tells tasks what is frequent: 8 MB.
FILTER_BITS = 1 << 26
#: Cells are 32 bits wide and counted in so many parts.
PART_BITS = 8
PARTS = 1 << PART_BITS
#: Phrases of which a run is made at a time.
RUN = 1 << 18
#: Copies of a language's total, so that its rows don't meet in one task.
COPIES = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK[[0x20, 0x09]] = True
_PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
_BYTE = np.random.default_rng(20250613).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)



class Room(NamedTuple):
    """Entries of a container and of a trie, cells of a task, bytes of text and entries to merge at a time."""

    burst: int = 4096
    entries: int = 500_000
    cells: int = 2_000_000
    text: int = 1 << 20
    merge: int = 1 << 20


_RUNS = "lang string,part int,phrases binary,counts binary"
_LEVEL = "lang string,phrase binary,f bigint,bit bigint"
_CELLS = "part int,lang string,cells binary,counts binary,n bigint"


# Words --------------------------------------------------------------------------


def words_of(texts: list[bytes | None], seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Ids of all words, whether a piece begins there, where they start and end, and the lower-cased bytes.

    seed: hash of the language, so the same word has other ids in another one.
    """
    raw = _LOWER[np.frombuffer(b"\n".join(x or b"" for x in texts) + b"\n", np.uint8)]
    gap = _BREAK[raw] | _BLANK[raw]
    first = ~gap
    first[1:] &= gap[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.astype(_U), none.astype(bool), none, none, b""
    at = np.flatnonzero(~gap)
    word = np.cumsum(first[at]) - 1
    lengths = np.bincount(word, minlength=len(starts))
    place = at - starts[word]
    value = _BYTE[raw[at]] * powers(int(lengths.max()))[place]
    ids = mix(np.add.reduceat(value, np.flatnonzero(place == 0)) + _U(seed) * lengths.astype(_U))
    ids[ids == 0] = 1  # 0 stands for a place that no phrase reaches over
    breaks = np.cumsum(_BREAK[raw])[starts]
    opens = np.ones(len(starts), bool)
    opens[1:] = breaks[1:] != breaks[:-1]
    return ids, opens, starts, starts + lengths, raw.tobytes()


def by_language(batch: pa.RecordBatch, column: str) -> Iterator[tuple[str, list[bytes | None]]]:
    """Values of a binary or string column by the language of their rows."""
    groups: dict[str, list[bytes | None]] = {}
    for lang, value in zip(batch.column("lang").to_pylist(), bytes_of(batch.column(column)), strict=True):
        groups.setdefault(lang, []).append(value)
    yield from groups.items()


def in_parts(texts: list[bytes | None], most: int) -> Iterator[list[bytes]]:
    """The texts in lists of about `most` bytes; a longer text is cut where one of its pieces ends."""
    now, size = [], 0
    for x in texts:
        at = 0
        while x and at < len(x):
            end = len(x)
            if end - at > most and (found := _PIECE_END.search(x, at + most)):
                end = found.end()
            now.append(x[at:end])
            size += end - at
            at = end
            if size >= most:
                yield now
                now, size = [], 0
    if now:
        yield now


def seed_of(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))


def phrase_hashes(ids: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of the `size` ids from each place on."""
    n = max(0, len(ids) - size + 1)
    out = np.full(n, seed & (2**64 - 1), _U)
    for k in range(size):
        out = mix((out ^ ids[k : k + n]) * _U(0x9E3779B97F4A7C15) + _U(k + 1))
    return out


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    place = hashes & _U(FILTER_BITS - 1)
    return (bits[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1) == 1


# Runs and their merge -------------------------------------------------------------


def ids_hashes(ids: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each row of ids, as `phrase_hashes` has it."""
    out = np.full(len(ids), seed, _U)
    for k in range(ids.shape[1]):
        out = mix((out ^ ids[:, k]) * _U(0x9E3779B97F4A7C15) + _U(k + 1))
    return out


def ids_of(phrases: bytes, size: int) -> np.ndarray:
    return np.frombuffer(phrases, ">u8").astype(_U).reshape(-1, size)


def cut_by_prefix(lang: str, phrases: list[bytes], counts: list[int], size: int) -> Iterator[dict]:
    """A run's rows: the phrases of a part in order, and their counts."""
    ids, n = ids_of(b"".join(phrases), size), np.array(counts, "<i8")
    part = ids_hashes(ids[:, :2], seed_of(lang)) >> _U(64 - PART_BITS)
    order = np.argsort(part, kind="stable")
    ids, n = ids[order].astype(">u8"), n[order]
    cuts = np.searchsorted(part[order], np.arange(PARTS + 1, dtype=_U)).tolist()
    parts = [(p, a, b) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
    yield {
        "lang": [lang] * len(parts),
        "part": [p for p, _, _ in parts],
        "phrases": [ids[a:b].tobytes() for _, a, b in parts],
        "counts": [n[a:b].tobytes() for _, a, b in parts],
    }


def runs_out(entries: Iterator[tuple[str, bytes, int]], size: int) -> Iterator[dict]:
    held: dict[str, tuple[list[bytes], list[int]]] = {}
    total = 0
    for lang, phrase, n in entries:
        phrases, counts = held.get(lang) or held.setdefault(lang, ([], []))
        phrases.append(phrase)
        counts.append(n)
        total += 1
        if total >= RUN:
            for own, run in held.items():
                yield from cut_by_prefix(own, *run, size)
            held, total = {}, 0
    for own, run in held.items():
        yield from cut_by_prefix(own, *run, size)


def summed(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs as one, each phrase once."""
    ids, n = (np.concatenate(x) for x in zip(*runs, strict=True))
    order = np.lexsort(ids.T[::-1])
    ids, n = ids[order], n[order]
    cut = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]).any(axis=1)))
    return ids[cut], np.add.reduceat(n, cut)


def windows(ids: np.ndarray, size: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(ids, size)


def phrase_runs(tokens: DataFrame, size: int, sent: Broadcast, room: Room) -> DataFrame:
    """Runs of the phrases of `size` words whose bit is set."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        trie = HatTrie(room.burst, room.entries)
        step = WIDTH * (size - 1)
        for lang, ids in sequences(batches):
            if len(ids) < size:
                continue
            hashes = phrase_hashes(ids, size, seed_of(lang))
            here = np.flatnonzero(marked(sent.value, hashes))
            here = here[(windows(ids, size)[here] != 0).all(axis=1)] if len(here) else here
            if not len(here):
                continue
            _, where, counts = np.unique(hashes[here], return_index=True, return_counts=True)
            where = here[where]
            order = np.argsort(ids[where], kind="stable")
            where, counts = where[order], counts[order].tolist()
            firsts = ids[where]
            rests = windows(ids, size)[where][:, 1:].astype(">u8").tobytes()
            cuts = np.flatnonzero(np.append(True, firsts[1:] != firsts[:-1])).tolist() + [len(firsts)]
            heads = firsts.astype(">u8").tobytes()
            for a, b in zip(cuts, cuts[1:], strict=False):
                rest = [rests[step * i : step * (i + 1)] for i in range(a, b)]
                trie.add(lang, heads[WIDTH * a : WIDTH * (a + 1)], rest, counts[a:b])
            yield from runs_out(trie.overflow(), size)
        yield from runs_out(trie.rest(), size)

    return mapped(tokens, work, _RUNS)


def merged(runs: DataFrame, size: int, least: int, room: Room = Room()) -> DataFrame:
    """Phrases of `least` occurrences or more: the runs of a part at a time, folded as they come."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, pieces, held, once = None, [], 0, 0

        def close() -> Iterator[dict]:
            if not pieces:
                return
            ids, n = summed(pieces)
            ids, n = ids[n >= least], n[n >= least]
            place = (ids_hashes(ids, seed_of(now[0])) & _U(FILTER_BITS - 1)).astype(np.int64)
            raw = ids.astype(">u8").tobytes()
            yield {
                "lang": [now[0]] * len(n),
                "phrase": [raw[i : i + WIDTH * size] for i in range(0, len(raw), WIDTH * size)],
                "f": pa.array(n.astype(np.int64)),
                "bit": pa.array(place),
            }

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "part", "phrases", "counts"))
            for lang, part, phrases, counts in zip(*columns, strict=True):
                if (lang, part) != now:
                    yield from close()
                    now, pieces, held, once = (lang, part), [], 0, 0
                pieces.append((ids_of(phrases, size), np.frombuffer(counts, "<i8")))
                held += len(pieces[-1][1])
                if held > room.merge + 2 * once:
                    pieces = [summed(pieces)]
                    held = once = len(pieces[0][1])
        yield from close()

    dealt = runs.repartition("lang", "part").sortWithinPartitions("lang", "part")
    return mapped(dealt, work, _LEVEL)


def filter_of(level: DataFrame) -> np.ndarray:
    """The table of bits that a column `bit` names; its size is fixed."""
    cells = level.select(
        F.shiftright("bit", 6).alias("cell"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("one")
    ).groupBy("cell").agg(F.bit_or("one").alias("one"))
    found = cells.toPandas()
    bits = np.zeros(FILTER_BITS // 64, _U)
    bits[found["cell"].to_numpy(np.int64)] = found["one"].to_numpy(np.int64).view(_U)
    return bits


# What may be frequent ---------------------------------------------------------------


def folded(pieces: list[tuple[np.ndarray, np.ndarray]], most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """One piece with each cell once, its counts summed up to `most`: that many or more."""
    if len(pieces) < 2:
        return pieces
    cells, counts = (np.concatenate(x) for x in zip(*pieces, strict=True))
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], counts[order]
    first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
    return [(cells[first], np.minimum(np.add.reduceat(counts, first, dtype=np.int64), most).astype(counts.dtype))]


class Cells:
    """Counts of 32-bit cells in a task, given out in parts: sorted cells as differences, byte planes apart.

    255 stands for that many or more, which is beyond any use of the sums.
    """

    def __init__(self, most: int = 4_000_000):
        self.most, self.size, self.pieces = most, 0, []

    def add(self, hashes: np.ndarray) -> None:
        cells, counts = np.unique((hashes & _U(0xFFFFFFFF)).astype(np.uint32), return_counts=True)
        self.pieces.append((cells, np.minimum(counts, 255).astype(np.uint8)))
        self.size += len(cells)
        if self.size > 2 * self.most:
            self._fold()

    def _fold(self) -> None:
        self.pieces = folded(self.pieces, 255)
        self.size = sum(len(x) for x, _ in self.pieces)

    def out(self, last: bool = False) -> Iterator[dict]:
        if not last and self.size <= self.most:
            return
        self._fold()
        if self.pieces and (last or self.size > self.most):
            cells, counts = self.pieces[0]
            cuts = np.searchsorted(cells, np.arange(PARTS + 1, dtype=np.uint64) << _U(32 - PART_BITS)).tolist()
            parts = [(p, a, b) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
            for p, a, b in parts:
                own = cells[a:b]
                apart = np.diff(own, prepend=np.uint32(p << (32 - PART_BITS)))  # from where the part begins
                planes = np.ascontiguousarray(apart.view(np.uint8).reshape(-1, 4).T)
                yield {
                    "part": [p], "lang": [None], "cells": [planes.tobytes()],
                    "counts": [counts[a:b].astype(np.uint8).tobytes()], "n": [None],
                }
            self.pieces, self.size = [], 0


def often(cells: DataFrame, least: int) -> DataFrame:
    """(bit) of the cells that hold `least` or more, at most 255: one part at a time, at most 2**24 cells held."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, pieces, size = None, [], 0

        def close() -> Iterator[dict]:
            for own, counts in folded(pieces, 1 << 40):
                full = own[counts >= least]
                if len(full):
                    yield {"bit": pa.array(np.unique(full & (FILTER_BITS - 1)))}

        for batch in batches:
            for part, planes, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "cells", "counts")), strict=True):
                if part != now:
                    yield from close()
                    now, pieces, size = part, [], 0
                apart = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.uint32)[:, 0]
                own = np.cumsum(apart, dtype=np.int64) + (part << (32 - PART_BITS))
                pieces.append((own, np.frombuffer(counts, np.uint8).astype(np.int64)))
                size += len(own)
                if size > 1 << 25:
                    pieces = folded(pieces, 1 << 40)
                    size = len(pieces[0][0])
        yield from close()

    return mapped(cells.repartition("part").sortWithinPartitions("part"), work, "bit bigint")


def word_cells(texts: DataFrame, room: Room) -> DataFrame:
    """Cells of all words, and the number of words of each language (part -1)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cells, totals = Cells(room.cells), Counter()
        for batch in slices(batches, "text", room.text):
            for lang, part in ((x, part) for x, every in by_language(batch, "text") for part in in_parts(every, room.text)):
                ids, *_ = words_of(part, seed_of(lang))
                totals[lang] += len(ids)
                cells.add(phrase_hashes(ids, 1, seed_of(lang)))
            yield from cells.out()
        yield from cells.out(last=True)
        if totals:
            none = [None] * len(totals)
            yield {"part": [-1] * len(totals), "lang": list(totals), "cells": none, "counts": none, "n": list(totals.values())}

    return mapped(texts, work, _CELLS)


def phrase_cells(tokens: DataFrame, size: int, sent: Broadcast, room: Room) -> DataFrame:
    """Cells of the phrases of `size` words both of whose parts of one word less are marked."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cells = Cells(room.cells)
        for lang, ids in sequences(batches):
            if len(ids) >= size:
                good = marked(sent.value, phrase_hashes(ids, size - 1, seed_of(lang)))
                here = good[:-1] & good[1:]
                for k in range(size):
                    here &= ids[k : k + len(here)] != 0
                cells.add(phrase_hashes(ids, size, seed_of(lang))[here])
                yield from cells.out()
        yield from cells.out(last=True)

    return mapped(tokens, work, _CELLS)


def tokens_of(texts: DataFrame, sent: Broadcast, room: Room) -> DataFrame:
    """(lang, ids, codes): ids of marked words, 0 for others and between pieces, as places in the distinct ones."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text", room.text):
            for lang, part in ((x, part) for x, every in by_language(batch, "text") for part in in_parts(every, room.text)):
                ids, opens, *_ = words_of(part, seed_of(lang))
                if not len(ids):
                    continue
                ids = np.where(marked(sent.value, phrase_hashes(ids, 1, seed_of(lang))), ids, _U(0))
                # A 0 before each piece; runs of zeros say no more than one.
                out = np.insert(ids, np.flatnonzero(opens), _U(0))
                keep = out != 0
                keep[1:] |= out[:-1] != 0
                distinct, codes = np.unique(out[keep], return_inverse=True)
                planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
                yield {"lang": [lang], "ids": [distinct.tobytes()], "codes": [planes.tobytes()]}

    return mapped(texts, work, "lang string,ids binary,codes binary")


def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    """Language and ids of each row of tokens."""
    for batch in slices(batches, "codes", 1 << 20):
        for lang, ids, planes in zip(*(batch.column(c).to_pylist() for c in ("lang", "ids", "codes")), strict=True):
            codes = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4")[:, 0]
            yield lang, np.frombuffer(ids, _U)[codes]


def spelling(texts: DataFrame, bits: np.ndarray, room: Room) -> DataFrame:
    """(lang, id, word) of the words whose bit is set."""
    sent = texts.sparkSession.sparkContext.broadcast(bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", room.text):
            for lang, part in ((x, part) for x, every in by_language(batch, "text") for part in in_parts(every, room.text)):
                ids, _, starts, ends, raw = words_of(part, seed_of(lang))
                if not len(ids):
                    continue
                here = np.flatnonzero(marked(sent.value, phrase_hashes(ids, 1, seed_of(lang))))
                unique, where = np.unique(ids[here], return_index=True)
                old = known.get(lang, np.zeros(0, _U))
                fresh = ~np.isin(unique, old, assume_unique=True)
                known[lang] = np.union1d(old, unique[fresh])
                at = here[where[fresh]]
                if len(at):
                    words = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                    own = unique[fresh].astype(">u8").tobytes()
                    yield {"lang": [lang] * len(at), "id": [own[i : i + WIDTH] for i in range(0, len(own), WIDTH)], "word": words}

    found = mapped(texts, work, "lang string,id binary,word binary")
    return found.groupBy("lang", "id").agg(F.max("word").cast("string").alias("word"))


# Scores -----------------------------------------------------------------------------


def scored(levels: list[DataFrame], totals: DataFrame) -> DataFrame:
    """Candidates with a, l, r, n and score of the cut that counts."""
    known = levels[0].select("lang", "phrase", "f")
    for level in levels[1:]:
        known = known.unionByName(level.select("lang", "phrase", "f"))
    candidates = known.where(F.length("phrase") > WIDTH)
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.expr(f"cast(length(phrase) / {WIDTH} as int) - 1"))))
    cuts = cuts.withColumns(
        {"left": F.expr(f"substring(phrase, 1, {WIDTH} * k)"), "right": F.expr(f"substring(phrase, {WIDTH} * k + 1)")}
    )
    first = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rest = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    copies = totals.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    wide, narrow = "decimal(38,0)", "decimal(19,0)"
    score = F.expr(
        f"cast(cast(f as {narrow}) * 1000 * cast(n as decimal(16,0)) as {wide}) div (cast(l as {narrow}) * cast(r as {narrow}))"
    )
    return (
        cuts.join(first, ["lang", "left"])
        .join(rest, ["lang", "right"])
        .withColumn("copy", F.pmod(F.xxhash64("phrase"), F.lit(COPIES)).cast("int"))
        .join(copies, ["lang", "copy"])
        .withColumn("score", score)
        .groupBy("lang", "phrase")
        .agg(F.first("f").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def inside_longer(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the greatest count of a candidate around each phrase of 2 words or more."""
    size = F.expr(f"cast(length(phrase) / {WIDTH} as int)")
    long = candidates.withColumn("size", size).where("size > 2")
    parts = long.withColumn("part_size", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn(
        "at", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("part_size")))
    )
    inner = F.expr(f"substring(phrase, {WIDTH} * at + 1, {WIDTH} * part_size)")
    return parts.select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(
    docs: DataFrame, longest: int = 5, least: int = 100, share: int = 100, most: int = 2000, room: Room = Room()
) -> DataFrame:
    """Per language its first `most` phrases: lang, rank, phrase, a, l, r, n, score."""
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    if not 0 < least < 256:
        raise ValueError("least must lie between 1 and 255")
    cells = stored(word_cells(texts, room))
    totals = cells.where("part < 0").groupBy("lang").agg(F.sum("n").alias("n"))
    # A table is sent, used by one job whose result is kept, and taken back.
    send = docs.sparkSession.sparkContext.broadcast
    sent = send(filter_of(often(cells.where("part >= 0"), least)))
    tokens, levels = stored(tokens_of(texts, sent, room)), []
    for size in range(1, longest + 1):
        if size > 1:
            bits = filter_of(often(phrase_cells(tokens, size, sent, room), least))
            sent.destroy()
            sent = send(bits)
        levels.append(stored(merged(phrase_runs(tokens, size, sent, room), size, least, room)))
        sent.destroy()
        if size < longest:
            sent = send(filter_of(levels[-1]))

    every = stored(scored(levels, totals))
    kept = every.join(inside_longer(every), ["lang", "phrase"], "left").where(
        f"longer is null or 100 * longer < {share} * a"
    )
    # Words are looked up for those that may be returned only: the first by score and a, ties included,
    # of each share of a language, then of the language.
    front = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(COPIES))).drop("longer")
    for by in (["lang", "part"], ["lang"]):
        by_score = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"))
        front = front.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= most)
    front = stored(front.drop("place", "part"))
    ids = F.expr(f"transform(sequence(0, cast(length(phrase) / {WIDTH} as int) - 1), i -> substring(phrase, {WIDTH} * i + 1, {WIDTH}))")
    named = stored(front.select("*", F.posexplode(ids).alias("i", "id")))
    needed = named.select("lang", F.col("id").alias("phrase")).distinct().join(levels[0], ["lang", "phrase"])
    named = named.join(spelling(texts, filter_of(needed), room), ["lang", "id"])
    spelled = named.groupBy("lang", "phrase", "a", "l", "r", "n", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("spelled")
    )
    final = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("spelled"))
    return (
        spelled.withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= most)
        .select("lang", F.col("rank").cast("bigint").alias("rank"), F.col("spelled").alias("phrase"), "a", "l", "r", "n", "score")
    )
