from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from plumbline.llm import packing as P
from plumbline.llm.pretokens import Units, lengths, packed, tokenizer
from plumbline.llm.token_counts import token_counts

NAME = "byte_bpe_50k.json"
ODD = [
    "", None, " ", "  a", "a  b", "a \nb", "x<|endoftext|> y", "a <|endoftext|>", " a b ", "don't I'll  we", "\n\n a",
    "1 2 3 ", "é ü  ", "\x1c a b\x1c c", "a ​ b", "a\u0085 b", "a　b c", "word " * 3000, "x" * 5000,
]


def library(texts):
    return [e.ids for e in tokenizer(NAME).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    parts = ["a", "b", " ", "\n", "'s", "1", "é", "\t", " ", "<|endoftext|>", " word", " other,"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("most", [400_000, 7])
def test_units_give_the_ids_of_the_library(most):
    texts = ODD + random_texts(3000)
    for ranks in (None, "byte_bpe_50k.tiktoken"):
        units = Units(NAME, packed, b"x", most=most, ranks=ranks)
        for _ in range(2):
            got = [np.frombuffer(b"".join(v), "<u4").tolist() for v in units.many(texts)]
            assert got == library(texts)
    given = Units(NAME, lengths, -1, {"word": 1, "b": 1})
    assert [sum(v) for v in given.many(texts)] == [len(x) for x in library(texts)]


def test_ids_of_the_rank_file_are_those_of_the_library():
    """Every document of the smallest tables, as it is and with marks, digits and capitals put in."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    texts += [t.replace("e", "E1'").replace(" t", "\t t").replace(". ", "..  ") for t in texts[:60]]
    texts += [" ".join(t[i : i + 7] for i in range(0, len(t), 5)) for t in texts[:60]]
    units = Units(NAME, packed, b"x", ranks="byte_bpe_50k.tiktoken")
    assert [np.frombuffer(b"".join(v), "<u4").tolist() for v in units.many(texts)] == library(texts)


def test_token_counts(spark):
    texts = ODD + random_texts(200)
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(1, "again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "doc_id n_tokens", "text unit")
    got = Counter(tuple(r) for r in token_counts(df, limit=8, table_size=5).collect())
    ids = library([t for _, t in rows])
    assert got == Counter((i, len((t or "").encode()), len(x), len(x) > 8) for (i, t), x in zip(rows, ids, strict=True))
    assert token_counts(df.limit(0)).count() == 0


def test_best_fit_plan_fills_and_never_overflows():
    rng = random.Random(5)
    for _ in range(60):
        limit = rng.choice([7, 32, 100])
        histogram = Counter(rng.randint(1, limit) for _ in range(rng.choice([0, 1, 5, 400, 3000])))
        used, placed = defaultdict(list), Counter()
        for length, rank, number, first, offset in P.best_fit_plan(histogram, limit):
            assert rank == placed[length]
            placed[length] += number
            for s in range(first, first + number):
                used[s].append((offset, length))
        assert placed == histogram
        for parts in used.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= limit
        # Best-fit decreasing piece by piece needs as many.
        room: list[int] = []
        for length in sorted(histogram.elements(), reverse=True):
            fits = [i for i, r in enumerate(room) if r >= length]
            if fits:
                room[min(fits, key=lambda i: room[i])] -= length
            else:
                room.append(limit - length)
        assert len(used) == len(room)


def test_packed_documents(spark):
    texts = ODD + random_texts(150, 2)
    rows = [(i if i != 40 else None, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).selectExpr("*", "doc_id rank", "text length")
    out = P.pack_documents(df, limit=64).collect()
    want = Counter()
    for (doc_id, _), ids in zip(rows, library([t for _, t in rows]), strict=True):
        ids = np.array([*ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 64 or 64, len(ids), 64), len(ids)] if len(ids) > 64 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in out)
    places = defaultdict(list)
    for r in out:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert P.pack_documents(df.limit(0)).count() == 0
