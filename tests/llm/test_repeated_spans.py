from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import repeated_spans as R
from plumbline.llm.suffix_groups import suffix_array


def brute(docs, length):
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(x[p : p + length] for _, x in texts for p in range(len(x) - length + 1))
    out = []
    for i, x in texts:
        gone = [False] * (len(x) + 1)
        for p in range(len(x) - length + 1):
            if seen[x[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        kept = bytes(c for c, g in zip(x, gone, strict=False) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone[: len(x)]))
        out.append((i, len(x), len(x) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cut(spark, docs, sizes=None, frequent=2000):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "doc_id lo", "text cuts", "1 copy", "text kept", "2 id")
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r[c] for c in names) for r in R.without_repeats(df, 200, sizes, frequent).collect()), key=str)


def corpus(seed, n, size):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé ", k=rng.randint(2, 9)))
    passages = [" ".join(word() for _ in range(size)) for _ in range(4)]
    docs = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.choice([0, 3, size])))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts += [p[a:] if rng.random() < 0.5 else p, " ".join(word() for _ in range(rng.choice([0, 1, 5, size])))]
        docs.append((i, "".join(parts)))
    docs += [(i + n, rng.choice(docs)[1]) for i in range(n // 8)]
    docs += [(900, "ab" * 150), (901, "a" * 333), (902, "a" * 333 + "b"), (903, None), (904, ""), (905, "short"), (None, docs[0][1])]
    return [*docs, docs[3], (3, "x" * 39), (3, "x" * 40), (None, None)]


@pytest.mark.parametrize(("seed", "length", "frequent"), [(1, 40, 2000), (2, 40, 2), (3, 200, 2000)])
def test_equals_brute_force(spark, seed, length, frequent):
    """With frequent grams dealt further in the second case; stretches cut texts in all."""
    docs = corpus(seed, 70, length // 4)
    expected = brute(docs, length)
    assert sum(r[2] for r in expected) > 5000
    assert cut(spark, docs, R.Sizes(length, 32 if length > 100 else 8, 700, 3000), frequent) == expected


def test_empty_table(spark):
    assert cut(spark, []) == []


def test_suffix_array_equals_sorting():
    rng = random.Random(7)
    for _ in range(3000):
        x = [rng.randint(1, rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(40))] * rng.choice([1, 1, 2, 3])
        x.append(0)
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


def test_every_window_has_one_segment_whatever_the_stretches():
    rng = random.Random(8)
    texts = [bytes(rng.choices(b"abc", k=k)) for k in (0, 10, 199, 200, 201, 5000)]
    for stretch in (300, 1 << 20):
        windows, by = Counter(), R.Sizes(200, 32, stretch)
        for pieces in R.stretches(texts, by):
            joined, owner, first, last, gram, hashes = R.segments(pieces, by)
            starts = np.cumsum([0] + [len(x) for *_, x in pieces])
            for o, a, b, g in zip(owner, first, last, gram, strict=True):
                for p in range(a, b + 1):
                    windows[pieces[o][0], pieces[o][1] + p - starts[o]] += 1
                    assert p <= g <= p + 200 - 32
        assert windows == Counter((i, p) for i, x in enumerate(texts) for p in range(len(x) - 199))


def test_ranges_of_a_frequent_gram_hold_every_window_once_and_equal_ones_under_one_key():
    rng = random.Random(9)
    joined = bytes(rng.choices(b"abc", k=600))
    found = list(R.dealt(joined, 100, 268, 268, 5, 200))
    assert sorted(p for _, a, b in found for p in range(a, b + 1)) == list(range(100, 269))
    keys = {p: k for k, a, b in found for p in range(a, b + 1)}
    other = b"z" * 130 + joined[130:350] + b"z" * 200  # equal in the windows from 130 to 150
    again = {p: k for k, a, b in R.dealt(other, 110, 268, 268, 5, 200) for p in range(a, b + 1)}
    assert all(keys[p] == again[p] for p in range(130, 151))
