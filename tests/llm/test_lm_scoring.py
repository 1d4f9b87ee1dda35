from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import context_mixing as M
from plumbline.llm import lm_scoring as L
from plumbline.llm.lm_scoring import lm_scores


def prose(rng, k):
    return " ".join("".join(rng.choices(["ba", "to", "ri", "é", "n"], k=rng.randint(1, 3))) for _ in range(k))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [(i, prose(rng, rng.choice([0, 1, 5, 40]))) for i in range(150)]
    out += [(200, None), (201, " \n"), (None, "ba to"), (5, out[5][1]), (202, "QX zz " * 2000), (203, "\0 a\0")]
    return out


def test_base_score_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "doc_id score", "text word")
    got = sorted(lm_scores(df).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["n_tokens"]))
    assert len(got) == len(rows)

    def words(t):
        return (t or "").encode().lower().split()

    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2

    c = Counter(x for i, t in rows if not held(i) for x in [*words(t), None])
    n, v = c.total(), len(c)
    for r, (i, t) in zip(got, sorted(rows, key=lambda x: (x[0] is None, x[0], len(words(x[1])))), strict=True):
        w = [*words(t), None]
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["train_tokens"]) == (i, held(i), len(w), n)
        assert r["n_known"] == sum(x in c for x in w)
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r["score"] < 0 and r["bits_per_byte"] > 0


def test_empty_table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert lm_scores(df.limit(0)).count() == 0


def model(texts, aside):
    keys, n = np.unique(M.keys_of(texts)[0], return_counts=True)
    slots, sums = M.node_counts(keys, [n])
    z, o = (np.bincount(slots.astype(np.int64), sums[:, i], 1 << M.MOST_BITS) for i in (0, 1))
    table = np.where(z + o > 0, M.logits(z, o), 0).astype(np.int8)
    keys, n = np.unique(M.keys_of(aside)[0], return_counts=True)
    return table, M.learn(table, keys, n)[0]


def test_model_is_a_distribution_and_learns():
    rng = random.Random(2)
    train, aside, other = ([prose(rng, 60).encode() for _ in range(k)] for k in (60, 15, 10))
    table, weights = model(train, aside)
    # The probabilities of all bytes after any context sum to one, in each mixer.
    for context in (b"\0\0\0\0\0", b"ba to", b"zzzzz"):
        high = int.from_bytes(context, "big") << 8
        keys = np.array([high | b for b in range(256)], np.uint64)
        assert np.allclose(np.exp(-M.cost(table, weights, keys)).sum(axis=0), 1, atol=1e-4)
    scorer = M.Scorer(table, weights, cache_bits=6, most=500)
    fresh = M.Scorer(table, M.fresh_weights())
    assert np.allclose(scorer.scores(other), M.Scorer(table, weights).scores(other))
    assert np.allclose(scorer.scores(other[:1]), scorer.scores(other)[:1])
    bits = -scorer.scores(other).sum() / math.log10(2) / sum(map(len, other))
    assert bits < 2.6  # five syllables and blanks; uniform bytes would take eight
    assert scorer.scores(other).sum() > fresh.scores(other).sum()


def test_cost_equals_single_steps():
    """The vectorised mixers against one decision at a time."""
    rng = random.Random(3)
    table, weights = model([prose(rng, 50).encode() for _ in range(20)], [b"ba to ri"])
    keys, _ = M.keys_of([b"Ba ton\xc3\xa9", None])
    for key, got in zip(keys, M.cost(table, weights, keys), strict=True):
        one = np.array([key])
        for m, w in enumerate(weights):
            total = 0.0
            for bit in range(8):
                x, gates = M.inputs(table, M.bases(one), one, bit)
                p = 1 / (1 + math.exp(-float(x[0].astype(float) @ w[gates[m][0]])))
                total -= math.log(p if (int(key) >> (7 - bit)) & 1 else 1 - p)
            assert math.isclose(total, got[m], rel_tol=1e-3, abs_tol=1e-3)


def test_no_contexts_share_a_place(spark, rows):
    """Logits of every order against counts in dictionaries, and scores that no bound of a broadcast changes."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    uses = df.selectExpr("coalesce(text, '') text", "cast(coalesce(doc_id, 0) % 3 as int) use").collect()
    grams = L.gram_counts(spark.createDataFrame(uses, "text string, use int")).localCheckpoint()
    low, _ = L.low_tables(grams)
    seen = [Counter(), Counter()]
    for r in uses:
        for key in M.keys_of([r["text"].encode()])[0].tolist():
            for k in M.ORDERS:
                for bit in range(8):
                    at = (k, key >> 8 & (1 << 8 * k) - 1, (key & 255) >> 8 - bit | 1 << bit)
                    if r["use"] == 0:
                        seen[key >> 7 - bit & 1][at] += 1
    got = L.high_logits(grams).where("b > 0").collect()
    assert got
    for r in got:
        key = np.array([r["gram"]], np.uint64)
        table = L._exact(low, [np.array([r[c]]) for c in L._FIRST])
        for bit in range(8):
            for k, v in enumerate(table.found(key, bit)):
                at = (k, r["gram"] >> 8 & (1 << 8 * k) - 1, (r["gram"] & 255) >> 8 - bit | 1 << bit)
                z, o = seen[0][at], seen[1][at]
                assert v[0] == (M.logits(np.array([z]), np.array([o]))[0] if z + o else 0)
    key = lambda r: (r["doc_id"] or -1, r["n_tokens"])
    want = [r["score"] for r in sorted(L.lm_scores(df).collect(), key=key)]
    for most in (0, 50):
        joined = [r["score"] for r in sorted(L.lm_scores(df, most_grams=most).collect(), key=key)]
        assert joined == pytest.approx(want, rel=1e-6)


def test_places_of_grams_are_those_of_a_search(monkeypatch):
    """Tables so small that most slots are taken by others."""
    monkeypatch.setattr(L, "PLACES", ((6, 0x9E3779B97F4A7C15), (4, 0xD6E8FEB86659FD93)))
    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(0, 1 << 48, 90, dtype=np.uint64))
    index = L.Grams(grams)
    assert len(index.rest) > 10
    keys = np.concatenate([rng.permutation(grams), rng.integers(0, 1 << 48, 200, dtype=np.uint64), grams[:3]])
    at = index.places(keys)
    for k, i in zip(keys.tolist(), at.tolist(), strict=True):
        assert grams[i] == k if i >= 0 else k not in grams
    assert (L.Grams(grams[:0]).places(keys) == -1).all() and not len(index.places(keys[:0]))
