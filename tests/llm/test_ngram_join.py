from __future__ import annotations

import random

import numpy as np
import pytest

from plumbline.llm import ngram_join as J


def brute(docs, size, share):
    def words(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    sets = [(i, words(t)) for i, t in docs if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= share * len(x | y):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    out = {}
    for i, x in sets:
        out.setdefault(i, set()).add((len(x), find(i)))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.7:
            w = (rng.choice(docs)[1] or "").split()
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
            docs.append((i, rng.choice([" ", "\n", "  "]).join(w).upper() if i % 5 == 0 else " ".join(w)))
        else:
            docs.append((i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 5, 9, 30, 120])))))
    return docs


@pytest.mark.parametrize(("size", "share", "block"), [(5, 80, 1000), (4, 85, 6)])
def test_groups_equal_brute_force(spark, monkeypatch, size, share, block):
    monkeypatch.setattr(J, "BLOCK_SETS", block)  # small blocks meet in pairs
    docs = corpus(size * share + block, 220) + [(900, None), (901, ""), (902, " \n"), (None, "a b c d e f"), (903, "x")]
    docs.append((5, docs[5][1]))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "doc_id part", "text keys")
    got = {}
    for r in J.near_groups(df, size, share).collect():
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            got.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    assert got == brute(docs, size, share)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert J.near_groups(df).count() == 0


def test_one_row_stays_per_group(spark):
    text = " ".join(f"w{i}" for i in range(80))
    docs = [(3, text), (4, text + " more"), (5, "other words"), (None, text), (6, None)]
    left = J.drop_near_duplicates(spark.createDataFrame(docs, "doc_id int, text string"))
    assert left.columns == ["doc_id", "text"]
    assert sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, 3, 5, 6]


@pytest.mark.parametrize("common", [0, 5, 60, 100])
def test_keys_meet_for_every_linked_pair(common):
    """Whatever share of the shingles is frequent."""
    rng = np.random.default_rng(common)
    for n in range(6, 500, 7):
        base = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        frequent = np.sort(rng.permutation(base)[: n * common // 100])
        for changed in {1, 2, n * 6 // 100, n * 8 // 100}:
            kept = rng.permutation(base)[: n - changed]
            other = np.unique(np.append(kept, rng.integers(0, 1 << 62, int(rng.integers(0, changed + 1)), dtype=np.uint64)))
            both = len(np.intersect1d(base, other))
            if 100 * both >= 85 * (len(base) + len(other) - both):
                assert set(J.keys_of(base, 85, frequent).tolist()) & set(J.keys_of(other, 85, frequent).tolist())


def test_frequent_shingles_change_no_result(spark):
    """Every text shares a long passage; groups are those of brute force."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(i, f"{t} {passage}" if rng.random() < 0.9 else t) for i, t in corpus(11, 150)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert len(J.frequent_shingles(df, 4)) > 20
    got = {r["doc_id"]: {(r["n_shingles"], r["component_id"])} for r in J.near_groups(df, 4, 85).collect()}
    assert got == brute(docs, 4, 85)


def test_edges_come_from_one_pass_over_one_exchange(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h")] * 3, "doc_id bigint, text string")
    plan = J.candidate_edges(J.candidate_keys(docs, 4, 85))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.count("Exchange") == 1  # the keys, and the stream over them
    rows = [(3, 1), (2, 1), (2, 1), (9, 5), (7, 8), (7, 6), (7, 9)]
    keys = spark.createDataFrame([(s, k) for k, s in rows], "set_id bigint, key bigint")
    found = {(r["a"], r["b"]) for r in J.candidate_edges(keys).collect()}
    assert found == {(8, 6), (9, 6)}


@pytest.mark.parametrize("common", [0, 5, 60, 100])
def test_linked_sets_share_as_many_keys_as_either_needs(common):
    rng = np.random.default_rng(common + 1)
    for n in range(6, 600, 11):
        base = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        frequent = np.sort(rng.permutation(base)[: n * common // 100])
        for changed in {1, 2, n * 6 // 100, n * 11 // 100}:
            kept = rng.permutation(base)[: n - changed]
            other = np.unique(np.append(kept, rng.integers(0, 1 << 62, int(rng.integers(0, changed + 1)), dtype=np.uint64)))
            both = len(np.intersect1d(base, other))
            if 100 * both >= 80 * (len(base) + len(other) - both):
                (x, least), (y, least2) = (J.keys_and_least(s, 80, frequent) for s in (base, other))
                assert len(np.intersect1d(x, y)) >= max(least, least2) >= 1


def test_long_texts_that_share_a_few_keys_are_no_candidates(spark):
    """Each shares a twelfth of its words with the next one, which made all of them one family."""
    words = [f"w{i}" for i in range(60_000)]
    docs = [(i, " ".join(words[2750 * i : 2750 * i + 3000])) for i in range(20)]
    docs += [(100, docs[3][1] + " more"), (101, docs[3][1] + " other words")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    pairs = J.candidate_edges(J.candidate_keys(df, 5, 80)).groupBy("a", "b").agg({"n": "sum", "need": "min"}).collect()
    assert len(pairs) > 3  # they do share keys
    assert sum(r["sum(n)"] >= r["min(need)"] for r in pairs) == 3  # the three copies
    got = {r["doc_id"]: r["component_id"] for r in J.near_groups(df, 5, 80).collect()}
    assert got == {i: 3 if i >= 100 else i for i, _ in docs}


def test_pairs_of_keys_that_go_on_over_batches(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(30), rng.randrange(12)) for _ in range(260)] + [(99, s) for s in range(40)] * 2
    least = {s: rng.choice([1, 1, 2, 5]) for s in range(40)}
    df = spark.createDataFrame([(s, least[s], k) for k, s in rows], "set_id bigint, least int, key bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        found = J.candidate_edges(df).groupBy("a", "b").agg({"n": "sum", "need": "min"}).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    kept = {(r["a"], r["b"]) for r in found if r["sum(n)"] >= r["min(need)"]}
    groups = {}
    for k, s in rows:
        groups.setdefault(k, set()).add(s)
    counted, sure = {}, set()
    for own in groups.values():
        if len(own) > J.GROUP:
            sure |= {(s, min(own)) for s in own if s != min(own)}
            continue
        ones = sorted(s for s in own if least[s] == 1)
        sure |= {(s, ones[0]) for s in ones[1:]}
        for a in own:
            for b in own:
                if b < a and max(least[a], least[b]) > 1:
                    counted[a, b] = counted.get((a, b), 0) + 1
    assert kept == sure | {(a, b) for (a, b), n in counted.items() if n >= max(least[a], least[b])}
