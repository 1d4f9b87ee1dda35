from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from plumbline.llm import collocations as C
from plumbline.llm.hat_trie import HatTrie, Inner


def brute(docs, longest, least, share, most):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    frequent = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in frequent.items():
        inside = (
            100 * b >= share * a
            for (other, q), b in frequent.items()
            if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        )
        if any(inside):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    return {
        (lang, rank, p.decode(), -a, x, y, total, -score)
        for lang, rows in out.items()
        for rank, (score, a, p, x, y, total) in enumerate(sorted(rows)[:most], 1)
    }


def rows(df):
    return [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()]


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["the", "Über", "x|y"]
    out = []
    for _ in range(n):
        words = rng.choices(vocabulary, weights=[3] * 12 + [40, 4, 4], k=rng.choice([0, 1, 5, 40, 200]))
        if rng.random() < 0.5:
            at = rng.randrange(len(words) + 1)
            words[at:at] = ["New", "York", "is", "here"]
        gaps = [" ", "  ", "\t", ", ", ". ", "\n", "!", "\r\n"]
        text = "".join(w + rng.choices(gaps, weights=[60, 5, 5, 9, 9, 5, 1, 1])[0] for w in words)
        out.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    return out


@pytest.mark.parametrize(("seed", "least", "most"), [(1, 4, 2000), (2, 12, 7)])
def test_equals_brute_force(spark, seed, least, most):
    docs = corpus(seed, 150) + [("en", None), ("en", ""), ("en", " \t"), (None, ".,;"), ("fr", "one two")]
    df = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "lang phrase", "text word", "lang n", "0 f", "1 bit")
    got = rows(C.collocations(df, 5, least, 100, most))
    assert len(got) == len(set(got)) > 10
    assert set(got) == brute(docs, 5, least, 100, most)


def test_runs_of_a_small_trie_merge_to_the_same(spark):
    """Tries that burst and spill all the time, and texts cut into small parts."""
    docs = corpus(3, 80)
    df = spark.createDataFrame(docs, "lang string, text string")
    assert set(rows(C.collocations(df, 5, 5, room=C.Room(2, 20, 30, 50)))) == brute(docs, 5, 5, 100, 2000)


def test_empty_table_and_one_huge_word(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert C.collocations(df).collect() == []
    df = spark.createDataFrame([("en", "x" * 3_000_000), ("en", "a b " * 300)], "lang string, text string")
    got = {r[2]: r[3] for r in rows(C.collocations(df))}
    assert set(got) == {r[2] for r in brute([("en", "a b " * 300)], 5, 100, 100, 2000)}


def test_parts_end_where_pieces_end():
    text = b"one two. three four, five\nsix" * 9
    parts = [x for part in C.in_parts([text, None, b"", b"z"], 10) for x in part]
    assert b"".join(parts) == text + b"z"
    assert all(x[-1:] in b".,\n" for x in parts[:-2])


def test_trie_bursts_spills_subtrees_in_order_and_counts():
    rng = random.Random(4)
    trie, expected, got = HatTrie(burst=3, most=60), Counter(), Counter()
    runs = []
    for _ in range(400):
        first = bytes([rng.randrange(5)]) * 8
        rests = [b"".join(bytes([rng.randrange(4)]) * 8 for _ in range(3)) for _ in range(2)]
        trie.add("en", first, rests, [1, 2])
        for rest, n in zip(rests, [1, 2], strict=True):
            expected[first + rest] += n
        assert trie.total == sum(trie.sizes.values())
        run = list(trie.overflow())
        if run:
            runs.append(run)
            assert trie.total <= 30
    assert any(isinstance(t, Inner) for t in trie.trees.values())
    runs.append(list(trie.rest()))
    assert trie.total == 0 and not trie.trees
    for run in runs:
        heads = [p[:8] for _, p, _ in run]
        for head in set(heads):  # a subtree is one run in order, given out whole
            own = [p for _, p, _ in run if p[:8] == head]
            assert own == sorted(set(own))
        for _, p, n in run:
            got[p] += n
    assert got == expected


def test_a_row_of_runs_is_a_part_and_parts_sum_to_the_counts(spark):
    """Every task's phrases make a row per part at most, however many they are."""
    rng = random.Random(8)
    entries = [("en" if rng.random() < 0.7 else "de", b"".join(rng.randbytes(8) for _ in range(3)), 1) for _ in range(3000)]
    entries += rng.sample(entries, 900)
    rows = [r for block in C.runs_out(iter(entries), 3) for r in zip(*block.values(), strict=True)]
    assert len(rows) <= 2 * C.PARTS
    where = {}
    for lang, part, phrases, _ in rows:
        for i in range(0, len(phrases), 24):
            assert where.setdefault((lang, phrases[i : i + 16]), part) == part  # a prefix lies in one part
    runs = spark.createDataFrame(rows, "lang string, part int, phrases binary, counts binary").repartition(3)
    got = {(r["lang"], bytes(r["phrase"])): r["f"] for r in C.merged(runs, 3, 2).collect()}
    assert got == {x: n for x, n in Counter((a, b) for a, b, _ in entries).items() if n >= 2}


def test_runs_of_a_part_are_folded_as_they_come(spark):
    docs = corpus(6, 60)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    assert set(rows(C.collocations(df, 5, 5, room=C.Room(merge=2)))) == brute(docs, 5, 5, 100, 2000)
