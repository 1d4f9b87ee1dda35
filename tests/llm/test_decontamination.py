from __future__ import annotations

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from plumbline.llm import decontamination as D


def make(seed, n=120):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(400)]

    def prose(k):
        return " ".join(rng.choice(common if rng.random() < 0.5 else rare) for _ in range(k))

    items = [(i, f"{prose(rng.randint(6, 30))}.\n{prose(rng.randint(1, 9))}") for i in range(40)]
    items += [(40, None), (41, ""), (42, "one sentence alone, so no answer"), (43, items[3][1])]
    docs = []
    for d in range(n):
        body = prose(rng.choice([0, 4, 50, 300, 900]))
        kind = d % 4
        if kind == 1:
            w = body.split(" ")
            w.insert(rng.randint(0, len(w)), rng.choice([t for _, t in items if t]).upper())
            body = " ".join(w)
        elif kind == 2:  # the question alone
            body += " " + items[rng.randrange(40)][1].split("\n")[0]
        docs.append((d, body))
    return docs + [(1000, None), (None, items[5][1]), (1, docs[1][1])], items


def plain_words(text):
    return re.findall(r"[a-z0-9\x80-\uffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def edit_distance(part, text):
    """Fewest word edits from `part` to any run of `text`."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(part, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def brute(docs, items, size, threshold, overlap, k1=1.2, b=0.75):
    """Scores every passage against every item, with its own BM25."""
    items = [(i, plain_words(t), t) for i, t in items if plain_words(t)]
    longest = max(len(w) for _, w, _ in items)
    mean = sum(len(w) for _, w, _ in items) / len(items)
    seen = Counter(x for _, w, _ in items for x in set(w))

    def weight(x, w):
        n = w.count(x)
        idf = math.log(1 + (len(items) - seen[x] + 0.5) / (seen[x] + 0.5))
        return idf * n * (k1 + 1) / (n + k1 * (1 - b + b * len(w) / mean))

    def grams(w, k):
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}

    def held(parts, span):
        changed, enough = 0, True
        for p in parts:
            k = min(size, len(p))
            share, n = len(grams(p, k) & grams(span, k)) / len(grams(p, k)), edit_distance(p, span)
            if share < 1:
                changed += n
                share = max(share, 1 - n / len(p))
            if share < overlap:
                enough = False
                if n > 1 or len(p) < 2:
                    return False
        return enough or 1 - changed / sum(map(len, parts)) >= overlap

    weights = [{x: weight(x, w) for x in set(w)} for _, w, _ in items]
    parts = [[plain_words(x) for x in D.question_and_answer(t) if plain_words(x)] for _, _, t in items]
    out = Counter()
    for doc_id, t in docs:
        w, got = plain_words(t), set()
        for start in range(0, max(1, len(w) - longest), longest) if w else ():
            span = w[start : start + 2 * longest]
            here = set(span)
            for k, (i, _, _) in enumerate(items):
                score = sum(v for x, v in weights[k].items() if x in here) / sum(weights[k].values())
                if score >= threshold - 1e-6 and (i not in got) and held(parts[k], span):
                    got.add(i)
        out.update((doc_id, i) for i in got)
    return out


@pytest.fixture(scope="module")
def expected():
    return brute(*make(7), 5, 0.6, 0.8)


def test_portions_hold_the_passages_of_the_text(monkeypatch):
    monkeypatch.setattr(D, "PORTION", 100)
    for _, t in make(7)[0]:
        w = D.words(t)
        spans = [
            ((first + k) * 7, tuple(x[k * 7 : k * 7 + 14]))
            for first, x in D.portions((t or "").encode(), 7, 14, 3)
            for k in range(D.passages(len(x), 7, 14))
        ]
        assert spans == [(k * 7, tuple(w[k * 7 : k * 7 + 14])) for k in range(D.passages(len(w), 7, 14) if w else 0)]


@pytest.mark.parametrize("index_bytes", [1 << 20, 1500])
def test_equals_brute_force(spark, expected, index_bytes):
    """With one index and with several."""
    docs, items = make(7)
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "doc_id item_id", "text score")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = D.contaminated(d, i, index_bytes=index_bytes)
    assert Counter((r["doc_id"], r["item_id"]) for r in got.collect()) == expected
    left = {r["doc_id"] for r in D.drop_contaminated(d, i, index_bytes=index_bytes).collect()}
    assert left == {None, *(x for x, _ in docs)} - {x for x, _ in expected if x is not None}
    # Whole items are found; equal items are each found.
    planted = {d for d, t in docs if d is not None and d % 4 == 1 and t}
    assert planted <= {d for d, _ in expected}
    assert (None, 5) in expected
    assert {x for x, i in expected if i == 3} == {x for x, i in expected if i == 43}


def test_one_changed_word_hides_no_item(spark):
    rng = random.Random(3)
    items = [
        (n, " ".join(f"w{rng.randrange(300)}" for _ in range(20 + n)) + "\n" + " ".join(f"a{rng.randrange(99)}" for _ in range(2 + n)))
        for n in range(8)
    ]
    docs, whole = [], {}
    for n, t in items:
        lines = [x.split() for x in t.split("\n")]
        for line in range(2):
            for k in range(len(lines[line])):
                edited = [list(x) for x in lines]
                edited[line][k] = "other"
                whole[len(docs)] = n
                docs.append((len(docs), "before it " * 30 + " ".join(" ".join(x) for x in edited) + " and after" * 20))
        docs.append((len(docs), " ".join(lines[0]) + " and another answer here"))  # the question alone
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    found = {r["doc_id"]: r["item_id"] for r in D.contaminated(d, i).collect()}
    assert found == whole


def test_many_one_word_items_and_a_long_text_stay_small():
    """Groups of portions hold bounded numbers of passages and words, whatever the text."""
    text = ("some words of a long text " * 400_000).encode()
    batch = pa.RecordBatch.from_pydict({"text": [text.decode(), "short"]})
    for stride in (1, 20):
        most = max(1, min(D.CELLS // 256, D.WORDS // stride))
        sizes, words = [], []
        for group in D.together(batch, stride, 2 * stride, most):
            sizes.append(sum(int(D.passages(len(w), stride, 2 * stride)) for _, _, w in group))
            words.append(sum(len(w) for _, _, w in group))
        assert max(sizes) <= 2 * most and max(words) <= 2 * (most + 2) * stride
        assert sum(sizes) == D.passages(2_400_000, stride, 2 * stride) + 1


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.contaminated(d, none).count() == 0
    assert D.contaminated(d.limit(0), none.unionByName(spark.createDataFrame([(1, "a b")], none.schema))).count() == 0


def test_question_and_answer():
    assert D.question_and_answer("Who is it?\nIt is me.") == ("Who is it?", "It is me.")
    assert D.question_and_answer("Who is it? It is me.") == ("Who is it?", "It is me.")
    assert D.question_and_answer("only one") == ("only one", "")
