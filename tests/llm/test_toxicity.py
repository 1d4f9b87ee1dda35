from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from plumbline.llm import toxicity as X


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    clean, bad = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)], ["scumbag", "m0ron", "pl4gue", "v\u0435rmin"]
    docs, labels = [], []
    for i in range(600):
        w = rng.choices(clean, k=rng.choice([3, 20, 80]))
        toxic = i % 7 == 0
        if toxic:
            w[rng.randrange(len(w))] = rng.choice([*bad, "scumbags", "Moron"])
        elif i % 100 == 1:
            w[:2] = ["plague", "doctor"]
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs += [(1000, None), (1001, ""), (None, "scumbag wortaa"), (3, docs[3][1]), (1002, "scumbag " * 20_000)]
    return docs, labels + [(1001, None), (3, 0), (None, 1)]


def brute_hits(weights, exceptions, words):
    """Longest entry at each blank, unless an exception phrase around it stands in the text."""
    text, out = f" {' '.join(words)} ", []
    places = [(i, i + len(x) - 1) for x in exceptions for i in range(len(text)) if text.startswith(x, i)]
    for i in range(len(text)):
        fits = [x for x in weights if text.startswith(x, i)]
        if fits:
            x = max(fits, key=len)
            end = i + len(x)
            if not any(a <= i and end - 1 <= b for a, b in places):
                out.append((i, end - 1, weights[x]))
    return out


def test_matches_and_exceptions_equal_brute_force():
    rng = random.Random(5)
    vocabulary = ["scum", "scumbag", "plague", "plagued", "doctor", "of", "the", "pla"]
    weights = {" scum": 1.0, " scumbag ": 2.0, " plague": 3.0, " plagued ": 4.0, " doct": 0.5}
    exceptions = [" plague doctor ", " the scumbag ", " doctor of the plague ", " scum scum "]
    for _ in range(300):
        words = rng.choices(vocabulary, k=rng.randint(0, 25))
        chosen = rng.sample(exceptions, rng.randint(0, 4))
        got = X.Matcher(weights, chosen).hits(words)
        assert sorted(got) == brute_hits(weights, chosen, words)
    assert X.Matcher({}, []).hits(["scum"]) == []


def test_a_long_text_of_exception_phrases_takes_no_quadratic_time():
    matcher = X.Matcher({" plague": 3.0}, [" plague doctor "])
    start = time.perf_counter()
    assert matcher.hits(["plague", "doctor"] * 100_000) == []
    assert time.perf_counter() - start < 10


def test_learns_and_spares_exceptions(spark, rows):
    docs, labels = rows
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "'x' key", "1 toxic", "'z' score")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = X.fit(d.where(~X.is_held_out(F.col("doc_id"))), marks, support=3)
    assert " piague doctor " in model.exceptions
    out = {r["doc_id"]: r for r in X.toxicity(d.select("doc_id", "text", "key"), marks).collect()}
    truth = {i: t for i, t in labels if i is not None and t is not None}
    held = [i for i in truth if out[i]["held_out"]]
    assert sum(out[i]["predicted"] == truth[i] for i in held) >= 0.98 * len(held)
    assert out[None]["predicted"] == 1 and out[1002]["predicted"] == 1
    assert out[1000]["predicted"] == 0 == out[1001]["predicted"]
    assert all(0 <= r["score"] <= 1 for r in out.values())
    left = X.drop_toxic(d, marks)
    assert left.columns == d.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i, r in out.items() if not r["predicted"]}


def test_folding_and_longest_matches():
    assert X.folded("Mоrоn М0RON m\u200boron") == ["moron"] * 3
    assert X.folded("1OSER ｌｏｓｅｒ") == ["ioser"] * 2
    m = X.Matcher({" scum ": 2.0, " scu": 1.0, " bag ": 4.0}, [" no scum "])
    assert sum(w for _, _, w in m.hits(["scum", "scumbag", "bag"])) == 7.0
    assert [w for _, _, w in m.hits(["no", "scum", "scum"])] == [2.0]
    assert X.Matcher({}, []).hits(["a"]) == []


def test_without_labels_nothing_is_toxic(spark, rows):
    d = spark.createDataFrame(rows[0], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert X.toxicity(d, none).where("predicted = 1").count() == 0
    assert X.toxicity(d.limit(0), none).count() == 0


def test_no_key_is_cut_by_number(spark):
    """Many common words must not push rare toxic ones out, and a lexicon of several parts scores as one."""
    rng = random.Random(3)
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3))
    common = [f"{name(i)}x" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        w = rng.sample(common, 60)
        if i % 9 == 0:
            w[5] = f"{name(i // 9 % 8)}zbad"
        elif i % 9 == 1:
            w[5:7] = [f"{name(i // 9 % 8)}zbad", "doctor"]
        docs.append((i, " ".join(w)))
        labels.append((i, int(i % 9 == 0)))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    whole = X.fit(d, marks, support=5, least=0.5)
    parts = X.fit(d, marks, support=5, least=0.5, most=1)
    assert {e[1:4] for e in whole.weights} >= {name(i) for i in range(8)}
    assert parts.weights == whole.weights
    assert whole.table.parts == 1 < parts.table.parts
    assert parts.exceptions == whole.exceptions
    assert any(x.endswith(" doctor ") for x in whole.exceptions)
    one, many = ({r["doc_id"]: r["score"] for r in X.scored(d, m).collect()} for m in (whole, parts))
    assert many == pytest.approx(one, abs=1e-9)
    assert min(one[i] for i, t in labels if t) > max(one[i] for i, t in labels if not t)
