from __future__ import annotations

import random

import pytest

from plumbline.llm import common
from plumbline.llm.exact_dedup import drop_exact_duplicates
from plumbline.llm.ngram_join import drop_near_duplicates


def shuffled(plan) -> int:
    """Bytes that the exchanges of a plan wrote."""
    own = plan.metrics().apply("dataSize").value() if plan.getClass().getSimpleName() == "ShuffleExchangeExec" else 0
    return own + sum(shuffled(plan.children().apply(i)) for i in range(plan.children().size()))


@pytest.fixture
def large_joins(spark):
    """Joins as on tables too large for Spark to broadcast them by itself."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def texts(n):
    rng = random.Random(n)
    return [" ".join(f"{rng.getrandbits(64):x}" for _ in range(120)) for _ in range(n)]


@pytest.mark.parametrize("drop", [drop_exact_duplicates, drop_near_duplicates])
def test_texts_that_are_no_duplicates_are_not_shuffled(spark, large_joins, drop):
    docs = list(enumerate(texts(200)))
    docs += [(1000 + i, docs[i][1]) for i in range(4)]
    left = drop(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(200))
    assert shuffled(left._jdf.queryExecution().executedPlan()) < sum(len(t) for _, t in docs) / 8


@pytest.mark.parametrize("marks", [64, 1 << 24])
def test_marked_buckets_decide_no_row(spark, monkeypatch, marks):
    monkeypatch.setattr(common, "MARKS", marks)
    rows = [(i, f"t{i}", "w", 1) for i in [*range(-50, 50), 7, 7, None, None, 1 << 40]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, word string, Marks int").repartition(3)
    for gone in ([], [7], [*range(0, 50, 3), 7, 7, None, 1 << 40, 99]):
        ids = spark.createDataFrame([(i,) for i in gone], "doc_id bigint")
        asked, clear = (x.collect() for x in common.parted(docs, ids))
        assert sorted([*asked, *clear], key=str) == sorted(docs.collect(), key=str)
        assert not {r["doc_id"] for r in clear} & set(gone)
        if marks > 64:
            assert {r["doc_id"] for r in asked} <= set(gone)  # so few ids have buckets of their own
        left = common.without(docs, ids)
        assert left.columns == docs.columns
        want = [r for r in rows if r[0] is None or r[0] not in gone]
        assert sorted((tuple(r) for r in left.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("marks", [64, 1 << 24])
def test_exact_copies_whatever_the_buckets(spark, large_joins, monkeypatch, marks):
    monkeypatch.setattr(common, "MARKS", marks)
    rows = [(1, "a b"), (1, "a  b"), (1, "c"), (2, "c"), (3, None), (None, ""), (None, "d"), (None, "d"), (4, "e"), (4, "f")]
    left = drop_exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = sorted(((r["doc_id"], " ".join((r["text"] or "").split())) for r in left), key=str)
    assert found == sorted([(1, "a b"), (1, "c"), (3, ""), (None, "d"), (4, "e"), (4, "f")], key=str)
