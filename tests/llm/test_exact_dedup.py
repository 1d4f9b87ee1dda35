from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from plumbline.llm.exact_dedup import drop_exact_duplicates, exact_groups


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [None, "", " ", "\n\t", "a b", "a  b", "a\nb", " a b", "A b", "é b", "x" * 70_000]
    out = [(i, rng.choice(texts) if i % 3 else "hot text") for i in range(200)]
    return out + [(7, out[7][1]), (8, "another"), (None, "hot text"), (None, "only without id"), (None, "only without id")]


def test_groups(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).selectExpr("*", "doc_id keep_id", "text digest")
    got = exact_groups(df, rounds=2, bits=1).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = defaultdict(int)
    for r in got:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == min((i for i in ids if i is not None), default=None)
        if r["kept"]:
            kept[r["text_sha256"]] += 1
            assert r["doc_id"] == r["keep_id"]
    assert len(got) == len(rows)
    assert kept == dict.fromkeys(by_sha, 1)
    assert exact_groups(df.limit(0)).count() == 0


def test_rows_that_stay(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' key", "1 Rows")
    left = drop_exact_duplicates(df)
    assert left.columns == df.columns
    texts = [normal(r["text"]) for r in left.collect()]
    assert sorted(texts) == sorted({normal(t) for _, t in rows})
    assert {r["doc_id"] for r in left.where("text = 'hot text'").collect()} == {0}
