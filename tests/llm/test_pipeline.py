from __future__ import annotations

import random

import pytest

import corpus_pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    word = lambda: "".join(rng.choices(["ba", "to", "ri", "ne", "lu", "ka"], k=rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(25) + ".\n" + prose(6)) for i in range(12)]
    docs, labels, fate = [], [], {}
    for i in range(160):
        text, kind = prose(rng.choice([3, 40, 200])), "clean"
        if i % 8 == 1:
            text, kind = f"{text} scumbag {prose(4)}", "toxic"
        elif i % 8 == 2:
            text, kind = f"{prose(30)} {items[i % 12][1]} {prose(30)}", "leak"
        elif i % 16 == 3:
            text, kind = docs[0][1].replace(" ", "  "), "copy"
        elif i % 16 == 4:
            text, kind = f"{docs[5][1]} {word()}" if i > 5 else prose(300), "near" if i > 5 else "clean"
        elif i == 5:
            text = prose(300)
        docs.append((i, text, "xx", "s", len(text)))
        fate[i] = kind
        labels.append((i, 1, int(kind == "toxic")))
    docs += [(200, None, None, None, None), (None, prose(50), "xx", "s", 1), (201, "", "xx", "s", 0), docs[7]]
    fate |= {200: "clean", 201: "copy", None: "clean"}
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, fate


def test_stages_drop_what_was_planted_and_keep_the_rest(spark, folder):
    path, fate = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    gone = {"toxicity": "toxic", "exact_dedup": "copy", "near_dedup": "near", "decontamination": "leak"}
    left = set(fate)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, path))
        left -= {i for i, kind in fate.items() if kind == gone[name]}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} == left, name
    assert docs.count() == len(left)  # the repeated row is gone
    out = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r["doc_id"] for r in out} == left
    assert all(r["offset"] + r["length"] <= 1024 for r in out)


def test_run(spark, folder):
    path, fate = folder
    out = corpus_pipeline.run(spark, path)
    assert {r["doc_id"] for r in out.collect()} == {i for i, kind in fate.items() if kind == "clean"}
