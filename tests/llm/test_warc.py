from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import zstandard

from plumbline.llm import warc as W


@pytest.fixture(scope="module")
def rows():
    big = "<p>" + "same words é " * 120
    out = [(i, f"http://h{i % 3}.example/{i}", big if i % 3 else f"<b>{i}</b>" * (i + 1) * 20) for i in range(60)]
    out += [(60, None, None), (61, "http://x\r\ny", ""), (62, "u", "short"), (63, "u", "short"), (None, "u", big), (64, "u", "x\r\n\r\ny")]
    return out + [(2, "again", out[2][2]), (65, "long", "z" * 200_000)]


def test_archive_round_trip(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3).selectExpr("*", "1 part", "2 d")
    folder, manifest = W.write_archive(df, volume_bytes=20_000, dictionary_bytes=2048)
    back = W.read_archive(spark, folder, manifest).collect()
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows) and manifest.count() > 3
    groups = Counter()
    newest = {}
    for i, _, h in rows:
        body = (h or "").encode()
        if len(body) >= 1000:
            newest[body] = max(newest.get(body, -1), -1 if i is None else i)
    bodies = {hashlib.sha1((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in rows}
    for r in back:
        body = bodies[r["payload_digest"]]
        assert r["payload_bytes"] == len(body)
        groups[(r["page_id"], body)] += 1
        if r["record_type"] == "response":
            assert bytes(r["html"]) == body and r["refers_to"] is None
        else:
            assert r["html"] is None and r["refers_to"] == newest[body]
    assert groups == Counter((i, (h or "").encode()) for i, _, h in rows)
    responses = Counter(r["payload_digest"] for r in back if r["record_type"] == "response" and r["payload_bytes"] >= 1000)
    assert set(responses.values()) == {1} and len(responses) == len(newest)
    assert {r["page_id"] for r in back if r["record_type"] == "response" and bodies[r["payload_digest"]] in newest} == {
        i for i in newest.values()
    }


def test_volume_begins_with_its_dictionary_and_frames_stand_alone():
    records = [W.record(i, f"http://x/{i}", (f"<p>common words {i} " * 40).encode(), None, False, "2024-01-01T00:00:00Z") for i in range(300)]
    data = W.volume(records, 4096, 3)
    assert list(W.records_of(data)) == records
    assert int.from_bytes(data[:4], "little") == W.DICTIONARY_FRAME
    size = int.from_bytes(data[4:8], "little")
    assert size and int.from_bytes(data[8:12], "little") == W.DICTIONARY_MAGIC
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(data) - size - 8 < plain / 2
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(data[8 + size :])


@pytest.mark.parametrize("count, size, kind", [(1, 3, "raw"), (2, 40, "raw"), (3, 40_000, "trained"), (20, 1_000, "trained"), (1, 2_000_000, "trained")])
def test_every_volume_has_a_dictionary(count, size, kind):
    rng = random.Random(count)
    bodies = [" ".join(f"word{rng.randrange(200)}" for _ in range(size // 7 + 1)).encode() for _ in range(count)]
    records = [W.record(i, "http://x/", b, None, False, "2024-01-01T00:00:00Z") for i, b in enumerate(bodies)]
    data = W.volume(records, 4096, 3)
    assert list(W.records_of(data)) == records
    assert int.from_bytes(data[4:8], "little") > 0 and W.dictionary_kind(data) == kind


def test_the_manifest_names_the_dictionary_of_each_volume(spark):
    """Pages larger than a volume, and a last one with hardly any."""
    rows = [(1, "u", "many words " * 9_000), (2, "u", "other words " * 9_000), (3, "u", "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    folder, manifest = W.write_archive(df, volume_bytes=50_000, dictionary_bytes=2048)
    assert sorted((r["records"], r["dictionary"]) for r in manifest.collect()) == [(1, "raw"), (1, "trained"), (1, "trained")]
    back = {r["page_id"]: bytes(r["html"]).decode() for r in W.read_archive(spark, folder, manifest).collect()}
    assert back == {i: h for i, _, h in rows}


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    folder, manifest = W.write_archive(df)
    assert W.read_archive(spark, folder, manifest).count() == 0
