from __future__ import annotations

import csv
import io
import random
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from plumbline.functions import casting
from plumbline.functions.text import csv_fields, csv_records, split_lines
from plumbline.sources import landing
from plumbline.sources.batches import decode_batch


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_decimals(spark):
    cases = {
        "1e3": Decimal(1000), "1E-9": Decimal(0), "0.000000001": Decimal(0), "-0": Decimal(0),
        ".5": Decimal("0.5"), "5.": Decimal(5), "+1.2": Decimal("1.2"),
        "1.123456785": Decimal("1.12345679"), "999999999999.99999999": Decimal("999999999999.99999999"),
        "NaN": None, "+NaN": None, "Infinity": None, "1234567890123": None, "1_000": None,
        "0x1F": None, "1,234": None, "1.5d": None, "--1": None, None: None,
    }
    assert column(spark, list(cases), casting.parse_decimal) == list(cases.values())


def test_dates(spark):
    day = date(2023, 1, 3)
    cases = {
        "03-Jan-2023": day, "03-JAN-2023": day, "03-jan-2023": day, "29-Feb-2024": date(2024, 2, 29),
        "31-Feb-2023": None, "29-Feb-2023": None, "32-Jan-2023": None, "00-Jan-2023": None,
        "03-Foo-2023": None, "3-Jan-2023": None, "03-January-2023": None, "03-Sept-2023": None,
        "2023-01-03": None, "03-Jan-12023": None, "01-Jan-0000": None, "03-Jan-2023\n": None, None: None,
    }
    assert column(spark, list(cases), casting.parse_date) == list(cases.values())


def test_clean_text_and_non_finite_words(spark):
    assert column(spark, ["  a ", "   ", "", None, "\t"], casting.clean_text) == ["a", None, None, None, "\t"]
    words = ["nan", "-INF", "+Infinity", "1", None, "infinite"]
    assert column(spark, words, casting.is_non_finite) == [True, True, True, False, False, False]


def test_lines_equal_universal_splitting(spark):
    rng = random.Random(1)
    breaks = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " ", "a", "b "]
    texts = ["", "\n", "a"] + ["".join(rng.choice(breaks) for _ in range(rng.randrange(9))) for _ in range(200)]
    assert column(spark, texts, split_lines) == [t.splitlines() for t in texts]


def test_csv_equals_the_standard_reader(spark):
    rng = random.Random(2)
    parts = ['"', '""', ",", "\n", "a", "b c", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(300)]
    ours = column(spark, texts, lambda c: F.transform(csv_records(c), csv_fields))

    def filled(rows):
        return [r for r in rows if any(v.strip() for v in r)]

    expected = [filled(csv.reader(io.StringIO(t))) for t in texts]
    assert [filled(rows) for rows in ours] == expected


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(
        "﻿F11.1  EXCHANGE RATES\nmeta\nSeries ID,A,B\n03-Jan-2023,1,2\n,,\n04-Jan-2023,1\n".encode()
    )
    (tmp_path / "b.csv").write_bytes(b"Series ID,A,A\n1,2,3")
    (tmp_path / "c.txt").write_bytes(b"Series ID,A,B\n , ")
    files = landing.read_landing(spark, str(tmp_path), "*.csv").withColumn(
        "path", F.regexp_extract("path", "([^/]+)$", 1)
    ).select("path", "length", "content")
    assert {r.path: r.length for r in files.collect()} == {"a.csv": 77, "b.csv": 19}
    parsed = landing.parse_csv(landing.strip_metadata(files.drop("length")))
    status = {r.path: (r.header_line, r.header_status) for r in landing.header_check(parsed).collect()}
    assert status == {"a.csv": (3, "OK"), "b.csv": (1, "DUPLICATE_HEADER")}
    rows = landing.csv_rows(parsed)
    assert [(r.source_row_no, r["values"], r.arity_ok) for r in rows.orderBy("source_row_no").collect()] == [
        (1, ["03-Jan-2023", "1", "2"], True), (2, ["04-Jan-2023", "1"], False),
    ]
    checks = {r.path: (r.utf8_bom, r.signature_ok) for r in landing.check_signature(files).collect()}
    assert checks == {"a.csv": (True, True), "b.csv": (False, False)}
    verdicts = {r.path: (r.heading_ok, r.line_count) for r in landing.check_text_source(files).collect()}
    assert verdicts == {"a.csv": (True, 6), "b.csv": (False, 2)}
    scanned = landing.check_text_lines(spark, str(tmp_path / "*.csv"), min_lines=5).collect()
    assert {r.path.rsplit("/", 1)[1]: (r.heading_ok, r.line_count, r.line_count_ok) for r in scanned} == {
        "a.csv": (True, 6, True), "b.csv": (False, 2, False),
    }
    counts = landing.match_counts(files, F.lit("all")).collect()
    assert [(r.file_count, r.matches) for r in counts] == [(2, False)]


def test_strict_parsing_raises(spark):
    files = spark.createDataFrame([("a", bytearray(b"Series ID,A\n1\n"))], "path string, content binary")
    parsed = landing.parse_csv(landing.strip_metadata(files))
    assert landing.csv_rows(parsed).where("not arity_ok").count() == 1
    for body in (b"Series ID,A\n1\n", b"no header"):
        files = spark.createDataFrame([("a", bytearray(body))], "path string, content binary")
        parsed = landing.parse_csv(landing.strip_metadata(files))
        try:
            landing.csv_rows(parsed, strict=True).collect()
        except Exception as e:
            assert "Malformed CSV at data row 1: expected 2 fields, got 1" in str(e) or "HEADER_NOT_FOUND" in str(e)
        else:
            raise AssertionError("strict parsing accepted a bad file")


def test_json_batches(spark):
    text = '[{"source_row_no":1,"series_id":"A"},{"source_row_no":"x"},{"source_row_no":1.0}]'
    df = spark.createDataFrame([(1, text), (2, "nope"), (3, None), (4, "[]")], "b int, j string")
    rows = decode_batch(df, "j").orderBy("b", "ordinal").collect()
    assert [(r.b, r.ordinal, r.source_row_no, r.bad_fields) for r in rows] == [
        (1, 1, 1, []), (1, 2, None, ["source_row_no"]), (1, 3, None, ["source_row_no"]), (2, None, None, ["j"]),
    ]
    try:
        decode_batch(df, "j", strict=True).collect()
    except Exception as e:
        assert "badly typed batch element" in str(e)
    else:
        raise AssertionError("strict decoding accepted a bad element")


def test_line_scan_counts_a_file_that_spans_many_blocks(spark, tmp_path):
    (tmp_path / "big.csv").write_text("F11.1  EXCHANGE RATES\n" + "row\n" * 50_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        verdict = landing.check_text_lines(spark, str(tmp_path)).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (verdict.line_count, verdict.heading_ok, verdict.line_count_ok) == (50_001, True, True)
