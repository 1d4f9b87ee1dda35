"""Landed files: one row per file, everything about a file computed in its row.

A file table has `path` and `content` (bytes).  From bytes to long staging rows
no step shuffles: header discovery, CSV parsing and row numbering are array
expressions inside the file's own row, so many files of different shapes are
one Spark job.  The binary scan itself bounds a row to a 2 GB file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.once import computed
from plumbline.functions.text import (
    BOM,
    PLAIN_LINE_BREAK,
    csv_fields,
    csv_records,
    decode_utf8,
    is_blank,
    split_lines,
    strip_bom,
    strip_leading_space,
    strip_space,
)

# Fixed values of the feed's format.
FIRST_HEADER = "Series ID"
HEADER_MARKER = "Series ID,"
FILE_HEADING = "F11.1  EXCHANGE RATES"
SIGNATURE_PREFIX = "F11.1"
SIGNATURE_WINDOW = 16000
DIAGNOSTIC_WINDOW = 512


def read_landing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Landed files as rows of path, modificationTime, length, content."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def match_counts(files: DataFrame, feed: Column, expected: int = 1) -> DataFrame:
    """Files found per feed, and whether that is the expected number."""
    return (
        files.groupBy(feed.alias("feed"))
        .agg(F.count("*").alias("file_count"))
        .withColumn("matches", F.col("file_count") == expected)
    )


def with_fingerprint(files: DataFrame) -> DataFrame:
    """SHA-256 of the bytes as landed, BOM included."""
    return files.withColumn("source_fingerprint", F.sha2("content", 256))


def check_text_source(
    files: DataFrame, heading: Column | str = FILE_HEADING, min_lines: int = 2000
) -> DataFrame:
    """Verdict per file: expected first line, and more than `min_lines` lines."""
    text = F.make_valid_utf8(F.col("content").cast("string"))
    lines = split_lines(text, PLAIN_LINE_BREAK)
    first = F.coalesce(F.get("_lines", F.lit(0)), F.lit(""))
    expected = F.lit(heading) if isinstance(heading, str) else heading
    return computed(
        computed(files, _lines=lines),
        line_count=F.size("_lines").cast("bigint"),
        first_line=strip_space(strip_bom(first)),
    ).select(
        "path",
        "line_count",
        "first_line",
        (F.col("first_line") == expected).alias("heading_ok"),
        (F.col("line_count") > min_lines).alias("line_count_ok"),
    )


def check_text_lines(
    spark: SparkSession, path: str, heading: str = FILE_HEADING, min_lines: int = 2000
) -> DataFrame:
    """The same verdict from a line scan, for files too large to be one row.

    Blocks of a file are read by different tasks; counts and the first line of
    the first block combine map-side, so one huge file is no hot spot.
    """
    position = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return (
        spark.read.text(path)
        .select("value", F.col("_metadata.file_path").alias("path"), position.alias("position"))
        .groupBy("path")
        .agg(F.count("*").alias("line_count"), F.min_by("value", "position").alias("value"))
        .select("path", "line_count", strip_space(strip_bom(F.col("value"))).alias("first_line"))
        .withColumns(
            {
                "heading_ok": F.col("first_line") == heading,
                "line_count_ok": F.col("line_count") > min_lines,
            }
        )
    )


def check_signature(
    files: DataFrame,
    prefix: str = SIGNATURE_PREFIX,
    marker: str = HEADER_MARKER,
    window: int = SIGNATURE_WINDOW,
) -> DataFrame:
    """Verdict per file: text starts with `prefix` and holds `marker` near its start.

    BOM and leading blank space do not count.  Malformed bytes are tolerated.
    """
    text = strip_leading_space(decode_utf8(F.col("content"), strict=False))
    return computed(files, _text=text).select(
        "path",
        F.length("content").cast("bigint").alias("byte_count"),
        (F.hex(F.substr("content", F.lit(1), F.lit(3))) == "EFBBBF").alias("utf8_bom"),
        F.contains(F.substr("_text", F.lit(1), F.lit(DIAGNOSTIC_WINDOW)), F.lit(prefix)).alias(
            "prefix_near_start"
        ),
        F.contains(F.substr("_text", F.lit(1), F.lit(window)), F.lit(marker)).alias("marker_present"),
        F.col("_text").startswith(prefix).alias("prefix_ok"),
    ).withColumn("signature_ok", F.col("prefix_ok") & F.col("marker_present"))


def bronze_lines(files: DataFrame) -> DataFrame:
    """Every line of every file, numbered from 1 within its file."""
    others = [c for c in files.columns if c != "content"]
    return files.select(
        *others, F.posexplode(split_lines(decode_utf8(F.col("content")))).alias("_pos", "raw_line")
    ).select(*others, (F.col("_pos") + 1).cast("bigint").alias("line_number"), "raw_line")


def with_provenance(
    lines: DataFrame, source_url: Column, source_sha256: Column, run_id: Column, ingested_at: Column
) -> DataFrame:
    """Where a line came from, when, and in which run."""
    return lines.withColumns(
        {
            "source_url": source_url,
            "source_sha256": source_sha256,
            "ingested_at": ingested_at,
            "run_id": run_id,
        }
    )


def strip_metadata(files: DataFrame, marker: str = HEADER_MARKER) -> DataFrame:
    """Cut each file's text at its header line, the first one starting with `marker`.

    Adds `header_line` (NULL when a file has none, never an error: such a file
    is rejected by `header_check`) and `csv_text`, the lines from there on.
    """
    is_header = F.transform(
        F.col("_lines"), lambda x: F.ltrim(x, F.lit(BOM)).startswith(marker)
    )
    header_line = F.nullif(F.array_position(is_header, True), F.lit(0)).cast("bigint")
    lines = computed(files, _lines=split_lines(decode_utf8(F.col("content"))))
    found = computed(lines, header_line=header_line)
    rest = F.slice("_lines", F.col("header_line").cast("int"), F.size("_lines"))
    return computed(found, csv_text=F.array_join(rest, "\n")).drop("_lines")


def parse_csv(stripped: DataFrame) -> DataFrame:
    """Headers and data records of each stripped file, all-blank records dropped.

    Adds `headers` (array of text) and `records` (array of arrays of text).
    """
    parsed = F.transform(csv_records(F.col("csv_text")), csv_fields)
    kept = F.filter(parsed, lambda r: F.exists(r, lambda v: ~is_blank(v)))
    headers = F.transform(
        F.get("_matrix", F.lit(0)), lambda h: strip_space(F.ltrim(h, F.lit(BOM)))
    )
    records = F.slice("_matrix", F.lit(2), F.size("_matrix"))
    return computed(computed(stripped, _matrix=kept), headers=headers, records=records).drop("_matrix")


# Codes and order of the header checks.
HEADER_OK = "OK"
HEADER_ERRORS = ("HEADER_NOT_FOUND", "NO_DATA_ROWS", "UNEXPECTED_FIRST_HEADER", "BLANK_HEADER", "DUPLICATE_HEADER")


def with_header_status(parsed: DataFrame, first_header: str = FIRST_HEADER) -> DataFrame:
    """First header check a file fails, or OK."""
    headers, records = F.col("headers"), F.col("records")
    failed = (
        F.col("header_line").isNull(),
        F.coalesce(F.size(records), F.lit(0)) < 1,
        headers[0] != first_header,
        F.exists(headers, lambda h: h == ""),
        F.size(F.array_distinct(headers)) != F.size(headers),
    )
    status = F.lit(HEADER_OK)
    for test, code in reversed(list(zip(failed, HEADER_ERRORS))):
        status = F.when(test, F.lit(code)).otherwise(status)
    return computed(parsed, header_status=status)


def header_check(parsed: DataFrame, first_header: str = FIRST_HEADER) -> DataFrame:
    """One verdict row per file."""
    return with_header_status(parsed, first_header).select(
        "path",
        "header_line",
        F.coalesce(F.size("headers"), F.lit(0)).cast("bigint").alias("header_count"),
        F.coalesce(F.size("records"), F.lit(0)).cast("bigint").alias("data_row_count"),
        "header_status",
    )


def csv_rows(
    parsed: DataFrame,
    first_header: str = FIRST_HEADER,
    strict: bool = False,
    keep_rejected: bool = False,
) -> DataFrame:
    """Data rows of files with a sound header, numbered from 1 within the file.

    `arity_ok` tells whether a row has as many fields as headers.  A file with an
    unsound header gives no row, or with `keep_rejected` one row without values
    next to its `header_status`.
    Strict mode raises at the first unsound header or row instead.
    """
    others = [
        c for c in parsed.columns
        if c not in ("content", "csv_text", "headers", "records", "header_line")
    ]
    checked = with_header_status(parsed, first_header)
    sound = F.col("header_status") == HEADER_OK
    if strict:
        unsound = F.raise_error(F.concat(F.col("path"), F.lit(": "), F.col("header_status")))
        checked = checked.withColumn("records", F.when(sound, F.col("records")).otherwise(unsound))
    elif keep_rejected:
        others.append("header_status")
        checked = checked.withColumn("records", F.when(sound, F.col("records")))
    else:
        checked = checked.where(sound)
    numbered = F.posexplode_outer("records") if keep_rejected else F.posexplode("records")
    arity_ok = F.size("values") == F.size("headers")
    if strict:
        arity_ok = F.when(arity_ok, F.lit(True)).otherwise(F.raise_error(arity_message()))
    return (
        checked.select(*others, "headers", numbered.alias("_pos", "values"))
        .withColumn("source_row_no", (F.col("_pos") + 1).cast("bigint"))
        .select(
            *others,
            "source_row_no",
            "headers",
            "values",
            F.when(F.col("values").isNotNull(), arity_ok).alias("arity_ok"),
        )
    )


def arity_message() -> Column:
    # Fixed value: the text that names a wrong field count.
    return F.format_string(
        "Malformed CSV at data row %d: expected %d fields, got %d",
        F.col("source_row_no"),
        F.size("headers"),
        F.size("values"),
    )


def arity_check(rows: DataFrame) -> DataFrame:
    """Rows whose field count differs from the header's."""
    return rows.where(~F.col("arity_ok")).select(
        "path",
        "source_row_no",
        F.size("headers").cast("bigint").alias("expected_fields"),
        F.size("values").cast("bigint").alias("actual_fields"),
    )


def structural_exceptions(rows: DataFrame, carry: Sequence[str] = ("path",)) -> DataFrame:
    """Rejected files and rows, outside the law staged = valid + invalid.

    `rows` keeps rejected files, see `csv_rows`.
    """
    of_file = F.col("header_status") != HEADER_OK
    return rows.where(of_file | ~F.col("arity_ok")).select(
        *carry,
        "source_row_no",
        F.when(of_file, F.col("header_status")).otherwise("WRONG_FIELD_COUNT").alias("error_code"),
        F.when(of_file, "File rejected").otherwise(arity_message()).alias("error_detail"),
    )
