"""Column expressions over whole landed texts and their CSV records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .once import bind

BOM = "﻿"

# Every line boundary a text reader in universal mode recognises.
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
# Line boundaries of a plain text scan.
PLAIN_LINE_BREAK = r"\r\n|\n|\r"
# Whitespace, Unicode spaces included.
SPACE = r"\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# One CSV field: quoted text with doubled quotes (left open at the end of the
# text at worst), or plain text.  A quote counts only where it opens a field.
# Possessive quantifiers keep the scans linear and free of recursion.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+(?:"[^,\n]*+|\z)|(?!")[^,\n]*+)'
_NEXT_FIELD = f",({_FIELD})"
_NEXT_RECORD = rf"\n({_FIELD}(?:,{_FIELD})*+)"
_QUOTED = r'\A"([^"]*+(?:""[^"]*+)*+)"?+([\s\S]*+)\z'


def strip_bom(text: Column) -> Column:
    return F.when(text.startswith(BOM), F.substr(text, F.lit(2))).otherwise(text)


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def strip_leading_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A[{SPACE}]+", "")


def is_blank(text: Column) -> Column:
    return ~text.rlike(rf"[^{SPACE}]")


def decode_utf8(content: Column, strict: bool = True) -> Column:
    """Bytes to text without a leading BOM.

    Strict decoding raises on malformed bytes; lenient decoding puts the
    replacement character in their place.
    """
    text = content.cast("string")
    return bind(F.validate_utf8(text) if strict else F.make_valid_utf8(text), strip_bom)


def split_lines(text: Column, pattern: str = LINE_BREAK) -> Column:
    """Lines of a text; a final line break does not open another line."""
    return bind(
        F.split(text, pattern),
        lambda parts: F.when(
            F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)
        ).otherwise(parts),
    )


def csv_records(text: Column) -> Column:
    """Records of a CSV text whose lines end in \\n; a quoted field may span lines."""
    tokens = F.regexp_extract_all(F.concat(F.lit("\n"), text), F.lit(_NEXT_RECORD), F.lit(1))
    return F.when(F.contains(text, F.lit('"')), tokens).otherwise(F.split(text, "\n"))


def csv_fields(record: Column) -> Column:
    """Unquoted fields of one CSV record."""
    tokens = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_NEXT_FIELD), F.lit(1))
    return F.when(
        F.contains(record, F.lit('"')), F.transform(tokens, _unquote)
    ).otherwise(F.split(record, ","))


def _unquote(field: Column) -> Column:
    """Text between the quotes, with doubled quotes undone, and what follows them."""
    inside = F.replace(F.regexp_extract(field, _QUOTED, 1), F.lit('""'), F.lit('"'))
    after = F.regexp_extract(field, _QUOTED, 2)
    return F.when(field.startswith('"'), F.concat(inside, after)).otherwise(field)
