from .casting import clean_text, has_format, is_non_finite, parse_date, parse_decimal
from .text import csv_fields, decode_utf8, split_lines, strip_bom

__all__ = [
    "clean_text", "has_format", "is_non_finite", "parse_date", "parse_decimal",
    "csv_fields", "decode_utf8", "split_lines", "strip_bom",
]
