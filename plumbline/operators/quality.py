"""Named quality rules over staging rows, and the exceptions they log."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.casting import (
    DATE_FORMAT,
    DATE_PATTERN,
    NON_FINITE_WORDS,
    SERIES_PATTERN,
    clean_text,
    has_format,
    in_calendar,
    parse_decimal,
)
from plumbline.functions.once import computed

from .keys import key_multiplicity

# Rule codes and their detail texts.
RULE_DETAILS = {
    "MISSING_DATE": "raw_rate_date is null or blank",
    "INVALID_DATE_FORMAT": "Expected date format DD-Mon-YYYY",
    "INVALID_DATE_VALUE": "Date text matches the expected format but is not a valid date",
    "MISSING_SERIES_ID": "series_id is null or blank",
    "INVALID_SERIES_ID": "Unexpected RBA series_id format",
    "MISSING_RATE": "raw_rate is null or blank",
    "NON_FINITE_RATE": "Rate is non-finite",
    "INVALID_RATE": "Rate cannot be converted to NUMERIC(20,8)",
    "NON_POSITIVE_RATE": "Rate must be greater than zero",
    "DUPLICATE_BUSINESS_KEY": "Duplicate (source, rate_date, series_id) exists inside this source run",
}
RULE_CODES = tuple(RULE_DETAILS)

RUN_KEY = ("run_id", "source", "parsed_date", "clean_series")


@dataclass(frozen=True)
class Step:
    """What a field must be, and the code of the fault where it isn't.

    `holds` takes the cleaned text, or the parsed value where `of_value` is set, of
    which neither is missing; a NULL answer counts as a fault.
    """

    code: str
    holds: Callable[[Column], Column]
    of_value: bool = False


def shaped(code: str, pattern: str) -> Step:
    """The whole text has a form."""
    return Step(code, lambda text: has_format(text, pattern))


def listed(code: str, words: Sequence[str]) -> Step:
    """The text is one of some words, in any case."""
    return Step(code, lambda text: F.upper(text).isin(*words))


def barred(code: str, words: Sequence[str]) -> Step:
    """The text is none of some words, in any case."""
    return Step(code, lambda text: ~F.upper(text).isin(*words))


def above(code: str, bound: float) -> Step:
    """The value is greater than a bound."""
    return Step(code, lambda value: value > bound, of_value=True)


def within(code: str, low: object, high: object) -> Step:
    """The value lies between two bounds, both included."""
    return Step(code, lambda value: value.between(low, high), of_value=True)


@dataclass(frozen=True)
class Field:
    """A raw text column and its checks, in their order; a row gets the first that fails.

    Blank text is missing: the fault `missing`, or none where the field may be absent.
    `parse` turns a text without a fault into a value, NULL where it can't: `unparsable`.
    """

    name: str
    raw: str
    missing: str | None = None
    steps: tuple[Step, ...] = ()
    parse: Callable[[Column], Column] | None = None
    unparsable: str | None = None

    @property
    def text(self) -> str:
        return f"clean_{self.name}"

    @property
    def value(self) -> str:
        return f"parsed_{self.name}" if self.parse else self.text

    @property
    def fault(self) -> str:
        return f"fault_{self.name}"

    @property
    def codes(self) -> list[str]:
        """The field's faults in the order in which they are looked for."""
        early = [s.code for s in self.steps if not s.of_value]
        late = [s.code for s in self.steps if s.of_value]
        return [c for c in (self.missing, *early, self.unparsable, *late) if c]

    def fault_of_text(self) -> Column:
        """Code of the first check that the text fails, else NULL."""
        text = F.col(self.text)
        checks = [(text.isNull(), F.lit(self.missing))]
        checks += [(~_sure(s.holds(text)), F.lit(s.code)) for s in self.steps if not s.of_value]
        return _first(checks)

    def fault_of_value(self) -> Column:
        """Code of the first check that the value of a sound text fails, else NULL."""
        value = F.col(self.value)
        checks = [(value.isNull(), F.lit(self.unparsable))] if self.parse else []
        checks += [(~_sure(s.holds(value)), F.lit(s.code)) for s in self.steps if s.of_value]
        return F.when(F.col(self.text).isNotNull(), _first(checks)) if checks else F.lit(None).cast("string")


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _first(checks: Sequence[tuple[Column, Column]]) -> Column:
    out = F.lit(None).cast("string")
    for test, code in reversed(checks):
        out = F.when(test, code).otherwise(out)
    return out


@dataclass(frozen=True)
class Feed:
    """Declared fields, the key that is unique within a run, and the text of each fault.

    Typed columns, predicates and details all follow from it.
    """

    fields: tuple[Field, ...]
    key: tuple[str, ...]
    repeated: str
    details: Mapping[str, str]

    def __post_init__(self) -> None:
        codes = [c for f in self.fields for c in f.codes] + [self.repeated]
        if len(set(codes)) < len(codes) or set(codes) != set(self.details):
            raise ValueError(f"every fault needs one code and one text: {sorted(set(codes) ^ set(self.details))}")
        if any(f.parse and not f.unparsable for f in self.fields):
            raise ValueError("a field with a parser needs a code for texts that it can't parse")


DAILY_RATES = Feed(
    fields=(
        Field(
            "date", "raw_rate_date", "MISSING_DATE",
            (shaped("INVALID_DATE_FORMAT", DATE_PATTERN),),
            lambda text: in_calendar(F.try_to_date(text, DATE_FORMAT)), "INVALID_DATE_VALUE",
        ),
        Field("series", "series_id", "MISSING_SERIES_ID", (shaped("INVALID_SERIES_ID", SERIES_PATTERN),)),
        Field(
            "rate", "raw_rate", "MISSING_RATE",
            (barred("NON_FINITE_RATE", NON_FINITE_WORDS), above("NON_POSITIVE_RATE", 0)),
            parse_decimal, "INVALID_RATE",
        ),
    ),
    key=RUN_KEY,
    repeated="DUPLICATE_BUSINESS_KEY",
    details=RULE_DETAILS,
)


@dataclass(frozen=True)
class Rule:
    """A predicate that marks a row as failing; NULL counts as not failing."""

    code: str
    detail: str
    fails: Column


def typed_rows(staging: DataFrame, feed: Feed = DAILY_RATES) -> DataFrame:
    """Staging rows with each field's cleaned text, its parsed value and its first fault.

    A text with a fault isn't parsed; its value is NULL.
    """
    cleaned = staging.withColumns({f.text: clean_text(f.raw) for f in feed.fields})
    checked = computed(cleaned, **{f"_{f.fault}": f.fault_of_text() for f in feed.fields})
    parsers = {f.value: f.parse(F.when(F.col(f"_{f.fault}").isNull(), F.col(f.text))) for f in feed.fields if f.parse}
    parsed = computed(checked, **parsers) if parsers else checked
    faults = {f.fault: F.coalesce(f"_{f.fault}", f.fault_of_value()) for f in feed.fields}
    return parsed.withColumns(faults).drop(*[f"_{f.fault}" for f in feed.fields])


def feed_rules(feed: Feed = DAILY_RATES) -> list[Rule]:
    """A feed's rules over typed rows, in the order of its details; one looks at more than a row."""
    fails = {code: F.col(f.fault) == code for f in feed.fields for code in f.codes}
    fails[feed.repeated] = F.col("business_key_count") > 1
    return [Rule(code, detail, fails[code]) for code, detail in feed.details.items()]


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One boolean column per rule, and `is_valid` where none fired."""
    flagged = df.withColumns({r.code: F.coalesce(r.fails, F.lit(False)) for r in rules})
    return flagged.withColumn("is_valid", ~reduce(lambda a, b: a | b, (F.col(r.code) for r in rules)))


def flag_rows(
    staging: DataFrame,
    feed: Feed = DAILY_RATES,
    repeated: DataFrame | None = None,
    **hot: int,
) -> DataFrame:
    """Typed staging rows with key multiplicity, rule flags and validity."""
    counted = key_multiplicity(typed_rows(staging, feed), feed.key, repeated=repeated, **hot)
    return apply_rules(counted, feed_rules(feed))


def quality_summary(flags: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Staged, valid and invalid rows per run."""
    return flags.groupBy(*by).agg(
        F.count("*").alias("staged_count"),
        F.count_if("is_valid").alias("valid_count"),
        F.count_if(~F.col("is_valid")).alias("invalid_count"),
    )


def rule_totals(
    flags: DataFrame, codes: Sequence[str] = RULE_CODES, by: Sequence[str] = ("run_id",)
) -> DataFrame:
    """Failures per rule and run, counted in one pass."""
    return flags.groupBy(*by).agg(*[F.count_if(c).alias(c) for c in codes])


def exception_rows(
    flags: DataFrame,
    carry: Sequence[str],
    details: Mapping[str, str] = RULE_DETAILS,
) -> DataFrame:
    """One row per row and failed rule; only invalid rows are unpivoted."""
    texts = F.create_map(*[F.lit(t) for pair in details.items() for t in pair])
    return (
        flags.where(~F.col("is_valid"))
        .unpivot(list(carry), list(details), "error_code", "_failed")
        .where("_failed")
        .select(*carry, "error_code", texts[F.col("error_code")].alias("error_detail"))
    )


RECORD_KEY = ("run_id", "source", "source_row_no", "series_id")


def new_exceptions(
    detected: DataFrame, logged: DataFrame, record_key: Sequence[str] = RECORD_KEY
) -> DataFrame:
    """Detected exceptions that are not logged yet; missing key parts compare as equal."""
    d, g = detected.alias("d"), logged.alias("g")
    same = reduce(
        lambda a, b: a & b,
        (F.col(f"d.{k}").eqNullSafe(F.col(f"g.{k}")) for k in (*record_key, "error_code")),
    )
    return d.join(g, same, "left_anti")


def exception_load_summary(
    detected: DataFrame, inserted: DataFrame, record_key: Sequence[str] = RECORD_KEY
) -> DataFrame:
    """Invalid records, detected errors and newly inserted exceptions per run."""
    found = detected.groupBy("run_id").agg(
        F.count_distinct(F.struct(*record_key)).alias("invalid_record_count"),
        F.count("*").alias("detected_error_count"),
    )
    new = inserted.groupBy("run_id").agg(F.count("*").alias("_new"))
    return found.join(new, "run_id", "left").select(
        "run_id",
        "invalid_record_count",
        "detected_error_count",
        F.coalesce("_new", F.lit(0)).cast("bigint").alias("newly_inserted_exception_count"),
    )


def exceptions_by_code(exceptions: DataFrame) -> DataFrame:
    """Exceptions per code, most frequent first."""
    return (
        exceptions.groupBy("error_code")
        .agg(F.count("*").alias("exception_count"))
        .orderBy(F.desc("exception_count"), "error_code")
    )


def invalid_record_count(
    exceptions: DataFrame, record_key: Sequence[str] = RECORD_KEY
) -> DataFrame:
    """Distinct records with at least one exception, per run."""
    return exceptions.groupBy("run_id").agg(
        F.count_distinct(F.struct(*record_key)).alias("invalid_record_count")
    )


def invalid_agreement(
    flags: DataFrame, exceptions: DataFrame, record_key: Sequence[str] = RECORD_KEY
) -> DataFrame:
    """Do logged exceptions and row flags name equally many invalid records?"""
    flagged = flags.groupBy("run_id").agg(
        F.count_if(~F.col("is_valid")).alias("flagged_invalid_count")
    )
    return (
        flagged.join(invalid_record_count(exceptions, record_key), "run_id", "left")
        .select(
            "run_id",
            "flagged_invalid_count",
            F.coalesce("invalid_record_count", F.lit(0)).cast("bigint").alias("logged_invalid_count"),
        )
        .withColumn("agrees", F.col("flagged_invalid_count") == F.col("logged_invalid_count"))
    )
