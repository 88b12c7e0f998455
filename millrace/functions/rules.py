"""Validation rules: one rule is a field, a name and a boolean column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import is_filled_object, with_once
from millrace.schemas import ID_PATTERN, Field, Record

ERRORS = "validation_errors"
KEYS = "_keys"
RAW = "_raw"


@dataclass(frozen=True)
class Rule:
    """``passes`` must be true; null counts as a failure."""

    field: str
    name: str
    passes: Column

    @property
    def label(self) -> str:
        return f"{self.field}:{self.name}"


def required(field: str, c: Column) -> Rule:
    return Rule(field, "required", c.isNotNull())


def one_of(field: str, c: Column, values: Sequence[str]) -> Rule:
    return Rule(field, "enum", c.isNull() | c.isin(*values))


def in_range(field: str, c: Column, low: float | None, high: float | None, floating: bool) -> Rule:
    """Inclusive bounds.  NaN fails: Spark orders it above every number."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & (c >= F.lit(low))
    if high is not None:
        inside = inside & (c <= F.lit(high))
    if floating:
        inside = inside & ~F.isnan(c)
    return Rule(field, "range", c.isNull() | inside)


def non_empty(field: str, c: Column) -> Rule:
    return Rule(field, "payload", c.isNull() | is_filled_object(c))


def matches(field: str, c: Column, pattern: str) -> Rule:
    return Rule(field, "format", c.isNull() | c.rlike(pattern))


def field_rules(f: Field, c: Column) -> list[Rule]:
    """The rules a field's definition implies for its typed value."""
    rules = []
    if f.required:
        rules.append(required(f.name, c))
    if f.one_of:
        rules.append(one_of(f.name, c, f.one_of))
    if f.low is not None or f.high is not None:
        rules.append(in_range(f.name, c, f.low, f.high, isinstance(f.type, T.DoubleType)))
    if f.non_empty:
        rules.append(non_empty(f.name, c))
    if f.pattern:
        rules.append(matches(f.name, c, f.pattern))
    return rules


def rules_for(record: Record, prefix: str = "", only: Sequence[str] | None = None) -> list[Rule]:
    """All rules of a record over typed columns named ``prefix + field``."""
    rules = []
    for f in record.fields:
        if only is None or f.name in only:
            rules += field_rules(f, F.col(f"{prefix}{f.name}"))
    return rules


def error_array(rules: Sequence[Rule]) -> Column:
    """The labels of the failed rules, in rule order."""
    checks = [F.when(F.coalesce(r.passes, F.lit(False)), None).otherwise(r.label) for r in rules]
    # Labels are distinct, so a set difference drops the nulls and nothing else;
    # unlike a lambda it is compiled.
    return F.array_except(F.array(*checks), F.array(F.lit(None).cast("string")))


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``validation_errors``; errors a record already carries stay in front."""
    found = error_array(rules)
    if ERRORS in df.columns:
        found = F.concat(F.coalesce(F.col(ERRORS), F.array().cast("array<string>")), found)
    return with_once(df, ERRORS, found)


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with their errors).

    Both come from one plan; persist ``df`` or write the validated table once
    if its computation is dear.
    """
    checked = validate(df, rules)
    return checked.filter(F.size(ERRORS) == 0), checked.filter(F.size(ERRORS) > 0)


def id_rules(column: str) -> list[Rule]:
    """A text id must be present and well formed; for commands on single records."""
    return [required(column, F.col(column)), matches(column, F.col(column), ID_PATTERN)]


# --- JSON documents -------------------------------------------------------


def parse_documents(df: DataFrame, doc: str) -> DataFrame:
    """Parse JSON text once into ``_raw``, a map from key to text.

    A map keeps apart what a struct cannot: an absent key and a null value.
    Nested values stay JSON text.
    """
    raw = with_once(df, RAW, F.from_json(F.col(doc), T.MapType(T.StringType(), T.StringType())))
    return raw.withColumn(KEYS, F.map_keys(RAW))


def _typed(f: Field) -> Column:
    text = F.col(RAW)[f.name]
    if isinstance(f.type, (T.MapType, T.ArrayType)):
        return F.from_json(text, f.type)
    if isinstance(f.type, T.StringType):
        return text
    if isinstance(f.type, T.IntegralType):
        text = F.regexp_replace(text, r"^([+-]?\d+)\.0+$", "$1")  # 3.0 is a whole number
    return text.try_cast(f.type)


def _fallback(f: Field) -> Column:
    if isinstance(f.type, T.MapType):
        return F.create_map().cast(f.type)
    if isinstance(f.type, T.ArrayType):
        return F.array().cast(f.type)
    return F.lit(f.default).cast(f.type)


def typed_documents(df: DataFrame, record: Record) -> DataFrame:
    """Add the record's typed columns; a default fills an absent key only."""
    present = {f.name: F.array_contains(KEYS, f.name) for f in record.fields}
    columns = {}
    for f in record.fields:
        value = _typed(f)
        if f.default is not None:
            value = F.when(F.coalesce(present[f.name], F.lit(False)), value).otherwise(_fallback(f))
        columns[f.name] = value
    return df.withColumns(columns)


def document_rules(record: Record) -> list[Rule]:
    """Rules on the JSON shape, for the output of ``typed_documents``: readable,
    no unknown keys, convertible values, no explicit null where the record has
    a non-null default."""
    allowed = F.array(*[F.lit(n) for n in record.field_names])
    rules = [
        Rule("document", "json", F.col(KEYS).isNotNull()),
        Rule("document", "unknown_fields", F.size(F.array_except(F.col(KEYS), allowed)) == 0),
    ]
    for f in record.fields:
        text = F.col(RAW)[f.name]
        if not isinstance(f.type, T.StringType):
            rules.append(Rule(f.name, "type", text.isNull() | F.col(f.name).isNotNull()))
        if f.default is not None and not f.nullable:
            explicit_null = F.array_contains(KEYS, f.name) & text.isNull()
            rules.append(Rule(f.name, "required", ~F.coalesce(explicit_null, F.lit(False))))
    return rules


def validate_documents(df: DataFrame, doc: str, record: Record) -> DataFrame:
    """Parse, type and check JSON documents; adds the fields and the errors."""
    typed = typed_documents(parse_documents(df, doc), record)
    rules = document_rules(record) + rules_for(record)
    return validate(typed, rules).drop(KEYS, RAW)
