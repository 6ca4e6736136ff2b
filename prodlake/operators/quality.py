"""Data-quality split: type text columns against declared rules, apply
defaults, check NOT NULL / length / the production model, and split rows
into accepted and rejected frames with a reason per failed check.

Checks are plain column predicates. The failed ones are joined into one
``_reasons`` text (empty when the row passed), so the whole split is a single
projection inside the scan's stage: no join, no shuffle, no array building,
and the rejected rows are kept instead of being dropped. Where only the
status is needed, :func:`failed` gives it as one boolean.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodlake.schemas import MONTH_RANGE, ColumnRule
from prodlake.sources.files import CORRUPT

REASONS = "_reasons"  # failed checks joined by SEP; "" when the row passed
RAW = "_raw"
SEP = "; "

# --- fixed values: reason texts -------------------------------------------
MALFORMED = "malformed record"


def not_type(name: str, dtype) -> str:
    return f"{name}: not {dtype.simpleString()}"


def required(name: str) -> str:
    return f"{name}: required"


def too_long(name: str, n: int) -> str:
    return f"{name}: longer than {n}"


def month_outside(lo: int, hi: int) -> str:
    return f"month: outside {lo}..{hi}"


def merge_checks(checks: Sequence[tuple[Column, str]]) -> list[tuple[Column, str]]:
    """One predicate per message (ORed), in first-seen order, so a reason is
    never listed twice."""
    merged: dict[str, Column] = {}
    for bad, msg in checks:
        merged[msg] = merged[msg] | bad if msg in merged else bad
    return [(bad, msg) for msg, bad in merged.items()]


def reasons_of(checks: Sequence[tuple[Column, str]]) -> Column:
    """The messages whose bad-row predicate is true, joined by ``SEP``, ""
    when none is (a NULL predicate counts as passed; NOT NULL has its own
    check). ``concat_ws`` skips the NULLs of the passed checks: plain string
    functions, no lambda, so the check stays in whole-stage code generation.
    """
    checks = merge_checks(checks)
    if not checks:
        return F.lit("")
    return F.concat_ws(SEP, *[F.when(bad, F.lit(msg)) for bad, msg in checks])


def failed(checks: Sequence[tuple[Column, str]]) -> Column:
    """True when any check fails (a NULL predicate counts as passed): the
    status alone, without building the reason text."""
    if not checks:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.coalesce(bad, F.lit(False)) for bad, _ in checks])


def passed() -> Column:
    return F.col(REASONS) == F.lit("")


def add_reasons(df: DataFrame, checks: Sequence[tuple[Column, str]]) -> DataFrame:
    """Append reasons to ``_reasons`` (created when absent), no repeats: a
    message the row already has is not added again."""
    if REASONS not in df.columns:
        return df.withColumn(REASONS, reasons_of(checks))
    old = F.col(REASONS)
    padded = F.concat(F.lit(SEP), old, F.lit(SEP))
    fresh = [F.when(bad & ~padded.contains(F.lit(f"{SEP}{msg}{SEP}")), F.lit(msg)) for bad, msg in merge_checks(checks)]
    return df.withColumn(REASONS, F.concat_ws(SEP, F.when(old != F.lit(""), old), *fresh))


def default_checks(rules: Sequence[ColumnRule]) -> list[tuple[Column, str]]:
    """NOT NULL and maximum length of each rule (on typed columns)."""
    checks = []
    for r in rules:
        if not r.nullable:
            checks.append((F.col(r.name).isNull(), required(r.name)))
        if r.max_length is not None:
            checks.append((F.length(F.col(r.name)) > F.lit(r.max_length), too_long(r.name, r.max_length)))
    return checks


def validate_schema(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """V3: NOT NULL and maximum length from a declared schema."""
    return add_reasons(df, default_checks(rules))


def production_checks(wellbore: str = "wellbore", month: str = "month") -> list[tuple[Column, str]]:
    """V2: wellbore required (null or blank text fails), month in 1..12."""
    lo, hi = MONTH_RANGE
    wb = F.col(wellbore)
    m = F.col(month)
    return [
        (wb.isNull() | (F.trim(wb) == F.lit("")), required(wellbore)),
        (m.isNull() | (m < F.lit(lo)) | (m > F.lit(hi)), month_outside(lo, hi)),
    ]


def validate_production(df: DataFrame) -> DataFrame:
    return add_reasons(df, production_checks())


def apply_defaults(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """V4: a NULL in a column with a default takes the default."""
    defaults = {r.name: r for r in rules if r.default is not None}
    return df.select(
        [
            F.coalesce(F.col(c), F.lit(defaults[c].default).cast(defaults[c].dtype)).alias(c) if c in defaults else F.col(c)
            for c in df.columns
        ]
    )


def type_and_check(raw: DataFrame, rules: Sequence[ColumnRule], extra: Sequence[tuple[Column, str]] = ()) -> DataFrame:
    """V1: text columns typed by ``try_cast`` per rule; a value that does not
    parse, a malformed line, a missing required value (after defaults) or an
    over-long text adds a reason. Output: typed rule columns, ``_raw`` (the
    text as read, with the corrupt line if any) and ``_reasons``.
    """
    names = [r.name for r in rules]
    has_corrupt = CORRUPT in raw.columns
    raw_fields = [F.col(n) for n in names] + ([F.col(CORRUPT)] if has_corrupt else [])
    staged = raw.select(*[F.col(n).alias(f"_t_{n}") for n in names], F.struct(*raw_fields).alias(RAW))
    checks: list[tuple[Column, str]] = []
    if has_corrupt:
        checks.append((F.col(f"{RAW}.{CORRUPT}").isNotNull(), MALFORMED))
    typed = []
    for r in rules:
        text = F.col(f"_t_{r.name}")
        value = text.try_cast(r.dtype)
        checks.append((text.isNotNull() & value.isNull(), not_type(r.name, r.dtype)))
        if r.default is not None:
            value = F.coalesce(value, F.when(text.isNull(), F.lit(r.default).cast(r.dtype)))
        typed.append(value.alias(r.name))
    out = staged.select(*typed, RAW, *[F.col(f"_t_{n}") for n in names])
    late = []
    for r in rules:
        if not r.nullable:
            # a value that failed to parse already has its reason
            late.append((F.col(r.name).isNull() & F.col(f"_t_{r.name}").isNull(), required(r.name)))
        if r.max_length is not None:
            late.append((F.length(F.col(r.name)) > F.lit(r.max_length), too_long(r.name, r.max_length)))
    # the extra (model) checks see the typed columns, like the rule checks
    return out.withColumn(REASONS, reasons_of(checks + late + list(extra))).drop(*[f"_t_{n}" for n in names])


def accepted(checked: DataFrame) -> DataFrame:
    """Rows without reasons, helper columns dropped."""
    return checked.filter(passed()).drop(REASONS, RAW)


def rejected(checked: DataFrame, joined: str | None = "reason") -> DataFrame:
    """Rows with at least one reason, as read, with the reasons (one text
    column named ``joined``, or an array ``_reasons`` when it is None)."""
    bad = checked.filter(~passed())
    reason = F.col(REASONS).alias(joined) if joined else F.split(F.col(REASONS), SEP).alias(REASONS)
    return bad.select(f"{RAW}.*", reason)


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). Each is a lazy filter of the same plan; land
    ``checked`` once (e.g. partitioned by status) when both are written, so
    the source is parsed once."""
    return accepted(checked), rejected(checked)


def quality_stamp(checked: DataFrame, column: str = "quality") -> DataFrame:
    """T4: keep every row, stamped ``passed`` or ``failed`` with its reasons."""
    stamp = F.when(passed(), F.lit("passed")).otherwise(F.lit("failed"))
    return checked.drop(RAW).withColumn(column, stamp).withColumnRenamed(REASONS, "reason")
