"""Projections: cast, enrich, map columns by declaration or by name, expand
JSON records, retype measures. All are single ``select`` nodes that
Catalyst collapses into the scan's projection."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.operators.quality import SEP, not_type
from prodlake.schemas import OIL_GAS_TYPE


def select_cast(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Keep the named columns, each cast to its type. A value that does not
    parse becomes NULL (``try_cast``) instead of failing the job."""
    return df.select([F.col(c).try_cast(t).alias(c) for c, t in types.items()])


def enrich_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """All columns plus one computed column."""
    return df.select("*", expr.alias(name))


def map_columns(df: DataFrame, mapping: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Rename by declaration: ``{source: target}``. Unmapped columns and the
    ``drop`` list (e.g. an identity column) are left out."""
    return df.select([F.col(s).alias(t) for s, t in mapping.items() if t not in drop])


def auto_map(
    df: DataFrame, target: T.StructType, case_sensitive: bool = False, reasons: str | None = None
) -> DataFrame:
    """Map by equal names (import schemas): every target column taken from
    the source column of the same name, NULL when the source has none. Source
    columns equal but for case raise, unless ``case_sensitive``. With
    ``reasons``, a column of that name tells which values didn't parse
    (``; ``-joined, empty when all did)."""
    fold = (lambda c: c) if case_sensitive else str.lower
    by_name: dict[str, str] = {}
    for c in df.columns:
        if fold(c) in by_name:
            raise ValueError(f"columns {by_name[fold(c)]!r} and {c!r} map to the same name")
        by_name[fold(c)] = c
    cols = []
    lost = []
    for f in target.fields:
        src = by_name.get(fold(f.name))
        if src:
            bad = F.col(src).isNotNull() & F.col(src).try_cast(f.dataType).isNull()
            lost.append(F.when(bad, F.lit(not_type(f.name, f.dataType))))
        value = F.col(src).try_cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        cols.append(value.alias(f.name))
    if reasons:
        cols.append((F.concat_ws(SEP, *lost) if lost else F.lit("")).alias(reasons))
    return df.select(cols)


def union_by_name(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows matched to the table by column name; columns the rows
    lack are NULL (load after ``auto_map``)."""
    return table.unionByName(rows, allowMissingColumns=True)


def expand_records(df: DataFrame, json_col: str, schema: T.DataType, keep: Sequence[str] = ()) -> DataFrame:
    """JSON text to columns. An object becomes one row, an array of objects
    one row per element (``inline``); ``keep`` columns are carried along."""
    parsed = F.from_json(F.col(json_col), schema)
    if isinstance(schema, T.ArrayType):
        return df.select(*keep, F.inline(parsed))
    return df.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")


# a variant's schema: field names, some in backquotes, and type names
_SCHEMA_PART = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\bVARIANT\b|\bVOID\b")
_AS_TYPE = {"OBJECT<": "STRUCT<", "VARIANT": "STRING", "VOID": "STRING"}


def discover_records(df: DataFrame, json_col: str) -> T.DataType:
    """The type that all of a column's JSON texts fit, found from the records
    themselves: one aggregate over the parsed texts, whose partial results are
    merged schemas, and one row to the driver. A field with values of different
    kinds, or with nulls only, is text. Texts that don't parse tell nothing."""
    parsed = F.try_parse_json(F.col(json_col))
    found = df.agg(F.schema_of_variant_agg(parsed)).first()[0]
    return T._parse_datatype_string(_SCHEMA_PART.sub(lambda m: _AS_TYPE.get(m[0], m[0]), found or "VOID"))


def _type_text(t: T.DataType) -> str:
    """A type as SQL reads it, whatever its fields are called."""
    if isinstance(t, T.StructType):
        names = [f.name.replace("`", "``") for f in t.fields]
        return "STRUCT<" + ", ".join(f"`{n}`: {_type_text(f.dataType)}" for n, f in zip(names, t.fields, strict=True)) + ">"
    return f"ARRAY<{_type_text(t.elementType)}>" if isinstance(t, T.ArrayType) else t.simpleString()


def expand_discovered(
    df: DataFrame, json_col: str, keep: Sequence[str] = (), schema: T.DataType | None = None
) -> DataFrame:
    """JSON text to columns without a declared schema: the fields are those the
    records have (``schema``: as found before). A list of records becomes a row
    each; a record that doesn't parse keeps its row, with NULLs."""
    schema = discover_records(df, json_col) if schema is None else schema
    records = isinstance(schema, T.ArrayType) and isinstance(schema.elementType, T.StructType)
    if not records and not isinstance(schema, T.StructType):
        raise ValueError(f"{json_col} holds no records: its texts are {schema.simpleString()}")
    value = F.try_variant_get(F.try_parse_json(F.col(json_col)), "$", _type_text(schema))
    if records:
        return df.select(*keep, F.inline(value))
    return df.select(*keep, value.alias("_r")).select(*keep, "_r.*")


def retype_decimal(df: DataFrame, cols: Sequence[str] = ("oil", "gas"), dtype: T.DecimalType = OIL_GAS_TYPE) -> DataFrame:
    """Change measures to a decimal type, other columns untouched."""
    targets = set(cols)
    return df.select([F.col(c).try_cast(dtype).alias(c) if c in targets else F.col(c) for c in df.columns])
