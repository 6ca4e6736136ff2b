"""The ingest and notebook side as named queries: CSV / JSON / binary
readers, casts, the carrier/year sums, column mapping, the quality split, the
lake-to-table copy and the sinks. Files are landed from the driver tables
(see ``staging``), so every query grows with them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.operators import aggregates as A
from prodlake.operators import quality as Q
from prodlake.operators import transform as P
from prodlake.plans import staging as S
from prodlake.plans.oracle import with_views
from prodlake.plans.registry import ORACLE, register
from prodlake.schemas import (
    ENRICH_OFFSET,
    FIELD_CARRIER,
    FIELD_COLUMNS,
    FIELD_MEASURES,
    FIELD_TYPES,
    FIELD_YEAR,
    OIL_GAS_TYPE,
    PRODUCTION_RULES,
    WELLBORE_RULES,
    ColumnRule,
)
from prodlake.session import scratch_path
from prodlake.sinks import writers as W
from prodlake.sinks.copies import copy_files
from prodlake.sources import files as SF
from prodlake.sources import fixtures as fx
from prodlake.sources.json_arrays import scan_json_array_split as scan_split
from prodlake.sources.tables import Target, read_target

# --- landed files ---------------------------------------------------------


def field_csv(spark, sf_dir):
    return S.landed(spark, sf_dir, "field_csv", fx.field_csv_frame, S.write_csv)


def production_csv(spark, sf_dir):
    return S.landed(spark, sf_dir, "production_csv", fx.production_csv_frame, S.write_csv)


def part_csv(spark, sf_dir):
    return S.landed(spark, sf_dir, "part_csv", fx.part_strings, S.write_csv)


def part_json_arrays(spark, sf_dir):
    return S.landed(spark, sf_dir, "part_json", fx.part_strings, S.write_json_arrays)


# The defective lake file: monthly production lines as text, no header, with
# defects keyed on lineitem values. The same expressions run in Spark SQL
# and in DuckDB. Defects: missing, blank and over-long wellbore; a month that
# is not a number or is 13; a missing oil (takes the default 0); a gas that
# is not a number; a line with two fields only.
DIRTY_FIELDS = {
    "wb": "CASE WHEN l_discount = 0 THEN NULL WHEN l_discount = 0.01 THEN '   ' "
    "WHEN l_quantity = 50 THEN repeat('X', 51) ELSE concat('W-', cast(l_suppkey AS string)) END",
    "yr": "cast(year(l_shipdate) AS string)",
    "mo": "CASE WHEN l_linenumber = 7 THEN concat(cast(month(l_shipdate) AS string), 'x') "
    "WHEN l_tax = 0 THEN '13' ELSE cast(month(l_shipdate) AS string) END",
    "oil": "CASE WHEN l_linenumber = 6 THEN NULL ELSE cast(cast(l_quantity AS decimal(15,5)) AS string) END",
    "gas": "CASE WHEN l_tax = 0.08 THEN 'n/a' ELSE cast(cast(l_extendedprice AS decimal(15,5)) AS string) END",
    "short": "l_returnflag = 'N' AND l_linenumber = 5",
}
DIRTY_LINE = (
    "CASE WHEN short THEN concat_ws(',', coalesce(wb, ''), yr) "
    "ELSE concat_ws(',', coalesce(wb, ''), yr, mo, coalesce(oil, ''), gas) END"
)
DIRTY_SOURCE_COLUMNS = [FIELD_CARRIER, FIELD_YEAR, "prfMonth", FIELD_MEASURES[0], FIELD_MEASURES[1]]
LAKE_TO_TABLE = dict(zip(DIRTY_SOURCE_COLUMNS, ["wellbore", "year", "month", "oil", "gas"]))


def dirty_lines_frame(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    fields = li.selectExpr(*[f"{expr} AS {name}" for name, expr in DIRTY_FIELDS.items()])
    return fields.selectExpr(f"{DIRTY_LINE} AS value")


def dirty_csv(spark, sf_dir):
    return S.landed(spark, sf_dir, "dirty_lines", dirty_lines_frame, S.write_lines)


def dirty_raw(spark, sf_dir):
    """The defective file read as text, mapped to the table's names."""
    raw = SF.scan_csv_checked(spark, dirty_csv(spark, sf_dir), columns=DIRTY_SOURCE_COLUMNS, header=False)
    return P.map_columns(raw, {**LAKE_TO_TABLE, SF.CORRUPT: SF.CORRUPT})


def dirty_checked(spark, sf_dir, model_checks: bool = True):
    extra = Q.production_checks() if model_checks else ()
    return Q.type_and_check(dirty_raw(spark, sf_dir), PRODUCTION_RULES, extra=extra)


# DuckDB text of the same: raw fields as Spark's CSV reader yields them
# (a short line keeps two fields and its text as the corrupt record) ...
_DIRTY_RAW_SQL = f"""
    SELECT CASE WHEN wb = '' THEN NULL ELSE wb END AS wellbore, yr AS year,
           CASE WHEN short THEN NULL ELSE mo END AS month,
           CASE WHEN short THEN NULL ELSE oil END AS oil,
           CASE WHEN short THEN NULL ELSE gas END AS gas,
           CASE WHEN short THEN {DIRTY_LINE} END AS _corrupt_record
    FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in DIRTY_FIELDS.items())} FROM lineitem) f"""
# ... then typed, with the reasons in the order the Spark checks make them.
_DIRTY_TYPED_SQL = f"""
    SELECT wellbore AS raw_wellbore, year AS raw_year, month AS raw_month, oil AS raw_oil, gas AS raw_gas,
           _corrupt_record,
           wellbore AS t_wellbore, TRY_CAST(year AS int) AS t_year, TRY_CAST(month AS int) AS t_month,
           coalesce(TRY_CAST(oil AS decimal(15,5)), CASE WHEN oil IS NULL THEN 0::decimal(15,5) END) AS t_oil,
           coalesce(TRY_CAST(gas AS decimal(15,5)), CASE WHEN gas IS NULL THEN 0::decimal(15,5) END) AS t_gas
    FROM ({_DIRTY_RAW_SQL}) r"""


def _reason_sql(model_checks: bool, merged: bool) -> str:
    """``merged``: model checks given to ``type_and_check`` (one predicate per
    message, in first-seen order); otherwise appended afterwards by
    ``validate_production`` (new messages go to the end)."""
    wb_required = "t_wellbore IS NULL AND raw_wellbore IS NULL"
    if model_checks and merged:
        wb_required = "t_wellbore IS NULL OR trim(t_wellbore) = ''"
    cases = [
        "CASE WHEN _corrupt_record IS NOT NULL THEN 'malformed record' END",
        "CASE WHEN raw_year IS NOT NULL AND t_year IS NULL THEN 'year: not int' END",
        "CASE WHEN raw_month IS NOT NULL AND t_month IS NULL THEN 'month: not int' END",
        "CASE WHEN raw_oil IS NOT NULL AND t_oil IS NULL THEN 'oil: not decimal(15,5)' END",
        "CASE WHEN raw_gas IS NOT NULL AND t_gas IS NULL THEN 'gas: not decimal(15,5)' END",
        f"CASE WHEN {wb_required} THEN 'wellbore: required' END",
        "CASE WHEN length(t_wellbore) > 50 THEN 'wellbore: longer than 50' END",
        "CASE WHEN t_year IS NULL AND raw_year IS NULL THEN 'year: required' END",
        "CASE WHEN t_month IS NULL AND raw_month IS NULL THEN 'month: required' END",
    ]
    if model_checks:
        if not merged:
            # appended without repeats: a null wellbore already says "required"
            cases.append("CASE WHEN t_wellbore IS NOT NULL AND trim(t_wellbore) = '' THEN 'wellbore: required' END")
        cases.append("CASE WHEN t_month IS NULL OR t_month < 1 OR t_month > 12 THEN 'month: outside 1..12' END")
    return f"concat_ws('; ', {', '.join(cases)})"


def _checked_sql(model_checks: bool = True, merged: bool = True) -> str:
    return f"SELECT *, {_reason_sql(model_checks, merged)} AS reason FROM ({_DIRTY_TYPED_SQL}) t"


# --- S1, S7, P1, A1, P2: the notebook ----------------------------------------

_FIELD_TEXT_COLS = ", ".join(FIELD_COLUMNS)


@register("scan_csv", with_views(f"SELECT {_FIELD_TEXT_COLS} FROM field_csv", "field_csv"))
def scan_csv(spark, sf_dir):
    return SF.scan_csv(spark, f"{field_csv(spark, sf_dir)}/*.csv")


@register("scan_lake", with_views(f"SELECT {_FIELD_TEXT_COLS} FROM field_csv", "field_csv"))
def scan_lake(spark, sf_dir):
    # store settings travel with the read; a local path needs none, so the
    # option shown is a harmless Hadoop setting
    return SF.scan_lake(spark, field_csv(spark, sf_dir), {"fs.file.impl.disable.cache": "true"})


def _field_cast_sql() -> str:
    casts = [f"TRY_CAST({c} AS {t})  AS {c}" for c, t in FIELD_TYPES.items()]
    return f"SELECT {', '.join(casts)} FROM field_csv"


@register("select_cast", with_views(_field_cast_sql(), "field_csv"))
def select_cast(spark, sf_dir):
    return P.select_cast(SF.scan_csv(spark, field_csv(spark, sf_dir), columns=FIELD_COLUMNS), FIELD_TYPES)


def _carrier_sums(spark, sf_dir):
    typed = P.select_cast(SF.scan_csv(spark, field_csv(spark, sf_dir), columns=FIELD_COLUMNS), FIELD_TYPES)
    return A.group_sums(typed, [FIELD_CARRIER, FIELD_YEAR], FIELD_MEASURES, digits=4)


_SUMS_SQL = ", ".join(f"round(sum({m}), 4) AS sum_{m}" for m in FIELD_MEASURES)


@register(
    "carrier_year_sums",
    with_views(f"SELECT {FIELD_CARRIER}, {FIELD_YEAR}, {_SUMS_SQL} FROM ({_field_cast_sql()}) t GROUP BY ALL", "field_csv"),
)
def carrier_year_sums(spark, sf_dir):
    return _carrier_sums(spark, sf_dir)


@register(
    "enrich_column",
    with_views(
        f"SELECT *, {FIELD_YEAR} + {ENRICH_OFFSET} AS GDPRColumn FROM "
        f"(SELECT {FIELD_CARRIER}, {FIELD_YEAR}, {_SUMS_SQL} FROM ({_field_cast_sql()}) t GROUP BY ALL) s",
        "field_csv",
    ),
)
def enrich_column(spark, sf_dir):
    sums = _carrier_sums(spark, sf_dir)
    return P.enrich_column(sums, "GDPRColumn", F.col(FIELD_YEAR) + F.lit(ENRICH_OFFSET))


# --- P3, S2, P6: mapping and typing ----------------------------------------


@register(
    "map_columns",
    with_views(
        "SELECT prfInformationCarrier AS wellbore, prfYear AS year, prfMonth AS month, "
        "prfPrdOilNetMillSm3 AS oil, prfPrdGasNetBillSm3 AS gas FROM production_csv",
        "production_csv",
    ),
)
def map_columns(spark, sf_dir):
    return P.map_columns(SF.scan_csv(spark, production_csv(spark, sf_dir), columns=DIRTY_SOURCE_COLUMNS), LAKE_TO_TABLE)


@register("scan_csv_typed", with_views("SELECT wellbore, year, month, oil, gas FROM production", "production"))
def scan_csv_typed(spark, sf_dir):
    raw = SF.scan_csv_checked(spark, production_csv(spark, sf_dir), columns=DIRTY_SOURCE_COLUMNS)
    mapped = P.map_columns(raw, {**LAKE_TO_TABLE, SF.CORRUPT: SF.CORRUPT})
    return Q.accepted(Q.type_and_check(mapped, PRODUCTION_RULES))


@register(
    "retype_decimal",
    with_views(
        "SELECT carrier, year, TRY_CAST(oil AS decimal(15,5)) AS oil, TRY_CAST(gas AS decimal(15,5)) AS gas "
        "FROM carrier_year",
        "carrier_year",
    ),
)
def retype_decimal(spark, sf_dir):
    cy = fx.carrier_year(spark, sf_dir).select("carrier", "year", "oil", "gas")
    return P.retype_decimal(cy)


# --- V1-V4, T4: the quality split on the defective file ---------------------

_RAW_OUT = "raw_wellbore AS wellbore, raw_year AS year, raw_month AS month, raw_oil AS oil, raw_gas AS gas"
_TYPED_OUT = "t_wellbore AS wellbore, t_year AS year, t_month AS month, t_oil AS oil, t_gas AS gas"


@register(
    "skip_incompatible",
    with_views(f"SELECT {_RAW_OUT}, _corrupt_record, reason FROM ({_checked_sql()}) c WHERE reason <> ''"),
)
def skip_incompatible(spark, sf_dir):
    return Q.rejected(dirty_checked(spark, sf_dir))


@register(
    "accepted_rows",
    with_views(f"SELECT {_TYPED_OUT} FROM ({_checked_sql()}) c WHERE reason = ''"),
)
def accepted_rows(spark, sf_dir):
    return Q.accepted(dirty_checked(spark, sf_dir))


@register(
    "validate_production",
    with_views(f"SELECT {_TYPED_OUT}, reason FROM ({_checked_sql(merged=False)}) c"),
)
def validate_production(spark, sf_dir):
    typed = Q.type_and_check(dirty_raw(spark, sf_dir), PRODUCTION_RULES)
    checked = Q.validate_production(typed)
    return checked.select("wellbore", "year", "month", "oil", "gas", F.col(Q.REASONS).alias("reason"))


@register(
    "quality_stamp",
    with_views(
        f"SELECT {_TYPED_OUT}, CASE WHEN reason = '' THEN 'passed' ELSE 'failed' END AS quality, reason "
        f"FROM ({_checked_sql()}) c"
    ),
)
def quality_stamp(spark, sf_dir):
    return Q.quality_stamp(dirty_checked(spark, sf_dir))


@register(
    "apply_defaults",
    with_views(
        "SELECT wellbore, TRY_CAST(year AS int) AS year, TRY_CAST(month AS int) AS month, "
        "coalesce(TRY_CAST(oil AS decimal(15,5)), 0::decimal(15,5)) AS oil, "
        "coalesce(TRY_CAST(gas AS decimal(15,5)), 0::decimal(15,5)) AS gas "
        f"FROM ({_DIRTY_RAW_SQL}) r"
    ),
)
def apply_defaults(spark, sf_dir):
    typed = P.select_cast(dirty_raw(spark, sf_dir), {r.name: r.dtype for r in PRODUCTION_RULES})
    return Q.apply_defaults(typed, PRODUCTION_RULES)


# --- fixed values: declared limits for the wide text table (part) ----------
PART_RULES = [
    ColumnRule("p_partkey", T.StringType(), nullable=False, max_length=20),
    ColumnRule("p_name", T.StringType(), nullable=False, max_length=10),
    ColumnRule("p_brand", T.StringType(), nullable=False, max_length=7),
    ColumnRule("p_type", T.StringType(), nullable=True, max_length=6),
    ColumnRule("p_size", T.StringType(), nullable=False, max_length=2),
    ColumnRule("p_retailprice", T.StringType(), nullable=True, max_length=500),
]


def _schema_reason_sql() -> str:
    cases = []
    for r in PART_RULES:
        if not r.nullable:
            cases.append(f"CASE WHEN {r.name} IS NULL THEN '{r.name}: required' END")
        cases.append(f"CASE WHEN length({r.name}) > {r.max_length} THEN '{r.name}: longer than {r.max_length}' END")
    return f"concat_ws('; ', {', '.join(cases)})"


_PART_COLS = "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice"


@register(
    "validate_schema",
    with_views(f"SELECT {_PART_COLS}, {_schema_reason_sql()} AS reason FROM part_strings", "part_strings"),
)
def validate_schema(spark, sf_dir):
    checked = Q.validate_schema(fx.part_strings(spark, sf_dir), PART_RULES)
    return checked.select(*[r.name for r in PART_RULES], F.col(Q.REASONS).alias("reason"))


# --- S3, S4, K4, P4, P5: other file shapes ---------------------------------

PART_SCHEMA = T.StructType([T.StructField(r.name, T.StringType(), True) for r in PART_RULES])
_TEXT_RULES = [ColumnRule(r.name, T.StringType(), nullable=True, max_length=None) for r in PART_RULES]


def broken_array(spark) -> str:
    """A file whose array breaks off in its second record."""
    path = scratch_path(spark, "broken-json")
    spark.range(1).select(F.lit('[{"p_partkey": "1"}, {"p_partkey": "2"').alias("value")).write.text(path)
    return path


# bytes of a file that a task holds at a time
BINARY_PIECE = 1 << 20


@register("scan_binary", with_views(f"SELECT {_FIELD_TEXT_COLS} FROM field_csv", "field_csv"))
def scan_binary(spark, sf_dir):
    """The files' bytes, decoded to lines here and split into fields: what
    was landed comes back. Each file's first line is its header."""
    pieces = SF.scan_binary(spark, field_csv(spark, sf_dir), glob="*.csv", piece_bytes=BINARY_PIECE)
    first = F.when(F.col("start") == 0, 2).otherwise(1)
    lines = pieces.select(F.explode(F.slice(F.split(F.decode("content", "UTF-8"), "\n"), first, F.lit(1 << 30))).alias("line"))
    fields = F.split("line", ",")
    return lines.filter("line <> ''").select(*[fields[i].alias(c) for i, c in enumerate(FIELD_COLUMNS)])


@register("scan_json_array", with_views(f"SELECT {_PART_COLS} FROM part_strings", "part_strings"))
def scan_json_array(spark, sf_dir):
    return SF.scan_json_array(spark, part_json_arrays(spark, sf_dir), PART_SCHEMA)


# small ranges, so that the landed files take several each at every size
RANGE_BYTES = 1 << 16


@register("copy_binary", with_views(f"SELECT {_FIELD_TEXT_COLS} FROM field_csv", "field_csv"))
def copy_binary(spark, sf_dir):
    """The landed files copied byte for byte, each in ranges by several tasks;
    the copies are read."""
    copies = scratch_path(spark, "copied")
    copy_files(spark, field_csv(spark, sf_dir), copies, glob="*.csv", chunk_bytes=RANGE_BYTES)
    return SF.scan_csv(spark, f"{copies}/*.csv", columns=FIELD_COLUMNS)


@register("scan_json_array_split", with_views(f"SELECT {_PART_COLS} FROM part_strings", "part_strings"))
def scan_json_array_split(spark, sf_dir):
    """The arrays, each file read by several tasks."""
    return scan_split(spark, part_json_arrays(spark, sf_dir), PART_SCHEMA, RANGE_BYTES).drop(SF.CORRUPT)


@register(
    "scan_json_array_split_checked",
    with_views(
        f"SELECT {_PART_COLS}, '' AS reason FROM part_strings UNION ALL SELECT '1', NULL, NULL, NULL, NULL, NULL, '' UNION ALL "
        f"SELECT {', '.join('NULL' for _ in PART_RULES)}, '{Q.MALFORMED}'",
        "part_strings",
    ),
)
def scan_json_array_split_checked(spark, sf_dir):
    """The arrays next to a file that breaks off: its whole records are kept."""
    rows = scan_split(spark, [part_json_arrays(spark, sf_dir), broken_array(spark)], PART_SCHEMA, RANGE_BYTES)
    checked = Q.type_and_check(rows, _TEXT_RULES)
    return checked.select(*[r.name for r in PART_RULES], F.col(Q.REASONS).alias("reason"))


@register("csv_to_json", with_views(f"SELECT {_PART_COLS} FROM part_strings", "part_strings"))
def csv_to_json(spark, sf_dir):
    dst = W.csv_to_json(spark, part_csv(spark, sf_dir), scratch_path(spark, "json"))
    return SF.scan_json_lines(spark, dst, PART_SCHEMA)


_AUTO_TARGET = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("P_BRAND", T.StringType()),
        T.StructField("p_comment", T.StringType()),
    ]
)


@register(
    "auto_map",
    with_views(
        "SELECT TRY_CAST(p_partkey AS bigint) AS p_partkey, p_name, p_brand AS P_BRAND, "
        "CAST(NULL AS varchar) AS p_comment FROM part_strings",
        "part_strings",
    ),
)
def auto_map(spark, sf_dir):
    return P.auto_map(SF.scan_json_array(spark, part_json_arrays(spark, sf_dir), PART_SCHEMA), _AUTO_TARGET)


@register(
    "expand_records",
    "SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS int) AS k FROM events",
)
def expand_records(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    return P.expand_records(ev, "props", T.StructType([T.StructField("k", T.IntegerType())]), keep=["event_id"])


@register("discover_records", "SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS bigint) AS k FROM events")
def discover_records(spark, sf_dir):
    """The events' properties as columns, found from the records."""
    return P.expand_discovered(fx.events(spark, sf_dir), "props", keep=["event_id"])


@register("discover_record_lists", with_views("SELECT wellbore, year, month, oil FROM production_keyed", "production_keyed"))
def discover_record_lists(spark, sf_dir):
    """Lists of records to a row each, their fields found from the records."""
    found = P.expand_discovered(_record_lists(spark, sf_dir), "records", keep=["wellbore"])
    return P.select_cast(found, {"wellbore": "string", "year": "int", "month": "int", "oil": OIL_GAS_TYPE})


# --- K1, K2, K5, K6, K3: sinks and loads -----------------------------------

_KEYED = "id, wellbore, year, month, oil, gas"


@register("sink_append", with_views(f"SELECT {_KEYED} FROM production_keyed UNION ALL SELECT {_KEYED} FROM production_keyed", "production_keyed"))
def sink_append(spark, sf_dir):
    target = Target.parquet(scratch_path(spark, "append"))
    rows = fx.production_keyed(spark, sf_dir)
    W.append(rows, target)
    W.append(rows, target)  # not idempotent: twice the rows
    return read_target(spark, target)


@register("sink_full_refresh", with_views(f"SELECT {_KEYED} FROM production_keyed", "production_keyed"))
def sink_full_refresh(spark, sf_dir):
    target = Target.parquet(scratch_path(spark, "refresh"))
    rows = fx.production_keyed(spark, sf_dir)
    W.full_refresh(rows, target)
    W.full_refresh(rows, target)  # idempotent: rows once
    return read_target(spark, target)


@register("sink_lake", with_views("SELECT wellbore, year, month, oil, gas FROM production", "production"))
def sink_lake(spark, sf_dir):
    path = W.sink_lake(fx.production(spark, sf_dir), scratch_path(spark, "lake"), partition_by=("year",))
    return spark.read.parquet(path).select("wellbore", "year", "month", "oil", "gas")


@register("two_step_refresh", with_views(f"SELECT {_PART_COLS} FROM part_strings", "part_strings"))
def two_step_refresh(spark, sf_dir):
    """CSV to JSON, then (only if that succeeded) empty and load a table."""
    json_dir = scratch_path(spark, "json")
    target = Target.parquet(scratch_path(spark, "wellbore-table"))
    W.in_order(
        lambda: W.csv_to_json(spark, part_csv(spark, sf_dir), json_dir),
        lambda: W.full_refresh(SF.scan_json_lines(spark, json_dir, PART_SCHEMA), target),
    )
    return read_target(spark, target)


@register(
    "scan_json_array_checked",
    with_views(f"SELECT {_PART_COLS}, '' AS reason FROM part_strings UNION ALL "
               f"SELECT {', '.join(f'NULL AS {r.name}' for r in PART_RULES)}, '{Q.MALFORMED}' AS reason", "part_strings"),
)
def scan_json_array_checked(spark, sf_dir):
    """The arrays next to a file that breaks off: it is one row with a reason."""
    rows = SF.scan_json_array_checked(spark, [part_json_arrays(spark, sf_dir), broken_array(spark)], PART_SCHEMA)
    checked = Q.type_and_check(rows, _TEXT_RULES)
    return checked.select(*[r.name for r in PART_RULES], F.col(Q.REASONS).alias("reason"))


def _record_lists(spark, sf_dir):
    rows = fx.production_keyed(spark, sf_dir)
    record = F.struct("year", "month", "oil")
    return rows.groupBy("wellbore", "year").agg(F.to_json(F.collect_list(record)).alias("records")).drop("year")


@register(
    "expand_record_lists",
    with_views("SELECT wellbore, year, month, oil FROM production_keyed", "production_keyed"),
)
def expand_record_lists(spark, sf_dir):
    """Lists of records (the orders of a customer and year) to one row a record."""
    record = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()), T.StructField("oil", OIL_GAS_TYPE)])
    return P.expand_records(_record_lists(spark, sf_dir), "records", T.ArrayType(record), keep=["wellbore"])


@register(
    "auto_map_append",
    with_views(
        "SELECT TRY_CAST(p_partkey AS bigint) AS p_partkey, p_name, p_brand AS P_BRAND, CAST(NULL AS varchar) AS p_comment, '' AS reason "
        "FROM part_strings UNION ALL SELECT TRY_CAST(p_name AS bigint), p_name, p_brand, NULL, "
        "CASE WHEN TRY_CAST(p_name AS bigint) IS NULL THEN 'p_partkey: not bigint' ELSE '' END FROM part_strings",
        "part_strings",
    ),
)
def auto_map_append(spark, sf_dir):
    """Two sources mapped by name and appended; keys that don't parse (the
    second source has names there) are NULL with a reason."""
    rows = fx.part_strings(spark, sf_dir)
    first = P.auto_map(rows, _AUTO_TARGET, reasons="reason")
    second = P.auto_map(rows.withColumn("p_partkey", F.col("p_name")).select("p_partkey", "p_name", "p_brand"), _AUTO_TARGET, reasons="reason")
    return P.union_by_name(first, second)


def wide_wellbores(spark, sf_dir):
    """Every part as a row of the declared 81 text columns: its values spread
    over them in turn, some left out, some too long."""
    part = fx.part_strings(spark, sf_dir)
    source = part.columns
    return part.select(
        *[F.expr(_wide_sql(i, source[i % len(source)])).alias(r.name) for i, r in enumerate(WELLBORE_RULES)], F.col("p_partkey").alias("_part")
    )


def _wide_sql(i: int, column: str) -> str:
    """Column ``i``: every 7th value left out in a different row, every 11th
    repeated 60 times."""
    return (
        f"CASE WHEN (cast(p_partkey AS bigint) + {i}) % 7 = 0 THEN NULL "
        f"WHEN (cast(p_partkey AS bigint) + {i}) % 11 = 0 THEN repeat({column}, 60) ELSE {column} END"
    )


def _wide_reasons_sql() -> str:
    source = [r.name for r in PART_RULES]
    out = []
    for i, r in enumerate(WELLBORE_RULES):
        value = _wide_sql(i, source[i % len(source)]).replace("AS string", "AS varchar")
        if not r.nullable:
            out.append(f"CASE WHEN ({value}) IS NULL THEN '{r.name}: required' END")
        if r.max_length is not None:
            out.append(f"CASE WHEN length({value}) > {r.max_length} THEN '{r.name}: longer than {r.max_length}' END")
    return f"concat_ws('; ', {', '.join(out)})"


@register("validate_wellbore", with_views(f"SELECT p_partkey, {_wide_reasons_sql()} AS reason FROM part_strings", "part_strings"))
def validate_wellbore(spark, sf_dir):
    """V3 with the 81 declared columns over a whole driver table."""
    checked = Q.validate_schema(wide_wellbores(spark, sf_dir), WELLBORE_RULES)
    return checked.select(F.col("_part").alias("p_partkey"), F.col(Q.REASONS).alias("reason"))


@register("notebook_end_to_end", ORACLE["enrich_column"])
def notebook_end_to_end(spark, sf_dir):
    """Extract, cast, sum, enrich, append to a table, read the table back."""
    target = Target.parquet(scratch_path(spark, "transformed"))
    sums = _carrier_sums(spark, sf_dir)
    W.append(P.enrich_column(sums, "GDPRColumn", F.col(FIELD_YEAR) + F.lit(ENRICH_OFFSET)), target)
    return read_target(spark, target)
