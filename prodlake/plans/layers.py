"""Lake-to-table load and the layer rules as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from prodlake.operators import layers as L
from prodlake.operators.load import copy_lake_to_table as _copy
from prodlake.plans.changes import ID_ORDER, VALUE_COLS
from prodlake.plans.ingest import DIRTY_SOURCE_COLUMNS, LAKE_TO_TABLE, _checked_sql, dirty_csv
from prodlake.plans import staging as S
from prodlake.plans.registry import register
from prodlake.session import scratch_path
from prodlake.sources import fixtures as fx
from prodlake.sources.tables import Target, read_target
from prodlake.streaming.landing import land_raw_stream as _land_stream

_V = ", ".join(VALUE_COLS)
_T = "t_wellbore AS wellbore, t_year AS year, t_month AS month, t_oil AS oil, t_gas AS gas"

# --- fixed values: layer tags of the landed event data ---------------------
TAGS = {"classification": "internal", "owner": "production-data", "country": "NO"}


@register(
    "copy_lake_to_table",
    f"SELECT row_number() OVER (ORDER BY {', '.join(ID_ORDER)}) AS id, {_V} "
    f"FROM (SELECT {_T} FROM ({_checked_sql()}) c WHERE reason = '') a",
)
def copy_lake_to_table(spark, sf_dir):
    target = Target.parquet(scratch_path(spark, "production-table"))
    _copy(
        spark,
        dirty_csv(spark, sf_dir),
        target,
        LAKE_TO_TABLE,
        order_by=ID_ORDER,
        columns=DIRTY_SOURCE_COLUMNS,
        header=False,
    )
    return read_target(spark, target)


def events_drop_folder(spark, sf_dir) -> str:
    """The events, dropped as Parquet files into a folder of their own (a
    streaming file source watches a folder)."""
    return S.landed(spark, sf_dir, "events_drop", fx.events, S.write_parquet)


_EVENT = "event_id, user_id, event_type, ts, value"
_TAG_SQL = ", ".join(f"'{v}' AS {k}" for k, v in TAGS.items())


def _stable(landed):
    """What doesn't differ from run to run: the event, its tags, and that
    it names its source file and a time."""
    file = F.regexp_extract(F.col("source_path"), r"([^/]+)$", 1)
    return landed.select(
        *_EVENT.split(", "),
        *TAGS,
        (F.length(file) > 0).alias("has_source"),
        F.col("source_time").isNotNull().alias("has_time"),
    )


_LANDED_SQL = f"SELECT {_EVENT}, {_TAG_SQL}, TRUE AS has_source, TRUE AS has_time FROM events"


@register("land_raw", _LANDED_SQL)
def land_raw(spark, sf_dir):
    return _stable(L.land_raw(fx.events(spark, sf_dir), **TAGS))


@register("dedup_raw", "SELECT DISTINCT * FROM events")
def dedup_raw(spark, sf_dir):
    """The same source landed twice (a rerun), then made duplicate-free."""
    ev = fx.events(spark, sf_dir)
    return L.dedup_raw(ev.unionByName(ev))


@register("dedup_raw_keep_first", _LANDED_SQL.replace("SELECT", "SELECT DISTINCT", 1))
def dedup_raw_keep_first(spark, sf_dir):
    """Landed twice with metadata, earliest landing kept."""
    landed = L.land_raw(fx.events(spark, sf_dir), **TAGS)
    return _stable(L.dedup_raw(landed.unionByName(landed), metadata=["source_path", "source_time"]))


@register(
    "lineage_columns",
    "SELECT event_id, ts, event_type, value, 'events.parquet' AS file, 'events-transform' AS job, TRUE AS has_load_time FROM events",
)
def lineage_columns(spark, sf_dir):
    """The load time differs per run; that there is one doesn't. The file is
    the driver table's name, a folder or a file."""
    raw = L.land_raw(fx.events(spark, sf_dir), **TAGS)
    traced = L.lineage_columns(raw.select("event_id", "ts", "event_type", "value", "source_path"), job="events-transform")
    file = F.regexp_extract("source_path", r"(events\.parquet)", 1)
    return traced.select(
        "event_id", "ts", "event_type", "value", file.alias("file"), "job", F.col("load_time").isNotNull().alias("has_load_time")
    )


@register("land_raw_stream", _LANDED_SQL)
def land_raw_stream(spark, sf_dir):
    """The events file landed by a streaming query, run twice on one
    checkpoint (the second run finds no new file and adds nothing)."""
    schema = fx.events(spark, sf_dir).schema
    out, ckpt = scratch_path(spark, "raw-events"), scratch_path(spark, "raw-events-ckpt")
    for _ in range(2):
        _land_stream(spark, events_drop_folder(spark, sf_dir), schema, out, ckpt, **TAGS)
    return _stable(spark.read.parquet(out))


@register("land_raw_stream_distinct", _LANDED_SQL)
def land_raw_stream_distinct(spark, sf_dir):
    """The events dropped as files, landed, dropped again as other files and
    landed by a second run: every event once."""
    events = fx.events(spark, sf_dir)
    drop, out, ckpt = (scratch_path(spark, f"events-{x}") for x in ("again", "distinct", "distinct-ckpt"))
    for _ in range(2):
        events.write.mode("append").parquet(drop)
        _land_stream(spark, drop, events.schema, out, ckpt, distinct=events.columns, **TAGS)
    return _stable(spark.read.parquet(out))


@register(
    "load_counts",
    f"SELECT count(*) AS read, count(*) FILTER (reason = '') AS accepted, count(*) FILTER (reason <> '') AS rejected FROM ({_checked_sql()}) c",
)
def load_counts(spark, sf_dir):
    """What a load read, accepted and rejected, counted while it ran."""
    target = Target.parquet(scratch_path(spark, "counted-table"))
    done = _copy(spark, dirty_csv(spark, sf_dir), target, LAKE_TO_TABLE, columns=DIRTY_SOURCE_COLUMNS, header=False)
    n = done.counts
    return spark.createDataFrame([(n.read, n.accepted, n.rejected)], "read long, accepted long, rejected long")
