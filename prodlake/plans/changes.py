"""The API's write side as named queries: change batches derived from the
driver tables, applied to ``production_keyed``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from prodlake.operators import changes as M
from prodlake.operators import quality as Q
from prodlake.operators import transform as P
from prodlake.plans.ingest import _DIRTY_RAW_SQL, dirty_raw
from prodlake.plans.oracle import with_views
from prodlake.plans.registry import ORACLE as ORACLE_SQL
from prodlake.plans.registry import register
from prodlake.schemas import OIL_GAS_TYPE, PRODUCTION_RULES
from prodlake.session import scratch_path
from prodlake.sinks.writers import full_refresh, write_changed_partitions
from prodlake.sources import fixtures as fx
from prodlake.sources.tables import Target, read_target, stored_max

VALUE_COLS = ["wellbore", "year", "month", "oil", "gas"]
ID_ORDER = ["year", "month", "wellbore", "oil", "gas"]
_V = ", ".join(VALUE_COLS)


# --- insert requests: the defective lake rows, typed with defaults, so some
# fail the model checks (blank wellbore, month 13, ...) -----------------------
def insert_requests(spark, sf_dir):
    typed = P.select_cast(dirty_raw(spark, sf_dir), {r.name: r.dtype for r in PRODUCTION_RULES})
    return Q.apply_defaults(typed, PRODUCTION_RULES)


_REQ_SQL = (
    "SELECT wellbore, TRY_CAST(year AS int) AS year, TRY_CAST(month AS int) AS month, "
    "coalesce(TRY_CAST(oil AS decimal(15,5)), 0::decimal(15,5)) AS oil, "
    "coalesce(TRY_CAST(gas AS decimal(15,5)), 0::decimal(15,5)) AS gas "
    f"FROM ({_DIRTY_RAW_SQL}) r"
)
_VALID_SQL = (
    "wellbore IS NOT NULL AND trim(wellbore) <> '' AND length(wellbore) <= 50 AND year IS NOT NULL "
    "AND month IS NOT NULL AND month BETWEEN 1 AND 12 AND oil IS NOT NULL AND gas IS NOT NULL"
)
_ASSIGNED_SQL = (
    f"SELECT row_number() OVER (ORDER BY {', '.join(ID_ORDER)}) + (SELECT max(id) FROM production_keyed) AS id, {_V} "
    f"FROM ({_REQ_SQL}) q WHERE {_VALID_SQL}"
)


def _largest_id(spark, sf_dir) -> int:
    """The largest stored id, from the files' footers."""
    return int(stored_max(spark, f"{sf_dir.rstrip('/')}/orders.parquet", "o_orderkey") or 0)


def _inserted(spark, sf_dir) -> M.ChangeResult:
    table, requests = fx.production_keyed(spark, sf_dir), insert_requests(spark, sf_dir)
    return M.apply_inserts(table, requests, order_by=ID_ORDER, start_after=_largest_id(spark, sf_dir))


@register("assign_ids", with_views(_ASSIGNED_SQL, "production_keyed"))
def assign_ids(spark, sf_dir):
    valid = insert_requests(spark, sf_dir).filter(~Q.failed(M.insert_checks()))
    return M.assign_ids(valid, _largest_id(spark, sf_dir), order_by=ID_ORDER)


@register(
    "apply_inserts",
    with_views(f"SELECT id, {_V} FROM production_keyed UNION ALL SELECT id, {_V} FROM ({_ASSIGNED_SQL}) a", "production_keyed"),
)
def apply_inserts(spark, sf_dir):
    return _inserted(spark, sf_dir).table


@register(
    "insert_report",
    with_views(
        f"SELECT {_V}, id, 'applied' AS status FROM ({_ASSIGNED_SQL}) a UNION ALL "
        f"SELECT {_V}, CAST(NULL AS bigint) AS id, 'bad_request' AS status FROM ({_REQ_SQL}) q WHERE NOT ({_VALID_SQL})",
        "production_keyed",
    ),
)
def insert_report(spark, sf_dir):
    return _inserted(spark, sf_dir).report


# --- update batch: one change per lineitem to key 2 x order key (about half
# not stored); a return flag R sends a mismatched path key; the line number
# orders changes to one key --------------------------------------------------
def update_changes(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") * 2
    return li.select(
        key.alias("id"),
        F.when(F.col("l_returnflag") == "R", key + 1).otherwise(key).alias("path_id"),
        F.col("l_linenumber").alias("seq"),
        F.concat(F.lit("W-"), F.col("l_suppkey").cast("string")).alias("wellbore"),
        F.year("l_shipdate").cast("int").alias("year"),
        F.month("l_shipdate").cast("int").alias("month"),
        F.col("l_quantity").cast(OIL_GAS_TYPE).alias("oil"),
        F.col("l_extendedprice").cast(OIL_GAS_TYPE).alias("gas"),
    )


_CHANGES_SQL = (
    "SELECT l_orderkey * 2 AS id, CASE WHEN l_returnflag = 'R' THEN l_orderkey * 2 + 1 ELSE l_orderkey * 2 END AS path_id, "
    "l_linenumber AS seq, concat('W-', cast(l_suppkey AS varchar)) AS wellbore, cast(year(l_shipdate) AS int) AS year, "
    "cast(month(l_shipdate) AS int) AS month, cast(l_quantity AS decimal(15,5)) AS oil, "
    "cast(l_extendedprice AS decimal(15,5)) AS gas FROM lineitem"
)
_FLAGGED_SQL = (
    f"SELECT c.*, (path_id IS NULL OR path_id <> id OR NOT ({_VALID_SQL})) AS bad, "
    f"id IN (SELECT id FROM production_keyed) AS found FROM ({_CHANGES_SQL}) c"
)
_WIN_ORDER = "seq DESC, wellbore DESC, year DESC, month DESC, oil DESC, gas DESC"
_WINNERS_SQL = (
    f"SELECT DISTINCT id, {_V} FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY {_WIN_ORDER}) AS rk "
    f"FROM ({_FLAGGED_SQL}) f WHERE NOT bad AND found) r WHERE rk = 1"
)


def _updated(spark, sf_dir) -> M.ChangeResult:
    return M.apply_updates(fx.production_keyed(spark, sf_dir), update_changes(spark, sf_dir))


@register(
    "apply_updates",
    with_views(
        "SELECT k.id, "
        + ", ".join(f"CASE WHEN w.id IS NOT NULL THEN w.{c} ELSE k.{c} END AS {c}" for c in VALUE_COLS)
        + f" FROM production_keyed k LEFT JOIN ({_WINNERS_SQL}) w ON k.id = w.id",
        "production_keyed",
    ),
)
def apply_updates(spark, sf_dir):
    return _updated(spark, sf_dir).table


@register(
    "change_report",
    with_views(
        f"SELECT id, path_id, seq, {_V}, CASE WHEN bad THEN 'bad_request' WHEN NOT found THEN 'not_found' "
        f"WHEN rank() OVER (PARTITION BY id, (NOT bad AND found) ORDER BY {_WIN_ORDER}) = 1 THEN 'applied' "
        f"ELSE 'superseded' END AS status FROM ({_FLAGGED_SQL}) f",
        "production_keyed",
    ),
)
def change_report(spark, sf_dir):
    return _updated(spark, sf_dir).report


# --- delete batch: key 2 x order key per lineitem, line number as sequence --
def delete_requests(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_orderkey") * 2).alias("id"), F.col("l_linenumber").alias("seq"))


_DEL_SQL = "SELECT l_orderkey * 2 AS id, l_linenumber AS seq FROM lineitem"


def _deleted(spark, sf_dir) -> M.ChangeResult:
    return M.apply_deletes(fx.production_keyed(spark, sf_dir), delete_requests(spark, sf_dir))


@register(
    "apply_deletes",
    with_views(f"SELECT id, {_V} FROM production_keyed WHERE id NOT IN (SELECT id FROM ({_DEL_SQL}) d)", "production_keyed"),
)
def apply_deletes(spark, sf_dir):
    return _deleted(spark, sf_dir).table


@register(
    "removed_rows",
    with_views(f"SELECT id, {_V} FROM production_keyed WHERE id IN (SELECT id FROM ({_DEL_SQL}) d)", "production_keyed"),
)
def removed_rows(spark, sf_dir):
    return _deleted(spark, sf_dir).removed


@register(
    "delete_report",
    with_views(
        # one delete of a key is applied, also where line numbers repeat
        "SELECT id, seq, CASE WHEN found AND row_number() OVER (PARTITION BY id ORDER BY seq) = 1 THEN 'applied' ELSE 'not_found' END "
        f"AS status FROM (SELECT d.*, id IN (SELECT id FROM production_keyed) AS found FROM ({_DEL_SQL}) d) x",
        "production_keyed",
    ),
)
def delete_report(spark, sf_dir):
    return _deleted(spark, sf_dir).report


# --- conflicts: the insert batch above next to a third of the stored rows,
# refused where an equal row is stored or was asked for before --------------
def conflicting_requests(spark, sf_dir):
    known = fx.production_keyed(spark, sf_dir).filter(F.col("id") % 3 == 0).select(*VALUE_COLS)
    return insert_requests(spark, sf_dir).select(*VALUE_COLS).unionByName(known)


_CONFLICT_SQL = (
    f"SELECT {_V}, row_number() OVER (PARTITION BY {_V}) AS rn, ({_V}) IN (SELECT ({_V}) FROM production_keyed) AS stored "
    f"FROM (SELECT {_V} FROM ({_REQ_SQL}) q UNION ALL SELECT {_V} FROM production_keyed WHERE id % 3 = 0) u WHERE {_VALID_SQL}"
)


@register(
    "apply_inserts_conflict",
    with_views(
        f"SELECT {_V}, row_number() OVER (ORDER BY {', '.join(ID_ORDER)}) + (SELECT max(id) FROM production_keyed) AS id, "
        f"'applied' AS status FROM ({_CONFLICT_SQL}) a WHERE rn = 1 AND NOT stored UNION ALL "
        f"SELECT {_V}, CAST(NULL AS bigint) AS id, 'conflict' AS status FROM ({_CONFLICT_SQL}) c WHERE rn > 1 OR stored UNION ALL "
        f"SELECT {_V}, CAST(NULL AS bigint) AS id, 'bad_request' AS status FROM ({_REQ_SQL}) q WHERE NOT ({_VALID_SQL})",
        "production_keyed",
    ),
)
def apply_inserts_conflict(spark, sf_dir):
    table, requests = fx.production_keyed(spark, sf_dir), conflicting_requests(spark, sf_dir)
    start = _largest_id(spark, sf_dir)
    return M.apply_inserts(table, requests, order_by=ID_ORDER, reject_existing_on=VALUE_COLS, start_after=start).report


@register(
    "delete_report_ties",
    with_views(
        "SELECT id, seq, CASE WHEN found AND row_number() OVER (PARTITION BY id ORDER BY seq) = 1 THEN 'applied' ELSE 'not_found' END "
        f"AS status FROM (SELECT d.*, id IN (SELECT id FROM production_keyed) AS found FROM ({_DEL_SQL} UNION ALL {_DEL_SQL}) d) x",
        "production_keyed",
    ),
)
def delete_report_ties(spark, sf_dir):
    """Every delete asked for twice, with the same sequence number."""
    requests = delete_requests(spark, sf_dir)
    return M.apply_deletes(fx.production_keyed(spark, sf_dir), requests.unionByName(requests)).report


# --- the keyed table stored bucketed by id: a change batch then shuffles only
# itself; the table is read bucket by bucket, never re-shuffled -------------
_BUCKETED: dict[tuple[int, str], str] = {}


def production_keyed_bucketed(spark, sf_dir):
    """``production_keyed`` saved once per session as a catalog table in the
    shared folder, bucketed by id into as many buckets as the session's
    shuffle width (so the change side's shuffle lines up with the buckets)."""
    memo = (id(spark), sf_dir)
    name = _BUCKETED.get(memo)
    if name is None or not spark.catalog.tableExists(name):
        # a new name each time: never replaces a table someone else made
        name = f"production_keyed_{uuid.uuid4().hex[:12]}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        target = Target.catalog(name, path=scratch_path(spark, name), bucket_by=("id",), buckets=buckets)
        full_refresh(fx.production_keyed(spark, sf_dir), target)
        _BUCKETED[memo] = name
    return spark.table(name)


@register("apply_updates_bucketed", ORACLE_SQL["apply_updates"])
def apply_updates_bucketed(spark, sf_dir):
    return M.apply_updates(production_keyed_bucketed(spark, sf_dir), update_changes(spark, sf_dir)).table


@register("apply_deletes_bucketed", ORACLE_SQL["apply_deletes"])
def apply_deletes_bucketed(spark, sf_dir):
    return M.apply_deletes(production_keyed_bucketed(spark, sf_dir), delete_requests(spark, sf_dir)).table


# --- the keyed table as a year-partitioned folder: a change batch rewrites
# only the years it touches ------------------------------------------------
def _keyed_lake_copy(spark, sf_dir) -> Target:
    """A fresh copy of ``production_keyed`` partitioned by year (a change
    query must not alter a table other queries read)."""
    target = Target.parquet(scratch_path(spark, "keyed-lake"), partition_by=("year",))
    full_refresh(fx.production_keyed(spark, sf_dir), target)
    return target


def _commit(spark, target: Target, change):
    write_changed_partitions(spark, target, change)
    return read_target(spark, target).select("id", *VALUE_COLS)


@register("apply_updates_lake", ORACLE_SQL["apply_updates"])
def apply_updates_lake(spark, sf_dir):
    target = _keyed_lake_copy(spark, sf_dir)
    batch = update_changes(spark, sf_dir)
    return _commit(spark, target, lambda t: M.apply_updates(t, batch))


@register("apply_deletes_lake", ORACLE_SQL["apply_deletes"])
def apply_deletes_lake(spark, sf_dir):
    target = _keyed_lake_copy(spark, sf_dir)
    batch = delete_requests(spark, sf_dir)
    return _commit(spark, target, lambda t: M.apply_deletes(t, batch))
