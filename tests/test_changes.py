from pathlib import Path
from decimal import Decimal

import pytest

from prodlake.operators import changes as M

SCHEMA = "id long, wellbore string, year int, month int, oil decimal(15,5), gas decimal(15,5)"
CHANGE = "id long, path_id long, seq int, wellbore string, year int, month int, oil decimal(15,5), gas decimal(15,5)"


@pytest.fixture()
def table(spark):
    rows = [(i, f"W-{i}", 2000, 1, Decimal(i), Decimal(0)) for i in range(1, 6)]
    return spark.createDataFrame(rows, SCHEMA)


def status_of(report):
    return sorted((r.id, r.seq, r.status) for r in report.collect())


def test_updates(spark, table):
    changes = spark.createDataFrame(
        [
            (5, 6, 1, "W-x", 2001, 2, Decimal(1), Decimal(1)),  # path id != body id
            (999, 999, 1, "W-x", 2001, 2, Decimal(1), Decimal(1)),  # unknown id
            (2, 2, 1, "W-a", 2001, 2, Decimal(1), Decimal(1)),  # superseded by seq 2
            (2, 2, 2, "W-b", 2001, 3, Decimal(2), Decimal(2)),
            (3, 3, 1, "W-c", 2001, 13, Decimal(2), Decimal(2)),  # invalid month
        ],
        CHANGE,
    )
    res = M.apply_updates(table, changes)
    assert status_of(res.report) == [
        (2, 1, "superseded"),
        (2, 2, "applied"),
        (3, 1, "bad_request"),
        (5, 1, "bad_request"),
        (999, 1, "not_found"),
    ]
    new = {r.id: (r.wellbore, r.month) for r in res.table.collect()}
    assert new == {1: ("W-1", 1), 2: ("W-b", 3), 3: ("W-3", 1), 4: ("W-4", 1), 5: ("W-5", 1)}


def test_unknown_id_leaves_table_unchanged(spark, table):
    changes = spark.createDataFrame([(999, 999, 1, "W-x", 2001, 2, Decimal(1), Decimal(1))], CHANGE)
    res = M.apply_updates(table, changes)
    assert sorted(res.table.collect()) == sorted(table.collect())
    dels = M.apply_deletes(table, spark.createDataFrame([(999, 1)], "id long, seq int"))
    assert dels.table.count() == 5 and dels.removed.count() == 0
    assert status_of(dels.report) == [(999, 1, "not_found")]


def test_deletes(spark, table):
    dels = spark.createDataFrame([(2, 1), (2, 2), (4, 1)], "id long, seq int")
    res = M.apply_deletes(table, dels)
    assert sorted(r.id for r in res.table.collect()) == [1, 3, 5]
    assert sorted(r.id for r in res.removed.collect()) == [2, 4]
    assert status_of(res.report) == [(2, 1, "applied"), (2, 2, "not_found"), (4, 1, "applied")]


def test_inserts_get_ids_after_max(spark, table):
    req = spark.createDataFrame(
        [("W-new", 2002, 1, Decimal(1), Decimal(1)), ("W-bad", 2002, 0, Decimal(1), Decimal(1)), ("W-1", 2000, 1, Decimal(1), Decimal(0))],
        "wellbore string, year int, month int, oil decimal(15,5), gas decimal(15,5)",
    )
    res = M.apply_inserts(table, req, order_by=["wellbore"])
    rep = sorted((r.wellbore, r.id, r.status) for r in res.report.collect())
    assert rep == [("W-1", 6, "applied"), ("W-bad", None, "bad_request"), ("W-new", 7, "applied")]
    assert res.table.count() == 7
    conflict = M.apply_inserts(table, req, order_by=["wellbore"], reject_existing_on=["wellbore", "year", "month", "oil", "gas"])
    rep = sorted((r.wellbore, r.status) for r in conflict.report.collect())
    assert rep == [("W-1", "conflict"), ("W-bad", "bad_request"), ("W-new", "applied")]


def test_assign_ids_dense_in_order_across_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).selectExpr("(id * 7919) % 5000 AS v")
    out = M.assign_ids(df, 100, order_by=["v"])
    rows = sorted((r.id, r.v) for r in out.collect())
    assert [i for i, _ in rows] == list(range(101, 5101))
    assert [v for _, v in rows] == sorted(v for _, v in rows)


def test_stored_numbering_ignores_task_layout(spark, tmp):
    """Ids come from (file, row index), so a re-run with other splits and
    other shuffle widths (as after a lost executor) gives the same ids."""
    from pyspark.sql import functions as F

    path = f"{tmp}/stored"
    spark.range(0, 20000, numPartitions=5).select((F.col("id") * 7919 % 20000).alias("v")).write.parquet(path)
    first = {r.v: r.id for r in M.number_stored(spark, path, 0).collect()}
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")
    try:
        again = {r.v: r.id for r in M.number_stored(spark, path, 0).collect()}
    finally:
        spark.conf.set(key, before)
    assert first == again
    assert sorted(first.values()) == list(range(1, 20001))


def test_load_without_order_numbers_staged_rows(spark, tmp):
    from pathlib import Path

    from prodlake.operators.load import copy_lake_to_table
    from prodlake.sources.tables import Target, read_target

    src = Path(tmp) / "src.csv"
    src.write_text("W,Y,M,O,G\n" + "\n".join(f"W-{i},2001,{1 + i % 12},{i},1" for i in range(50)) + "\nW-x,2001,13,1,1\n")
    mapping = {"W": "wellbore", "Y": "year", "M": "month", "O": "oil", "G": "gas"}
    target = Target.parquet(f"{tmp}/table")
    res = copy_lake_to_table(spark, str(src), target, mapping)
    assert res.rejected.count() == 1
    ids = sorted(r.id for r in read_target(spark, target).collect())
    assert ids == list(range(1, 51))


def test_bucketed_table_is_not_reshuffled(spark, tmp, table):
    from prodlake.sinks.writers import full_refresh
    from prodlake.sources.tables import Target

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = Target.catalog("keyed_bucketed_test", path=f"{tmp}/kb", bucket_by=("id",), buckets=n)
    full_refresh(table, target)
    stored = spark.table("keyed_bucketed_test")
    changes = spark.createDataFrame([(2, 2, 1, "W-b", 2001, 3, Decimal(2), Decimal(2))], CHANGE)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        bucketed = M.apply_updates(stored, changes).table
        plain = M.apply_updates(table, changes).table
        shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        # plain: the table and the changes each shuffled once; bucketed: only the changes
        assert shuffles(plain) == 2 and shuffles(bucketed) == 1
        assert {r.id: r.wellbore for r in bucketed.collect()} == {1: "W-1", 2: "W-b", 3: "W-3", 4: "W-4", 5: "W-5"}
    finally:
        spark.conf.set(key, before)


def test_empty_batches(spark, table):
    empty = spark.createDataFrame([], "wellbore string, year int, month int, oil decimal(15,5), gas decimal(15,5)")
    res = M.apply_inserts(table, empty, order_by=["wellbore"])
    assert res.table.count() == 5 and res.report.count() == 0
    assert M.assign_ids(empty, 0, order_by=["wellbore"]).count() == 0


def test_changed_partitions_only_are_rewritten(spark, tmp):
    from prodlake.sinks.writers import full_refresh, write_changed_partitions
    from prodlake.sources.tables import Target, read_target

    rows = [(1, "W-1", 2000, 1, Decimal(1), Decimal(0)), (2, "W-2", 2001, 1, Decimal(2), Decimal(0)),
            (3, "W-3", 2002, 1, Decimal(3), Decimal(0)), (4, "W-4", 2003, 1, Decimal(4), Decimal(0))]
    target = Target.parquet(f"{tmp}/lake", partition_by=("year",))
    full_refresh(spark.createDataFrame(rows, SCHEMA), target)
    files = lambda year: sorted(p.name for p in Path(f"{tmp}/lake/year={year}").glob("*.parquet"))
    untouched = files(2003)
    # id 1 moves from 2000 to 2001; id 3 (the only row of 2002) is deleted
    moved = spark.createDataFrame([(1, 1, 1, "W-1", 2001, 5, Decimal(9), Decimal(9))], CHANGE)
    touched = write_changed_partitions(spark, target, lambda t: M.apply_updates(t, moved))
    assert sorted(r.year for r in touched.collect()) == [2000, 2001]
    gone = spark.createDataFrame([(3, 1)], "id long, seq int")
    touched = write_changed_partitions(spark, target, lambda t: M.apply_deletes(t, gone))
    assert [r.year for r in touched.collect()] == [2002]
    got = sorted((r.id, r.year, r.month) for r in read_target(spark, target).collect())
    assert got == [(1, 2001, 5), (2, 2001, 1), (4, 2003, 1)]
    assert not Path(f"{tmp}/lake/year=2002").exists()
    assert files(2003) == untouched  # never rewritten


def test_stored_numbering_over_partition_folders(spark, tmp):
    """One task writes files of the same name into several partition
    folders; every row still gets its own id."""
    from pyspark.sql import functions as F

    path = f"{tmp}/parts"
    spark.range(0, 600, numPartitions=2).withColumn("year", (F.col("id") % 3).cast("int")).write.partitionBy("year").parquet(path)
    ids = sorted(r.id for r in M.number_stored(spark, path, 0, key="n").select(F.col("n").alias("id")).collect())
    assert ids == list(range(1, 601))


def test_changed_partitions_create_a_new_year(spark, tmp):
    from prodlake.sinks.writers import full_refresh, write_changed_partitions
    from prodlake.sources.tables import Target, read_target

    rows = [(1, "W-1", 2000, 1, Decimal(1), Decimal(0)), (2, "W-2", 2001, 1, Decimal(2), Decimal(0))]
    target = Target.parquet(f"{tmp}/lake", partition_by=("year",))
    full_refresh(spark.createDataFrame(rows, SCHEMA), target)
    moved = spark.createDataFrame([(1, 1, 1, "W-1", 2005, 5, Decimal(9), Decimal(9))], CHANGE)
    touched = write_changed_partitions(spark, target, lambda t: M.apply_updates(t, moved))
    assert sorted(r.year for r in touched.collect()) == [2000, 2005]
    got = sorted((r.id, r.year) for r in read_target(spark, target).collect())
    assert got == [(1, 2005), (2, 2001)]
    assert not Path(f"{tmp}/lake/year=2000").exists()


def test_partition_commit_with_null_partitions(spark, tmp):
    from prodlake.sinks.writers import full_refresh, write_changed_partitions
    from prodlake.sources.tables import Target, read_target

    rows = [(1, "A", None, 1, Decimal(1), Decimal(0)), (2, "B", 2001, 1, Decimal(2), Decimal(0)), (3, "C", None, 1, Decimal(2), Decimal(0))]
    target = Target.parquet(f"{tmp}/lake", partition_by=("year",))
    full_refresh(spark.createDataFrame(rows, SCHEMA), target)
    moved = spark.createDataFrame([(1, 1, 1, "A2", 2001, 5, Decimal(9), Decimal(9))], CHANGE)
    write_changed_partitions(spark, target, lambda t: M.apply_updates(t, moved))
    got = sorted((r.id, r.wellbore, r.year) for r in read_target(spark, target).collect())
    assert got == [(1, "A2", 2001), (2, "B", 2001), (3, "C", None)]
    # nothing stored is touched: nothing is written
    none = spark.createDataFrame([(99, 1)], "id long, seq int")
    assert write_changed_partitions(spark, target, lambda t: M.apply_deletes(t, none)).count() == 0


def test_partition_commit_goes_on_after_a_crash(spark, tmp, monkeypatch):
    from prodlake.sinks import writers as W
    from prodlake.sources.tables import Target, read_target

    rows = [(i, "W", 2000 + i, 1, Decimal(i), Decimal(0)) for i in range(1, 5)]
    for crash_at in ("replace_partitions", "delete_path"):
        target = Target.parquet(f"{tmp}/{crash_at}", partition_by=("year",))
        W.full_refresh(spark.createDataFrame(rows, SCHEMA), target)
        moved = spark.createDataFrame([(1, 1, 1, "W", 2002, 5, Decimal(9), Decimal(9))], CHANGE)
        places = []
        real = W.commit_partitions
        monkeypatch.setattr(W, "commit_partitions", lambda s, t, p: (places.append(p), real(s, t, p)))
        with monkeypatch.context() as m:

            def lost(*a):
                raise RuntimeError("driver lost")

            m.setattr(W, crash_at, lost)
            with pytest.raises(RuntimeError):
                W.write_changed_partitions(spark, target, lambda t: M.apply_updates(t, moved))
        real(spark, target, places[0])
        got = sorted((r.id, r.year) for r in read_target(spark, target).collect())
        assert got == [(1, 2002), (2, 2002), (3, 2003), (4, 2004)]
        assert not Path(f"{tmp}/{crash_at}/year=2001").exists()
        monkeypatch.undo()


def files_read(df, folder: str) -> int:
    """Files that the executed plan's scan of a folder read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.finalPhysicalPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        if name == "FileSourceScanExec" and folder in node.relation().location().rootPaths().toString():
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_first_and_last_year_read_two_folders(spark, tmp):
    from prodlake.sinks import writers as W
    from prodlake.sources.tables import Target, read_target

    rows = [(i, "W", 1990 + i % 20, 1, Decimal(i), Decimal(0)) for i in range(100)]
    target = Target.parquet(f"{tmp}/lake", partition_by=("year",))
    W.full_refresh(spark.createDataFrame(rows, SCHEMA), target)
    stored = read_target(spark, target)
    for years, n in (([1996], 5), ([1990, 2009], 10), ([1990, 2009, 2050], 10)):
        touched = W.staged_partitions(spark.createDataFrame([(y,) for y in years], "year int"), f"{tmp}/touched-{n}-{len(years)}")
        part = W.stored_slice(stored, touched, ["year"])
        there = [f for y in years for f in Path(f"{tmp}/lake/year={y}").glob("*.parquet")]
        assert part.count() == n and files_read(part, f"{tmp}/lake") == len(there) < len(list(Path(f"{tmp}/lake").rglob("*.parquet")))
        assert "dynamicpruning" in part._jdf.queryExecution().executedPlan().toString()


def test_null_partitions_are_sliced_too(spark, tmp):
    from prodlake.sinks import writers as W
    from prodlake.sources.tables import Target, read_target

    rows = [(i, "W", (1990, None, 1992)[i % 3], 1, Decimal(i), Decimal(0)) for i in range(30)]
    target = Target.parquet(f"{tmp}/lake", partition_by=("year",))
    W.full_refresh(spark.createDataFrame(rows, SCHEMA), target)
    touched = W.staged_partitions(spark.createDataFrame([(None,), (1992,)], "year int"), f"{tmp}/touched")
    part = W.stored_slice(read_target(spark, target), touched, ["year"])
    assert {r.year for r in part.collect()} == {None, 1992} and part.count() == 20


def test_a_batch_is_staged_once_and_its_report_is_made_on_demand(spark, table, tmp, monkeypatch):
    from prodlake.sinks import writers as W
    from prodlake.sources.tables import Target

    staged = []
    real = M.stored_frame
    monkeypatch.setattr(M, "stored_frame", lambda df, name: (staged.append(name), real(df, name))[1])
    change = spark.createDataFrame([(1, 1, 1, "W-9", 2002, 3, Decimal(2), Decimal(2))], CHANGE)
    target = Target.parquet(f"{tmp}/lake", partition_by=("year",))
    W.full_refresh(table, target)
    W.write_changed_partitions(spark, target, lambda t: M.apply_updates(t, change))
    assert staged == ["update-batch", "winning-updates"]
    staged.clear()
    res = M.apply_deletes(table, spark.createDataFrame([(1, 1)], "id long, seq int"))
    res.table.count(), res.removed.count()
    assert staged == ["delete-batch", "first-deletes"]
    assert [r.status for r in res.report.collect()] == [M.APPLIED] and staged[-1] == "stored-deletes"
    res.report.collect()
    assert len(staged) == 3


def test_offsets_of_many_files_are_not_broadcast(spark, tmp, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(M, "MOST_BROADCAST_FILES", 3)
    path = f"{tmp}/stored"
    spark.range(0, 500, numPartitions=7).select(F.col("id").alias("v")).write.parquet(path)
    numbered = M.number_stored(spark, path, 10)
    assert "ResolvedHint" not in numbered._jdf.queryExecution().analyzed().toString()
    assert {r.v: r.id for r in numbered.collect()} == {v: v + 11 for v in range(500)}


def test_missing_body_id_and_defaults(spark, table):
    changes = spark.createDataFrame(
        [(None, 1, 1, "W", 2001, 3, Decimal(2), Decimal(2)), (2, 2, 1, "W-b", 2001, 3, None, None), (None, None, 1, "W", 2001, 3, Decimal(2), Decimal(2))],
        CHANGE,
    )
    res = M.apply_updates(table, changes)
    assert sorted((r.id or 0, r.status) for r in res.report.collect()) == [(0, M.BAD_REQUEST), (0, M.BAD_REQUEST), (2, M.APPLIED)]
    assert [(r.oil, r.gas) for r in res.table.filter("id = 2").collect()] == [(0, 0)]
    new = spark.createDataFrame([("W-9", 2001, 2, None, None)], "wellbore string, year int, month int, oil decimal(15,5), gas decimal(15,5)")
    assert [(r.status, r.oil) for r in M.apply_inserts(table, new, start_after=70).report.collect()] == [(M.APPLIED, 0)]


def test_equal_changes_have_one_winner(spark, table):
    same = (2, 2, 1, "W-b", 2001, 3, Decimal(2), Decimal(2))
    res = M.apply_updates(table, spark.createDataFrame([same, same, same, (3, 3, None, "W-c", 2001, 3, Decimal(2), Decimal(2))], CHANGE))
    assert sorted((r.id, r.status) for r in res.report.collect()) == [(2, M.APPLIED), (2, M.SUPERSEDED), (2, M.SUPERSEDED), (3, M.APPLIED)]
    dele = M.apply_deletes(table, spark.createDataFrame([(1, 5), (1, 5), (2, None), (3, 1), (3, None), (77, 1)], "id long, seq int"))
    assert sorted((r.id, r.status) for r in dele.report.collect()) == [
        (1, M.APPLIED), (1, M.NOT_FOUND), (2, M.APPLIED), (3, M.APPLIED), (3, M.NOT_FOUND), (77, M.NOT_FOUND)
    ]
    assert {r.id for r in dele.removed.collect()} == {1, 2, 3} and dele.table.count() == 2


def test_conflicts_inside_a_batch(spark, table):
    stored = table.filter("id = 1").first()
    req = [(stored.wellbore, stored.year, 7, Decimal(1), Decimal(1)), ("N", 2001, 1, Decimal(1), Decimal(1)), ("N", 2001, 2, Decimal(1), Decimal(1)), ("M", 2002, 1, None, None)]
    batch = spark.createDataFrame(req, "wellbore string, year int, month int, oil decimal(15,5), gas decimal(15,5)")
    res = M.apply_inserts(table, batch, reject_existing_on=["wellbore", "year"])
    assert sorted((r.wellbore, r.status) for r in res.report.collect()) == sorted(
        [(stored.wellbore, M.CONFLICT), ("N", M.APPLIED), ("N", M.CONFLICT), ("M", M.APPLIED)]
    )
    assert res.table.count() == 7


def test_numbering_in_small_groups(spark, tmp, monkeypatch):
    monkeypatch.setattr(M, "GROUP_FILES", 1)
    from pyspark.sql import functions as F

    path = f"{tmp}/stored"
    spark.range(0, 5000, numPartitions=7).select(F.col("id").alias("v")).write.parquet(path)
    got = {r.v: r.id for r in M.number_stored(spark, path, 10).collect()}
    assert got == {v: v + 11 for v in range(5000)}
