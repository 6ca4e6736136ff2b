from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.operators import layers as L
from prodlake.operators import transform as P
from prodlake.sinks import writers as W
from prodlake.sources import files as SF
from prodlake.sources.tables import Target, read_target
from prodlake.streaming.landing import land_raw_stream


def test_append_twice_doubles_refresh_twice_does_not(spark, tmp):
    df = spark.range(10).withColumnRenamed("id", "k")
    app, ref = Target.parquet(f"{tmp}/a"), Target.parquet(f"{tmp}/r")
    for _ in range(2):
        W.append(df, app)
        W.full_refresh(df, ref)
    assert read_target(spark, app).count() == 20
    assert read_target(spark, ref).count() == 10


def test_csv_to_json_lines_and_multiline_pitfall(spark, tmp):
    src = Path(tmp) / "in.csv"
    src.write_text("a,b\n1,x\n2,y\n3,z\n")
    dst = W.csv_to_json(spark, str(src), f"{tmp}/json")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert SF.scan_json_lines(spark, dst, schema).count() == 3
    # multiLine on JSON Lines keeps only the first record of each file
    assert spark.read.schema(schema).option("multiLine", True).json(dst).count() < 3


def test_json_array_file(spark, tmp):
    p = Path(tmp) / "arr.json"
    p.write_text('[{"a": "1", "b": "x"},\n {"a": "2"}]')
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    rows = sorted(SF.scan_json_array(spark, str(p), schema).collect())
    assert [(r.a, r.b) for r in rows] == [("1", "x"), ("2", None)]


def test_binary_scan(spark, tmp):
    (Path(tmp) / "f.bin").write_bytes(b"\x00\x01abc")
    row = SF.scan_binary(spark, tmp, glob="*.bin").first()
    assert row.length == 5 and bytes(row.content) == b"\x00\x01abc"


def test_auto_map_and_expand(spark):
    df = spark.createDataFrame([("1", "n", '{"k": 3}')], "ID string, name string, js string")
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("missing", T.StringType())])
    r = P.auto_map(df, target).first()
    assert (r.id, r.missing) == (1, None)
    arr = T.ArrayType(T.StructType([T.StructField("k", T.IntegerType())]))
    rows = P.expand_records(spark.createDataFrame([('[{"k": 1}, {"k": 2}]',)], "js string"), "js", arr).collect()
    assert [x.k for x in rows] == [1, 2]


def test_land_and_dedup_raw(spark, tmp):
    spark.range(5).write.parquet(f"{tmp}/src")
    landed = L.land_raw(spark.read.parquet(f"{tmp}/src"), "internal", "owner-x", "NO")
    assert {"source_path", "source_time", "classification", "owner", "country"} <= set(landed.columns)
    twice = landed.unionByName(landed)
    assert L.dedup_raw(twice, metadata=["source_path", "source_time"]).count() == 5
    assert L.dedup_raw(twice.drop("source_path", "source_time")).count() == 5


def test_stream_landing_is_incremental(spark, tmp):
    src = f"{tmp}/drop"
    spark.range(3).write.parquet(f"{src}/batch1")
    schema = spark.read.parquet(f"{src}/batch1").schema
    out, ckpt = f"{tmp}/out", f"{tmp}/ckpt"
    land_raw_stream(spark, f"{src}/*", schema, out, ckpt, timeout_s=120)
    land_raw_stream(spark, f"{src}/*", schema, out, ckpt, timeout_s=120)
    assert spark.read.parquet(out).count() == 3
    spark.range(3, 5).write.parquet(f"{src}/batch2")
    land_raw_stream(spark, f"{src}/*", schema, out, ckpt, timeout_s=120)
    assert spark.read.parquet(out).count() == 5


def test_wellbore_json_against_declared_81_columns(spark, tmp):
    import json

    from prodlake.operators import quality as Q
    from prodlake.schemas import WELLBORE_COLUMNS, WELLBORE_RULES, WELLBORE_SCHEMA

    good = {n: ("x" if n != "wlbNsCode" else "N") for n, _, _ in WELLBORE_COLUMNS}
    missing = dict(good)
    missing.pop("wlbWell")  # NOT NULL column absent from the object
    long_code = dict(good, wlbNsCode="NN")  # nvarchar(1)
    p = Path(tmp) / "wellbore.json"
    p.write_text(json.dumps([good, missing, long_code]))
    df = SF.scan_json_array(spark, str(p), WELLBORE_SCHEMA)
    assert len(WELLBORE_SCHEMA.fields) == 81
    reasons = sorted(r[Q.REASONS] for r in Q.validate_schema(df, WELLBORE_RULES).collect())
    assert reasons == ["", "wlbNsCode: longer than 1", "wlbWell: required"]


def test_jdbc_options_need_bounds(spark):
    import pytest

    from prodlake.sources.jdbc import jdbc_options, scan_jdbc

    opts = jdbc_options("jdbc:x://h/db", "dbo.ProductionData", user="u", fetchsize=10)
    assert opts == {"url": "jdbc:x://h/db", "dbtable": "dbo.ProductionData", "user": "u", "fetchsize": "10"}
    with pytest.raises(ValueError):
        scan_jdbc(spark, "jdbc:x://h/db", "t", partition_column="id")


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id long, name string")
    b = spark.createDataFrame([("y",)], "name string")
    rows = sorted((r.id or 0, r.name) for r in P.union_by_name(a, b).collect())
    assert rows == [(0, "y"), (1, "x")]


def test_json_array_landing_spreads_rows(spark, tmp):
    from prodlake.plans import staging as S

    df = spark.range(120).selectExpr("cast(id % 2 AS string) AS k", "id")
    old = S.ROWS_PER_ARRAY_FILE
    S.ROWS_PER_ARRAY_FILE = 50
    try:
        S.write_json_arrays(df, f"{tmp}/arr")
    finally:
        S.ROWS_PER_ARRAY_FILE = old
    files = [p for p in Path(f"{tmp}/arr").iterdir() if p.name.startswith("part-") and p.stat().st_size > 0]
    assert len(files) == 3
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("id", T.LongType())])
    assert SF.scan_json_array(spark, f"{tmp}/arr", schema).count() == 120


def test_full_refresh_empties_partitioned_target_replace_keeps_others(spark, tmp):
    target = Target.parquet(f"{tmp}/lake", partition_by=("year",))
    both = spark.createDataFrame([(1996, 1), (1997, 2)], "year int, v int")
    only97 = spark.createDataFrame([(1997, 3)], "year int, v int")
    W.full_refresh(both, target)
    W.replace_partitions(only97, target)
    assert sorted((r.year, r.v) for r in read_target(spark, target).collect()) == [(1996, 1), (1997, 3)]
    W.full_refresh(only97, target)
    assert sorted((r.year, r.v) for r in read_target(spark, target).collect()) == [(1997, 3)]


def test_csv_with_declared_columns_checks_header(spark, tmp):
    import pytest

    from prodlake.sources import files as SF

    p = Path(tmp) / "a.csv"
    p.write_text("name,year\nW-1,2001\n")
    rows = SF.scan_csv(spark, str(p), columns=["name", "year"]).collect()
    assert [(r.name, r.year) for r in rows] == [("W-1", "2001")]
    with pytest.raises(Exception):
        SF.scan_csv(spark, str(p), columns=["year", "name"]).collect()  # other order: not mapped by position


def test_ingest_formats_round_trip(spark, tmp):
    """The formats named for ingest that this machine has: CSV, JSON, ORC and
    Parquet, each written and read back through one table description."""
    from prodlake.sinks.writers import append, full_refresh
    from prodlake.sources.tables import Target, read_target

    df = spark.createDataFrame([("W-1", 2001, 1), ("W-2", 2002, 12)], "wellbore string, year int, month int")
    for kind in ("csv", "json", "orc", "parquet"):
        target = Target(kind, f"{tmp}/{kind}")
        full_refresh(df, target)
        append(df, target)
        back = read_target(spark, target, schema=df.schema)
        assert sorted(tuple(r) for r in back.collect()) == sorted(2 * [("W-1", 2001, 1), ("W-2", 2002, 12)]), kind


def test_stored_max_reads_footers(spark, tmp):
    from pyspark.sql import functions as F

    from prodlake.sources.tables import footer_max_query, stored_max

    path = f"{tmp}/ids"
    spark.range(0, 5000, numPartitions=3).withColumn("year", (F.col("id") % 2).cast("int")).write.partitionBy("year").parquet(path)
    assert stored_max(spark, path, "id") == 4999
    plan = footer_max_query(spark, path, "id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(id)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") in ("false", None)  # caller's session untouched


def test_stream_backlog_lands_in_bounded_batches(spark, tmp):
    src = f"{tmp}/drop"
    for i in range(4):
        spark.range(i * 10, i * 10 + 10, numPartitions=1).write.parquet(f"{src}/b{i}")
    schema = spark.read.parquet(f"{src}/b0").schema
    out, ckpt = f"{tmp}/out", f"{tmp}/ckpt"
    query = land_raw_stream(spark, f"{src}/*", schema, out, ckpt, timeout_s=120, max_files_per_trigger=1)
    assert spark.read.parquet(out).count() == 40
    # one file per micro-batch, every waiting file taken
    batches = [p for p in query.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 4 and all(p["numInputRows"] == 10 for p in batches)


def test_json_file_that_breaks_off_is_rejected(spark, tmp):
    from pyspark.sql import types as T

    from prodlake.operators import quality as Q
    from prodlake.schemas import ColumnRule
    from prodlake.sources.files import scan_json_array_checked

    Path(f"{tmp}/a.json").write_text('[{"a": "1"}, {"a": "2"}]')
    Path(f"{tmp}/b.json").write_text('[{"a": "3"}, {"a": "4"}, {"a')
    rows = scan_json_array_checked(spark, f"{tmp}/*.json", T.StructType([T.StructField("a", T.StringType())]))
    checked = Q.type_and_check(rows, [ColumnRule("a", T.StringType(), nullable=True, max_length=None)])
    good, bad = Q.split(checked)
    assert sorted(r.a for r in good.collect()) == ["1", "2"]
    assert [r.reason for r in bad.collect()] == [Q.MALFORMED]


def test_csv_lines_with_other_field_counts_are_kept_apart(spark, tmp):
    Path(f"{tmp}/x.csv").write_text('a,b\n1,2\n2,3,4\n"say ""hi"", twice",5\n9\n')
    dst = W.csv_to_json(spark, f"{tmp}/x.csv", f"{tmp}/json")
    got = sorted((r.a, r.b) for r in spark.read.json(dst).collect())
    assert got == [("1", "2"), ('say "hi", twice', "5")]
    assert sorted(r.value for r in spark.read.text(f"{dst}_rejected").collect()) == ["2,3,4", "9"]


def test_auto_map_tells_what_did_not_parse(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1", "x"), ("one", "y"), (None, "z")], "id string, name string")
    target = T.StructType([T.StructField("ID", T.LongType()), T.StructField("name", T.StringType())])
    got = [tuple(r) for r in P.auto_map(df, target, reasons="why").orderBy("name").collect()]
    assert got == [(1, "x", ""), (None, "y", "ID: not bigint"), (None, "z", "")]
    with pytest.raises(ValueError, match="same name"):
        P.auto_map(df.selectExpr("id", "name", "name AS NAME2").toDF("id", "name", "NAME"), target)


def test_stream_takes_old_files(spark, tmp):
    import os
    import time

    from prodlake.streaming.landing import land_raw_stream

    src, out, ckpt = f"{tmp}/src", f"{tmp}/out", f"{tmp}/ckpt"
    spark.range(3).coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    land_raw_stream(spark, src, schema, out, ckpt)
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(src)
    old = time.time() - 30 * 86400
    newest = max(Path(src).glob("part-*.parquet"), key=lambda p: p.stat().st_mtime)
    os.utime(newest, (old, old))
    land_raw_stream(spark, src, schema, out, ckpt)
    assert spark.read.parquet(out).count() == 8


def test_fields_are_found_from_the_records(spark):
    texts = ['{"k": 1, "n": "x"}', '{"k": 2.5, "o": {"p": [1]}}', '{"k": null, "n": 3}', "broken {", None, '{"odd name": true}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, js string")
    out = P.expand_discovered(df, "js", keep=["id"])
    assert set(out.columns) == {"id", "k", "n", "o", "odd name"}
    rows = {r.id: r for r in out.collect()}
    assert float(rows[1].k) == 2.5 and rows[1].o.p == [1] and (rows[0].n, rows[2].n) == ("x", "3")
    assert rows[3].k is None and rows[4].k is None and rows[5]["odd name"] is True
    lists = spark.createDataFrame([('[{"a": 1}, {"b": "y"}]',), ("[]",), (None,)], "js string")
    assert sorted((r.a or 0, r.b or "") for r in P.expand_discovered(lists, "js").collect()) == [(0, "y"), (1, "")]
    for plain in ("[1, 2]", "7", None):
        with pytest.raises(ValueError, match="no records"):
            P.expand_discovered(spark.createDataFrame([(plain,)], "js string"), "js")


def test_load_counts_and_refusals(spark, tmp):
    from prodlake.operators import load

    src = Path(tmp) / "in.csv"
    src.write_text("W-1,2000,1,1.5,2\nW-2,2000,13,1,1\nW-3,2000,2,,1\nshort,2000\n")
    columns = ["wellbore", "year", "month", "oil", "gas"]
    names = {c: c for c in columns}
    target = Target.parquet(f"{tmp}/table")
    done = load.copy_lake_to_table(spark, str(src), target, names, columns=columns, header=False)
    assert done.counts == load.LoadCounts(4, 2, 2) and done.rejected.count() == 2
    with pytest.raises(load.LoadRefused, match="2 of 4"):
        load.copy_lake_to_table(spark, str(src), target, names, columns=columns, header=False, most_rejected=0.4)
    assert read_target(spark, target).count() == 2  # the refused load appended nothing
    ran = []
    with pytest.raises(load.LoadRefused, match="5 rows read"):
        W.in_order(lambda: load.require_reconciled(load.LoadCounts(5, 2, 2)), lambda: ran.append("second"))
    assert not ran


def test_rows_land_once_in_two_runs(spark, tmp):
    schema = "id long, at timestamp, v string"
    rows = spark.createDataFrame([(i, None, str(i % 3)) for i in range(30)], schema)
    for run in range(3):
        rows.write.mode("append").parquet(f"{tmp}/drop")
        if run == 2:
            spark.createDataFrame([(99, None, "new")], schema).write.mode("append").parquet(f"{tmp}/drop")
        land_raw_stream(spark, f"{tmp}/drop", rows.schema, f"{tmp}/out", f"{tmp}/ckpt", distinct=["id", "at", "v"])
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/out").collect()) == [*range(30), 99]
    with pytest.raises(ValueError, match="together"):
        land_raw_stream(spark, f"{tmp}/drop", rows.schema, f"{tmp}/out2", f"{tmp}/ckpt2", within="1 day", distinct=["id"])


def test_rows_are_remembered_for_a_time(spark, tmp):
    rows = spark.sql("SELECT id, timestamp'2026-01-01' + make_interval(0, 0, 0, cast(id AS int)) AS at FROM range(40)")
    for _ in range(2):
        rows.write.mode("append").parquet(f"{tmp}/drop")
        land_raw_stream(spark, f"{tmp}/drop", rows.schema, f"{tmp}/out", f"{tmp}/ckpt", distinct=["id", "at"], event_time="at", within="60 days")
    assert spark.read.parquet(f"{tmp}/out").count() == 40


def test_bloom_filters_skip_row_groups(spark, tmp):
    ids = spark.range(0, 200_000, 2, numPartitions=1).selectExpr("(id * 7919) % 1000003 * 2 AS id", "concat('W-', id) AS wellbore")
    plain, bloom = Target.parquet(f"{tmp}/plain"), Target.parquet(f"{tmp}/bloom", bloom=("id", "wellbore"))
    for t in (plain, bloom):
        W.append(ids, t)

    def rows_scanned(t, condition):
        df = read_target(spark, t).filter(condition)
        assert df.count() == (0 if "absent" in condition or "101" in condition else 1)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        while plan.children().size():
            plan = plan.children().apply(0)
        return plan.metrics().apply("numOutputRows").value()

    # odd ids lie between stored ids but none is stored
    assert rows_scanned(plain, "id = 101") > 0 and rows_scanned(bloom, "id = 101") == 0
    assert rows_scanned(plain, "wellbore = 'W-1absent'") > 0 and rows_scanned(bloom, "wellbore = 'W-1absent'") == 0
    assert rows_scanned(bloom, "wellbore = 'W-500'") > 0


def test_field_text_equals_four_decimals(spark):
    from prodlake.sources.fixtures import _text4

    edges = [0.0, -0.0, 5e-5, 4.9999e-5, 1.00005, 0.125, 1e13, 9999999999999.998, 1e-320, -3.14159, 1e22, None]
    values = edges + [float("nan"), float("inf"), float("-inf")] + [i * 7e-5 for i in range(1, 2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    quick = _text4(F.col("x"))
    rows = df.select("x", quick.alias("a"), F.format_string("%.4f", "x").alias("b")).collect()
    assert [r for r in rows if r.a != r.b] == []
    # the formatter takes what the decimal can't
    assert "decimal(18,4)" in df.select(quick.alias("a"))._jdf.queryExecution().optimizedPlan().toString()
