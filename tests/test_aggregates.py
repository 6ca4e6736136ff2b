from decimal import Decimal

from prodlake.operators import aggregates as A

SCHEMA = "id long, wellbore string, year int, month int, oil decimal(15,5), gas decimal(15,5)"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_sum_avg_count_types_and_values(spark):
    df = frame(
        spark,
        [
            (1, "A", 2000, 1, Decimal("1.00001"), Decimal("10")),
            (2, "A", 2000, 2, Decimal("2.00000"), Decimal("20")),
            (3, "B", 2000, 3, Decimal("5.00000"), Decimal("1")),
        ],
    )
    s = {r.wellbore: r.oil_sum for r in A.oil_sum_between(df).collect()}
    assert s == {"A": Decimal("3.00001"), "B": Decimal("5.00000")}
    assert str(A.oil_sum_between(df).schema["oil_sum"].dataType) == "DecimalType(25,5)"
    avg = {r.wellbore: r.oil_avg for r in A.oil_avg_between(df).collect()}
    # (1.00001 + 2.00000) / 2 = 1.500005 exactly, kept to six places
    assert avg["A"] == Decimal("1.500005")
    assert str(A.oil_avg_between(df).schema["oil_avg"].dataType) == "DecimalType(19,6)"
    n = {r.wellbore: r.records for r in A.records_between(df).collect()}
    assert n == {"A": 2, "B": 1}


def test_mean_rounds_half_up_once(spark):
    # mean 0.0000005 exactly: half up at six places gives 0.000001
    df = frame(spark, [(1, "A", 2000, 1, Decimal("0.00001"), Decimal(0))] + [(i, "A", 2000, 1, Decimal(0), Decimal(0)) for i in range(2, 21)])
    assert A.oil_avg_between(df).first().oil_avg == Decimal("0.000001")


def test_interval_applies_before_group(spark):
    df = frame(
        spark,
        [(1, "A", 1996, 11, Decimal(1), Decimal(1)), (2, "A", 1997, 6, Decimal(2), Decimal(2)), (3, "A", 1998, 3, Decimal(4), Decimal(4))],
    )
    assert A.oil_sum_between(df, 1996, 1998, 11, 2).count() == 0
    chrono = A.oil_sum_between(df, 1996, 1998, 11, 2, mode="chronological").first()
    assert chrono.oil_sum == Decimal("3.00000")


def test_ordered_output(spark):
    df = frame(spark, [(i, w, 2000, 1, Decimal(1), Decimal(1)) for i, w in enumerate("CAB")])
    assert [r.wellbore for r in A.gas_sum_between(df, ordered=True).collect()] == ["A", "B", "C"]


def test_pivot_gap_is_null(spark):
    df = frame(
        spark,
        [(1, "A", 2010, 1, Decimal(1), Decimal(0)), (2, "A", 2011, 1, Decimal(2), Decimal(0)), (3, "B", 2011, 1, Decimal(5), Decimal(0))],
    )
    rows = {r.year: (r.A, r.B) for r in A.measure_pivot(df, ["A", "B"]).collect()}
    assert rows == {2010: (Decimal("1.00000"), None), 2011: (Decimal("2.00000"), Decimal("5.00000"))}


def test_first_last_per_key_and_top(spark):
    df = frame(spark, [(5, "A", 2000, 1, Decimal(1), Decimal(1)), (2, "A", 2000, 2, Decimal(2), Decimal(2)), (9, "B", 2000, 3, Decimal(3), Decimal(3))])
    assert sorted((r.wellbore, r.id) for r in A.first_per_key(df).collect()) == [("A", 2), ("B", 9)]
    assert sorted((r.wellbore, r.id) for r in A.last_per_key(df).collect()) == [("A", 5), ("B", 9)]
    assert A.last_inserted(df).first().id == 9
    assert [r.id for r in A.head_n(df, 2, ["id"]).collect()] == [2, 5]
    assert A.first_match(df, "A").first().id == 2


def test_group_sums_round(spark):
    df = spark.createDataFrame([("x", 1, 0.1), ("x", 1, 0.2)], "c string, y int, v double")
    assert A.group_sums(df, ["c", "y"], ["v"], digits=4).first().sum_v == 0.3


def test_double_sums_do_not_depend_on_the_order(spark):
    import math
    import random
    import struct

    from pyspark.sql import functions as F

    r = random.Random(1)
    values = [1e16, 1.0, -1e16, 3.14, 1e-9, 2.0**79, -(2.0**79), 1 / 3] + [r.choice([-1, 1]) * r.random() * 10.0 ** r.randint(-12, 17) for _ in range(2000)]
    keyed = [("a", v) for v in values] + [("b", v) for v in values[:5]] + [("c", 0.1)] * 10 + [("n", None)]
    bits = set()
    for seed, parts in ((1, 1), (2, 3), (3, 7), (4, 16)):
        random.Random(seed).shuffle(keyed)
        df = spark.createDataFrame(keyed, "k string, v double").repartition(parts)
        out = {x.k: x.sum_v for x in A.group_sums(df, ["k"], ["v"]).collect()}
        bits.add(tuple(struct.pack("d", out[k]) for k in "abc"))
        assert out["n"] is None
        for k, exact in (("a", math.fsum(values)), ("b", math.fsum(values[:5])), ("c", math.fsum([0.1] * 10))):
            assert abs(out[k] - exact) <= math.ulp(exact)
    assert len(bits) == 1
    plain = {spark.createDataFrame([("a", v) for v in sorted(values, key=f)], "k string, v double").coalesce(1).agg(F.sum("v")).first()[0] for f in (abs, lambda v: -abs(v))}
    assert len(plain) > 1  # an ordinary sum does depend on it


def test_double_sums_of_special_values(spark):
    from math import inf, isnan

    rows = [("i", inf), ("i", 1.0), ("n", inf), ("n", -inf), ("m", float("nan")), ("h", 1e300), ("h", 1e300), ("z", -0.0), ("s", 2.0**-70)]
    out = {x.k: x.sum_v for x in A.group_sums(spark.createDataFrame(rows, "k string, v double"), ["k"], ["v"]).collect()}
    assert out["i"] == inf and isnan(out["n"]) and isnan(out["m"]) and out["h"] == 2e300 and out["z"] == 0 and out["s"] == 0


def test_pivot_to_a_map(spark):
    from decimal import Decimal

    rows = [(2000, "W-b", Decimal(1)), (2000, "W-a", Decimal(2)), (2000, "W-b", Decimal(3)), (2001, None, Decimal(4)), (2001, "W-a", None)]
    pivot = A.measure_map(spark.createDataFrame(rows, "year int, wellbore string, oil decimal(15,5)"))
    out = {r.year: r.oil_by_wellbore for r in pivot.collect()}
    assert out == {2000: {"W-a": Decimal(2), "W-b": Decimal(4)}, 2001: {"W-a": None}}
    assert pivot.filter("year = 2000").selectExpr("map_keys(oil_by_wellbore) AS k").first().k == ["W-a", "W-b"]
    empty = spark.createDataFrame([], "year int, wellbore string, oil decimal(15,5)")
    assert A.measure_map(empty).count() == 0
