"""DuckDB text for the fixture views and the decimal rules, used by the
oracle SQL of every registered query. The views mirror
:mod:`prodlake.sources.fixtures` column for column.
"""

from __future__ import annotations

VIEWS = {
    "production": """
        SELECT concat('W-', cast(l_suppkey AS varchar)) AS wellbore,
               cast(year(l_shipdate) AS int) AS year,
               cast(month(l_shipdate) AS int) AS month,
               cast(l_quantity AS decimal(15,5)) AS oil,
               cast(l_extendedprice AS decimal(15,5)) AS gas
        FROM lineitem""",
    "production_by_flag": """
        SELECT l_returnflag AS wellbore,
               cast(year(l_shipdate) AS int) AS year,
               cast(month(l_shipdate) AS int) AS month,
               cast(l_quantity AS decimal(15,5)) AS oil,
               cast(l_extendedprice AS decimal(15,5)) AS gas
        FROM lineitem""",
    "production_keyed": """
        SELECT o_orderkey AS id,
               concat('W-', cast(o_custkey AS varchar)) AS wellbore,
               cast(year(o_orderdate) AS int) AS year,
               cast(month(o_orderdate) AS int) AS month,
               cast(o_totalprice AS decimal(15,5)) AS oil,
               cast(o_totalprice / 10 AS decimal(15,5)) AS gas
        FROM orders""",
    "carrier_year": """
        SELECT l_returnflag AS carrier, cast(year(l_shipdate) AS int) AS year,
               l_quantity AS oil, l_extendedprice AS gas, l_discount AS ngl, l_tax AS condensate,
               l_quantity * l_discount AS oe, l_extendedprice * l_tax AS water
        FROM lineitem""",
    "field_csv": """
        SELECT carrier AS prfInformationCarrier,
               cast(year AS varchar) AS prfYear,
               printf('%.4f', oil) AS prfPrdOilNetMillSm3,
               printf('%.4f', gas) AS prfPrdGasNetBillSm3,
               printf('%.4f', ngl) AS prfPrdNGLNetMillSm3,
               printf('%.4f', condensate) AS prfPrdCondensateNetMillSm3,
               printf('%.4f', oe) AS prfPrdOeNetMillSm3,
               printf('%.4f', water) AS prfPrdProducedWaterInFieldMillSm3
        FROM carrier_year""",
    "production_csv": """
        SELECT wellbore AS prfInformationCarrier,
               cast(year AS varchar) AS prfYear,
               cast(month AS varchar) AS prfMonth,
               cast(oil AS varchar) AS prfPrdOilNetMillSm3,
               cast(gas AS varchar) AS prfPrdGasNetBillSm3
        FROM production""",
    "part_strings": """
        SELECT cast(p_partkey AS varchar) AS p_partkey, p_name, p_brand, p_type,
               cast(p_size AS varchar) AS p_size, cast(p_retailprice AS varchar) AS p_retailprice
        FROM part""",
}

# views that other views read
_DEPENDS = {"field_csv": ["carrier_year"], "production_csv": ["production"]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with a WITH clause defining the named fixture views."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    return f"WITH {ctes}\n{sql}"


def dsum(c: str) -> str:
    """Decimal sum pinned to decimal(25,5), like ``decimal_sum``."""
    return f"cast(sum({c}) AS decimal(25,5))"


def dmean(c: str) -> str:
    """Exact mean of a decimal(15,5) column, rounded half away from zero to
    six places, in integer arithmetic (DuckDB's avg is a double)."""
    units = f"cast(sum({c}) * 100000 AS hugeint)"
    n = f"count({c})"
    q = f"(({units}) * 20 + sign({units}) * {n}) // (2 * {n})"
    return f"cast(cast({q} AS decimal(19,0)) * cast(0.000001 AS decimal(7,6)) AS decimal(19,6))"


def interval_sql(mode: str, fy, ty, fm, tm) -> str:
    """The WHERE text of one interval (``TRUE`` when no bound is given)."""
    preds = []
    if mode == "independent":
        if fy is not None:
            preds.append(f"year >= {fy}")
        if ty is not None:
            preds.append(f"year <= {ty}")
        if fm is not None:
            preds.append(f"month >= {fm}")
        if tm is not None:
            preds.append(f"month <= {tm}")
    else:
        if fy is not None:
            preds.append(f"year * 12 + month >= {fy * 12 + (fm or 1)}")
        if ty is not None:
            preds.append(f"year * 12 + month <= {ty * 12 + (tm or 12)}")
    return " AND ".join(preds) or "TRUE"
