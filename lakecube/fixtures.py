"""Stand-in inputs derived from the test tables.

Each fixture only reshapes a test table into the schema an operator expects
(grid, static field, observations, prediction, training log).  None of them
does an operator's work.  The same SQL body feeds Spark (``spark.sql`` with
DataFrame arguments) and the DuckDB oracle (as a CTE), so both engines see
identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .session import read_table

# name -> (SQL body with {table} placeholders, fixture dependencies, base tables)
FIXTURE_SQL: dict[str, tuple[str, tuple[str, ...], tuple[str, ...]]] = {
    # Daily SST cube on a 20 x 30 grid with a -99999 fill value.
    "sst_raw": (
        "select cast(l_shipdate as date) as time, cast(l_suppkey%20 as bigint) as lat_idx, "
        "cast(l_partkey%30 as bigint) as lon_idx, "
        "38.875e0+0.5e0*(l_suppkey%20) as lat, -92.25e0+0.5e0*(l_partkey%30) as lon, "
        "min(case when l_tax=0 then -99999e0 else l_quantity end) as sst "
        "from {lineitem} group by 1,2,3,4,5",
        (), ("lineitem",)),
    "sst_grid": (
        "select time, lat_idx, lon_idx, lat, lon, "
        "case when sst=-99999e0 then null else sst end as sst from {sst_raw}",
        ("sst_raw",), ()),
    # Static depth on the same grid; land has depth <= 0.
    "bathymetry": (
        "select cast(p_partkey%20 as bigint) as lat_idx, "
        "cast(cast(floor(p_partkey/20) as bigint)%30 as bigint) as lon_idx, "
        "38.875e0+0.5e0*(p_partkey%20) as lat, "
        "-92.25e0+0.5e0*(cast(floor(p_partkey/20) as bigint)%30) as lon, "
        "max(p_size)-30e0 as depth from {part} group by 1,2,3,4",
        (), ("part",)),
    "lakemask": (
        "select lat_idx, lon_idx, lat, lon, "
        "cast(case when depth>0 then 1 else 0 end as bigint) as mask from {bathymetry}",
        ("bathymetry",), ()),
    # Coarser, offset daily grid with a -1 land sentinel and missing days.
    "ice_raw": (
        "select cast(o_orderdate as date) as time, 38.7e0+0.7e0*(o_custkey%15) as lat, "
        "-92.4e0+0.8e0*(cast(floor(o_custkey/15) as bigint)%20) as lon, "
        "max(case when o_orderstatus='F' then -1e0 else o_totalprice/1024e0 end) as ice_concentration "
        "from {orders} group by 1,2,3",
        (), ("orders",)),
    # Point observations, some with a missing longitude.
    "buoy_obs": (
        "select event_id as obs, ts as time, 38.9e0+0.23e0*(user_id%40) as latitude, "
        "case when user_id%37=0 then null else -92.1e0+0.37e0*(user_id%39) end as longitude, "
        "273.15e0+value/16e0 as temperature_k from {events}",
        (), ("events",)),
    # A prediction (mean, std) on the SST grid.
    "pred": (
        "select cast(l_shipdate as date) as time, cast(l_suppkey%20 as bigint) as lat_idx, "
        "cast(l_partkey%30 as bigint) as lon_idx, "
        "avg(l_quantity+20e0*(l_discount-0.05e0)) as mean, avg(16e0*l_tax) as std "
        "from {lineitem} group by 1,2,3",
        (), ("lineitem",)),
    # Per-batch training losses: 100 epochs x 100 batches at sf0.01.
    "training_log": (
        "select cast(floor(event_id/100) as bigint) as epoch, event_id%100 as batch, "
        "value/(1e0+sqrt(floor(event_id/100))) as loss from {events}",
        (), ("events",)),
    # Daily observations of orders' totals as a point-observation table spanning years.
    "order_obs": (
        "select o_orderkey as obs, o_orderdate as time, o_totalprice as temperature_k from {orders}",
        (), ("orders",)),
}


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in FIXTURE_SQL[n][1]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def fixture(spark: SparkSession, sf_dir: str, name: str, _cache=None) -> DataFrame:
    """Build fixture ``name`` as a Spark DataFrame over the test tables in ``sf_dir``."""
    cache = {} if _cache is None else _cache
    if name in cache:
        return cache[name]
    body, deps, tables = FIXTURE_SQL[name]
    args = {t: read_table(spark, sf_dir, t) for t in tables}
    for d in deps:
        args[d] = fixture(spark, sf_dir, d, cache)
    df = spark.sql(body, **args)
    cache[name] = df
    return df


def fixtures(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    cache: dict = {}
    return [fixture(spark, sf_dir, n, cache) for n in names]


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs (DuckDB side) of the named fixtures."""
    ctes = []
    for n in _order(names):
        body, deps, tables = FIXTURE_SQL[n]
        fmt = {t: t for t in tables}
        fmt.update({d: d for d in deps})
        ctes.append(f"{n} AS ({body.format(**fmt)})")
    if not ctes:
        return sql
    sql = sql.strip()
    if sql.lower().startswith("with recursive "):
        return "WITH RECURSIVE " + ", ".join(ctes) + ", " + sql[15:]
    if sql.lower().startswith("with "):
        return "WITH " + ", ".join(ctes) + ", " + sql[5:]
    return "WITH " + ", ".join(ctes) + " " + sql
