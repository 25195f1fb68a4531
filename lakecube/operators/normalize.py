"""Fit/apply normalisation.

``fit_*`` return an immutable parameter frame (one row per variable or axis);
``apply_*`` read the parameters as scalar subqueries, so applying them is a
projection of the big table with no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

PARAM_SCHEMA = "var string, method string, mean double, std double, min double, max double"


def _stack(one_row: DataFrame, entries: list[tuple[str, str, list[Column]]]) -> DataFrame:
    """Reshape a one-row aggregate into one row per variable."""
    structs = [F.struct(F.lit(v).alias("var"), F.lit(m).alias("method"),
                        vals[0].cast("double").alias("mean"), vals[1].cast("double").alias("std"),
                        vals[2].cast("double").alias("min"), vals[3].cast("double").alias("max"))
               for v, m, vals in entries]
    return one_row.select(F.explode(F.array(*structs)).alias("p")).select("p.*")


def fit_mean_std(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: mean and population std per variable (NULLs skipped), one pass."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    row = df.agg(*aggs)
    nul = F.lit(None)
    return _stack(row, [(c, "mean_std", [F.col(f"{c}__mean"), F.col(f"{c}__std"), nul, nul]) for c in cols])


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: min and max per variable, one pass."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    row = df.agg(*aggs)
    nul = F.lit(None)
    return _stack(row, [(c, "min_max", [nul, nul, F.col(f"{c}__min"), F.col(f"{c}__max")]) for c in cols])


def fit_coord_map(df: DataFrame, x1: str = "lat", x2: str = "lon") -> DataFrame:
    """Affine coordinate map with one shared span (keeps the aspect ratio).

    Rows (axis, name, lo, hi) with hi = lo + span and span = max of the two ranges.
    """
    row = df.agg(F.min(x1).alias("lo1"), F.max(x1).alias("hi1"), F.min(x2).alias("lo2"), F.max(x2).alias("hi2"))
    span = F.greatest(F.col("hi1") - F.col("lo1"), F.col("hi2") - F.col("lo2"))
    rows = F.array(
        F.struct(F.lit("x1").alias("axis"), F.lit(x1).alias("name"), F.col("lo1").alias("lo"),
                 (F.col("lo1") + span).alias("hi")),
        F.struct(F.lit("x2").alias("axis"), F.lit(x2).alias("name"), F.col("lo2").alias("lo"),
                 (F.col("lo2") + span).alias("hi")))
    return row.select(F.explode(rows).alias("p")).select("p.*")


def _params(params: DataFrame, var: str, *fields: str) -> Column:
    """One scalar subquery holding every parameter of ``var`` (a struct).

    Fields are read from the same subquery, which Spark evaluates once per
    plan, so a fit over a big table is not repeated per parameter.
    """
    return (params.filter(F.col("var") == var)
            .select(F.struct(*[F.first(f).alias(f) for f in fields])).scalar())


def _coords(coord_params: DataFrame) -> Column:
    """The whole coordinate map as one struct scalar: lo/hi of x1 and x2."""
    def pick(axis, field):
        return F.max(F.when(F.col("axis") == axis, F.col(field)))
    return coord_params.select(F.struct(pick("x1", "lo").alias("lo1"), pick("x1", "hi").alias("hi1"),
                                        pick("x2", "lo").alias("lo2"), pick("x2", "hi").alias("hi2"))).scalar()


def apply_mean_std(df: DataFrame, params: DataFrame, cols: Sequence[str], inverse: bool = False,
                   add_offset: bool = True) -> DataFrame:
    """z-score each column with its fitted mean/std (or undo it)."""
    out = {}
    for c in cols:
        p = _params(params, c, "mean", "std")
        m, s = p.getField("mean"), p.getField("std")
        out[c] = (C.mean_std_inverse(c, m, s, add_offset) if inverse else C.mean_std_forward(c, m, s))
    return df.withColumns(out)


def apply_min_max(df: DataFrame, params: DataFrame, cols: Sequence[str], inverse: bool = False,
                  feature_range: tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """min-max scale each column onto ``feature_range`` (or undo it)."""
    out = {}
    for c in cols:
        p = _params(params, c, "min", "max")
        lo, hi = p.getField("min"), p.getField("max")
        out[c] = (C.min_max_inverse(c, lo, hi, feature_range) if inverse
                  else C.min_max_forward(c, lo, hi, feature_range))
    return df.withColumns(out)


def apply_coord_map(df: DataFrame, coord_params: DataFrame, x1: str = "lat", x2: str = "lon",
                    inverse: bool = False, out1: str = "x1", out2: str = "x2") -> DataFrame:
    """(lat, lon) -> (x1, x2) = (c - lo) / span, or back with ``inverse``."""
    cp = _coords(coord_params)
    res = {}
    for k, src, dst in (("1", x1, out1), ("2", x2, out2)):
        lo, hi = cp.getField(f"lo{k}"), cp.getField(f"hi{k}")
        res[dst] = C.affine_inverse(src, lo, hi - lo) if inverse else C.affine_forward(src, lo, hi - lo)
    return df.withColumns(res)


# --- persisted normaliser config (nested JSON document, one file) --------------------

def _by_key(entries: Column, key: str) -> Column:
    """Sort an array of (key, value) structs by key (values may be maps, which do not order)."""
    def cmp(a, b):
        ka, kb = a.getField(key), b.getField(key)
        return F.when(ka < kb, F.lit(-1)).when(ka > kb, F.lit(1)).otherwise(F.lit(0))
    return F.array_sort(entries, cmp)


def params_to_json(params: DataFrame, coord_params: DataFrame | None = None) -> DataFrame:
    """K6 payload: one JSON text row ``{"coords": {...}, "<var>": {"method", "params"}}``.

    ``collect_list`` runs over the parameter rows only (one per variable / axis).
    """
    var_params = F.when(
        F.col("method") == "mean_std",
        F.map_from_arrays(F.array(F.lit("mean"), F.lit("std")), F.array("mean", "std"))).otherwise(
        F.map_from_arrays(F.array(F.lit("min"), F.lit("max")), F.array("min", "max")))
    # entries sorted by name: the same parameters always give the same document
    variables = params.agg(F.to_json(F.map_from_entries(_by_key(F.collect_list(F.struct(
        "var", F.struct(F.col("method"), var_params.alias("params"))).alias("e")), "var"))).alias("j"))
    if coord_params is None:
        return variables.select(F.col("j").alias("value"))
    coords = coord_params.agg(F.to_json(F.map_from_entries(_by_key(F.collect_list(F.struct(
        "axis", F.struct(F.col("name"), F.array("lo", "hi").alias("map")))), "axis"))).alias("c"))
    # both sides are one-row global aggregates: zip them with a scalar subquery
    c = coords.select("c").scalar()
    return variables.select(F.concat(F.lit('{"coords":'), c, F.lit(","),
                                     F.expr("substring(j, 2)")).alias("value"))


def save_norm_params(params: DataFrame, path: str, coord_params: DataFrame | None = None) -> str:
    """K6: write the normaliser config as one JSON document under ``path``."""
    params_to_json(params, coord_params).coalesce(1).write.mode("overwrite").text(path)
    return path


NORM_ENTRY = "method string, params map<string, double>"
COORD_ENTRY = "name string, map array<double>"


def load_norm_params(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """Read a saved config back as (variable params, coordinate params) frames."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", "map<string, string>")).alias("key", "json"))
    variables = (entries.filter(F.col("key") != "coords")
                 .select(F.col("key").alias("var"), F.from_json("json", NORM_ENTRY).alias("p"))
                 .select("var", F.col("p.method").alias("method"),
                         F.col("p.params")["mean"].alias("mean"), F.col("p.params")["std"].alias("std"),
                         F.col("p.params")["min"].alias("min"), F.col("p.params")["max"].alias("max")))
    coords = (entries.filter(F.col("key") == "coords")
              .select(F.explode(F.from_json("json", "map<string, string>")).alias("axis", "j"))
              .select("axis", F.from_json("j", COORD_ENTRY).alias("c"))
              .select("axis", F.col("c.name").alias("name"), F.col("c.map")[0].alias("lo"),
                      F.col("c.map")[1].alias("hi")))
    return variables, coords


def config_entries(df: DataFrame, json_col: str, id_col: str) -> DataFrame:
    """explode a JSON object column into (id, key, value) rows."""
    return df.select(id_col, F.explode(F.from_json(json_col, "map<string, string>")).alias("key", "value"))
