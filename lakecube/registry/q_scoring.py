"""Queries: prediction scores, training-log curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fixture
from ..operators import scoring as S
from .base import query, rounded
from .q_climate import sst_grid

_J = ("j as (select p.time, p.lat_idx, p.lon_idx, p.mean, p.std, g.sst as truth from pred p join sst_grid g "
      "on g.time = p.time and g.lat_idx = p.lat_idx and g.lon_idx = p.lon_idx) ")
_S = "(case when std > 1e-6 then std else 1e-6 end)"
_NLL = (f"(0.5 * ln(2 * pi() * {_S} * {_S}) + 0.5 * (truth - mean) * (truth - mean) / ({_S} * {_S}))")


def scored(spark, sf_dir):
    pred = fixture(spark, sf_dir, "pred")
    return S.pred_vs_truth(pred, sst_grid(spark, sf_dir))


@query("pred_vs_truth",
       "with " + _J + "select time, lat_idx, lon_idx, round(mean, 6) as mean, round(std, 6) as std, truth from j",
       uses=("pred", "sst_grid"))
def q_pred_vs_truth(spark, sf_dir):
    return rounded(scored(spark, sf_dir), ["mean", "std"])


@query("pointwise_error",
       "with " + _J + "select time, lat_idx, lon_idx, round(mean - truth, 6) as error, "
       "round((mean - truth) * (mean - truth), 6) as sq_error, round(abs(mean - truth), 6) as abs_error from j",
       uses=("pred", "sst_grid"))
def q_pointwise_error(spark, sf_dir):
    p = S.pointwise(scored(spark, sf_dir)).select("time", "lat_idx", "lon_idx", "error", "sq_error", "abs_error")
    return rounded(p, ["error", "sq_error", "abs_error"])


@query("std_floor",
       "select time, lat_idx, lon_idx, round(case when std > 1e-6 then std else 1e-6 end, 9) as std_safe "
       "from pred", uses=("pred",))
def q_std_floor(spark, sf_dir):
    from ..functions import columns as C
    p = fixture(spark, sf_dir, "pred")
    return rounded(p.select("time", "lat_idx", "lon_idx", C.std_floor("std").alias("std_safe")), ["std_safe"], 9)


# Inputs rounded to 6 digits in both engines: both then evaluate the same numbers, std = 0 (floored) included.
# Terms of the floored std reach 1e12 and are compared to six significant places instead of six decimals.
_S6 = "(case when round(std, 6) > 1e-6 then round(std, 6) else 1e-6 end)"
_NLL6 = (f"(0.5 * ln(2 * pi() * {_S6} * {_S6}) + 0.5 * (truth - round(mean, 6)) * (truth - round(mean, 6)) "
         f"/ ({_S6} * {_S6}))")


def _big_sql(x):
    return f"case when abs({x}) < 1e6 then round({x}, 6) else round({x} / 1e6, 0) * 1e6 end"


def _big(c):
    return F.when(F.abs(c) < 1e6, F.round(c, 6)).otherwise(F.round(F.col(c) / 1e6, 0) * 1e6)


@query("gaussian_nll",
       "with " + _J + f", n as (select time, lat_idx, lon_idx, {_NLL6} as nll from j) "
       f"select time, lat_idx, lon_idx, {_big_sql('nll')} as nll from n", uses=("pred", "sst_grid"))
def q_gaussian_nll(spark, sf_dir):
    """F9 on every row, std = 0 included (floored to 1e-6)."""
    s = rounded(scored(spark, sf_dir), ["mean", "std"])
    return S.pointwise(s).select("time", "lat_idx", "lon_idx", _big("nll").alias("nll"))


@query("band",
       "select time, lat_idx, lon_idx, round(mean - 1e0 * std, 6) + 0e0 as lower, "
       "round(mean + 1e0 * std, 6) + 0e0 as upper "
       "from pred", uses=("pred",))
def q_band(spark, sf_dir):
    from ..functions import columns as C
    lo, hi = C.band("mean", "std")
    p = fixture(spark, sf_dir, "pred")
    return rounded(p.select("time", "lat_idx", "lon_idx", lo.alias("lower"), hi.alias("upper")), ["lower", "upper"])


_RMSE_SQL = ("with " + _J + "select round(sqrt(avg((mean - truth) * (mean - truth))), 6) as rmse, "
             "count(mean - truth) as n from j")


@query("pooled_rmse", _RMSE_SQL, uses=("pred", "sst_grid"))
def q_pooled_rmse(spark, sf_dir):
    return rounded(S.pooled_rmse(scored(spark, sf_dir)), ["rmse"])


@query("pool_errors", _RMSE_SQL, uses=("pred", "sst_grid"))
def q_pool_errors(spark, sf_dir):
    s = scored(spark, sf_dir)
    parts = [s.filter(F.month("time") <= 6), s.filter(F.month("time") > 6)]
    return rounded(S.pool_errors(parts), ["rmse"])


@query("weighted_scores",
       "with " + _J + ", w as (select lat_idx, lon_idx, mask / (select sum(mask) from lakemask) as w from lakemask), "
       f"k as (select j.time, j.truth, round(j.mean, 6) as mean, round(j.std, 6) as std, w.w, {_NLL6} as nll "
       "from j join w on w.lat_idx = j.lat_idx and w.lon_idx = j.lon_idx), "
       "t as (select sqrt(sum(w * ((mean - truth) * (mean - truth))) / "
       "sum(case when (mean - truth) * (mean - truth) is not null then w end)) as rmse, "
       "sum(w * std) / sum(case when std is not null then w end) as mean_std, "
       "sum(w * nll) / sum(case when nll is not null then w end) as nll from k) "
       f"select round(rmse, 6) as rmse, round(mean_std, 6) as mean_std, {_big_sql('nll')} as nll from t",
       uses=("pred", "sst_grid", "lakemask"))
def q_weighted_scores(spark, sf_dir):
    """A11 over every row: weighted RMSE, mean std and NLL, floored stds included."""
    mask = fixture(spark, sf_dir, "lakemask")
    s = rounded(scored(spark, sf_dir), ["mean", "std"])
    return rounded(S.weighted_scores(s, mask), ["rmse", "mean_std"]).withColumn("nll", _big("nll"))


@query("epoch_loss",
       "select epoch, round(avg(loss), 6) as loss, count(*) as n_batches from training_log group by 1",
       uses=("training_log",))
def q_epoch_loss(spark, sf_dir):
    return rounded(S.epoch_loss(fixture(spark, sf_dir, "training_log")), ["loss"])


@query("best_checkpoint",
       "with c as (select epoch, avg(loss) as val_rmse from training_log group by 1) "
       "select epoch, round(val_rmse, 6) as val_rmse from (select epoch, val_rmse, min(val_rmse) over "
       "(order by epoch rows between unbounded preceding and 1 preceding) as b from c) "
       "where b is null or val_rmse < b", uses=("training_log",))
def q_best_checkpoint(spark, sf_dir):
    curve = S.epoch_loss(fixture(spark, sf_dir, "training_log")).select(
        "epoch", F.col("loss").alias("val_rmse"))
    return rounded(S.best_checkpoint(curve), ["val_rmse"])


@query("apply_elementwise",
       "select time, lat_idx, lon_idx, case when sst is null then null when sst / 100e0 > 0.2e0 then 0 "
       "else 1 end::bigint as binary_ice_indicator from sst_grid", uses=("sst_grid",))
def q_apply_elementwise(spark, sf_dir):
    from ..functions.udf import apply_elementwise, ice_indicator_pandas
    ice = apply_elementwise(ice_indicator_pandas, "bigint")
    g = sst_grid(spark, sf_dir)
    return g.select("time", "lat_idx", "lon_idx", ice(F.col("sst") / 100.0).alias("binary_ice_indicator"))


@query("score_partitions",
       "with " + _J + "select time, round(sqrt(avg((mean - truth) * (mean - truth))), 6) as rmse, "
       "count(mean - truth) as n from j group by time", uses=("pred", "sst_grid"))
def q_score_partitions(spark, sf_dir):
    from ..functions.udf import rmse_per_task, score_partitions
    s = scored(spark, sf_dir).select("time", "mean", "truth")
    out = score_partitions(s, "time", rmse_per_task, "time date, rmse double, n long")
    return rounded(out, ["rmse"])


@query("gaussian_nll_all",
       "with " + _J + f", n as (select time, lat_idx, lon_idx, {_NLL6} as nll from j) "
       "select time, lat_idx, lon_idx, case when abs(nll) < 1e6 then round(nll, 6) else nll end as nll from n",
       uses=("pred", "sst_grid"))
def q_gaussian_nll_all(spark, sf_dir):
    """F9 on every row, std = 0 included (floored to 1e-6).  Inputs are the
    prediction rounded to 6 digits so both engines evaluate the same numbers;
    results are rounded to 6 decimals below 1e6 and compared as computed above
    (those come from the std floor and are exact in both engines)."""
    s = rounded(scored(spark, sf_dir), ["mean", "std"])
    nll = S.pointwise(s).select("time", "lat_idx", "lon_idx", "nll")
    return nll.withColumn("nll", F.when(F.abs("nll") < 1e6, F.round("nll", 6)).otherwise(F.col("nll")))


@query("weighted_scores_all",
       "with " + _J + ", w as (select lat_idx, lon_idx, mask / (select sum(mask) from lakemask) as w from lakemask), "
       "k as (select j.*, w.w from j join w on w.lat_idx = j.lat_idx and w.lon_idx = j.lon_idx) "
       "select round(sqrt(sum(w * ((mean - truth) * (mean - truth))) / "
       "sum(case when (mean - truth) * (mean - truth) is not null then w end)), 6) as rmse, "
       "round(sum(w * std) / sum(case when std is not null then w end), 6) as mean_std from k",
       uses=("pred", "sst_grid", "lakemask"))
def q_weighted_scores_all(spark, sf_dir):
    """A11 over every row (std = 0 included): weighted RMSE and mean std.  The
    weighted NLL of these rows is dominated by floored-std terms near 1e12 and
    is compared in ``gaussian_nll_all`` row by row instead."""
    mask = fixture(spark, sf_dir, "lakemask")
    return rounded(S.weighted_scores(scored(spark, sf_dir), mask).drop("nll"), ["rmse", "mean_std"])
