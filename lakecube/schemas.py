"""Table kinds as fixed schemas, and a validator used at load time.

A table of a kind must carry the kind's key columns with compatible types;
variables (value columns) are free.  ``validate`` raises ``ValueError`` with
the missing or mistyped columns instead of failing later inside a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_NUM = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_INT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIME = (T.DateType, T.TimestampType, T.TimestampNTZType)

# kind -> required key columns and the type families they accept
KINDS: dict[str, dict[str, tuple]] = {
    "grid": {"time": _TIME, "lat_idx": _INT, "lon_idx": _INT, "lat": _NUM, "lon": _NUM},
    "static": {"lat_idx": _INT, "lon_idx": _INT, "lat": _NUM, "lon": _NUM},
    "mask": {"lat_idx": _INT, "lon_idx": _INT, "lat": _NUM, "lon": _NUM, "mask": _NUM},
    "climatology": {"month": _INT, "lat_idx": _INT, "lon_idx": _INT},
    "obs": {"time": _TIME, "latitude": _NUM, "longitude": _NUM},
    "points": {"point_id": _INT, "lat_idx": _INT, "lon_idx": _INT, "lat": _NUM, "lon": _NUM},
    "task": {"task_time": (T.DateType,), "role": (T.StringType,), "set_idx": _INT, "var": (T.StringType,),
             "point_id": _INT, "x1": _NUM, "x2": _NUM, "value": _NUM},
    "pred": {"time": _TIME, "lat_idx": _INT, "lon_idx": _INT, "mean": _NUM, "std": _NUM},
    "norm_params": {"var": (T.StringType,), "method": (T.StringType,), "mean": _NUM, "std": _NUM,
                    "min": _NUM, "max": _NUM},
    "coord_params": {"axis": (T.StringType,), "name": (T.StringType,), "lo": _NUM, "hi": _NUM},
    "training_log": {"epoch": _INT, "batch": _INT, "loss": _NUM},
    "chunks": {"var": (T.StringType,), "shape": (T.ArrayType,), "payload": (T.ArrayType,)},
    "catalog": {"name": (T.StringType,), "path": (T.StringType,), "format": (T.StringType,)},
}

# Canonical Spark schemas of the key columns (what the library's own operators produce).
SCHEMAS: dict[str, T.StructType] = {
    "grid": T.StructType([T.StructField("time", T.DateType()), T.StructField("lat_idx", T.LongType()),
                          T.StructField("lon_idx", T.LongType()), T.StructField("lat", T.DoubleType()),
                          T.StructField("lon", T.DoubleType())]),
    "task": T.StructType([T.StructField("task_time", T.DateType()), T.StructField("role", T.StringType()),
                          T.StructField("set_idx", T.LongType()), T.StructField("var", T.StringType()),
                          T.StructField("point_id", T.LongType()), T.StructField("x1", T.DoubleType()),
                          T.StructField("x2", T.DoubleType()), T.StructField("value", T.DoubleType())]),
    "pred": T.StructType([T.StructField("time", T.DateType()), T.StructField("lat_idx", T.LongType()),
                          T.StructField("lon_idx", T.LongType()), T.StructField("mean", T.DoubleType()),
                          T.StructField("std", T.DoubleType())]),
}


def problems(df: DataFrame, kind: str) -> list[str]:
    """Missing or mistyped key columns of ``df`` for ``kind`` (empty when valid)."""
    if kind not in KINDS:
        raise ValueError(f"unknown table kind {kind!r}; one of {sorted(KINDS)}")
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for col, families in KINDS[kind].items():
        if col not in fields:
            out.append(f"missing column {col!r}")
        elif not isinstance(fields[col], families):
            out.append(f"column {col!r} has type {fields[col].simpleString()}")
    return out


def validate(df: DataFrame, kind: str) -> DataFrame:
    """Return ``df`` unchanged if it is a valid ``kind`` table, else raise ``ValueError``."""
    errs = problems(df, kind)
    if errs:
        raise ValueError(f"not a valid {kind} table: " + "; ".join(errs))
    return df
