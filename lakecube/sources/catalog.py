"""Catalog-driven loading.

A catalog is a JSON document ``{"datasets": {name: {path, format, variables,
time_range, ...}}, "metadata": {...}}``.  It is read with Spark into one row
per dataset; loading dispatches on ``format`` to a Spark reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import store_path
from ..operators.clean import FILL_VALUE, rename_vars, sentinel_to_null

CATALOG_SCHEMA = ("datasets map<string, struct<description: string, path: string, format: string, "
                  "consolidated: boolean, variables: array<string>, time_range: struct<start: string, end: string>>>")

# Readers for the formats a catalog may name.  "zarr"/"netcdf" stores are
# expected to have been converted to one of these (chunk tables: see grid_store).
READERS = {"parquet": "parquet", "csv": "csv", "json": "json", "orc": "orc", "chunks": "parquet"}


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row per dataset: name, description, path, format, variables, time_start, time_end."""
    doc = spark.read.text(path, wholetext=True)
    entries = doc.select(F.explode(F.from_json("value", CATALOG_SCHEMA)["datasets"]).alias("name", "d"))
    return entries.select("name", "d.description", "d.path", "d.format", "d.variables",
                          F.col("d.time_range.start").alias("time_start"),
                          F.col("d.time_range.end").alias("time_end"))


def catalog_lookup(catalog: DataFrame, name: str) -> DataFrame:
    """The catalog row of ``name``; ``ValueError`` when unknown."""
    row = catalog.filter(F.col("name") == name)
    if row.limit(1).count() == 0:
        raise ValueError(f"the catalog has no dataset {name!r}")
    return row


def load_dataset(spark: SparkSession, catalog: DataFrame, name: str, year: int | None = None,
                 schema=None, sentinel: float | None = FILL_VALUE, rename: dict | None = None,
                 kind: str | None = None) -> DataFrame:
    """Load a catalog dataset with the reader for its format.

    With ``year`` the dataset is a year-partitioned store and only that year's
    partition is read (``year=`` partition filter, pruned by Spark).  The fill
    value (``sentinel``; None keeps it) is turned into NULL on every value column.  A chunk
    store with ``lat`` and ``lon`` axis arrays comes back as a grid with its labels,
    one column per variable; without them its rows stay flat.  With
    ``kind`` (e.g. "grid", "mask") the result is validated against that table
    kind's key columns (``schemas.validate``), a schema-only check.
    """
    entry = catalog_lookup(catalog, name).select("path", "format").first()
    fmt = entry["format"]
    if fmt not in READERS:
        raise ValueError(f"dataset {name!r} has format {fmt!r}, which no reader is registered for")
    reader = spark.read.format(READERS[fmt])
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(entry["path"])
    if year is not None:
        df = df.filter(F.col("year") == F.lit(year))
    if fmt == "chunks":
        # array store held as chunk rows: flatten, then dates by position when
        # the store has no time axis of its own
        from .grid_store import flatten_chunks, labelled_grid, positional_time
        names = [r["var"] for r in df.select("var").distinct().collect()]        # variable names: a handful
        keep = [c for c in ("year",) if c in df.columns]
        if not keep and df.filter(F.size("shape") == 3).limit(1).count() > 0:
            raise ValueError(f"Dataset '{name}' has (time, lat, lon) arrays but neither a time axis nor a year.")
        df = flatten_chunks(df, keep=keep)
        if keep:
            df = positional_time(df)
        if {"lat", "lon"} <= set(names):
            df = labelled_grid(df, names)
    if sentinel is not None:
        df = sentinel_to_null(df, sentinel)
    if rename:
        df = rename_vars(df, rename)
    if kind is not None:
        from ..schemas import validate
        df = validate(df, kind)
    return df


def load_years(spark: SparkSession, catalog: DataFrame, name: str, years: Sequence[int] | None = None,
               sentinel: float | None = FILL_VALUE) -> DataFrame:
    """One scan of the year-partitioned store for the requested years (all when None)."""
    df = load_dataset(spark, catalog, name, sentinel=sentinel)
    return df if years is None else df.filter(F.col("year").isin(list(years)))


def store_paths(catalog: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """per-year store paths ``{path}/{NAME}_{year}.zarr`` for every dataset."""
    years = F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("year")
    return (catalog.select("name", "path", years)
            .select("name", "year", store_path("path", "name", "year").alias("store")))


# Fixed value: the variable name an unnamed array gets when stored from the array library.
UNNAMED = "__xarray_dataarray_variable__"


def load_context(spark: SparkSession, catalog: DataFrame) -> dict[str, DataFrame]:
    """Static context fields present in the catalog (bathymetry, lakemask).

    An unnamed bathymetry variable is renamed to ``bathymetry``.
    """
    names = {r["name"] for r in catalog.select("name").collect()}  # catalog: a handful of rows
    out = {}
    if "bathymetry" in names:
        out["bathymetry"] = rename_vars(load_dataset(spark, catalog, "bathymetry"), {UNNAMED: "bathymetry"})
    if "lakemask" in names:
        out["lakemask"] = load_dataset(spark, catalog, "lakemask")
    return out


def scan_lazy(spark: SparkSession, path: str, schema: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Lazy scan with an explicit schema (no inference pass) and column pruning."""
    df = spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns else df


def scan_obs(spark: SparkSession, path: str) -> DataFrame:
    """Point observations with their declared schema."""
    return spark.read.schema("obs bigint, time timestamp_ntz, latitude double, longitude double, "
                             "temperature_k double").parquet(path)


def scan_static(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    """Static grids stored as rows with a ``region`` column (one per lake mask)."""
    df = spark.read.parquet(path)
    return df if region is None else df.filter(F.col("region") == region)
