"""M9: ice concentration onto the SST grid.

fill value -1 -> NULL (S7) -> keep the SST record's time span (P16) ->
nearest regrid on time/lat/lon (J5) -> percent to fraction, float32 (F3) ->
clip to [0, 1] keeping NULL (F2) -> optional partitioned write (K1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import columns as C
from ..operators.clean import overlap_slice, sentinel_to_null
from ..operators.grid import regrid_nearest
from ..sinks.writers import write_grid


def prepare_ice(ice: DataFrame, sst: DataFrame, var: str = "ice_concentration",
                out_path: str | None = None) -> DataFrame:
    cleaned = sentinel_to_null(ice, sentinel=C.ICE_LAND_VALUE, cols=[var])
    sliced = overlap_slice(cleaned, sst)
    regridded = regrid_nearest(sliced, sst, [var])
    out = regridded.withColumn(var, C.clip(C.rescale_cast(var, 100.0, "double")).cast("float"))
    if out_path:
        write_grid(out, out_path)
        return out.sparkSession.read.parquet(out_path).drop("year")
    return out
