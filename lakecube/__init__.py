"""lakecube: gridded environmental time series as Spark tables.

Modules (all functions take and return DataFrames):

- ``sources.catalog``      catalog -> loaders (year partitions, chunk stores, context fields)
- ``operators.clean``      fill values, selections, splits
- ``operators.climatology`` monthly climatology and anomalies
- ``operators.normalize``  fit/apply normalisers and the shared-span coordinate map
- ``operators.grid``       masking, nearest/bilinear regridding, block means, point sampling
- ``operators.quality``    date gaps, validation statistics, histograms, percentiles
- ``operators.sampling``   seeded exact sampling of cells and rows
- ``operators.tasks``      context/target task tables
- ``operators.kernel``     kernel prediction and gap filling
- ``operators.scoring``    errors, pooled and mask-weighted scores
- ``operators.placement``  acquisition surfaces and greedy sensor placement
- ``sinks.writers``        partitioned writes, climatology store, manifests
- ``plans``                preprocessing, ice preparation and evaluation jobs
- ``session``              session defaults, checkpoint folder, size-checked broadcast
"""

__version__ = "0.1.0"
