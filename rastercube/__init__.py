"""rastercube: raster time-series analytics as Spark DataFrame operators.

Observations are one row per valid pixel per acquisition date
``(date, row, col, red, nir, ndvi)``.  Every operator is a
``DataFrame -> DataFrame`` function built from Spark SQL built-ins so that
Catalyst can prune, push down and plan the work; nothing is collected to the
driver except bounded dimension tables whose size is checked first.

Sub-packages
------------
functions   Column expressions (guarded ratio, UTM projection, path mapping)
operators   Band maths, statistics, exact distributed percentiles, zones,
            grid / cube, acquisition catalogue
sources     Manifest, archive listing, tile data source, Parquet store,
            mapping views over the driver's test tables
plans       The end-to-end job and the registered queries
streaming   (none: the reference has no streaming work)
"""

from rastercube.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
