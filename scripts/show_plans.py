"""Print the physical plans of the headline operators over the observation store.

    python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from rastercube.operators import grid, zones  # noqa: E402
from rastercube.operators.quantile import bucket_key  # noqa: E402
from rastercube.session import build_session  # noqa: E402
from rastercube.sources import store  # noqa: E402
from rastercube.sources import testdata as td  # noqa: E402


def show(title, df):
    print(f"\n===== {title} =====")
    print(df._jdf.queryExecution().executedPlan().toString())


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"})
    path = tempfile.mkdtemp(prefix="rastercube-plans-")
    store.write_observations(td.obs(spark, sf_dir), path)
    o = store.read_observations(spark, path)
    boxes = td.test_boxes(spark)
    hist = o.select("date", F.col("ndvi").cast("double").alias("_v")).groupBy("date", bucket_key(F.col("_v")).alias("_b")).agg(
        F.count("_v"), F.sum("_v"), F.min("_v"), F.max("_v"))
    show("exact percentiles, pass 1 (histogram + moments)", hist)
    show("zone membership, inline", zones.assign_zones(o.select("date", "row", "col", "ndvi"), boxes, "inline"))
    show("zone membership, cells", zones.assign_zones(o.select("date", "row", "col", "ndvi"), boxes, "cells", cell=250))
    show("box filter on one date", zones.bbox_filter(o.filter(F.col("date") == "1996-03"), 0, 300, 0, 300))
    show("dense cube", grid.dense_cube(grid.block_means(o, 20)))
    show("cube series", grid.series_from_means(grid.block_means(o, 20)))
    spark.stop()


if __name__ == "__main__":
    main()
