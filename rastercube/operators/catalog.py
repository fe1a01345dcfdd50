"""Acquisition catalogue: predicates, cloud cover, per-month choice, selection.

A catalogue is a table of products.  The nested form follows the product
search service (``Id, Name, Collection, ContentDate.Start, Attributes,
Footprint``); ``flatten`` turns it into ``(id, name, start, month, cloud)``
on which the selection operators work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Calendar months tried in order, acquisitions wanted, and
# the cloud cover used when it is unknown or its value is missing.
TARGET_MONTHS = [1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
N_ACQUISITIONS = 8
CLOUD_UNKNOWN = 50.0
CLOUD_MISSING_VALUE = 100.0


def cloud_cover(attrs: str | Column = "Attributes") -> Column:
    """First ``cloudCover`` attribute as DOUBLE; missing value -> 100;
    no such attribute (or no attributes) -> 50."""
    a = F.col(attrs) if isinstance(attrs, str) else attrs
    hits = F.filter(a, lambda x: x["Name"] == "cloudCover")
    first = F.try_element_at(hits, F.lit(1))
    return (
        F.when(first.isNull(), F.lit(CLOUD_UNKNOWN))
        .otherwise(F.coalesce(first["Value"].cast("double"), F.lit(CLOUD_MISSING_VALUE)))
    )


def has_attribute(name: str, value: str, attrs: str = "Attributes") -> Column:
    return F.coalesce(F.exists(F.col(attrs), lambda x: (x["Name"] == name) & (x["Value"] == value)), F.lit(False))


def catalog_filter(
    products: DataFrame,
    collection: str | None = "SENTINEL-2",
    start_after: str | None = None,
    start_before: str | None = None,
    product_type: str | None = "S2MSI2A",
    name_contains: str | None = None,
    max_cloud: float | None = None,
    start: str = "start",
) -> DataFrame:
    """Search predicates: collection equality, start strictly between two
    instants, attribute ``productType`` equality, name contains a tile id,
    optional maximum cloud cover (strictly below)."""
    cond = F.lit(True)
    if collection is not None:
        cond = cond & (F.col("Collection") == collection)
    if start_after is not None:
        cond = cond & (F.col(start) > F.lit(start_after).cast("timestamp"))
    if start_before is not None:
        cond = cond & (F.col(start) < F.lit(start_before).cast("timestamp"))
    if product_type is not None:
        cond = cond & has_attribute("productType", product_type)
    if name_contains is not None:
        cond = cond & F.col("Name").contains(name_contains)
    if max_cloud is not None:
        cond = cond & (cloud_cover() < max_cloud)
    return products.filter(cond)


def footprint_contains(lon: float | Column, lat: float | Column, footprint: str = "Footprint") -> Column:
    """Point-in-polygon by ray casting over ``ARRAY<STRUCT<x,y>>`` (ring,
    first vertex not repeated), with a bounding-box pre-test."""
    px = lon if isinstance(lon, Column) else F.lit(float(lon))
    py = lat if isinstance(lat, Column) else F.lit(float(lat))
    fp = F.col(footprint)
    n = F.size(fp)

    def crosses(i):
        a = fp[i]
        b = fp[F.when(i == 0, n - 1).otherwise(i - 1)]
        straddles = (a["y"] > py) != (b["y"] > py)
        x_at = (b["x"] - a["x"]) * (py - a["y"]) / F.when(straddles, b["y"] - a["y"]) + a["x"]
        return straddles & (px < x_at)

    n_cross = F.size(F.filter(F.sequence(F.lit(0), n - 1), crosses))
    xs = F.transform(fp, lambda p: p["x"])
    ys = F.transform(fp, lambda p: p["y"])
    in_bbox = (
        (px >= F.array_min(xs)) & (px <= F.array_max(xs)) & (py >= F.array_min(ys)) & (py <= F.array_max(ys))
    )
    return F.when(n >= 3, in_bbox & (n_cross % 2 == 1)).otherwise(F.lit(False))


def iso_month(iso: str | Column) -> Column:
    """Calendar month as written in an ISO-8601 timestamp string (the local
    fields of the string, whatever its offset and the session time zone)."""
    c = F.col(iso) if isinstance(iso, str) else iso
    return F.substring(c, 6, 2).cast("int")


def flatten(products: DataFrame) -> DataFrame:
    """Nested products -> ``(id, name, start, month, day, cloud)``."""
    start = F.to_timestamp(F.col("ContentDate.Start"))
    return products.select(
        F.col("Id").alias("id"),
        F.col("Name").alias("name"),
        start.alias("start"),
        iso_month("ContentDate.Start").alias("month"),
        F.substring(F.col("ContentDate.Start"), 1, 10).alias("day"),
        cloud_cover().alias("cloud"),
    )


def date_parts(df: DataFrame, start_iso: str = "start_iso") -> DataFrame:
    """ISO day prefix, month number and ``MM-DD`` label of an ISO timestamp string."""
    day = F.substring(F.col(start_iso), 1, 10)
    return df.withColumn("day", day).withColumn("month", iso_month(start_iso)).withColumn(
        "mmdd", F.substring(day, 6, 5)
    )


def by_month(cat: DataFrame) -> DataFrame:
    """Products grouped by calendar month number (year ignored)."""
    return cat.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_products"),
        F.min("cloud").alias("min_cloud"),
        F.min("start").alias("first_start"),
    )


def month_best(cat: DataFrame) -> DataFrame:
    """Lowest-cloud product per month; ties -> earliest start, then id."""
    order = F.struct("cloud", "start", "id")
    best = cat.groupBy("month").agg(F.min_by(F.struct(*cat.columns), order).alias("b"))
    return best.select("b.*")


def select_acquisitions(cat: DataFrame, n: int = N_ACQUISITIONS, months: list[int] | None = None) -> DataFrame:
    """Pick ``n`` acquisitions: each target month's best in month order until
    ``n``; if short, fill with the lowest-cloud leftovers (ties by start, id);
    result sorted by start.

    Only the per-month winners (at most 12 rows) and the ``n`` best leftovers
    (a top-k, planned as a per-partition take-ordered) ever leave the
    executors.
    """
    months = months or TARGET_MONTHS
    order_arr = F.array(*[F.lit(m) for m in months])
    best = month_best(cat).withColumn("_p", F.array_position(order_arr, F.col("month")))
    chosen = best.filter(F.col("_p") > 0).orderBy("_p").limit(n).drop("_p")
    # at most one product a month: kept as literal rows, so the catalogue is not read again for them
    winners = chosen.collect()
    chosen, k = cat.sparkSession.createDataFrame(winners, chosen.schema), len(winners)
    picked = chosen
    if k < n:
        rest = cat.join(chosen.select("id"), "id", "left_anti")
        fill = rest.orderBy("cloud", "start", "id").limit(n - k)
        picked = chosen.unionByName(fill.select(*chosen.columns))
    return picked.orderBy("start", "id")


def manifest_rows(selected: DataFrame, path_prefix: str) -> DataFrame:
    """Manifest entries for selected products: id, name, date, cloud_cover, path."""
    return selected.select(
        F.col("id").cast("string").alias("id"),
        F.col("name"),
        F.col("day").alias("date"),
        F.col("cloud").alias("cloud_cover"),
        F.concat(F.lit(path_prefix), F.col("name"), F.lit(".zip")).alias("path"),
    )
