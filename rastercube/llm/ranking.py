"""Dense positions of rows in their groups' order, without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastercube.llm.common import checked, settle, shuffle_partitions


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``: the place from 0 among the rows of the same ``group``, by ``order``.

    The rows are dealt out by ranges of (group, order), so a hot group is many
    tasks' work, and written sorted; a row's place in its file and the number
    of the group's rows in the files before make its rank.  Ties in all of
    ``order`` come in any order.  ``group`` must not be null.  ``rows`` is read
    twice (ranges are sampled first): settle it if it is dear.
    """
    place, part = "_place", "_part"
    laid = settle(rows.repartitionByRange(shuffle_partitions(rows), group, *order)
                  .sortWithinPartitions(group, *order).withColumn(place, F.monotonically_increasing_id()))
    # the upper bits of such an id number the partition, the lower ones the row in it
    laid = laid.withColumn(part, F.shiftright(place, 33))
    runs = laid.groupBy(group, part).agg(F.min(place).alias("_first"), F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    runs = settle(runs.select(group, part, "_first", F.coalesce(before, F.lit(0)).alias("_before")))
    rank = (F.col(place) - F.col("_first") + F.col("_before")).alias("rank")
    return laid.join(checked(runs), [group, part]).select(*rows.columns, rank)
