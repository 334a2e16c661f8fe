"""Numbers and running totals in an order, by range partitions rather than one task for each group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..plans.scratch import materialize


def running_total(df: DataFrame, by: list[str], order: list[str], value: Column | None = None, into: str = "n") -> DataFrame:
    """``df`` with the sum of ``value`` (a long; 1 unless given, so a number from 1) over the rows of its group up to each, in ``order``.

    Rows are dealt out by ranges of group and order, sorted, and summed up within each range; what a group's earlier
    ranges hold is added afterwards.  So a group of any size is spread over tasks, small groups share them, and
    the driver sees nothing.  The rows are written once, as ranges that are drawn anew could differ.  ``order`` should
    tell rows apart; nulls come first.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = df.withColumns({"_group": F.xxhash64(*by) if by else F.lit(0).cast("long"), "_value": F.lit(1).cast("long") if value is None else value.cast("long")})
    dealt = own.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order)
    place = [dealt.columns.index(c) for c in ("_group", "_value")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, values = (batch.column(k).to_numpy() for k in place)
            first = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1 if group is None else group))
            sums = np.cumsum(values)
            before = np.zeros(len(values), np.int64)
            if len(first):
                before[first] = np.diff(np.concatenate([[0], (sums - values)[first]]))
                before = np.cumsum(before)
            # the group that was open goes on up to the first new one
            sums = sums - before
            sums[: first[0] if len(first) else len(sums)] += total
            group, total = groups[-1], int(sums[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums), pa.array(np.full(len(sums), part, np.int32))], names=[*batch.schema.names, into, "_part"])

    schema = T.StructType([*dealt.schema.fields, T.StructField(into, T.LongType()), T.StructField("_part", T.IntegerType())])
    summed = materialize(dealt.mapInArrow(run, schema), "ranges")
    held = summed.groupBy("_group", "_part").agg(F.sum("_value").alias("_held"))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("_group", "_part", F.sum("_held").over(earlier).alias("_before"))
    # only the group that a range begins with can have earlier rows: no more rows than ranges
    held = F.broadcast(held.where("_before IS NOT NULL"))
    return summed.join(held, ["_group", "_part"], "left").withColumn(into, F.col(into) + F.coalesce("_before", F.lit(0))).select(*df.columns, into)


def numbered(df: DataFrame, by: list[str], order: list[str], into: str = "n") -> DataFrame:
    """``df`` with the number of each row in its group, from 1."""
    return running_total(df, by, order, None, into)
