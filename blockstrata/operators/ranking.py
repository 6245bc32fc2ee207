"""Global numbering without a single-task sort."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..session import cut_lineage


def global_row_number(df: DataFrame, order, name="id") -> DataFrame:
    """Dense number 0.. in the order of the given columns.

    Rows are range-partitioned, numbered inside each partition, and shifted by
    the row counts of the partitions before. Only one row per partition, never
    the data, meets in one task.
    """
    ranged = cut_lineage(df.repartitionByRange(*order)
                         .withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
              .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy("_part").orderBy(*order)
    # one row per partition: the size of this side is the partition count
    return (ranged.withColumn("_row", F.row_number().over(inside))
            .join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + F.col("_row") - 1)
            .drop("_part", "_row", "_start"))


def _changes(column, before):
    """Places of a column whose value is not that of the row before (of the
    batches before, if it is the first), and its last value."""
    coded = column.dictionary_encode(null_encoding="encode")
    ids, known = np.asarray(coded.indices), coded.dictionary
    new = np.ones(len(ids), bool)
    new[1:] = ids[1:] != ids[:-1]
    new[0] = before != [known[int(ids[0])].as_py()]
    return new, [known[int(ids[-1])].as_py()]


def _numbered(batches, group, value):
    """Sorted rows of a partition with their number in the group (_row), and if
    their ``value`` is not that of the row before in the group (_new)."""
    in_group = in_value = None
    held = 0  # rows of the last group so far
    for batch in batches:
        if not batch.num_rows:
            continue
        starts, in_group = _changes(batch.column(group), in_group)
        new, in_value = _changes(batch.column(value), in_value)
        at = np.arange(batch.num_rows)
        begun = np.maximum.accumulate(np.where(starts, at, -1))
        rows = np.where(begun >= 0, at - begun, at + held)
        held = int(rows[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows), pa.array(new | starts)],
                                         names=[*batch.schema.names, "_row", "_new"])


def number_in_groups(df: DataFrame, group, order, name="id", first=None) -> DataFrame:
    """Dense number 0.. of each row within its group, in the given order.

    Rows are range-partitioned by group and order into a stated number of parts
    and numbered inside each; a group that spans parts goes on where the parts
    before ended, so a group of any size is spread over tasks. Only the first
    group of a part may have begun before it, so only one row per part, never
    the groups, is joined. ``first`` names a flag of the rows whose first order
    column has a new value in the group. Rows without a group are left out."""
    df = cut_lineage(df.filter(F.col(group).isNotNull()))  # dealing reads its input twice
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order).withColumn("_part", F.spark_partition_id())
    schema, value = StructType(dealt.schema.fields + [StructField("_row", LongType()), StructField("_new", BooleanType())]), order[0]
    ranged = cut_lineage(dealt.mapInArrow(lambda batches: _numbered(batches, group, value), schema))
    ends = ranged.groupBy("_part").agg(F.min(group).alias("_first"), F.max(F.struct(group, (F.col("_row") + 1).alias("_n"))).alias("_end"),
                                       F.max_by(value, F.struct(group, "_row")).alias("_top"))
    # the last group of each part with its rows and value; the first one, where it is another, only asks
    last, asks = F.struct(F.col(f"_end.{group}").alias(group), "_end._n", "_top"), \
        F.struct(F.col("_first").alias(group), F.lit(0).cast("bigint").alias("_n"), F.lit(None).cast(df.schema[value].dataType).alias("_top"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ends.select("_part", "_first", F.inline(F.when(F.col("_first") == F.col(f"_end.{group}"), F.array(last)).otherwise(F.array(asks, last))))
              .withColumn("_start", F.sum("_n").over(before)).withColumn("_held", F.max("_top").over(before))
              .filter((F.col(group) == F.col("_first")) & F.col("_start").isNotNull()).select("_part", group, "_start", "_held"))
    # one row per part at most: the size of this side is the part count
    out = ranged.join(F.broadcast(starts), ["_part", group], "left").withColumn(name, F.coalesce("_start", F.lit(0)) + F.col("_row"))
    if first:
        goes_on = (F.col("_row") == 0) & F.col("_start").isNotNull()
        out = out.withColumn(first, F.when(goes_on, ~F.col("_held").eqNullSafe(F.col(value))).otherwise(F.col("_new")))
    return out.select(*df.columns, name, *([first] if first else []))


def top_per_group(df: DataFrame, group, order, n: int) -> DataFrame:
    """First n rows of each group; Spark prunes each partition before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def sorted_counts(df: DataFrame, value) -> DataFrame:
    """Distinct values with their count ``k``, the place ``start`` of their
    first row in value order, and the row count ``total``. Equal values are
    counted before the shuffle, so a common value makes no hot partition."""
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("k"))
    ranged = cut_lineage(counted.repartitionByRange(value).withColumn("_part", F.spark_partition_id()))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (ranged.groupBy("_part").agg(F.sum("k").alias("_n"))
             .select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_first"),
                     F.sum("_n").over(Window.partitionBy()).alias("total")))
    inside = Window.partitionBy("_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the size of this side is the partition count
    return (ranged.withColumn("_before", F.coalesce(F.sum("k").over(inside), F.lit(0)))
            .join(F.broadcast(parts), "_part")
            .select(value, "k", (F.col("_first") + F.col("_before")).alias("start"), "total"))


def percentile_of(value, q):
    """Linear percentile as an aggregate over sorted_counts rows. Only the rows
    around the position add to it, so no task holds the whole column."""
    at = (F.col("total") - 1) * F.lit(float(q))
    low = F.floor(at)
    part = at - low

    def holds(place):
        return (F.col("start") <= place) & (place < F.col("start") + F.col("k"))

    return F.sum(F.when(holds(low), F.col(value) * (1.0 - part)).otherwise(0.0)
                 + F.when(holds(low + 1), F.col(value) * part).otherwise(0.0))


def weighted_mean(value):
    """Mean over sorted_counts rows."""
    return F.sum(F.col(value) * F.col("k")) / F.sum("k")
