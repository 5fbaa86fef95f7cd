"""Running sums along an order inside groups of any size.

A window over a whole group puts it in one task. Here the order, a long, is cut into chunks of 2**bits neighbours; sums of
chunks, and of chunks of chunks, are carried in, so the largest window holds 2**bits rows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 12


def running_sum(df: DataFrame, group: list[str], order: str, value: Column, out: str, bits: int = BITS) -> DataFrame:
    """``df`` + ``out``: sum of ``value`` over the group's rows up to and with this one. ``order`` is unique in a group."""
    base = df.withColumn("_v", value.cast("long")).withColumn("_c1", F.shiftright(order, bits)).withColumn("_c2", F.shiftright(order, 2 * bits))
    one = base.groupBy(*group, "_c2", "_c1").agg(F.sum("_v").alias("_v"))
    two = one.groupBy(*group, "_c2").agg(F.sum("_v").alias("_v"))
    upto = lambda keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    two = two.withColumn("_b2", F.coalesce(F.sum("_v").over(upto(group, "_c2")), F.lit(0))).drop("_v")
    one = one.withColumn("_b1", F.coalesce(F.sum("_v").over(upto([*group, "_c2"], "_c1")), F.lit(0))).drop("_v")
    equal = lambda names: [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names, strict=True)]
    g2 = [f"_h{i}" for i in range(len(group))]
    two = two.select(*[F.col(g).alias(n) for g, n in zip(group, g2, strict=True)], F.col("_c2").alias("_k2"), "_b2")
    one = one.join(two, reduce(and_, equal(g2), F.col("_c2") == F.col("_k2")))
    # the group as one struct, in which nulls are equal: window and join then share one shuffle of the rows
    whole = F.struct(*group, F.lit(0).alias("_"))
    carried = one.select(whole.alias("_g1"), F.col("_c1").alias("_k1"), (F.col("_b1") + F.col("_b2")).alias("_before"))
    base = base.withColumn("_g", whole)
    inside = Window.partitionBy("_g", "_c1").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    base = base.withColumn("_own", F.sum("_v").over(inside))
    joined = base.join(carried, (F.col("_g") == F.col("_g1")) & (F.col("_c1") == F.col("_k1")))
    return joined.withColumn(out, F.col("_own") + F.col("_before")).select(*df.columns, out)


def numbered(df: DataFrame, group: list[str], order: str, out: str) -> DataFrame:
    """``df`` + ``out``: 1, 2, 3 ... along ``order`` in each group."""
    return running_sum(df, group, order, F.lit(1), out)
