"""Running totals over any order, spread over tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from kinmart.workspace import stage


def with_total_before(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over earlier rows of the group.

    Rows are range-partitioned by group and order, so a group that fills a third of the table
    lies in many tasks. Each task sums its own stretch; what lies before it is carried in from
    one subtotal for each task and group, and no task sees more than these. ``group`` and
    ``value`` must not be null, and ``order`` must tell rows of a group apart.
    """
    schema = StructType(
        [*df.schema.fields, StructField("part", IntegerType()), StructField("local", LongType())]
    )

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, carry = None, 0
        for batch in batches:
            if not len(batch):
                continue
            keys, values = batch[group], batch[value]
            local = values.groupby(keys, sort=False).cumsum() - values
            if last is not None:
                local += carry * (keys == last)
            batch["local"] = local
            carry = int(local.iloc[-1] + values.iloc[-1])
            last = keys.iloc[-1]
            yield batch[schema.names]

    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    numbered = ranged.withColumn("part", F.spark_partition_id())
    staged = stage(numbered.mapInPandas(sums, schema), "running")
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        staged.groupBy(group, "part")
        .agg(F.sum(value).alias("subtotal"))
        .withColumn("carried", F.coalesce(F.sum("subtotal").over(earlier), F.lit(0)))
        .drop("subtotal")
    )
    joined = staged.join(carried, [group, "part"])
    before = (F.col("local") + F.col("carried")).cast("long")
    return joined.select(*df.columns, before.alias("before"))
