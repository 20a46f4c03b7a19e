"""Numbers of rows in an order over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireloom.llm.storage import stored


def numbered(rows: DataFrame, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Some columns with ``place``, the number of the row (from 0) in an order that has no ties.

    Rows are range-partitioned and sorted; each part numbers its own, and adds the sizes of the parts before it.
    """
    told = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)

    def number(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = count + np.arange(batch.num_rows)
            count += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places), pa.array(np.full(batch.num_rows, part, np.int32))], [*batch.schema.names, "place", "part"])

    schema = T.StructType([*told.schema, T.StructField("place", T.LongType()), T.StructField("part", T.IntegerType())])
    own = stored(told.mapInArrow(number, schema), "numbered")
    sizes = own.groupBy("part").agg(F.count("*").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    before = sizes.select(F.col("part").alias("_part"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_before"))
    return own.join(before, F.col("part") == F.col("_part")).select(*columns, (F.col("place") + F.col("_before")).alias("place"))
