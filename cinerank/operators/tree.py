"""Sums of whole vectors, one per task, added up level by level."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tree_sum(parts: DataFrame, n_parts: int, fan_in: int = 16) -> DataFrame:
    """``parts`` (_id long, v array<double> or array<long>, all of one length) added up: one row (_id = 0, v), none for no rows.

    The ids are distinct and below ``n_parts``. Each level adds groups of ``fan_in`` vectors, in the order of their ids, so the sum
    is the same in every run; a task holds ``fan_in`` vectors, and a level moves each vector once:
    n + n / fan_in + ... vectors are shuffled, and log(n) levels follow each other.
    """
    kind = parts.schema["v"].dataType.simpleString()

    def add(group: pa.Table) -> pa.Table:
        ids = group["_id"].to_numpy()
        flat = group["v"].combine_chunks()
        rows = (pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat).flatten().to_numpy(zero_copy_only=False)
        total = np.add.reduce(rows.reshape(len(ids), -1)[np.argsort(ids)], axis=0)
        return pa.table({"_id": pa.array([int(ids[0]) // fan_in], pa.int64()), "v": pa.array([total], group.schema.field("v").type)})

    parts = parts.select(F.col("_id").cast("long").alias("_id"), "v")
    while n_parts > 1:
        parts = parts.groupBy(F.floor(F.col("_id") / fan_in).alias("_g")).applyInArrow(add, f"_id long, v {kind}")
        n_parts = -(-n_parts // fan_in)
    return parts
