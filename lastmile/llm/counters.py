"""Dense counters over a whole corpus, added up as compressed parts.

Every task counts in one numpy array of fixed size and hands on the parts of it
that are not zero; parts are added in as many steps as the number of tasks needs,
so no group holds more than ``FAN_IN`` of them. The driver gets one row a part."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm.common import frozen

PART = 1 << 14
#: Parts that one group adds.
FAN_IN = 64
SCHEMA = "part int, counts binary"


def parts_of(counts: np.ndarray) -> pa.RecordBatch:
    """The parts of a task's counts (unsigned 32-bit) that are not zero."""
    rows = [(k, zlib.compress(counts[at : at + PART].tobytes(), 1)) for k, at in enumerate(range(0, len(counts), PART)) if counts[at : at + PART].any()]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["part", "counts"])


def _adder(kind):
    """Sums the parts of a group, whose numbers are of ``kind``, as 64-bit numbers."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(x), kind).astype(np.uint64) for x in frame["counts"])
        return pd.DataFrame({"part": frame["part"].iloc[:1], "of": frame["of"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    return add


def total(counted: DataFrame, size: int) -> np.ndarray:
    """Sum of what the tasks of ``counted`` (``SCHEMA``) have counted, 64-bit numbers."""
    kind, now = np.uint32, counted.withColumn("of", F.spark_partition_id())
    while True:
        dealt = now.withColumn("of", F.floor(F.col("of") / FAN_IN).cast("int"))
        now = frozen(dealt.groupBy("part", "of").applyInPandas(_adder(kind), f"of int, {SCHEMA}"))
        kind = np.uint64
        if now.where("of > 0").isEmpty():
            break
    out = np.zeros(size, np.uint64)
    for row in now.collect():
        part = np.frombuffer(zlib.decompress(row["counts"]), np.uint64)
        out[row["part"] * PART : row["part"] * PART + len(part)] = part
    return out
