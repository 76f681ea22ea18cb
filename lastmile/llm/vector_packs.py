"""Integer vectors in packs, and the meeting of stated queries with all packs.

A pack is up to ``ROWS`` rows of one width as a single row of bytes: ids, labels
and a matrix of 32-bit integers. Every scan task packs the rows it reads, so no
shuffle deals the table and no key can be hot; the packs are a table in the
shared folder. Packs fall into shards of a few packs, queries into blocks of at
most ``QUERIES``, and every (shard, block) is one group: a group is bounded on
both sides, whatever the size of the table or of the query set.

Defined results: rows without an id, and vectors that are null, empty or hold
null or non-finite components take no part; nor do those whose integer length
is 2^31 or more, where a score may not fit a long. Vectors of different widths
have no score. A row repeated in full is as many candidates; queries repeated in
full are asked once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm.common import frozen, scratch, trimmed

ROWS = 4096
QUERIES = 4096
#: Packs of a shard, and packs that a task sorts by length together.
SHARD, CHUNK = 16, 16
#: Rows that give every query its first lower bound.
SEEDS = 1024
PACK = "pack long, width int, ids binary, labels binary, matrix binary"
ROW = "vec_id long, label long, width int, vector binary"


def _integers(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and ``floor(scale * x)`` of a batch's usable rows, width by width."""
    vectors = batch.column("embedding")
    usable = vectors.is_valid().to_numpy(zero_copy_only=False) & batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
    usable &= batch.column("label").is_valid().to_numpy(zero_copy_only=False)
    width = np.where(usable, vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
    ids, labels = (batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        flat = vectors.take(pa.array(at)).flatten().cast(pa.float64()).fill_null(np.nan)
        with np.errstate(over="ignore", invalid="ignore"):
            matrix = np.floor(flat.to_numpy(zero_copy_only=False).reshape(len(at), w) * float(scale))
            fits = (matrix * matrix).sum(axis=1) < 2.0**62  # false for NaN and infinities
        yield ids[at][fits], labels[at][fits], matrix[fits].astype(np.int32)


def _slim(vectors: DataFrame, label: str | None) -> DataFrame:
    named = F.col(label).cast("long") if label else F.lit(0).cast("long")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), named.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))


def integer_rows(vectors: DataFrame, scale: int, label: str | None = None) -> DataFrame:
    """One row (``ROW``) for each usable vector of ``vectors`` (vec_id, embedding)."""

    def convert(batches):
        for batch in batches:
            for ids, labels, matrix in _integers(batch, scale):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(np.full(len(ids), matrix.shape[1], np.int32)),
                     pa.array([v.tobytes() for v in matrix], pa.binary())], names=["vec_id", "label", "width", "vector"])

    return _slim(vectors, label).mapInArrow(trimmed(convert), ROW)


def packs(vectors: DataFrame, scale: int, label: str | None = None) -> DataFrame:
    """The packs (``PACK``) of all usable vectors, a table in the shared folder.

    Each task orders the rows of ``CHUNK`` packs by length, longest first, and cuts them."""

    def cut(batches):
        held: dict[int, list] = {}
        made = TaskContext.get().partitionId() << 33

        def emit(parts):
            nonlocal made
            ids, labels, matrix = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(-(matrix.astype(np.float64) ** 2).sum(axis=1), kind="stable")
            for begin in range(0, len(order), ROWS):
                at = order[begin : begin + ROWS]
                yield pa.RecordBatch.from_pydict(
                    {"pack": [made], "width": [matrix.shape[1]], "ids": [ids[at].tobytes()], "labels": [labels[at].tobytes()], "matrix": [matrix[at].tobytes()]},
                    schema=pa.schema([("pack", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("matrix", pa.binary())]))
                made += 1

        for batch in batches:
            for part in _integers(batch, scale):
                own = held.setdefault(part[2].shape[1], [])
                own.append(part)
                if sum(len(p[0]) for p in own) >= CHUNK * ROWS:
                    yield from emit(held.pop(part[2].shape[1]))
        for own in held.values():
            yield from emit(own)

    path = scratch(vectors.sparkSession, "packs")
    _slim(vectors, label).mapInArrow(trimmed(cut), PACK).write.parquet(path)
    return vectors.sparkSession.read.schema(PACK).parquet(path)


def asked_rows(queries: DataFrame, scale: int, label: str | None = None) -> DataFrame:
    """Distinct queries with a number ``q`` each, frozen."""
    return frozen(integer_rows(queries, scale, label).dropDuplicates().withColumn("q", F.monotonically_increasing_id()))


def number_type(*matrices: np.ndarray) -> type:
    """Numbers in which inner products and their partial sums are exact:
    doubles while lengths stay below 2^26, else 64-bit integers."""
    longest = max([0.0, *((m.astype(np.float64) ** 2).sum(axis=1).max() for m in matrices if len(m))])
    return np.float64 if longest < 2.0**52 else np.int64


class Rows:
    """Rows of one width: ``ids``, ``labels``, ``matrix``."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        self.ids, self.labels, self.matrix = ids, labels, matrix

    @classmethod
    def of_pack(cls, row) -> Rows:
        matrix = np.frombuffer(row.matrix, np.int32).reshape(-1, row.width)
        return cls(np.frombuffer(row.ids, np.int64), np.frombuffer(row.labels, np.int64), matrix)

    @classmethod
    def of_rows(cls, frame: pd.DataFrame) -> dict[int, Rows]:
        """By width, from a frame of ``ROW``."""
        return {int(w): cls(own["vec_id"].to_numpy(), own["label"].to_numpy(), np.array([np.frombuffer(v, np.int32) for v in own["vector"]]).reshape(-1, w))
                for w, own in frame.groupby("width")}


def seeds(vectors: DataFrame, scale: int, label: str | None = None) -> dict[int, Rows]:
    """At most ``SEEDS`` rows, those with the smallest hashes; their scores bound every
    query's answers from below, so no pack starts without a threshold."""
    chosen = _slim(vectors, label).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEEDS)
    return Rows.of_rows(integer_rows(chosen, scale, "label").toPandas())


def meet(asked: DataFrame, held: DataFrame, search: Callable[[pd.DataFrame, list], pd.DataFrame], schema: str) -> DataFrame:
    """``search`` of every block of ``asked`` over every shard of the packs ``held``.

    It gets a frame of at most about ``QUERIES`` queries and the list of a shard's
    packs (``Rows``, by width); its results (``schema``) are put together."""
    spark = asked.sparkSession
    n_packs, n_asked = held.count(), asked.count()
    shards = max(1, -(-n_packs // SHARD), min(n_packs, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    blocks = max(1, -(-n_asked // QUERIES))
    dealt = held.withColumn("shard", F.pmod(F.xxhash64("pack"), F.lit(shards)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    called = asked.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        return search(queries, [(int(p.width), Rows.of_pack(p)) for p in found.itertuples()])

    return called.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInPandas(run, schema)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))[:k]
