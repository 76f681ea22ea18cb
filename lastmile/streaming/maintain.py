"""Silver and gold kept up to date batch by batch, without a rebuild.

A store under ``root`` holds, in parts of which a batch touches only some:

* ``records``: the raw shipments in force, each with its number of copies, by hash
  bucket of the tracking id; ``moved`` names the last version that brought a record which
  can equal this one once both are clean;
* ``core``: the clean shipments (the 10 business columns, exact duplicates once), in
  the same buckets; a weight that is to be imputed is still null, ``twin`` marks rows
  that differ in nothing else from one without (or with) a weight, and ``again`` rows that an
  earlier run holds as well (the older twins of new rows);
* ``beside``: clean shipments without a weight that differ in nothing else from
  one with a weight, with that weight, in the same buckets;
* ``cube``: mergeable states by day, city and courier id, by year; a key has a state a run;
* ``weights``: number of raw rows of each accepted weight, ``counts``: rows, both by bucket;
* ``couriers``: the latest record of each courier.

``apply_batch`` merges a batch's records into their buckets (a record counts as often as
in the last file that holds it, so a file landed twice counts once). A record stays in force
once it is there, so clean shipments and states are never taken back: ``core``, ``beside`` and ``cube`` get
what is new as one more run of the parts concerned, and a part with ``RUNS`` runs is
written as one. What depends on all rows is left to the reader: the median comes from ``weights``, and a
shipment without a weight that equals another one once the median is filled in
(``beside`` tells) is taken off; couriers are joined to the states and to the rows
when they are read, so a changed courier record rewrites no shipment.

A batch becomes visible by one small file that names the folder of every part
(``layers.name_version``) and the last batch of each source. A batch that failed, or
that a stream delivers again, changes nothing. A store has one writer.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lastmile import fixed, schemas
from lastmile.operators import clean, cube, enrich
from lastmile.operators.clean import weight_in_range
from lastmile.operators.merge import latest_per_key
from lastmile.operators.ranking import quantile_value
from lastmile.session import shuffles_freed
from lastmile.sources import layers

#: Hash buckets of a new store. A batch rewrites the buckets it touches, so a large store wants
#: buckets of about what a few tasks read.
BUCKETS = 32
RAW = list(schemas.RAW_SHIPMENT_COLUMNS)
KEYS = list(fixed.SHIPMENT_KEY_COLUMNS)
BESIDES = [k for k in KEYS if k != "weight"]
CUBE_KEYS = (*cube.DAY, "courier_id")
#: Cuts of a part. Rows are dealt by part and cut once; what is grouped by more columns than
#: the cut is made of then stays in its task.
CUTS = 64
#: Runs of a part; with so many, the next batch writes it as one.
RUNS = 16
#: Columns that cleaning leaves as they are: equal records and equal clean shipments share a cut.
KEPT = ("tracking_id", "status", "courier_id", "client_type")
#: What rows of a task are grouped by, first: a number that tells most rows apart (they are sorted
#: by its value alone), then what they are dealt by and the columns that equal rows share.
ALIKE = ("_hash", "bucket", "_cut", *KEPT)
_STAMP = "ingestion_timestamp timestamp, source_file string, source_system string"
_CLEAN = "tracking_id string, pickup timestamp, delivery timestamp, city string, zip string, weight double, status string, courier_id string, client_type string, amount double"
#: Of each table its columns and the column that its parts are cut by.
TABLES = {
    "records": (", ".join(f"{c} string" for c in RAW) + f", {_STAMP}, n bigint, since string, moved string", "bucket"),
    "core": (f"{_CLEAN}, ingestion_timestamp timestamp, since string, twin boolean, again boolean", "bucket"),
    "beside": (f"{_CLEAN}, beside double", "bucket"),
    "counts": ("raw_rows bigint, in_range_rows bigint, null_weight_rows bigint", "bucket"),
    "cube": (f"day date, year int, month int, city string, courier_id string, {cube.STATE_SCHEMA}", "part"),
    "weights": ("weight double, n bigint", "bucket"),
    "couriers": (", ".join(f"{c} string" for c in schemas.RAW_COURIER_COLUMNS) + f", {_STAMP}", "part"),
}


def bucket_of(buckets: int = BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64("tracking_id"), F.lit(buckets)).cast("int")


def dealt(rows: DataFrame, part: str, *cut_by: str) -> DataFrame:
    """Rows dealt by ``part`` and ``_cut``, a hash of ``cut_by``."""
    return rows.withColumn("_cut", F.pmod(F.xxhash64(*cut_by), F.lit(CUTS)).cast("int")).repartition(part, "_cut")


def _by_id(rows: DataFrame) -> DataFrame:
    """Dealt rows with ``_hash``, which is not moved with them."""
    return rows.withColumn("_hash", F.xxhash64("tracking_id"))


def _runs(held: str | list[str]) -> list[str]:
    """Versions that hold a part; a store from before runs names one."""
    return [held] if isinstance(held, str) else held


class Store:
    """The parts that a store's current version names."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        version = layers.current_version(spark, self.root)
        found = json.loads(layers.version_note(spark, self.root, version)) if version else {}
        self.applied: dict[str, int] = found.get("applied", {})
        self.parts: dict[str, dict[str, list[str]]] = {t: {p: _runs(v) for p, v in parts.items()} for t, parts in found.get("parts", {}).items()}
        self.buckets: int = found.get("buckets", buckets)

    def folders(self, table: str, parts=None, version: str | None = None) -> list[str]:
        """Folders of a table's parts: all, or of ``parts`` those that exist; of all runs, or of one."""
        held = self.parts.get(table, {})
        return [f"{self.root}/{table}/{run}/{p}" for p in sorted(held) if parts is None or p in parts for run in held[p] if version in (None, run)]

    def read(self, table: str, parts=None, version: str | None = None) -> DataFrame:
        """Rows of a table; a part (or run) that is not asked for is not in the plan."""
        schema, folders = TABLES[table][0], self.folders(table, parts, version)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame(self.spark.sparkContext.emptyRDD(), schema)

    def full(self, table: str) -> list[str]:
        """Parts with so many runs that the next batch writes them as one."""
        return [p for p, runs in self.parts.get(table, {}).items() if len(runs) >= RUNS]

    def write(self, version: str, table: str, df: DataFrame, touched=None, is_dealt: bool = False, adds: bool = False) -> list[str]:
        """Write a table's touched parts (all by default) as ``version``; a part without rows goes.

        ``is_dealt``: the rows come from :func:`dealt` or lie as they should, and are not moved again.
        ``adds``: the rows are one more run of their parts, and the whole of the ``touched`` ones."""
        by, target = TABLES[table][1], f"{self.root}/{table}/{version}"
        with shuffles_freed(self.spark):
            (df if is_dealt else df.hint("rebalance", F.col(by))).write.option("compression", "zstd").partitionBy(by).parquet(target)
        new = [n for n in layers.names_in(self.spark, target) if n.startswith(f"{by}=")]
        kept = {} if touched is None else {p: runs for p, runs in self.parts.get(table, {}).items() if p not in touched}
        self.parts[table] = {**kept, **{p: [*(kept.get(p, []) if adds else []), version] for p in new}}
        return new

    def commit(self, version: str) -> None:
        note = {"applied": self.applied, "parts": self.parts, "buckets": self.buckets}
        layers.name_version(self.spark, self.root, version, json.dumps(note))

    def sweep(self) -> None:
        """Remove what neither the current version nor the one before it names."""
        published = layers.names_in(self.spark, f"{self.root}/{layers.PUBLISHED}")
        notes = [json.loads(layers.version_note(self.spark, self.root, v))["parts"] for v in published[-2:]]
        named = {(t, v, p) for note in notes for t, parts in note.items() for p, held in parts.items() for v in _runs(held)}
        for table in (*TABLES, "incoming", "delta"):
            for version in layers.names_in(self.spark, f"{self.root}/{table}"):
                inside = layers.names_in(self.spark, f"{self.root}/{table}/{version}")
                if not any((table, version, p) in named for p in inside):
                    layers.remove(self.spark, f"{self.root}/{table}/{version}")
                    continue
                for part in inside:
                    if "=" in part and (table, version, part) not in named:
                        layers.remove(self.spark, f"{self.root}/{table}/{version}/{part}")
        for version in published[:-2]:
            layers.remove(self.spark, f"{self.root}/{layers.PUBLISHED}/{version}")


def _in_range(records: DataFrame) -> DataFrame:
    return clean.filter_weight_range(clean.normalize_shipments(records))


def _measured(core: DataFrame, vocab: fixed.Vocabulary) -> DataFrame:
    return enrich.with_delivery_measures(core.where(F.col("courier_id").isNotNull()), delivered=vocab.delivered)


def merged_records(old: DataFrame, incoming: DataFrame, bucket: F.Column) -> DataFrame:
    """Each record as often as in the last file that holds it, with its bucket, the version
    that brought it first and the last one that brought a record like it; ``old`` and ``incoming`` have a
    row a record and file, with its copies ``n``."""
    stamp = ["ingestion_timestamp", "source_file", "source_system", "n"]
    rows = _by_id(dealt(old.unionByName(incoming).withColumn("bucket", bucket), "bucket", *KEPT))
    others = [c for c in RAW if c not in KEPT]
    last = rows.groupBy(*ALIKE, *others).agg(F.max(F.struct(*stamp)).alias("last"), F.min("since").alias("since"))
    marked = last.withColumn("moved", F.max("since").over(Window.partitionBy(*ALIKE)))
    return marked.select(*RAW, *[F.col("last")[c].alias(c) for c in stamp], "since", "moved", "bucket")


def _clean_rows(records: DataFrame, bucket: F.Column) -> DataFrame:
    """The clean shipments of records, with their bucket and the mark of twins."""
    typed = _in_range(records).select(*KEYS, "ingestion_timestamp", "since").withColumn("bucket", bucket)
    besides = [c for c in BESIDES if c not in KEPT]
    # sorted once: the weight comes last, so twins follow each other
    core = _by_id(dealt(typed, "bucket", *KEPT)).groupBy(*ALIKE, *besides, "weight").agg(
        F.min("ingestion_timestamp").alias("ingestion_timestamp"), F.min("since").alias("since"))
    alike = Window.partitionBy(*ALIKE, *besides)
    missing = F.col("weight").isNull()
    return core.withColumn("twin", F.max(missing).over(alike) != F.min(missing).over(alike)).select(*KEYS, "ingestion_timestamp", "since", "twin", "bucket")


def _once(core: DataFrame) -> DataFrame:
    """The clean shipments of core, each from the run that brought it."""
    return core.where(~F.coalesce(F.col("again"), F.lit(False)))


def _write_counts(store: Store, version: str, touched: list[str]) -> None:
    """Rows and accepted weights of the records of the touched buckets, which are read once."""
    bucket = bucket_of(store.buckets)
    # a store from before weights had buckets counts all of its records once
    whole = any(not p.startswith("bucket=") for p in store.parts.get("weights", {}))
    touched = None if whole else touched
    weighed = clean.normalize_shipments(store.read("records", touched)).groupBy(bucket.alias("bucket"), "weight").agg(F.sum("n").alias("n"))
    path = f"{store.root}/incoming/{version}-weights"
    with shuffles_freed(store.spark):
        weighed.write.option("compression", "zstd").parquet(path)
    weighed = store.spark.read.schema("bucket int, weight double, n bigint").parquet(path)
    rows = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    store.write(version, "counts", weighed.groupBy("bucket").agg(
        F.sum("n").alias("raw_rows"), rows(weight_in_range(F.col("weight"))).alias("in_range_rows"), rows(F.col("weight").isNull()).alias("null_weight_rows")), touched)
    store.write(version, "weights", clean.filter_weight_range(weighed).where(F.col("weight").isNotNull()), touched)
    layers.remove(store.spark, path)


def _add_clean(store: Store, version: str, touched: list[str]) -> DataFrame:
    """Add the clean shipments that are new to core, and their twins to beside; returns the new ones.

    Only records are cleaned that came with, or can equal, a record that is new."""
    bucket, full = bucket_of(store.buckets), store.full("core")
    moved = store.read("records", touched).where(F.col("moved") == version)
    rows = _clean_rows(moved, bucket).withColumn("again", F.col("since") != version).where(F.col("twin") | ~F.col("again"))
    if full:
        rows = rows.unionByName(_once(store.read("core", full)).withColumn("bucket", bucket))
    store.write(version, "core", rows, full, is_dealt=not full, adds=True)
    core = store.read("core", version=version)

    twins = core.where("twin")
    weighted = twins.where(F.col("weight").isNotNull()).select(*[F.col(k).alias(f"_{k}") for k in BESIDES], F.col("weight").alias("beside"), F.col("since").alias("_since"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in BESIDES]
    # of older pairs an earlier run tells
    pairs = twins.where(F.col("weight").isNull()).join(weighted, same).where((F.col("since") == version) | (F.col("_since") == version))
    beside, full = pairs.select(*KEYS, "beside").distinct(), store.full("beside")
    if full:
        beside = beside.unionByName(store.read("beside", full))
    store.write(version, "beside", beside.withColumn("bucket", bucket), full, adds=True)
    return core.where(F.col("since") == version)


def _add_states(store: Store, version: str, new: DataFrame, vocab: fixed.Vocabulary) -> None:
    """Add the states of the clean shipments that are new to the cube."""
    states, full = cube.changed(cube.delivery_states(_measured(new, vocab), CUBE_KEYS, vocab)), store.full("cube")
    if full:
        states = cube.merge_states(states.unionByName(store.read("cube", full)), CUBE_KEYS)
    part = F.coalesce(F.date_format("day", "yyyy"), F.lit("none"))
    store.write(version, "cube", states.withColumn("part", part), full, is_dealt=True, adds=True)


def _apply_shipments(store: Store, version: str, shipments: DataFrame, vocab: fixed.Vocabulary) -> None:
    spark, bucket = store.spark, bucket_of(store.buckets)
    # the batch is computed once; its rows tell which buckets it touches
    per_file = shipments.groupBy(*RAW, "ingestion_timestamp", "source_file", "source_system").agg(F.count(F.lit(1)).alias("n"))
    staged = f"{store.root}/incoming/{version}"
    with shuffles_freed(spark):
        per_file.withColumn("since", F.lit(version)).write.option("compression", "zstd").parquet(staged)
    incoming = spark.read.schema(TABLES["records"][0]).parquet(staged)
    touched = [f"bucket={r.bucket}" for r in incoming.select(bucket.alias("bucket")).distinct().collect()]  # at most the store's buckets
    if not touched:
        return
    # records of a store from before ``since`` are older than any version
    old_records = store.read("records", touched).withColumn("since", F.coalesce("since", F.lit("")))
    store.write(version, "records", merged_records(old_records, incoming, bucket), touched, is_dealt=True)
    layers.remove(spark, staged)

    _write_counts(store, version, touched)
    _add_states(store, version, _add_clean(store, version, touched), vocab)


def apply_batch(spark: SparkSession, root: str, shipments: DataFrame | None = None, couriers: DataFrame | None = None,
                source: str = "batch", batch_id: int = 0, vocab: fixed.Vocabulary = fixed.ENGLISH, buckets: int = BUCKETS) -> bool:
    """Merge a batch of stamped bronze rows into the store; false if it is in it already.

    ``batch_id`` grows with the batches of a ``source``; ``buckets`` counts for a new store."""
    store = Store(spark, root, buckets)
    if store.applied.get(source, -1) >= batch_id:
        return False
    version = layers.new_version()
    if shipments is not None:
        _apply_shipments(store, version, shipments, vocab)
    if couriers is not None:
        latest = latest_per_key(store.read("couriers").unionByName(couriers.select(*store.read("couriers").columns)), ["courier_id"], ["ingestion_timestamp"])
        store.write(version, "couriers", latest.withColumn("part", F.lit("all")))
    store.applied[source] = batch_id
    store.commit(version)
    store.sweep()
    return True


def median_weight(store: Store) -> float | None:
    """The median that fills missing weights, from the weights' counts."""
    return quantile_value(store.read("weights"), "weight", fixed.MEDIAN_QUANTILE, weight="n")


def clean_couriers(store: Store, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    return clean.clean_couriers(store.read("couriers").select(*schemas.RAW_COURIER_COLUMNS), vocab.contract_canon)


def _collisions(store: Store, median: float | None) -> DataFrame | None:
    """Clean shipments without a weight that equal another one once the median is filled in."""
    if not store.folders("beside"):
        return None
    return store.read("beside").where(F.col("beside") == F.lit(median)).drop("beside").distinct()


def read_silver(spark: SparkSession, root: str, vocab: fixed.Vocabulary = fixed.ENGLISH, audit: bool = False) -> DataFrame:
    """The silver shipment table of a store.

    ``audit``: with the time of ingestion, which a record that is sent again changes, so the
    rows come from the records."""
    store = Store(spark, root)
    median = median_weight(store)
    core = _clean_rows(store.read("records"), bucket_of(store.buckets)) if audit else _once(store.read("core"))
    gone = _collisions(store, median)
    if gone is not None:
        of = gone.select(*[F.col(k).alias(f"_{k}") for k in BESIDES])
        core = core.join(of, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in BESIDES] + [F.col("weight").isNull()], "left_anti")
    filled = core.withColumn("weight", F.coalesce(F.col("weight"), F.lit(median).cast("double")))
    measured = enrich.with_delivery_measures(enrich.enrich_with_courier(filled, clean_couriers(store, vocab)), delivered=vocab.delivered)
    return enrich.silver_projection(measured, audit)


def read_cube(spark: SparkSession, root: str, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    """States by day, city and courier, with the courier's columns: no shipment is read.

    A key may have several states, one a run; they add up (``cube.merge_states``), as the gold tables do with them."""
    store = Store(spark, root)
    states, gone = store.read("cube"), _collisions(store, median_weight(store))
    if gone is not None:
        signed = _measured(gone.withColumn("_sign", F.lit(-1)), vocab)
        states = states.unionByName(cube.delivery_states(signed, CUBE_KEYS, vocab, "_sign"))
    return enrich.enrich_with_courier(states, clean_couriers(store, vocab))


def maintain_available(spark: SparkSession, bronze: str, kind: str, root: str, checkpoint: str,
                       vocab: fixed.Vocabulary = fixed.ENGLISH) -> int:
    """Merge the rows that a bronze table has gained into the store; returns the batches merged."""
    schema = (TABLES["couriers"] if kind == "couriers" else (", ".join(f"{c} string" for c in RAW) + f", {_STAMP}", ""))[0]
    merged = []

    def merge(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            merged.append(apply_batch(batch.sparkSession, root, **{kind: batch}, source=kind, batch_id=batch_id, vocab=vocab))

    query = (spark.readStream.schema(schema).parquet(bronze).writeStream.foreachBatch(merge)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(merged)
