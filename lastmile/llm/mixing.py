"""Operator 10: mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a keyed shuffle, the whole queue
repeated up to ``most`` times. A queued copy has as its virtual finish time the words of
its source up to its end, divided by the source's target. The mix serves all queues in order
of virtual finish time until the total budget (the whole words of all targets) is used up:
copies are range-partitioned by finish time, a prefix sum over the partitions' words and a
running sum inside each find where the budget ends, and what lies beyond is cut off.

A copy that runs past its source's target is queued as two units, its words up to the
target (which finish at virtual time 1) and the rest (later). So no source is served
beyond its target before all others have reached theirs, and every source takes the whole
words of its target, inside a document if need be (at most one document of a source).

Targets come from water-filling: sources share the budget by weight, none gets
more than ``most`` times its own size, and what is left is shared again by
weight until no source is above.

Scale. Running totals of a source never sit in one task: documents fall into
4096 buckets by the leading digits of their shuffle key, totals are formed per
(source, bucket) and only those totals (at most 4096 rows a source) are summed
along the source. Source names, one row each, are ranked in one small window.
The join back is on (source, bucket), so a source with a third of all rows is
spread over 4096 keys. The global order is found on units of a few numbers each; the
driver learns one row, the last unit within the budget, against which every copy is
compared where it lies. Texts are carried only when the caller selects them.

Defined results: null sources form a source of their own, ranked last; null
or empty texts have size 0 and are taken 0 times; rows repeated in full are
queued one after the other; rows with a null ``doc_id`` shuffle last; an empty
table gives no rows. Columns of the input keep their values whatever their
names (they travel in one struct).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.common import WORD, frozen, word_count

#: Leading hexadecimal digits of the shuffle key that choose a bucket.
BUCKET_DIGITS = 3


def source_targets(sources: DataFrame, weights=(5, 2, 1), share=1.5, most=2.0) -> DataFrame:
    """``rank`` and ``target`` words of each source of ``sources`` (source, source_size).

    Ranked by code point, null last, the sources take ``weights`` in turn.
    One row a source; the windows run over that table alone.
    """
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    turn = (F.col("rank") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    capped = ranked.withColumns({"weight": weight, "cap": F.lit(float(most)) * F.col("source_size")})
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
    levels = capped.withColumns({"level": level, "step": F.row_number().over(filling)})
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("step", "level"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(open_level["level"] * F.col("weight"), F.col("cap")))
    return levels.withColumn("target", target).select("source", "rank", "source_size", "target")


def _queued(docs: DataFrame, weights, share: float, most: int, seed: str) -> DataFrame:
    """Every document (``doc``) with its size, its source's rank, size and target, and the
    words ``begin`` of its source that are queued before it."""
    key = F.md5(F.concat(F.lit(f"{seed}/"), F.col("doc_id").cast("string")))
    slim = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col("source"), word_count(F.col("text")).alias("size"), key.alias("shuffle"),
        F.struct(F.col("doc_id"), F.xxhash64("text")).alias("tie"),
    ).withColumn("bucket", F.coalesce(F.substring("shuffle", 1, BUCKET_DIGITS), F.lit("~")))
    totals = slim.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(totals.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("words").over(along), F.lit(0))).select(
        F.col("source").alias("of_source"), F.col("bucket").alias("of_bucket"), "offset")
    named = targets.withColumnRenamed("source", "by_source")
    offsets = offsets.join(named, F.col("of_source").eqNullSafe(F.col("by_source"))).drop("by_source")
    inside = Window.partitionBy("source", "bucket").orderBy(F.col("shuffle").asc_nulls_last(), "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    queued = slim.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket")))
    return queued.select("doc", "size", "rank", "source_size", "target", (F.col("ahead") + F.col("offset")).alias("begin"))


def _units(most: int) -> Column:
    """Array of a queued document's units, two a copy: ``place`` (finish, rank, begin, part) and ``words``."""
    def unit(turn: int, part: int) -> Column:
        ahead = F.col("begin") + turn * F.col("source_size")
        until = F.greatest(F.lit(0), F.least(F.col("size"), F.floor(F.col("target")) - ahead)).cast("long")
        words, end = (until, ahead + until) if part == 0 else (F.col("size") - until, ahead + F.col("size"))
        finish = F.try_divide(end.cast("double"), F.col("target"))
        place = F.struct(F.coalesce(finish, F.lit(float("inf"))).alias("finish"), F.col("rank"), ahead.alias("ahead"), F.lit(part).alias("part"))
        return F.struct(place.alias("place"), words.alias("words"))

    return F.filter(F.array(*[unit(turn, part) for turn in range(int(most)) for part in (0, 1)]), lambda u: u["words"] > 0)


def _last_unit(queued: DataFrame, most: int):
    """The last unit, in order of finish time, that the total budget reaches, and how many
    of its words; None where nothing is served."""
    numbers = queued.select("size", "rank", "source_size", "target", "begin")
    units = numbers.select(F.explode(_units(most)).alias("unit"), "target").select("unit.place", "unit.words", "target")
    ranged = frozen(units.repartitionByRange("place").withColumn("range", F.spark_partition_id()))
    budget = ranged.groupBy("place.rank").agg(F.floor(F.max("target")).alias("words")).agg(F.sum("words").alias("budget")).first()["budget"]  # one row a source
    if budget is None:
        return None
    sums = ranged.groupBy("range").agg(F.sum("words").alias("held"))  # one row a partition
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("range", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("earlier"), "held")
    found = offsets.where((F.col("earlier") < budget) & (F.col("earlier") + F.col("held") >= budget)).select("range", (budget - F.col("earlier")).alias("left")).first()
    if found is None:  # nothing fits into a budget of no whole word
        return None
    running = F.sum("words").over(Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    inside = ranged.where(F.col("range") == found["range"]).withColumn("upto", running).where(F.col("upto") >= found["left"])
    end = inside.agg(F.min(F.struct("place", "words", "upto")).alias("end")).first()["end"]
    return end["place"], end["words"] - (end["upto"] - found["left"])


def mix_plan(docs: DataFrame, weights=(5, 2, 1), share=1.5, most=2, seed="mix") -> DataFrame:
    """What the mix takes of each document of ``docs`` (doc_id, text, source).

    Returns ``doc`` (the input row, without its text if ``docs`` has only the three columns),
    ``size``, ``source_size``, ``target``, ``taken`` (words, repeats counted) and ``copies``, an
    array of ``(finish, words)`` for each copy that the mix takes, ``words`` being less
    than ``size`` only for the copy at which the source's target is reached.
    """
    queued = _queued(docs, weights, share, most, seed)
    if set(docs.columns) == {"doc_id", "text", "source"}:
        queued = frozen(queued.withColumn("doc", F.struct("doc.doc_id", "doc.source")))  # numbers only: computed once
    last = _last_unit(queued, most)
    if last is None:
        served = F.filter(_units(most), lambda u: F.lit(False))
    else:
        place = F.struct(*[F.lit(last[0][c]).cast(kind).alias(c) for c, kind in (("finish", "double"), ("rank", "int"), ("ahead", "long"), ("part", "int"))])
        cut = F.transform(_units(most), lambda u: F.struct(
            u["place"].alias("place"),
            F.when(u["place"] < place, u["words"]).when(u["place"] == place, F.lit(last[1]).cast("long")).otherwise(F.lit(0).cast("long")).alias("words")))
        served = F.filter(cut, lambda u: u["words"] > 0)
    copies = F.transform(served, lambda u: F.struct(u["place"]["finish"].alias("finish"), u["words"].alias("words")))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, c: total + c["words"])
    return queued.select("doc", "size", "source_size", "target", copies.alias("copies")).withColumn("taken", taken)


def mix(docs: DataFrame, weights=(5, 2, 1), share=1.5, most=2, seed="mix") -> DataFrame:
    """The mixed documents themselves, in order of virtual finish time.

    One row a copy with the columns of ``docs``, globally range-sorted by
    virtual finish time. The copy at which a source reaches its target keeps
    its first words only; ``n_chars``, where present, follows.
    """
    plan = mix_plan(docs, weights, share, most, seed)
    rows = plan.select("doc", "size", F.explode("copies").alias("copy"))
    rows = rows.orderBy(F.col("copy.finish"), F.xxhash64("doc.doc_id"))
    # only a cut copy is split into words, each with the blanks before it
    pieces = F.regexp_extract_all(F.col("doc.text"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    text = F.when(F.col("copy.words") < F.col("size"), F.array_join(F.slice(pieces, F.lit(1), F.col("copy.words").cast("int")), "")).otherwise(F.col("doc.text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("copy.words") < F.col("size"), F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return rows.select(*[changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def op10_mixing(spark, sf_dir) -> DataFrame:
    """Contract query: what the mix takes of every document."""
    from lastmile.llm.common import table
    plan = mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


OP10_SQL = r"""
with sized as (
  select doc_id, source, xx.words as size, md5('mix/' || cast(doc_id as varchar)) as shuffle
  from documents, lateral (select cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as words) xx
), sources as (
  select source, cast(sum(size) as bigint) as source_size from sized group by source
), ranked as (
  select *, row_number() over (order by source nulls last) as rank from sources
), capped as (
  select *, case (rank - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight,
         2.0::double * source_size as cap from ranked
), levels as (
  select *, row_number() over filling as step,
    (1.5::double * sum(source_size) over () - coalesce(sum(cap) over (filling rows between unbounded preceding and 1 preceding), 0.0::double))
      / sum(weight) over (filling rows between current row and unbounded following) as level
  from capped window filling as (order by cap / weight, rank)
), targets as (
  select source, source_size,
    least(cap, coalesce((select arg_min(level, step) from levels where level * weight <= cap) * weight, cap)) as target
  from levels
), queued as (
  select doc_id, source, size, coalesce(sum(size) over (partition by source order by shuffle, size
    rows between unbounded preceding and 1 preceding), 0) as ahead from sized
)
select doc_id, size, source_size, target,
  cast(greatest(0, least(size, floor(target) - ahead)) + greatest(0, least(size, floor(target) - ahead - source_size)) as bigint) as taken
from queued join targets on queued.source is not distinct from targets.source
"""
