"""Operator 2: document fingerprints by order MinHash (SQL functions only).

Words are runs of non-blank characters, cut after ``PART`` characters so that
texts without blanks have words too; a k-mer is ``k`` of them in a row (a text
with fewer has one k-mer of all). Equal k-mers of a text are numbered by
occurrence. Every numbered k-mer is hashed once, onto a circle that ``sketches``
slots divide evenly (one-permutation hashing). A slot takes the ``keep`` k-mers that
follow its start on the circle, be they its own or, where it holds fewer, those of
the slots after it, puts them back in text order and hashes the tuple: two texts agree
in a slot if they share its k-mers in the same order, which edits, moves and
changed repetition counts all disturb. So a short text fills every slot with a tuple
of ``keep`` k-mers, and its fingerprint tells order as that of a long one does.

The fingerprint is the slots' tuple hashes, eight hexadecimal digits each, dashes
in all slots for a text without words. Likeness of two fingerprints: the share of
agreeing slots among those not empty in both; 1 for two empty fingerprints.

A text costs two sorts of one array of longs and a few linear passes over it;
nothing is exploded, so no shuffle follows from a text's length.

Edited texts need the next document by id. Ids alone are range-partitioned and
frozen; each text is shuffled once, by id, and only the opening that its
predecessor needs is shuffled again. Ids that many rows share (or lack) are found
first; their texts are dealt over salts, each with a copy of the one opening.

Defined results: null texts are empty; rows that share a ``doc_id`` count as one
document for "next" (the text of theirs with the smallest hash) and keep a row
each;
rows with a null ``doc_id`` come before all others; the only document is its own
next one; an empty table gives no rows; other columns are not read. A text of more than
2^28 words is beyond an array of longs and fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.common import frozen, table
from lastmile.operators.skewjoin import hot_keys, salted_join, salts_of

#: Longest word; longer runs are cut.
PART = 16
#: Bits of a packed long that hold a position; the rest holds a hash. No array of longs
#: is longer, as a buffer holds 2 GB.
POSITION_BITS = 28
#: Sorts a null id before all others.
NULL_KEY = -(2**63)
#: Share of all rows that a salt of a hot id holds.
SALT_SHARE = 0.0001


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _starts(values: Column, group) -> Column:
    """Positions (from 0) at which the groups of a sorted, non-empty array begin."""
    return F.filter(F.sequence(F.lit(0), F.size(values) - 1), lambda i: (i == 0) | (group(F.get(values, i)) != group(F.get(values, i - 1))))


def _hash_of(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, POSITION_BITS)


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))


def _packed(value: Column, place: Column) -> Column:
    return F.shiftleft(value, POSITION_BITS).bitwiseOR(place)


def _kmers(text: Column, k: int) -> Column:
    """Hashes of the k-mers of a text, in text order."""
    words = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"\S{{1,{PART}}}"), F.lit(0)), lambda w: F.xxhash64(w))

    def of(w):
        n = F.size(w)
        # a missing word is null and adds nothing to the hash
        return F.transform(F.slice(w, F.lit(1), F.greatest(n - k + 1, F.least(n, F.lit(1)))), lambda _, i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))

    return _let(words, of)


def _numbered(kmers: Column) -> Column:
    """Packed (hash of k-mer and occurrence number, place), sorted."""
    grouped = F.sort_array(F.transform(kmers, lambda h, i: _packed(h, i.cast("long"))))

    def number(g):
        def group(starts):
            def one(begin, j):
                end = F.coalesce(F.get(starts, j + 1), F.size(g))
                return F.transform(F.slice(g, begin + 1, end - begin), lambda x, o: _packed(F.xxhash64(_hash_of(x), o), _place_of(x)))
            return F.flatten(F.transform(starts, one))
        return F.sort_array(_let(_starts(g, _hash_of), group))

    return _let(grouped, number)


def slots(text: Column, k=3, sketches=32, keep=2) -> Column:
    """Order MinHash of a text: an array with one int a slot, nulls without words.

    ``sketches`` is a power of two, 2 at least; the leading bits of a hash are its slot."""
    bits = (sketches - 1).bit_length()
    if bits < 1 or 1 << bits != sketches:
        raise ValueError("sketches must be a power of two from 2 on")

    def slot(x):
        return F.shiftright(x, 64 - bits).cast("int")

    def of(kmers):
        def pick(ordered):
            size = F.least(F.size(ordered), F.lit(keep))
            circle = F.concat(ordered, F.slice(ordered, F.lit(1), size))
            held = F.transform(_starts(ordered, slot), lambda begin: F.struct(slot(F.get(ordered, begin)).alias("slot"), begin.alias("begin")))

            def entry(begin):
                places = F.sort_array(F.transform(F.slice(circle, begin + 1, size), _place_of))
                return F.hash(F.transform(places, lambda p: F.get(kmers, p.cast("int"))))

            def begin_of(held, i):
                # hashes are sorted as signed numbers, so the upper half of the slots comes first
                signed = F.when(i < sketches // 2, i).otherwise(i - sketches)
                return F.coalesce(F.get(F.filter(held, lambda h: h["slot"] >= signed), F.lit(0))["begin"], F.lit(0))

            return _let(held, lambda held: F.transform(F.sequence(F.lit(0), F.lit(sketches - 1)), lambda i: entry(begin_of(held, i))))

        return _let(_numbered(kmers), pick)

    return _let(_kmers(text, k), lambda kmers: F.when(F.size(kmers) > 0, of(kmers)).otherwise(F.array_repeat(F.lit(None).cast("int"), sketches)))


def fingerprint(slots: Column) -> Column:
    """A signature as text: eight hexadecimal digits a slot."""
    return F.array_join(F.transform(slots, lambda x: F.coalesce(F.substring(F.lpad(F.hex(x), 16, "0"), 9, 8), F.lit("-" * 8))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing slots among those not empty in both (0 to 1)."""
    both = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda s: s["a"].isNotNull() | s["b"].isNotNull())
    return _let(both, lambda s: F.when(F.size(s) == 0, F.lit(1.0)).otherwise(F.size(F.filter(s, lambda x: x["a"] == x["b"])) / F.size(s)))


def next_keys(keys: DataFrame) -> DataFrame:
    """``key`` and ``next``: the following distinct key, after the last the first.

    Keys are range-partitioned and frozen with their partition; the order inside
    one is a window over it, the step to the following one a table with one row
    a partition."""
    parts = frozen(keys.select("key").distinct().repartitionByRange("key").withColumn("part", F.spark_partition_id()))
    firsts = parts.groupBy("part").agg(F.min("key").alias("first"))
    all_parts = Window.partitionBy(F.lit(0))
    follow = firsts.select(F.col("part").alias("of"), F.coalesce(F.lead("first").over(all_parts.orderBy("part")), F.min("first").over(all_parts)).alias("then"))
    after = parts.withColumn("after", F.lead("key").over(Window.partitionBy("part").orderBy("key")))
    return after.join(follow, F.col("part") == F.col("of")).select("key", F.coalesce("after", "then").alias("next"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))


def edited_texts(docs: DataFrame, after: DataFrame) -> DataFrame:
    """``key``, ``text`` and ``edited``: the last quarter of the code points replaced by
    the first as many of the next document's text."""
    known = _keyed(docs)
    quarter = F.floor(F.length("text") / 4).cast("int")
    asked = known.groupBy("key").agg(F.max(quarter).alias("most")).join(after, "key").select(F.col("key").alias("asker"), F.col("next").alias("key"), "most")
    opening = known.join(asked, "key").select(F.col("asker").alias("key"), F.struct(F.xxhash64("text"), F.expr("substring(text, 1, most)").alias("opening")).alias("first"))
    opening = opening.groupBy("key").agg(F.min("first").alias("first"))
    edited = F.concat(F.expr("substring(text, 1, length(text) - quarter)"), F.expr("substring(first.opening, 1, quarter)"))
    salts = salts_of(hot_keys(known.select("key"), "key"), SALT_SHARE)
    # copies of one row are dealt over the salts too, by their place in the files
    dealt = known.withColumn("row", F.monotonically_increasing_id()) if salts else known
    return salted_join(dealt, opening, "key", salts, deal_by=("row",)).withColumn("quarter", quarter).select("key", "text", edited.alias("edited"))


def fingerprint_edits(docs: DataFrame, k=3, sketches=32, keep=2) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likenesses."""
    after = next_keys(_keyed(docs))
    rows = frozen(edited_texts(docs, after).select(
        "key", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.xxhash64("text").alias("tie"),
        slots(F.col("text"), k, sketches, keep).alias("own"), slots(F.col("edited"), k, sketches, keep).alias("other")))
    first = rows.groupBy("key").agg(F.min(F.struct("tie", "own"))["own"].alias("following")).withColumnRenamed("key", "next")
    following = after.join(first, "next").select("key", "following")
    return rows.join(following, "key").select(
        F.when(F.col("key") != NULL_KEY, F.col("key")).alias("doc_id"), "n_chars", "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"))


def op2_order_minhash(spark, sf_dir) -> DataFrame:
    """Contract query: fingerprints of every document and of its edited text."""
    return fingerprint_edits(table(spark, sf_dir, "documents"))
