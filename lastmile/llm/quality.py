"""Operator 4: quality classifier, Naive Bayes support vectors over n-grams.

Features are binary n-grams in 2^18 hashed dimensions: words (A-Z folded), and
n-grams (1 to 3) of word shapes, which say how a word is written (capitals, digits,
symbols, closing punctuation) and whether it repeats the word before it. They are
found with numpy on the raw bytes of an Arrow batch.

Fitting uses a bounded sample of labelled rows, ``per_class`` of each class (the
smallest hashes of their ids, so reruns agree), in one task: log-count ratios scale
the features, dual coordinate descent fits the hinge loss, and margins of held-back
thirds calibrate the score. The model is one row of 2 MB.

Scale. Labels are reduced to the sampled ids (a bounded broadcast) before they meet
the texts; scoring is one pass over the texts without a shuffle.

Defined results: null and empty texts have no features and get the score of the bias
alone; without labels of both classes every score is 0.5; null labels are not used,
of several labels of an id the smallest counts; repeated rows score alike; an empty
table gives no rows; other columns pass through, one named ``score`` is replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.llm import linear, words
from lastmile.llm.common import table

DIMENSION_BITS = 18
DIMENSIONS = 1 << DIMENSION_BITS
#: Labelled rows of each class that the model is fitted on.
PER_CLASS = 1500
#: Share of labels never learnt from: crc32 of the id as text, modulo this, is 0.
FOLDS = 5
KEEP_FROM = 0.3

#: Kinds of bytes: 0 A-Z, 1 a-z, 2 digits, 3 other ASCII, 4 the rest.
_KIND = np.full(256, 3, np.uint8)
for _from, _to, _kind in ((48, 57, 2), (65, 90, 0), (97, 122, 1), (128, 255, 4)):
    _KIND[_from : _to + 1] = _kind
_STOP = np.zeros(256, bool)
_STOP[[33, 44, 46, 58, 59, 63]] = True


def word_shapes(span: words.Span, hashes: np.ndarray) -> np.ndarray:
    """A small number for how each word is written."""
    kind = _KIND[span.data]
    counts = []
    for k in range(5):
        sums = np.zeros(len(kind) + 1, np.int32)
        np.cumsum(kind == k, out=sums[1:])
        counts.append(sums[span.end] - sums[span.first])
    upper, lower, digit, symbol, other = counts
    initial = kind[span.first] == 0
    capitals = np.select([upper == 0, (upper == 1) & initial & (lower + other > 0), (lower == 0) & (upper > 1)], [0, 1, 2], 3)
    marks = np.select([symbol == 0, symbol > 1, _STOP[span.data[span.end - 1]]], [0, 3, 1], 2)
    letters = upper + lower + other > 0
    content = np.select([letters & (digit == 0), letters, digit > 0], [0, 3, 1], 2)
    same = np.zeros(len(hashes), np.int64)
    same[1:] = (hashes[1:] == hashes[:-1]) & (span.doc[1:] == span.doc[:-1])
    return ((capitals * 4 + marks) * 4 + content) * 2 + same


def ngrams(x: np.ndarray, doc: np.ndarray, n: int, salt: int) -> np.ndarray:
    """``doc << bits | dimension`` of the n-grams of ``x`` inside documents."""
    count = len(x) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += words.mixed(x[k : k + count] + np.uint64(salt * 100 + k))
    keys = (doc[:count].astype(np.int64) << DIMENSION_BITS) | (total >> np.uint64(64 - DIMENSION_BITS)).astype(np.int64)
    return keys[doc[:count] == doc[n - 1 :]]


def span_features(span: words.Span) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row inside the span, dimension) pairs, sorted."""
    hashes = span.hashes()
    doc = span.doc - span.rows.start
    shape = words.mixed(word_shapes(span, hashes).astype(np.uint64) + np.uint64(77)) if len(hashes) else hashes
    keys = np.unique(np.concatenate([ngrams(hashes, doc, 1, 1)] + [ngrams(shape, doc, n, 1 + n) for n in (1, 2, 3)]))
    return keys >> DIMENSION_BITS, keys & (DIMENSIONS - 1)


def text_features(texts: pa.Array, features=span_features) -> list[np.ndarray]:
    """Dimensions of each text."""
    out = []
    for span in words.spans(texts):
        row, dimension = features(span)
        out += np.split(dimension, np.searchsorted(row, np.arange(1, len(span.rows))))
    return out


def held_out(doc_id: Column, folds=FOLDS) -> Column:
    return F.crc32(doc_id.cast("string")) % folds == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class=PER_CLASS, folds=FOLDS) -> DataFrame:
    """``text`` and ``label`` of at most ``per_class`` learnable rows of each class."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds))
    usable = usable.groupBy("doc_id").agg(F.min(label).alias("label"))
    chosen = [usable.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    picked = chosen[0].unionByName(chosen[1])  # bounded: 2 * per_class ids
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # rows that share an id give one text, so the sample stays bounded
    return found.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text")).select("text", "label")


def train(features, texts: list[str], labels: np.ndarray, dimensions=DIMENSIONS) -> linear.Model:
    """Model of a bounded sample; calibrated on margins of held-back thirds."""
    found = features(pa.array(texts, pa.large_string()))
    if len(set(labels.tolist())) < 2:
        return linear.Model(np.zeros((2, dimensions)), 0.0, 0.0, 0.0)
    margins = np.zeros(len(found))
    fold = np.arange(len(found)) % 3
    for k in range(3):
        inside = np.flatnonzero(fold != k)
        if len(set(labels[inside].tolist())) < 2:
            continue
        own = [found[i] for i in inside]
        ratio = linear.log_ratio(own, labels[inside], dimensions)
        weights, bias = linear.descend(own, labels[inside], ratio)
        margins[fold == k] = linear.margins_of([found[i] for i in np.flatnonzero(fold == k)], weights, ratio) + bias
    ratio = linear.log_ratio(found, labels, dimensions)
    weights, bias = linear.descend(found, labels, ratio)
    slope, shift = linear.logistic(margins, labels)
    return linear.Model(np.stack([weights * ratio, ratio * ratio]), bias, slope, shift)


def fit(sample: DataFrame, features=text_features) -> bytes:
    """Fit in one task on a bounded sample; the packed model (about 2 MB)."""

    def learn(frames):
        rows = pd.concat([pd.DataFrame({"text": [], "label": []}), *frames])
        rows = rows.sort_values("text", na_position="first").reset_index(drop=True)
        texts = [t if isinstance(t, str) else "" for t in rows["text"]]
        model = train(features, texts, rows["label"].to_numpy(np.int64))
        packed = zlib.compress(np.concatenate([[model.bias, model.slope, model.shift], model.weights.ravel()]).astype(np.float32).tobytes(), 1)
        yield pd.DataFrame({"model": [packed]})

    row = sample.coalesce(1).mapInPandas(learn, "model binary").first()
    return row["model"] if row else next(learn([]))["model"][0]  # no partition at all: no labels


def scorer(packed: bytes, features=text_features):
    """Arrow function from texts to scores (0 to 1)."""

    def score(texts: pa.Array) -> pa.Array:
        raw = np.frombuffer(zlib.decompress(packed), np.float32).astype(np.float64)
        bias, slope, shift = raw[:3]
        model = linear.Model(raw[3:].reshape(2, -1), bias, slope, shift)
        return pa.array(model.scores(model.margins(features(texts))), pa.float64())

    return F.arrow_udf(score, "double")


def score_quality(docs: DataFrame, labels: DataFrame, per_class=PER_CLASS) -> DataFrame:
    """``docs`` with ``score``, the estimated probability of ``labels.quality`` 1."""
    packed = fit(labelled_sample(docs, labels, "quality", per_class))
    return docs.withColumn("score", scorer(packed)(F.col("text").cast("string")))


def op4_quality(spark, sf_dir) -> DataFrame:
    """Contract query: quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))
