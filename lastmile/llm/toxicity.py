"""Operator 6: toxicity of texts restored by noisy-channel decoding.

1. Language model. Letter trigrams (UTF-8 bytes, A-Z folded) are counted over
   all texts: 64 symbols, 2^18 counters whatever the corpus.
2. Suspicious words are found with numpy on the raw bytes: words that hold both
   letters and digits or signs, a letter three times in a row, and runs of
   single letters, digits and signs that hold a letter ("s t u p 1 d").
3. Decoding. A suspicious word spans a lattice: a letter stays itself, or is
   dropped where it repeats the one before; a sign becomes one of the letters it
   stands for, or is dropped; in a run of single signs it may stand for itself as
   well, and a blank between them falls out, or stays and ends a word. Viterbi
   search finds the path of most probability under the channel costs and the
   language model, in time linear in the length of a word or run. A word whose
   signs cost less left as they are keeps its plain letters.
4. Score. The restored text's words (their letters only) and word beginnings are
   binary features of a Naive Bayes support vector model fitted on labels.

Scale, fitting and calibration are as in the quality classifier: a bounded sample
of labelled rows, one pass to count, one to score, no shuffle of texts.

Defined results: null and empty texts have no features and get the score of the
bias alone; without labels of both classes every score is 0.5; words and runs are
decoded whatever their length; repeated rows score alike; an empty table gives no
rows; other columns pass through, one named ``score`` is replaced.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm import counters, quality, words
from lastmile.llm.common import table, trimmed

SYMBOLS = 64
TRIGRAMS = SYMBOLS**3
TOXIC_FROM = 0.5
#: Letters that a digit or sign may stand for (fixed values).
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "*": "", "#": "", "%": ""}
#: Channel costs (natural logarithms): a sign read as a letter, a sign dropped, a
#: repeated letter dropped, once and from the third time on, a sign that stands for
#: itself (a boundary to the language model).
READ, DROP, MERGE, MERGE_RUN, ITSELF = 0.7, 8.0, 6.0, 0.5, 4.0

_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:256] = 27 + (np.arange(128, 256) & 31)
_LETTER = _SYMBOL > 0
_LETTER[65:91] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in STANDS_FOR]] = True
#: Bytes that may open and close a disguised word; others are punctuation there.
_OPENS, _CLOSES = _LETTER | _SIGN, _LETTER | _SIGN
_OPENS[[ord(c) for c in "*#%"]] = False
_CLOSES[[ord(c) for c in "*#%!"]] = False
#: What a sign may become, and its price: read, left as it is, or either.
_READ = {ord(sign): [(ord(c), READ) for c in letters] + [(None, DROP)] for sign, letters in STANDS_FOR.items()}
_LEFT = {sign: [(32, ITSELF)] for sign in _READ}
_EITHER = {sign: _READ[sign] + _LEFT[sign] for sign in _READ}
_STRETCHED = re.compile(rb"([a-z])\1{3,}")


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Letter trigrams of all texts (blanks and other signs are boundaries)."""

    def count(batches):
        counts = np.zeros(TRIGRAMS, np.uint32)
        for batch in batches:
            for span in words.spans(batch.column(0)):
                if len(span.data) < 3:
                    continue
                s = _SYMBOL[words.LOWER[span.data]].astype(np.int32)
                counts += np.bincount((s[:-2] << 12) | (s[1:-1] << 6) | s[2:], minlength=TRIGRAMS).astype(np.uint32)
        yield counters.parts_of(counts)

    return counters.total(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(trimmed(count), counters.SCHEMA), TRIGRAMS)


def language_model(counts: np.ndarray) -> np.ndarray:
    """Costs -log P(c | a, b), smoothed with shorter contexts; float32, 1 MB."""
    tri = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    bi = tri.sum(0)
    one = bi.sum(0)
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (bi + 20 * p1) / (bi.sum(1, keepdims=True) + 20)
    p3 = (tri + 20 * p2) / (tri.sum(2, keepdims=True) + 20)
    return -np.log(p3).astype(np.float32)


def search(elements: list[bytes], costs: np.ndarray, signs=_READ) -> tuple[float, bytes]:
    """Least cost and its letters (folded), by Viterbi search.

    ``signs`` has what a sign may become, and its price. Between two elements a blank falls out, or stays and ends a word."""
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    run, before = 0, -1
    for k, element in enumerate(elements):
        if k:
            for (a, b), (cost, path) in list(best.items()):
                if b:
                    state, total = (b, 0), cost + float(costs[a, b, 0])
                    if state not in best or total < best[state][0]:
                        best[state] = (total, (path, 32))
        for byte in element.translate(_FOLD):
            run = run + 1 if byte == before else 1
            before = byte
            if _LETTER[byte]:
                options = [(byte, 0.0)]
                if run > 1:
                    options.append((None, MERGE_RUN if run > 2 else MERGE))
            elif _SIGN[byte]:
                options = signs[byte]
            else:
                continue
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in best.items():
                for letter, price in options:
                    if letter is None:
                        state, total, out = (a, b), cost + price, path
                    else:
                        c = int(_SYMBOL[letter])
                        state, total, out = (b, c), cost + price + float(costs[a, b, c]), (path, letter)
                    if state not in following or total < following[state][0]:
                        following[state] = (total, out)
            best = following
    # a boundary ends the word
    cost, path = min(((cost + float(costs[a, b, 0]), path) for (a, b), (cost, path) in best.items()), key=lambda x: x[0])
    out = bytearray()
    while path:
        path, letter = path
        out.append(letter)
    return cost, bytes(out[::-1])


def decode(word: bytes, costs: np.ndarray) -> bytes:
    """Most probable letters of a word (folded)."""
    return search([word], costs)[1]


def decoded_or_plain(word: bytes, costs: np.ndarray) -> bytes:
    """Letters of a word, its signs read or left out, whichever costs less."""
    # letters beyond the third cost every path the same
    word = _STRETCHED.sub(rb"\1\1\1", word.translate(_FOLD))
    read = search([word], costs)
    if not any(byte in _READ for byte in word):
        return read[1]
    left = search([word], costs, _LEFT)
    return (read[1] if read[0] <= left[0] else left[1]).replace(b" ", b"")


_FOLD = bytes(words.LOWER)


def suspicious(span: words.Span) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Masks over the span's words: to be decoded, and single signs in a run; and
    where a word to be decoded begins and ends without punctuation."""
    data, first, end = span.data, span.first, span.end
    n = len(data)
    letter, sign = _LETTER[data], _SIGN[data]
    at = np.arange(n)
    begin = np.append(np.minimum.accumulate(np.where(_OPENS[data], at, n)[::-1])[::-1], n)[first]
    stop = np.append(-1, np.maximum.accumulate(np.where(_CLOSES[data], at, -1)))[end] + 1

    def within(mask):
        sums = np.zeros(n + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return (begin < stop) & (sums[np.maximum(begin, stop)] > sums[begin])

    folded = words.LOWER[data]
    same = np.zeros(n, bool)
    same[1:] = (folded[1:] == folded[:-1]) & letter[1:] & (data[1:] < 128)
    third = np.zeros(n, bool)
    third[2:] = same[2:] & same[1:-1]
    marked = within(letter) & (within(sign) | within(third))
    # one byte, or the two bytes of a Latin, Greek or Cyrillic letter
    size = end - first
    pair = (size == 2) & (data[first] >= 0xC3) & (data[first] < 0xD4)
    single = ((size == 1) & (letter | sign)[first]) | pair
    joined = np.zeros(len(first), bool)
    if len(first) >= 3:
        three = single[2:] & single[1:-1] & single[:-2] & (span.doc[2:] == span.doc[:-2])
        joined[2:] |= three
        joined[1:-1] |= three
        joined[:-2] |= three
    # runs of signs and digits alone are no words
    for i, j in _runs(span, joined):
        if not letter[first[i:j]].any():
            joined[i:j] = False
    return marked & ~joined, joined, begin, stop


def _runs(span: words.Span, joined: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words, each a run of single signs inside a document."""
    at = np.flatnonzero(joined)
    if not len(at):
        return []
    new = (np.diff(at) > 1) | (np.diff(span.doc[at]) > 0)
    return list(zip(at[np.concatenate([[True], new])].tolist(), (at[np.concatenate([new, [True]])] + 1).tolist()))


def _elements(span: words.Span, i: int, j: int) -> list[bytes]:
    return [span.data[a:b].tobytes() for a, b in zip(span.first[i:j], span.end[i:j])]


def restored_features(span: words.Span, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row inside the span, dimension) pairs of the restored text."""
    marked, joined, begin, stop = suspicious(span)
    row = span.doc - span.rows.start
    plain = ~marked & ~joined
    letter = _LETTER[span.data]
    at = np.zeros(len(span.data) + 1, np.int64)
    np.cumsum(letter, out=at[1:])
    keys = [_word_keys(words.LOWER[span.data[letter]], at[span.first[plain]], at[span.end[plain]], row[plain])]
    texts, of, known = [], [], {}
    for k in np.flatnonzero(marked):
        word = span.data[begin[k] : stop[k]].tobytes()
        if word not in known:
            known[word] = decoded_or_plain(word, costs)
        texts.append(known[word])
        of.append(row[k])
    for i, j in _runs(span, joined):
        decoded = search(_elements(span, i, j), costs, _EITHER)[1].split()
        texts += decoded
        of += [row[i]] * len(decoded)
    if texts:
        size = np.array([len(t) for t in texts])
        last = np.cumsum(size)
        keys.append(_word_keys(np.frombuffer(b"".join(texts), np.uint8), last - size, last, np.array(of)))
    found = np.unique(np.concatenate(keys))
    return found >> quality.DIMENSION_BITS, found & (quality.DIMENSIONS - 1)


def _word_keys(data: np.ndarray, first: np.ndarray, end: np.ndarray, row: np.ndarray) -> np.ndarray:
    """``row << bits | dimension`` of words and of their first 4 and 6 bytes."""
    keys = []
    for salt, most in ((1, None), (2, 4), (3, 6)):
        some = end - first > (most or 0)
        stop = end[some] if most is None else first[some] + most
        h = words.mixed(words.piece_hashes(data, first[some], stop) + np.uint64(salt))
        keys.append((row[some].astype(np.int64) << quality.DIMENSION_BITS) | (h >> np.uint64(64 - quality.DIMENSION_BITS)).astype(np.int64))
    return np.concatenate(keys)


@lru_cache(maxsize=2)
def _costs(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.float32).reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def feature_function(packed: bytes):
    """Features of texts under a packed language model."""

    def features(texts: pa.Array) -> list[np.ndarray]:
        costs = _costs(packed)
        return quality.text_features(texts, lambda span: restored_features(span, costs))

    return features


def packed_model(docs: DataFrame) -> bytes:
    return zlib.compress(language_model(trigram_counts(docs)).tobytes(), 1)


def restore(text: str, costs: np.ndarray) -> str:
    """A text with its suspicious words decoded (for inspection; folded)."""
    span = next(words.spans(pa.array([text])), None)
    if span is None:
        return ""
    marked, joined, begin, stop = suspicious(span)
    run = dict(_runs(span, joined))
    out, k = [], 0
    while k < len(marked):
        if k in run:
            out.append(search(_elements(span, k, run[k]), costs, _EITHER)[1].decode("utf-8", "replace"))
            k = run[k]
            continue
        if marked[k]:
            word = decoded_or_plain(span.data[begin[k] : stop[k]].tobytes(), costs)
        else:
            word = span.data[span.first[k] : span.end[k]].tobytes().translate(_FOLD)
        out.append(word.decode("utf-8", "replace"))
        k += 1
    return " ".join(out)


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class=quality.PER_CLASS) -> DataFrame:
    """``docs`` with ``score``, the estimated probability of ``labels.toxic`` 1."""
    features = feature_function(packed_model(docs))
    packed = quality.fit(quality.labelled_sample(docs, labels, "toxic", per_class), features)
    return docs.withColumn("score", quality.scorer(packed, features)(F.col("text").cast("string")))


def op6_toxicity(spark, sf_dir) -> DataFrame:
    """Contract query: toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
