"""Words of Arrow text batches, hashed with numpy over the raw bytes.

Python never sees a single word: white space is found with a table lookup on
the UTF-8 bytes, and a word's hash is the difference of two prefix sums of a
polynomial in an odd base modulo 2^64, mixed afterwards. Batches are cut into
spans of documents of about ``SPAN`` bytes, so the working arrays stay small; a
single longer document makes a span of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPAN = 1 << 20
#: Odd base of the polynomial and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One random number a byte.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of both bases; kept between calls up to the length of an ordinary span."""
    global _powers, _inverses
    if len(_powers) < n:
        def table(base):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            return np.multiply.accumulate(steps)
        if n > 2 * SPAN:  # one very long document
            return table(BASE), table(INVERSE)
        _powers, _inverses = table(BASE), table(INVERSE)
    return _powers[:n], _inverses[:n]


@dataclass
class Span:
    """Some documents of a batch, one after the other.

    ``data``: their bytes; ``first``, ``end``: the bytes of each word; ``doc``: the
    row of the batch each word is of; ``rows``: the range of rows.
    """

    data: np.ndarray
    bounds: np.ndarray
    first: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    rows: range

    def hashes(self, fold=LOWER) -> np.ndarray:
        """Hash of each word after mapping its bytes through ``fold``."""
        return piece_hashes(fold[self.data], self.first, self.end)


def piece_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges ``first`` .. ``end``."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    return mixed((sums[end] - sums[first]) * inverse[first] + (end - first).astype(np.uint64))


def spans(texts: pa.Array) -> Iterator[Span]:
    """The texts of an Arrow string array (null: empty), span by span."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, offsets, values = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        stop = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + SPAN, side="right")) - 1)
        yield _span(data[bounds[begin] : bounds[stop]], bounds[begin : stop + 1] - bounds[begin], range(begin, stop))
        begin = stop


def _span(data: np.ndarray, bounds: np.ndarray, rows: range) -> Span:
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)  # where a document begins
    edge[bounds] = True
    before = np.concatenate([[False], inside[:-1]])
    first = np.flatnonzero(inside & (~before | edge))
    end = np.flatnonzero(before & (~inside | edge))
    doc = np.searchsorted(bounds, first, side="right") - 1
    return Span(data, bounds, first, end, doc + rows.start, rows)


def shingles(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` words inside a document, and their documents.

    A document with fewer words gives one hash of all of them."""
    n = len(hashes)
    if not n:
        return hashes, doc
    count = np.bincount(doc - doc[0])
    short = (count[doc - doc[0]] < width) if n else np.zeros(0, bool)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total[: n - k] += mixed(hashes[k:] + np.uint64((k + 1) * BASE & (1 << 64) - 1)) if k < n else 0
    whole = np.zeros(n, bool)
    if n >= width:
        whole[: n - width + 1] = doc[: n - width + 1] == doc[width - 1 :]
    if not short.any():
        return total[whole], doc[whole]
    few = np.flatnonzero(short & np.concatenate([[True], doc[1:] != doc[:-1]]))
    extra = np.empty(len(few), np.uint64)
    for j, at in enumerate(few):
        part = hashes[at : at + count[doc[at] - doc[0]]]
        extra[j] = mixed(np.array([sum(int(x) * pow(BASE, i + 7, 1 << 64) for i, x in enumerate(part)) % (1 << 64)], np.uint64))[0]
    out, of = np.concatenate([total[whole], extra]), np.concatenate([doc[whole], doc[few]])
    order = np.argsort(of, kind="stable")
    return out[order], of[order]


def distinct_by_doc(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs, sorted by both."""
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[keep], doc[keep]
