"""Periodic runs of words by the branching-tandem test of an enhanced suffix array.

A run is a stretch of words with smallest period q that neither neighbour extends, at least ``min_length``
words and ``min_periods`` periods long. Tasks read whole documents and need no shuffle.

Words that occur fewer than ``min_periods`` times in their document can't lie in a run, so a document falls
into stretches between them, and stretches shorter than ``min_length`` hold none. The other stretches of
some documents, each closed by a symbol of its own, make one enhanced suffix array: suffix array, its
inverse, and LCP values, from names of the strings of 1, 2, 4, .. words at every place. The LCP intervals
come from next smaller values, no tree is built. For an interval of depth d, every suffix i outside its
largest child checks whether the suffix i + d (i - d) lies in the interval but not in the same child: then
a square of period d starts at i (at i - d) that can't be rotated to the right. It is rotated to the left as
far as the words agree, which is read from the names, and the rotations of a square are a run. Multiples of
a period give the same run, so the smallest is kept. Skipping largest children bounds the checks by n log n.

Defined cases: a null or empty text has no words and no runs; texts of any length are read whole; a document
of one repeated word is one run; repeated rows are documents of their own; no rows give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in one suffix array, and words held at a time, about; a longer document is taken alone.
ARRAY_WORDS, HELD_WORDS = 1 << 18, 1 << 20
#: Suffixes checked at a time.
CHECKED = 1 << 21

Rewrite = Callable[[object, list], list]


def names_by_length(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and for k = 0, 1, .. a name of the 2^k symbols at each place, until all names differ.

    Names are equal where the strings are. The last symbol must occur once.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    first = np.concatenate(([True], symbols[order][1:] != symbols[order][:-1]))
    name = np.empty(n, np.int64)
    name[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, step = [name.astype(np.int32)], 1
    while True:
        tied = ~first
        tied[:-1] |= ~first[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            return order, levels
        places = order[slots]
        key = name[places] * n + name[places + step]  # a repeated string never holds the last symbol
        sort = np.argsort(key, kind="stable")
        places, key = places[sort], key[sort]
        order[slots] = places
        first[slots] = np.concatenate(([True], key[1:] != key[:-1]))
        name[places] = np.maximum.accumulate(np.where(first[slots], slots, 0))
        levels.append(name.astype(np.int32))
        step *= 2


def common_after(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that agree from the places ``a`` and ``b`` (all different) on."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 2, -1, -1):
        length += (levels[k][a + length] == levels[k][b + length]) * (1 << k)
    return length


def common_before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that agree in front of the places ``a`` < ``b``."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 2, -1, -1):
        step = 1 << k
        at = a - length - step
        fits = at >= 0
        at = np.maximum(at, 0)
        length += (fits & (levels[k][at] == levels[k][b - a + at])) * step
    return length


def _smaller_before(h: np.ndarray) -> np.ndarray:
    """For each positive value the place of the nearest smaller one before it; the first value is 0."""
    at = np.maximum(np.arange(len(h)) - 1, 0)
    live = np.flatnonzero((h > 0) & (h[at] >= h))
    while len(live):
        at[live] = at[at[live]]  # everything passed over is at least as large
        live = live[h[at[live]] >= h[live]]
    return at


def branching_squares(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(start, period) of the squares of period up to ``longest`` that can't be rotated to the right, and the names.

    The last symbol must occur once.
    """
    n = len(symbols)
    order, levels = names_by_length(symbols)
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    lcp = np.zeros(n + 1, np.int64)  # lcp[i] belongs to the slots i - 1 and i
    lcp[1:n] = common_after(levels, order[:-1], order[1:])
    left = _smaller_before(lcp)
    right = n - _smaller_before(lcp[::-1])[::-1]
    splits = np.flatnonzero((lcp > 0) & (lcp <= longest))
    none = np.zeros(0, np.int64)
    if not len(splits):
        return none, none, levels
    # splits with the same bounds cut one interval into its children
    interval = left[splits] * (n + 1) + right[splits]
    splits = splits[np.argsort(interval, kind="stable")]
    interval = np.sort(interval, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], interval[1:] != interval[:-1])))
    number = np.cumsum(np.concatenate(([True], interval[1:] != interval[:-1]))) - 1
    first = heads + np.arange(len(heads))  # the first child of each interval
    starts = np.empty(len(splits) + len(heads), np.int64)
    starts[first] = left[splits[heads]]
    starts[np.arange(len(splits)) + number + 1] = splits
    of = np.repeat(np.arange(len(heads)), np.diff(np.concatenate((first, [len(starts)]))))
    ends = np.append(starts[1:], 0)
    last = np.append(first[1:], len(starts)) - 1
    ends[last] = right[splits[heads]]
    sizes = ends - starts
    largest = np.flatnonzero(sizes == np.maximum.reduceat(sizes, first)[of])
    small = np.ones(len(starts), bool)
    small[largest[np.concatenate(([True], of[largest][1:] != of[largest][:-1]))]] = False
    child = np.flatnonzero(small)
    found = []
    upto = np.cumsum(sizes[child])
    for a, b in _portions(upto, CHECKED):
        some = child[a:b]
        length = sizes[some]
        c = np.repeat(some, length)
        begin = np.cumsum(length) - length
        place = order[np.repeat(starts[some] - begin, length) + np.arange(len(c))]
        depth = lcp[splits[heads]][of[c]]
        lo, hi = starts[first][of[c]], ends[last][of[c]]
        for shift in (depth, -depth):
            other = place + shift
            inside = (other >= 0) & (other < n)
            where = slot[np.where(inside, other, 0)]
            hit = inside & (where >= lo) & (where < hi) & ((where < starts[c]) | (where >= ends[c]))
            found.append(np.stack((np.minimum(place, other)[hit], depth[hit])))
    squares = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    return squares[0], squares[1], levels


def _portions(upto: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of items whose running total ``upto`` grows by about ``size`` each."""
    at = 0
    while at < len(upto):
        end = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, "right"))
        yield at, max(end, at + 1)
        at = max(end, at + 1)


def runs_of(symbols: np.ndarray, longest: int) -> np.ndarray:
    """(start, end, period) of all runs with at least two periods, as columns, by start and end."""
    start, period, levels = branching_squares(symbols, longest)
    if not len(start):
        return np.zeros((3, 0), np.int64)
    begin = start - common_before(levels, start, start + period)
    end = start + 2 * period
    by = np.lexsort((period, end, begin))  # a run's smallest period first
    begin, end, period = begin[by], end[by], period[by]
    new = np.concatenate(([True], (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])))
    return np.stack((begin[new], end[new], period[new]))


class _Held:
    """Documents of a task until their stretches fill a suffix array."""

    def __init__(self, min_length: int, min_periods: int):
        self.min_length, self.min_periods = min_length, min_periods
        self.clear()

    def clear(self) -> None:
        self.docs: list[tuple[object, list[bytes]]] = []
        self.words = self.symbols = self.base = 0
        self.parts: list[np.ndarray] = []
        self.places: list[tuple[int, int, int]] = []  # begin among the symbols, document, first word

    def add(self, doc_id, words: list[bytes]) -> None:
        self.docs.append((doc_id, words))
        self.words += len(words) + 1
        if len(words) < self.min_length:
            return
        seen: dict[bytes, int] = {}
        ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
        often = (np.bincount(ids) >= self.min_periods)[ids]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], often.view(np.int8), [0]))))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= self.min_length:
                self.places.append((self.symbols, len(self.docs) - 1, a))
                closing = self.base + len(seen) + len(self.places)
                self.parts.append(np.append(ids[a:b] + self.base, closing))
                self.symbols += b - a + 1
        self.base += len(seen) + len(self.places) + 1  # symbols of different documents differ

    def runs(self) -> list[list[tuple[int, int, int]]]:
        """Per document (start, length, period) by start, then period."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in self.docs]
        if self.parts:
            longest = max(len(p) - 1 for p in self.parts) // self.min_periods
            begin, end, period = runs_of(np.concatenate(self.parts), longest)
            length = end - begin
            kept = (length >= self.min_length) & (length >= self.min_periods * period)
            at = np.searchsorted([p[0] for p in self.places], begin[kept], "right") - 1
            for i, s, n, q in zip(at.tolist(), begin[kept].tolist(), length[kept].tolist(), period[kept].tolist(), strict=True):
                place, doc, word = self.places[i]
                out[doc].append((s - place + word, n, q))
        return [sorted(found, key=lambda r: (r[0], r[2])) for found in out]

    def rows(self, kind: pa.DataType) -> pa.RecordBatch:
        found = self.runs()
        texts = [b" ".join(collapsed(words, runs)).decode() for (_, words), runs in zip(self.docs, found, strict=True)]
        runs_ = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
        columns = {
            "doc_id": pa.array([d for d, _ in self.docs], kind), "n_words": pa.array([len(w) for _, w in self.docs], pa.int64()),
            "runs": pa.array(runs_, pa.list_(RUN)), "collapsed": pa.array(texts, pa.string()),
        }
        self.clear()
        return pa.RecordBatch.from_pydict(columns)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, dropped in zip(words, np.cumsum(change).tolist(), strict=False) if not dropped]


def periodic_runs(docs: DataFrame, min_length: int = 24, min_periods: int = 3, rewrite: Rewrite | None = None) -> DataFrame:
    """Per document: doc_id, n_words, runs (array of start, length, period) and the text with its runs collapsed.

    Words are split at ASCII white space and numbered from 0. ``rewrite`` changes a document's list of
    words (UTF-8) before they are searched. A run keeps its first period.
    """
    key = "string" if docs.schema["doc_id"].dataType.simpleString() == "string" else "long"
    kind = pa.string() if key == "string" else pa.int64()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(min_length, min_periods)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                held.add(doc_id, rewrite(doc_id, words) if rewrite else words)
                if held.symbols >= ARRAY_WORDS or held.words >= HELD_WORDS:
                    yield held.rows(kind)
        if held.docs:
            yield held.rows(kind)

    return docs.select(F.col("doc_id").cast(key), "text").mapInArrow(
        work, f"doc_id {key}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
