"""Repeated passages found with run-length indexes.

Marks every byte covered by a string of ``length`` bytes that also starts anywhere else in the corpus.

Routing. Of every window of ``length`` bytes, the sub-string of half the length with the lowest hash is
its anchor; equal windows have equal anchors at equal offsets, so they meet by anchor. Neighbouring
windows with the same anchor form a piece. An anchor that occurs once ends there, which leaves a small
part of the corpus. Equal pieces are counted (by anchor and piece hash, on the map side): all of their
windows are repeated. A piece that occurs once but shares its anchor with other pieces is open.

Index. Open pieces and one copy of each piece they could match are gathered in groups of some hundred
kilobytes by anchor. A group's text is suffix-sorted and kept as a run-compressed Burrows-Wheeler transform with
samples at run ends. Inside a run, neighbours in the suffix order stay neighbours one byte earlier in the
text, so the longest match of a position with its predecessor (and its successor) is the one of the
position before, less one; it is compared byte by byte only at run starts (run ends). Streaming the
matching statistics in text order gives the longest match of every position, and windows are marked
where it reaches ``length``.

An anchor shared by more than ``BUSY`` different pieces (the edges of a passage that very many documents
hold) isn't gathered whole. Its pieces are sliced by their windows' distance to the anchor, slices are routed
by the bytes all of their windows share, and the steps above are taken with the slices as pieces; where
that isn't enough, with thinner slices, down to single windows, which are counted.

Defined cases: a null or empty text has no bytes; texts shorter than ``length`` keep all bytes; equal
texts of ``length`` bytes or more are removed whole, all of them; overlapping repeats within a document
count; a cut may fall inside a character; repeated rows are documents of their own; no rows give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import materialise

#: Bytes of a text that are hashed at a time.
SEGMENT = 1 << 20
#: Bytes of text in one index, about; different pieces of an anchor that are gathered at most.
GROUP, BUSY = 1 << 17, 512
#: Rows a Python task hands on at a time.
ROWS = 4096
#: Windows of a slice, from one step to the next.
SLICES = (16, 4, 1)

c = F.col
U = np.uint64


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(31))) * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(29)
    return h * U(0x94D049BB133111EB)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the bytes; powers of an odd base and of its inverse modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    n = SEGMENT + (1 << 16)
    values = _mixed(np.arange(1, 257, dtype=np.uint64) * U(base))
    up = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, base, np.uint64))).astype(np.uint64))
    down = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, pow(base, -1, 1 << 64), np.uint64))).astype(np.uint64))
    return values, up, down


def anchored_pieces(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, last, anchor, place) of the pieces of ``data``: windows start..last have the anchor at ``place`` in common."""
    gram = length // 2
    width = length - gram + 1  # anchors to choose from in a window
    found = []
    values, up, down = _powers()
    for at in range(0, len(data) - length + 1, SEGMENT):
        part = np.frombuffer(data, np.uint8, min(SEGMENT + length - 1, len(data) - at), at)
        n = len(part)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[part] * up[:n], out=sums[1:])
        hashes = _mixed((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        # the leftmost minimum of each window: ranges of doubling size, then two that overlap
        low, place, size = hashes, np.arange(len(hashes), dtype=np.int32), 1
        while 2 * size <= width:
            left = low[:-size] <= low[size:]
            low, place, size = np.where(left, low[:-size], low[size:]), np.where(left, place[:-size], place[size:]), 2 * size
        if size < width:
            shift = width - size
            place = np.where(low[:-shift] <= low[shift:], place[:-shift], place[shift:])
        starts = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
        lasts = np.concatenate((starts[1:], [len(place)])) - 1
        found.append((starts + at, lasts + at, hashes[place[starts]].view(np.int64), place[starts] + at))
    if not found:
        return (np.array([], np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes of ``symbols`` (below 512) in order, and the first seven symbols at each place."""
    n = len(symbols)
    padded = np.concatenate((symbols.astype(np.int64), np.zeros(7, np.int64)))
    seven = np.zeros(n, np.int64)
    for i in range(7):
        seven = (seven << 9) | padded[i : i + n]
    order = np.argsort(seven, kind="stable")
    fresh = np.concatenate(([True], seven[order][1:] != seven[order][:-1]))
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0))
    step = 7
    while True:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        slots = np.flatnonzero(tied)  # slots of suffixes that have the same prefix so far as a neighbour
        if not len(slots):
            return order, seven
        places = order[slots]
        behind = np.where(places + step < n, rank[np.minimum(places + step, n - 1)] + 1, 0)
        key = rank[places] * (n + 1) + behind
        sort = np.argsort(key, kind="stable")
        places, key = places[sort], key[sort]
        order[slots] = places
        first = np.concatenate(([True], key[1:] != key[:-1]))
        fresh[slots] = first
        rank[places] = np.maximum.accumulate(np.where(first, slots, 0))
        step *= 2


def _common(seven: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``one`` and ``two``."""
    n = len(seven)
    out, live = np.zeros(len(one), np.int64), np.arange(len(one))
    a, b = one.copy(), two.copy()
    while len(live):
        x = seven[np.minimum(a, n - 1)] ^ seven[np.minimum(b, n - 1)]
        differ = (x != 0) | (a >= n) | (b >= n)
        same = 6 - np.floor(np.log2(np.maximum(x[differ], 1).astype(np.float64))).astype(np.int64) // 9
        out[live[differ]] += np.where(x[differ] != 0, same, 0)
        live, a, b = live[~differ], a[~differ] + 7, b[~differ] + 7
        out[live] += 7
    return out


def longest_matches(symbols: np.ndarray) -> np.ndarray:
    """For each place the length of the longest string there that also starts elsewhere in ``symbols``.

    Built from the run-compressed transform: samples at run starts and run ends, streamed in text order.
    """
    n = len(symbols)
    if n < 2:
        return np.zeros(n, np.int64)
    order, seven = suffix_order(symbols)
    transform = symbols[order - 1]
    heads = np.concatenate(([True], (transform[1:] != transform[:-1]) | (order[1:] == 0) | (order[:-1] == 0)))
    tails = np.concatenate((heads[1:], [True]))
    out = np.zeros(n, np.int64)
    for ends, shift in ((heads, -1), (tails, 1)):
        slots = np.flatnonzero(ends)
        beside = slots + shift
        inside = (beside >= 0) & (beside < n)
        sample = np.zeros(len(slots), np.int64)
        sample[inside] = _common(seven, order[slots[inside]], order[beside[inside]])
        at = np.full(n, -1)
        value = np.zeros(n, np.int64)
        value[order[slots]] = sample
        at[order[slots]] = order[slots]
        last = np.maximum.accumulate(at)
        here = np.arange(n)
        out = np.maximum(out, np.where(last >= 0, value[last] - (here - last), 0))
    return out


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of set marks."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def keep_rest(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs of them, and what is left of ``data`` without the spans."""
    order = np.argsort(starts, kind="stable")
    starts, reached = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate(([True], starts[1:] > reached[:-1]))  # spans that touch are one run
    starts, ends = starts[first].tolist(), reached[np.concatenate((first[1:], [True]))].tolist()
    kept = [data[a:b] for a, b in zip([0, *ends], [*starts, len(data)], strict=True)]
    return sum(ends) - sum(starts), len(starts), b"".join(kept)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a 128-bit key of the text in two longs."""
    text = F.coalesce(c("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


KEY = ["k1", "k2"]


def pieces(keyed: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start, more, anchor, piece): ``more`` windows follow the first; piece is the hash of all their bytes."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        one = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows = []
            for k1, k2, text in zip(batch["k1"], batch["k2"], batch["text"], strict=True):
                data = text.encode()
                starts, lasts, anchors, _ = anchored_pieces(data, length)
                n = len(starts)
                hashes = np.array([one(data[a:b]) for a, b in zip(starts.tolist(), (lasts + length).tolist(), strict=True)], np.uint64).view(np.int64)
                rows.append((np.full(n, k1), np.full(n, k2), starts, lasts - starts, anchors, hashes))
            if rows:
                columns = [np.concatenate(x) for x in zip(*rows, strict=True)]
                yield pd.DataFrame(dict(zip(("k1", "k2", "start", "more", "anchor", "piece"), columns, strict=True)))

    long = keyed.filter(F.octet_length("text") >= length).select(*KEY, "text")
    return long.mapInPandas(work, "k1 long, k2 long, start long, more int, anchor long, piece long")


def _open_matches(length: int):
    """Groups of pieces (k1, k2, start, more, open, data) to the spans (k1, k2, start, end) of repeated windows."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([*KEY, "start"])
        sizes = np.array([len(d) for d in frame["data"]])
        begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        symbols = np.zeros(int((sizes + 1).sum()), np.int16)  # 0 ends a piece
        for begin, data in zip(begins.tolist(), frame["data"], strict=True):
            symbols[begin : begin + len(data)] = np.frombuffer(data, np.uint8)
            symbols[begin : begin + len(data)] += 1
        marked = longest_matches(symbols) >= length
        out = []
        for begin, k1, k2, start, more, is_open in zip(begins.tolist(), frame["k1"], frame["k2"], frame["start"], frame["more"], frame["open"], strict=True):
            if is_open:
                out += [(k1, k2, start + a, start + b + length) for a, b in _runs(marked[begin : begin + more + 1])]
        return pd.DataFrame(out, columns=["k1", "k2", "start", "end"]).astype("int64")

    return work


def _cut(length: int):
    """Texts with their pieces (arrays of start, more, anchor, open, busy) to the pieces' bytes, some thousand rows at a time."""
    columns = ["k1", "k2", "start", "more", "anchor", "open", "busy", "data"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k1, k2, text, *wanted in zip(*(batch[x] for x in ("k1", "k2", "text", "start", "more", "anchor", "open", "busy")), strict=True):
                data = text.encode()
                for start, more, anchor, is_open, busy in zip(*(w.tolist() for w in wanted), strict=True):
                    out.append((k1, k2, start, more, anchor, is_open, busy, data[start : start + more + length]))
                    if len(out) >= ROWS:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
            yield pd.DataFrame(out, columns=columns)

    return work


def _sliced(length: int, size: int):
    """Pieces to slices of windows at ``size`` neighbouring distances from the anchor, routed by what these share.

    ``place`` is where the anchor stands in the piece, if known.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        one = xxhash.xxh3_64_intdigest
        for batch in batches:
            out = []
            columns = ("k1", "k2", "start", "more", "open", "place", "data")
            for k1, k2, start, more, is_open, place, data in zip(*(batch[x] for x in columns), strict=True):
                if place < 0:
                    place = int(anchored_pieces(data, length)[3][0])
                for number in range((place - more) // size, place // size + 1):
                    near, far = number * size, number * size + size - 1  # distances of the slice's windows
                    first, last = max(0, place - far), min(more, place - near)
                    shared = one(data[place - near : place - far + length], number)
                    part = data[first : last + length]
                    out.append((k1, k2, start + first, last - first, is_open, place - first, part, shared, one(part, 1)))
            frame = pd.DataFrame(out, columns=[*columns, "anchor", "piece"])
            for name in ("anchor", "piece"):
                frame[name] = frame[name].to_numpy(np.uint64).view(np.int64)
            yield frame

    return work


def _busy_spans(pieces_: DataFrame, length: int, sizes: tuple[int, ...] = SLICES) -> DataFrame:
    """(k1, k2, start, end) of the repeated windows in open pieces, by slices of the first of ``sizes``."""
    schema = "k1 long, k2 long, start long, more int, open boolean, place int, data binary, anchor long, piece long"
    slices = materialise(pieces_.select(*KEY, "start", "more", "open", "place", "data").mapInPandas(_sliced(length, sizes[0]), schema))
    # an open piece stands for itself, another one for the several that are equal to it
    times = F.sum(F.when(c("open"), 1).otherwise(2))
    different = materialise(slices.groupBy("anchor", "piece").agg(times.alias("n"), F.min(F.struct(*KEY, "start")).alias("rep")))
    settled = slices.filter("open").join(different.filter(c("n") > 1), ["anchor", "piece"], "left_semi")
    spans = settled.select(*KEY, "start", (c("start") + c("more") + length).alias("end"))
    if len(sizes) == 1:
        return spans
    contested = _contested(different)
    named = different.join(contested, "anchor").select("anchor", "piece", "busy", (c("n") == 1).alias("open"), "rep")
    rest = slices.drop("open").join(named, ["anchor", "piece"]).filter(F.struct(*KEY, "start") == c("rep")).dropDuplicates(["anchor", "piece"])
    rest = materialise(rest.drop("rep"))
    spans = spans.unionByName(_indexed_spans(rest.filter(~c("busy")), length))
    return spans.unionByName(_busy_spans(rest.filter("busy"), length, sizes[1:])) if rest.filter("busy").limit(1).count() else spans


def _contested(different: DataFrame) -> DataFrame:
    """(anchor, busy) of the anchors of (anchor, piece, n) with a piece that occurs once beside another piece."""
    per_anchor = different.groupBy("anchor").agg(F.count("*").alias("pieces"), F.count(F.when(c("n") == 1, 1)).alias("open_pieces"))
    return materialise(per_anchor.filter((c("pieces") > 1) & (c("open_pieces") > 0)).select("anchor", (c("pieces") > BUSY).alias("busy")))


def _indexed_spans(gathered: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start, end) of the repeated windows in open pieces, by an index of each group of anchors."""
    size = gathered.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    grouped = gathered.withColumn("group", F.pmod(F.xxhash64("anchor"), F.lit(int(size // GROUP) + 1)))
    return grouped.groupBy("group").applyInPandas(_open_matches(length), "k1 long, k2 long, start long, end long")


def repeated_spans(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, start, end): spans that cover the repeated bytes of each text, and the texts that have any."""
    keyed = _keyed(docs)
    # written once: the anchors of the whole corpus, then only those that occur again
    every = materialise(pieces(keyed, length))
    again = materialise(every.groupBy("anchor").agg(F.count("*").alias("n")).filter(c("n") > 1).select("anchor"))
    shared = materialise(every.join(again, "anchor", "left_semi"))

    rep = F.struct(*KEY, "start", "more")
    different = materialise(shared.groupBy("anchor", "piece").agg(F.count("*").alias("n"), F.min(rep).alias("rep")))
    wanted = different.join(_contested(different), "anchor").select("rep.*", "anchor", (c("n") == 1).alias("open"), "busy")
    wanted = materialise(wanted.groupBy(*KEY).agg(F.collect_list(F.struct("start", "more", "anchor", "open", "busy")).alias("wanted")))

    settled = different.filter(c("n") > 1).select("anchor", "piece")
    settled = shared.join(settled, ["anchor", "piece"], "left_semi").select(*KEY, "start", (c("start") + c("more") + length).alias("end"))
    settled = materialise(settled.distinct())

    # texts that may lose bytes, each once; only they are looked at again
    named = materialise(settled.select(*KEY).unionByName(wanted.select(*KEY)).distinct())
    texts = materialise(keyed.groupBy(*KEY).agg(F.first("text").alias("text")).join(named, KEY))
    parts = ("start", "more", "anchor", "open", "busy")
    cut = texts.join(wanted, KEY).select(*KEY, "text", *(c(f"wanted.{x}").alias(x) for x in parts)).mapInPandas(
        _cut(length), "k1 long, k2 long, start long, more int, anchor long, open boolean, busy boolean, data binary"
    )
    cut = materialise(cut)
    spans = settled.unionByName(_indexed_spans(cut.filter(~c("busy")), length))
    if cut.filter("busy").limit(1).count():
        spans = spans.unionByName(_busy_spans(cut.filter("busy").withColumn("place", F.lit(-1)), length))
    return spans, texts


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that are left)."""
    spans, texts = repeated_spans(docs, length)
    lists = materialise(spans.groupBy(*KEY).agg(F.collect_list(F.struct("start", "end")).alias("spans")))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k1, k2, text, starts, ends in zip(*(batch[x] for x in ("k1", "k2", "text", "start", "end")), strict=True):
                removed, runs, kept = keep_rest(text.encode(), starts, ends)
                out.append((k1, k2, removed, runs, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["k1", "k2", "n_removed", "n_spans", "kept"])

    found = texts.join(lists, KEY).select(*KEY, "text", c("spans.start").alias("start"), c("spans.end").alias("end"))
    changed = found.mapInPandas(work, "k1 long, k2 long, n_removed long, n_spans long, kept string")
    keyed = _keyed(docs).select("doc_id", *KEY, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return keyed.join(materialise(changed), KEY, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept", "whole").alias("kept_sha256"),
    )
