"""SimHash near-duplicates found with pivot distance tables.

Every distinct fingerprint gets a row in a table of its Hamming distances to many reference
fingerprints (pivots). By the triangle inequality, two fingerprints within k bits differ by at most k in
each of these coordinates, so a pair whose largest coordinate difference is above k is discarded
without comparing the fingerprints; what survives is verified bit by bit.

The coordinates alone would halve the pairs with every pivot but still look at all of them. So pairs are
formed in buckets first: cut into 2 * k blocks of bits, fingerprints within k bits agree in k blocks
at least, and each choice of k blocks is a bucket key. This loses no link. A bucket that holds more than
``BUCKET`` fingerprints is dealt out as pairs of its chunks, so it is neither capped nor put into one
task; a task hands on a spanning forest of the links it verified instead of all pairs.

Defined cases: a null, empty or blank text has fingerprint 0, linked like any other; fewer words than
a shingle has make one shingle; equal rows share a fingerprint and a component; a null doc_id is listed
but never names a component (null if the component has no other id); no rows give no rows; extra
columns are ignored by ``components`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import fresh, materialise

BITS = 64
#: Reference fingerprints in the table.
PIVOTS = 16
#: Fingerprints of one bucket that one task compares at most; larger buckets are dealt out by chunks.
BUCKET = 1024
#: Rows of a bucket or chunk whose pairs are verified at a time.
BATCH = 256
SEED = 42

c = F.col


def fingerprint(text: str | None, shingle: int) -> int:
    """A bit is set if it is set in over half of the shingles' XXH64."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    one, n, total = xxhash.xxh64_intdigest, len(starts), np.zeros(BITS, np.int64)
    ends = ends[k - 1 :].tolist()
    for at in range(0, n, 1 << 15):  # bounds the table of bits
        hashes = np.array([one(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)], strict=True)], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, tie, fp): tie tells rows of one id apart by their text, fp is the fingerprint as a signed long."""

    def work(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], np.uint64).view(np.int64))

    hashed = F.pandas_udf(work, "long")
    return docs.select("doc_id", F.xxhash64("text").alias("tie"), hashed(c("text")).alias("fp"))


def pivot_distances(fp: Column) -> Column:
    """The table's row: distances to the pivots, one byte each."""
    # pivots are hashes of 1..PIVOTS: half of their bits differ from one another
    each = [F.lpad(F.hex(F.bit_count(fp.bitwiseXOR(F.xxhash64(F.lit(i))))), 2, "0") for i in range(1, PIVOTS + 1)]
    return F.unhex(F.concat(*each))


def _masks(max_bits: int) -> list[int]:
    """Each choice of ``max_bits`` of 2 * max_bits blocks of bits, as signed 64-bit masks."""
    blocks = max(2 * max_bits, 1)
    borders = [round(i * BITS / blocks) for i in range(blocks + 1)]
    block = [sum(1 << b for b in range(borders[i], borders[i + 1])) for i in range(blocks)]
    masks = [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), max(max_bits, 1))]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _forest(fps: np.ndarray, tables: np.ndarray, left: np.ndarray, right: np.ndarray, labels: np.ndarray, max_bits: int) -> np.ndarray:
    """Discards, verifies and merges the given pairs; labels become the smallest place each place is linked to."""
    near = np.abs(tables[left] - tables[right]).max(axis=1) <= max_bits
    left, right = left[near], right[near]
    near = np.bitwise_count(fps[left] ^ fps[right]) <= max_bits
    left, right = left[near], right[near]
    while True:
        # only roots may be hooked: a place with others behind it would be cut off from its own root
        while (labels != labels[labels]).any():
            labels = labels[labels]
        one, two = labels[left], labels[right]
        if (one == two).all():
            return labels
        np.minimum.at(labels, np.maximum(one, two), np.minimum(one, two))


def _compare(max_bits: int):
    """Buckets (arrays of fp and table, and of side for a pair of chunks) to links (a, b) of a spanning forest."""

    def links_of(bucket_fps, bucket_tables, sides) -> tuple[np.ndarray, np.ndarray]:
        fps = np.asarray(bucket_fps, np.int64).view(np.uint64)
        tables = np.frombuffer(b"".join(bucket_tables), np.uint8).reshape(len(fps), -1).astype(np.int16)
        labels = np.arange(len(fps))
        if sides is None:
            order = np.argsort(tables[:, 0], kind="stable")
            upto = np.searchsorted(tables[order, 0], tables[order, 0] + max_bits, "right")  # partners by the first coordinate
            for at in range(0, len(fps), BATCH):
                counts = np.maximum(upto[at : at + BATCH] - np.arange(at + 1, at + 1 + len(upto[at : at + BATCH])), 0)
                left = np.repeat(np.arange(at, at + len(counts)), counts)
                right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(counts) - counts, counts)
                labels = _forest(fps, tables, order[left], order[right], labels, max_bits)
        else:
            one, two = np.flatnonzero(np.asarray(sides) == 0), np.flatnonzero(np.asarray(sides) == 1)
            for at in range(0, len(one), BATCH):
                labels = _forest(fps, tables, np.repeat(one[at : at + BATCH], len(two)), np.tile(two, len(one[at : at + BATCH])), labels, max_bits)
        linked = np.flatnonzero(labels != np.arange(len(fps)))
        return fps[linked].view(np.int64), fps[labels[linked]].view(np.int64)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [links_of(f, t, s) for f, t, s in zip(batch["fps"], batch["tables"], batch["sides"], strict=True)]
            a, b = ([np.concatenate(x) for x in zip(*found, strict=True)]) if found else (np.array([], np.int64),) * 2
            yield pd.DataFrame({"a": a, "b": b})

    return work


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between the distinct fingerprints (column fp) that join all that are within ``max_bits``."""
    tabled = materialise(distinct.select("fp", pivot_distances(c("fp")).alias("table")))
    keys = F.array(*(F.struct(F.lit(i).alias("k"), c("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(_masks(max_bits))))
    keyed = tabled.select("fp", "table", F.inline(keys))
    sizes = keyed.groupBy("k", "bits").agg(F.count("*").alias("n")).filter(c("n") > 1)
    sizes = materialise(sizes)
    shared = keyed.join(sizes, ["k", "bits"])
    plain = shared.filter(c("n") <= BUCKET).groupBy("k", "bits").agg(F.collect_list("fp").alias("fps"), F.collect_list("table").alias("tables"))
    plain = plain.select("fps", "tables", F.lit(None).cast("array<int>").alias("sides"))
    # a large bucket: chunk i meets every chunk j >= i, itself once
    chunks = F.ceil(c("n") / (BUCKET // 2))
    chunked = shared.filter(c("n") > BUCKET).withColumns({"chunks": chunks, "chunk": F.pmod(F.xxhash64("fp", F.lit(7)), chunks)})
    chunked = chunked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), c("chunks") - 1)))
    pair = {"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other"), "side": (c("chunk") > c("other")).cast("int")}
    dealt = chunked.withColumns(pair).groupBy("k", "bits", "i", "j").agg(
        F.collect_list("fp").alias("fps"), F.collect_list("table").alias("tables"), F.collect_list("side").alias("sides")
    )
    dealt = dealt.select("fps", "tables", F.when(c("i") < c("j"), c("sides")).alias("sides"))
    return plain.unionByName(dealt).mapInPandas(_compare(max_bits), "a long, b long").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Alternating large and small stars: every node hands its larger, then its smaller neighbours to the
    smallest one it knows, until all hang on their root. Minima are combined on the map side; the joins
    split hot nodes. Only counts come to the driver.
    """
    now = materialise(edges.filter(c("a") != c("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(c("b").alias("a"), c("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), c("a")).alias("m"))
        large = both.filter(c("b") > c("a")).join(least, "a").select(c("b").alias("a"), c("m").alias("b")).filter(c("a") != c("b")).distinct()
        large = materialise(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(c("a"), c("m").alias("b")), F.struct(c("b").alias("a"), c("m").alias("b")))).alias("e"))
        now = materialise(small.select("e.*").filter(c("a") != c("b")).distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            return now.select(c("a").alias("node"), c("b").alias("root"))
        seen = state


def components(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Per row: doc_id, tie, fp, root (a fingerprint of the component), component_id (its smallest doc_id)."""
    rows = materialise(fingerprints(docs, shingle))
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = materialise(links(distinct, max_bits))
    rooted = distinct.join(roots(linked).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    found = components(docs, shingle, max_bits)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id."""
    found = materialise(components(docs, shingle, max_bits))
    key, turn = (fresh(n, docs.columns) for n in ("key", "turn"))
    best = found.groupBy("root").agg(F.min(F.struct(c("doc_id").isNull().alias("last"), "doc_id", "tie")).alias("best"))
    named = lambda doc_id, tie: F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), tie.cast("string"))
    keep = best.select(named(c("best.doc_id"), c("best.tie")).alias(key))
    rows = docs.withColumn(key, named(c("doc_id"), F.xxhash64("text"))).join(keep, key, "left_semi")
    # equal rows are copies of one another, too
    rows = rows.withColumn(turn, F.row_number().over(W.partitionBy(key).orderBy(key))).filter(c(turn) == 1)
    return rows.select(*(c(f"`{n}`") for n in docs.columns))
