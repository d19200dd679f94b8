"""Approximate nearest neighbours: a hash-prefix forest.

A tree gives every vector a long string of hash bits (the sides of random hyperplanes, orthogonal
within a tree); a block of vectors keeps, for each of its trees, its strings in a sorted array. A query
descends every tree by binary search to the vectors that share its longest prefix, then ascends all
trees together, one bit at a time, until they hold enough candidates: ``share`` of the block. The
candidates' inner products are computed exactly.

Largest inner product is turned into smallest angle by one more component: vectors are scaled by the
longest and filled up to length 1, queries get a 0 there.

Each block is searched for every query, so all rows are indexed and recall does not depend on how many
blocks there are. ``share`` is high because a hash can tell neighbours apart from the rest only as far
as they are nearer: where the 20th neighbour is hardly nearer than the thousandth, fewer candidates
lose recall.

Defined cases: vectors that are null, empty, zero or hold null or non-finite parts take no part, nor
do rows without an id; rows that repeat an id are candidates and queries each, and leave out only
themselves; vectors of different lengths aren't compared; equal vectors tie by id; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import vectors as V
from tickerloom.llm.common import materialise

#: Trees, and bits of a hash string.
TREES, HASH_BITS = 64, 32
#: Vectors of a block, queries of a block.
BLOCK, QUERIES = 8192, 2048
#: Candidates the trees have to hold together, counted with repeats, as a share of the block.
SHARE = 1.2

c = F.col


@cache
def planes(dim: int) -> np.ndarray:
    """(dim, TREES * HASH_BITS) normals of hyperplanes; those of a tree are orthogonal as far as they can be."""
    random = np.random.default_rng(dim)
    trees = []
    for _ in range(TREES):
        normals = []
        while sum(n.shape[1] for n in normals) < HASH_BITS:
            normals.append(np.linalg.qr(random.standard_normal((dim, dim)))[0])
        trees.append(np.concatenate(normals, axis=1)[:, :HASH_BITS])
    return np.concatenate(trees, axis=1)


def hash_strings(x: np.ndarray) -> np.ndarray:
    """(rows, TREES): the hash strings as numbers, first bit highest."""
    sides = (x @ planes(x.shape[1]) > 0).reshape(len(x), TREES, HASH_BITS)
    weights = 1 << np.arange(HASH_BITS - 1, -1, -1, dtype=np.int64)
    return (sides * weights).sum(axis=2)


def filled_up(x: np.ndarray, longest: float) -> np.ndarray:
    scaled = x / longest
    return np.concatenate((scaled, np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))[:, None]), axis=1)


def build_forest(x: np.ndarray, ids: list, longest: float) -> dict:
    strings = hash_strings(filled_up(x, longest))
    order = np.argsort(strings, axis=0, kind="stable")
    return {"x": x, "rough": (x / longest).astype(np.float32), "ids": ids, "order": order.astype(np.int32), "sorted": np.take_along_axis(strings, order, axis=0)}


def prefix_ranges(forest: dict, strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries, TREES) first and past-the-last places that share ``length`` bits with each query."""
    low = strings >> (HASH_BITS - length) << (HASH_BITS - length)
    high = low + ((1 << (HASH_BITS - length)) - 1)
    trees = range(TREES)
    first = np.stack([np.searchsorted(forest["sorted"][:, t], low[:, t], "left") for t in trees], axis=1)
    last = np.stack([np.searchsorted(forest["sorted"][:, t], high[:, t], "right") for t in trees], axis=1)
    return first, last


def search(forest: dict, q: np.ndarray, k: int, share: float) -> list[list[tuple[float, tuple]]]:
    """Per query the k best (score, holder) among its candidates."""
    x, ids = forest["x"], forest["ids"]
    # a vector counts once a tree, so this many hold k different ones at least
    enough = min(max(share * len(x), TREES * k), TREES * len(x))
    unit = q / np.sqrt((q * q).sum(axis=1))[:, None]
    strings = hash_strings(np.concatenate((unit, np.zeros((len(q), 1))), axis=1))
    first, last = np.zeros((len(q), TREES), np.int64), np.zeros((len(q), TREES), np.int64)
    # descend to the longest prefixes, then give up one bit in all trees at a time
    waiting = np.arange(len(q))
    for length in range(HASH_BITS, -1, -1):
        lo, hi = prefix_ranges(forest, strings[waiting], length)
        first[waiting], last[waiting] = lo, hi
        waiting = waiting[(hi - lo).sum(axis=1) < enough]
        if not len(waiting):
            break
    out, orders = [], list(np.ascontiguousarray(forest["order"].T))
    for i in range(len(q)):
        mark = np.zeros(len(x), bool)
        mark[np.concatenate([order[a:b] for order, a, b in zip(orders, first[i].tolist(), last[i].tolist(), strict=True)])] = True
        near = np.flatnonzero(mark)
        if len(near) > k:  # single precision settles which are far below the k-th
            rough = forest["rough"][near] @ unit[i].astype(np.float32)
            near = near[rough >= np.partition(rough, -k)[-k] - 1e-4]
        # one order of additions for all rows, so that equal vectors have equal scores
        exact = (x[near] * q[i]).sum(axis=1)
        best = sorted((-s, j) for s, r in zip(exact.tolist(), near.tolist(), strict=True) for j in ids[r])[:k]
        out.append([(-s, j) for s, j in best])
    return out


def nearest(rows: DataFrame, k: int, every: int, share: float = SHARE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for the rows whose id is divisible by ``every``."""
    usable = V.usable(rows, id_col, vector_col).filter(F.exists("vector", lambda x: x != 0))
    doubles = materialise(usable)
    once = materialise(V.held_once(doubles, k))
    queries = materialise(V.query_rows(doubles, once, every))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x))
    longest = {r["dim"]: r["longest"] for r in once.groupBy("dim").agg(F.max(length).alias("longest")).collect()}
    blocked, blocks = V.blocks_of(once, c("dim"), BLOCK, 1)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        x = V.matrix(frame["vector"], np.float64)
        forest = build_forest(x, V.holders(frame), longest[x.shape[1]])
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "forest": [pickle.dumps(forest)]})

    forests = materialise(blocked.groupBy("block").applyInPandas(build, "block int, forest binary"))
    asked = once.join(queries.select("vid").distinct(), "vid", "left_semi").select("vid", "vector", "dim")
    dealt, query_blocks = V.blocks_of(asked, c("dim"), QUERIES, 2)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        packed = (frame["vid"].to_numpy(), V.matrix(frame["vector"], np.float64))
        return pd.DataFrame({"asked": [frame["block"].iloc[0]], "queries": [pickle.dumps(packed)]})

    packed = materialise(dealt.groupBy("block").applyInPandas(pack, "asked int, queries binary"))

    def look(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(mine) and len(theirs):
            vids, q = pickle.loads(theirs["queries"].iloc[0])
            for vid, best in zip(vids.tolist(), search(pickle.loads(mine["forest"].iloc[0]), q, k + 1, share), strict=True):
                found += [(vid, *i, s) for s, i in best]
        kinds = {"vid": "int64", "id": "int64", "row": "int64", "score": "float64"}
        return pd.DataFrame(found, columns=list(kinds)).astype(kinds)

    left = V.pairs(forests, blocks, "block", query_blocks, "asked").groupBy("block", "asked")
    right = V.pairs(packed, query_blocks, "asked", blocks, "block").groupBy("block", "asked")
    return V.ranked(left.cogroup(right).applyInPandas(look, "vid long, id long, row long, score double"), queries, k)
