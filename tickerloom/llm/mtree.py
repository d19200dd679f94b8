"""Exact top-k by inner product: best-first search in an M-tree of paged nodes.

The tree has three levels. Routing objects, chosen far apart from a bounded sample, split the space;
each takes the vectors nearest to it, in pages of about ``PAGE`` vectors (a routing object with more has
more pages). A page is a node written as one row: leaves of about ``LEAF`` entries, each leaf with its
own routing object, covering radius and distance to the page's routing object, each entry with its
distance to the leaf's, sorted.

For a query q and an object o with everything below it within r, no inner product exceeds
<q, o> + |q| * r. Applied to a page, to a leaf through its stored parent distance (before <q, o> of the
leaf is computed), to the leaf itself and to its entries through theirs, it avoids computing what can't
enter the result. Every query takes its best unvisited leaf at each step; queries that took the same
leaf are answered together. A first round searches the page a query lies in, which gives it the k-th
best score so far; the second round takes all pages to all blocks of queries under that bound.

Scores are integers: components x count as floor(scale * x). The tree is exact as long as these are below
``LARGEST``. Vectors with a larger one stay out of it: as candidates they meet all queries, as queries all
vectors, block by block, in numbers wide enough for the products.

Defined cases: vectors that are null, empty or hold null or non-finite parts take no part, nor do rows
without an id; of rows with one id the smallest vector counts; vectors of different lengths aren't
compared; equal vectors tie by id; a score beyond a long fails; no rows give no rows; extra columns are
ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm import vectors as V
from tickerloom.llm.common import materialise

#: Vectors of a page, entries of a leaf, queries of a block.
PAGE, LEAF, QUERIES = 4096, 64, 2048
#: Routing objects at the top, and the sample per dimension they are chosen from.
ROUTES, SAMPLE = 32, 2048
#: Floored components are below it; products of 512 of them are exact.
LARGEST = 1 << 19

#: What a search hands on: the query's vector, the row found (its id, its number), the score.
FOUND, FOUND_SQL = ["vid", "id", "row", "score"], "vid long, id long, row long, score long"

c = F.col


def routing_objects(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the sample, each the farthest from those before it."""
    chosen, gap = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _nearest(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    return ((to * to).sum(axis=1)[None, :] - 2 * x @ to.T).argmin(axis=1)


def build_page(x: np.ndarray, ids: list, route: np.ndarray) -> dict:
    """A page over the rows of ``x``; ``ids`` are the id lists of the rows, in order of their first ids."""
    objects = routing_objects(x[:: max(1, len(x) // 512)], -(-len(x) // LEAF))
    own = _nearest(x, objects)
    leaves = []
    for i, o in enumerate(objects):
        rows = np.flatnonzero(own == i)
        if not len(rows):
            continue
        gap = np.sqrt(((x[rows] - o) ** 2).sum(axis=1))
        order = np.argsort(gap, kind="stable")
        leaves.append({"object": o, "radius": gap.max(), "parent": np.sqrt(((o - route) ** 2).sum()), "rows": rows[order], "gaps": gap[order]})
    radius = np.sqrt(((x - route) ** 2).sum(axis=1)).max()
    return {"route": route, "radius": radius, "leaves": leaves, "x": x.astype(np.int32), "ids": ids}


def search_page(page: dict, q: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``q`` the k best (score, row of the page) by score, then row; -1 rows fill up.

    ``bound`` is the score a result must reach to matter.
    """
    x, leaves, size = page["x"].astype(np.float64), page["leaves"], len(page["x"])
    none = -(1 << 62)
    # score and row in one number that sorts as the result does
    best = np.full((len(q), k), none)
    bound = bound.astype(np.float64).copy()
    norm = np.sqrt((q * q).sum(axis=1)) * (1 + 1e-9) + 1e-9
    to_route = q @ page["route"]
    reach = np.array([leaf["parent"] + leaf["radius"] for leaf in leaves]) + 1e-6
    # first by the stored parent distances alone
    upper = to_route[:, None] + norm[:, None] * np.minimum(reach, page["radius"] + 1e-6)[None, :]
    alive = upper >= bound[:, None]
    to_leaf = np.full(upper.shape, -np.inf)
    for j, leaf in enumerate(leaves):
        rows = np.flatnonzero(alive[:, j])
        if len(rows):
            to_leaf[rows, j] = q[rows] @ leaf["object"]
            upper[rows, j] = np.minimum(upper[rows, j], to_leaf[rows, j] + norm[rows] * (leaf["radius"] + 1e-6))
    upper[~alive] = -np.inf
    order = np.argsort(-upper, axis=1, kind="stable")
    active = np.arange(len(q))
    for step in range(len(leaves)):
        took = order[active, step]
        go = upper[active, took] >= bound[active]
        active, took = active[go], took[go]
        if not len(active):
            break
        for j in np.unique(took):
            rows, leaf = active[took == j], leaves[j]
            # entries come by rising distance: those too near the object to reach the bound are skipped
            least = ((bound[rows] - to_leaf[rows, j]) / norm[rows]).min() - 1e-6
            entries = leaf["rows"][np.searchsorted(leaf["gaps"], least) :]
            if not len(entries):
                continue
            scores = np.rint(q[rows] @ x[entries].T).astype(np.int64) * size + (size - 1 - entries)[None, :]
            merged = np.concatenate((best[rows], scores), axis=1)
            top = -np.partition(-merged, k - 1, axis=1)[:, :k] if merged.shape[1] > k else merged
            best[rows, : top.shape[1]] = top
            full = top.min(axis=1)
            reached = np.where(full == none, -np.inf, np.floor_divide(full, size).astype(np.float64))
            bound[rows] = np.maximum(bound[rows], reached)
    best = -np.sort(-best, axis=1)
    scores = np.where(best == none, none, np.floor_divide(best, size))
    return scores, np.where(best == none, -1, size - 1 - np.mod(best, size))


def _results(page: dict, vids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int) -> pd.DataFrame:
    scores, rows = search_page(page, q, bound, k + 1)
    out = []
    for vid, score, row in zip(vids.tolist(), scores, rows, strict=True):
        mine = [(-int(s), i) for s, r in zip(score, row, strict=True) if r >= 0 for i in page["ids"][r]]
        out += [(vid, *i, -s) for s, i in sorted(mine)[: k + 1]]
    return pd.DataFrame(out, columns=FOUND).astype("int64")


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """q @ x.T of whole numbers of any size, without rounding."""
    most = float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1]
    if most < 1 << 53:
        return np.rint(q @ x.T).astype(np.int64)
    if most < 1 << 62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    whole = lambda m: np.array([[int(v) for v in row] for row in m], object)
    return whole(q) @ whole(x).T


def compare_all(candidates: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(vid, id, row, score): the best of ``candidates`` (vid, vector, dim, ids, rows) for each of ``asked`` (vid, vector, dim), by blocks of both."""
    left, left_blocks = V.blocks_of(candidates, c("dim").cast("long"), PAGE, 3)
    right, right_blocks = V.blocks_of(asked, c("dim").cast("long"), QUERIES, 4)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vid")
        ids = V.holders(frame) if "ids" in frame else None
        packed = (frame["vid"].tolist(), V.matrix(frame["vector"], np.float64), ids)
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "packed": [pickle.dumps(packed)]})

    def look(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(mine) and len(theirs):
            (_, x, ids), (vids, q, _) = (pickle.loads(f["packed"].iloc[0]) for f in (mine, theirs))
            for at in range(0, len(q), 64):
                for vid, scores in zip(vids[at : at + 64], exact_scores(q[at : at + 64], x), strict=True):
                    few = np.argsort(-scores, kind="stable")[: k + 1]
                    best = sorted((-int(scores[r]), i) for r in few for i in ids[r])[: k + 1]
                    out += [(vid, *i, -s) for s, i in best]
        return pd.DataFrame(out, columns=FOUND).astype("int64")

    left = materialise(left.groupBy("block").applyInPandas(pack, "block int, packed binary"))
    right = materialise(right.groupBy("block").applyInPandas(pack, "block int, packed binary")).withColumnRenamed("block", "asked")
    spread = V.pairs(left, left_blocks, "block", right_blocks, "asked"), V.pairs(right, right_blocks, "asked", left_blocks, "block")
    one, two = (f.groupBy("block", "asked") for f in spread)
    return one.cogroup(two).applyInPandas(look, FOUND_SQL)


def top_k(rows: DataFrame, k: int, every: int, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): exact, for the rows whose id is divisible by ``every``."""
    parts = F.transform("vector", lambda x: F.floor(x * scale))
    usable = materialise(V.usable(rows, id_col, vector_col))
    small = F.forall("vector", lambda x: F.abs(x) < LARGEST / scale)
    ints = materialise(usable.filter(small).select("id", "row", parts.cast("array<int>").alias("vector")))
    once = materialise(V.held_once(ints, k))
    queries = materialise(V.query_rows(ints, once, every))

    # routing objects by dimension, from a bounded sample
    turn = F.row_number().over(W.partitionBy("dim").orderBy(F.xxhash64("vid"), "vid"))
    sample: dict[int, list] = {}
    for r in once.withColumn("turn", turn).filter(c("turn") <= SAMPLE).orderBy("dim", "turn").collect():
        sample.setdefault(r["dim"], []).append(r["vector"])
    routes = {dim: routing_objects(np.array(v, np.float64), ROUTES) for dim, v in sample.items()}

    @F.pandas_udf("long")
    def route_of(vector: pd.Series) -> pd.Series:
        out = np.zeros(len(vector), np.int64)
        dims = vector.map(len).to_numpy()
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            out[at] = dim * ROUTES + _nearest(V.matrix(vector.iloc[at], np.float64), routes[int(dim)])
        return pd.Series(out)

    routed, page_blocks = V.blocks_of(materialise(once.withColumn("route", route_of("vector"))), c("route"), PAGE, 1)
    routed = materialise(routed)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vid")
        route = int(frame["route"].iloc[0])
        x = V.matrix(frame["vector"], np.float64)
        page = build_page(x, V.holders(frame), routes[route // ROUTES][route % ROUTES])
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "page": [pickle.dumps(page)]})

    pages = materialise(routed.groupBy("block").applyInPandas(build, "block int, page binary"))
    asked = queries.select("vid").distinct()
    asked = materialise(routed.select("vid", "vector", "dim", "block").join(asked, "vid", "left_semi"))

    def at_home(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(theirs):
            return pd.DataFrame([], columns=FOUND).astype("int64")
        q = V.matrix(theirs["vector"], np.float64)
        return _results(pickle.loads(mine["page"].iloc[0]), theirs["vid"].to_numpy(), q, np.full(len(q), -np.inf), k)

    home = materialise(pages.groupBy("block").cogroup(asked.groupBy("block")).applyInPandas(at_home, FOUND_SQL))
    reached = home.groupBy("vid").agg(F.when(F.count("*") > k, F.min("score")).alias("bound"))
    bounded = asked.withColumnRenamed("block", "home").join(reached, "vid", "left")
    dealt, query_blocks = V.blocks_of(bounded, c("dim").cast("long"), QUERIES, 2)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        packed = (frame["vid"].to_numpy(), V.matrix(frame["vector"], np.float64), frame["bound"].fillna(-np.inf).to_numpy(float), frame["home"].to_numpy())
        return pd.DataFrame({"asked": [frame["block"].iloc[0]], "queries": [pickle.dumps(packed)]})

    packed = materialise(dealt.groupBy("block").applyInPandas(pack, "asked int, queries binary"))

    def elsewhere(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if len(mine) and len(theirs):
            vids, q, bound, homes = pickle.loads(theirs["queries"].iloc[0])
            away = homes != mine["block"].iloc[0]
            if away.any():
                return _results(pickle.loads(mine["page"].iloc[0]), vids[away], q[away], bound[away], k)
        return pd.DataFrame([], columns=FOUND).astype("int64")

    page_dims: dict[int, tuple[int, int]] = {}
    for name, (start, n) in page_blocks.items():
        lo, count = page_dims.get(name // ROUTES, (start, 0))
        page_dims[name // ROUTES] = (lo, count + n)
    spread_pages = V.pairs(pages, page_dims, "block", query_blocks, "asked")
    spread_queries = V.pairs(packed, query_blocks, "asked", page_dims, "block")
    far = spread_pages.groupBy("block", "asked").cogroup(spread_queries.groupBy("block", "asked")).applyInPandas(elsewhere, FOUND_SQL)
    best = home.unionByName(far)

    @F.pandas_udf("array<double>")
    def floors(vector: pd.Series) -> pd.Series:
        return vector.map(lambda v: np.floor(np.asarray(v, np.float64) * scale) + 0.0)

    large = materialise(usable.filter(~small).select("id", "row", floors("vector").alias("vector")))
    if large.isEmpty():
        return V.ranked(best, queries, k)
    large_once = materialise(V.held_once(large, k))
    large_queries = materialise(V.query_rows(large, large_once, every))
    large_asked = large_once.join(large_queries.select("vid").distinct(), "vid", "left_semi").select("vid", "vector", "dim")
    doubles = c("vector").cast("array<double>")
    best = best.unionByName(compare_all(large_once, asked.select("vid", doubles.alias("vector"), "dim"), k))
    everything = once.withColumn("vector", doubles).unionByName(large_once)
    return V.ranked(best.unionByName(compare_all(everything, large_asked, k)), queries.unionByName(large_queries), k)
