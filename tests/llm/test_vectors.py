"""Both vector searches against brute force."""

import math
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tickerloom.llm import hash_forest, mtree, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, dim, seed, start=0):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((6, dim))
    x = centres[random.integers(0, 6, n)] + 0.6 * random.standard_normal((n, dim))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    return [(start + i, [float(v) for v in row], 0) for i, row in enumerate(x)]


ODD = [
    (1, None, 0), (2, [], 0), (3, [0.5, None, 0.5], 0), (4, [math.nan, 0.0, 1.0], 0), (5, [math.inf, 0.0, 1.0], 0),
    (None, [1.0, 0.0, 0.0], 0), (0, [0.0, 0.0, 0.0], 0), (100, [1.0, 0.0, 0.0], 0), (100, [1.0, 0.0, 0.0], 0), (101, [1.0, 0.0, 0.0], 0),
    (102, [0.5, 0.5, 0.0], 0), (103, [-1.0, 0.25, 0.0], 0), (200, [1.0, 2.0], 0), (201, [2.0, 1.0], 0),
]


def plain(rows, k, every, score, zero=True):
    """Per query id the (vec_id, score) of all its rows, by rank; a row leaves out itself only."""
    kept = [(i, v) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))]
    out = defaultdict(list)
    for n, (q, mine) in enumerate(kept):
        if q % every == 0:
            scored = sorted((-score(mine, v), i) for m, (i, v) in enumerate(kept) if m != n and len(v) == len(mine))
            out[q] += [(rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return {q: [(i, s) for _, i, s in sorted(found)] for q, found in out.items()}


def floored(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=True))


def dot(a, b):
    return float(np.dot(np.array(a, float), np.array(b, float)))


def by_query(frame):
    out = defaultdict(list)
    for r in frame.collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    for found in out.values():
        ranks = Counter(rank for rank, *_ in found)
        assert sorted(ranks) == list(range(1, max(ranks) + 1))
    return {q: [(i, s) for _, i, s in sorted(found)] for q, found in out.items()}


REPEATED = [(100, [1.0, 0.0], 0), (7, [0.0, 1.0], 0), (7, [1.0, 0.0], 0), (8, [0.5, 0.0], 0), (200, [0.0, 1.0], 0), (200, [1.0, 0.0], 0), (200, [1.0, 0.0], 0)]


def test_rows_that_repeat_an_id_are_all_candidates_and_queries(spark, tmp_path):
    frame = spark.createDataFrame(REPEATED, SCHEMA)
    got = by_query(mtree.top_k(frame, 3, 100))
    assert got == plain(REPEATED, 3, 100, floored)
    assert got[100] == [(7, 65536), (200, 65536), (200, 65536)] and len(got[200]) == 9
    near = by_query(hash_forest.nearest(frame, 3, 100))
    assert near == plain(REPEATED, 3, 100, dot, zero=False)
    # and the DuckDB twin agrees
    rows = vectors(60, 4, 9) + [(i % 20 * 5, v, 0) for i, v, _ in vectors(60, 4, 10)] + [(50, [0.5] * 4, 0)] * 9
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(queries.ORACLES["op5_mtree_top_k"]).fetchall()
    found = queries.QUERIES["op5_mtree_top_k"](spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, found)) == sorted(want)


@pytest.mark.parametrize("page,leaf", [(4096, 64), (60, 5)])
def test_mtree_is_exact(spark, monkeypatch, page, leaf):
    monkeypatch.setattr(mtree, "PAGE", page)
    monkeypatch.setattr(mtree, "LEAF", leaf)
    monkeypatch.setattr(mtree, "QUERIES", 7)
    rows = vectors(500, 8, 1) + [(1000 + i, [0.25] * 8, 0) for i in range(90)] + vectors(40, 5, 2, 2000) + ODD
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "vector").repartition(3)
    assert by_query(mtree.top_k(frame, 5, 50)) == {q: r for q, r in plain(rows, 5, 50, floored).items() if r}


def test_mtree_takes_large_components(spark, monkeypatch):
    """Components of 2,048 and more, up to products that neither doubles nor longs hold with room to spare."""
    monkeypatch.setattr(mtree, "PAGE", 60)
    monkeypatch.setattr(mtree, "QUERIES", 3)
    some = [[5000.0] + [0.25] * 7, [-5000.0] * 8, [2048.0] + [0.0] * 7, [0.0, 3e9] + [0.5] * 6, [0.0] * 7 + [100000.0]]
    rows = vectors(200, 8, 1) + [(1000 + 25 * i + j, v, 0) for i, v in enumerate(some) for j in ([0] if v[1] == 3e9 else range(3))]
    rows += [(3000 + i, [5000.0 + i // 2, 1.0], 0) for i in range(9)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = {q: r for q, r in plain(rows, 5, 50, floored).items() if r}
    assert by_query(mtree.top_k(frame, 5, 50)) == want and want[0][0][0] >= 1000
    only = spark.createDataFrame(rows[-9:], SCHEMA)
    assert by_query(mtree.top_k(only, 5, 50)) == plain(rows[-9:], 5, 50, floored)


@pytest.mark.parametrize("size", [1 << 19, 1 << 28, 1 << 40])
def test_scores_are_exact_at_any_size(size):
    random = np.random.default_rng(1)
    q, x = random.integers(-size, size, (3, 8)), random.integers(-size, size, (5, 8))
    want = [[sum(int(a) * int(b) for a, b in zip(r, s, strict=True)) for s in x] for r in q]
    assert mtree.exact_scores(q.astype(float), x.astype(float)).tolist() == want


def test_mtree_skips_by_its_bounds():
    """Far clusters: a query that knows its bound computes scores in its own cluster's leaves only."""
    random = np.random.default_rng(0)
    x = np.concatenate([np.eye(16)[i] * 1000 + random.integers(-20, 20, (64, 16)) for i in range(16)])
    page = mtree.build_page(x, [[i] for i in range(len(x))], x.mean(axis=0))
    exact = np.sort(x @ x[0])[::-1][:3].astype(int)
    scores, rows = mtree.search_page(page, x[:1], np.array([-np.inf]), 3)
    assert scores[0].tolist() == exact.tolist() and (x[rows[0]] @ x[0]).astype(int).tolist() == exact.tolist()
    page["x"][64:] = 10**6  # entries that must not be looked at
    assert mtree.search_page(page, x[:1], np.array([exact[-1]]), 3)[0][0].tolist() == exact.tolist()


def test_forest_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], 0) for r in table.collect()]
    want, got = plain(rows, 20, 20, dot, zero=False), by_query(hash_forest.nearest(table, 20, 20))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    vector = {i: v for i, v, _ in rows}
    assert all(abs(s - dot(vector[q], vector[i])) < 1e-12 for q in got for i, s in got[q])


def test_forest_copies_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hash_forest, "BLOCK", 100)
    monkeypatch.setattr(hash_forest, "QUERIES", 7)
    rows = vectors(300, 8, 5, 5000) + [(1000 + i, rows_copy, 0) for i, rows_copy in enumerate([[0.5, 0.5, 0.5, 0.5, 0.0, 0.0, 0.0, 0.0]] * 120)] + ODD
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "ids").repartition(3)
    want, got = plain(rows, 20, 20, dot, zero=False), by_query(hash_forest.nearest(frame, 20, 20))
    assert got.keys() == {q for q, r in want.items() if r}
    assert [i for i, _ in got[1000]] == list(range(1001, 1021))
    assert [i for i, _ in got[100]] == [100, 100, 101, 101, 102, 102, 103, 103] and [i for i, _ in got[200]] == [201]
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in got)
    assert hits / sum(len(want[q]) for q in got) >= 0.9


def test_longest_common_prefix_first():
    """Descending finds the vectors with the query's longest prefix; ascending only adds to them."""
    random = np.random.default_rng(4)
    x = random.standard_normal((200, 6))
    forest = hash_forest.build_forest(x, [[i] for i in range(200)], 10.0)
    strings = hash_forest.hash_strings(hash_forest.filled_up(x[:5], 10.0))
    before = None
    for length in range(hash_forest.HASH_BITS, -1, -1):
        first, last = hash_forest.prefix_ranges(forest, strings, length)
        assert (first < last).all()
        if before is not None:
            assert (first <= before[0]).all() and (last >= before[1]).all()
        before = first, last
    assert (before[0] == 0).all() and (before[1] == 200).all()


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mtree.top_k(none, 5, 50).count() == 0 and hash_forest.nearest(none, 20, 20).count() == 0
    useless = spark.createDataFrame(ODD[:6], SCHEMA)
    assert mtree.top_k(useless, 5, 50).count() == 0 and hash_forest.nearest(useless, 20, 20).count() == 0
