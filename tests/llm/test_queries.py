"""Queries with a DuckDB twin, and the pipeline."""

import os
from collections import Counter, defaultdict

import duckdb
import pytest

import check
import corpus_pipeline
from tests.llm.test_learned import linked, plain_fingerprint
from tests.llm.test_native import base_spans
from tickerloom.llm import packing, queries
from tickerloom.session import scratch_scope


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, sf_dir, name):
    con = check.connect(sf_dir)
    frame = queries.QUERIES[name](spark, sf_dir)
    got = check.rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    text = queries.ORACLES[name]
    names = [r[0] for r in con.execute(f"DESCRIBE {text}").fetchall()]
    assert sorted(names) == sorted(frame.columns)
    assert got == check.rows_of(names, con.execute(text).fetchall())


def test_every_operator_has_a_query():
    assert [sum(q.startswith(f"op{n}_") for q in queries.QUERIES) for n in range(1, 14)] == [1] * 13


def test_pipeline_stages(spark, sf_dir, documents):
    docs, columns = documents, documents.columns
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir))
        assert docs.columns == columns, name
        sizes.append(docs.count())
    total = documents.count()
    assert 0.9 * total < sizes[0] <= total and sizes[1] < sizes[0] and sizes[2] == sizes[1]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    tokens = {r["doc_tokens"] for r in pieces.select("doc_id", "doc_tokens").distinct().collect()}
    assert tokens and pieces.select("doc_id").distinct().count() <= sizes[1]


def test_pipeline_on_odd_rows_and_none(spark, sf_dir, odd_docs, no_docs):
    """Ids 1 to 4 have no letter; equal rows and rows within 3 bits leave one; the secrets of 8 are masked; copies and pieces follow."""
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain = corpus_pipeline.materialise(stage(spark, plain, sf_dir))
        kept.append([(r["doc_id"], r["text"]) for r in plain.collect()])
    identified, deduplicated, masked, mixed = kept
    # a text of one repeated letter and one without labels may be told or not
    assert {None, 5, 6, 7, 10} <= {i for i, _ in identified} and not {1, 2, 3, 4} & {i for i, _ in identified}
    assert sorted(map(str, deduplicated)) == sorted(map(str, one_of_each_group(identified)))
    assert len(masked) == len(deduplicated) and all(t == "é😀 [SECRET] é😀 [SECRET]' secret=ab" for i, t in masked if i == 8)
    assert {t for i, t in masked if i != 8} == {t for i, t in deduplicated if i != 8} and set(mixed) <= set(masked)
    pieces = corpus_pipeline.STAGES[-1][1](spark, plain, sf_dir)
    assert pieces.filter("start = 0").count() == len(mixed)
    for _, stage in corpus_pipeline.STAGES:
        no_docs = corpus_pipeline.materialise(stage(spark, no_docs, sf_dir))
    assert no_docs.count() == 0


def test_pipeline_leaves_no_scratch_folder(spark, sf_dir, tmp_path):
    """Stages' own tables and inputs go as the run goes on, the last ones with the caller's scope."""
    scratch = f"{spark.conf.get('spark.checkpoint.dir')}/tickerloom"
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    with scratch_scope(spark):
        pieces = corpus_pipeline.run(spark, sf_dir)
        held = set(os.listdir(scratch)) - before
        pieces.write.parquet(str(tmp_path / "pieces"))
    assert 1 <= len(held) < 10 and set(os.listdir(scratch)) <= before
    assert spark.read.parquet(str(tmp_path / "pieces")).count() > 0


def one_of_each_group(rows):
    """The first of each group of linked fingerprints, by id (null first), equal rows being one."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    groups = linked([plain_fingerprint(text) for _, text in rows], 3)
    return [rows[i] for i in sorted(set(groups))]


def test_pipeline_against_plain_python(spark, tmp_path):
    """All stages but the model: groups, masks, copies and tokens from plain Python and the SQL of the mix."""
    texts = ["A river runs under the cold morning {0} and the house {0} stands by the green stone {0}", "Le moulin {0} de la vieille ville {0} tourne dans le vent {0} du soir"]
    rows = [(i, texts[i % 2].format(f"w{i}") + " more words here" * (i % 9), ("en", "fr")[i % 2], "abc"[i % 3]) for i in range(60)]
    rows += [(100 + i, rows[i][1], rows[i][2], "b") for i in range(0, 20, 3)]  # copies
    rows += [(200, "the secret=hunter2x and token: abc is known by all of them today", "en", "a"), (201, "... 12 34", "en", "a"), (202, None, "en", None)]
    docs = spark.createDataFrame([(i, t, la, s, len(t or "")) for i, t, la, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    told = {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path)).collect()}
    assert len(told) > 50 and not {201, 202} & told
    left = one_of_each_group([(i, t) for i, t, *_ in rows if i in told])
    assert len(left) < len(told)
    masked = {}
    for doc_id, text in left:
        for span in reversed(base_spans(text)):
            _, a, b = span.split(":")
            text = text[: int(a)] + "[SECRET]" + text[int(b) :]
        masked[doc_id] = text
    source = {i: s for i, _, _, s in rows}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, source[i]) for i, t in masked.items()])
    taken = con.execute(f"SELECT doc_id, taken // size FROM ({queries.ORACLES['op3_pareto_mix']}) WHERE taken > 0").fetchall()
    ids = packing.WordIds(queries.tokenizer_path())
    want = sorted((doc_id, copies, len(ids.of(masked[doc_id])) // 4 + 1) for doc_id, copies in taken)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    copies, tokens, every = Counter(), {}, defaultdict(list)
    for p in pieces:
        copies[p["doc_id"]] += p["start"] == 0
        tokens[p["doc_id"]] = p["doc_tokens"]
        every[p["doc_id"]].append((p["start"], bytes(p["ids"])))
    assert sorted((i, copies[i], tokens[i]) for i in copies) == want and max(copies.values()) > 1
    for doc_id, n, _ in want:
        whole = ids.of(masked[doc_id]) + (2).to_bytes(4, "little")
        assert sum(len(data) for _, data in every[doc_id]) == n * len(whole)
        assert all(whole[4 * start : 4 * start + len(data)] == data for start, data in every[doc_id])
    places = sorted((p["sequence_id"] * 4096 + p["offset"], p["length"]) for p in pieces)
    assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))


def test_word_ids_are_kept_and_the_same_after_a_clearing(monkeypatch):
    path = queries.tokenizer_path()
    assert packing.word_ids(path) is packing.word_ids(path)
    texts = ["The mots; naïve... un", "deux trois naïve x?!", "The un;\nquatre"]
    want = [packing.WordIds(path).of(t) for t in texts]
    monkeypatch.setattr(packing, "REMEMBERED", 6)
    ids = packing.WordIds(path)
    for _ in range(3):
        ids["many"], ids["few"], ids["more"] = b"", b"", b""  # so that words are cleared before their pieces
        assert [ids.of(t) for t in texts] == want
        assert len(ids.pieces) > 1
