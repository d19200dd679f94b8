"""Language identification, packing, SimHash and repeats against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tickerloom.llm import language_id, packing, run_length_index, simhash
from tickerloom.llm.queries import tokenizer_path

from .conftest import SCHEMA, prose


def test_held_out_accuracy(documents):
    rows = language_id.predict(documents).collect()
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert len(rows) == len(lang) and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97


def test_prediction_reads_the_text_only(documents):
    swapped = documents.selectExpr("doc_id", "text", "lang", "'x' as source", "0L as n_chars", "1 as p")
    assert sorted(language_id.predict(swapped).collect()) == sorted(language_id.predict(documents).collect())


def test_weights_are_sparse_and_calibration_lowers_the_loss():
    chosen = random.Random(0)
    words = {0: "aba bab abba", 1: "xyx yxy xyyx aba"}
    rows = [(k, *language_id.features(" ".join(chosen.choices(words[k].split(), k=12)))) for k in (0, 1) * 60]
    model = language_id.Model(["a", "x"], np.ones(language_id.FEATURES), np.zeros((language_id.FEATURES, 2)))
    language_id.train(model, rows[:80])
    assert 0 < (model.weights != 0).mean() < 0.01

    def loss(t):
        p = [language_id._softmax(model.scores(*r[1:]) / t)[r[0]] for r in rows[80:]]
        return -np.log(p).mean()

    before = loss(1.0)
    assert loss(language_id.calibrate(model, rows[80:]).temperature) <= before


def test_language_odd_rows(odd_docs, no_docs):
    rows = language_id.predict(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert und >= {1, 2, 3, 4} and not und & {5, 6, 7}
    assert language_id.predict(no_docs).count() == 0
    unlabelled = language_id.predict(odd_docs.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}
    kept = language_id.accepted(odd_docs)
    assert kept.columns == odd_docs.columns and kept.filter("doc_id in (1, 2, 3, 4)").count() == 0


TEXTS = [None, "", " ", "Don't <|endoftext|>x ÉÈ é Σ ΑΣ\n\n12ab", "a" * 5000, prose(4, 9000), "x <|startoftext|> y\tz"]


def whole(text):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    return np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_pack_round_trip(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(1, "")], "doc_id long, text string").repartition(3)
    rows = packing.pack(docs, tokenizer_path(), window=4096).collect()
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
        assert len(r["ids"]) == 4 * r["length"]
    for i, text in enumerate(TEXTS):
        want = whole(text).tobytes()
        joined = b"".join(r["ids"] for r in sorted(pieces[i], key=lambda r: (r["start"], r["sequence_id"], r["offset"])))
        assert joined == want * (2 if i == 1 else 1)
        assert {r["doc_tokens"] for r in pieces[i]} == {len(want) // 4}
    assert sorted(sequences) == list(range(len(sequences)))
    for s, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or s == max(sequences)


def test_long_documents_are_written_in_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 1000)
    docs = spark.createDataFrame([(1, prose(5, 4000))], "doc_id long, text string")
    rows = sorted(packing.pack(docs, tokenizer_path(), window=512).collect(), key=lambda r: r["start"])
    assert b"".join(r["ids"] for r in rows) == whole(prose(5, 4000)).tobytes()
    assert all(r["start"] == sum(x["length"] for x in rows[:i]) for i, r in enumerate(rows))


def test_pack_odd_rows(odd_docs, no_docs):
    rows = packing.pack(odd_docs, tokenizer_path()).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1
    assert sum(r["start"] == 0 for r in rows) == odd_docs.count()
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


def plain_fingerprint(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def linked(fps, bits):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash(documents):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(documents).collect()}
    text = {r["doc_id"]: r["text"] for r in documents.collect()}
    ids = sorted(text)
    fps = [plain_fingerprint(text[i]) for i in ids]
    for i, fp, root in zip(ids, fps, linked(fps, 3), strict=True):
        assert rows[i]["fingerprint"] == f"{fp:016x}" and rows[i]["component_id"] == ids[root]


@pytest.mark.parametrize("bucket", [1024, 8])
def test_links_lose_nothing(spark, monkeypatch, bucket):
    """Crowded fingerprints: clusters around few centres, and a bucket that has to be dealt out."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    chosen = random.Random(3)
    centres = [chosen.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in chosen.sample(range(64), chosen.randrange(6))) for c in centres for _ in range(60)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 3)
    rooted = {r["node"]: r["root"] for r in simhash.roots(edges).collect()}
    groups = collections.defaultdict(set)
    for f in signed:
        groups[rooted.get(f, f)].add(f)
    want = collections.defaultdict(set)
    for f, root in zip(signed, linked(fps, 3), strict=True):
        want[root].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_a_later_batch_keeps_the_links_of_an_earlier_one():
    e, t, s, e0, r1, a, x, y, b = range(9)
    same, table, labels = np.zeros(9, np.uint64), np.zeros((9, 1), np.int16), np.arange(9)
    for batch in ([(a, r1), (a, x), (s, y), (e0, b)], [(r1, y), (x, b), (y, t), (b, e)]):
        left, right = np.array(batch).T
        labels = simhash._forest(same, table, left, right, labels, 3)
    assert labels.tolist() == [0] * 9


@pytest.mark.parametrize("dealt", [False, True])
def test_small_batches_lose_nothing(monkeypatch, dealt):
    """A bucket of chains of near fingerprints, in itself or as a pair of chunks, four rows at a time."""
    monkeypatch.setattr(simhash, "BATCH", 4)
    chosen = random.Random(5)
    for _ in range(40):
        fps = list({chosen.getrandbits(10) * 0x1041 % (1 << 16) for _ in range(90)})
        sides = [chosen.randrange(2) for _ in fps]
        tables = [bytes(((f ^ p).bit_count()) for p in (0x5A5A, 0x0F33)) for f in fps]
        bucket = pd.DataFrame({"fps": [fps], "tables": [tables], "sides": [sides if dealt else None]})
        links = next(simhash._compare(1)(iter([bucket])))
        near = [(f, g) for i, f in enumerate(fps) for j, g in enumerate(fps[:i]) if (f ^ g).bit_count() <= 1 and not (dealt and sides[i] == sides[j])]
        assert parts(fps, zip(links["a"].tolist(), links["b"].tolist(), strict=True)) == parts(fps, near)


def parts(nodes, edges):
    root = {n: n for n in nodes}
    for a, b in edges:
        old, new = root[a], root[b]
        root = {n: new if r == old else r for n, r in root.items()}
    return {frozenset(n for n in nodes if root[n] == r) for r in root.values()}


def test_roots_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 999)]
    rows = {r["node"]: r["root"] for r in simhash.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(rows[i] == 0 for i in range(1, 201)) and rows[1000] == 999


def test_simhash_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = collections.defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add((r["fingerprint"], r["component_id"]))
    assert {("0" * 16, 1)} == by[1] == by[2] == by[3] and ("0" * 16, 1) in by[None]
    assert {c for _, c in by[5] | by[6]} == {5}
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(5) == 1 and 6 not in ids and ids.count(None) == 1
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def plain_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        mark = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                mark[i : i + length] = True
        rest = bytes(np.frombuffer(d, np.uint8)[~mark])
        runs = int((np.diff(np.concatenate(([0], mark.astype(int)))) == 1).sum())
        out.append((len(d), int(mark.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def repeats(docs, length=400):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, *r[1:]) for r in run_length_index.remove_repeats(docs, length).collect())


def test_repeats(documents):
    rows = documents.collect()
    want = plain_repeats([r["text"] for r in rows], 400)
    assert repeats(documents) == sorted((False, r["doc_id"], *w) for r, w in zip(rows, want, strict=True))


@pytest.mark.parametrize("busy", [256, 2])
def test_planted_repeats(spark, monkeypatch, busy):
    """Edges at every offset, runs of one byte, nested and overlapping repeats; few letters, so anchors tie."""
    monkeypatch.setattr(run_length_index, "BUSY", busy)
    monkeypatch.setattr(run_length_index, "SEGMENT", 700)
    chosen = random.Random(7)
    some = lambda n, of="ab": "".join(chosen.choices(of, k=n))
    passage = some(300, "abcdefgh")
    texts = [some(chosen.randrange(200)) + passage[chosen.randrange(80) : 300 - chosen.randrange(80)] + some(chosen.randrange(200), "xyé") for _ in range(40)]
    texts += ["z" * 500, "z" * 130, "ab" * 300, "abc" * 100, passage, passage, passage[:60] * 4, None, "", some(1500, "abcdefgh") + passage]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = plain_repeats(texts, 40)
    assert repeats(docs, 40) == [(False, i, *w) for i, w in enumerate(want)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40), st.integers(0, 20))
def test_longest_matches(symbols, again):
    text = np.array([*symbols, *symbols[:again], 0], np.int16)
    n = len(text)
    want = [0] * n
    for i in range(n):
        for j in range(n):
            length = 0
            while i != j and max(i, j) + length < n and text[i + length] == text[j + length]:
                length += 1
            want[i] = max(want[i], length)
    assert run_length_index.longest_matches(text).tolist() == want


def test_repeats_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    want = plain_repeats([r["text"] for r in rows], 400)
    assert repeats(odd_docs) == sorted((r["doc_id"] is None, r["doc_id"] or 0, *w) for r, w in zip(rows, want, strict=True))
    assert repeats(no_docs) == []


def test_too_many_languages(spark):
    rows = [(i, f"some words {i}", f"l{i % 4}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(language_id.fit(docs, 4, 2, most_languages=4).languages) == 4
    with pytest.raises(ValueError, match="more than 3 languages"):
        language_id.fit(docs, 4, 2, most_languages=3)
