"""Periodic runs, chat windows and collocations against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import pytest

from tickerloom.llm import chat_windows, collocations, periodic_runs, queries

TOKENIZER = queries.tokenizer_path()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs --------------------------------------------------------------------------


def plain_runs(words, min_length, min_periods):
    """Per period, the stretches in which words that far apart are equal."""
    found = []
    for q in range(1, len(words) // min_periods + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)]
        at = 0
        for equal, group in groupby(same):
            n = len(list(group))
            length = n + q
            if equal and length >= max(min_length, min_periods * q):
                stretch = words[at : at + length]
                if all(any(stretch[i] != stretch[i + p] for i in range(length - p)) for p in range(1, q)):
                    found.append((at, length, q))
            at += n
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The row of a document, as its contract words it."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 24, 3)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *top, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


RUN_COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_of_documents(spark, sf_dir, documents):
    got = queries.QUERIES["op11_periodic_runs"](spark, sf_dir)
    assert got.columns == RUN_COLUMNS
    got = sorted(tuple(r) for r in got.collect())
    want = sorted(plain_row(r["doc_id"], r["text"]) for r in documents.collect())
    assert got == want and any(r[1] for r in got)


@pytest.mark.parametrize("letters,least,periods", [(1, 4, 2), (2, 4, 2), (3, 6, 3), (4, 9, 3)])
def test_runs_of_random_words(letters, least, periods):
    rnd = random.Random(letters)
    for _ in range(150):
        held, docs = periodic_runs._Held(least, periods), []
        for _ in range(rnd.randint(1, 4)):
            words = [rnd.choice([b"a", b"b", b"c", b"d"][:letters]) for _ in range(rnd.randint(0, 60))]
            if rnd.random() < 0.5 and words:
                a, p = rnd.randrange(len(words)), rnd.randint(1, 9)
                words = [words[min(a + (i - a) % p, len(words) - 1)] if i >= a else w for i, w in enumerate(words)]
            docs.append(words)
            held.add(0, words)
        assert held.runs() == [plain_runs(w, least, periods) for w in docs]


def test_runs_of_a_very_long_document():
    held = periodic_runs._Held(24, 3)
    held.add(0, [b"x"] * 100_000 + [b"y"] + [b"a", b"b"] * 50_000)
    assert held.runs() == [[(0, 100_000, 1), (100_001, 100_000, 2)]]


def test_checks_in_small_portions(monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHECKED", 1)
    words = list(random.Random(3).choices([b"a", b"b"], k=400))
    held = periodic_runs._Held(4, 2)
    held.add(0, words)
    assert held.runs() == [plain_runs(words, 4, 2)]


def test_small_arrays_give_the_same_runs(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "lo la " * (5 * (i % 9)) + "end") for i in range(40)], "doc_id long, text string").coalesce(1)
    one = sorted(map(str, periodic_runs.periodic_runs(docs).collect()))
    monkeypatch.setattr(periodic_runs, "ARRAY_WORDS", 30)
    assert sorted(map(str, periodic_runs.periodic_runs(docs).collect())) == one


def test_runs_odd_rows(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    got = sorted(map(str, ((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.periodic_runs(odd_docs).collect())))
    want = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = plain_runs(words, 24, 3) if len(words) < 1000 else []
        want.append((doc_id, len(words), runs, " ".join(words)))
    assert got == sorted(map(str, want))
    assert periodic_runs.periodic_runs(no_docs).count() == 0
    repeated = no_docs.sparkSession.createDataFrame([(1, "x " * 30)] * 2, "doc_id long, text string")
    assert [r["collapsed"] for r in periodic_runs.periodic_runs(repeated).collect()] == ["x", "x"]


# --- chat windows ---------------------------------------------------------------------------


def plain_digests(rows):
    """conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256) from the rows themselves."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv_id, found in turns.items():
        found.sort()
        loss = "".join(text for *_, role, text in found if role == "assistant")
        out[conv_id] = (len(found), sha("".join(f"{role}\n{text}\n" for *_, role, text in found)), len(loss), sha(loss))
    return out


def digests(frame):
    found = {r["conv_id"]: tuple(r)[1:5] for r in frame.collect()}
    return found


def test_chat_windows_of_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    text = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    found = queries.QUERIES["op12_chat_windows"](spark, sf_dir)
    assert found.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert found.count() == len({r[0] for r in rows})
    assert digests(found) == plain_digests(rows)
    assert all(r["formatted_chars"] > r["loss_chars"] for r in found.collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def chat(spark, n, turns, seed=1, system=True):
    rnd = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(turns):
            role = "system" if turn == 0 and system and conv % 2 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, " ".join(rnd.choice(["alpha", "beta", "<|im_end|>", "<\\|x|>", "é😀"]) for _ in range(rnd.choice([0, 3, 20, 90])))))
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, SCHEMA)


def check_windows(made, rows, budget, history):
    """Each window has its budget, the system turn, limited history that ends where its new turns start, and the new targets."""
    size = chat_windows.WordIds(TOKENIZER)
    cost = lambda text: len(size.of(text)) // 4 + chat_windows.MARKS
    by_conv = defaultdict(list)
    for conv_id, turn, role, text in sorted(rows, key=lambda r: r[:2]):
        by_conv[conv_id].append((role, text))
    at = Counter()
    for w in sorted(made, key=lambda r: (r["conv_id"], r["segment"], r["number"])):
        turns, given, start = by_conv[w["conv_id"]], chat_windows.parse(w["text"]), at[w["conv_id"]]
        again, new = given[: w["repeated"]], given[w["repeated"] :]
        assert new and new == turns[start : start + len(new)]
        at[w["conv_id"]] += len(new)
        system = turns[0][0] == "system" and start > 0
        if system:
            assert again[0] == turns[0]
        past = again[1:] if system else again
        assert past == turns[start - len(past) : start] if past else True
        assert sum(cost(t) for _, t in past) <= history
        spent = sum(cost(t) for _, t in given)
        assert w["tokens"] == spent and (spent <= budget or (len(new) == 1 and not past))
        if past != turns[int(system) : start] and not w["segment"]:  # no more history fits
            before = turns[start - len(past) - 1]
            assert sum(cost(t) for _, t in [before, *past]) > history or spent + cost(before[1]) > budget or len(past) == 0
        targets = [chat_windows.unescape(w["text"][s["start"] : s["end"]]) for s in w["loss"]]
        assert targets == [text for role, text in new if role == "assistant"]
    assert {k: len(v) for k, v in by_conv.items()} == dict(at)


@pytest.mark.parametrize("budget,history", [(60, 20), (400, 100), (100_000, 0), (1, 0)])
def test_windows_keep_the_budget(spark, budget, history):
    rows, frame = chat(spark, 8, 30)
    made = chat_windows.windows(frame, TOKENIZER, budget, history)
    check_windows(made.collect(), rows, budget, history)
    assert digests(chat_windows.read_back(made)) == plain_digests(rows)


@pytest.mark.parametrize("segment", [200, 1000])
def test_long_conversations_are_cut_into_segments(spark, monkeypatch, segment):
    monkeypatch.setattr(chat_windows, "SEGMENT", 3000)
    monkeypatch.setattr(chat_windows, "SEGMENT_TOKENS", segment)
    rows, frame = chat(spark, 6, 120, seed=2)
    made = chat_windows.windows(frame, TOKENIZER, 300, 80).cache()
    found = made.collect()
    assert max(r["segment"] for r in found) > 2 and not any(r["whole"] for r in found)
    check_windows(found, rows, 300, 80)
    assert digests(chat_windows.read_back(made)) == plain_digests(rows)
    # windows may come back in any order
    assert digests(chat_windows.read_back(made.repartition(7, "number").sortWithinPartitions("text"))) == plain_digests(rows)


def test_no_task_gathers_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(chat_windows, "SEGMENT", 3000)
    monkeypatch.setattr(chat_windows, "SEGMENT_TOKENS", 500)
    rows = [(1, turn, ("user", "assistant")[turn % 2], f"turn {turn} of one") for turn in range(4000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    dealt = chat_windows.segments(frame, TOKENIZER, 50)
    assert max(r["count"] for r in dealt.groupBy("key", "segment").count().collect()) < 120
    assert digests(chat_windows.read_back(chat_windows.windows(frame, TOKENIZER, 200, 50))) == plain_digests(rows)


@pytest.mark.parametrize("text", ["", "<", "<|", "<|im_end|>", "<\\|", "<\\\\|im_start|>", "a<|<|b", "<\\", "|>", "\\|<", "<|im_end|>\n<|im_start|>user\nx"])
def test_escapes_are_reversible(text):
    assert chat_windows.unescape(chat_windows.escape(text)) == text
    role = f"r\n%0A{text}"
    shown, places = chat_windows.render([(role, text), ("user", text + "<")])
    assert chat_windows.parse(shown) == [(role, text), ("user", text + "<")]
    assert [chat_windows.unescape(shown[a:b]) for a, b in places] == [text, text + "<"]


def test_chat_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (1, None, None, "no turn"),
        (None, 0, "system", "no id"), (None, 1, "assistant", "x" * 30000), (2, 5, "assistant", "<|im_start|>"), (3, 0, "", "\n"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "segment", "number", "tokens", "loss", "whole"):
        frame = frame.withColumn(name, frame["text"])
    assert digests(chat_windows.read_back(chat_windows.windows(frame, TOKENIZER, 50, 10))) == plain_digests(rows)
    assert chat_windows.read_back(chat_windows.windows(frame.limit(0), TOKENIZER)).count() == 0


# --- collocations ---------------------------------------------------------------------------


def plain_collocations(rows, longest=3, least=10, absorbed=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) from counts of all n-grams."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        n = sum(k for p, k in f.items() if len(p) == 1)
        found = {p: k for p, k in f.items() if len(p) > 1 and k >= least}
        scored = []
        for p, a in found.items():
            if any(100 * b >= absorbed * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def repeated_phrases(seed=1, n=300):
    rnd = random.Random(seed)
    text = lambda: rnd.choice([" ", ", ", ".\n", "\t"]).join(rnd.choice(["New York", "new york city", "la la", "one two three", "é é", "x"]) for _ in range(rnd.randint(0, 8)))
    return [(rnd.choice(["en", "fr", None]), text()) for _ in range(n)]


@pytest.mark.parametrize("shard,longest", [(1 << 21, 3), (40, 3), (40, 4), (40, 2), (7, 5)])
def test_collocations(spark, monkeypatch, shard, longest):
    monkeypatch.setattr(collocations, "SHARD", shard)
    rows = repeated_phrases()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(docs, longest=longest, top=30).collect())
    assert got == plain_collocations(rows, longest, top=30) and len(got) > 10


@pytest.mark.parametrize("bits", [0, 1, 5])
def test_colliding_names_change_nothing(spark, bits):
    rows = repeated_phrases(2)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in collocations.collocations(docs, bits=bits).collect()) == plain_collocations(rows)


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 900_000_000_007, 1_000_000_000_003, 999_999_999_989
    one = spark.createDataFrame([("en", "x y", a)], "lang string, phrase string, a long")
    counts = spark.createDataFrame([("en", "x", left), ("en", "y", right)], "lang string, part string, n long")
    assert [tuple(r) for r in collocations.scored(one, counts, 1_000_000).collect()] == [("en", "x y", a, left, right, 1_000_000 * a * a // (left * right))]


def test_index_intervals_count_occurrences():
    """A phrase's two intervals hold its occurrences, whichever side it was extended to."""
    import numpy as np

    rnd = random.Random(5)
    text = np.array([0, *(rnd.randrange(5) for _ in range(400)), 0], np.int32)
    forward, reverse = (collocations.Side(t) for t in collocations.transforms(text, 4))
    places, back_places = collocations.sorted_places(text, 4), collocations.sorted_places(text[::-1], 4)
    every = lambda of, symbol: np.ones(len(of), bool)
    symbols = np.arange(1, 5)
    names, lo, other, size = [(s,) for s in symbols], reverse.begins[symbols], forward.begins[symbols], np.diff(reverse.begins)[symbols]
    for side in "rlr":
        if side == "r":
            of, symbol, lo, other, size = collocations.extended(reverse, lo, other, size, every)
            names = [(*names[i], s) for i, s in zip(of, symbol, strict=True)]
        else:
            of, symbol, other, lo, size = collocations.extended(forward, other, lo, size, every)
            names = [(s, *names[i]) for i, s in zip(of, symbol, strict=True)]
        for name, b, f, n in zip(names, lo, other, size, strict=True):
            at = {i for i in range(len(text)) if tuple(text[i : i + len(name)]) == name}
            assert set(places[f : f + n].tolist()) == at
            assert {len(text) - p - len(name) for p in back_places[b : b + n].tolist()} == at


def test_collocations_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    assert sorted(tuple(r) for r in collocations.collocations(odd_docs).collect()) == plain_collocations(rows)
    assert collocations.collocations(no_docs).count() == 0
    blank = spark.createDataFrame([(None, None), ("en", " .. ")], "lang string, text string")
    assert collocations.collocations(blank).count() == 0
