"""Phrase collocations from FM-indexes of word ids.

Every task cuts its documents into shards of one language and indexes each: the words' ids in text order and
in reverse, both sorted to the depth asked for and kept as Burrows-Wheeler transforms. No text is shuffled.
A phrase is a pair of intervals, one in either index. The transform's ids inside the reverse interval are
the words that may follow, with their counts; the new forward interval lies behind the smaller ones, the new
reverse interval is found by ranks (occurrences of the word before the interval). The other side works
the same way with the indexes exchanged. Counts of a phrase are summed across shards.

Two passes over the indexes. First every shard counts all its phrases, named by a hash of 40 bits, and
the counts of a name are summed across shards. Then a shard spells out, and counts again, only the phrases
whose name is frequent. Names that collide let more phrases pass, never fewer, and the counts that follow are
by the phrase itself.

Scores. A phrase's weakest cut is the lowest of floor(scale * a * a / (l * r)) over the cuts into first
part and rest, in exact decimals. A phrase is dropped if a longer frequent phrase extends it to the left or
right and holds at least ``absorbed`` percent of its occurrences.

Defined cases: a null text is empty; a null language is ``und``; words and pieces are split at the marks
given, A-Z in lower case; texts of any length are read whole; repeated rows count each; no rows give no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import materialise

#: Words of a shard, and rows handed on at a time.
SHARD, ROWS = 1 << 21, 1 << 17
#: Bits of a phrase's name; short ones make small rows.
KEY_BITS = 40
#: A-Z to lower case; what ends a piece to a line feed; what ends a word to a space.
_MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + _MARKS + b"\t", bytes(range(97, 123)) + b"\n" * len(_MARKS) + b" ")
_ZSTD = "zstd"

c = F.col
U = np.uint64


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in lower case, a line feed where a piece ends."""
    return [w for w in text.translate(_TABLE).replace(b"\n", b" \n ").split(b" ") if w]


class _Ids(dict):
    """Ids of words as they come up; the piece mark is 0."""

    def __init__(self):
        super().__init__({b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def sorted_places(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The places of a cyclic text in the order of the ``depth`` symbols found there."""
    key, high = symbols.astype(np.int64), int(symbols.max(initial=0)) + 1
    bound = high
    for i in range(1, depth):
        if bound * high >= 1 << 62:
            bound, key = len(symbols), np.unique(key, return_inverse=True)[1]
        key, bound = key * high + np.roll(symbols, -i), bound * high
    return np.argsort(key)  # equal ones in any order: intervals of shorter phrases don't depend on it


class Side:
    """One of the two indexes: the transform and, for each symbol, where the rows that start with it begin."""

    def __init__(self, transform: np.ndarray):
        self.transform, self.n = transform.astype(np.int64), len(transform)
        self.begins = np.concatenate(([0], np.cumsum(np.bincount(self.transform))))

    @cached_property
    def ranked(self) -> np.ndarray:
        """Numbers of (symbol, row) in order."""
        return np.sort(self.transform * self.n + np.arange(self.n))

    def before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` in the transform before ``row``."""
        asked = symbol * self.n + row
        order, places = np.argsort(asked), np.empty(len(asked), np.int64)
        places[order] = np.searchsorted(self.ranked, asked[order])  # in order, so neighbours are looked up together
        return places - self.begins[symbol]


def transforms(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The transforms of the text and of its reverse."""
    back = symbols[::-1]
    return symbols[sorted_places(symbols, depth) - 1], back[sorted_places(back, depth) - 1]


Keep = Callable[[np.ndarray, np.ndarray], np.ndarray]
Known = Callable[[np.ndarray], np.ndarray]


def counted(side: Side, lo: np.ndarray, size: np.ndarray, keep: Keep) -> tuple[np.ndarray, ...]:
    """Extensions of intervals on one side: (interval, symbol, size, rows of the interval that smaller symbols extend).

    ``lo`` and ``size`` are rows of ``side``. ``keep`` says which (interval, symbol) to keep; piece marks never are.
    """
    of = np.repeat(np.arange(len(lo)), size)
    rows = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(len(of))
    high = len(side.begins)
    key, count = np.unique(of * high + side.transform[rows], return_counts=True)
    of, symbol = key // high, key % high
    total = np.cumsum(count) - count
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    smaller = total - np.repeat(total[first], np.diff(np.append(first, len(of))))  # extensions by smaller symbols
    kept = symbol > 0
    kept[kept] = keep(of[kept], symbol[kept])
    return of[kept], symbol[kept], count[kept], smaller[kept]


def extended(side: Side, lo: np.ndarray, other: np.ndarray, size: np.ndarray, keep: Keep) -> tuple[np.ndarray, ...]:
    """:func:`counted` with the new intervals: (interval, symbol, new lo, new other, size); ``other`` are first rows in the other index."""
    of, symbol, count, smaller = counted(side, lo, size, keep)
    return of, symbol, side.begins[symbol] + side.before(symbol, lo[of]), other[of] + smaller, count


class Names:
    """Names of a shard's phrases. The sum of a phrase, a polynomial of its words' hashes, grows on either side."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, lang: str, words: list[bytes], bits: int):
        import xxhash

        self.mask = U((1 << bits) - 1)
        self.words = np.fromiter(chain((0,), map(xxhash.xxh3_64_intdigest, words)), np.uint64, len(words) + 1)
        self.lang = U(xxhash.xxh3_64_intdigest(lang, 1))

    def right(self, total: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        return total * U(self.BASE) + self.words[symbol]

    def left(self, total: np.ndarray, symbol: np.ndarray, length: int) -> np.ndarray:
        return total + self.words[symbol] * U(pow(self.BASE, length, 1 << 64))

    def keys(self, total: np.ndarray) -> np.ndarray:
        h = total ^ self.lang
        h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
        return ((h ^ (h >> U(29))) & self.mask).view(np.int64)


def _packed(values: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, all first bytes in front, then all second bytes and so on."""
    planes = np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec=_ZSTD, asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec=_ZSTD, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").reshape(-1)


def _spelled(words: list[bytes]) -> bytes:
    """Compressed words, behind the length of their text; no word has a line feed."""
    text = b"\n".join(words)
    return len(text).to_bytes(8, "little") + pa.compress(text, codec=_ZSTD, asbytes=True)


def _words(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], n, codec=_ZSTD, asbytes=True).split(b"\n") if n else []


_INDEX = pa.schema([
    ("lang", pa.string()), ("shard", pa.int64()), ("n", pa.int64()), ("words", pa.binary()), ("counts", pa.binary()),
    ("forward", pa.binary()), ("reverse", pa.binary()),
])


def index(docs: DataFrame, depth: int) -> DataFrame:
    """One row per shard: lang, shard, n (symbols), words and their counts by id from 1, the two transforms, all packed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Ids, list[np.ndarray]]] = {}
        total, shard = 0, TaskContext.get().partitionId() << 32

        def row(lang: str) -> pa.RecordBatch:
            nonlocal shard
            ids, parts = held.pop(lang)
            symbols = np.concatenate([np.zeros(1, np.int32), *parts])
            forward, reverse = transforms(symbols, depth)
            shard += 1
            # numbered by task and turn: unique, and the same when a task runs again
            return pa.RecordBatch.from_pydict({
                "lang": [lang], "shard": [shard], "n": [len(symbols)], "words": [_spelled(list(ids)[1:])],
                "counts": [_packed(np.bincount(symbols, minlength=len(ids))[1:])], "forward": [_packed(forward)], "reverse": [_packed(reverse)],
            }, _INDEX)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, parts = held.setdefault(lang, (_Ids(), []))
                words = words_of(text.as_buffer().to_pybytes())
                if words:
                    parts.append(np.fromiter(chain(map(ids.__getitem__, words), (0,)), np.int32, len(words) + 1))
                    total += len(words) + 1
                if total >= SHARD:  # of all languages of the task, so that memory is bounded for any number of them
                    large = max(held, key=lambda k: sum(map(len, held[k][1])))
                    total -= sum(map(len, held[large][1]))
                    yield row(large)
        for lang in [k for k in held if held[k][1]]:
            yield row(lang)

    slim = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return slim.mapInArrow(work, "lang string, shard long, n long, words binary, counts binary, forward binary, reverse binary")


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            yield {n: x[0].values.to_numpy(zero_copy_only=False) if pa.types.is_list(x.type) else x[0].as_py() for n, x in zip(row.schema.names, row.columns, strict=True)}


def word_counts(shards: DataFrame) -> DataFrame:
    """(lang, part, n): each shard's words with their counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _index_rows(batches):
            words = pa.array(_words(row["words"]), pa.binary()).cast(pa.string())
            n = _unpacked(row["counts"], len(words)).astype(np.int64)
            for at in range(0, len(words), ROWS):
                part = words.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(part)), part, pa.array(n[at : at + ROWS])], names=["lang", "part", "n"])

    return shards.select("lang", "words", "counts").mapInArrow(work, "lang string, part string, n long")


class _Phrases:
    """The phrases of an index row, from single words on: intervals, sizes and names."""

    def __init__(self, row: dict, bits: int):
        self.texts = _words(row["words"])
        self.names = Names(row["lang"], self.texts, bits)
        self.reverse = Side(_unpacked(row["reverse"], row["n"]))
        words = np.arange(1, len(self.names.words))
        # a word's rows start at the same places in both indexes
        self.front = self.back = self.reverse.begins[words]
        self.size = np.diff(self.reverse.begins)[words]
        self.sums, self.length = self.names.words[words], 1

    def grow(self, known: Known) -> tuple[np.ndarray, np.ndarray]:
        """Extend to the right, phrases of ``known`` names only; (phrase before, word) of each new phrase."""
        sums = lambda of, symbol: self.names.right(self.sums[of], symbol)
        of, symbol, back, front, size = extended(self.reverse, self.back, self.front, self.size, lambda *x: known(self.names.keys(sums(*x))))
        self.sums, self.back, self.front, self.size, self.length = sums(of, symbol), back, front, size, self.length + 1
        return of, symbol

    def to_the_right(self) -> tuple[np.ndarray, np.ndarray]:
        """(name, count) of the right extensions, which nothing extends: their intervals aren't looked up."""
        of, symbol, size, _ = counted(self.reverse, self.back, self.size, lambda of, _: np.ones(len(of), bool))
        return self.names.keys(self.names.right(self.sums[of], symbol)), size

    def to_the_left(self, forward: Side, known: Known) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, word, count) of the left extensions of ``known`` names."""
        sums = lambda of, symbol: self.names.left(self.sums[of], symbol, self.length)
        return counted(forward, self.front, self.size, lambda *x: known(self.names.keys(sums(*x))))[:3]


def _among(keys: np.ndarray) -> Known:
    wanted = np.sort(keys)
    return lambda found: wanted[np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)] == found


def frequent_keys(shards: DataFrame, longest: int, least: int, bits: int = KEY_BITS) -> DataFrame:
    """(shard, keys): names of a shard's phrases of 2 to ``longest`` words that occur ``least`` times or more across shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _index_rows(batches):
            found = _Phrases(row, bits)
            for length in range(2, longest + 1):
                if length < longest:
                    found.grow(lambda keys: np.ones(len(keys), bool))
                    keys, size = found.names.keys(found.sums), found.size
                else:
                    keys, size = found.to_the_right()
                order = np.argsort(keys)  # neighbours alike make small rows
                for at in range(0, len(order), ROWS):
                    some = order[at : at + ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(some), row["shard"]), keys[some], size[some])], names=["shard", "key", "n"])

    every = shards.select("lang", "shard", "n", "words", "reverse").mapInArrow(work, "shard long, key long, n long")
    # a name has few rows of a shard, one but for collisions
    often = every.withColumn("every", F.sum("n").over(W.partitionBy("key"))).filter(c("every") >= least)
    return often.groupBy("shard").agg(F.collect_list("key").alias("keys"))


def phrases(shards: DataFrame, keys: DataFrame, longest: int, bits: int = KEY_BITS) -> DataFrame:
    """(lang, phrase, side, n) of each shard's phrases of 2 to ``longest`` words whose names are among ``keys``.

    Each stands there as the right extension of its first words (side 0) and, from three words on, as the
    left extension of its last words (side 1).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        def rows(lang: str, text: pa.Array, side: int, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(text), ROWS):
                part = text.slice(at, ROWS)
                same = [pa.array([x] * len(part), t) for x, t in ((lang, pa.string()), (side, pa.int32()))]
                yield pa.RecordBatch.from_arrays([same[0], part, same[1], pa.array(n[at : at + ROWS])], names=["lang", "phrase", "side", "n"])

        for row in _index_rows(batches):
            known, found = _among(row["keys"]), _Phrases(row, bits)
            words = pa.array([b"", *found.texts], pa.binary()).cast(pa.string())
            forward = Side(_unpacked(row["forward"], row["n"]))
            text = words.slice(1)
            while found.length < longest:
                if found.length > 1:
                    of, symbol, n = found.to_the_left(forward, known)
                    yield from rows(row["lang"], pc.binary_join_element_wise(words.take(pa.array(symbol)), text.take(pa.array(of)), " "), 1, n)
                of, symbol = found.grow(known)
                text = pc.binary_join_element_wise(text.take(pa.array(of)), words.take(pa.array(symbol)), " ")
                yield from rows(row["lang"], text, 0, found.size)

    return shards.drop("counts").join(keys, "shard").mapInArrow(work, "lang string, phrase string, side int, n long")


def scored(candidates: DataFrame, counts: DataFrame, scale: int) -> DataFrame:
    """(lang, phrase, a) with l, r and score of the weakest cut; ``counts`` is (lang, part, n) of all parts of candidates."""
    words = F.split("phrase", " ")
    cut = candidates.select("lang", "phrase", "a", words.alias("words"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", 1, c("k")), " ").alias("first"),
        F.array_join(F.slice("words", c("k") + 1, F.size("words")), " ").alias("rest"),
    )
    cut = cut.join(counts.select("lang", c("part").alias("first"), c("n").alias("l")), ["lang", "first"])
    cut = cut.join(counts.select("lang", c("part").alias("rest"), c("n").alias("r")), ["lang", "rest"])
    wide = {x: c(x).cast("decimal(15,0)") for x in "alr"}
    exact = cut.withColumns({"above": F.lit(scale).cast("decimal(7,0)") * (wide["a"] * wide["a"]), "below": wide["l"] * wide["r"]})
    exact = exact.withColumn("score", F.expr("above div below"))  # whole numbers of up to 38 digits
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return exact.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, absorbed: int = 50, top: int = 2000, scale: int = 1_000_000, bits: int = KEY_BITS
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score, by score, count, phrase."""
    shards = materialise(index(docs, longest))
    words = materialise(word_counts(shards).groupBy("lang", "part").agg(F.sum("n").alias("n")))
    keys = materialise(frequent_keys(shards, longest, least, bits))
    sums = phrases(shards, keys, longest, bits).groupBy("lang", "phrase", "side").agg(F.sum("n").alias("n"))
    frequent = materialise(sums.filter(c("n") >= least))
    candidates = frequent.filter("side = 0").select("lang", "phrase", c("n").alias("a"))

    # what extends a phrase by one word holds all that longer ones hold
    right = frequent.filter("side = 0").filter(F.size(F.split("phrase", " ")) > 2)
    shorter = right.select("lang", F.regexp_replace("phrase", " [^ ]*$", "").alias("phrase"), "n")
    left = frequent.filter("side = 1").select("lang", F.regexp_replace("phrase", "^[^ ]* ", "").alias("phrase"), "n")
    longer = shorter.unionByName(left).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(c("longer") * 100 < c("a") * absorbed, F.lit(True)))

    counts = words.filter(c("n") >= least).unionByName(candidates.select("lang", c("phrase").alias("part"), c("a").alias("n")))
    order = W.partitionBy("lang").orderBy(c("score").desc(), c("a").desc(), "phrase")
    best = scored(kept.drop("longer"), counts, scale).withColumn("rank", F.row_number().over(order).cast("long")).filter(c("rank") <= top)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
