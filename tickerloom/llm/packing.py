"""Packing by concatenate and cut.

All documents' tokens, each closed by an end token, form one long stream, cut into windows of a fixed
length. Pass one tokenises the whole texts and numbers the tokens within each input partition; it is
written once, so that a lost executor can't renumber anything. Pass two turns the partitions' totals
into offsets by a prefix sum (one row per partition) and cuts every document at the window borders it
crosses. No token moves between tasks, and only the last window needs padding.

A document longer than ``CHUNK`` tokens is written in several rows, which bounds a row; the cut
between two of them is one more piece border.

Defined cases: a null or empty text has just the end token; repeated rows are packed each; very long
words and texts are tokenised whole; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import materialise

#: Tokens in a row of pass one, at most.
CHUNK = 1 << 15
#: Words, and pieces of words, whose ids a worker remembers, and how long such a word may be.
REMEMBERED, REMEMBERED_CHARS = 1 << 19, 48

c = F.col


class WordIds(dict):
    """Ids of words as little-endian 32-bit numbers, asked for as they come up, for a tokenizer that never joins text across a space.

    Most words are Latin letters with a mark behind: all that normaliser and splitter do to them is to
    lower-case, to split off the mark and to spell bytes as characters, so they go to the model
    directly. A few probes make sure of that; another kind of tokenizer is asked in full.
    """

    _PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)").fullmatch
    _PROBES = ("The", "ÀÉÖØÞ", "àéöøþÿß,", "naïve...", "x?!", "mots;", "WORD:")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.pieces = self.tokenizer.model, {"": b""}
        self.packed = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        # byte-level BPE: printable bytes stand for themselves, the others for characters from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.spelled = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in printable)}
        self.direct = all(self._direct(*self._PLAIN(w).groups()) == self._full(w) for w in self._PROBES)

    def __missing__(self, word: str) -> bytes:
        plain = self._PLAIN(word) if self.direct else None
        ids = self._direct(*plain.groups()) if plain else self._full(word)
        if len(word) <= REMEMBERED_CHARS:
            self[word] = ids
        return ids

    def _full(self, text: str) -> bytes:
        return b"".join([self.packed[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def _direct(self, letters: str, mark: str) -> bytes:
        return self._piece(letters.lower()) + self._piece(mark)

    def _piece(self, piece: str) -> bytes:
        """Ids of lower-case letters or of a mark; a word comes in several cases and with several marks."""
        ids = self.pieces.get(piece)
        if ids is None:
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.spelled)
            ids = b"".join([self.packed[t.id] for t in self.model.tokenize(spelled)])
            if len(piece) <= REMEMBERED_CHARS:
                self.pieces[piece] = ids
        return ids

    def of(self, text: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        if len(self.pieces) > REMEMBERED:  # words share pieces, so these are of use for longer
            self.pieces = {"": b""}
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The words of a tokenizer, kept by a Python worker from task to task."""
    return WordIds(path)


def tokens(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Pass one: (doc_id, doc_tokens, start, part, position, ids), a row for each ``CHUNK`` tokens of a document.

    ``position`` counts the tokens before the row in its partition ``part``.
    """
    end = end_id.to_bytes(4, "little")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, part, position = word_ids(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = words.of(text or "") + end
                n = len(ids) // 4
                for start in range(0, n, CHUNK):
                    piece = ids[4 * start : 4 * (start + CHUNK)]
                    rows.append((doc_id, n, start, part, position, piece))
                    position += len(piece) // 4
            frame = pd.DataFrame(rows, columns=["doc_id", "doc_tokens", "start", "part", "position", "ids"])
            frame["doc_id"] = pd.array(frame["doc_id"], dtype="Int64" if key != "string" else "object")
            yield frame

    key = "string" if docs.schema["doc_id"].dataType.simpleString() == "string" else "long"
    return docs.select(c("doc_id").cast(key), "text").mapInPandas(
        encode, f"doc_id {key}, doc_tokens long, start long, part int, position long, ids binary"
    )


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = 4096) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids, goes_on.

    ``goes_on`` is the boundary record: the document continues at the start of the next sequence.
    """
    rows = materialise(tokens(docs, tokenizer_path, end_id)).withColumn("n", (F.octet_length("ids") / 4).cast("long"))
    totals = rows.groupBy("part").agg(F.max(c("position") + c("n")).alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    placed = rows.join(materialise(offsets), "part").withColumn("at", c("before") + c("position"))
    first, last = F.floor(c("at") / window), F.floor((c("at") + c("n") - 1) / window)
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(first, last)))
    lo = F.greatest(c("at"), c("sequence_id") * window)
    hi = F.least(c("at") + c("n"), (c("sequence_id") + 1) * window)
    cut = cut.withColumns({"lo": lo, "length": hi - lo})
    start = c("start") + c("lo") - c("at")
    return cut.select(
        "doc_id", start.alias("start"), "length", "doc_tokens", "sequence_id", (c("lo") - c("sequence_id") * window).alias("offset"),
        F.substring("ids", ((c("lo") - c("at")) * 4 + 1).cast("int"), (c("length") * 4).cast("int")).alias("ids"),
        ((c("lo") + c("length") == (c("sequence_id") + 1) * window) & (start + c("length") < c("doc_tokens"))).alias("goes_on"),
    )
