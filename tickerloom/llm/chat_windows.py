"""Chat formatting in budgeted windows.

A conversation's turns become windows of text with turn marks. Prefix sums of turn tokens choose
turn-aligned spans: a window opens with the conversation's system turn, repeats the last turns before its
span up to ``history`` tokens, and takes as many new turns as fit the budget (one at least; repeated
turns give way to a long new one). The loss mask holds the texts of new assistant turns only, so every
assistant text is a target once.

Texts and roles are escaped reversibly: between ``<`` and ``|`` goes one more backslash than is there, so no
text can hold a mark. :func:`read_back` takes formatted windows apart again.

Long conversations. One of more than ``SEGMENT`` bytes is dealt out by the (conversation, turn) ranges of its
rows, and its prefix sums are taken in two passes, within the ranges and over the ranges' totals. The sums
cut it into segments, each of which starts a window; the system turn and the rows that may be history go
to a segment as copies. So no task ever holds more than a segment. Only a digest of a whole conversation
reads it in order, as a stream of the segments' parts.

Defined cases: a null text or role is empty; a null conversation id is a conversation; turns are ordered
by turn (null first), equal ones by role and text; a turn without text is a turn; repeated rows are
turns each; a turn longer than the budget has a window over the budget; a system turn that isn't first is
like any other; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import materialise
from tickerloom.llm.packing import WordIds

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens that a turn's marks and role count for.
MARKS = 5
#: Bytes up to which a conversation stays in one piece, and tokens of a segment of a longer one.
SEGMENT, SEGMENT_TOKENS = 1 << 16, 1 << 14
#: Windows, or rows, handed on at a time.
ROWS = 1024

c = F.col

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def _escaped_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def _plain_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def render(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted (role, text) turns, and where each escaped text stands in them."""
    parts, places, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{_escaped_role(role)}\n", escape(text)
        places.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END, "\n")
        at = places[-1][1] + len(END) + 1
    return "".join(parts), places


def spans(tokens: list[int], first_new: int, system: int, inside: bool, budget: int, history: int) -> list[tuple[int, int, int]]:
    """(history from, new from, new to) of the windows over turns of which the first ``first_new`` are history only.

    ``system`` is what a repeated system turn costs (0: there is none). With ``inside`` it is the first of the
    turns: the window that starts there has it as a new turn, and it is no history.
    """
    sums, out, at = [0, *accumulate(tokens)], [], first_new
    while at < len(tokens):
        cost = 0 if inside and at == 0 else system
        spare = max(min(history, budget - cost - tokens[at]), 0)
        back = max(bisect_left(sums, sums[at] - spare), min(int(inside), at))
        upto = max(bisect_right(sums, sums[back] + budget - cost) - 1, at + 1)
        out.append((back, at, upto))
        at = upto
    return out


def _windows_of(group: list[dict], counted: list[int], budget: int, history: int) -> list[dict]:
    """The windows of a segment's rows: a copy of the system turn, history copies, new turns."""
    kinds = [r["kind"] for r in group]
    copied = kinds.count(0)  # the system turn of an earlier segment
    inside = not copied and group[0]["opens"] and group[0]["role"] == "system"
    turns, tokens = [(r["role"], r["text"]) for r in group], counted[copied:]
    rest, system = turns[copied:], counted[0] if copied or inside else 0
    out = []
    for number, (back, at, upto) in enumerate(spans(tokens, kinds.count(1), system, inside, budget, history)):
        again = turns[:1] if copied or (inside and at) else []
        repeated = [*again, *rest[back:at]]
        text, places = render(repeated + rest[at:upto])
        targets = zip(places[len(repeated) :], rest[at:upto], strict=True)
        out.append({
            **{k: group[0][k] for k in ("key", "conv_id", "segment", "whole")}, "number": number, "last": upto == len(rest), "repeated": len(repeated),
            "tokens": sum(tokens[back:upto]) + (system if again else 0), "text": text,
            "loss": [{"start": a, "end": b} for (a, b), (role, _) in targets if role == "assistant"],
        })
    return out


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield from batch.slice(at, ROWS).to_pylist()


def _keyed(conversations: DataFrame) -> DataFrame:
    """key (a text that is never null), conv_id, turn, role, tie, text."""
    text = F.coalesce(c("text"), F.lit(""))
    key = F.coalesce(F.concat(F.lit("c"), c("conv_id").cast("string")), F.lit("none"))
    role = F.coalesce(c("role"), F.lit(""))
    return conversations.select(key.alias("key"), c("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.xxhash64(text).alias("tie"), text.alias("text"))


ORDER = ["turn", "role", "tie", "text"]
_PLACED = "key string, conv_id long, part int, before long, tokens long, turn {turn}, role string, tie long, text string"


def _placed(long: DataFrame, tokenizer_path: str) -> DataFrame:
    """Turns of long conversations with ``at``, the tokens before them in their conversation."""
    ranged = long.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("key", "turn", "role", "tie", "row").drop("row")
    ranged = ranged.sortWithinPartitions("key", *ORDER)
    schema = _PLACED.format(turn=long.schema["turn"].dataType.simpleString())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, key, before = WordIds(tokenizer_path), TaskContext.get().partitionId(), None, 0
        for batch in batches:
            sums, counts = [], []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                key, before = k, before if k == key else 0
                counts.append(len(words.of(text)) // 4 + MARKS)
                sums.append(before)
                before += counts[-1]
            new = {"part": pa.array([part] * len(sums), pa.int32()), "before": pa.array(sums, pa.int64()), "tokens": pa.array(counts, pa.int64())}
            names = ["key", "conv_id", *new, "turn", "role", "tie", "text"]
            yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names=names)

    rows = materialise(ranged.mapInArrow(work, schema))
    totals = rows.groupBy("key", "part").agg(F.sum("tokens").alias("total"))
    # a conversation has at most one total for each range
    earlier = W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = materialise(totals.select("key", "part", F.sum("total").over(earlier).alias("carried")).filter("carried is not null"))
    at = F.coalesce(c("carried"), F.lit(0)) + c("before")
    return rows.join(carried, ["key", "part"], "left").withColumn("at", at).drop("carried", "part", "before")


def segments(conversations: DataFrame, tokenizer_path: str, history: int) -> DataFrame:
    """Turns dealt to segments: key, conv_id, segment, whole, opens, kind (0 system copy, 1 history copy, 2 new), turn, role, tie, text."""
    if history >= SEGMENT_TOKENS:
        raise ValueError("history must be shorter than a segment")
    turns = _keyed(conversations)
    sizes = turns.groupBy("key").agg(F.sum(F.octet_length("text") + MARKS).alias("size"))
    long = materialise(sizes.filter(c("size") > SEGMENT).select("key"))
    out = ["key", "conv_id", "segment", "whole", "opens", "kind", *ORDER]
    short = turns.join(long, "key", "left_anti").withColumns({"segment": F.lit(0).cast("long"), "whole": F.lit(True), "opens": F.lit(True), "kind": F.lit(2)})
    if not long.limit(1).count():
        return short.select(out)
    placed = materialise(_placed(turns.join(long, "key", "left_semi"), tokenizer_path))
    segment = F.floor(c("at") / SEGMENT_TOKENS)
    new = placed.withColumns({"segment": segment, "whole": F.lit(False), "opens": segment == 0, "kind": F.lit(2)})
    near = new.filter(c("at") >= (c("segment") + 1) * SEGMENT_TOKENS - history)
    near = near.withColumns({"segment": c("segment") + 1, "opens": F.lit(False), "kind": F.lit(1)})
    last = new.groupBy("key").agg(F.max("segment").alias("last")).filter("last > 0")
    system = new.filter((c("at") == 0) & (c("role") == "system")).join(last, "key")
    system = system.withColumns({"segment": F.explode(F.sequence(F.lit(1).cast("long"), "last")), "opens": F.lit(False), "kind": F.lit(0)})
    return short.select(out).unionByName(new.select(out)).unionByName(near.select(out)).unionByName(system.select(out))


_WINDOW = pa.schema([
    ("key", pa.string()), ("conv_id", pa.int64()), ("segment", pa.int64()), ("number", pa.int64()), ("last", pa.bool_()), ("whole", pa.bool_()),
    ("repeated", pa.int32()), ("tokens", pa.int64()), ("text", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
])
WINDOWS = (
    "key string, conv_id long, segment long, number long, last boolean, whole boolean, repeated int, tokens long, text string, "
    "loss array<struct<start:int,end:int>>"
)


def windows(conversations: DataFrame, tokenizer_path: str, budget: int = 1024, history: int = 256) -> DataFrame:
    """Formatted windows: conv_id, segment, number, last, whole, repeated, tokens, text, loss, in order within their task.

    The first ``repeated`` turns of ``text`` repeat earlier ones; ``loss`` are the spans (code points) under the
    loss mask; ``last`` marks a segment's last window, ``whole`` a segment that is the whole conversation.
    """
    dealt = segments(conversations, tokenizer_path, history)
    dealt = dealt.repartition("key", "segment").sortWithinPartitions("key", "segment", "kind", *ORDER)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_path)

        def made() -> Iterator[dict]:
            for _, rows in groupby(_rows(batches), key=lambda r: (r["key"], r["segment"])):
                group = list(rows)
                if group[-1]["kind"] == 2:  # else copies for a segment that one long turn passes over
                    yield from _windows_of(group, [len(words.of(r["text"])) // 4 + MARKS for r in group], budget, history)

        return _batches(made(), _WINDOW, ROWS)

    return dealt.mapInArrow(work, WINDOWS)


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted window."""
    return [(_plain_role(role), unescape(body)) for role, body in _TURN.findall(text)]


_READ = pa.schema([
    ("key", pa.string()), ("conv_id", pa.int64()), ("segment", pa.int64()), ("number", pa.int64()), ("n_turns", pa.int64()), ("loss_chars", pa.int64()),
    ("formatted_chars", pa.int64()), ("turns_sha256", pa.string()), ("loss_sha256", pa.string()), ("turns", pa.binary()), ("loss", pa.binary()),
])
_READ_SQL = (
    "key string, conv_id long, segment long, number long, n_turns long, loss_chars long, formatted_chars long, "
    "turns_sha256 string, loss_sha256 string, turns binary, loss binary"
)


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows to one row for each stretch of a segment: digests if that is a whole conversation, else its bytes."""

    def read() -> Iterator[dict]:
        # a stretch has windows in a row, so windows in another order make more stretches
        for _, rows in groupby(enumerate(_rows(batches)), key=lambda r: (r[1]["key"], r[1]["segment"], r[1]["number"] - r[0])):
            turns, loss, n, chars, formatted, first, last = [], [], 0, 0, 0, None, None
            for _, row in rows:
                first, last = first or row, row
                new = parse(row["text"])[row["repeated"] :]
                turns += [f"{role}\n{text}\n" for role, text in new]
                targets = [unescape(row["text"][s["start"] : s["end"]]) for s in row["loss"]]
                loss += targets
                n, chars, formatted = n + len(new), chars + sum(map(len, targets)), formatted + len(row["text"])
            parts = {"turns": "".join(turns).encode(), "loss": "".join(loss).encode()}
            done = first["whole"] and first["number"] == 0 and last["last"]
            yield {
                **{k: first[k] for k in ("key", "conv_id", "segment", "number")}, "n_turns": n, "loss_chars": chars, "formatted_chars": formatted,
                **{f"{k}_sha256": hashlib.sha256(v).hexdigest() if done else None for k, v in parts.items()},
                **{k: None if done else v for k, v in parts.items()},
            }

    return _batches(read(), _READ, ROWS)


def _read_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order, a part in memory at a time, to one row for each conversation."""

    def read() -> Iterator[dict]:
        rows = (r for batch in batches for at in range(batch.num_rows) for r in batch.slice(at, 1).to_pylist())
        for _, parts in groupby(rows, key=lambda r: r["key"]):
            total, digests = None, {"turns": hashlib.sha256(), "loss": hashlib.sha256()}
            for part in parts:
                total = total or {**part, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "turns": None, "loss": None}
                for name in ("n_turns", "loss_chars", "formatted_chars"):
                    total[name] += part[name]
                for name, digest in digests.items():
                    digest.update(part[name])
            yield total | {f"{k}_sha256": d.hexdigest() for k, d in digests.items()}

    return _batches(read(), _READ, ROWS)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``turns_sha256`` is of role, newline, text, newline for each turn, ``loss_sha256`` of all text under the loss mask.
    """
    found = materialise(formatted.mapInArrow(_read_segments, _READ_SQL))
    rest = found.filter("turns is not null").repartition("key").sortWithinPartitions("key", "segment", "number")
    every = found.filter("turns is null").unionByName(rest.mapInArrow(_read_long, _READ_SQL))
    return every.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
