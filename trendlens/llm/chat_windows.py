"""Chat formatting in budgeted windows.

A conversation becomes one or more samples.  Prefix sums of the turns' token
counts choose turn-aligned spans: a window holds the system turn, some turns
of history repeated from the window before, and as many new turns as fit the
budget (one at least, so a longer turn makes a window of its own).  Loss falls
on the texts of new assistant turns only; repeated targets are masked.

Template of a turn (role and text escaped):

    ### {role}: {text} </turn>\\n

Escapes: a backslash doubles, ``###`` becomes ``\\h``, ``</turn>`` becomes
``\\c`` and, in roles, ``:`` becomes ``\\k``.  So neither mark can stand inside
a role or a text, and reading back restores every character.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import WORD_PATTERN, shuffle_partitions, written

#: Tokens (words and marks) of a window, and of the history it may repeat.
BUDGET = 512
HISTORY = 96
#: Tokens that the marks of a turn count.
TURN_MARKS = 3

_OUT = [("\\", "\\\\"), ("###", "\\h"), ("</turn>", "\\c")]
_BACK = {"\\": "\\", "h": "###", "c": "</turn>", "k": ":"}
_TURN = re.compile(r"### (.*?): (.*?) </turn>\n", re.S)


def escape(text: str, role: bool = False) -> str:
    for a, b in _OUT:
        text = text.replace(a, b)
    return text.replace(":", "\\k") if role else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text) if "\\" in text else text


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn and where its text starts and ends in it."""
    head, body = f"### {escape(role, True)}: ", escape(text)
    return f"{head}{body} </turn>\n", len(head), len(head) + len(body)


def parse(sample: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a sample."""
    out, at = [], 0
    for m in _TURN.finditer(sample):
        if m.start() != at:
            raise ValueError("a sample holds text outside its turns")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(sample):
        raise ValueError("a sample ends inside a turn")
    return out


SCHEMA = "conv_id long, window long, sample string, repeated int, spans array<struct<start:int,end:int>>"


class _Windows:
    """Streams turns in (conversation, turn) order and yields its windows; holds one window at most."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.conv: object = self        # no conversation yet
        self.rows: list[tuple] = []

    def open(self, conv) -> None:
        self.conv, self.window = conv, 0
        self.system: list[tuple[str, str, int]] = []
        self.past: list[tuple[str, str, int]] = []
        self.new: list[tuple[str, str]] = []
        self.keep: tuple[str, str, int] | None = None
        self.base, self.first = 0, True

    def close(self) -> None:
        if self.new:
            self.emit()

    def emit(self) -> None:
        parts, spans, at = [], [], 0
        old = [(r, t) for r, t, _ in self.system + self.past]
        for k, (role, text) in enumerate(old + self.new):
            turn, a, b = format_turn(role, text)
            if k >= len(old) and role == "assistant":
                spans.append({"start": at + a, "end": at + b})
            parts.append(turn)
            at += len(turn)
        self.rows.append((self.conv, self.window, "".join(parts), len(old), spans))
        self.window += 1

    def add(self, conv, role: str, text: str, tokens: int, prefix: int) -> None:
        """``prefix``: tokens of the conversation up to and with this turn."""
        if self.conv is self or conv != self.conv:
            if self.conv is not self:
                self.close()
            self.open(conv)
        # self.base: the prefix sum at which this window's new turns start, less what it repeats
        if self.new and prefix - self.base > self.budget:
            self.emit()
            kept = self.past_of(self.recent)
            self.past, self.new = kept, []
            self.base = prefix - tokens - sum(n for *_, n in self.system + self.past)
        turn = (role, text, tokens)
        if not self.new:
            self.recent: list[tuple[str, str, int]] = list(self.past)
        if self.first and role == "system":
            self.keep = turn
        self.first = False
        self.new.append((role, text))
        self.recent.append(turn)
        while len(self.recent) > 1 and sum(n for *_, n in self.recent) - self.recent[0][2] >= self.history:
            self.recent.pop(0)

    def past_of(self, recent: list[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
        """The system turn is retained; of the turns before, the last that fit the history budget."""
        self.system = [self.keep] if self.keep else []
        kept, room = [], self.history
        for turn in reversed(recent):
            if turn[2] > room or (self.keep is not None and turn is self.keep):
                break
            kept.insert(0, turn)
            room -= turn[2]
        return kept


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Samples of all conversations: ``conv_id``, ``window``, ``sample``, ``repeated``, ``spans``.

    ``repeated`` counts the leading turns a sample repeats; ``spans`` are the
    loss spans (code points in the sample).  Rows are taken by turn (null
    first), then role, then text; repeated rows are turns like any other.  A
    null text or role is empty; rows without conversation id form one
    conversation.  An empty table gives no sample; other columns are not
    read.  A conversation is streamed, one window in memory at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(budget, history)
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text", "tokens", "prefix")),
                           strict=True):
                windows.add(*row)
                if len(windows.rows) >= 256:
                    yield to_batch(windows.rows)
                    windows.rows = []
        if windows.conv is not windows:
            windows.close()
        if windows.rows:
            yield to_batch(windows.rows)

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(),
                 pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=["conv_id", "window", "sample", "repeated", "spans"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"), text.alias("text"))
    counted = slim.withColumn("tokens", F.regexp_count("text", F.lit(WORD_PATTERN)) + TURN_MARKS)
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    prefix = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # the window's sort by (conversation, turn) is also the order of the stream below
    return counted.withColumn("prefix", prefix).select("conv", "role", "text", "tokens", "prefix").mapInArrow(run, SCHEMA)


def read_samples(samples: DataFrame) -> DataFrame:
    """Per conversation, read back from samples: turns, loss text and their digests.

    ``turns_sha256`` covers role, newline, text, newline of each turn once, in
    order; ``loss_sha256`` all text under the loss spans, unescaped.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, rows = None, None, []

        def done() -> None:
            n, turns, chars, loss, size = state
            rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != conv:
                    if state is not None:
                        done()
                    conv, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                sample = row["sample"]
                for role, text in parse(sample)[row["repeated"]:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in row["spans"]:
                    text = unescape(sample[span["start"]:span["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(sample)
            if rows:
                yield pack(rows)
                rows = []
        if state is not None:
            done()
            yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=fields)

    fields = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    n = shuffle_partitions(samples.sparkSession)
    return samples.repartition(n, "conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")


def format_and_read(turns: DataFrame, **options) -> DataFrame:
    """Formats, writes the samples, and reads them back into one row per conversation."""
    return read_samples(written(format_conversations(turns, **options), "chat"))
