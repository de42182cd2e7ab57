"""Conversation structure repair by generalised LR over the role grammar.

Legal role sequences are ``(s?(ua)+)?`` over the roles' first letters:

    C -> (nothing) | P | s P        P -> u a | P u a

A conversation's rows are parsed with every edit that could mend it: keep a
row, give it the role user or assistant, delete it, insert an empty user or
assistant turn.  The parser keeps a graph-structured stack: stack nodes (an LR
state on top of another node) are interned, so equal stacks are one node and
longer stacks share the nodes below.  Where two ways of editing reach an equal
stack top after the same row, the one with the least (cost, audit) stays; the
audit is the string of edits' initials.  Audits are compared by rank: after a
row, no audit is the start of another, so ranks of the audits so far and the
edits since decide, and no strings are compared as they grow.

Scale.  A conversation is cut into segments of ``SEGMENT`` positions, parsed
in parallel: the first from the empty stack, others from every stack a
conversation can have (eight).  A stream over a conversation's segments then
chooses, by the same rule, which way each segment goes: one short row for a
segment, whatever its texts hold.  Texts are repaired segment by segment.  Of
a conversation of one segment the digest is taken there; only longer ones
stream their repaired text, in pieces, through one task, as SHA-256 asks for.

Defined results: rows are taken by turn (null first), then role, then text;
a null role or text is one space; rows without conversation id are one
conversation.  Repeated rows are duplicates.  A conversation without rows
needs no edit.  An empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import shuffle_partitions
from trendlens.llm.ordered import positions

#: Positions of a segment, and bytes of a piece of repaired text.
SEGMENT = 256
PIECE_BYTES = 4 << 20

GRAMMAR = (("C", ()), ("C", ("P",)), ("C", ("s", "P")), ("P", ("u", "a")), ("P", ("P", "u", "a")))
START, END = "C", "$"
ROLES = {"u": "user", "a": "assistant"}

#: Costs of edits; a truncated row that stays adds ``TRUNCATED``.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

WHITE = " \t\n\x0b\x0c\r"


class RoleParser:
    """LR(0) automaton of the role grammar and the interned nodes of its graph-structured stack."""

    def __init__(self, grammar=GRAMMAR, start: str = START):
        self.rules = (("", (start,)), *grammar)
        heads = {h for h, _ in grammar}

        def closed(items):
            out, todo = set(items), list(items)
            while todo:
                rule, dot = todo.pop()
                body = self.rules[rule][1]
                if dot < len(body) and body[dot] in heads:
                    for k, (head, _) in enumerate(self.rules):
                        if head == body[dot] and (k, 0) not in out:
                            out.add((k, 0))
                            todo.append((k, 0))
            return frozenset(out)

        states, self.goto = [closed({(0, 0)})], []
        for items in states:                # grows while it is read
            moves = {}
            for symbol in sorted({self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}):
                after = closed({(r, d + 1) for r, d in items if d < len(self.rules[r][1]) and self.rules[r][1][d] == symbol})
                if after not in states:
                    states.append(after)
                moves[symbol] = states.index(after)
            self.goto.append(moves)
        self.complete = [[r for r, d in sorted(items) if d == len(self.rules[r][1])] for items in states]
        self.terminals = sorted({s for _, body in grammar for s in body} - heads)
        # node 0 is the empty stack; a node is (LR state, node below)
        self.nodes: list[tuple[int, int]] = [(0, -1)]
        self.known = {(0, -1): 0}
        self.shifts: dict[tuple[int, str], tuple[int, ...]] = {}
        self.ends: dict[int, bool] = {}
        self._explore()

    def _node(self, state: int, below: int) -> int:
        if (state, below) not in self.known:
            self.known[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.known[state, below]

    def _reduced(self, node: int) -> list[int]:
        """The node and every node that reductions lead to."""
        out, todo = [node], [node]
        while todo:
            top = todo.pop()
            for rule in self.complete[self.nodes[top][0]]:
                head, body = self.rules[rule]
                if not head:
                    continue
                base = top
                for _ in body:
                    base = self.nodes[base][1]
                state = self.goto[self.nodes[base][0]].get(head)
                if state is not None and (reduced := self._node(state, base)) not in out:
                    out.append(reduced)
                    todo.append(reduced)
        return out

    def _explore(self) -> None:
        """All stacks that can stand between two rows, their shifts, and which may end a conversation."""
        tops = [0]
        for top in tops:                    # grows while it is read
            self.ends[top] = any(0 in self.complete[self.nodes[n][0]] for n in self._reduced(top))
            for symbol in self.terminals:
                state = self.goto[self.nodes[top][0]].get(symbol)
                after = () if state is None else tuple(
                    n for n in self._reduced(self._node(state, top))
                    if any(t in self.goto[self.nodes[n][0]] for t in self.terminals))
                self.shifts[top, symbol] = after
                tops += [n for n in after if n not in tops]
            if len(tops) > 64:
                raise ValueError("the role grammar needs stacks without bound")
        self.tops = tops

    def insertions(self, frontier: dict[int, tuple], cost) -> dict[int, tuple]:
        """``frontier`` with every stack that insertions reach; values are (cost, rank, edits since)."""
        best, todo = dict(frontier), list(frontier)
        while todo:
            top = todo.pop()
            value, rank, edits, link = best[top]
            for symbol in ROLES:
                for after in self.shifts[top, symbol]:
                    new = (value + cost, rank, edits + "I", link)
                    if after not in best or new[:3] < best[after][:3]:
                        best[after] = new
                        todo.append(after)
        return best


PARSER = RoleParser()


def ranked(frontier: dict[int, tuple]) -> dict[int, tuple]:
    """The frontier after a row: edits go to the links, and audits are ranked anew."""
    order = {key: i for i, key in enumerate(sorted({(rank, edits) for _, rank, edits, _ in frontier.values()}))}
    return {top: (cost, order[rank, edits], "", (link, edits)) for top, (cost, rank, edits, link) in frontier.items()}


def _text(link) -> str:
    pieces = []
    while link is not None:
        link, piece = link
        pieces.append(piece)
    return "".join(reversed(pieces))


def parse_segment(rows: list[tuple[str, str]], entry: int, parser: RoleParser = PARSER) -> list[tuple[int, int, str]]:
    """(stack, cost, audit) of each stack that rows of (initial, fault) can lead to from ``entry``.

    Faults: ``b`` blank and ``d`` duplicate (such a row must go), ``t`` truncated, else ``-``.
    """
    frontier = {entry: (0, 0, "", None)}
    for initial, fault in rows:
        reached: dict[int, tuple] = {}

        def offer(top: int, value: tuple) -> None:
            if top not in reached or value[:3] < reached[top][:3]:
                reached[top] = value

        stay = TRUNCATED if fault == "t" else 0
        for top, (cost, rank, edits, link) in parser.insertions(frontier, INSERT).items():
            offer(top, (cost + DELETE, rank, edits + "D", link))
            if fault in "bd":
                continue
            for after in parser.shifts.get((top, initial), ()):
                offer(after, (cost + stay, rank, edits + "K", link))
            for symbol in ROLES:
                for after in parser.shifts[top, symbol]:
                    offer(after, (cost + REROLE + stay, rank, edits + "R", link))
        frontier = ranked(reached)
    return [(top, cost, _text(link)) for top, (cost, _, _, link) in frontier.items()]


class Chain:
    """Chooses, segment by segment, the least (cost, audit) to each stack of a conversation."""

    def __init__(self, parser: RoleParser = PARSER):
        self.parser, self.frontier = parser, {0: (0, 0, "", None)}

    def add(self, ways: list[tuple[int, int, int, str]]) -> None:
        """``ways``: (stack before, stack after, cost, audit) of one segment."""
        reached: dict[int, tuple] = {}
        for entry, after, cost, audit in ways:
            if entry in self.frontier:
                before, rank, _, link = self.frontier[entry]
                value = (before + cost, rank, audit, (link, entry))
                if after not in reached or value[:3] < reached[after][:3]:
                    reached[after] = value
        order = {key: i for i, key in enumerate(sorted({v[1:3] for v in reached.values()}))}
        self.frontier = {top: (cost, order[rank, audit], "", (link[0], link[1], audit))
                         for top, (cost, rank, audit, link) in reached.items()}

    def end(self) -> tuple[int, list[tuple[int, str]]]:
        """The cost, and (stack before, audit) of each segment."""
        done = {top: v for top, v in self.parser.insertions(self.frontier, INSERT).items() if self.parser.ends[top]}
        cost, _, edits, link = min(done.values(), key=lambda v: v[:3])
        pieces = []
        while link is not None:
            link, entry, audit = link
            pieces.append((entry, audit))
        pieces.reverse()
        if edits:
            entry, audit = pieces[-1] if pieces else (0, "")
            pieces[-1:] = [(entry, audit + edits)]
        return cost, pieces


class Apply:
    """Applies a segment's audit to its rows, in order."""

    def __init__(self, entry: int, audit: str, parser: RoleParser = PARSER):
        self.top, self.audit, self.at, self.parser = entry, audit, 0, parser

    def _role(self) -> str:
        """The one role that an insertion or a new role can have here."""
        symbol = next(s for s in ROLES if self.parser.shifts[self.top, s])
        self.top, = self.parser.shifts[self.top, symbol]
        return ROLES[symbol]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """The turns inserted before the next row (or at the end)."""
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._role(), "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.top, = self.parser.shifts[self.top, role[:1]]
            yield role, text, "K"
        elif edit == "R":
            yield self._role(), text, "R"


# -- rows ------------------------------------------------------------------------

def ordered_rows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """``conv, pos, turn, role, text``: rows in order, null roles and texts as one space."""
    space = F.lit(" ")
    slim = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(role_col, space).alias("role"), F.coalesce(text_col, space).alias("text"))
    return positions(slim, "conv", ["turn", "role", "text"], "pos", name="repair-rows")


def damaged(rows: DataFrame) -> DataFrame:
    """Ordered rows, damaged by crc32(``conv_id:turn``) % 20 (null: one space); ``pos`` keeps the order, not the count.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets its role to user.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key) % 20
    copies = F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv", "turn", "pos", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("_copy")).select(
        "conv", (F.col("pos") * 2 + F.col("_copy")).alias("pos"), "turn", "role", "text")


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def faulted(rows: DataFrame) -> DataFrame:
    """``conv, pos, segment, initial, fault`` of ordered rows: b blank, d duplicate, t truncated, else -.

    A row is a duplicate where its conversation has its role and text at a
    smaller position; first positions are gathered by one digest of all three
    before anything is joined, and only of what stands more than once.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    same = F.unhex(F.sha2(F.concat(F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.lit(":"),
                                   F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    marked = rows.select(
        "conv", "pos", F.floor(F.col("pos") / SEGMENT).alias("segment"), _initial(F.col("role")).alias("initial"),
        F.when(trimmed == "", "b").when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "-").otherwise("t").alias("own"),
        same.alias("same"))
    firsts = marked.groupBy("same").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "same", "first")
    later = F.coalesce(F.col("pos") > F.col("first"), F.lit(False)) & (F.col("own") != "b")
    return marked.join(firsts, "same", "left").select(
        "conv", "pos", "segment", "initial", F.when(later, "d").otherwise(F.col("own")).alias("fault"))


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)],
                                      names=[n for n, _ in fields])


def _ways(faults: DataFrame) -> DataFrame:
    """``conv, segment, ways``: how each segment leads from stacks to stacks."""
    kinds = [("conv", pa.int64()), ("segment", pa.int64()), ("ways", pa.list_(pa.struct(
        [("entry", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, segment, rows in zip(*(batch.column(c).to_pylist() for c in ("conv", "segment", "rows")),
                                           strict=True):
                codes = [(r["initial"], r["fault"]) for r in rows]
                out.append((conv, segment, [
                    {"entry": entry, "after": top, "cost": cost, "audit": audit}
                    for entry in (PARSER.tops if segment else [0]) for top, cost, audit in parse_segment(codes, entry)]))
                if len(out) == 256:
                    yield _batch(out, kinds)
                    out = []
            yield _batch(out, kinds)

    # at most two rows a position and SEGMENT positions
    held = faults.groupBy("conv", "segment").agg(F.array_sort(F.collect_list(F.struct("pos", "initial", "fault"))).alias("rows"))
    return held.mapInArrow(
        run, "conv long, segment long, ways array<struct<entry:int,after:int,cost:long,audit:string>>")


def _choices(ways: DataFrame) -> DataFrame:
    """``conv, segment, entry, audit, cost, segments``: the way each segment goes; ``cost`` of the conversation."""
    kinds = [("conv", pa.int64()), ("segment", pa.int64()), ("entry", pa.int32()), ("audit", pa.string()),
             ("cost", pa.int64()), ("segments", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chain, numbers, out = None, None, [], []

        def done() -> None:
            cost, pieces = chain.end()
            out.extend((conv, n, entry, audit, cost, len(numbers))
                       for n, (entry, audit) in zip(numbers, pieces, strict=True))

        for batch in batches:
            for this, number, options in zip(*(batch.column(c).to_pylist() for c in ("conv", "segment", "ways")),
                                             strict=True):
                if chain is None or this != conv:
                    if chain is not None:
                        done()
                    conv, chain, numbers = this, Chain(), []
                # the first segment with rows starts from nothing, whatever its number
                entries = options if numbers else [w for w in options if w["entry"] == 0]
                chain.add([(w["entry"], w["after"], w["cost"], w["audit"]) for w in entries])
                numbers.append(number)
                if len(out) >= 1024:
                    yield _batch(out, kinds)
                    out.clear()
        if chain is not None:
            done()
        yield _batch(out, kinds)

    return ways.repartition(shuffle_partitions(ways.sparkSession), "conv").sortWithinPartitions(
        "conv", "segment").mapInArrow(run, "conv long, segment long, entry int, audit string, cost long, segments long")


def _together(rows: DataFrame, faults: DataFrame, choices: DataFrame) -> DataFrame:
    """Every segment's choice followed by its faults and its rows, in order, each segment in one task."""
    none = {c: F.lit(None) for c in ("entry", "audit", "cost", "segments", "turn", "role", "text", "fault")}
    columns = ["conv", "segment", "pos", "kind", *none]

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        held = df.withColumn("kind", F.lit(kind))
        return held.withColumns({c: v for c, v in none.items() if c not in df.columns}).select(*columns)

    schema = {"entry": "int", "audit": "string", "cost": "long", "segments": "long", "turn": "long", "role": "string",
              "text": "string", "fault": "string"}
    none = {c: v.cast(schema[c]) for c, v in none.items()}
    parts = [shaped(choices.withColumn("pos", F.lit(-1).cast("long")), 0),
             shaped(faults.select("conv", "segment", "pos", "fault"), 1),
             shaped(rows.withColumn("segment", F.floor(F.col("pos") / SEGMENT)), 2)]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.repartition(shuffle_partitions(rows.sparkSession), "conv", "segment").sortWithinPartitions(
        "conv", "segment", "pos", "kind")


def _plan(rows: DataFrame) -> DataFrame:
    faults = faulted(rows)
    return _together(rows, faults, _choices(_ways(faults)))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("open", conv, segment, choice), ("row", turn, role, text, fault) and ("close",) events of ``_together``."""
    at, fault = None, "-"
    for batch in batches:
        for conv, segment, _, kind, entry, audit, cost, segments, turn, role, text, code in zip(
                *(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 0:
                if at is not None:
                    yield ("close",)
                at = (conv, segment)
                yield "open", conv, segment, (entry, audit, cost, segments)
            elif kind == 1:
                fault = code
            else:
                yield "row", turn, role, text, fault
    if at is not None:
        yield ("close",)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """``conv, segment, at, role, text, edit``: the repaired turns of ordered rows, in order of (segment, at)."""
    kinds = [("conv", pa.int64()), ("segment", pa.int64()), ("at", pa.int64()), ("role", pa.string()),
             ("text", pa.string()), ("edit", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, segment, apply, at = [], None, None, None, 0
        for kind, *event in _segments(batches):
            if kind == "open":
                conv, segment, (entry, audit, *_) = event
                apply, at = Apply(entry, audit), 0
                continue
            turns = apply.row(event[1], event[2]) if kind == "row" else apply.inserted()
            for turn in turns:
                out.append((conv, segment, at, *turn))
                at += 1
            if len(out) >= 256:
                yield _batch(out, kinds)
                out = []
        yield _batch(out, kinds)

    return _plan(rows).mapInArrow(run, "conv long, segment long, at long, role string, text string, edit string")


#: What is known of one segment; ``sha`` where it is the whole conversation, else ``pieces`` of its repaired text.
_REPORT = [("conv", pa.int64()), ("segment", pa.int64()), ("piece", pa.int64()), ("blank", pa.int64()),
           ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("turns", pa.int64()),
           ("low", pa.int64()), ("high", pa.int64()), ("first", pa.string()), ("last", pa.string()),
           ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string()), ("text", pa.binary())]
_REPORT_SCHEMA = ("conv long, segment long, piece long, blank long, duplicate long, truncated long, illegal long, "
                  "turns long, low long, high long, first string, last string, cost long, audit string, sha string, "
                  "text binary")
LEGAL = ("su", "ua", "au")


def _reports(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for kind, *event in _segments(batches):
            if len(out) >= 256 or held >= PIECE_BYTES:
                yield _batch(out, _REPORT)
                out, held = [], 0
            if kind == "open":
                conv, segment, (entry, audit, cost, segments) = event
                apply, sha, parts, size, piece, begun = Apply(entry, audit), hashlib.sha256(), [], 0, 0, False
                counts, illegal, turns, low, high = {"b": 0, "d": 0, "t": 0, "-": 0}, 0, 0, None, None
                first, last = None, None
                continue
            if kind == "row":
                turn, role, text, fault = event
                counts[fault] += 1
                initial = role[:1]
                illegal += last is not None and last + initial not in LEGAL
                first, last = initial if first is None else first, initial
                if turn is not None:
                    turns += turn != high
                    low, high = turn if low is None else low, turn
                mended = apply.row(role, text)
            else:
                mended = apply.inserted()
            for role, text, _ in mended:
                # texts join by newlines; a later segment's first line starts with one
                line = f"\n{role}:{text}" if begun or segments > 1 else f"{role}:{text}"
                begun = True
                if segments == 1:
                    sha.update(line.encode())
                    continue
                parts.append(line.encode())
                size += len(parts[-1])
                if size >= PIECE_BYTES:
                    out.append((conv, segment, piece, *[None] * 12, b"".join(parts)))
                    parts, size, piece, held = [], 0, piece + 1, held + size
            if kind == "close":
                out.append((conv, segment, piece, counts["b"], counts["d"], counts["t"], illegal, turns, low, high,
                            first, last, cost, audit, sha.hexdigest() if segments == 1 else None, b"".join(parts)))
                held += size
        yield _batch(out, _REPORT)

    return _plan(rows).mapInArrow(run, _REPORT_SCHEMA)


_SUMMARY = [("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal",
                                                                 "cost")), ("audit", pa.string()),
            ("repaired_sha256", pa.string())]
_SUMMARY_SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                   "audit string, repaired_sha256 string")


def summaries(turns: DataFrame, rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation of ``turns``: faults of ``rows``, the repair's cost and audit, and the digest of what it gives.

    ``rows`` are ordered rows (``ordered_rows``, perhaps ``damaged``).  Texts
    pass only where a conversation has several segments.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out = None, []

        def done() -> None:
            gaps = state["high"] - state["low"] + 1 - state["turns"] if state["turns"] else 0
            out.append((state["conv"], gaps, state["blank"], state["duplicate"], state["truncated"], state["illegal"],
                        state["cost"], "".join(state["audit"]), state["sha"] or state["digest"].hexdigest()))

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or state["conv"] != row["conv"]:
                    if state is not None:
                        done()
                    state = {"conv": row["conv"], "turns": 0, "low": None, "high": None, "last": None, "audit": [],
                             "sha": None, "digest": hashlib.sha256(), "begun": False,
                             **dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)}
                if row["text"]:
                    # the newline before the first line goes
                    state["digest"].update(row["text"] if state["begun"] else row["text"][1:])
                    state["begun"] = True
                if row["audit"] is None:
                    continue
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    state[c] += row[c]
                if state["last"] is not None and row["first"] is not None:
                    state["illegal"] += state["last"] + row["first"] not in LEGAL
                state["last"] = row["last"] if row["last"] is not None else state["last"]
                if row["turns"]:
                    state["turns"] += row["turns"] - (row["low"] == state["high"])
                    state["low"] = row["low"] if state["low"] is None else state["low"]
                    state["high"] = row["high"]
                state["cost"], state["sha"] = row["cost"], row["sha"]
                state["audit"].append(row["audit"])
            if len(out) >= 1024:
                yield _batch(out, _SUMMARY)
                out.clear()
        if state is not None:
            done()
        yield _batch(out, _SUMMARY)

    reports = _reports(rows)
    # every conversation has a row, before those of its segments, even where damage left it none
    names = turns.select(F.col(conv_col).cast("long").alias("conv")).distinct().withColumn("segment", F.lit(-1).cast("long"))
    names = names.select(*(F.col(c) if c in ("conv", "segment") else F.lit(None).cast(reports.schema[c].dataType).alias(c)
                           for c in reports.columns))
    return names.unionByName(reports).repartition(shuffle_partitions(turns.sparkSession), "conv").sortWithinPartitions(
        "conv", "segment", "piece").mapInArrow(run, _SUMMARY_SCHEMA)


def repair_damaged(turns: DataFrame) -> DataFrame:
    """Conversations are ordered, damaged and repaired; one row for each."""
    return summaries(turns, damaged(ordered_rows(turns)))
