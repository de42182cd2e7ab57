"""Secret scans by assignment-aware lexing.

A text is lexed as source or configuration syntax into names, literals and
the operators between them (``=``, ``:``, ``:=``, ``=>``), which gives
name-literal pairs: ``db.password: 'x'``, ``"api_key": "x"``, ``TOKEN=x``.
Constants propagate: a name bound to a literal passes it on (``key = base`` or
``key = base + "x"``), so a literal is scored by the most sensitive name it
reaches.  A literal is a secret when its score, sensitivity of the name times
randomness of the literal, reaches ``THRESHOLD``.

Base spans are found by patterns and always stay: ``assign``, ``access`` and
``hex``.  The method adds spans of kind ``literal`` that no base span covers.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import batches_of, texts

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

#: How sensitive a name is: its parts (split at case changes and separators) against these.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "private": 0.8, "auth": 0.8, "authorization": 0.8, "bearer": 0.8,
    "signature": 0.7, "access": 0.7, "key": 0.7, "salt": 0.6, "session": 0.6, "cookie": 0.6, "dsn": 0.6,
}
THRESHOLD = 0.55
SHORTEST = 8
#: Words that sentences and messages are made of; a passphrase is scored by its other words.
COMMON = frozenset(
    "a an and any are as at be been by can cannot could do does enter expired failed for from has have here if in "
    "incorrect invalid is it its may missing must new no not of on or our please required set should so that the "
    "their then there these they this to use valid value was we were when which will with wrong you your".split())
#: Such words that make a literal as good as random.
PHRASE = 5

# the letters of names; a name starts at the first letter or underscore of such a run and takes the rest of it
_RUN = re.compile(r"[A-Za-z0-9_.-]++")
_FIRST = re.compile(r"[A-Za-z_]")
# then an operator: the left side of a pair
_OPERATOR = re.compile(r"[ \t]*(?::=|=>|=(?![=~])|:(?![:/]))[ \t]*")
# one operand of the right side
_QUOTED = re.compile(r""""(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'""")
_WORD = re.compile(r"[A-Za-z0-9+/_.=~@!$%^&*-]+")
_PLUS = re.compile(r"[ \t]*(?:\+|\.\.)[ \t]*")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*+")


def sensitivity(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = {a + b for a, b in zip(parts, parts[1:])}
    return max((SENSITIVE.get(p, 0.0) for p in [*parts, *joined]), default=0.0)


def randomness(literal: str) -> float:
    """0 to 1: entropy of the characters against that of a random string as long, and mixed character kinds."""
    n = len(literal)
    if n < SHORTEST:
        return 0.0
    return _phrase(literal.split()) if " " in literal else _mixture(Counter(literal), n)


def _mixture(counts: Counter, n: int) -> float:
    """``randomness`` of ``n`` characters (none of them a blank) by their counts."""
    if n < SHORTEST:
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    share = min(1.0, entropy / math.log2(min(n, 64)))
    kinds = (any(c.isdigit() for c in counts) + any(c.islower() for c in counts) + any(c.isupper() for c in counts)
             + any(not c.isalnum() for c in counts))
    return share * (0.5 if kinds < 2 else 0.85 if kinds == 2 else 1.0)


def _scored(text: str, wanted: dict[tuple[int, int], float]) -> list[tuple[int, int]]:
    """The spans whose literal's randomness times ``wanted``'s factor reaches the threshold.

    Literals that end together are each other's ends (``a=b=c``), so their
    characters are counted once, from the last to the first.
    """
    out, end, at, counts = [], None, 0, Counter()
    for a, b in sorted(wanted, key=lambda span: (span[1], -span[0])):
        if b != end:
            end, at, counts = b, b, Counter()
        counts.update(text[a:at])
        at = a
        score = randomness(text[a:b]) if counts[" "] else _mixture(counts, b - a)
        if wanted[a, b] * score >= THRESHOLD:
            out.append((a, b))
    return sorted(out)


def _phrase(words: list[str]) -> float:
    """0 to 1: distinct uncommon words, by number and share; or the most random word that mixes letters and digits."""
    if not words:
        return 0.0
    bare = {w.strip(".,;:!?()").lower() for w in words}
    uncommon = sum(len(w) > 2 and w not in COMMON and not sensitivity(w) for w in bare)
    mixed = (w for w in words if any(c.isdigit() for c in w) and any(c.isalpha() for c in w))
    return max([min(1.0, uncommon / PHRASE) * uncommon / len(words), *map(randomness, mixed)])


def _assignments(text: str) -> Iterator[tuple[str, int]]:
    """(name, where its right side starts) of each assignment; every run of letters is looked at once."""
    done = 0
    for run in _RUN.finditer(text):
        end = run.end()
        if not (start := _FIRST.search(text, run.start(), end)):
            continue
        at = start.start()
        quote = text[at - 1:at] if at > done else ""
        # a quote before the name goes with one after it
        operator = _OPERATOR.match(text, end + 1) if quote in ("'", '"') and quote and text[end:end + 1] == quote else None
        operator = operator or _OPERATOR.match(text, end)
        if operator:
            done = operator.end()
            yield text[at:end], done


def pairs(text: str) -> list[tuple[str, list[tuple[int, int]], list[str]]]:
    """(name, spans of literals, names used) of each assignment of a text."""
    out = []
    words = [m.span() for m in _WORD.finditer(text)]
    starts = [a for a, _ in words]
    for name, at in _assignments(text):
        literals, used = [], []
        while True:
            if quoted := _QUOTED.match(text, at):
                at = quoted.end()
                literals.append((quoted.start() + 1, at - 1))
            else:
                # the run of word letters that holds this place; runs are found once, however many pairs one holds
                k = bisect_right(starts, at) - 1
                if k < 0 or words[k][1] <= at:
                    break
                start, at = at, words[k][1]
                if (m := _NAME.match(text, start, at)) and m.end() == at:
                    used.append(text[start:at])
                literals.append((start, at))
            if not (plus := _PLUS.match(text, at)):
                break
            at = plus.end()
        out.append((name, literals, used))
    return out


def lexed_spans(text: str) -> list[tuple[int, int]]:
    """Spans of the literals that reach a sensitive name, propagated through bindings."""
    if "=" not in text and ":" not in text:
        return []
    found = pairs(text)
    if not found:
        return []
    reach = {name: sensitivity(name) for name, _, _ in found}
    # a name is as sensitive as the most sensitive name that is built from it: the most sensitive first, each
    # passes its sensitivity on along all bindings, and no name is visited twice
    uses: dict[str, list[str]] = {name: [] for name in reach}
    for name, _, used in found:
        uses[name] += [u for u in used if u in reach]
    visited: set[str] = set()
    for start in sorted(reach, key=reach.__getitem__, reverse=True):
        waiting = [start]
        while waiting:
            name = waiting.pop()
            if name not in visited:
                visited.add(name)
                reach[name] = reach[start]
                waiting += uses[name]
    longest = max(map(len, reach))
    wanted: dict[tuple[int, int], float] = {}
    for name, literals, _ in found:
        for a, b in literals if reach[name] else ():
            # what a bound name stands for is scored where it is bound
            if b - a > longest or text[a:b] not in reach:
                wanted[a, b] = max(wanted.get((a, b), 0.0), reach[name])
    return _scored(text, wanted)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the three patterns, leftmost and non-overlapping within each kind."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each ordered by start, then kind."""
    base = in_order(base_spans(text))
    starts = [s for _, s, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))      # how far base spans that start up to here reach
    more = [("literal", a, b) for a, b in lexed_spans(text)
            if not ((k := bisect_right(starts, a)) and reach[k - 1] >= b)]
    return base, in_order(base + more)


def written_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with every run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every whole text: counts per base kind, digest of base spans, all spans.

    Null text counts as empty (no spans); null ids and repeated rows are kept,
    one row each; an empty table gives no row; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "text"):
                found = [scan(t) for t in texts(batch.column("text"))]
                kinds = [Counter(k for k, _, _ in base) for base, _ in found]
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"),
                    *(pa.array([k[kind] for k in kinds], pa.int64()) for kind in KINDS[:3]),
                    pa.array([hashlib.sha256(written_spans(base).encode()).hexdigest() for base, _ in found]),
                    pa.array([written_spans(spans) for _, spans in found], pa.string()),
                ], names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    ).withColumnRenamed("id", id_col)


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with the secrets in ``text_col`` replaced; ``length_col`` gets the new length in characters.

    All columns and rows stay; a null text stays null, with its length.
    """
    @F.pandas_udf("string")
    def clean(column):
        return column.map(lambda t: t if t is None else redact(t, scan(t)[1]))

    out = docs.withColumn(text_col, clean(F.col(text_col)))
    if length_col:
        out = out.withColumn(length_col, F.coalesce(F.length(text_col).cast(docs.schema[length_col].dataType),
                                                    F.col(length_col)))
    return out
