"""Tokenization automaton: BPE merges compiled into a deterministic automaton over tokens.

States are the tokens read last; an arc ``u -> v`` says
that ``v`` may follow ``u`` in the tokenization of a word.  The automaton
starts with all arcs between single symbols, and each merge ``a b -> c``, in
rank order, applies one gadget:

- state ``c`` leaves like ``b`` left until now, and is entered like ``a`` was,
- the arc ``a -> b`` is closed (for ``a a -> c`` also ``a -> c``: the
  leftmost pair merges first).

Gadgets only copy rows and columns of the arc table and close one cell, so
the table is kept by version: a state stores when it was made and from which
two states, and an arc is looked up by following those copies back to the
symbols.  ``arc`` memorises what it has looked up in a bounded table.

Every word has exactly one path whose arc labels spell it, and so has every
prefix of it.  So the word's characters drive a second deterministic table:
its states hold the possible starts of the next label, its transitions give
the last label of the prefix read.  Both tables fill as words need them.  A
word costs one look-up per character; decoding emits the labels of the arcs.

The file named here holds the merges, the vocabulary, the pre-split pattern
and the word-end mark; each task reads it.
"""

from __future__ import annotations

import gc
import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendlens.llm.common import batches_of, give_back_memory, texts

#: Letters that every Unicode version knows alike; others are pre-split by the tokenizers library's own tables.
OUTSIDE_LATIN = regex.compile("[^\x00-\u017f]")
#: Entries a task keeps of the automaton's tables before it starts new ones.
CACHE_ENTRIES = 1 << 16
#: About the bytes of each of the two generations of known pieces (an entry takes some 200 beside its text and ids).
CACHE_BYTES = 16 << 20
#: Bytes of texts that are encoded at once.
TEXT_BYTES = 1 << 20


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {b: chr(b) for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in shown):
        shown[b] = chr(256 + i)
    return [shown[b] for b in range(256)]


class MergeAutomaton:
    """The automaton of a merge list; ``mark`` ends the last symbol of a word."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], mark: str):
        self.made: dict[int, int] = {}                 # state -> gadget that made it
        self.parts: dict[int, tuple[int, int]] = {}    # state -> the two states it copies
        self.closed: dict[tuple[int, int], int] = {}   # arc -> gadget that closed it
        for step, (left, right) in enumerate(merges):
            self._gadget(step, vocab[left], vocab[right], vocab[left + right])
        self._arcs: dict[int, bool] = {}
        self.symbol: dict[str, int] = {}       # a character, or the last one with its mark -> its number
        self._tree: dict[int, int] = {}        # place << 16 | symbol -> place
        self._depth, self._label_at = [0], {}
        for label, i in vocab.items():
            node, body = 0, label.removesuffix(mark)
            for at, c in enumerate(body):
                s = c + mark if at + 1 == len(body) < len(label) else c
                key = node << 16 | self.symbol.setdefault(s, len(self.symbol))
                if key not in self._tree:
                    self._tree[key] = len(self._depth)
                    self._depth.append(self._depth[node] + 1)
                node = self._tree[key]
            self._label_at[node] = i
        self.table: dict[int, tuple[int, int, int]] = {}
        self._reset()

    def _reset(self) -> None:
        self.table.clear()
        self._states = [((0, -1),)]
        self._state_of = {self._states[0]: 0}

    def _gadget(self, step: int, a: int, b: int, c: int) -> None:
        if c not in self.parts:        # a second pair that spells c never meets inside a word
            self.made[c] = step
            self.parts[c] = (a, b)
        self.closed.setdefault((a, b), step)

    def _open(self, u: int, v: int, now: int) -> bool:
        """Whether the arc u -> v is there before gadget ``now``."""
        made, parts, closed = self.made, self.parts, self.closed
        while True:
            if closed.get((u, v), now) < now:
                return False
            mu, mv = made.get(u, -1), made.get(v, -1)
            if mu < 0 and mv < 0:
                return True
            if mu > mv:
                now, u = mu, parts[u][1]
            elif mv > mu:
                first, second = parts[v]
                if u == first == second:
                    return False
                now, v = mv, first
            else:                       # v is u, made by one gadget
                now, (first, second) = mu, parts[u]
                u, v = second, first

    def arc(self, u: int, v: int) -> bool:
        key = u << 32 | v
        got = self._arcs.get(key)
        if got is None:
            if len(self._arcs) >= CACHE_ENTRIES:
                self._arcs.clear()
            got = self._arcs[key] = self._open(u, v, 1 << 60)
        return got

    def _step(self, state: int, symbol: int) -> tuple[int, int, int]:
        """The transition of ``state`` by ``symbol``, compiled when first used.

        A state holds the places in the label tree that are reached from the
        possible starts of the next label, each with the label before that
        start.  Exactly one of them completes a label that may follow.
        """
        found, live = None, []
        for node, before in self._states[state]:
            child = self._tree.get(node << 16 | symbol)
            if child is None:
                continue
            label = self._label_at.get(child)
            if found is None and label is not None and (before < 0 or self.arc(before, label)):
                found = (label, self._depth[child])
            live.append((child, before))
        if found is None:
            raise ValueError("no path spells this word")
        key = (*live, (0, found[0]))
        to = self._state_of.get(key)
        if to is None:
            to = self._state_of[key] = len(self._states)
            self._states.append(key)
        got = self.table[state << 16 | symbol] = (to, *found)
        return got

    def encode(self, symbols: list[int]) -> list[int]:
        """The labels of the one path that spells ``symbols`` (numbers from ``symbol``)."""
        table, state, steps = self.table, 0, []
        if len(table) >= 2 * CACHE_ENTRIES:
            self._reset()
        for s in symbols:
            step = table.get(state << 16 | s)
            if step is None:
                step = self._step(state, s)
            steps.append(step)
            state = step[0]
        out, i = [], len(steps)
        while i:
            _, label, size = steps[i - 1]
            out.append(label)
            i -= size
        return out[::-1]


class WordTokenizer:
    """Encoding and decoding by a tokenizer file: byte-level BPE with a word-end mark.

    The file's normalizer (composed form, white space as a blank, lower case
    by character), split pattern and special tokens are followed; a file of
    another kind is refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model, kinds = spec["model"], [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        mark = model.get("end_of_word_suffix")
        if model["type"] != "BPE" or not mark or kinds != ["NFC", "Replace", "Lowercase"] or spec.get("decoder"):
            raise ValueError(f"{path}: not a byte-level BPE with word ends")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # unlike Python's \s, the file's \s is the Unicode property
        self.split = regex.compile(split.replace(r"[^\s", r"[^\p{White_Space}"), regex.V0)
        self.vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.labels = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for label, i in [*self.vocab.items(), *self.special.items()]:
            self.labels[i] = label
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = MergeAutomaton(self.vocab, merges, mark)
        self.bytes = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(self.bytes)}
        library = Tokenizer.from_file(path)
        self.normalize, self.presplit = library.normalizer, library.pre_tokenizer
        symbol = self.automaton.symbol
        self.inner = [symbol[c] for c in self.bytes]
        self.final = [symbol[c + mark] for c in self.bytes]
        self._chunks: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0
        self._label_bytes = [x.encode() for x in self.labels]

    def _word(self, word: bytes) -> list[int]:
        symbols = list(map(self.inner.__getitem__, word))
        symbols[-1] = self.final[word[-1]]
        return self.automaton.encode(symbols)

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a text without blanks, as little-endian 32-bit integers."""
        ids: list[int] = []
        for piece in self.special_split.split(chunk) if "<" in chunk else (chunk,):
            if piece in self.special:
                ids.append(self.special[piece])
            elif piece.isascii():
                if piece.isalpha():
                    ids += self._word(piece.lower().encode())
                else:
                    for word in self.split.findall(piece.lower()):
                        ids += self._word(word.encode())
            elif OUTSIDE_LATIN.search(piece):
                for word, _ in self.presplit.pre_tokenize_str(self.normalize.normalize_str(piece)):
                    ids += self._word(bytes(map(self.byte_of.__getitem__, word)))
            else:
                for word in self.split.findall(unicodedata.normalize("NFC", piece).lower()):
                    ids += self._word(word.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian 32-bit integers.

        No word spans a blank, so the text is cut at blanks and each distinct
        piece is looked up.
        """
        known, older, out = self._chunks, self._older, []
        for chunk in text.split(" "):
            got = known.get(chunk)
            if got is None:
                got = older.get(chunk)
                if got is None:
                    got = self._chunk(chunk)
                if self._held >= CACHE_BYTES:
                    self._chunks, self._older = known, older = {}, known
                    self._held = 0
                known[chunk] = got
                self._held += len(chunk) + len(got) + 200
            out.append(got)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The labels of the ids, joined by blanks (special tokens kept), in UTF-8."""
        return b" ".join(map(self._label_bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def tokenizer(path: str) -> WordTokenizer:
    """A tokenizer of its own for the caller, who lets it go when done."""
    return WordTokenizer(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every whole text as token ids, and those ids decoded again.

    Columns: ``id_col``, ``n_tokens`` long, ``ids`` binary (little-endian
    unsigned 32-bit), ``decoded`` binary (UTF-8).  Null text counts as empty
    (no ids); null ids and repeated rows are kept, one row each; an empty
    table gives no row; other columns are not read.  The tokenizer is loaded
    for each task and goes with it: Spark's Python workers live on, and what
    they held would take memory from every later job.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()        # the tables hold no cycles; scanning their millions of entries would cost more than the work
        try:
            tok = tokenizer(path)
            for whole in batches:
                for batch in batches_of(whole, "text", TEXT_BYTES):
                    ids = [tok.encode(t) for t in texts(batch.column("text"))]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("id"),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([tok.decode(x) for x in ids], pa.binary()),
                    ], names=["id", "n_tokens", "ids", "decoded"])
        finally:
            tok = whole = batch = ids = None
            gc.enable()
            give_back_memory()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_tokens long, ids binary, decoded binary").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: token count and digests of ids and decoded text."""
    return encoded.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def brute_force(text: str, path: str) -> tuple[list[int], str]:
    """The tokenizers library's answer, for tests."""
    lib = _library(path)
    ids = lib.encode(text, add_special_tokens=False).ids
    return ids, lib.decode(ids, skip_special_tokens=False)


@cache
def _library(path: str) -> Tokenizer:
    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    return lib


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
