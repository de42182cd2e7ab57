"""Token ids in binary files: static range asymmetric numeral system (rANS).

A file is a table of segments in ascending document order.  A segment is one
self-contained binary value:

    magic "RAS1", then little-endian unsigned 32-bit numbers: scale bits,
    interleave, steps per block, blocks, ids, documents, bytes of the table,
    reserved
    document ids     64-bit integers, then one byte each (1: null)
    document lengths 32-bit
    frequency table  zlib: the symbols' ids, then their frequencies (32-bit)
    checkpoints      per block: offset of its words (64-bit), checksum of its
                     ids (crc32), and the start state of each of its lanes
    words            32-bit

All blocks of a segment share its frequency table; each is coded by
``interleave`` independent lanes and can be decoded alone from its checkpoint.
A checksum that fails raises.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from trendlens.llm.bpe_automaton import byte_symbols
from trendlens.llm.common import batches_of, prefix_sums, shuffle_partitions, texts, written

MAGIC = b"RAS1"
LANES = 32
STEPS = 512
#: A segment ends with the document that brings it to this many ids.
SEGMENT_IDS = 1 << 22
LOW = np.uint64(1 << 31)
CACHE_BYTES = 80 << 20
#: Blocks coded side by side, which bounds the arrays a segment takes besides its ids.
BLOCKS = 64
#: Bytes of texts whose pieces are held at once.
TEXT_BYTES = 2 << 20


# -- the coder -----------------------------------------------------------------

def frequencies(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols of ``ids``, frequencies (at least 1) that sum to 2**bits, and bits."""
    counts = np.bincount(ids, minlength=size)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    bits = min(22, max(12, int(len(symbols)).bit_length() + 3))
    total = 1 << bits
    freq = np.maximum(1, counts * total // max(1, int(counts.sum())))
    order = np.argsort(-freq, kind="stable")
    rest = total - int(freq.sum())
    if rest > 0:
        freq[order[0]] += rest
    for at in order:            # rounding up rare symbols took too much: give it back from the frequent ones
        if rest >= 0:
            break
        give = min(int(freq[at]) - 1, -rest)
        freq[at] -= give
        rest += give
    return symbols.astype("<u4"), freq.astype("<u4"), bits


def encode_segment(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment; ``ids`` holds the documents' ids one after another."""
    count = len(ids)
    steps = int(min(STEPS, max(1, -(-count // LANES))))
    blocks = -(-count // (steps * LANES)) if count else 0
    symbols, freq, bits = frequencies(ids, 1) if count else (np.zeros(0, "<u4"), np.zeros(0, "<u4"), 12)
    table = zlib.compress(symbols.tobytes() + freq.tobytes(), 1)
    marks, words = b"", b""
    if count:
        index = np.zeros(int(symbols[-1]) + 1, np.int64)
        index[symbols] = np.arange(len(symbols))
        f64 = freq.astype(np.uint64)
        start = np.concatenate([[0], np.cumsum(f64)[:-1]]).astype(np.uint64)
        limit = f64 << np.uint64(63 - bits)
        scale, word = np.uint64(bits), np.uint64(32)
        each = steps * LANES
        offsets, sums, states, coded, held = [], [], [], [], 0
        for b in range(0, blocks, BLOCKS):
            some = ids[b * each:(b + BLOCKS) * each]
            n = -(-len(some) // each)
            padded = np.full(n * each, np.argmax(freq), np.int64)
            padded[:len(some)] = index[some]
            # [step, block x lane]; a block's ids run along its steps, lane by lane
            grid = np.ascontiguousarray(padded.reshape(n, steps, LANES).transpose(1, 0, 2).reshape(steps, -1))
            state = np.full(grid.shape[1], LOW, np.uint64)
            out = np.zeros(grid.shape, "<u4")
            full = np.zeros(grid.shape, bool)
            for t in range(steps - 1, -1, -1):
                row = grid[t]
                f = f64[row]
                big = state >= limit[row]
                full[t] = big
                out[t] = state.astype("<u4")
                state = np.where(big, state >> word, state)
                whole = state // f
                state = (whole << scale) + (state - whole * f) + start[row]
            full = full.reshape(steps, n, LANES).transpose(1, 0, 2)
            sizes = full.reshape(n, -1).sum(1)
            offsets.append(held + np.cumsum(sizes) - sizes)
            held += int(sizes.sum())
            coded.append(out.reshape(steps, n, LANES).transpose(1, 0, 2)[full].tobytes())
            states.append(state)
            sums += [zlib.crc32(some[k:k + each].astype("<u4").tobytes()) for k in range(0, len(some), each)]
        words = b"".join(coded)
        marks = b"".join([np.concatenate(offsets).astype("<u8").tobytes(), np.array(sums, "<u4").tobytes(),
                          np.concatenate(states).astype("<u8").tobytes()])
    head = struct.pack("<4s8I", MAGIC, bits, LANES, steps, blocks, count, len(doc_ids), len(table), 0)
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    nulls = np.array([d is None for d in doc_ids], np.uint8).tobytes()
    return b"".join([head, keys, nulls, lengths.astype("<u4").tobytes(), table, marks, words])


def decode_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, ids) of a segment; ``BLOCKS`` of its blocks are decoded side by side."""
    magic, bits, lanes, steps, blocks, count, docs, table_size, _ = struct.unpack_from("<4s8I", data)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at = struct.calcsize("<4s8I")

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(data, kind, n, at)
        at += got.nbytes
        return got

    keys, nulls, lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
    doc_ids = [None if n else int(k) for k, n in zip(keys, nulls, strict=True)]
    table = np.frombuffer(zlib.decompress(data[at:at + table_size]), "<u4")
    at += table_size
    if not count:
        return doc_ids, lengths, np.zeros(0, "<u4")
    symbols, freq = table[:len(table) // 2], table[len(table) // 2:].astype(np.uint64)
    offsets, sums, state = take("<u8", blocks).astype(np.int64), take("<u4", blocks), take("<u8", blocks * lanes).copy()
    words = np.concatenate([np.frombuffer(data, "<u4", -1, at), np.zeros(1, "<u4")])
    start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    slot = np.repeat(np.arange(len(symbols), dtype=np.int32), freq.astype(np.int64))
    mask, scale, word = np.uint64((1 << bits) - 1), np.uint64(bits), np.uint64(32)
    each = steps * lanes

    def decode(out: np.ndarray, offsets: np.ndarray, state: np.ndarray) -> None:
        grid = np.empty((steps, len(state)), np.int32)
        for t in range(steps):
            low = state & mask
            row = slot[low]
            grid[t] = row
            state = freq[row] * (state >> scale) + low - start[row]
            need = (state < LOW).reshape(-1, lanes)
            rank = np.cumsum(need, axis=1)
            where = (offsets[:, None] + rank - 1)[need]
            offsets = offsets + rank[:, -1]
            flat = need.ravel()
            state[flat] = (state[flat] << word) | words[where].astype(np.uint64)
        out[:] = symbols[grid.reshape(steps, -1, lanes).transpose(1, 0, 2).reshape(-1)[:len(out)]]

    ids = np.empty(count, "<u4")
    for b in range(0, blocks, BLOCKS):
        decode(ids[b * each:(b + BLOCKS) * each], offsets[b:b + BLOCKS], state[b * lanes:(b + BLOCKS) * lanes])
    for b in range(blocks):
        if zlib.crc32(ids[b * each:(b + 1) * each].tobytes()) != int(sums[b]):
            raise ValueError(f"token segment: block {b} fails its checksum")
    return doc_ids, lengths, ids


# -- ids of whole texts ----------------------------------------------------------

#: Where a text may be cut: a blank between two other characters starts a word of a byte-level vocabulary.
CUT = regex.compile(r"(?<=\S) (?=\S)")
AT_ONCE = 4096
#: Letters in every Unicode version, then ASCII punctuation: the split pattern makes one word of each behind a blank.
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+)([!-/:-@\\[-`{-~]*)")
#: Runs of punctuation whose ids are kept.
TAILS = 1 << 12


class CachedTokenizer:
    """The tokenizers library on whole texts, each distinct piece encoded once.

    In byte-level vocabularies' split pattern a blank between two characters
    that aren't white space always starts a new word, and a newline between
    two such characters is a word.  So the pieces' ids, one after another, are
    the text's.  Files of another kind get whole texts.  Words of letters behind
    a blank, which the split pattern leaves whole, go straight to the library's
    merges, and the punctuation after them is encoded alone.  Other words behind
    a blank are encoded one after another in one call and told apart by the
    bytes that each id stands for.  Pieces are kept in two generations of at
    most about ``CACHE_BYTES`` each, those taken over from the older one
    included.
    """

    def __init__(self, path: str):
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.cut = type(self.lib.pre_tokenizer).__name__ == "ByteLevel" and self.lib.normalizer is None
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0
        if self.cut:
            self.newline = self.lib.encode("\n", add_special_tokens=False).ids
            self.cut = len(self.newline) == 1
            # each character of a byte-level token is a byte; an added token is its text
            vocab = self.lib.get_vocab(with_added_tokens=True)
            self.bytes = np.zeros(max(vocab.values()) + 1, np.int64)
            self.bytes[list(vocab.values())] = list(map(len, vocab))
            added = self.lib.get_added_tokens_decoder()
            for k, token in added.items():
                self.bytes[k] = len(token.content.encode())
        # an added token that plain words may hold would cut them
        self.merges = self.lib.model if self.cut and self.lib.pre_tokenizer.use_regex and (
            type(self.lib.model) is BPE) and not any(PLAIN.fullmatch(f"a{t.content}") or PLAIN.search(t.content[:1]) for t in added.values()) else None
        self.tails: dict[str, bytes] = {}
        shown = byte_symbols()
        self.shown = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0xC0, 0x180)}

    def _encode(self, pieces: list[str]) -> list[bytes]:
        got = self.lib.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def _plain(self, words: list[str]) -> list[str]:
        """Learns the words of letters, with or without punctuation behind, and returns the others."""
        rest, plain, stems = [], [], {}
        for word in words:
            if word.isascii() and word.isalpha():
                stem, tail = word, ""
            elif found := PLAIN.fullmatch(word):
                stem, tail = found.groups()
            else:
                rest.append(word)
                continue
            plain.append((word, stem, tail))
            stems[stem] = self.new.get(stem)
        missing = [stem for stem, ids in stems.items() if ids is None]
        for k in range(0, len(missing), AT_ONCE):
            some = missing[k:k + AT_ONCE]
            tokens = [self.merges.tokenize("\u0120" + (w if w.isascii() else w.translate(self.shown))) for w in some]
            raw = np.array([t.id for own in tokens for t in own], "<u4").tobytes()
            after = (4 * np.cumsum(list(map(len, tokens)))).tolist()
            stems.update(zip(some, [raw[a:b] for a, b in zip([0, *after[:-1]], after, strict=True)], strict=True))
        for word, stem, tail in plain:
            ids = stems[stem]
            if tail:
                if tail not in self.tails:
                    if len(self.tails) >= TAILS:
                        self.tails.clear()
                    self.tails[tail] = self._encode([tail])[0]
                ids += self.tails[tail]
            self.new[word] = ids
            self.held += len(word) + len(ids) + 200
        return rest

    def _after_blanks(self, words: list[str]) -> list[bytes]:
        """The ids of words behind a blank, from texts of many words."""
        out = []
        for k in range(0, len(words), AT_ONCE):
            some = words[k:k + AT_ONCE]
            text = " " + " ".join(some)
            ids = np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum(self.bytes[ids])
            want = np.cumsum(list(map(len, some if text.isascii() else map(str.encode, some)))) + np.arange(1, len(some) + 1)
            at = np.searchsorted(ends, want)
            if not len(ids) or ends[-1] != want[-1] or (ends[at] != want).any():
                out += self._encode([f" {w}" for w in some])    # an id that does not stand for the bytes it was made of
                continue
            raw, after = ids.tobytes(), (4 * (at + 1)).tolist()
            out += [raw[a:b] for a, b in zip([0, *after[:-1]], after, strict=True)]
        return out

    def _of_lines(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces without white space, from texts of many pieces, a line each."""
        out = []
        for k in range(0, len(pieces), AT_ONCE):
            text = "\n".join([*pieces[k:k + AT_ONCE], ""])
            ids = np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            after = np.flatnonzero(ids == self.newline[0]) + 1
            raw, starts = ids.tobytes(), np.concatenate([[0], after[:-1]])
            out += [raw[4 * a:4 * b] for a, b in zip(starts.tolist(), (after - 1).tolist(), strict=True)]
        return out

    def _learn(self, missing: list[str]) -> None:
        words, bare, lone = [], [], []
        for p in missing:
            held = self.old.get(p)
            if held is not None:
                self.new[p] = held
                self.held += len(p) + len(held) + 200
            elif p[0] != "\n":
                words.append(p)
            # without a blank before them, pieces are told apart by newlines, so they hold no white space
            elif len(p.split()) == 1 and not p[1].isspace() and not p[-1].isspace():
                bare.append(p)
            else:
                lone.append(p)
        if self.merges is not None:
            words = self._plain(words)
        for names, ids in ((words, self._after_blanks(words)), (bare, self._of_lines([p[1:] for p in bare])),
                           (lone, self._encode([p[1:] for p in lone]))):
            self.new.update(zip(names, ids, strict=True))
            self.held += sum(map(len, names)) + sum(map(len, ids)) + 200 * len(names)

    @staticmethod
    def _pieces(text: str) -> list[str]:
        """Pieces: a word stands for itself behind a blank, a blank for a newline; any other has a newline before it."""
        pieces = []
        for line in text.split("\n"):
            words = line.split()
            # is every white space a blank between two others?
            if line.count(" ") != len(words) - 1 or len("".join(words)) + len(words) - 1 != len(line):
                return [f"\n{' ' * (k > 0)}{p}" for k, p in enumerate(CUT.split(text))]
            words[0] = f"\n{words[0]}"
            pieces += words
            pieces.append(" ")
        pieces.pop()
        return pieces

    def encode(self, batch: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if not self.cut:
            return self._encode(batch)
        if self.held >= CACHE_BYTES:
            self.new, self.old, self.held = {}, self.new, 0
        self.new[" "] = np.array(self.newline, "<u4").tobytes()
        pieces, sizes = [], []
        for text in batch:
            own = self._pieces(text)
            pieces += own
            sizes.append(len(own))
        # each piece of the batch is looked up once; the texts' ids are then taken from its pieces' side by side
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        del pieces
        names, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        found = list(map(self.new.get, names))
        gap = [k for k, x in enumerate(found) if x is None]
        self._learn([names[k] for k in gap])
        for k in gap:
            found[k] = self.new[names[k]]
        pool = np.frombuffer(b"".join(found), "<u4")
        lengths = np.array(list(map(len, found)), np.int64) // 4
        each = lengths[at]
        ends = np.concatenate([[0], np.cumsum(each)])
        raw = pool[np.repeat((np.cumsum(lengths) - lengths)[at] - ends[:-1], each) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[np.cumsum([0, *sizes])]).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


_LOADED: dict[tuple[str, float], CachedTokenizer] = {}


def tokenizer(path: str) -> CachedTokenizer:
    key = (path, os.path.getmtime(path))
    if key not in _LOADED:
        _LOADED[key] = CachedTokenizer(path)
    return _LOADED[key]


# -- writing and reading -----------------------------------------------------------

def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 0, partitions: int | None = None) -> DataFrame:
    """Writes every document's ids, each ended by ``end_id``, and returns the written file's segments.

    Segments are numbered (part, seq) in ascending order of ``id_col`` (null
    ids first; rows of one id in order of their text's hash).  Null text
    counts as empty: the end id alone.  An empty table gives no segment;
    other columns are not read.  A task holds one segment at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        tok, part, seq = tokenizer(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        keys: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, held
            ids = np.frombuffer(b"".join(parts), "<u4")
            lengths = np.array([len(p) // 4 for p in parts])
            payload = encode_segment(keys, lengths, ids)
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()),
                pa.array([payload], pa.binary())], names=["part", "seq", "ids", "payload"])
            seq, held = seq + 1, 0
            keys.clear()
            parts.clear()
            return row

        for whole in batches:
            for batch in batches_of(whole, "text", TEXT_BYTES):
                encoded = tok.encode(texts(batch.column("text")))
                for key, ids in zip(batch.column("id").to_pylist(), encoded, strict=True):
                    keys.append(key)
                    parts.append(ids + end)
                    held += len(ids) // 4 + 1
                    if held >= SEGMENT_IDS:
                        yield flush()
        if keys:
            yield flush()

    n = partitions or shuffle_partitions(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = slim.withColumn("tie", F.xxhash64("text")).repartitionByRange(
        n, F.asc_nulls_first("id"), F.asc("tie")).sortWithinPartitions(F.asc_nulls_first("id"), "tie", "text")
    return written(ordered.select("id", "text").mapInArrow(run, "part int, seq int, ids long, payload binary"),
                   "tokens")


def read_tokens(segments: DataFrame, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Decodes segments: ``id_col``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32``.

    ``with_ids`` adds the ids themselves (binary, little-endian 32-bit).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column("start").to_pylist(), batch.column("payload"), strict=True):
                keys, lengths, ids = decode_segment(payload.as_py())
                ends = np.cumsum(lengths.astype(np.int64))
                raw = memoryview(ids.tobytes())
                cut = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                columns = [pa.array(keys, pa.int64()), pa.array(start + ends - lengths, pa.int64()),
                           pa.array(lengths, pa.int64()), pa.array([zlib.crc32(c) for c in cut], pa.int64())]
                if with_ids:
                    columns.append(pa.array([bytes(c) for c in cut], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=fields)

    fields = ["id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    schema = "id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    starts = prefix_sums(segments.select("part", "seq", "ids"), "ids", "start", "part", "seq")
    placed = segments.drop("ids").join(starts.drop("ids"), ["part", "seq"])
    return placed.select("start", "payload").mapInArrow(run, schema).withColumnRenamed("id", id_col)
