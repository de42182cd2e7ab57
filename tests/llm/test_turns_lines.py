"""Prefix trie, line dedup and structure repair against brute force; trees, filters and parser on their own."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from trendlens.llm import line_dedup, ordered, prefix_trie, queries, structure_repair

TURNS = "conv_id long, turn long, role string, text string"


def random_turns(seed=3, convs=range(-110, 250)):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.choice([1, 2, 3, 5, 8, 20])):
            rows.append((c, rng.choice([t, t, t, None, t + 5]),
                         rng.choice(["user", "assistant", "system", "uber", "tool", "", None]),
                         rng.choice([None, "", "b", f"{t}.", f"q{t}!\n", f"é{t}?", "  "]) if t < 9 else "z."))
    rows += rows[:40]
    return rows


def by_turn(rows, null):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t, null if r is None else r, null if x is None else x))
    return {c: sorted(v, key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2])) for c, v in convs.items()}


# -- prefix trie ----------------------------------------------------------------------

def trie(rows):
    own = {c: [(r, x) for _, r, x in v] for c, v in by_turn([r for r in rows if r[0] is not None], "").items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids, leaves, saved, out = defaultdict(list), {}, {}, []
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + (len(members[k]) - 1) * (len(k[-1][1]) if k else 0)
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"length": 3, "most_rows": 7}, {"length": 1, "most_rows": 60}])
def test_trie_is_the_brute_force_one(spark, options):
    copies = [(1000 + i, t, "user", "hot" if t % 9 else f"w{t}") for i in range(40) for t in range(41)]
    rows = random_turns() + copies + [(None, 1, "user", "x")]
    frame = spark.createDataFrame(rows, TURNS).withColumnRenamed("conv_id", "c").selectExpr(
        "c AS conv_id", "turn", "role", "text", "1 AS pos", "2 AS total", "'x' AS klass")
    assert Counter(map(tuple, prefix_trie.rebuilt_trie(frame, **options).collect())) == trie(rows)


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.rebuilt_trie(empty).collect() == []
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([(None, 0, "user", "a")], TURNS)).collect() == []


def test_radix_tree_grows_and_walks_in_order():
    rng = random.Random(1)
    keys = {bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 2, 3]))) for _ in range(3000)}
    keys |= {b"long" * 300 + k for k in list(keys)[:50]}
    tree = prefix_trie.RadixTree()
    for k in rng.sample(sorted(keys), len(keys)):
        assert tree.get_or_put(k, lambda: [k]) == [k] and tree.get_or_put(k, list) == [k]
    walked = list(tree.walk())
    assert [k for _, k, _ in walked] == sorted(keys)
    for (_, a, _), (n, b, _) in zip(walked, walked[1:]):
        assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])
    kinds, todo = set(), [tree.root]
    while todo:
        node = todo.pop()
        kinds.add((type(node).__name__, getattr(node, "size", None)))
        todo += [kid for _, kid in node.children()]
    assert kinds == {("Small", 4), ("Small", 16), ("Indexed", None), ("Direct", None)}


def test_positions_count_within_the_key_over_any_split(spark):
    rows = [(k, i % 7, "x") for k in (None, 1, 2, 3) for i in range(3000 if k == 2 else 5)]
    got = ordered.positions(spark.createDataFrame(rows, "k long, o long, v string").repartition(5), "k", ["o"], "at").collect()
    held = defaultdict(list)
    for r in got:
        held[r["k"]].append((r["at"], r["o"]))
    assert {k: len(v) for k, v in held.items()} == {None: 5, 1: 5, 2: 3000, 3: 5}
    for v in held.values():
        assert [a for a, _ in sorted(v)] == list(range(len(v))) and [o for _, o in sorted(v)] == sorted(o for _, o in v)


# -- line dedup -------------------------------------------------------------------------

LONG = "This line has more than forty code points, so it counts "


def deduped(rows, min_chars=40, min_docs=5):
    white = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(white).translate(lower)
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(d)
    rank = lambda d: (d is not None, d)
    gone = {k: max(v, key=lambda d: (d is not None, d or 0)) for k, v in holders.items()
            if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or rank(gone[key(x)]) == rank(d)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def line_rows():
    rng = random.Random(9)
    pool = [LONG + str(i) for i in range(30)] + ["short", "", "É" * 40, "É" * 39, "\t" + LONG.upper() + "7 \r"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randrange(12)))) for i in range(60)]
    rows += [(None, LONG + "3\nx"), (None, LONG + "3"), (70, None), (71, ""), rows[0], rows[0]]
    rows += [(80, "y " * 300_000 + "\n" + LONG + "1"), (81, (LONG + "2\n") * 2000)]
    return rows + [(100 + i, LONG + "everywhere\nown line of this text, with more than forty letters " + str(i)) for i in range(300)]


@pytest.mark.parametrize("bits", [line_dedup.BITS, 64])
def test_lines_by_brute_force(spark, bits):
    # with 64 bits every line is suspected, and nothing changes
    rows = line_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert Counter(map(tuple, line_dedup.digests(frame, bits=bits).collect())) == deduped(rows)


def test_other_columns_pass_and_names_never_clash(spark):
    rows = [(i, LONG + f"same\nown {i}", i * 2, "a", "b") for i in range(6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_lines long, digest string, _lost string")
    out, added = line_dedup.drop_repeated_lines(frame)
    assert out.columns[:5] == frame.columns and added["n_lines"] not in frame.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[5]["text"] == rows[5][1] and all(got[i]["text"] == f"own {i}" for i in range(5))
    assert all(got[i]["n_lines"] == 2 * i and got[i]["digest"] == "a" for i in range(6))
    assert line_dedup.digests(frame.limit(0)).collect() == []


def test_few_lines_are_suspected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = line_dedup.Bits(line_dedup.BITS, line_dedup.twice_filter(docs.repartition(7), "text"))
    seen = Counter(k for r in docs.collect() for k in line_dedup.keys_of(r["text"], 40))
    hit = held.has(line_dedup._hashes(seen))
    repeated = np.array([n > 1 for n in seen.values()])
    assert hit[repeated].all() and hit[~repeated].mean() < 0.001


def test_filters_of_tasks_merge_to_seen_twice():
    rng = np.random.default_rng(4)
    a, b = (rng.integers(0, 2 ** 63, 500, dtype=np.uint64) for _ in range(2))
    once_a, once_b = line_dedup.Bits(1 << 16), line_dedup.Bits(1 << 16)
    once_a.add(np.concatenate([a, b[:50]]))
    once_b.add(b)
    both = line_dedup.Bits(1 << 16, once_a.held & once_b.held)
    assert both.has(b[:50]).all() and both.has(a).mean() < 0.1


# -- structure repair -------------------------------------------------------------------

WHITE = " \t\n\x0b\x0c\r"
FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def repaired(rows):
    """(cost, audit, turns) by dynamic programming over the last role, with whole audits; rows are (role, text, fault)."""
    def put(best, state, value):
        if state not in best or value[:2] < best[state][:2]:
            best[state] = value

    def inserted(best):
        best = dict(best)
        for _ in range(4):
            for s, (cost, audit, turns) in list(best.items()):
                for n in set(FOLLOWS[s]) & set("ua"):
                    put(best, n, (cost + 3, audit + "I", [*turns, (NAMES[n], "")]))
        return best

    best = {"": (0, "", [])}
    for role, text, fault in rows:
        after = {}
        for s, (cost, audit, turns) in inserted(best).items():
            put(after, s, (cost + 4, audit + "D", turns))
            if fault in "bd":
                continue
            more = 3 if fault == "t" else 0
            if role[:1] and role[:1] in FOLLOWS[s]:
                put(after, role[0], (cost + more, audit + "K", [*turns, (role, text)]))
            for n in set(FOLLOWS[s]) & set("ua"):
                put(after, n, (cost + 3 + more, audit + "R", [*turns, (NAMES[n], text)]))
        best = after
    return min((v for s, v in inserted(best).items() if s in ("", "a")), key=lambda v: v[:2])


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(WHITE)
        out.append("b" if not body else "d" if (role, text) in seen else "-" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def summary(conv, turns):
    """The query's row for one conversation's ordered rows."""
    rows = []
    for t, r, x in turns:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        rows += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    known = [t for t, _, _ in rows if t is not None]
    found = faults([r[1:] for r in rows])
    cost, audit, mended = repaired([(r, x, f) for (_, r, x), f in zip(rows, found)])
    return (conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, found.count("b"), found.count("d"),
            found.count("t"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in mended).encode()).hexdigest())


def repair_rows():
    rng = random.Random(8)
    rows = random_turns(5) + [(None, i, rng.choice(["user", "assistant"]), f"{i}.") for i in range(30)]
    # several segments
    rows += [(7000 + j, i, rng.choice(["user", "assistant", "user", "system"]), f"{i % 700}.") for j in range(2) for i in range(900)]
    return rows + [(8000, i, "user", "same") for i in range(600)]


def test_repair_is_the_cheapest_one(spark):
    rows = repair_rows()
    got = structure_repair.repair_damaged(spark.createDataFrame(rows, TURNS)).collect()
    assert Counter(map(tuple, got)) == Counter(summary(c, v) for c, v in by_turn(rows, " ").items())


def test_repaired_turns_are_legal_and_keep_their_texts(spark):
    rows = repair_rows()
    kept = structure_repair.repaired_turns(structure_repair.ordered_rows(spark.createDataFrame(rows, TURNS))).collect()
    got = defaultdict(list)
    for r in sorted(kept, key=lambda r: (r["conv"] is not None, r["conv"] or 0, r["segment"], r["at"])):
        got[r["conv"]].append((r["role"], r["text"]))
    for c, v in by_turn(rows, " ").items():
        turns = [(r, x) for _, r, x in v]
        _, _, want = repaired([(r, x, f) for (r, x), f in zip(turns, faults(turns))])
        assert got[c] == want
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in want))


def test_repair_of_nothing(spark):
    assert structure_repair.repair_damaged(spark.createDataFrame([], TURNS)).collect() == []
    # conversation 0 loses its only row
    turn = next(t for t in range(100) if zlib.crc32(f"0:{t}".encode()) % 20 == 0)
    got = structure_repair.repair_damaged(spark.createDataFrame([(0, turn, "user", "a")], TURNS)).collect()
    assert list(map(tuple, got)) == [(0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_segments_chain_to_the_whole():
    rng = random.Random(2)
    for _ in range(200):
        codes = [(rng.choice("suax"), rng.choice("--td")) for _ in range(rng.randrange(1, 14))]
        chain, cut = structure_repair.Chain(), rng.randrange(1, 5)
        for i in range(0, len(codes), cut):
            chain.add([(e, top, cost, audit) for e in structure_repair.PARSER.tops
                       for top, cost, audit in structure_repair.parse_segment(codes[i:i + cut], e)])
        cost, pieces = chain.end()
        want = repaired([(c, "", f) for c, f in codes])
        assert (cost, "".join(a for _, a in pieces)) == want[:2]


def test_role_parser_knows_the_grammar():
    parser = structure_repair.PARSER
    assert len(parser.tops) == 8
    for n in range(7):
        for word in ("".join(w) for w in __import__("itertools").product("sua", repeat=n)):
            tops = {0}
            for symbol in word:
                tops = {a for t in tops for a in parser.shifts[t, symbol]}
            assert any(parser.ends[t] for t in tops) == bool(re.fullmatch("(s?(ua)+)?", word))


def test_op13_on_the_given_table(spark):
    got = queries.op13_structure_repair(spark, "/root/testdata/sf0.001").collect()
    rows = duckdb.sql("SELECT conv_id, turn, role, text FROM '/root/testdata/sf0.001/conversations.parquet'").fetchall()
    assert Counter(map(tuple, got)) == Counter(summary(c, v) for c, v in by_turn(rows, " ").items())


def test_op11_on_the_given_table(spark):
    got = queries.op11_prefix_trie(spark, "/root/testdata/sf0.001").collect()
    rows = duckdb.sql("SELECT conv_id, turn, role, text FROM '/root/testdata/sf0.001/conversations.parquet'").fetchall()
    assert Counter(map(tuple, got)) == trie(rows)
