"""The registered queries: DuckDB twins where SQL can express them, brute force elsewhere."""

import math
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from trendlens.llm import bpe_automaton, chat_windows, piecewise_hash, queries, secret_scan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT * FROM '{SF}/documents.parquet' ORDER BY doc_id").df()


def rows(spark, name):
    return queries.QUERIES[name](spark, SF).toPandas()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_twin(spark, name):
    got = rows(spark, name)
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLE[name]).df()[list(got.columns)]
    norm = lambda df: sorted(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r)
                             for r in df.astype(object).where(df.notna(), None).itertuples(index=False))
    assert [tuple(map(str, r)) for r in norm(got)] == [
        tuple(map(str, r)) for r in norm(want.astype(got.dtypes.to_dict()))]


def test_op1_targets_and_limits(spark, docs):
    got = rows(spark, "op1_cube_mix")
    size = docs.set_index("doc_id").text.map(lambda t: len(t.encode().split()))
    got = got.set_index("doc_id").sort_index()
    assert (got["size"] == size).all() and len(got) == len(docs)
    by = got.groupby("source")
    sizes = by["size"].sum()
    assert (by.source_size.first() == sizes).all()
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes.index, key=lambda s: s.encode()))}
    target, held = {}, set()
    while True:
        free = sizes.sum() - sum(3 * sizes[s] for s in held)
        level = free / sum(w for s, w in weight.items() if s not in held)
        target = {s: 3.0 * sizes[s] if s in held else weight[s] * level for s in weight}
        more = {s for s in weight if s not in held and target[s] > 3 * sizes[s]}
        if not more:
            break
        held |= more
    assert by.target.first().to_dict() == pytest.approx(target)
    assert (got.taken <= 3 * got["size"]).all()
    largest = by["size"].max()
    assert all(abs(by.taken.sum()[s] - target[s]) <= largest[s] for s in weight)
    again = rows(spark, "op1_cube_mix").set_index("doc_id")
    assert (again.taken.sort_index() == got.taken.sort_index()).all()


def test_op2_keeps_the_clean_and_drops_the_rest(spark):
    kept = set(queries.op2_quality(spark, "/root/testdata/sf0.01").toPandas().doc_id)
    labels = duckdb.sql("SELECT * FROM '/root/testdata/sf0.01/labels.parquet'").df()
    clean = labels[(labels.quality == 1) & (labels.toxic == 0)].doc_id
    junk = labels[labels.quality == 0].doc_id
    toxic = labels[labels.toxic == 1].doc_id
    assert np.mean([d in kept for d in clean]) >= 0.98
    assert np.mean([d in kept for d in junk]) <= 0.02
    assert np.mean([d in kept for d in toxic]) <= 0.3


def test_op3_digests(spark):
    got = rows(spark, "op3_chat_windows").set_index("conv_id")
    turns = duckdb.sql(f"SELECT * FROM '{SF}/conversations.parquet' ORDER BY conv_id, turn").df()
    for conv, g in turns.groupby("conv_id"):
        text = "".join(f"{r}\n{t}\n" for r, t in zip(g.role, g.text))
        loss = "".join(t for r, t in zip(g.role, g.text) if r == "assistant")
        row = got.loc[conv]
        assert (row.n_turns, row.turns_sha256) == (len(g), bpe_automaton.sha256_hex(text.encode()))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), bpe_automaton.sha256_hex(loss.encode()))
    assert got.loc[-7].loss_chars == len(queries.MARKS)
    assert got.loc[-7].turns_sha256 == bpe_automaton.sha256_hex(
        f"user\n{queries.MARKS}\nassistant\n{queries.MARKS}\n".encode())


def test_op4_matches_the_library(spark, docs):
    got = rows(spark, "op4_token_files").set_index("doc_id")
    lib, start = Tokenizer.from_file(queries.BYTE_BPE), 0
    for doc, text in zip(docs.doc_id, docs.text):
        ids = [*lib.encode(text, add_special_tokens=False).ids, 0]
        row = got.loc[doc]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op5_matches_the_library(spark, docs):
    got = rows(spark, "op5_bpe_automaton").set_index("doc_id")
    for doc, text in zip(docs.doc_id, docs.text):
        ids, decoded = bpe_automaton.brute_force(text, queries.WORD_BPE)
        row = got.loc[doc]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (
            len(ids), bpe_automaton.sha256_hex(np.array(ids, "<u4").tobytes()),
            bpe_automaton.sha256_hex(decoded.encode()))


def test_op8_recall(spark):
    got = queries.op8_nn_descent(spark, "/root/testdata/sf0.1").toPandas()
    table = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").df()
    ids, x = table.vec_id.to_numpy(), np.stack(table.embedding.to_numpy()).astype(float)
    found = total = 0
    for query, g in got.groupby("query_id"):
        d = np.sqrt(((x - x[ids == query]) ** 2).sum(1))
        d[ids == query] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        assert g.sort_values("rank")["rank"].tolist() == list(range(1, 11))
        at = dict(zip(ids, d))
        assert all(abs(at[v] - s) < 1e-12 for v, s in zip(g.vec_id, g.score))
        found, total = found + len(set(best) & set(g.vec_id)), total + 10
    assert total == 10 * (ids % 100 == 0).sum() and found / total >= 0.9


def test_op9_edits_and_fingerprints(spark, docs):
    got = rows(spark, "op9_piecewise_hash").set_index("doc_id")
    back = docs.sort_values("doc_id", ascending=False).reset_index(drop=True)
    for i, (doc, text) in enumerate(zip(back.doc_id, back.text)):
        new = piecewise_hash.edited(text, back.text[(i + 1) % len(back)])
        row = got.loc[doc]
        assert row.n_chars == len(text) and row.edited_sha256 == bpe_automaton.sha256_hex(new.encode())
        assert row.fingerprint == piecewise_hash.fingerprint(text.encode())
        assert row.edited_fingerprint == piecewise_hash.fingerprint(new.encode())
    assert got.near_edited.mean() > 0.5 > 0.2 > got.near_next.mean()


def test_op10_base_spans(spark, docs):
    got = rows(spark, "op10_secret_scan").set_index("doc_id")
    for doc, text in zip(docs.doc_id, docs.text):
        base, spans = secret_scan.scan(text)
        row = got.loc[doc]
        assert row.base_sha256 == bpe_automaton.sha256_hex(secret_scan.written_spans(base).encode())
        assert row.spans == secret_scan.written_spans(spans) and set(base) <= set(spans)


def test_windows_respect_the_budget(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    words = lambda s: len(s.encode().split())
    for row in chat_windows.format_conversations(turns, budget=120, history=40).collect():
        parsed = chat_windows.parse(row["sample"])
        tokens = sum(words(t) + chat_windows.TURN_MARKS for _, t in parsed)
        assert tokens <= 120 or len(parsed) - row["repeated"] == 1
        assert len(row["spans"]) == sum(r == "assistant" for r, _ in parsed[row["repeated"]:])
