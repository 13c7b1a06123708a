"""The registered queries and their SQL on the supplied tables."""

import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from quirework.llm import _common, queries

DATA = "/root/testdata"
pytestmark = pytest.mark.skipif(not os.path.isdir(f"{DATA}/sf0.01"), reason="no tables")
TABLES = ("documents", "embeddings", "pages", "labels")


def tables(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS FROM read_parquet('{DATA}/{sf}/{t}.parquet')")
    return c


def test_all_are_registered():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 11)]
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries()) and set(queries.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_says_the_same(spark, name):
    sf = "sf0.01"
    df = queries.queries()[name](spark, f"{DATA}/{sf}")
    want = tables(sf).sql(queries.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    got = sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))
    assert got == sorted(map(str, want.project(", ".join(columns)).fetchall()))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_op1_recall(spark, sf):
    rows = tables(sf).sql("SELECT vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL").fetchall()
    rows = [(i, v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    found = {}
    for r in queries.queries()["op1_ann"](spark, f"{DATA}/{sf}").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        c = unit @ unit[q]
        c[q] = -9
        own = sorted(found[ids[q]])
        assert [r for r, _, _ in own] == list(range(1, 6))
        assert all(abs(c[ids == v][0] - s) < 1e-12 for _, v, s in own)
        hits += len({v for _, v, _ in own} & set(ids[np.lexsort((ids, -c))[:5]].tolist()))
        total += 5
    assert hits >= 0.9 * total


def test_tokens_and_pieces(spark, vocabulary):
    sf = "sf0.001"
    lib = Tokenizer.from_file(vocabulary)
    lib.no_truncation()
    texts = dict(tables(sf).sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    ids = {d: lib.encode(t, add_special_tokens=False).ids for d, t in texts.items()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = queries.queries()["op10_bpe"](spark, f"{DATA}/{sf}").collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == {(d, len(i), sha(" ".join(map(str, i))), sha(lib.decode(i, skip_special_tokens=False))) for d, i in ids.items()}
    pieces = queries.queries()["op3_packing"](spark, f"{DATA}/{sf}").collect()
    want = set()
    for d, own in ids.items():
        own = [*own, 1]
        want |= {(d, k, s, len(own[s : s + 4096]), zlib.crc32(np.array(own[s : s + 4096], "<u4").tobytes())) for k, s in enumerate(range(0, len(own), 4096))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces} == want and len(pieces) == len(want)
    by = {}
    for r in pieces:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and sum(own[-1]) <= 4096
    least = -(-sum(n for _, _, _, n, _ in want) // 4096)
    assert len(by) <= 1.02 * least + 1


def test_op8_by_hand(spark):
    from tests.llm.test_text_operators import linked_by_hand

    rows = tables("sf0.001").sql("SELECT doc_id, text FROM documents").fetchall()
    got = queries.queries()["op8_jaccard"](spark, f"{DATA}/sf0.001").collect()
    assert sorted(map(tuple, got), key=str) == linked_by_hand(rows)


def test_op6_on_held_out_labels(spark):
    got = {r.doc_id: r for r in queries.queries()["op6_quality"](spark, f"{DATA}/sf0.01").collect()}
    truth = tables("sf0.01").sql("SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL").fetchall()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    held = [got[d].predicted == q for d, q in truth if d in got and got[d].held_out]
    assert len(held) > 20 and np.mean(held) > 0.95


def test_op4_leaves_no_found_entity(spark):
    from quirework.llm import pii

    texts = dict(tables("sf0.01").sql("SELECT doc_id, text FROM documents").fetchall())
    got = {r.doc_id: r for r in queries.queries()["op4_pii"](spark, f"{DATA}/sf0.01").collect()}
    assert set(got) == set(texts)
    for d, t in texts.items():
        spans = pii.find(t)
        assert got[d].n_entities == len(spans) and (got[d].text == t or spans)
        if got[d].text is not None:
            assert not any(t[a:b] in got[d].text for a, b, *_ in spans)


def test_pipeline_runs(spark):
    rows = entry.queries()["pipeline"](spark, f"{DATA}/sf0.001").collect()
    assert rows and len({(r.doc_id, r.piece) for r in rows}) == len(rows)


# ---------------------------------------------------------------- hashes and folders
def test_no_family_of_words_shares_a_hash():
    bits = [0]
    for _ in range(12):  # Thue and Morse: a word and its complement meet in any hash by powers modulo 2**64
        bits += [1 - b for b in bits]
    words = [bytes(97 + b for b in bits[:n]) for n in (1024, 2048, 4096)] + [bytes(98 - b for b in bits[:n]) for n in (1024, 2048, 4096)]
    words += [b"a" * n for n in (1, 2, 5000, 5001)] + [b"ab", b"ba", "é".encode(), "e\u0301".encode()]
    data = np.frombuffer(b" ".join(words), np.uint8)
    hashes, _ = _common.word_hashes(data, np.array([0, len(data)]))
    assert len(set(hashes.tolist())) == len(words)
    apart = [_common.word_hashes(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0] for w in words]
    assert apart == hashes.tolist()
    assert _common.word_hashes(np.frombuffer(b"AbC", np.uint8), np.array([0, 3]), lower=True)[0] == _common.word_hashes(np.frombuffer(b"abc", np.uint8), np.array([0, 3]))[0]


def test_hashes_in_small_steps(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.choice(np.frombuffer(b"ab \n", np.uint8), 5000)
    offs = np.r_[0, np.sort(rng.integers(0, 5000, 20)), 5000]
    whole = _common.word_hashes(data, offs)
    monkeypatch.setattr(_common, "SLICE_BYTES", 7)
    steps = _common.word_hashes(data, offs)
    assert (whole[0] == steps[0]).all() and (whole[1] == steps[1]).all()
    words = whole[0]
    for k in (2, 8, 50):
        grams = _common.gram_hashes(words, k)
        seen = {}
        for i, g in enumerate(grams.tolist()):
            assert seen.setdefault(g, words[i : i + k].tolist()) == words[i : i + k].tolist()


def test_no_local_folder_on_a_cluster():
    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1024]"):
        Session.sparkContext = Context(master)
        with pytest.raises(RuntimeError):
            _common.shared_dir(Session)
