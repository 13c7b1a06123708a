"""Tokens, packing, substrings, similarity, language model: against brute force and the tokenizers library."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quirework.llm import bpe, jaccard, lm, packing, substring

ODD = [(None, "a b c d e f g h"), (900, None), (901, ""), (902, " \n\t ")]
DOCS = "doc_id long, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def noise(seed, n):
    rng = random.Random(seed)
    alpha = list("abcdefgh'stre  \n\t<|>éñßÜΣİẞ0123!?.,\x1c\x85\xa0​́中😀") + ["<|endoftext|>", "<|startoftext|>", "'ll", "the", "ing", " "]
    return ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 60))) for _ in range(n)]


# ---------------------------------------------------------------- BPE
def test_bpe_is_the_library(spark, vocabulary):
    lib = Tokenizer.from_file(vocabulary)
    texts = noise(1, 1500) + ["thing " * 5000, None, ""]
    rows = bpe.encode(frame(spark, list(enumerate(texts))), vocabulary).collect()
    for r in rows:
        want = lib.encode(r.text or "", add_special_tokens=False)
        assert r.ids == want.ids and r.decoded == lib.decode(want.ids, skip_special_tokens=False)
    again = bpe.decode(spark.createDataFrame([(r.doc_id, r.ids) for r in rows[:50]], "doc_id long, ids array<int>"), vocabulary).collect()
    assert [r.decoded for r in again] == [r.decoded for r in rows[:50]]


def test_bpe_digests(spark, vocabulary):
    lib = Tokenizer.from_file(vocabulary)
    for r in bpe.digests(frame(spark, [*ODD, (1, "Hello, WORLD <|endoftext|>"), (1, "Hello, WORLD <|endoftext|>")]), vocabulary).collect():
        text = next((t for d, t in [*ODD, (1, "Hello, WORLD <|endoftext|>")] if d == r.doc_id), None) or ""
        ids = lib.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.digests(frame(spark, []), vocabulary).count() == 0


def test_bpe_table_forgets(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 10)
    coder = bpe.Encoder(bpe.MergeTable(bpe.load_spec(vocabulary)))
    lib = Tokenizer.from_file(vocabulary)
    for t in noise(2, 60):
        assert coder.encode([t])[0].tolist() == lib.encode(t, add_special_tokens=False).ids


# ---------------------------------------------------------------- packing
def test_plan_places_every_piece_once():
    rng = random.Random(0)
    for _ in range(300):
        cap = rng.choice([7, 20, 100])
        h = {rng.randint(1, cap): rng.randint(1, 30) for _ in range(rng.randint(0, 20))}
        left, seqs = dict(h), {}
        for length, _, n, each, first, offset in packing.plan(h, cap):
            left[length] -= n
            for i in range(n):
                seqs.setdefault(first + i // each, []).append((offset + i % each * length, length))
        assert not any(left.values()) and sorted(seqs) == list(range(len(seqs)))
        for own in seqs.values():
            own.sort()
            assert own[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(own, own[1:])) and sum(own[-1]) <= cap
        total = sum(k * n for k, n in h.items())
        assert len(seqs) <= max(1.25 * total / cap + 1, sum(n for k, n in h.items() if 2 * k > cap) + total / cap + 1)


def test_packed(spark, vocabulary):
    lib = Tokenizer.from_file(vocabulary)
    docs = [*ODD, (1, "one two three " * 4000), (2, "short"), (2, "short"), *((10 + i, "word " * (i * 7 % 300)) for i in range(60))]
    rows = packing.packed(frame(spark, docs), vocabulary).collect()
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in seqs.values():
        own.sort()
        assert own[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(own, own[1:])) and sum(own[-1]) <= 4096
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc in (1, 901, 900, 15):
        ids = [*lib.encode(dict(docs)[doc] or "", add_special_tokens=False).ids, 1]
        own = sorted(by_doc[doc], key=lambda r: r.piece)
        for r in own:
            assert r.start == 4096 * r.piece and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        assert sum(r.length for r in own) == len(ids)
    assert len(by_doc[2]) == 2 and packing.packed(frame(spark, []), vocabulary).count() == 0


# ---------------------------------------------------------------- substrings
def cut_by_hand(docs, win):
    first = {}
    for d, t in docs:
        w = t.split() if d is not None and t else []
        for i in range(len(w) - win + 1):
            k = tuple(w[i : i + win])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, t in docs:
        w, gone = (t or "").split(), set()
        for i in range(len(w) - win + 1) if d is not None else ():
            if first[tuple(w[i : i + win])] < d:
                gone |= set(range(i, i + win))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [3, 4])
def test_substrings(spark, monkeypatch, seed):
    rng, win, docs = random.Random(seed), 6, [*ODD]
    for i in range(70):
        t = []
        while len(t) < rng.randint(0, 40):
            t += [rng.choice("abcd")] if rng.random() < 0.5 else rng.choice([list("abcabc"), list("ddddd"), list("bacd")])
        docs.append((i // 2 if i % 7 else i, rng.choice([" ", "\n", "  "]).join(t) + rng.choice(["", " "])))
    whole = substring.marks
    monkeypatch.setattr(substring, "marks", lambda d, w=win: whole(d, w, 3))
    monkeypatch.setattr(substring, "TOGETHER", 200)
    monkeypatch.setattr(substring, "HOT", 2 if seed == 4 else 512)
    want = cut_by_hand(docs, win)
    got = substring.deduplicated(frame(spark, docs), win).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, " ".join((r.text or "").split())) for r in got), key=str) == want
    sha = substring.digests(frame(spark, docs), win).collect()
    assert sorted((str(r.doc_id), r.n_removed, r.kept_sha256) for r in sha) == sorted((str(d), m, hashlib.sha256(t.encode()).hexdigest()) for d, _, m, t in want)
    assert substring.digests(frame(spark, []), win).count() == 0


@pytest.fixture
def conf(spark):
    """Sets a setting of the session for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


def test_a_worker_holds_a_bounded_number_of_windows(spark, monkeypatch, conf):
    rng, later = random.Random(7), substring._later
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(2000)) for _ in range(30)]

    def counted(anchor, whole, doc):
        assert len(anchor) <= 10_000
        return later(anchor, whole, doc)

    monkeypatch.setattr(substring, "_later", counted)
    monkeypatch.setattr(substring, "HELD", 5000, raising=False)
    monkeypatch.setattr(substring, "SETTLED", 2000, raising=False)
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    got = substring.digests(frame(spark, [(i, texts[i % 30]) for i in range(60)]).coalesce(1)).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: 0 if i < 30 else 2000 for i in range(60)}


def test_hot_anchors_stand_in_few_files(spark, monkeypatch, conf):
    rng, win, parts, settled = random.Random(8), 6, [], substring.settled

    def counted(df):
        out = settled(df)
        parts.append((out.rdd.getNumPartitions(), out.count()))
        return out

    docs = [(i, " ".join([*(rng.choice("abcd") for _ in range(5)), *"xyzxyz", *(rng.choice("abcd") for _ in range(5))])) for i in range(40)]
    whole = substring.marks
    monkeypatch.setattr(substring, "marks", lambda d, w=win: whole(d, w, 3))
    monkeypatch.setattr(substring, "settled", counted)
    for name, value in (("TOGETHER", 200), ("HOT", 2), ("HELD", 50), ("SETTLED", 20)):
        monkeypatch.setattr(substring, name, value, raising=False)
    conf("spark.sql.shuffle.partitions", "32")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = substring.digests(frame(spark, docs), win).collect()
    assert sorted((str(r.doc_id), r.n_removed, r.kept_sha256) for r in got) == sorted((str(d), m, hashlib.sha256(t.encode()).hexdigest()) for d, _, m, t in cut_by_hand(docs, win))
    assert parts and all(n <= 8 and rows > 0 for n, rows in parts)


def test_kept_text_keeps_its_white_space(spark):
    words = [f"w{i}" for i in range(60)]
    docs = [(1, " ".join(words)), (2, "begin\n\nhere  " + " ".join(words) + "\nand end "), (3, "x " * 10)]
    got = {r.doc_id: r for r in substring.deduplicated(frame(spark, docs)).collect()}
    assert got[2].text == "begin\n\nhere  and end " and got[1].text == docs[0][1] and got[3].text == docs[2][1]


# ---------------------------------------------------------------- similarity
def linked_by_hand(docs, k=5, percent=75):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and docs[i][0] is not None and docs[j][0] is not None and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least[find(i)] if d is not None else None) for i, (d, _) in enumerate(docs)), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_similar_documents(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "COMMON", 3)
    monkeypatch.setattr(jaccard, "SMALL", seed)
    monkeypatch.setattr(jaccard, "HOT", 4 if seed == 2 else 100_000)
    rng, docs = random.Random(seed), []
    for _ in range(25):
        base = [rng.choice("abcdefghij") for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(1, 14)):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = rng.choice("abcXYz")
            docs.append((len(docs), rng.choice([" ", "\n"]).join(t[: rng.randint(1, len(t))] if rng.random() < 0.3 else t)))
    docs += [(None, docs[5][1]), (1000, None), (1001, ""), (3, docs[3][1])]
    assert sorted(map(tuple, jaccard.linked(frame(spark, docs)).collect()), key=str) == linked_by_hand(docs)


def test_similar_corner_cases(spark):
    assert jaccard.linked(frame(spark, [])).count() == 0
    lonely = jaccard.linked(frame(spark, [(1, None), (2, ""), (3, "one two")])).collect()
    assert sorted(map(tuple, lonely)) == [(1, 0, 1), (2, 0, 2), (3, 1, 3)]


def near_sets(rng, groups, most):
    """Sets of made-up shingles: near copies of some bases, of many sizes."""
    out = []
    for _ in range(groups):
        base = rng.integers(0, 1 << 60, rng.integers(4, most), dtype=np.uint64)
        for _ in range(rng.integers(1, 9)):
            keep = base[rng.random(len(base)) < rng.choice([0.6, 0.8, 0.95])]
            out.append(np.unique(np.r_[keep, rng.integers(0, 1 << 60, rng.integers(0, len(base) // 4 + 1), dtype=np.uint64)]))
    return [x for x in out if len(x)]


def test_signatures_bound_the_distance():
    sets = near_sets(np.random.default_rng(1), 40, 6000)
    signed = jaccard.Signatures(jaccard.signatures(np.concatenate(sets), np.r_[0, np.cumsum([len(x) for x in sets])]))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    true = np.array([len(np.setxor1d(sets[i], sets[j])) for i, j in zip(a, b, strict=True)])
    bound = signed.apart(a, b)
    assert (bound <= true).all() and (bound[a == b] == 0).all()
    size = np.array([len(x) for x in sets])
    fair = (np.maximum(signed.level[a], signed.level[b]) < 6) & (true > 40) & (2 * true < np.minimum(size[a], size[b]))
    assert fair.any() and bound[fair].mean() > 0.7 * true[fair].mean()


@pytest.mark.parametrize("seed", [0, 1])
def test_list_blocks_leave_no_linked_pair(seed):
    import pyarrow as pa

    rng = np.random.default_rng(seed)
    sets = near_sets(rng, 30, 80)
    count = len(sets)
    size = np.array([len(x) for x in sets])
    linked = lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    component = rng.integers(0, 12, count)
    hub = rng.integers(0, count, count)
    rows = []
    for i, own in enumerate(sets):
        for place, token in enumerate(own[: jaccard.prefix_length(np.array([len(own)]))[0]]):
            rows.append((int(token >> np.uint64(1)), i + 1, size[i], place, component[i], hub[i] + 1, len(np.setxor1d(own, sets[hub[i]])), i))
    packed = jaccard.signatures(np.concatenate(sets), np.r_[0, np.cumsum(size)])
    table = []
    for i in range(count):
        own = [r for r in rows if r[-1] == i]
        tokens, places = np.array([r[0] for r in own], np.uint64), np.array([r[3] for r in own], np.int32)
        table.append((0, i + 1, size[i], component[i], hub[i] + 1, own[0][6], None if i % 5 == 0 else packed[i].as_py(), tokens.tobytes(), places.tobytes(), bytes(4 * len(own))))
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
    names = [c.split(" ")[0] for c in jaccard._ENTRIES.split(", ")]
    table = pa.table([pa.array(c, k) for c, k in zip(zip(*table, strict=True), kinds, strict=True)], names)
    got = {(a - 1, b - 1) for part in jaccard.possible(table, most=500) for a, b in part.tolist()}
    want = {(i, j) for j in range(count) for i in range(j) if component[i] != component[j] and linked(i, j)}
    assert len(want) > 10 and want <= got and all(component[i] != component[j] for i, j in got)


def test_very_long_text_among_its_copies(spark):
    words = [f"w{i}" for i in range(300_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:290_000])), (3, " ".join(words[:200_000])), (4, "w1 w2 w3 w4 w5 w6")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked(frame(spark, docs)).collect()}
    assert got == {1: (299_996, 1), 2: (289_996, 1), 3: (199_996, 3), 4: (2, 4)}


# ---------------------------------------------------------------- language model
def test_backoff_scores(spark):
    docs = [*ODD, (1, "a b a b c"), (2, "a b d"), (2, "a b d")]
    from collections import Counter
    from math import log

    words = [(t or "").split() for _, t in docs]
    u = Counter(w for d in words for w in d)
    for order in (1, 2, 3):
        c = [None, u] + [Counter(tuple(d[i : i + k]) for d in words for i in range(len(d) - k + 1)) for k in range(2, order + 1)]
        n, want = sum(u.values()), []
        for d in words:
            s = 0.0
            for i, w in enumerate(d):
                v = log(u[w] / n)
                for k in range(2, min(order, i + 1) + 1):
                    g = tuple(d[i - k + 1 : i + 1])
                    past = c[k - 1][g[:-1]] if k > 2 else u[g[0]]
                    v = log(c[k][g] / past) if c[k][g] >= 2 else log(0.4) + v
                s += v
            want.append(round(s, 9))
        got = lm.score(frame(spark, docs), order).collect()
        assert sorted(round(r.log_prob, 9) for r in got) == sorted(want)
    assert lm.score(frame(spark, [])).count() == 0


def test_planes():
    for x in (np.array([0, 5, 70_000, (1 << 24) - 1]), np.array([1 << 24, 3]), np.zeros(0, np.int64)):
        assert (lm._unplanes(lm._planes(x), len(x)) == x).all()


def test_gaps():
    rng = np.random.default_rng(0)
    for base in (0, 1 << 60):
        keys = np.unique(rng.integers(base, base + (1 << 62), 1000, dtype=np.uint64))
        assert (lm._ungaps(lm._gaps(keys, base), len(keys), base) == keys).all()
    c = np.array([1, 254, 255, 10**12])
    assert (lm._long(*lm._short(c)) == c).all()
