"""Language-model scoring: stupid backoff over n-gram counts of all documents.

Each worker packs about ``BATCH_BYTES`` of text into one row (word hashes as a local vocabulary, words
as indices into it) of a spooled table. The distinct n-grams of all orders of a row, with their local
counts, are dealt by ranges of their 64-bit hash; one task holds the count table of a range, adds up
the counts of all rows and sends each row the totals of its own n-grams, in the order they came. Joined
to the row's n-grams they give every word its score, summed per document. A frequent n-gram is one
entry per row, so no range is hot, and nothing is pruned from the counts.

The counts include the text that is scored, in which every n-gram is seen: with a backoff at a count of 0 no
score would ever back off. Here an n-gram that is seen once, in this very place, backs off (``LEAST``).

Null and empty texts have no words and a log probability of 0; a very long text fills a batch of its own; other columns are left out; repeated rows count as often as they
stand; a null doc_id is carried along; an empty table has an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm._common import mix, shuffle_partitions, slices, small_batches, spooled, text_buffers, word_hashes

ORDER = 2
#: An n-gram seen less often than this backs off to the next shorter one.
LEAST = 2
BACKOFF = 0.4
BATCH_BYTES = 8 << 20
#: N-grams (each counted once for each batch that has it) in one range of hashes.
RANGE = 8_000_000

_PACKED = "batch long, ids binary, known binary, sizes binary, vocabulary binary, planes binary, words long"


def _planes(x: np.ndarray) -> bytes:
    """Byte planes of indices, three or (from 2**24 on) four: the high ones are nearly all 0 and compress."""
    planes = 3 if not len(x) or x.max() < 1 << 24 else 4
    return b"".join((x >> s).astype(np.uint8).tobytes() for s in range(0, 8 * planes, 8))


def _unplanes(b: bytes, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for i, plane in enumerate(np.frombuffer(b, np.uint8).reshape(-1, n) if n else ()):
        out |= plane.astype(np.int64) << 8 * i
    return out


def _short(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as single bytes, and the larger ones as (position, count) pairs."""
    big = np.flatnonzero(counts >= 255)
    return np.minimum(counts, 255).astype(np.uint8).tobytes(), np.stack([big, counts[big]], axis=1).astype(np.int64).tobytes()


def _long(small: bytes, big: bytes) -> np.ndarray:
    counts = np.frombuffer(small, np.uint8).astype(np.int64)
    at = np.frombuffer(big, np.int64).reshape(-1, 2)
    counts[at[:, 0]] = at[:, 1]
    return counts


def _gaps(keys: np.ndarray, base: int) -> bytes:
    """Sorted distinct keys from ``base`` on as byte planes of the gaps between them, as many as the widest gap needs."""
    gap = np.diff(keys, prepend=np.uint64(base))
    wide = max(1, -(-int(gap.max()).bit_length() // 8))
    return np.ascontiguousarray(gap.view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()


def _ungaps(raw: bytes, n: int, base: int) -> np.ndarray:
    gap = np.zeros((n, 8), np.uint8)
    gap[:, : len(raw) // n] = np.frombuffer(raw, np.uint8).reshape(-1, n).T
    return np.cumsum(gap.view(np.uint64).ravel(), dtype=np.uint64) + np.uint64(base)


def pack(docs: DataFrame) -> DataFrame:
    """One row for each batch of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            hashes = np.concatenate([h for _, _, h, _ in held])
            vocabulary, at, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")  # frequent words get small indices
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            row = [first + n, b"".join(i for i, _, _, _ in held), b"".join(k for _, k, _, _ in held), np.concatenate([s for _, _, _, s in held]).astype(np.int32).tobytes(), vocabulary[order].tobytes(), _planes(place[at.ravel()] if len(at) else np.zeros(0, np.int64)), len(hashes)]
            kinds = [pa.int64(), *[pa.binary()] * 5, pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], [c.split(" ")[0] for c in _PACKED.split(", ")])

        size = 0
        for batch in slices(batches, "text"):
            data, offs = text_buffers(batch.column(1))
            hashes, before = word_hashes(data, offs)
            ids = batch.column(0)
            held.append((ids.fill_null(0).to_numpy().astype(np.int64).tobytes(), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(), hashes, np.diff(before)))
            size += len(data)
            if size >= BATCH_BYTES:
                yield flush()
                held, size, n = [], 0, n + 1
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PACKED)


def grams(vocabulary: np.ndarray, words: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each n from 1 to ``order`` the hash of the n-gram that ends at each word; 0 where the text is shorter."""
    hashes = vocabulary[words] if len(words) else np.zeros(0, np.uint64)
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = [np.maximum(mix(hashes + np.uint64(1)), np.uint64(1))]
    for n in range(2, order + 1):
        longer = np.zeros(len(words), np.uint64)
        longer[1:] = mix(out[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] + np.uint64(n))
        out.append(np.where(place >= n - 1, np.maximum(longer, np.uint64(1)), np.uint64(0)))
    return out


def _unpack(row: dict, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
    return sizes, grams(np.frombuffer(row["vocabulary"], np.uint64), _unplanes(row["planes"], int(sizes.sum())), sizes, order)


def _base(part: int, parts: int) -> int:
    return (part << 64) // parts


def _ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of the equal ranges of the hash space in sorted keys."""
    cuts = np.array([_base(i, parts) for i in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, cuts), [len(keys)]])


def totals(packed: DataFrame, order: int, words: int) -> DataFrame:
    """(batch, part, small, big): for each batch and range the totals of its n-grams, sorted by hash.

    There are so many ranges that the n-grams of all ``words`` words fill none beyond ``RANGE`` entries."""
    parts = max(shuffle_partitions(packed.sparkSession), -(-words * order // RANGE))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = np.unique(np.concatenate(_unpack(row, order)[1]), return_counts=True)
                keys, counts = (keys[1:], counts[1:]) if len(keys) and not keys[0] else (keys, counts)
                cut = _ranges(keys, parts)
                spans = [(p, a, b) for p, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < b]
                short = [_short(counts[a:b]) for _, a, b in spans]
                yield pa.RecordBatch.from_arrays([pa.array([row["batch"]] * len(spans), pa.int64()), pa.array([p for p, _, _ in spans], pa.int32()), pa.array([_gaps(keys[a:b], _base(p, parts)) for p, a, b in spans], pa.binary()), pa.array([s for s, _ in short], pa.binary()), pa.array([b for _, b in short], pa.binary())], ["batch", "part", "keys", "small", "big"])

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                held.setdefault(r["part"], []).append((r["batch"], _ungaps(r["keys"], len(r["small"]), _base(r["part"], parts)), _long(r["small"], r["big"])))
        for part in sorted(held):
            rows = held.pop(part)
            keys, at = np.unique(np.concatenate([k for _, k, _ in rows]), return_inverse=True)
            count = np.bincount(at.ravel(), np.concatenate([c for _, _, c in rows]), minlength=len(keys)).astype(np.int64)
            own = np.split(count[at.ravel()], np.cumsum([len(k) for _, k, _ in rows])[:-1])
            short = [_short(c) for c in own]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _, _ in rows], pa.int64()), pa.array([part] * len(rows), pa.int32()), pa.array([s for s, _ in short], pa.binary()), pa.array([b for _, b in short], pa.binary())], ["batch", "part", "small", "big"])

    sent = packed.select("batch", "sizes", "vocabulary", "planes").mapInArrow(local, "batch long, part int, keys binary, small binary, big binary")
    return sent.repartition(parts, "part").mapInArrow(table, "batch long, part int, small binary, big binary")


def score(docs: DataFrame, order: int = ORDER, least: int = LEAST, backoff: float = BACKOFF) -> DataFrame:
    """doc_id, n_words, log_prob: the sum over a document's words of the log of their stupid-backoff scores."""
    small_batches(docs.sparkSession)
    packed = spooled(pack(docs), "packed")
    n = packed.agg(F.sum("words")).first()[0] or 0

    def own(key, texts: pa.Table, found: pa.Table) -> pa.Table:
        row = texts.to_pylist()[0]
        sizes, hashes = _unpack(row, order)
        keys = np.unique(np.concatenate(hashes))
        keys = keys[1:] if len(keys) and not keys[0] else keys
        parts = sorted(found.to_pylist(), key=lambda r: r["part"])
        count = np.concatenate([np.zeros(0, np.int64), *(_long(r["small"], r["big"]) for r in parts)])
        of = [np.where(h > 0, count[np.searchsorted(keys, h)], 0) if len(keys) else np.zeros(0, np.int64) for h in hashes]
        logs = np.log(np.maximum(of[0], 1) / max(n, 1))
        for k in range(1, order):
            history = np.ones(len(logs))
            history[1:] = np.maximum(of[k - 1][:-1], 1)
            inside = hashes[k] > 0
            logs = np.where(of[k] >= least, np.log(np.maximum(of[k], 1) / history), np.where(inside, np.log(backoff) + logs, logs))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        known = np.frombuffer(row["known"], np.uint8).astype(bool)
        return pa.table({"doc_id": pa.array(np.frombuffer(row["ids"], np.int64), mask=~known), "n_words": pa.array(sizes), "log_prob": pa.array(np.bincount(doc, logs, minlength=len(sizes)).astype(float))})

    texts = packed.select("batch", "ids", "known", "sizes", "vocabulary", "planes")
    both = texts.groupBy("batch").cogroup(totals(packed, order, n).groupBy("batch"))
    return both.applyInArrow(own, "doc_id long, n_words long, log_prob double")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    mean = F.when(F.col("n_words") > 0, F.round(F.col("log_prob") / F.col("n_words"), 6))
    return rows.select("doc_id", "n_words", F.round("log_prob", 3).alias("log_prob"), mean.alias("mean_log_prob"))


OP5_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS b, unnest(range(1, len(w) + 1)) AS i, w FROM d),
g AS (SELECT doc_id, i, b, CASE WHEN i > 1 THEN w[i - 1] END AS a FROM t),
u AS (SELECT b, count(*) AS c FROM g GROUP BY b),
p AS (SELECT a, b, count(*) AS c FROM g WHERE a IS NOT NULL GROUP BY a, b),
s AS (SELECT g.doc_id, CASE WHEN g.a IS NULL THEN ln(u.c / n.c) WHEN p.c >= {LEAST} THEN ln(p.c / h.c) ELSE ln({BACKOFF}) + ln(u.c / n.c) END AS s
  FROM g JOIN u ON u.b = g.b LEFT JOIN p ON p.a = g.a AND p.b = g.b LEFT JOIN u h ON h.b = g.a CROSS JOIN (SELECT count(*) AS c FROM g) n),
r AS (SELECT doc_id, sum(s) AS s FROM s GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, round(coalesce(r.s, 0), 3) AS log_prob, round(r.s / len(d.w), 6) AS mean_log_prob
FROM d LEFT JOIN r USING (doc_id)
"""
