"""Substring dedup: windows of ``WINDOW`` words that also start in a document with a smaller doc_id.

First pass: partition sketches, merged into a count-min sketch. A window is counted under its anchor,
the smallest hash of the ``GRAM``-word grams in it: equal windows have equal anchors, so the count of
the anchor (in different documents) is at least that of the window, and a run of neighbouring windows
shares one. Second pass: the windows whose anchor is estimated repeated, and only those, are grouped
exactly. A run travels as one row under its anchor with the 64-bit hashes of its windows (the group is
the pair of both); of the equal windows in one batch only that of the smallest doc_id travels, so a
passage that very many documents share has one row per batch. Where one anchor still has more than ``HOT``
rows, they are first thinned in parts of about that many: of equal windows in a part only that of the
smallest doc_id goes on, each under a key of its own (anchor and window). The marks come back as bit masks, and the covered words are cut out.
A Python worker holds a bounded number of windows at a time, however many of them repeat (one slice of text,
or the rows of one key, are still taken whole).

A window stands for its words by a 64-bit hash under a 64-bit anchor, both multilinear with weights of
their own; the words themselves are not compared again. The sketch has a greatest width: past about 30
million anchors (some 5 GB of text) more windows pass that occur once, in the end all, at 8 bytes each.

Null and empty texts have no words; texts shorter than a window keep all; a very long text is taken whole
by one task; a row with a null doc_id is left as it is and is no source; rows that repeat a doc_id count as
one document, each cut for itself; columns named n_words and n_removed are replaced; an empty table has an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import sketch
from quirework.llm._common import binary_column, flat_binary, gram_hashes, mix, ragged, settled, slices, small_batches, spooled, text_buffers, word_bounds, word_hashes

WINDOW, GRAM = 50, 8
#: Rows of one anchor that are settled in one task.
HOT = 512
#: Bytes of text whose equal windows are merged before they travel.
TOGETHER = 16 << 20
#: Windows of such text that a worker holds at most, and windows of whole anchors that it settles at a time.
HELD, SETTLED = 1 << 20, 1 << 18
#: Files of the table of hot anchors, which is small.
HOT_FILES = 8
_RUN = "anchor long, doc_id long, text_hash long, start int, windows int, hashes binary, mask long"
_COLUMNS = [c.split(" ")[0] for c in _RUN.split(", ")]


def anchored(data: np.ndarray, offs: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window: its text, its start in words, its anchor and its hash; and the words before each text."""
    words, before = word_hashes(data, offs)
    n = np.diff(before)
    count = np.maximum(n - window + 1, 0)
    text = np.repeat(np.arange(len(n)), count)
    at = ragged(before[:-1], count)
    grams = gram_hashes(words, gram)
    reach, low = window - gram + 1, grams
    step = 1
    while 2 * step <= reach:  # minima over 2, 4, 8 ... grams, then over all of a window
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if reach > step:
        low = np.minimum(low[: -(reach - step)], low[reach - step :])
    whole = gram_hashes(words, window)
    return text, at - before[text], low[at] if len(at) else np.zeros(0, np.uint64), whole[at] if len(at) else np.zeros(0, np.uint64), before


def _runs(text: np.ndarray, start: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Heads of the runs of neighbouring windows with one anchor, of 63 windows at most."""
    if not len(text):
        return np.zeros(0, np.int64)
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1) | (anchor[1:] != anchor[:-1])
    where = np.arange(len(text))
    since = where - np.maximum.accumulate(np.where(new, where, 0))
    return np.flatnonzero(since % 63 == 0)


def _later(anchor: np.ndarray, whole: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which windows have an equal one in a document with a smaller doc_id."""
    order = np.lexsort((doc, whole, anchor))
    a, w, d = anchor[order], whole[order], doc[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1])
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.empty(len(order), bool)
    out[order] = d > least
    return out


def _masks(marked: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """One bit for each window of a run."""
    if not len(heads):
        return np.zeros(0, np.int64)
    place = np.arange(len(marked)) - np.repeat(heads, np.diff(np.r_[heads, len(marked)]))
    return np.bitwise_or.reduceat(marked.astype(np.int64) << place, heads)


def marks(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_hash, start, mask): the windows that are to go, as bits from ``start`` on; only rows with a bit."""
    small_batches(docs.sparkSession)
    keyed = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = sketch.width_for(size / 7 * 2 / (window - gram + 2))  # about 7 bytes a word, an anchor for each half window
    cut = lambda batches: slices(batches, "text")

    def anchors(batch: pa.RecordBatch) -> np.ndarray:
        text, _, anchor, _, _ = anchored(*text_buffers(batch.column(1)), window, gram)
        doc = batch.column(0).to_numpy()[text] if len(text) else np.zeros(0, np.int64)
        new = np.ones(len(text), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        anchor, doc = anchor[new], doc[new]
        order = np.lexsort((anchor, doc))  # once for each document
        a, d = anchor[order], doc[order]
        keep = np.ones(len(order), bool)
        keep[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
        return a[keep]

    maps = keyed.sparkSession.sparkContext.broadcast(sketch.repeated(keyed.select("doc_id", "text"), anchors, width, cut))

    def emit(held: list[tuple]) -> pa.RecordBatch:
        first = np.cumsum([0] + [len(h[0]) for h in held])
        docs_of, hashes_of, start, anchor, whole = (np.concatenate([h[i] for h in held]) for i in (0, 1, 3, 4, 5))
        text = np.concatenate([h[2] + f for h, f in zip(held, first, strict=False)])
        held.clear()
        gone = _later(anchor, whole, docs_of[text])
        heads = _runs(text, start, anchor)
        bounds = np.r_[heads, len(text)]
        doc, text_hash = docs_of[text[heads]], hashes_of[text[heads]]
        mask = _masks(gone, heads)
        settled = np.array([], bool) if not len(heads) else np.logical_and.reduceat(gone, heads)
        # runs whose windows have all gone have nothing left to ask; they go anywhere
        size = np.where(settled, 0, np.diff(bounds))
        hashes = whole[ragged(heads, size)]
        key = np.where(settled, (doc * 0x9E3779B1).astype(np.uint64), anchor[heads]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array(text_hash), pa.array(start[heads], pa.int32()), pa.array(np.diff(bounds), pa.int32()), binary_column(hashes, np.r_[0, np.cumsum(size)]), pa.array(mask)], _COLUMNS)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, windows = [], 0, 0
        for batch in slices(batches, "text"):
            data, offs = text_buffers(batch.column(2))
            text, start, anchor, whole, _ = anchored(data, offs, window, gram)
            keep = sketch.passes(anchor, maps.value, width)
            # copies: a view would keep the whole batch with its texts
            held.append((batch.column(0).to_numpy().copy(), batch.column(1).to_numpy().copy(), text[keep], start[keep].astype(np.int32), anchor[keep], whole[keep]))
            size += len(data)
            windows += int(keep.sum())
            if size >= TOGETHER or windows >= HELD:
                yield emit(held)
                held, size, windows = [], 0, 0
        if held:
            yield emit(held)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Tables of whole anchors, from batches sorted by anchor."""
        rest: list[pa.RecordBatch] = []
        rows = windows = 0
        step = max(1, SETTLED // 256)  # a run has 63 windows at most
        for batch in (b.slice(at, step) for b in batches for at in range(0, b.num_rows, step)):
            rest.append(batch)
            rows += batch.num_rows
            windows += int(batch.column("windows").to_numpy().sum())
            last = batch.column("anchor")[-1].as_py()
            if (rows < 20_000 and windows < SETTLED) or last == rest[0].column("anchor")[0].as_py():
                continue
            table = pa.Table.from_batches(rest).combine_chunks()
            end = int(np.searchsorted(table.column("anchor").to_numpy(), last))
            yield table.slice(0, end).combine_chunks()
            table = table.slice(end).combine_chunks()
            rest, rows, windows = table.to_batches(), table.num_rows, int(table.column("windows").to_numpy().sum())
        if rest:
            yield pa.Table.from_batches(rest).combine_chunks()

    def judged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The masks with the windows that another row of the table sends away, and the hashes with their bounds."""
        windows = table.column("windows").to_numpy()
        flat, bounds = flat_binary(table.column("hashes"), np.uint64)
        mask = table.column("mask").to_numpy().copy()
        live = np.flatnonzero(np.diff(bounds) > 0)
        if len(live):
            gone = _later(np.repeat(table.column("anchor").to_numpy()[live], windows[live]), flat, np.repeat(table.column("doc_id").to_numpy()[live], windows[live]))
            mask[live] |= _masks(gone, bounds[live])
        return mask, flat, bounds

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row's marks so far, which ask for nothing more, and every window that is left by itself under a key of its own."""
        for table in grouped(batches):
            mask, flat, bounds = judged(table)
            doc, start = table.column("doc_id").to_numpy(), table.column("start").to_numpy()
            row = np.repeat(np.arange(len(doc)), np.diff(bounds))
            place = np.arange(len(flat)) - bounds[:-1][row]
            left = np.flatnonzero((mask[row] >> place & 1) == 0)
            said = np.flatnonzero(mask != 0)
            at = np.concatenate([said, row[left]])
            own = mix(flat[left] ^ table.column("anchor").to_numpy()[row[left]].view(np.uint64))
            key = np.concatenate([mix(doc[said].view(np.uint64)), own]).view(np.int64)
            one = np.r_[np.zeros(len(said), np.int64), np.ones(len(left), np.int64)]
            yield pa.RecordBatch.from_arrays([
                pa.array(key), pa.array(doc[at]), pa.array(table.column("text_hash").to_numpy()[at]),
                pa.array(np.concatenate([start[said], start[row[left]] + place[left]]), pa.int32()), pa.array(np.concatenate([table.column("windows").to_numpy()[said], np.ones(len(left))]), pa.int32()),
                binary_column(flat[left], np.r_[0, np.cumsum(one)]), pa.array(np.concatenate([mask[said], np.zeros(len(left), np.int64)])),
            ], _COLUMNS)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            mask, _, _ = judged(table)
            keep = np.flatnonzero(mask)
            yield pa.RecordBatch.from_arrays([pa.array(table.column(c).to_numpy()[keep], k) for c, k in (("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()))] + [pa.array(mask[keep])], ["doc_id", "text_hash", "start", "mask"])

    sent = spooled(keyed.mapInArrow(candidates, _RUN), "runs")
    # of so few anchors that they can be broadcast, whatever the size of the table
    least = max(HOT, sent.count() >> 20)
    hot = settled(sent.groupBy("anchor").count().where(F.col("count") > least).repartition(HOT_FILES))
    if not hot.isEmpty():
        part = F.pmod(F.xxhash64("doc_id", "start"), F.ceil(F.col("count") / least))
        parts = sent.join(F.broadcast(hot), "anchor").repartition("anchor", part).sortWithinPartitions("anchor").select(*_COLUMNS)
        sent = sent.join(F.broadcast(hot), "anchor", "left_anti").select(*_COLUMNS).unionByName(parts.mapInArrow(thin, _RUN))
    return sent.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(exact, "doc_id long, text_hash long, start int, mask long")


def covered(n: int, found: list, window: int) -> np.ndarray:
    """Which of n words lie in a marked window."""
    edge = np.zeros(n + window + 64, np.int32)
    for m in found:
        mask, start = m["mask"], m["start"]
        bits = np.flatnonzero(np.unpackbits(np.array([mask], "<i8").view(np.uint8), bitorder="little")) + start
        edge[bits] += 1
        edge[bits + window] -= 1
    return np.cumsum(edge)[:n] > 0


def marked(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``_marks``, the marks of each row."""
    found = marks(docs, window).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "mask")).alias("_marks"))
    own = docs.withColumn("_id", F.col("doc_id").cast("long")).withColumn("_hash", F.xxhash64("text"))
    return own.join(found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_marks"), ["_id", "_hash"], "left").drop("_id", "_hash")


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the covered words cut out of ``text`` (the white space between kept words stays), n_words and n_removed, which replace columns of those names."""
    docs = docs.drop("n_words", "n_removed", "_marks", "_id", "_hash")
    schema = docs.schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column(batch.schema.get_field_index("text"))
            data, offs = text_buffers(texts)
            starts, ends, before = word_bounds(data, offs)
            said, gone = [], []
            for i, (text, found) in enumerate(zip(texts.to_pylist(), batch.column(batch.schema.get_field_index("_marks")).to_pylist(), strict=True)):
                if not found:
                    said.append(text)
                    gone.append(0)
                    continue
                lo, hi = before[i], before[i + 1]
                out = covered(hi - lo, found, window)
                # a kept word takes the white space after it along
                reach = np.r_[starts[lo + 1 : hi], offs[i + 1]]
                keep = np.flatnonzero(~out)
                joined = np.flatnonzero(np.r_[True, np.diff(keep) > 1]) if len(keep) else np.zeros(0, np.int64)
                last = np.r_[joined[1:], len(keep)] - 1
                raw = data[offs[i] : offs[i + 1]].tobytes()
                parts = [raw[starts[lo + keep[a]] - offs[i] : reach[keep[b]] - offs[i]] for a, b in zip(joined, last, strict=True)] if len(keep) else []
                said.append(b"".join(parts).decode())
                gone.append(int(out.sum()))
            names = [n for n in batch.schema.names if n != "_marks"]
            cols = [pa.array(said, pa.string()) if n == "text" else batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.diff(before), pa.int64()), pa.array(gone, pa.int64())], [*names, "n_words", "n_removed"])

    return marked(docs, window).mapInArrow(run, f"{schema}, n_words long, n_removed long")


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n, gone, sha = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("_marks").to_pylist(), strict=True):
                words = text.encode().split() if text else []  # bytes split at exactly these six separators
                n.append(len(words))
                out = covered(len(words), found, window) if found else None
                kept = words if out is None else [w for w, x in zip(words, out.tolist(), strict=True) if not x]
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return marked(docs.select("doc_id", "text"), window).select("doc_id", "text", "_marks").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, greatest(len(w) - {WINDOW} + 2, 1))) AS i, w FROM d),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h FROM s),
g AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS least FROM h),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM g WHERE least < doc_id),
r AS (SELECT doc_id, list(p) AS p FROM c GROUP BY doc_id),
k AS (SELECT d.doc_id, d.w, coalesce(r.p, []) AS p FROM d LEFT JOIN r USING (doc_id)),
x AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM d),
y AS (SELECT x.doc_id, string_agg(x.t, ' ' ORDER BY x.i) AS t FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.p = x.i WHERE c.p IS NULL GROUP BY x.doc_id)
SELECT k.doc_id, len(k.w)::BIGINT AS n_words, len(k.p)::BIGINT AS n_removed, sha256(coalesce(y.t, '')) AS kept_sha256
FROM k LEFT JOIN y USING (doc_id)
"""
