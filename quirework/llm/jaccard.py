"""N-gram Jaccard join with set-relation skipping.

A document is the set of its distinct word shingles; documents with equal sets are one set. Shingles
have one global order (the rare before those that some batch saw often, then by hash), and two sets
that are similar enough share a shingle of their prefixes. Prefix shingles that a count-min sketch
estimates in one set only are left out (none that two sets share are). Each set has a signature, the
parity of its shingles in so many cells: cells that differ bound from below how many shingles lie in
one of two sets only (their distance).

Index lists hold (size, position) blocks. Answers come in two rounds:

1. In every list each set meets only one set of about its size, the one with the fewest shingles of its
   own (its hub). Pairs that the signatures leave possible are compared; linked sets form components.
2. Only pairs from different components are left. A list whose sets lie in one component is skipped
   whole; in others, blocks of other sizes or beyond the last useful position are skipped, and the sets of
   the list's largest component meet those of other components only. A set's answer is derived from that of its
   hub, which it is highly similar to: the distance of a third set from the hub less the set's own is a
   lower bound, and where that excludes the pair nothing else is looked at. What the signatures of the
   pair leave possible is compared. All of this is decided where the list is, so only pairs that nearly link
   leave it; entries of lists of up to ``SMALL`` sets travel without signatures, as their pairs are few.
   A set's entries in the lists of one task travel as one row.

Lists meet per batch first and send on one hub each, so a shingle that very many sets hold stays small in the
first round. In the second, a list of more than ``HOT`` sets is dealt over parts: those of its largest component
to one part each, the others to every part.

Null and empty texts have empty sets and no links; a text with fewer words than a shingle is one
shingle; a very long text is one set like any other, taken whole; rows that repeat a doc_id are separate
sets whose component may be shared; a null doc_id has no links and no component; an empty table has an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import sketch
from quirework.llm._common import binary_column, flat_binary, gram_hashes, mix, ragged, settled, short_hashes, shuffle_partitions, slices, small_batches, spooled, text_buffers, word_hashes
from quirework.llm.components import components, joined

SHINGLE = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A shingle is common when one batch holds it in so many sets; so many of the most common are known to all.
COMMON, COMMON_KEPT = 4, 1 << 18
#: Shingles have 60 bits; the 4 above hold the class of common ones (the logarithm of their count), 0 for others.
_SHIFT = np.uint64(60)
_BITS = np.uint64((1 << 60) - 1)
#: One set's entries in the lists of one part; ``salts`` deal lists with very many sets.
_ENTRIES = "part int, sid long, n int, component long, hub long, own int, signature binary, tokens binary, places binary, salts binary"
#: Sets in a list up to which its entries carry no signatures, and beyond which it is dealt over parts; entries in a part.
SMALL, HOT, ENTRIES = 8, 100_000, 500_000
_PREFIX = "sid long, n int, tokens binary, places binary, signature binary"
#: log2 of the 64-cell words in a signature: about two cells for each shingle, within these bounds; and the most in a list.
_LEAST_LEVEL, _MOST_LEVEL, _LIST_LEVEL = 2, 10, 6


# ---------------------------------------------------------------- sets
def shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of every text (60 bits, with repeats), and the bounds of each text in them."""
    words, before = word_hashes(data, offs, lower=True)
    n = np.diff(before)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    bounds = np.r_[0, np.cumsum(count)]
    out = np.zeros(bounds[-1], np.uint64)
    long = n >= k
    if long.any():
        out[ragged(bounds[:-1][long], count[long])] = gram_hashes(words, k)[ragged(before[:-1][long], count[long])]
    short = np.flatnonzero((n > 0) & ~long)
    if len(short):
        out[bounds[short]] = short_hashes(words, before[short], before[short + 1])
    return out >> np.uint64(4), bounds


class Common:
    """The shingles that come last in the global order, the more frequent the later."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens = tokens[order]
        level = np.log2(np.maximum(counts[order], 1) / COMMON).astype(np.int64) + 1
        self.level = np.clip(level, 1, 15).astype(np.uint64) << _SHIFT
        self.hint = np.zeros(1 << 22, bool)
        self.hint[(self.tokens >> np.uint64(38)).astype(np.int64)] = True

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The shingles with their class."""
        maybe = np.flatnonzero(self.hint[(x >> np.uint64(38)).astype(np.int64)])
        if not len(maybe):
            return x
        at = np.minimum(np.searchsorted(self.tokens, x[maybe]), len(self.tokens) - 1)
        same = self.tokens[at] == x[maybe]
        out = x.copy()
        out[maybe[same]] |= self.level[at[same]]
        return out


def ordered_sets(data: np.ndarray, offs: np.ndarray, k: int, common: Common | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text in the global order, with the class of common ones, and bounds."""
    flat, bounds = shingles(data, offs, k)
    if common is not None and len(common.tokens):
        flat = common(flat)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        flat[a:b].sort()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    return flat[new], np.r_[0, np.cumsum(new)][bounds]


def set_ids(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, whatever the order of its shingles; 0 for empty sets."""
    sums = np.r_[np.uint64(0), np.cumsum(mix(flat & _BITS), dtype=np.uint64)]
    n = np.diff(bounds)
    return np.where(n > 0, np.maximum(mix(sums[bounds[1:]] - sums[bounds[:-1]] + n.astype(np.uint64)), 1), 0).astype(np.uint64).view(np.int64)


def _first(sid: np.ndarray) -> np.ndarray:
    """Rows with the first of each set that is not empty."""
    own, at = np.unique(sid, return_index=True)
    return np.sort(at[own != 0])


class Fresh:
    """Tells the sets that a task has not sent before, as far back as it remembers."""

    def __init__(self, most: int = 1 << 20):
        self.seen: set[int] = set()
        self.most = most

    def __call__(self, sid: np.ndarray) -> np.ndarray:
        if len(self.seen) > self.most:
            self.seen.clear()
        new = np.array([s not in self.seen for s in sid.tolist()], bool)
        self.seen.update(sid[new].tolist())
        return new


def prefix_length(n: np.ndarray) -> np.ndarray:
    """A set of n shingles shares at least one of so many first ones with any set it links to."""
    return np.where(n > 0, n - -(-n * PERCENT // 100) + 1, 0)


def overlap_needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least intersection of linked sets of n and m shingles."""
    return -(-(n + m) * PERCENT // (100 + PERCENT))


def room(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The greatest distance (shingles in one set only) of linked sets of n and m shingles."""
    return n + m - 2 * overlap_needed(n, m)


def signatures(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The parity signature of each set. The halves of one, added up, are that of the next lower level."""
    n = np.diff(bounds)
    level = np.clip(np.ceil(np.log2(np.maximum(n, 1) / 32)), _LEAST_LEVEL, _MOST_LEVEL).astype(np.int64)
    cells = 64 << level
    base = np.r_[0, np.cumsum(cells)]
    at = np.repeat(base[:-1], n) + (mix(flat & _BITS) & np.repeat(cells - 1, n).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(at, minlength=base[-1]).astype(np.uint8) & 1
    return binary_column(np.packbits(odd, bitorder="little").view(np.uint64), base // 64)


class Signatures:
    """The signatures of a column, by level, for distances of many pairs at once."""

    def __init__(self, column: pa.Array):
        flat, bounds = flat_binary(column, np.uint64)
        words = np.diff(bounds)
        self.level = np.where(words > 0, np.log2(np.maximum(words, 1)), -1).astype(np.int64)  # -1: none
        self.at = np.zeros(len(words), np.int64)
        self.rows: dict[int, np.ndarray] = {}
        for level in np.unique(self.level[words > 0]).tolist():
            own = np.flatnonzero(self.level == level)
            self.at[own] = np.arange(len(own))
            self.rows[level] = flat[bounds[own][:, None] + np.arange(1 << level)]

    def _folded(self, of: np.ndarray, level: int) -> np.ndarray:
        out = np.empty((len(of), 1 << level), np.uint64)
        for own in np.unique(self.level[of]).tolist():
            here = np.flatnonzero(self.level[of] == own)
            rows = self.rows[own][self.at[of[here]]]
            while rows.shape[1] > 1 << level:
                half = rows.shape[1] // 2
                rows = rows[:, :half] ^ rows[:, half:]
            out[here] = rows
        return out

    def capped(self, most: int) -> pa.Array:
        """The signatures folded to a level at most."""
        level = np.minimum(self.level, most)
        size = np.where(level >= 0, 1 << np.maximum(level, 0), 0)
        bounds = np.r_[0, np.cumsum(size)]
        flat = np.zeros(bounds[-1], np.uint64)
        for own in np.unique(level[level >= 0]).tolist():
            here = np.flatnonzero(level == own)
            flat[bounds[here][:, None] + np.arange(1 << own)] = self._folded(here, own)
        return binary_column(flat, bounds)

    def apart(self, a: np.ndarray, b: np.ndarray, other: Signatures | None = None) -> np.ndarray:
        """A lower bound of the distance of rows ``a`` from rows ``b`` (of ``other``)."""
        other = other or self
        out = np.zeros(len(a), np.int64)
        low = np.minimum(self.level[a], other.level[b])
        for level in np.unique(low[low >= 0]).tolist():
            here = np.flatnonzero(low == level)
            step = max(1, 1 << 20 >> level)
            for lo in range(0, len(here), step):
                part = here[lo : lo + step]
                out[part] = np.bitwise_count(self._folded(a[part], level) ^ other._folded(b[part], level)).sum(axis=1)
        return out


# ---------------------------------------------------------------- tables
def _text(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("text", F.col("doc_id").cast("long").alias("doc_id"))


def members(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, sid) of every document, and rows with doc_id null and n -count for locally common shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []

        def common() -> pa.RecordBatch:
            token, count = np.unique(np.concatenate(seen), return_counts=True)
            keep = count >= COMMON
            m = int(keep.sum())
            return pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.array(-count[keep], pa.int64()), pa.array(token[keep].view(np.int64))], ["doc_id", "n", "sid"])

        size = 0
        for batch in slices(batches, "text"):
            data, offs = text_buffers(batch.column(1))
            flat, bounds = ordered_sets(data, offs, k)
            sid, n = set_ids(flat, bounds), np.diff(bounds)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sid)], ["doc_id", "n", "sid"])
            own = _first(sid)
            seen.append(flat[ragged(bounds[own], n[own])])
            size += len(data)
            if size > 8 * (2 << 20):
                yield common()
                seen, size = [], 0
        if seen:
            yield common()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, sid long")


def with_sets(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``docs`` with the id of each row's set as ``sid`` (0 for empty sets)."""
    schema = docs.schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sid = set_ids(*ordered_sets(*text_buffers(batch.column(batch.schema.get_field_index("text"))), k))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sid)], [*batch.schema.names, "sid"])

    return docs.mapInArrow(run, f"{schema}, sid long")


def prefixes(docs: DataFrame, k: int, common, width: int) -> DataFrame:
    """_PREFIX rows: of each set the prefix shingles that may be shared, their places, and the set's signature."""
    texts = _text(docs)

    def cut(batch: pa.RecordBatch) -> tuple:
        flat, bounds = ordered_sets(*text_buffers(batch.column(0)), k, common.value)
        sid, n = set_ids(flat, bounds), np.diff(bounds)
        own = _first(sid)
        length = prefix_length(n[own])
        return sid[own], n[own], length, flat[ragged(bounds[own], length)], flat[ragged(bounds[own], n[own])]

    maps = docs.sparkSession.sparkContext.broadcast(sketch.repeated(texts, lambda b: cut(b)[3], width, lambda it: slices(it, "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = Fresh()
        for batch in slices(batches, "text"):
            sid, n, length, tokens, whole = cut(batch)
            keep = sketch.passes(tokens, maps.value, width)
            place = (np.arange(len(tokens)) - np.repeat(np.cumsum(length) - length, length)).astype(np.int32)
            bounds = np.r_[0, np.cumsum(keep)][np.r_[0, np.cumsum(length)]]
            some = np.flatnonzero((np.diff(bounds) > 0) & fresh(sid))
            out = pa.RecordBatch.from_arrays([pa.array(sid), pa.array(n, pa.int32()), binary_column(tokens[keep], bounds), binary_column(place[keep], bounds), signatures(whole, np.r_[0, np.cumsum(n)])], [c.split(" ")[0] for c in _PREFIX.split(", ")])
            yield out.take(pa.array(some))

    return texts.mapInArrow(run, _PREFIX)


def whole_sets(docs: DataFrame, k: int, wanted: DataFrame) -> DataFrame:
    """(sid, tokens) for the wanted sets (sid, least), each from its document with the least id.

    A bitmap of these pairs, bounded in size, keeps other sets and other copies from travelling."""
    key = lambda sid, doc: mix(sid.view(np.uint64) ^ mix(doc.view(np.uint64)))
    maps = docs.sparkSession.sparkContext.broadcast(sketch.members(wanted.select("sid", "least"), lambda b: key(b.column(0).to_numpy(), b.column(1).to_numpy())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = Fresh()
        for batch in slices(batches, "text"):
            flat, bounds = ordered_sets(*text_buffers(batch.column(0)), k)
            sid, n = set_ids(flat, bounds), np.diff(bounds)
            own = _first(sid)
            own = own[sketch.passes(key(sid[own], batch.column(1).to_numpy()[own]), *maps.value)]
            own = own[fresh(sid[own])]
            yield pa.RecordBatch.from_arrays([pa.array(sid[own]), binary_column(flat[ragged(bounds[own], n[own])], np.r_[0, np.cumsum(n[own])])], ["sid", "tokens"])

    return _text(docs).mapInArrow(run, "sid long, tokens binary").repartition(shuffle_partitions(docs.sparkSession), "sid").dropDuplicates(["sid"])


# ---------------------------------------------------------------- candidates
def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    tokens, bounds = flat_binary(batch.column("tokens"), np.uint64)
    places, _ = flat_binary(batch.column("places"), np.int32)
    count = np.diff(bounds)
    return tokens, np.repeat(batch.column("sid").to_numpy(), count), np.repeat(batch.column("n").to_numpy(), count), places.astype(np.int64), count


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _hubs(key: np.ndarray, sid: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heads of the lists in (key, odd share, sid) order, and the pairs of hubs with others whose sizes can match.

    ``n`` holds the size in its low 32 bits and the odd share above. The hub is the set with the least odd
    share: in a group of near copies that is the text that the others were made from, and all link to it."""
    order = np.lexsort((sid, n >> 32, key))
    k, s, m = key[order], sid[order], n[order] & 0xFFFFFFFF
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    near = (s != s[head]) & (100 * np.minimum(m, m[head]) >= PERCENT * np.maximum(m, m[head]))
    return order[new], s[head[near]], s[near]


def hub_pairs(prefix: DataFrame) -> DataFrame:
    """(a, b): every set with the first set of each of its lists and size bands."""
    parts = shuffle_partitions(prefix.sparkSession)
    kinds = "part int, keys binary, sids binary, sizes binary"

    def row(part: np.ndarray, key: np.ndarray, sid: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(part, kind="stable")
        own, heads = np.unique(part[order], return_index=True)
        bounds = np.r_[heads, len(order)]
        return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), binary_column(key[order], bounds), binary_column(sid[order], bounds), binary_column(n[order].astype(np.int64), bounds)], ["part", "keys", "sids", "sizes"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, sid, n, _, count = _flat(batch)
            if not len(tokens):
                continue
            band = np.floor(np.log(n) / np.log(100 / PERCENT)).astype(np.uint64)
            # the share of a set's prefix that no other set holds, in thousandths
            odd = 1000 - 1000 * np.repeat(count, count) // prefix_length(n.astype(np.int64))
            n = n.astype(np.int64) | odd << 32
            key = mix(tokens + band * np.uint64(0x9E3779B97F4A7C15))
            heads, a, b = _hubs(key, sid, n)
            yield row((key[heads] % np.uint64(parts)).astype(np.int64), key[heads], sid[heads], n[heads])
            pairs = _pairs(a, b)
            a, b = pairs.column(0).to_numpy(), pairs.column(1).to_numpy()
            # pairs found already: key 0 and the two ids one after the other
            if len(a):
                spot = (mix(b.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
                yield row(np.repeat(spot, 2), np.zeros(2 * len(a), np.uint64), np.stack([a, b], axis=1).ravel(), np.zeros(2 * len(a), np.int64))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            key, _ = flat_binary(batch.column("keys"), np.uint64)
            sid, _ = flat_binary(batch.column("sids"), np.int64)
            n, _ = flat_binary(batch.column("sizes"), np.int64)
            known = sid[key == 0].reshape(-1, 2)
            if len(known):
                yield _pairs(known[:, 0], known[:, 1])
            held.append((key[key != 0], sid[key != 0], n[key != 0]))
        if held:
            yield _pairs(*_hubs(*(np.concatenate(x) for x in zip(*held, strict=True)))[1:])

    sent = prefix.select("sid", "n", "tokens", "places").mapInArrow(local, kinds)
    return sent.repartition(parts, "part").mapInArrow(meet, "a long, b long").distinct()


def cross_pairs(prefix: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): the pairs of sets in different components that some list leaves possible.

    ``known`` has node, component, hub and own (the distance from the hub) of every set with a link."""
    spark = prefix.sparkSession
    parts = shuffle_partitions(spark)
    rows = prefix.join(known.withColumnRenamed("node", "sid").hint("merge"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    rows = spooled(rows.select("sid", "n", "tokens", "places", "signature", "component", F.coalesce("hub", F.lit(0)).alias("hub"), F.coalesce("own", F.lit(0)).alias("own")), "rows")
    # lists whose sets lie in one component are skipped: the largest component of each list, per batch first
    kinds = "part int, keys binary, tops binary, counts binary"

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, _, _, _, count = _flat(batch)
            if not len(tokens):
                continue
            own = np.repeat(batch.column("component").to_numpy(), count)
            key, top, most, total = _tops(tokens, own, np.ones(len(own), np.int64), np.ones(len(own), np.int64))
            part = (mix(key) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            at, heads = np.unique(part[order], return_index=True)
            bounds = np.r_[heads, len(order)]
            counts = np.stack([most, total], axis=1).astype(np.uint32).view(np.uint64).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(binary_column(x[order], bounds) for x in (key, top, counts))], ["part", "keys", "tops", "counts"])

    def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[flat_binary(batch.column(c), k)[0] for c, k in (("keys", np.uint64), ("tops", np.int64), ("counts", np.uint64))] for batch in batches]
        if held:
            key, top, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            counts = counts.view(np.uint32).reshape(-1, 2).astype(np.int64)
            key, top, most, total = _tops(key, top, counts[:, 0], counts[:, 1])
            keep = most < total
            yield pa.RecordBatch.from_arrays([pa.array(key[keep].view(np.int64)), pa.array(total[keep]), pa.array(top[keep])], ["token", "sets", "major"])

    tokens = settled(rows.select("sid", "n", "tokens", "places", "component").mapInArrow(spans, kinds).repartition(parts, "part").mapInArrow(live, "token long, sets long, major long"))
    # bitmaps of the lists that are left and of those that are not small, bounded in size, keep what is not needed from travelling
    maps = [sketch.members(tokens.where(F.col("sets") > least).select("token"), lambda b: mix(b.column(0).to_numpy().view(np.uint64))) for least in (1, SMALL)]
    kept = spark.sparkContext.broadcast(maps)

    total, most = tokens.agg(F.sum("sets"), F.max("sets")).first()
    dealt = max(parts, -(-(total or 0) // ENTRIES))
    # lists that are dealt over parts: so many at most as all entries by ``HOT``
    hot = tokens.where(F.col("sets") > HOT).orderBy("token").toArrow() if (most or 0) > HOT else None
    split = spark.sparkContext.broadcast(None if hot is None else (hot.column("token").to_numpy(), hot.column("major").to_numpy(), -(-hot.column("sets").to_numpy() // HOT)))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, sid, _, place, count = _flat(batch)
            of = np.repeat(np.arange(batch.num_rows), count)
            wanted, signed = (sketch.passes(mix(t), *m) for m in kept.value)
            t, of, place, sid, signed = t[wanted], of[wanted], place[wanted], sid[wanted], signed[wanted]
            salt = np.zeros(len(t), np.int64)
            if split.value is not None:
                again, salt = _salted(t.view(np.int64), sid, batch.column("component").to_numpy()[of], *split.value)
                t, of, place, signed = t[again], of[again], place[again], signed[again]
            part = ((mix(t) + salt.astype(np.uint64)) % np.uint64(dealt)).astype(np.int64)
            small = Signatures(batch.column("signature")).capped(_LIST_LEVEL)
            order = np.lexsort((part, of))
            t, of, place, signed, salt, part = (x[order] for x in (t, of, place, signed, salt, part))
            heads = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (part[1:] != part[:-1])]) if len(t) else np.zeros(0, np.int64)
            bounds = np.r_[heads, len(t)]
            bare = ~np.logical_or.reduceat(signed, heads) if len(t) else np.zeros(0, bool)
            for lo in range(0, len(heads), 1 << 13):
                hi = min(lo + (1 << 13), len(heads))
                at, cut = of[heads[lo:hi]], bounds[lo : hi + 1]
                own = [batch.column(c).take(pa.array(at)) for c in ("sid", "n", "component", "hub", "own")]
                signature = small.take(pa.array(at, mask=bare[lo:hi]))
                yield pa.RecordBatch.from_arrays([pa.array(part[heads[lo:hi]], pa.int32()), *own, signature, *(binary_column(x, cut) for x in (t, place.astype(np.int32), salt.astype(np.int32)))], [c.split(" ")[0] for c in _ENTRIES.split(", ")])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            pairs: list[np.ndarray] = []
            size = 0
            for found in possible(table, split.value):  # a pair that many lists hold leaves the task once
                pairs.append(found)
                size += len(found)
                if size > 1 << 20:
                    pairs = [np.unique(np.concatenate(pairs), axis=0)]
                    if (size := len(pairs[0])) > 1 << 19:
                        yield _both(pairs[0])
                        pairs, size = [], 0
            if pairs:
                yield _both(np.unique(np.concatenate(pairs), axis=0))

    return rows.mapInArrow(entries, _ENTRIES).repartition(dealt, "part").mapInArrow(meet, "a long, b long").distinct()


def _both(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _salted(token: np.ndarray, sid: np.ndarray, component: np.ndarray, hot: np.ndarray, major: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, salts): an entry of a hot list goes to one part of the list if its set is of the list's largest component, else to all."""
    at = np.minimum(np.searchsorted(hot, token), len(hot) - 1)
    is_hot = hot[at] == token
    alone = is_hot & (component == major[at])
    times = np.where(is_hot & ~alone, parts[at], 1)
    again = np.repeat(np.arange(len(token)), times)
    salt = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
    return again, np.where(alone[again], (mix(sid[again].view(np.uint64)) % parts[at[again]].astype(np.uint64)).astype(np.int64), salt)


def possible(table: pa.Table, split: tuple | None = None, most: int = 1 << 18) -> Iterator[np.ndarray]:
    """Pairs of sets whose entries (rows of ``_ENTRIES``) meet in a list and whose sizes, places, components, hubs and signatures allow a link."""
    flat, bounds = flat_binary(table.column("tokens"), np.uint64)
    if not len(flat):
        return
    row = np.repeat(np.arange(table.num_rows), np.diff(bounds))
    place, salt = (flat_binary(table.column(c), np.int32)[0].astype(np.int64) for c in ("places", "salts"))
    sizes = table.column("n").to_numpy().astype(np.int64)
    order = np.lexsort((place, sizes[row], salt, flat))
    token, row, place, salt = flat[order].view(np.int64), row[order], place[order], salt[order]
    sid, n, own, hub, lead = (table.column(c).to_numpy().astype(np.int64)[row] for c in ("sid", "n", "component", "hub", "own"))
    signed = Signatures(table.column("signature").combine_chunks())
    lists = np.cumsum(np.r_[False, (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])])
    one = np.ones(len(own), np.int64)
    _, top, _, _ = _tops(lists, own, one, one)
    major, parts = top[lists], one
    if split is not None:
        at = np.minimum(np.searchsorted(split[0], token), len(split[0]) - 1)
        same = split[0][at] == token
        major, parts = np.where(same, split[1][at], major), np.where(same, split[2][at], 1)
    minor = own != major
    # where the hub of each entry stands in the same list, or -1
    order = np.lexsort((sid, lists))
    _, rank = np.unique(np.r_[sid, hub], return_inverse=True)
    span = int(rank.max()) + 1
    keys = lists[order] * span + rank[: len(sid)][order]
    wanted = lists * span + rank[len(sid) :]
    spot = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    leader = np.where((keys[spot] == wanted) & (hub != 0), order[spot], -1)
    every = np.arange(len(sid))
    for x, y in ((every[minor], every), (every[~minor], every[minor])):
        for a, b in _windows(lists, n, place, x, y, most):
            keep = (own[a] != own[b]) & (sid[a] != sid[b])
            # sets that every part of a list has meet in one of them
            keep &= ~(minor[a] & minor[b]) | ((sid[a] ^ sid[b]) % parts[a] == salt[a])
            a, b = a[keep], b[keep]
            allowed = room(n[a], n[b])
            for p, q in ((a, b), (b, a)):  # the answer of p is derived from that of its hub
                some = np.flatnonzero(leader[p] >= 0)
                pair, back = np.unique(leader[p[some]] * len(sid) + q[some], return_inverse=True)
                bound = signed.apart(row[pair // len(sid)], row[pair % len(sid)])[back] - lead[p[some]]
                allowed[some[bound > allowed[some]]] = -1
            keep = np.flatnonzero(allowed >= 0)
            keep = keep[signed.apart(row[a[keep]], row[b[keep]]) <= allowed[keep]]
            found = np.stack([np.minimum(sid[a[keep]], sid[b[keep]]), np.maximum(sid[a[keep]], sid[b[keep]])], axis=1)
            yield np.unique(found, axis=0)


def _tops(key: np.ndarray, own: np.ndarray, most: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each key (ascending) the component with the greatest sum of ``most``, that sum, and the sum of ``total``."""
    if not len(key):
        return key, own, most, total
    order = np.lexsort((own, key))
    k, c, n, t = key[order], own[order], most[order], total[order]
    head = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])])
    k, c, n, t = k[head], c[head], np.add.reduceat(n, head), np.add.reduceat(t, head)
    best = np.lexsort((n, k))
    last = best[np.flatnonzero(np.r_[k[1:] != k[:-1], True])]
    return k[last], c[last], n[last], np.add.reduceat(t, np.flatnonzero(np.r_[True, k[1:] != k[:-1]]))


def _windows(lists: np.ndarray, n: np.ndarray, place: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries ``x`` and ``y`` (both ascending) of one list where y is no larger and sizes and places allow a link.

    A block is the entries of one list and size. A block as a whole is skipped for an entry if its size
    is too small or the entry stands too far back; of a block that is not, only the entries up to the
    last useful place are read."""
    if not len(x) or not len(y):
        return
    l, m, at = lists[y], n[y], place[y]
    new = np.r_[True, (l[1:] != l[:-1]) | (m[1:] != m[:-1])]
    head, block = np.flatnonzero(new), np.cumsum(new) - 1
    size, end = m[head], np.r_[head[1:], len(y)]
    span, wide = int(n.max()) + 1, int(place.max()) + 2
    keys = l[head] * span + size
    low = np.searchsorted(keys, lists[x] * span + -(-n[x] * PERCENT // 100))
    count = np.maximum(np.searchsorted(keys, lists[x] * span + n[x], "right") - low, 0)
    for lo, hi in _rooms(count, most):
        a, b = np.repeat(x[lo:hi], count[lo:hi]), ragged(low[lo:hi], count[lo:hi])
        need = overlap_needed(n[a], size[b])
        reach = size[b] - need
        ok = (place[a] <= n[a] - need) & (reach >= at[head[b]])
        a, b, reach = a[ok], b[ok], reach[ok]
        stop = np.minimum(np.searchsorted(block * wide + at, b * wide + np.minimum(reach, wide - 2), "right"), end[b])
        each = np.maximum(stop - head[b], 0)
        for p, q in _rooms(each, most):
            yield np.repeat(a[p:q], each[p:q]), y[ragged(head[b[p:q]], each[p:q])]


def _rooms(count: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose counts sum to about ``most``."""
    total = np.cumsum(count)
    lo = 0
    while lo < len(count):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


# ---------------------------------------------------------------- answers
def bounded(pairs: DataFrame, prefix: DataFrame) -> DataFrame:
    """(a, b) of the pairs that the signatures of both leave possible."""
    own = prefix.select("sid", F.col("n").cast("long").alias("n"), "signature")
    # both sides look alike, so that one exchange of the signatures serves both
    left = own.select(F.col("sid").alias("a"), F.col("n").alias("n"), F.col("signature").alias("x"))
    right = own.select(F.col("sid").alias("b"), F.col("n").alias("m"), F.col("signature").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.arange(batch.num_rows)
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            near = Signatures(batch.column("x")).apart(at, at, Signatures(batch.column("y"))) <= room(n, m)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(near)) for c in ("a", "b")], ["a", "b"])

    # merged at every size, as they must be at the large ones
    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "n", "m", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


def _open():
    """Pairs that link by their distance ``apart``."""
    total = F.col("n") + F.col("m")
    need = F.ceil(total * PERCENT / (100 + PERCENT) - 1e-9)
    return F.col("apart") <= total - 2 * need


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n, m, apart) with the true distance, from the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                both = [flat_binary(part.column(c), np.uint64) for c in ("ta", "tb")]
                tokens = np.concatenate([x for x, _ in both])
                of = np.concatenate([np.repeat(np.arange(part.num_rows), np.diff(b)) for _, b in both])
                order = np.lexsort((tokens, of))
                t, r = tokens[order], of[order]
                shared = np.bincount(r[1:][(t[1:] == t[:-1]) & (r[1:] == r[:-1])], minlength=part.num_rows)
                n, m = (np.diff(b) for _, b in both)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(n, pa.int32()), pa.array(m, pa.int32()), pa.array(n + m - 2 * shared, pa.int32())], ["a", "b", "n", "m", "apart"])

    left, right = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("ta")), sets.select(F.col("sid").alias("b"), F.col("tokens").alias("tb"))
    return pairs.select("a", "b").join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, n int, m int, apart int")


def _ids(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets of the pairs, with the least doc_id of each."""
    return pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct().join(sets.select("sid", "least"), "sid")


def linked(docs: DataFrame, k: int = SHINGLE, named_sets: bool = False) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``; with ``named_sets`` also sid and component, which tell sets that share a doc_id apart."""
    spark = docs.sparkSession
    small_batches(spark)
    table = spooled(members(docs.select("doc_id", "text"), k), "members")
    counted = table.where("n < 0").groupBy(F.col("sid").alias("token")).agg(F.sum("n").alias("n")).orderBy("n", "token").limit(COMMON_KEPT).toArrow()  # a bounded list, for the order alone
    common = spark.sparkContext.broadcast(Common(counted.column("token").to_numpy().view(np.uint64), -counted.column("n").to_numpy()))
    table = table.where("n >= 0")
    sets = spooled(table.where("n > 0 AND doc_id IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("least"), F.max("n").alias("n")), "sets")
    shared = sets.agg(F.sum("n")).first()[0] or 0
    prefix = spooled(prefixes(docs, k, common, sketch.width_for(shared * (100 - PERCENT) / 100)).dropDuplicates(["sid"]), "prefix")

    open_1 = settled(bounded(hub_pairs(prefix), prefix))
    known = spooled(compared(open_1, whole_sets(docs, k, settled(_ids(open_1, sets)))), "compared")
    links = known.where(_open())
    component = spooled(components(links), "component")

    # the nearest set that each set is linked with, and the distance from it
    near = links.select("a", "b", "apart")
    near = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
    hub = near.groupBy(F.col("a").alias("node")).agg(F.min_by("b", F.struct("apart", "b")).alias("hub"), F.min("apart").alias("own"))
    cross = cross_pairs(prefix, spooled(component.join(hub, "node"), "hubs"))
    cross = spooled(cross.join(known.select("a", "b"), ["a", "b"], "left_anti"), "cross")
    second = settled(bounded(cross, prefix))
    if not second.isEmpty():
        more = compared(second, whole_sets(docs, k, settled(_ids(second, sets)))).where(_open()).select("a", "b")
        component = spooled(joined(component, more), "component")

    named = sets.join(component.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "least", F.coalesce("component", "sid").alias("component"))
    least = spooled(named.groupBy("component").agg(F.min("least").alias("component_id")), "ids")
    named = spooled(named.join(least, "component").select("sid", "component_id", *(["component"] if named_sets else [])), "named")
    out = table.join(named, "sid", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), *(["sid", "component"] if named_sets else []))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
  ELSE list_distinct([array_to_string(w[i:i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(w) - {SHINGLE - 2})]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= {PERCENT} * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a, min(b) AS least FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.least, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
"""
