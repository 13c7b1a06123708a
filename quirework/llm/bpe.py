"""BPE encoding and decoding by batched numpy merge rounds.

A word's ids depend on the word alone, so each worker encodes the words that it has not met yet
together: all their symbols lie in one flat array, the lowest-ranked pair of every word is found by
binary search over sorted pair keys, and one round merges it in all words at once. Words met before
come from a bounded table.

Null and empty texts have no tokens; the markers of the vocabulary's added tokens in a text become
those tokens, as the tokenizers library has it; a very long text is encoded as a whole; repeated rows are
encoded each; columns named ids and decoded are replaced, others stay; an empty table has an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from quirework.llm._common import ragged, slices, small_batches

#: Words kept between batches; the table is emptied when it is full.
KNOWN_WORDS = 250_000

# White space as the tokenizer's own \s has it, and its word pattern.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")  # the same over ASCII
# The same over the first 256 characters, whose classes are spelt out for the faster engine.
_LATIN = {kind: "".join(chr(i) for i in range(128, 256) if unicodedata.category(chr(i))[0] == kind) for kind in "LN"}
_LATIN_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z{_LATIN['L']}]+|[0-9{_LATIN['N']}]|[^\t-\r \x85\xa0A-Za-z0-9{_LATIN['L']}{_LATIN['N']}]+")
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + _SPACE + r"\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class MergeTable:
    """A vocabulary's merges as arrays, and the batched rounds that apply them."""

    def __init__(self, spec: str):
        loaded = json.loads(spec)
        model = loaded["model"]
        vocab, merges = model["vocab"], model["merges"]
        end = model["end_of_word_suffix"] or ""
        self.text = {i: t for t, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        self.text |= {i: t for t, i in self.added.items()}
        symbols = byte_symbols()
        self.byte_id = np.array([vocab.get(s, -1) for s in symbols], np.int64)
        self.last_id = np.array([vocab.get(s + end, -1) for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.size = max(self.text) + 1
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order, made

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (UTF-8 bytes, none empty) one after another, and how many each has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        ids = self.byte_id[data]
        ends = np.cumsum(lengths)
        ids[ends - 1] = self.last_id[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        done_word, done_ids = [], []
        none = len(self.rank)
        while len(ids):
            keys = ids[:-1] * self.size + ids[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), none - 1)
            rank = np.full(len(ids), none, np.int64)
            rank[:-1] = np.where((self.keys[at] == keys) & (word[:-1] == word[1:]), self.rank[at], none)
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            mine = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.r_[heads, len(ids)]))
            live = mine < none
            if not live.all():
                done_word.append(word[~live])
                done_ids.append(ids[~live])
                ids, word, rank, mine = ids[live], word[live], rank[live], mine[live]
                if not len(ids):
                    break
            hit = rank == mine
            # in a run of overlapping hits every other one merges, from the left
            where = np.arange(len(ids))
            begin = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], where, 0))
            hit &= (where - begin) % 2 == 0
            ids = np.where(hit, self.made[np.where(hit, mine, 0)], ids)
            keep = ~np.r_[False, hit[:-1]]
            ids, word = ids[keep], word[keep]
        word, ids = np.concatenate([*done_word, word]), np.concatenate([*done_ids, ids])
        return ids[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))


class Known(dict):
    """Numbers words as they come; ``new`` holds those that no one has asked for before."""

    def __init__(self, first: list[str]):
        super().__init__((w, k) for k, w in enumerate(first))
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        k = self[word] = len(self)
        return k


class Encoder:
    """Encodes lists of texts. Words keep their ids in a bounded table from one list to the next."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.split = regex.compile(_WORD)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(table.added, key=len, reverse=True)))) if table.added else None
        self._empty()

    def _empty(self) -> None:
        self.known = Known([f" {t}" for t in self.table.added])  # no word holds a space
        self.ids = [np.array([*self.table.added.values()], np.int64)]
        self.counts = [np.ones(len(self.table.added), np.int64)]

    def _find(self, text: str) -> list[str]:
        if text.isascii():
            return _ASCII_WORD.findall(text.lower())
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.split.findall(_normal(text))
        return _LATIN_WORD.findall(text.lower())  # these are in normal form already

    def words(self, text: str | None) -> list[str]:
        if not text:
            return []
        if "<" not in text or not self.marks or not self.marks.search(text):
            return self._find(text)
        out, at = [], 0
        for m in self.marks.finditer(text):
            out += self._find(text[at : m.start()])
            out.append(f" {m[0]}")
            at = m.end()
        return out + self._find(text[at:])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the bounds of each text in them."""
        cut = [self.words(t) for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self._empty()
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, int(n.sum()))
        if self.known.new:
            ids, counts = self.table.merge_words([w.encode() for w in self.known.new])
            self.ids, self.counts = [np.concatenate([*self.ids, ids])], [np.concatenate([*self.counts, counts])]
            self.known.new = []
        ids, counts = self.ids[0], self.counts[0]
        starts = np.cumsum(counts) - counts
        own = counts[at]
        before = np.concatenate([[0], np.cumsum(own)])
        return ids[ragged(starts[at], own)], before[np.concatenate([[0], np.cumsum(n)])]


def _normal(text: str) -> str:
    text = unicodedata.normalize("NFC", text)
    # each character by itself: the library knows no final sigma
    return "".join(c.lower() for c in text) if "\u03a3" in text else text.lower()


def load_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``ids`` (array of int) and ``decoded`` (string), which replace columns of those names."""
    docs = docs.drop("ids", "decoded")
    small_batches(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(vocabulary))  # a vocabulary file: a few MB
    schema = docs.schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = MergeTable(spec.value)
        coder = Encoder(table)
        for batch in slices(batches, text):
            ids, bounds = coder.encode(batch.column(text).to_pylist())
            said = [" ".join(map(table.text.__getitem__, ids[a:b].tolist())) for a, b in pairwise(bounds.tolist())]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(said, pa.string())], [*batch.schema.names, "ids", "decoded"])

    return docs.mapInArrow(run, f"{schema}, ids array<int>, decoded string")


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``rows`` with the column ``decoded``: the tokens of ``ids`` joined by spaces; unknown ids are left out."""
    rows = rows.drop("decoded")
    spec = rows.sparkSession.sparkContext.broadcast(load_spec(vocabulary))
    schema = rows.schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = MergeTable(spec.value).text
        for batch in batches:
            said = [" ".join(known[i] for i in x or () if i in known) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said, pa.string())], [*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, f"{schema}, decoded string")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids (decimal, joined by a space) and of the decoded text."""
    small_batches(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = MergeTable(spec.value)
        number = [str(i).encode() for i in range(table.size)]
        token = [table.text.get(i, "").encode() for i in range(table.size)]
        coder = Encoder(table)
        for batch in slices(batches, "text"):
            ids, bounds = coder.encode(batch.column("text").to_pylist())
            a, b = [], []
            for lo, hi in pairwise(bounds.tolist()):
                own = ids[lo:hi].tolist()
                a.append(hashlib.sha256(b" ".join(map(number.__getitem__, own))).hexdigest())
                b.append(hashlib.sha256(b" ".join(map(token.__getitem__, own))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
