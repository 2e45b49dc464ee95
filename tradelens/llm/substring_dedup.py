"""Substring dedup: remove words that lie in a 35-word window found elsewhere.

Method: compressed FM-indexes.  Contexts of repeated word anchors (repeats.py),
as their words and not as hashes, are gathered into shards of bounded size; a shard's Burrows-Wheeler transform
is held in a wavelet tree of packed bits.  The contexts then stream through
it: backward search from every window end extends its match leftwards while
it occurs at least twice, which gives the matching statistics up to the
window; intervals that reach the threshold are reported.

Defined cases: null text has no words; documents shorter than the window lose
nothing; repeated rows and equal texts are repeats of each other; an empty
table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm import repeats, scan
from tradelens.llm.frames import distinct_texts, text_key

WINDOW = 35
ANCHOR = 12
#: Words of contexts that one FM-index holds (a larger group is an index of its own).
SHARD_WORDS = 300_000


class WaveletTree:
    """Rank over a sequence of small integers, level-wise, in packed bits (a wavelet matrix)."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(np.uint8)
            packed = np.packbits(np.concatenate([bit, np.zeros(64 - len(bit) % 64, np.uint8)]), bitorder="little").view(np.uint64)
            ones = np.zeros(len(packed) + 1, np.int32)
            np.cumsum(np.bitwise_count(packed), out=ones[1:])
            self.words.append(packed)
            self.before.append(ones)
            self.zeros.append(int(len(bit) - ones[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self.origin = np.zeros(sigma, np.int64)
        self.origin = self._descend(np.arange(sigma), np.zeros(sigma, np.int64))

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for i in range(self.levels):
            block, inner = place >> 6, (place & 63).astype(np.uint64)
            ones = self.before[i][block] + np.bitwise_count(
                self.words[i][block] & ((np.uint64(1) << inner) - np.uint64(1)))
            place = np.where((symbol >> (self.levels - 1 - i)) & 1, self.zeros[i] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbol, place) - self.origin[symbol]


class FMIndex:
    """FM-index of a sequence whose symbol 0 separates contexts.

    Suffixes are ordered to ``depth`` symbols, enough for patterns below it.
    """

    def __init__(self, seq: np.ndarray, sigma: int, depth: int):
        n = len(seq)
        rank, size = seq.astype(np.int64), 1
        while size < min(depth, n):
            nxt = np.zeros(n, np.int64)
            nxt[:n - size] = rank[size:] + 1
            _, rank = np.unique(rank * (n + sigma + 2) + nxt, return_inverse=True)
            size *= 2
        order = np.argsort(rank, kind="stable")
        self.first = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(seq, minlength=sigma), out=self.first[1:])
        self.tree = WaveletTree(seq[order - 1], sigma)

    def matched(self, seq: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
        """Longest match, up to ``most``, that ends before each place and occurs twice or more."""
        length = np.zeros(len(ends), np.int64)
        alive = np.arange(len(ends))
        symbol = seq[ends - 1]
        lo, hi = self.first[symbol], self.first[symbol + 1]
        for step in range(1, most + 1):
            more = (hi - lo >= 2) & (symbol > 0)
            alive, lo, hi = alive[more], lo[more], hi[more]
            length[alive] = step
            if step == most or not len(alive):
                break
            symbol = seq[ends[alive] - 1 - step]
            both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
            lo, hi = self.first[symbol] + both[:len(lo)], self.first[symbol] + both[len(lo):]
        return length


class FMIndexJudge:
    """Collects groups into shards, indexes each shard and streams its contexts through the index."""

    def __init__(self, sym: repeats.Symbols, shard_words: int = SHARD_WORDS):
        self.sym, self.limit = sym, shard_words
        self.held: list[repeats.Context] = []
        self.words = 0

    def group(self, held: list[repeats.Context], spans: repeats.Spans) -> None:
        if len(held) < 2 or all(c.n > 1 for c in held):
            return
        size = sum(self.sym.length(c.ctx) for c in held)
        if self.held and self.words + size > self.limit:
            self.close(spans)
        self.held += held
        self.words += size

    def close(self, spans: repeats.Spans) -> None:
        if not self.held:
            return
        window = self.sym.window
        sizes = np.array([self.sym.length(c.ctx) for c in self.held])
        data = np.frombuffer(b" ".join(c.ctx for c in self.held), np.uint8)
        starts, word_ends, _ = scan.words(data, np.array([0, len(data)]))
        words = scan.word_dictionary(data, starts, word_ends)  # symbols are told apart by their bytes
        ids = words.indices.to_numpy().astype(np.int64)
        at = np.concatenate([[0], np.cumsum(sizes + 1)])  # one separator after each context
        seq = np.zeros(at[-1], np.int64)
        own = np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)
        seq[own] = ids + 1
        index = FMIndex(seq, len(words.dictionary) + 1, window)
        once = [i for i, c in enumerate(self.held) if c.n == 1]
        ends = np.concatenate([np.arange(at[i] + window, at[i] + sizes[i] + 1) for i in once])
        owner = np.repeat(once, sizes[once] - window + 1)
        full = np.flatnonzero(index.matched(seq, ends, window) >= window)
        for i, end in zip(owner[full].tolist(), ends[full].tolist()):
            c = self.held[i]
            key, pos = c.occ[0]
            start = pos - c.off + end - window - int(at[i])
            spans.add(key, start, start + window)
        self.held, self.words = [], 0


def symbols(window: int = WINDOW, k: int = ANCHOR) -> repeats.Symbols:
    return repeats.Symbols(repeats.read_words, repeats.count_words, window, k)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (p for batch in batches for p in scan.slices(batch)):
        data, off = scan.string_bytes(b.column("text"))
        starts, ends, by_doc = scan.words(data, off)
        raw = data.tobytes()
        keep = np.ones(len(starts) + 1, bool)
        n_removed = np.zeros(b.num_rows, np.int64)
        for i, (s, e) in enumerate(zip(b.column("starts").to_pylist(), b.column("ends").to_pylist())):
            for x, y in repeats.covered(s or [], e or []):
                keep[by_doc[i] + x:by_doc[i] + y] = False
                n_removed[i] += y - x
        kept = []
        for i in range(b.num_rows):
            own = np.flatnonzero(keep[by_doc[i]:by_doc[i + 1]]) + by_doc[i]
            kept.append(b" ".join([raw[x:y] for x, y in zip(starts[own].tolist(), ends[own].tolist())]).decode())
        yield pa.record_batch([b.column("key"), pa.array(np.diff(by_doc).astype(np.int64)), pa.array(n_removed),
                               pa.array(kept, pa.string())], names=["key", "n_words", "n_removed", "kept"])


def remove_repeated_words(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, hot: int = repeats.HOT) -> DataFrame:
    """One row per distinct text: key, n_words, n_removed, kept (kept words joined by one space)."""
    texts = distinct_texts(docs)
    spans = repeats.repeated_spans(texts, symbols(window, k), FMIndexJudge, hot)
    return repeats.with_spans(texts, spans).mapInArrow(
        _cut, "key binary, n_words long, n_removed long, kept string")


def substring_dedup(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, hot: int = repeats.HOT) -> DataFrame:
    """The digest per document: doc_id, n_words, n_removed, kept_sha256."""
    cut = remove_repeated_words(docs, window, k, hot).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    return (docs.select("doc_id", text_key(F.col("text")).alias("key")).join(cut, "key")
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))
