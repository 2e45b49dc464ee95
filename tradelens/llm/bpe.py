"""Byte-level BPE encoding and decoding by monoid tree reduction.

A piece of text is encoded by halves, recursively; two neighbours are joined by
encoding anew a window around their boundary.  The window grows until its
outer tokens are stable: a token sequence is the encoding of its bytes if and
only if each two adjacent tokens are the encoding of their own bytes, so
checking the two seams of the window proves the join.  Decoding gathers the
token bytes of many texts side by side, so that joins up the tree move no bytes.

Matches of the pattern are encoded separately.  They never cross from a
non-space character to white space, so runs of white space with the word that
follows are the leaves that a worker keeps.

Defined cases: null text is empty, with no ids; a text without any match
cannot occur (the pattern covers all characters); repeated rows are encoded
each; an empty table gives an empty result; further columns stay out.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm import scan

#: Bytes up to which a part is encoded directly.
LEAF = 4
#: Leaves kept per worker, after which the table starts anew.
CACHE = 300_000
#: Unicode White_Space, as the tokenizers' regular expressions take it. Fixed values.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Codec:
    """Encodes and decodes by a table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF):
        self.ranks, self.leaf = ranks, leaf
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.tokens = pa.array([self.bytes_of.get(i) for i in range(max(self.bytes_of, default=-1) + 1)], pa.large_binary())
        self.pieces = regex.compile(pattern)
        self.chunks = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        self.other = re.compile(f"[{SPACE.replace(' ', '')}\x00]".replace("\t-\r", "\t\x0b-\r"))
        self.pairs: dict[tuple[int, int], tuple[int, ...] | None] = {}
        self.parts: dict[bytes, tuple[int, ...]] = {}
        # leaves and matches are kept in two generations, so frequent ones stay
        self.known_pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, data: bytes) -> tuple[int, ...]:
        """Encoding of a short part, kept: syllables come again in other words."""
        got = self.parts.get(data)
        return self._keep(data, self._merge(data)) if got is None else got

    def _keep(self, data: bytes, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(data) <= 16:
            if len(self.parts) > CACHE:
                self.parts.clear()
            self.parts[data] = ids
        return ids

    def _merge(self, data: bytes) -> tuple[int, ...]:
        """Merge the adjacent pair of lowest rank, the first of equals, while there is one."""
        get, never = self.ranks.get, 1 << 60
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = [get(data[i:i + 2], never) for i in range(len(data) - 1)]  # of each part with the next
        while rank:
            best = min(rank)
            if best == never:
                break
            i = rank.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del rank[i]
            if i:
                rank[i - 1] = get(parts[i - 1] + parts[i], never)
            if i < len(rank):
                rank[i] = get(parts[i] + parts[i + 1], never)
        return tuple([self.ranks[p] for p in parts])

    def pair(self, a: int, b: int) -> tuple[int, ...] | None:
        """Encoding of the bytes of two tokens, kept; None if that is the two themselves."""
        try:
            return self.pairs[a, b]
        except KeyError:
            got = self.merged(self.bytes_of[a] + self.bytes_of[b])
            if len(self.pairs) > CACHE:
                self.pairs.clear()
            got = self.pairs[a, b] = None if got == (a, b) else got
            return got

    def fits(self, a: int, b: int) -> bool:
        """Whether two tokens next to each other are the encoding of their bytes."""
        return self.pair(a, b) is None

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        if not left or not right:
            return left or right
        new = self.pair(left[-1], right[0])
        if new is None:
            return left + right
        i = j = 1
        while True:
            grow_left = i < len(left) and not self.fits(left[-i - 1], new[0])
            grow_right = j < len(right) and not self.fits(new[-1], right[j])
            if not grow_left and not grow_right:
                return left[:-i] + new + right[j:]
            i, j = min(len(left), i + grow_left), min(len(right), j + grow_right)
            window = left[-i:] + right[:j]
            new = self.merged(b"".join([self.bytes_of[t] for t in window]))

    def half(self, data: bytes) -> tuple[int, ...]:
        """Encoding of a part of a match; short ones are kept, as halves come again in other words."""
        if len(data) <= self.leaf:
            return self.merged(data)
        got = self.parts.get(data)
        if got is None:
            got = self._keep(data, self.tree(data))
        return got

    def tree(self, data: bytes) -> tuple[int, ...]:
        """Encoding of one match: halves recursively, joined; no deeper than log2 of its length."""
        if len(data) <= self.leaf:
            return self.merged(data)
        half = len(data) // 2
        return self.join(self.half(data[:half]), self.half(data[half:]))

    def match(self, piece: str) -> bytes:
        """ids of one match of the pattern."""
        got = self.known_pieces.get(piece)
        if got is None:
            got = self.older_pieces.get(piece)
            if got is None:
                data = piece.encode()
                rank = self.ranks.get(data)
                got = array("i", (rank,) if rank is not None else self.tree(data)).tobytes()
            if len(piece) <= 100:  # long ones hardly come again
                if len(self.known_pieces) > CACHE:
                    self.older_pieces, self.known_pieces = self.known_pieces, {}
                self.known_pieces[piece] = got
        return got

    def chunk(self, c: str) -> bytes:
        """ids of white space and the word that follows it."""
        got = self.known.get(c)
        if got is None:
            got = self.older.get(c)
            if got is None:
                got = b"".join([self.match(p) for p in self.pieces.findall(c)])
            if len(c) <= 100:
                self.known[c] = got
        return got

    def encode_bytes(self, text: str) -> bytes:
        """ids of a text as little-endian 32-bit integers."""
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        if "  " in text or "\n " in text or " \n" in text or "\n\n" in text or self.other.search(text):
            return b"".join([self.chunk(c) for c in self.chunks.findall(text)])
        # single spaces and line breaks only: every one of them begins a leaf
        known, chunk = self.known, self.chunk
        lines = text.replace("\n", "\x00\n").replace(" ", "\x00 ").split("\x00")
        return b"".join([known.get(c) or chunk(c) for c in lines])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def decode_lists(self, ids: pa.ListArray) -> pa.Array:
        """Bytes of every list of ids; a null list stays null.

        The tokens are gathered into one buffer, where neighbours lie side by
        side: joining two parts moves no bytes, and the root of a list's tree is
        the span from its first token to its last.
        """
        cut = ids.offsets.to_numpy()
        tokens = self.tokens.take(ids.values.slice(cut[0], cut[-1] - cut[0]))
        if tokens.null_count:
            raise KeyError("an id that is null or has no token")
        data, off = scan.string_bytes(tokens)
        spans = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(off[cut - cut[0]]), pa.py_buffer(data)])
        return pc.if_else(ids.is_valid(), spans, None).cast(pa.binary())

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_lists(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


_CODECS: dict[tuple[str, str], Codec] = {}


def _codec(name: str, ranks, pattern: str) -> Codec:
    """The codec of this worker: tasks that follow use what earlier ones have kept."""
    got = _CODECS.get((name, pattern))
    if got is None:
        got = _CODECS[(name, pattern)] = Codec(ranks.value, pattern)
    return got


def encode(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int) of every text."""
    raw = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_file))  # the vocabulary: about 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_file, raw, pattern)
        for b in (p for batch in batches for p in scan.slices(batch)):
            got = [codec.encode_bytes(t) for t in b.column("text").to_pylist()]
            off = np.concatenate([[0], np.cumsum([len(x) // 4 for x in got])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(off), pa.array(np.frombuffer(b"".join(got), "<i4")))
            yield pa.record_batch([b.column("doc_id"), ids], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_file: str) -> DataFrame:
    """doc_id, ids, decoded (binary) of every row of ids."""
    raw = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_file, raw, "")
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                b = batch.slice(at, 100)
                yield pa.record_batch([b.column("doc_id"), b.column("ids"), codec.decode_lists(b.column("ids"))],
                                      names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """The digest: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    text_ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode(encode(docs, ranks_file, pattern), ranks_file).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(text_ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
