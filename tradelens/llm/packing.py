"""Packing: vector bin packing of examples into sequences of at most 4096 tokens.

Method: dot-product heuristic.  An example demands (tokens, segments,
loss-bearing tokens); the open sequence has as much left of each limit.  Among
the examples of a bounded pool that fit whole, the one whose demand has the
largest dot product with what is left goes in next, each measured as a share
of the limit.  If none fits whole, the longest is cut to fill the rest, and
what remains of it goes back to the pool.  A sequence that ends below the limit
is cut into lengths that are powers of two, which need no padding.

Every task packs its own input split: no shuffle, memory bounded by the pool,
and a lost task is repeated with the same result.

Defined cases: null text is empty and gives its end token only; repeated rows
are packed each; an empty table gives an empty result; further columns are
ignored, whatever their names; a null doc_id is kept.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm import scan

END_ID = 2
#: Distinct words whose ids are kept per worker and generation.
CACHE_WORDS = 400_000
#: ASCII marks that the tokenizer never joins to a letter before them. Fixed values.
MARKS = ".,;:!?%&$#*|)"


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold, and how many examples wait to be chosen from."""

    tokens: int = 4096
    segments: int = 256
    loss: int = 4096
    pool: int = 128


@dataclass
class Example:
    """What is left of one example: ids from ``start`` on; those from ``loss_start`` bear loss."""

    doc_id: int | None
    ids: bytes
    start: int
    loss_start: int

    @property
    def total(self) -> int:
        return len(self.ids) // 4

    def loss(self, length: int) -> int:
        return max(0, self.start + length - max(self.start, self.loss_start))


class WordIds:
    """ids of a text by a tokenizer whose tokens never cross white space, kept by word.

    ASCII space and line breaks separate words here; any other white space
    stays inside a word and is left to the tokenizer.  Marks that follow a
    word's last letter are looked up apart, as the tokenizer splits there too.
    Words are kept in two generations, so frequent ones stay.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _learn(self, new: set[str]) -> None:
        """Give every word of ``new`` an entry in ``known``."""
        older, known = self.older, self.known
        split, missing = {}, {}
        for w in new:
            got = older.get(w)
            if got is not None:
                known[w] = got
                continue
            core = w.rstrip(MARKS)
            if len(core) < len(w) and core and core[-1].isalpha() and len(core[-1].lower()) == 1:
                split[w] = parts = (core, w[len(core):])
            else:
                parts = (w,)
            for x in parts:
                if x not in known:
                    got = older.get(x)
                    if got is None:
                        missing[x] = None
                    else:
                        known[x] = got
        todo = list(missing)
        plain = [w for w in todo if w.isalpha()]  # one piece each: many at a time
        for at in range(0, len(plain), 500):
            self._learn_plain(plain[at:at + 500])
        todo = [w for w in todo if w not in known]
        for at in range(0, len(todo), 1000):
            part = todo[at:at + 1000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known[w] = array("I", e.ids).tobytes()
        for w, (core, marks) in split.items():
            known[w] = known[core] + known[marks]

    def _learn_plain(self, part: list[str]) -> None:
        """Encode words as one text and divide its ids by piece."""
        e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
        ids, owner = array("I", e.ids), e.word_ids
        cuts = [0, *(i for i in range(1, len(owner)) if owner[i] != owner[i - 1]), len(owner)]
        if len(cuts) == len(part) + 1:
            for w, a, b in zip(part, cuts, cuts[1:]):
                self.known[w] = ids[a:b].tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        """ids of each text as little-endian 32-bit integers."""
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {"": b""}
        known = self.known
        new = {w for p in parts for w in p if w not in known}
        if new:
            self._learn(new)
        return [b"".join([known[w] for w in p]) for p in parts]


_ENCODERS: dict[str, WordIds] = {}


def _encoder(name: str, content) -> WordIds:
    """The encoder of this worker: tasks that follow know the words of earlier ones."""
    if name not in _ENCODERS:
        _ENCODERS[name] = WordIds(content.value)
    return _ENCODERS[name]


class Packer:
    """Fills one sequence after another from a pool of examples."""

    def __init__(self, limits: Limits, first_id: int):
        self.limits, self.next_id = limits, first_id
        self.pool: list[Example] = []
        self.need = np.zeros((limits.pool, 3))
        self.scale = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.open: list[tuple[Example, int, int]] = []  # example, start, length
        self.left = self.scale.copy()

    def add(self, example: Example) -> Iterator[tuple]:
        self.need[len(self.pool)] = self._need(example)
        self.pool.append(example)
        while len(self.pool) == self.limits.pool:
            yield from self._place()

    def finish(self) -> Iterator[tuple]:
        while self.pool:
            yield from self._place()
        yield from self._close()

    def _need(self, e: Example) -> tuple[int, int, int]:
        n = e.total - e.start
        return n, 1, e.loss(n)

    def _place(self) -> Iterator[tuple]:
        need = self.need[:len(self.pool)]
        fits = np.flatnonzero((need <= self.left).all(axis=1))
        if len(fits):
            share = (need[fits] / self.scale) @ (self.left / self.scale)
            yield from self._put(int(fits[np.argmax(share)]), None)
            return
        if self.left[1] < 1 or self.left[0] < 1:
            yield from self._close()
            return
        i = int(np.argmax(need[:, 0]))
        e = self.pool[i]
        free = max(0, e.loss_start - e.start)  # ids before the first that bears loss
        length = int(min(self.left[0], free + self.left[2], need[i, 0]))
        if length:
            yield from self._put(i, length)
        else:
            yield from self._close()

    def _put(self, i: int, length: int | None) -> Iterator[tuple]:
        e = self.pool[i]
        rest = e.total - e.start
        take = rest if length is None else length
        self.open.append((e, e.start, take))
        self.left = self.left - (take, 1, e.loss(take))
        if take < rest:
            self.pool[i] = Example(e.doc_id, e.ids, e.start + take, e.loss_start)
            self.need[i] = self._need(self.pool[i])
        else:
            last = self.pool.pop()
            if i < len(self.pool):
                self.pool[i] = last
                self.need[i] = self.need[len(self.pool)]
        if self.left[0] < 1:
            yield from self._close()

    def _close(self) -> Iterator[tuple]:
        """Hand out the open sequence: as it is when full, else in powers of two."""
        total = sum(n for _, _, n in self.open)
        pieces = self.open[::-1]
        while total:
            size = total if total == self.limits.tokens else 1 << (total.bit_length() - 1)
            offset = 0
            while offset < size:
                e, start, n = pieces.pop()
                take = min(n, size - offset)
                if take < n:
                    pieces.append((e, start + take, n - take))
                part = e.ids[4 * start:4 * (start + take)]
                yield e.doc_id, start, take, zlib.crc32(part), e.total, self.next_id, offset, part
                offset += take
            self.next_id += 1
            total -= size
        self.open, self.left = [], self.scale.copy()


_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
           ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_file: str, limits: Limits = Limits(), loss_start: str | None = None,
         with_ids: bool = False, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    ``loss_start``: a column with the first loss-bearing token of an example (instruction
    data: its prompt's length); by default all but the first token, which nothing predicts.
    """
    first = F.lit(1).cast("int") if loss_start is None else F.coalesce(F.col(loss_start), F.lit(1)).cast("int")
    items = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), first.alias("loss_start"))

    with open(tokenizer_file, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())  # the vocabulary: under 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_file, content)
        packer = Packer(limits, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], "<u4").tobytes()
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * 8
            arrays = [pa.array(c, t) for c, (_, t) in zip(cols, _FIELDS)]
            names = [n for n, _ in _FIELDS]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<i4") for x in cols[7]], pa.list_(pa.int32())))
                names.append("ids")
            return pa.record_batch(arrays, names=names)

        for b in (p for batch in batches for p in scan.slices(batch)):
            ids, starts = b.column("doc_id").to_pylist(), b.column("loss_start").to_pylist()
            for doc_id, loss_from, enc in zip(ids, starts, encode(b.column("text").to_pylist())):
                rows.extend(packer.add(Example(doc_id, enc + end, 0, loss_from)))
            if rows:
                yield out()
                rows.clear()
        rows.extend(packer.finish())
        yield out()

    return items.mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
