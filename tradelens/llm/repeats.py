"""Exact search for repeated windows of a corpus, in shuffles of bounded groups.

A window is ``window`` consecutive symbols (bytes or words) of one document.
Every window chooses an anchor by its content alone (scan.anchors), so equal
windows meet under the same anchor hash.  Anchors that occur once are dropped
by a count; around every other one the run of windows that chose it is cut out
as a *context* and sent to the task of its anchor, where a ``judge`` decides
which of its windows occur elsewhere.

Equal contexts are merged per batch before the shuffle and pass through the
task as a stream.  An anchor with more than ``hot`` places is not gathered:
there every window is sent on its own under its own hash, so the group is dealt
out by window and needs no memory.  Both ways are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm import scan

#: Places of one anchor that may be gathered in one task.
HOT = 100_000

CONTEXTS = "h long, ctx binary, off int, n long, occ array<struct<key:binary,pos:int>>"
_OCC = pa.list_(pa.struct([("key", pa.binary()), ("pos", pa.int32())]))
_CTX = pa.schema([("h", pa.int64()), ("ctx", pa.binary()), ("off", pa.int32()), ("n", pa.int64()), ("occ", _OCC)])
_SPAN = pa.schema([("key", pa.binary()), ("start", pa.int32()), ("end", pa.int32())])


@dataclass(frozen=True)
class Symbols:
    """How a text becomes symbols: ``read`` gives (cut, hash values, offsets by document).

    ``cut(a, b)`` are the bytes of symbols a to b, equal if and only if the
    symbols are; ``length`` counts the symbols in such bytes.
    """

    read: Callable
    length: Callable
    window: int
    k: int


@dataclass
class Context:
    """A distinct context of one anchor: text from ``off`` symbols before the anchor."""

    ctx: bytes
    off: int
    n: int
    occ: list


def read_bytes(arr: pa.Array):
    data, off = scan.string_bytes(arr)
    raw = data.tobytes()
    return lambda a, b: raw[a:b], scan.byte_values(data), off


def read_words(arr: pa.Array):
    data, off = scan.string_bytes(arr)
    starts, ends, by_doc = scan.words(data, off)
    raw, at = scan.joined_words(data, starts, ends)
    return lambda a, b: raw[at[a]:at[b] - 1], scan.word_hashes(data, starts, ends, lower=False), by_doc


def count_words(ctx: bytes) -> int:
    """Words of bytes cut by ``read_words``."""
    return ctx.count(b" ") + 1


def _counts(sym: Symbols):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in scan.slices(b)):
            _, values, off = sym.read(part.column("text"))
            doc, _, _, _, h = scan.anchors(values, off, sym.window, sym.k)
            if len(doc):
                n = part.column("n").to_numpy()[doc]
                u, inv = np.unique(scan.signed(h), return_inverse=True)
                yield pa.record_batch([pa.array(u), pa.array(np.bincount(inv, n).astype(np.int64))], names=["h", "c"])
    return run


def _places(sym: Symbols):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in scan.slices(b)):
            _, values, off = sym.read(part.column("text"))
            doc, place, _, _, h = scan.anchors(values, off, sym.window, sym.k)
            if len(doc):
                yield pa.record_batch([pa.array(scan.signed(h)), part.column("key").take(pa.array(doc)),
                                       pa.array((place - off[doc]).astype(np.int32))], names=["h", "key", "pos"])
    return run


def _contexts(sym: Symbols):
    """Contexts of the anchors listed in ``marks`` (place * 2 + hot), equal ones merged per slice."""
    window = sym.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in scan.slices(b)):
            cut, values, off = sym.read(part.column("text"))
            doc, place, first, last, h = scan.anchors(values, off, sym.window, sym.k)
            marks = part.column("marks")
            owner = np.repeat(np.arange(part.num_rows), np.diff(marks.offsets.to_numpy()))
            mark = marks.flatten().to_numpy()
            want = off[owner] + (mark >> 1)
            pick = np.searchsorted(place, np.sort(want))
            hot = (mark & 1)[np.argsort(want, kind="stable")]
            keys, count = part.column("key").to_pylist(), part.column("n").to_pylist()
            out: dict[tuple, Context] = {}

            def put(group, a, b, d, p, o):
                text = cut(a, b)
                c = out.get((group, text, o))
                if c is None:
                    c = out[(group, text, o)] = Context(text, o, 0, [])
                c.n += count[d]
                c.occ.append((keys[d], p))

            for i, is_hot in zip(pick.tolist(), hot.tolist()):
                d, p, a, b = int(doc[i]), int(place[i]), int(first[i]), int(last[i])
                if is_hot:
                    each = scan.signed(scan.gram_hashes(values[a:b + window], window))
                    for j, g in enumerate(each.tolist()):
                        put(g, a + j, a + j + window, d, a + j - int(off[d]), 0)
                else:
                    put(int(scan.signed(h[i:i + 1])[0]), a, b + window, d, p - int(off[d]), p - a)
            if out:
                got = list(out.items())
                yield pa.record_batch([
                    pa.array([k[0] for k, _ in got], pa.int64()), pa.array([c.ctx for _, c in got], pa.binary()),
                    pa.array([c.off for _, c in got], pa.int32()), pa.array([c.n for _, c in got], pa.int64()),
                    pa.array([[{"key": k, "pos": p} for k, p in c.occ] for _, c in got], _OCC)], schema=_CTX)
    return run


class Spans:
    """Collects output spans and hands them out in batches."""

    def __init__(self):
        self.key, self.start, self.end = [], [], []

    def add(self, key: bytes, start: int, end: int) -> None:
        self.key.append(key)
        self.start.append(start)
        self.end.append(end)

    def batch(self) -> pa.RecordBatch:
        out = pa.record_batch([pa.array(self.key, pa.binary()), pa.array(self.start, pa.int32()),
                               pa.array(self.end, pa.int32())], schema=_SPAN)
        self.__init__()
        return out


def _judged(sym: Symbols, make_judge: Callable):
    """Stream the sorted contexts of a partition, group by group, through a judge."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans, judge = Spans(), make_judge(sym)
        group, held, current = None, [], None

        def whole(c: Context) -> None:
            n = sym.length(c.ctx)
            for key, pos in c.occ:
                spans.add(key, pos - c.off, pos - c.off + n)

        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
            for h, ctx, off, n, occ in zip(*cols):
                if h != group:
                    judge.group(held, spans)
                    group, held, current = h, [], None
                if current is None or current.ctx != ctx or current.off != off:
                    current = Context(ctx, off, 0, [])
                    held.append(current)
                current.n += n
                current.occ = [(o["key"], o["pos"]) for o in occ] + current.occ
                if current.n > 1:  # repeated whole: its places need not be kept
                    whole(current)
                    current.occ = []
            if len(spans.key) >= 20_000:
                yield spans.batch()
        judge.group(held, spans)
        judge.close(spans)
        yield spans.batch()
    return run


def repeated_spans(texts: DataFrame, sym: Symbols, make_judge: Callable, hot: int = HOT) -> DataFrame:
    """(key, start, end) spans, in symbols, whose union is what repeated windows cover.

    ``texts``: key, n, text as from frames.distinct_texts.
    """
    counts = (texts.mapInArrow(_counts(sym), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
              .where("c > 1"))
    marks = (texts.mapInArrow(_places(sym), "h long, key binary, pos int").join(counts, "h")
             .groupBy("key").agg(F.collect_list(F.col("pos") * 2 + (F.col("c") > hot).cast("int")).alias("marks")))
    contexts = texts.join(marks, "key").select("key", "n", "text", "marks").mapInArrow(_contexts(sym), CONTEXTS)
    return (contexts.repartition("h").sortWithinPartitions("h", "off", "ctx")
            .mapInArrow(_judged(sym, make_judge), "key binary, start int, end int"))


def covered(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of the union of half-open spans."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """key, n, text and the spans of each text as two arrays (null where it has none)."""
    of = spans.groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    return texts.join(of, "key", "left").select("key", "n", "text", "starts", "ends")
