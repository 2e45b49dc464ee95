"""Periodic runs of words: every maximal stretch that repeats its first words.

A run has smallest period q (words q apart are identical), at least
``exponent`` * q and ``least`` words, and no neighbouring word extends it.

Method: multi-scale minimizers.  Scale k serves periods q in (G/2, G] with
G = 2**k.  Its grams are G consecutive words and its windows G/2 consecutive
grams; each window marks its gram of least hash (the leftmost of equals).
Windows q apart inside a run are equal, so marks repeat at distance q there,
and since a gram is no shorter than the period, equal grams inside the run are
multiples of q apart: neighbours of one hash give exactly (place, q).  Such
pairs seed the extension; pairs of one lag whose grams touch are one seed, so a
run is extended once, by a bounded number of words.  Periods up to ``SHORT``
are found by direct scans at each lag.  Words are numbered by their bytes, so
extension and the final test compare words, not hashes.

A batch of documents is worked on at once; no comparison crosses documents.

Defined cases: a null text has no words; texts without a run return no runs and
their words joined by one space; rows with equal doc_id are reported each; an
empty table gives an empty result; columns asked for are carried along, others
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm import scan

#: Longest period (a power of two) that is found by direct scans at its lag.
SHORT = 16
#: Words that one step of the extension compares.
STEP = 16
RUN = "struct<start:long,length:long,period:long>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


@dataclass(frozen=True)
class Rule:
    """A run has at least ``least`` words and ``exponent`` periods (four at least)."""

    least: int = 6
    exponent: int = 4

    def __post_init__(self):
        if self.exponent < 4:
            raise ValueError("minimizers repeat within runs of four periods or more")


@lru_cache(maxsize=4096)
def _prime_factors(n: int) -> tuple[int, ...]:
    out, r = [], 2
    while r * r <= n:
        if n % r == 0:
            out.append(r)
            while n % r == 0:
                n //= r
        r += 1
    return (*out, n) if n > 1 else tuple(out)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value (the leftmost of equals) of every ``width`` consecutive ones."""
    at, size = np.arange(len(h)), 1

    def lower(a, b):
        return np.where(h[b] < h[a], b, a)

    while size * 2 <= width:
        at = lower(at[:-size], at[size:])
        size *= 2
    return lower(at[:len(at) - (width - size)], at[width - size:]) if size < width else at


def _same(x: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from a and b on (in direction ``step``) are identical, up to ``room``."""
    out, live, t = np.zeros(len(a), np.int64), np.flatnonzero(room > 0), 0
    while len(live):
        d = t + np.arange(STEP)
        inside = d < room[live][:, None]
        i = np.where(inside, step * d, 0)
        equal = inside & (x[a[live][:, None] + i] == x[b[live][:, None] + i])
        full = equal.all(axis=1)
        out[live] += np.where(full, STEP, np.argmin(equal, axis=1))
        live, t = live[full], t + STEP
    return out


class Finder:
    """Runs of a batch of documents, given as word numbers and offsets by document."""

    def __init__(self, ids: np.ndarray, off: np.ndarray, rule: Rule):
        self.x, self.off, self.rule = ids, off, rule
        self.sizes = np.diff(off)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.runs: set[tuple[int, int, int]] = set()

    def _whole(self, a: int, b: int, q: int) -> bool:
        return np.array_equal(self.x[a:b - q], self.x[a + q:b])

    def _add(self, start: np.ndarray, end: np.ndarray, q: int) -> None:
        """Keep the stretches of lag q whose smallest period it is."""
        for a, b in zip(start.tolist(), end.tolist()):
            if not any(self._whole(a, b, q // r) for r in _prime_factors(q)):
                self.runs.add((a, b, q))

    def lag(self, q: int, lo: int, hi: int) -> None:
        """All runs of period q in the words [lo, hi), by one comparison per word."""
        x, doc = self.x[lo:hi], self.doc[lo:hi]
        if len(x) <= q:
            return
        equal = np.concatenate([[False], (x[:-q] == x[q:]) & (doc[:-q] == doc[q:]), [False]])
        edge = np.flatnonzero(equal[1:] != equal[:-1])
        start, end = edge[::2], edge[1::2]
        long = end - start + q >= max(self.rule.least, self.rule.exponent * q)
        self._add(start[long] + lo, end[long] + q + lo, q)

    def scale(self, gram: int) -> None:
        """Runs of periods in (gram / 2, gram]."""
        width, need = gram // 2, self.rule.exponent * (gram // 2 + 1)
        long = self.sizes >= need
        if not long.any():
            return
        where = np.flatnonzero(np.repeat(long, self.sizes))  # words of the long documents only
        x, doc = self.x[where], self.doc[where]
        h = scan.gram_hashes(scan.mix(x.astype(np.uint64) + np.uint64(1)), gram)
        if len(h) < width:
            return
        mark = np.unique(_least(h, width))
        mark = mark[np.lexsort((mark, h[mark]))]
        i, j = mark[:-1], mark[1:]
        q = j - i
        pair = (h[i] == h[j]) & (q > width) & (q <= gram)
        i, j, q = i[pair], j[pair], q[pair]
        pair = doc[i] == doc[j + gram - 1]
        i, q = i[pair], q[pair]
        if not len(i):
            return
        order = np.lexsort((i, q))
        i, q = i[order], q[order]
        new = np.concatenate([[True], (q[1:] != q[:-1]) | (i[1:] > i[:-1] + gram)])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(i)]]) - 1
        q, a, b = q[first], where[i[first]], where[i[last]] + gram  # words [a, b) equal those q further on
        begin, stop = self.off[self.doc[a]], self.off[self.doc[a] + 1]
        a = a - _same(self.x, a - 1, a - 1 + q, a - begin, -1)
        b = b + _same(self.x, b, b + q, stop - q - b, 1)
        keep = b + q - a >= self.rule.exponent * q
        for s, e, p in zip(a[keep].tolist(), (b + q)[keep].tolist(), q[keep].tolist()):
            if self._whole(s, e, p):
                self._add(np.array([s]), np.array([e]), p)
            else:  # equal hashes of unlike grams: look at every word of the document at this lag
                d = self.doc[s]
                self.lag(p, int(self.off[d]), int(self.off[d + 1]))

    def find(self) -> list[tuple[int, int, int]]:
        """(first word, end, period) of every run, by first word, then period."""
        for q in range(1, SHORT + 1):
            self.lag(q, 0, len(self.x))
        gram = 2 * SHORT
        while len(self.sizes) and self.rule.exponent * (gram // 2 + 1) <= self.sizes.max():
            self.scale(gram)
            gram *= 2
        return sorted((a, q, b) for a, b, q in self.runs)


def _found(rule: Rule, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in scan.slices(b, "_text")):
            data, at = scan.string_bytes(part.column("_text"))
            starts, ends, off = scan.words(data, at)
            found = Finder(scan.word_dictionary(data, starts, ends).indices.to_numpy().astype(np.int64), off, rule).find()
            gone = np.zeros(len(starts) + 1, np.int64)
            runs: list[list] = [[] for _ in range(part.num_rows)]
            owner = np.searchsorted(off, [a for a, _, _ in found], side="right") - 1
            for d, (a, q, b) in zip(owner.tolist(), found):
                runs[d].append({"start": a - int(off[d]), "length": b - a, "period": q})
                gone[a + q] += 1
                gone[b] -= 1
            keep = np.cumsum(gone[:-1]) == 0
            raw, texts = data.tobytes(), []
            for i in range(part.num_rows):
                own = np.flatnonzero(keep[off[i]:off[i + 1]]) + off[i]
                texts.append(b" ".join([raw[s:e] for s, e in zip(starts[own].tolist(), ends[own].tolist())]).decode())
            yield pa.record_batch([*(part.column(f"c{i}") for i in range(len(columns))),
                                   pa.array(np.diff(off).astype(np.int64)), pa.array(runs, _RUN), pa.array(texts, pa.string())],
                                  names=[*(f"c{i}" for i in range(len(columns))), "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), rule: Rule = Rule()) -> DataFrame:
    """``columns``, n_words, runs (start, length, period; by start, then period) and collapsed.

    collapsed: the words outside every run's repetitions (what follows its
    first period), joined by one space.
    """
    rows = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)), F.coalesce("text", F.lit("")).alias("_text"))
    types = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(columns))
    found = rows.mapInArrow(_found(rule, list(columns)), f"{types}, n_words long, runs array<{RUN}>, collapsed string")
    return found.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)), "n_words", "runs", "collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and the text with its planted repetition.

    With h = crc32 of the decimal doc_id and g = h div 10: if h mod 10 is 0,
    words from number a = g mod n on repeat the p = 1 + (n - a) div (3 + g mod 8)
    words that begin there.  Other texts, and those of a null doc_id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(h % 10 == 0, F.lit(False)).alias("_edit"),
                       F.floor(h / 10).cast("long").alias("_g"))
    rows = rows.withColumn("_w", F.when(F.col("_edit"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    n = F.size("_w").cast("long")
    rows = rows.withColumn("_a", F.when(n > 0, F.col("_g") % n))
    rows = rows.withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8)).cast("long"))
    edited = F.array_join(F.transform("_w", lambda x, i: F.when(i < F.col("_a"), x).otherwise(
        F.get("_w", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")))), " ")
    return rows.select("doc_id", F.when(F.col("_edit") & (n > 0), edited).otherwise(F.col("text")).alias("text"))


def digest(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256."""
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = periodic_runs(docs, rule=rule).withColumn("_best", F.array_min(order))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"), (-F.col("_best.l")).alias("length"),
        F.col("_best.period").alias("period"), F.floor(-1000 * F.col("_best.l") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit(""))).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
