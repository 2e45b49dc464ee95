"""Filter interaction audit: what each of five filters removes, in every order.

Method: a sparse document-term matrix.  Texts are read in shards of a bounded
number of bytes; a shard holds its documents' rows in CSR form (row pointers,
column numbers, counts) over the words of its own, and is written to the shared
folder.  The words of all shards are dealt out by word, sorted and numbered as a
stream: one dictionary for the whole corpus, whose numbers depend on nothing
but the words.  They go back to the shards, whose columns are renumbered.  Row sums are the numbers of words and nonzero counts those of
distinct words, which decide A and B.  C and D are read off the bytes, E comes
from the least doc_id of each text.  Documents are then counted by part and
pattern of failures (at most 32 a part), from which every order and step follows.

Defined cases: a null text is empty, a null lang is the empty part; a null
doc_id neither is nor has a smaller one and carries no label; rows with equal
doc_id are documents of their own and not copies of each other; a doc_id with
several labels has a mark if any of them has it; an empty table gives an empty
result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm import scan
from tradelens.llm.frames import stored

FILTERS = "ABCDE"
#: Bytes of text in a shard (one document, if it is longer).
SHARD_BYTES = 8 << 20
#: Numbered words that a task holds before they leave by shard (20 bytes each).
HELD_WORDS = 1 << 20
MARKS = b"#$%&*|"
_FRAME = "shard long, words array<string>, indptr binary, indices binary, counts binary, doc_id array<long>, " \
         "part array<string>, sha array<binary>, marks binary"
_NUMBERS = "shard long, n int, first long, local binary, gaps binary"


@dataclass(frozen=True)
class Limits:
    """A: under ``words`` words. B: distinct words below ``distinct`` percent. C: capitals above ``capitals`` percent."""

    words: int = 100
    distinct: int = 80
    capitals: int = 10


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches joined and cut anew, so that each holds about ``limit`` bytes of text."""
    held, size = [], 0
    for b in batches:
        for part in scan.slices(b, "text", limit):
            n = int(scan.string_bytes(part.column("text"))[1][-1])
            if held and size + n > limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()[:1]


def _by_document(marked: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of marked bytes of each document; few are."""
    return np.diff(np.searchsorted(np.flatnonzero(marked), off))


def _shards(limits: Limits, shard_bytes: int):
    is_mark = np.zeros(256, bool)
    is_mark[list(MARKS)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for shard, b in enumerate(_gathered((x for x in batches if x.num_rows), shard_bytes), first):
            data, off = scan.string_bytes(b.column("text"))
            starts, ends, by_doc = scan.words(data, off)
            terms = scan.word_dictionary(data, starts, ends)
            row = np.repeat(np.arange(b.num_rows), np.diff(by_doc))
            cell, count = np.unique(row << 32 | terms.indices.to_numpy().astype(np.int64), return_counts=True)
            indptr = np.searchsorted(cell >> 32, np.arange(b.num_rows + 1))
            gaps = np.diff(cell & 0xFFFFFFFF, prepend=0)  # columns of a row ascend, so that gaps pack well
            capitals = _by_document((data >= 65) & (data <= 90), off)
            points = np.diff(off) - _by_document((data & 0xC0) == 0x80, off)  # bytes that continue no code point
            marks = ((100 * capitals > limits.capitals * points) * 4 + (_by_document(is_mark[data], off) > 0) * 8).astype(np.uint8)
            raw, cut = data.tobytes(), off.tolist()
            sha = [hashlib.sha256(raw[x:y]).digest() for x, y in zip(cut, cut[1:])]
            yield pa.record_batch([
                pa.array([shard]), pa.ListArray.from_arrays([0, len(terms.dictionary)], terms.dictionary.cast(pa.large_string()).cast(pa.string())),
                pa.array([indptr.astype(np.int64).tobytes()]), pa.array([_packed(gaps)]),
                pa.array([_packed(count)]), pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([b.column("part").to_pylist()], pa.list_(pa.string())), pa.array([sha], pa.list_(pa.binary())),
                pa.array([marks.tobytes()])],
                names=["shard", "words", "indptr", "indices", "counts", "doc_id", "part", "sha", "marks"])
    return run


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype(np.int32).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.int32) if n else np.zeros(0, np.int32)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the words of a partition sorted by word: equal words get one number, others different ones.

    They leave by shard, packed: up to ``HELD_WORDS`` words are held for that.
    """
    number, last = TaskContext.get().partitionId() << 40, None
    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        word = b.column("word")
        new = np.ones(b.num_rows, bool)
        new[0] = word[0].as_py() != last
        new[1:] = pc.not_equal(word.slice(1), word.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
        term = number + np.cumsum(new)
        number, last = int(term[-1]), word[b.num_rows - 1].as_py()
        held.append((b.column("shard").to_numpy().copy(), b.column("local").to_numpy().copy(), term))  # else the words stay, too
        size += len(term)
        if size >= HELD_WORDS:
            yield _by_shard(held)
            held, size = [], 0
    if held:
        yield _by_shard(held)


def _by_shard(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One row for each shard of the held words: their places in the shard and their numbers, which ascend."""
    shard, local, term = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(shard, kind="stable")
    shard, local, term = shard[order], local[order], term[order]
    cut = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)]])
    at = cut[:-1]
    spans = list(zip(at.tolist(), cut[1:].tolist()))
    return pa.record_batch([
        pa.array(shard[at]), pa.array(np.diff(cut).astype(np.int32)), pa.array(term[at]), pa.array([_packed(local[x:y]) for x, y in spans]),
        pa.array([_packed(np.diff(term[x:y], prepend=term[x])) for x, y in spans])], names=["shard", "n", "first", "local", "gaps"])


def _numbers(known: list[dict] | None) -> np.ndarray:
    """The numbers of a shard's words, by place."""
    to = np.zeros(sum(k["n"] for k in known or []), np.int64)
    for k in known or []:
        to[_unpacked(k["local"], k["n"])] = k["first"] + np.cumsum(_unpacked(k["gaps"], k["n"]), dtype=np.int64)
    return to


def _rows(limits: Limits):
    """Row sums and nonzero counts of the renumbered shards, and the failures they decide."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                one = {c: b.column(c)[i] for c in b.schema.names}
                indptr = np.frombuffer(one["indptr"].as_py(), np.int64)
                indices, counts = np.cumsum(_unpacked(one["indices"].as_py(), indptr[-1])), _unpacked(one["counts"].as_py(), indptr[-1])
                n = len(indptr) - 1
                terms, place = np.unique(_numbers(one["known"].as_py()), return_inverse=True)
                row = np.repeat(np.arange(n), np.diff(indptr))
                cell = row * len(terms) + place[indices]
                order = np.argsort(cell)  # columns of a row in order, as CSR has them
                cell, row, value = cell[order], row[order], counts[order].astype(np.int64)
                first = np.ones(len(cell), bool)
                first[1:] = cell[1:] != cell[:-1]
                words = np.bincount(row, value, n).astype(np.int64)
                distinct = np.bincount(row[first], minlength=n)
                failed = np.frombuffer(one["marks"].as_py(), np.uint8) | (words < limits.words) | (
                    (100 * distinct < limits.distinct * words) * 2)
                yield pa.record_batch([one["doc_id"].values, one["part"].values, one["sha"].values, pa.array(words),
                                       pa.array(distinct.astype(np.int64)), pa.array(failed.astype(np.int32))],
                                      names=["doc_id", "part", "sha", "n_words", "n_distinct", "failed"])
    return run


def matrix(docs: DataFrame, limits: Limits = Limits(), shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, part, sha, n_words, n_distinct, failed (bits of A to D) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text"))
    shards = stored(rows.mapInArrow(_shards(limits, shard_bytes), _FRAME), "audit-shards")
    local = shards.select("shard", F.posexplode("words").alias("local", "word"))
    terms = local.repartition("word").sortWithinPartitions("word").mapInArrow(_numbered, _NUMBERS)
    known = terms.groupBy("shard").agg(F.collect_list(F.struct("n", "first", "local", "gaps")).alias("known"))  # the words of one shard
    return shards.drop("words").join(known, "shard", "left").drop("shard").mapInArrow(
        _rows(limits), "doc_id long, part string, sha binary, n_words long, n_distinct long, failed int")


def failures(docs: DataFrame, limits: Limits = Limits(), shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The matrix' rows with E (bit 16) attached: the text is that of a smaller doc_id."""
    rows = stored(matrix(docs, limits, shard_bytes), "audit-rows")
    copies = stored(rows.groupBy("sha").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").drop("n"), "audit-copies")
    copied = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return (rows.join(copies, "sha", "left").withColumn("failed", F.col("failed") + F.when(copied, 16).otherwise(0))
            .drop("least", "sha"))


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per part, order and step; see the module's docstring."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    counted = (failures(docs, limits, shard_bytes).select("doc_id", "part", "failed").join(marks, "doc_id", "left")
               .groupBy("part", "failed").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                                              F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))
    patterns = counted.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("p"))  # 32 at most
    orders = F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")
    each = (patterns.select("part", "p", F.explode(orders).alias("filter_order"))
            .select("part", "p", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")))

    def bit(letter):
        return F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord(FILTERS[0]))

    letters = F.split("filter_order", "")
    each = (each.withColumn("bit", bit(F.element_at(letters, F.col("step"))))
            .withColumn("before", F.aggregate(F.slice(letters, F.lit(1), F.col("step") - 1), F.lit(0), lambda a, x: a + bit(x))))
    zero = F.lit(0).cast("long")

    def total(which, value="n"):
        return F.aggregate(F.filter("p", which), zero, lambda a, x: a + x[value]).cast("long")

    def hit(x):
        return x["failed"].bitwiseAND(F.col("bit")) != 0

    def earlier(x):
        return x["failed"].bitwiseAND(F.col("before")) != 0

    def removed(x):
        return hit(x) & ~earlier(x)

    # of the orders, one in (number of filters that a document fails) has this one first among them; 120 divides by 1 to 5
    share = F.aggregate(F.filter("p", hit), zero, lambda a, x: a + x["n"] * (F.lit(120) / F.bit_count(x["failed"])).cast("long"))
    return each.select(
        "part", "filter_order", "step",
        total(lambda x: ~hit(x) & ~earlier(x)).alias("kept"), total(removed).alias("removed"),
        total(lambda x: hit(x) & earlier(x)).alias("redundant"), total(lambda x: x["failed"] == F.col("bit")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"), total(removed, "toxic").alias("toxic_lost"), share.alias("shapley"))
