"""N-gram Jaccard join: exact links between documents, as components.

Method: set-relation skipping.  Documents are sets of 4-word shingles; equal
sets are one node.  First every set is compared with one leader of each
min-hash band it is in, which joins groups of near copies without their pairs.
Then an exact prefix-filter join finds all links between different
components: index lists hold each set's rarest shingles, cut into blocks by size and
position, and a block whose best position cannot reach the overlap is skipped,
as is everything in the probe's own component.  A candidate pair's overlap is first
bounded from that of the two leaders, whose answer is computed once: a set
that differs from its leader in few shingles cannot overlap much more than it.
Only what the bound leaves is compared.

Texts lie in a table bucketed by node, so a join with pairs moves the pairs only.

Defined cases: a null or wordless text has the empty set, is linked with
nothing and is its own component; shorter texts are one shingle; rows with a
null doc_id take no part (component null); repeated rows share their component;
unlike texts with equal doc_id are linked only if their sets are; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelens.llm import scan
from tradelens.llm.frames import stored, text_key
from tradelens.llm.graph import components
from tradelens.session import scratch_path

_U = np.uint64
#: Bits of a shingle's hash that give way to its row in a slice (scan.SLICE_ROWS < 1024).
ROW_BITS = 10
#: Counters of the frequency sketch, which only orders shingles: a bound of 4 MB.
SKETCH = 1 << 20
BANDS = 4
BLOCK = 64
#: List length up to which neighbours at each distance are compared for all lists at once.
SHORT = 48


@dataclass(frozen=True)
class Rule:
    """Shingle length, and the similarity as a percentage."""

    words: int = 4
    percent: int = 85

    def prefix(self, size):
        """How many of the rarest shingles are indexed."""
        return size - (self.percent * size + 99) // 100 + 1

    def needed(self, a, b):
        """Overlap from which sets of these sizes are linked."""
        return (self.percent * (a + b) + 99 + self.percent) // (100 + self.percent)


def shingles(arr: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row << 54 | 54-bit shingle hash, sorted and distinct; offsets by row)."""
    data, off = scan.string_bytes(arr)
    starts, ends, by_doc = scan.words(data, off)
    h = scan.word_hashes(data, starts, ends, lower=True)
    sizes = np.diff(by_doc)
    grams = scan.gram_hashes(h, k)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    valid = np.flatnonzero(doc[:len(grams)] == doc[k - 1:k - 1 + len(grams)]) if len(grams) else np.empty(0, np.int64)
    docs, terms = [doc[valid]], [grams[valid]]
    for i in np.flatnonzero((sizes > 0) & (sizes < k)):
        docs.append(np.array([i]))
        terms.append(scan.gram_hashes(h[by_doc[i]:by_doc[i + 1]], int(sizes[i])))
    both = np.unique((np.concatenate(docs).astype(_U) << _U(64 - ROW_BITS)) | (np.concatenate(terms) >> _U(ROW_BITS)))
    return both, np.searchsorted(both, np.arange(len(sizes) + 1).astype(_U) << _U(64 - ROW_BITS)) if len(sizes) < 1 << ROW_BITS else None


_LOW = _U((1 << (64 - ROW_BITS)) - 1)


def _parts(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    return (p for b in batches for p in scan.slices(b, column))


def _members(rule: Rule) -> Callable:
    """key, nid, size, a hash of the set, and its bands (pairs of minima under different hashes)."""
    def run(batches):
        for b in _parts(batches):
            both, off = shingles(b.column("text"), rule.words)
            term, sizes = both & _LOW, np.diff(off)
            full = np.flatnonzero(sizes)
            bands = np.zeros((b.num_rows, BANDS), np.int64)
            for i in range(BANDS):
                low = [np.minimum.reduceat(scan.mix(term + _U(2 * i + j)), off[full]) for j in (0, 1)] if len(full) else [np.empty(0, _U)] * 2
                bands[full, i] = scan.signed(scan.mix(low[0] + scan.mix(low[1] + _U(i))))
            sets = [hashlib.blake2b(term[off[i]:off[i + 1]].tobytes(), digest_size=16).digest() for i in range(b.num_rows)]
            yield pa.record_batch([b.column("key"), b.column("nid"), pa.array(sizes.astype(np.int64)), pa.array(sets, pa.binary()),
                                   pa.array(bands.tolist(), pa.list_(pa.int64()))], names=["key", "nid", "size", "set", "bands"])
    return run


def _sketched(rule: Rule) -> Callable:
    """One frequency sketch per task, in parts."""
    def run(batches):
        count = np.zeros(SKETCH, np.uint32)
        for b in _parts(batches):
            both, _ = shingles(b.column("text"), rule.words)
            count += np.bincount((both & _U(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
        parts = count.reshape(64, -1)
        yield pa.record_batch([pa.array(range(64), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())],
                              names=["part", "counts"])
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for part, raw in zip(b.column("part").to_pylist(), b.column("counts").to_pylist()):
            x = np.frombuffer(raw, np.uint32)
            total[part] = total[part] + x if part in total else x
    yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                          names=["part", "counts"])


def frequencies(texts: DataFrame, rule: Rule) -> np.ndarray:
    """Counts of all shingles of all texts, by the low bits of their hash."""
    rows = (texts.select("text").mapInArrow(_sketched(rule), "part int, counts binary")
            .repartition(8, "part").mapInArrow(_summed, "part int, counts binary").collect())
    out = np.zeros((64, SKETCH // 64), np.uint32)
    for r in rows:
        out[r["part"]] = np.frombuffer(r["counts"], np.uint32)
    return out.ravel()


def _postings(rule: Rule, sketch) -> Callable:
    """token, nid, size, pos, component of every set's rarest shingles."""
    def run(batches):
        counts = sketch.value
        for b in _parts(batches):
            both, off = shingles(b.column("text"), rule.words)
            row, term = (both >> _U(64 - ROW_BITS)).astype(np.int64), both & _LOW
            order = np.lexsort((term, counts[(term & _U(SKETCH - 1)).astype(np.int64)], row))
            sizes = np.diff(off)
            pos = np.arange(len(order)) - np.repeat(off[:-1], sizes)
            take = np.flatnonzero(pos < np.repeat(rule.prefix(sizes), sizes))
            of = pa.array(row[take])
            yield pa.record_batch([pa.array(scan.signed(term[order[take]])), b.column("nid").take(of),
                                   pa.array(sizes[row[take]].astype(np.int32)), pa.array(pos[take].astype(np.int32)),
                                   b.column("component").take(of)], names=["token", "nid", "size", "pos", "component"])
    return run


class Lists:
    """Index lists of a partition, sorted by token, then size; yields candidate pairs across components."""

    def __init__(self, rule: Rule):
        self.rule = rule

    def short(self, token, nid, size, pos, comp) -> Iterator[np.ndarray]:
        """All lists at once: each entry with the one d places further on, while any pair can still link."""
        rule = self.rule
        at, d = np.arange(len(token)), 1
        while len(at):
            at = at[at + d < len(token)]
            to = at + d
            near = (token[at] == token[to]) & (rule.percent * size[to] <= 100 * size[at])
            at, to = at[near], to[near]
            reach = np.minimum(size[at] - pos[at], size[to] - pos[to])
            ok = (comp[at] != comp[to]) & (nid[at] != nid[to]) & (reach >= rule.needed(size[at], size[to]))
            if ok.any():
                yield np.stack([nid[at[ok]], nid[to[ok]]], axis=1)
            d += 1

    def long(self, nid, size, pos, comp) -> Iterator[np.ndarray]:
        """One list: entries outside its largest component probe blocks of the others."""
        rule = self.rule
        names, count = np.unique(comp, return_counts=True)
        if len(names) == 1:
            return
        n = len(nid)
        starts = np.arange(0, n, BLOCK)
        reach = np.maximum.reduceat(size - pos, starts)
        least, most = size[starts], size[np.minimum(starts + BLOCK, n) - 1]
        main = names[np.argmax(count)]
        for i in np.flatnonzero(comp != main):
            s = size[i]
            blocks = np.flatnonzero((100 * most >= rule.percent * s) & (rule.percent * least <= 100 * s)
                                    & (np.minimum(reach, s - pos[i]) >= rule.needed(np.maximum(least, -(-rule.percent * s // 100)), s)))
            if not len(blocks):
                continue
            j = (starts[blocks][:, None] + np.arange(BLOCK)[None, :]).ravel()
            j = j[j < n]
            j = j[(comp[j] != comp[i]) & (nid[j] != nid[i]) & ((comp[j] == main) | (j > i))]
            j = j[(100 * np.minimum(size[j], s) >= rule.percent * np.maximum(size[j], s))
                  & (np.minimum(size[j] - pos[j], s - pos[i]) >= rule.needed(size[j], s))]
            if len(j):
                yield np.stack([np.full(len(j), nid[i]), nid[j]], axis=1)

    def pairs(self, cols: list[np.ndarray]) -> Iterator[np.ndarray]:
        token = cols[0]
        first = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]])
        length = np.diff(first)
        few = np.repeat((length > 1) & (length <= SHORT), length)
        yield from self.short(*(c[few] for c in cols))
        for i in np.flatnonzero(length > SHORT):
            yield from self.long(*(c[first[i]:first[i + 1]] for c in cols[1:]))


def _candidates(rule: Rule) -> Callable:
    def run(batches):
        lists, held = Lists(rule), None

        def out(cols):
            for p in lists.pairs(cols):
                p = np.unique(np.sort(p, axis=1), axis=0)
                for i in range(0, len(p), 100_000):
                    yield pa.record_batch([pa.array(p[i:i + 100_000, 0]), pa.array(p[i:i + 100_000, 1])], names=["a", "b"])

        for b in batches:
            cols = [b.column(c).to_numpy().astype(np.int64) for c in ("token", "nid", "size", "pos", "component")]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last token's list may go on
            if cut > 20_000:
                yield from out([c[:cut] for c in cols])
                cols = [c[cut:] for c in cols]
            held = cols
        if held is not None and len(held[0]):
            yield from out(held)
    return run


def _overlaps(rule: Rule) -> Callable:
    def run(batches):
        for b in (p for x in batches for y in scan.slices(x, "text_a") for p in scan.slices(y, "text_b")):
            x, off_x = shingles(b.column("text_a"), rule.words)
            y, off_y = shingles(b.column("text_b"), rule.words)
            both = np.intersect1d(x, y, assume_unique=True)
            n = np.bincount((both >> _U(64 - ROW_BITS)).astype(np.int64), minlength=b.num_rows)
            yield pa.record_batch([b.column("a"), b.column("b"), pa.array(np.diff(off_x).astype(np.int64)),
                                   pa.array(np.diff(off_y).astype(np.int64)), pa.array(n.astype(np.int64))],
                                  names=["a", "b", "size_a", "size_b", "common"])
    return run


def overlaps(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """a, b, size_a, size_b, common of every pair."""
    left = pairs.join(texts.select(F.col("nid").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("nid").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(
        _overlaps(rule), "a long, b long, size_a long, size_b long, common long")


def bucketed(texts: DataFrame) -> str:
    """Write nid, key, text as a table bucketed by nid in the shared folder; its name.

    ``texts`` comes from a join on doc_id, and nearly every nid is the doc_id:
    its rows lie in the table's buckets already.
    """
    spark = texts.sparkSession
    name = f"jaccard_texts_{uuid.uuid4().hex}"
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts.write.bucketBy(n, "nid").option("path", scratch_path(spark, "llm", name)).saveAsTable(name)
    return name


def nodes_of(rows: DataFrame) -> DataFrame:
    """key, least (doc_id), nid of every text that has a doc_id; nid is the text's own.

    It is the least doc_id, unless a text of smaller key has the same one; then
    it is a number beyond all doc_ids.
    """
    least = rows.where("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    lo, hi = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    number = F.monotonically_increasing_id()
    if hi is None or hi < 1 << 62:
        other = F.lit((hi or 0) + 1) + number
    elif lo > -(1 << 62):
        other = F.lit(lo - 1) - number
    else:
        raise ValueError("doc_id fills the range of long; no room to number texts that share one")
    first = F.row_number().over(Window.partitionBy("least").orderBy("key")) == 1
    return stored(least.withColumn("first", first).select(
        "key", "least", F.when(F.col("first"), F.col("least")).otherwise(other).alias("nid")), "jaccard-nodes")


def groups(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """key, n_shingles, least, component_id, keeper of every distinct text that has a doc_id.

    component_id is the least doc_id of the texts linked with it; keeper is the
    text (by key) that has it, the smaller key of two.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"))
    nodes = nodes_of(rows.select("doc_id", "key"))
    # dealt out by doc_id alone: as an equality, the comparison of keys would become a second join key
    same_text = F.least("key", "own") == F.greatest("key", "own")
    name = bucketed(rows.where("doc_id is not null")
                    .join(nodes.withColumnRenamed("key", "own"), (F.col("doc_id") == F.col("least")) & same_text)
                    .dropDuplicates(["doc_id", "key"]).select("nid", "key", "text"))  # by doc_id still: no second shuffle
    try:
        members, component = _linked(docs.sparkSession.table(name), rule)
    finally:
        docs.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    of = (members.select("nid", "size").join(nodes, "nid").join(component.withColumnRenamed("node", "nid"), "nid", "left")
          .select("key", F.col("size").alias("n_shingles"), "least", F.coalesce("component", "nid").alias("c")))
    of = stored(of, "jaccard-texts")
    best = stored(of.groupBy("c").agg(F.min(F.struct("least", "key")).alias("best"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").drop("n"), "jaccard-groups")
    return of.join(best, "c", "left").select(
        "key", "n_shingles", "least", F.coalesce("best.least", "least").alias("component_id"), F.coalesce("best.key", "key").alias("keeper"))


def _linked(texts: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Sizes by nid, and the component of every nid that has a link; both written."""
    linked = "100 * common >= %d * (size_a + size_b - common)" % rule.percent
    members = stored(texts.select("key", "nid", "text").mapInArrow(
        _members(rule), "key binary, nid long, size long, set binary, bands array<long>"), "jaccard-members")

    sets = members.where("size > 0").groupBy("set").agg(F.min("nid").alias("leader"))
    same = members.where("size > 0").join(sets, "set")
    equal = same.where("nid <> leader").select(F.col("nid").alias("u"), F.col("leader").alias("v"))
    nodes = same.where("nid = leader").select("nid", "bands")

    band = nodes.select("nid", F.posexplode("bands").alias("i", "band"))
    lead = band.groupBy("i", "band").agg(F.min("nid").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    near = band.join(lead, ["i", "band"]).where("nid <> b").select(F.col("nid").alias("a"), "b").distinct()
    near = stored(overlaps(near, texts, rule).where(linked), "jaccard-near")
    leaders = near.groupBy("a").agg(F.min_by(F.struct("b", (F.col("size_a") - F.col("common")).alias("apart")),
                                             F.struct(F.col("size_a") - F.col("common"), "b")).alias("l"))
    leaders = leaders.select(F.col("a").alias("nid"), F.col("l.b").alias("leader"), F.col("l.apart").alias("apart"))

    joined = components(near.select(F.col("a").alias("u"), F.col("b").alias("v")))
    sketch = texts.sparkSession.sparkContext.broadcast(frequencies(texts, rule))  # 4 MB
    indexed = (texts.join(nodes.select("nid"), "nid").join(joined.withColumnRenamed("node", "nid"), "nid", "left")
               .select("nid", F.coalesce("component", "nid").alias("component"), "text"))
    postings = indexed.mapInArrow(_postings(rule, sketch), "token long, nid long, size int, pos int, component long")
    pairs = (postings.repartition("token").sortWithinPartitions("token", "size", "pos")
             .mapInArrow(_candidates(rule), "a long, b long").distinct())

    def led(frame: DataFrame, side: str) -> DataFrame:
        of = leaders.select(F.col("nid").alias(side), F.col("leader").alias(f"l{side}"), F.col("apart").alias(f"d{side}"))
        return (frame.join(of, side, "left").withColumn(f"l{side}", F.coalesce(f"l{side}", side))
                .withColumn(f"d{side}", F.coalesce(f"d{side}", F.lit(0))))

    size = same.where("nid = leader").select("nid", "size")
    pairs = led(led(pairs, "a"), "b")
    pairs = (pairs.join(size.select(F.col("nid").alias("a"), F.col("size").alias("sa")), "a")
             .join(size.select(F.col("nid").alias("b"), F.col("size").alias("sb")), "b"))
    pairs = stored(pairs, "jaccard-pairs")
    answers = stored(overlaps(pairs.where("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(),
                              texts, rule), "jaccard-answers")
    known = answers.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("common").alias("led"))
    open_pairs = (pairs.join(known, (F.least("la", "lb") == F.col("x")) & (F.greatest("la", "lb") == F.col("y")), "left")
                  .where("not (a = la and b = lb) and (la = lb or (led + da + db) * %d >= %d * (sa + sb))"
                         % (100 + rule.percent, rule.percent)).select("a", "b"))
    more = answers.union(overlaps(open_pairs, texts, rule)).where(linked)

    links = equal.union(near.select("a", "b")).union(more.select("a", "b"))
    return members, components(links)


def link(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    of = groups(docs, rule)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"))
    shared = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return rows.join(of.select("key", "n_shingles", "component_id"), "key", "left").select(
        "doc_id", F.coalesce("n_shingles", F.lit(0)).alias("n_shingles"),
        F.when(shared, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
