"""Approximate nearest neighbours by balanced posting lists (cosine).

Method: centroids are fitted on a bounded sample and split until no list is
much longer than the mean.  A graph over the centroids, held in the memory of
each worker, finds the lists near a vector by best-first search.  A vector
on a boundary goes to several lists: every list whose centroid is hardly
farther than the nearest one, unless a list already chosen is nearer to that
centroid than the vector is.  A query reads the lists whose centroid distance
is within a ratio of the nearest one's, and as many more as it takes to hold
k other vectors.  Lists are dealt out in blocks of bounded length, and every
block scores its queries exactly, in double precision.

Equal vectors are one entry with their k + 1 smallest ids (no query can use
more), so a vector that a third of all rows share is a single entry.

Defined cases: vectors that are null, zero, hold null or non-finite components,
or have another length than most, and rows without vec_id, take no part;
repeated rows count once; fewer than k candidates give all of them; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelens.llm.frames import stored


@dataclass(frozen=True)
class Params:
    """sample and lists bound what the driver fits; lists grow with the data up to that."""

    sample: int = 20_000
    list_size: int = 128
    lists: int = 2048
    degree: int = 24
    beam: int = 96
    replicas: int = 4
    boundary: float = 1.15
    ratio: float = 1.6
    probes: int = 96
    block: int = 4096


class Centroids:
    """Unit centroids and the graph that finds the nearest of them."""

    def __init__(self, points: np.ndarray, p: Params):
        self.points, self.p = points, p
        c = len(points)
        near = np.argsort(-(points @ points.T), axis=1, kind="stable")[:, 1:p.degree + 1]
        # a few long edges keep far parts of the graph connected
        far = (np.arange(c)[:, None] + (c * (np.arange(4) + 1) // 5)[None, :]) % max(c, 1)
        self.edges = np.concatenate([near, far], axis=1)

    def search(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(lists, distances) of the nearest centroids found, nearest first; -1 where there are fewer."""
        n, c = len(vectors), len(self.points)
        beam = min(beam, c)
        row = np.arange(n)[:, None]
        seen = np.zeros((n, c), bool)
        entry = np.broadcast_to(np.unique(np.linspace(0, c - 1, min(16, c)).astype(int)), (n, min(16, c)))
        seen[row, entry] = True
        sim = np.einsum("nd,nkd->nk", vectors, self.points[entry])
        ids, done = entry.copy(), np.zeros(entry.shape, bool)
        while True:
            open_sim = np.where(done, -np.inf, sim)
            best = open_sim.argmax(axis=1)
            live = np.flatnonzero(np.isfinite(open_sim[np.arange(n), best]))
            if not len(live):
                break
            done[live, best[live]] = True
            new = self.edges[ids[live, best[live]]]
            fresh = ~seen[live[:, None], new]
            seen[live[:, None], new] = True
            dup = np.zeros(new.shape, bool)  # the same centroid twice among one node's edges
            order = np.argsort(new, axis=1, kind="stable")
            ordered = np.take_along_axis(new, order, 1)
            np.put_along_axis(dup, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
            add = np.full((n, new.shape[1]), -np.inf)
            add[live] = np.where(fresh & ~dup, np.einsum("nd,nkd->nk", vectors[live], self.points[new]), -np.inf)
            add_ids = np.zeros((n, new.shape[1]), np.int64)
            add_ids[live] = new
            sim = np.concatenate([sim, add], axis=1)
            ids = np.concatenate([ids, add_ids], axis=1)
            done = np.concatenate([done, ~np.isfinite(add)], axis=1)
            keep = np.argsort(-sim, axis=1, kind="stable")[:, :beam]
            sim, ids, done = (np.take_along_axis(x, keep, 1) for x in (sim, ids, done))
        return np.where(np.isfinite(sim), ids, -1), np.sqrt(np.maximum(0, 2 - 2 * sim))

    def homes(self, vectors: np.ndarray) -> Iterator[tuple[int, int, bool]]:
        """(vector, list, is the nearest) for every list that a vector goes to."""
        ids, dist = self.search(vectors, min(self.p.beam, 16))
        for i in range(len(vectors)):
            chosen: list[int] = []
            for c, d in zip(ids[i].tolist(), dist[i].tolist()):
                if c < 0 or len(chosen) == self.p.replicas or d > self.p.boundary * dist[i, 0] and chosen:
                    break
                gap = np.sqrt(np.maximum(0, 2 - 2 * (self.points[chosen] @ self.points[c]))) if chosen else [9.0]
                if not chosen or min(gap) > d:
                    yield i, c, not chosen
                    chosen.append(c)


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # squares of very large components would overflow
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, total: int, p: Params, rounds: int = 8) -> Centroids:
    """Spherical k-means on unit vectors; lists over twice the mean are split."""
    want = max(1, min(p.lists // 2, len(sample), -(-total // p.list_size)))
    points = sample[np.linspace(0, len(sample) - 1, want).astype(int)]

    def assigned(points):
        return np.concatenate([(sample[i:i + 4096] @ points.T).argmax(axis=1) for i in range(0, len(sample), 4096)])

    for _ in range(rounds):
        home = assigned(points)
        total_by = np.zeros_like(points)
        np.add.at(total_by, home, sample)
        size = np.sqrt((total_by ** 2).sum(axis=1, keepdims=True))
        points = np.where(size > 1e-9, total_by / np.maximum(size, 1e-9), points)
        home = assigned(points)
        count = np.bincount(home, minlength=len(points))
        heavy = np.flatnonzero(count > 2 * len(sample) / want)[:max(0, p.lists - len(points))]
        parts = [points]
        for h in heavy:  # the member farthest from an overlong list's centroid opens a list of its own
            own = np.flatnonzero(home == h)
            parts.append(sample[own[(sample[own] @ points[h]).argmin()]][None])
        points = np.concatenate(parts)
    return Centroids(points[np.bincount(assigned(points), minlength=len(points)) > 0], p)


def _vectors(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def entries(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(rows that take part, distinct vectors as cid, embedding, ids)."""
    ok = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        "vec_id is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) "
        "and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)")
    size = ok.groupBy(F.size("embedding").alias("s")).count().orderBy(F.desc("count"), F.desc("s")).first()
    ok = ok.where(F.size("embedding") == (size["s"] if size else 0)).distinct()
    first = Window.partitionBy("embedding").orderBy("vec_id")
    each = (ok.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
            .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    return ok, each.select(F.col("ids")[0].alias("cid"), "embedding", "ids")


def nearest(vectors: DataFrame, is_query, k: int = 5, p: Params = Params()) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row that ``is_query`` marks."""
    spark = vectors.sparkSession
    ok, distinct = entries(vectors, k)
    distinct = stored(distinct, "ann-entries")
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("cid"), "cid").limit(p.sample).select("embedding").collect()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(fit(unit(np.array([r[0] for r in sample], np.float64)), total, p))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = list(shared.value.homes(unit(_vectors(b.column("embedding")))))
            at = pa.array([i for i, _, _ in got], pa.int64())
            yield pa.record_batch([pa.array([c for _, c, _ in got], pa.int32()), pa.array([f for _, _, f in got], pa.bool_()),
                                   *(b.column(c).take(at) for c in ("cid", "embedding", "ids"))],
                                  names=["list", "nearest", "cid", "embedding", "ids"])

    postings = stored(distinct.mapInArrow(place, "list int, nearest boolean, cid long, embedding array<float>, ids array<long>"),
                      "ann-postings")
    sizes = postings.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("nearest").cast("int")).alias("own")).collect()
    blocks = np.ones(len(shared.value.points), np.int64)
    own = np.zeros(len(shared.value.points), np.int64)
    for r in sizes:  # at most p.lists rows
        blocks[r["list"]], own[r["list"]] = -(-r["n"] // p.block), r["own"]
    spread = F.element_at(F.lit(blocks.tolist()), F.col("list") + 1)
    dealt = postings.select("list", F.pmod(F.xxhash64("cid"), spread).cast("int").alias("block"), "cid", "embedding", "ids")

    queries = ok.where(is_query).select(F.col("vec_id").alias("query_id"), "embedding").join(
        distinct.select("embedding", "cid"), "embedding")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for b in batches:
            v = _vectors(b.column("embedding"))
            lists, dist = c.search(unit(v), max(p.beam, p.probes))
            at, to, block = [], [], []
            for i in range(len(v)):
                held = 0
                for rank, (x, d) in enumerate(zip(lists[i].tolist(), dist[i].tolist())):
                    if x < 0 or held > k and (rank >= p.probes or d > p.ratio * dist[i, 0] and rank >= 8):
                        break
                    held += int(own[x])
                    for s in range(int(blocks[x])):
                        at.append(i)
                        to.append(x)
                        block.append(s)
                if held <= k:  # the beam's lists hold too few vectors: read all others as well
                    for x in sorted(set(range(len(own))) - set(lists[i].tolist())):
                        for s in range(int(blocks[x])):
                            at.append(i)
                            to.append(x)
                            block.append(s)
            rows = pa.array(at, pa.int64())
            yield pa.record_batch([pa.array(to, pa.int32()), pa.array(block, pa.int32()), b.column("cid").take(rows),
                                   b.column("embedding").take(rows)], names=["list", "block", "cid", "embedding"])

    asked = queries.select("cid", "embedding").dropDuplicates(["cid"]).mapInArrow(
        probe, "list int, block int, cid long, embedding array<float>")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"cid": [], "vec_id": [], "score": []}).astype({"cid": "int64", "vec_id": "int64", "score": "float64"})
        v = np.stack(right["embedding"].to_numpy()).astype(np.float64)
        norm = np.sqrt((v * v).sum(axis=1))
        ids = right["ids"].to_numpy()
        out: list[tuple] = []
        for cid, e in zip(left["cid"], left["embedding"]):
            q = np.asarray(e, np.float64)
            s = (v * q).sum(axis=1) / (norm * np.sqrt((q * q).sum()))
            top = np.argsort(-s, kind="stable")
            top = top[s[top] >= s[top[min(k, len(top) - 1)]]]  # k + 1 entries, and those equal to the last
            best = sorted((-s[j], int(x)) for j in top for x in ids[j])[:k + 1]
            out.extend((cid, x, -neg) for neg, x in best)
        return pd.DataFrame(out, columns=["cid", "vec_id", "score"])

    found = (asked.groupBy("list", "block").cogroup(dealt.groupBy("list", "block"))
             .applyInPandas(score, "cid long, vec_id long, score double"))
    by_class = Window.partitionBy("cid").orderBy(F.desc("score"), "vec_id")
    best = (found.groupBy("cid", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("r", F.row_number().over(by_class)).where(F.col("r") <= k + 1).drop("r"))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (queries.select("query_id", "cid").join(best, "cid").where("query_id <> vec_id")
            .withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
