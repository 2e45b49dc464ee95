"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters slide over the whole document in
overlapping windows; activations are max-pooled within overlapping chunks,
and the chunks' pooled values are combined (their mean, maximum and minimum)
by a small dense layer into one probability of label 1.  Gradients flow only
through the pooled maxima, so training costs little more than scoring.

The network is fitted on the driver from the whole texts of a bounded sample of
labelled rows: at most ``Params.sample``, and fewer once they hold
``Params.sample_bytes``.  Every whole text is scored, a task at a time, in
slices of bounded size.

Defined cases: null text is empty; an empty text is scored as one window of zero
bytes; labels that are null, not 0 or 1, or contradict each other for one
doc_id are not learned from; without any labels the score is 0.5; repeated
rows are scored each; an empty table gives an empty result; further columns
are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm import scan
from tradelens.llm.frames import quoted


@dataclass(frozen=True)
class Params:
    """``sample``, ``sample_bytes``: the bound of what is learned from, in whole texts."""

    sample: int = 4000
    sample_bytes: int = 64 << 20
    embed: int = 6
    width: int = 8
    stride: int = 4
    filters: int = 32
    chunk: int = 128   # windows in one chunk
    hop: int = 96      # windows from one chunk to the next
    hidden: int = 16
    epochs: int = 10
    batch: int = 32
    rate: float = 3e-3
    seed: int = 7
    threshold: float = 0.3


class ByteCNN:
    """The network; parameters are float32 arrays in ``w``."""

    def __init__(self, p: Params):
        self.p = p
        g = np.random.default_rng(p.seed)
        n = lambda *s, scale: (g.standard_normal(s) * scale).astype(np.float32)
        fan = p.embed * p.width
        self.w = {"embed": n(256, p.embed, scale=0.5), "filters": n(fan, p.filters, scale=fan ** -0.5),
                  "bias": np.zeros(p.filters, np.float32), "dense": n(3 * p.filters, p.hidden, scale=(3 * p.filters) ** -0.5),
                  "dense_bias": np.zeros(p.hidden, np.float32), "out": n(p.hidden, scale=p.hidden ** -0.5),
                  "out_bias": np.zeros(1, np.float32)}

    def layout(self, sizes: np.ndarray):
        """Padded sizes, windows and chunks of documents with ``sizes`` bytes."""
        p = self.p
        windows = np.maximum(1, -(-(sizes - p.width) // p.stride) + 1)
        chunks = np.maximum(1, -(-(windows - p.chunk) // p.hop) + 1)
        return (windows - 1) * p.stride + p.width, windows, chunks

    def forward(self, data: np.ndarray, off: np.ndarray, keep: bool = False):
        p, w = self.p, self.w
        sizes = np.diff(off)
        padded, windows, chunks = self.layout(sizes)
        starts = np.cumsum(padded) - padded
        text = np.zeros(int(padded.sum()), np.uint8)
        text[np.arange(len(data)) + np.repeat(starts - off[:-1], sizes)] = data
        first = np.cumsum(windows) - windows
        at = np.arange(int(windows.sum())) * p.stride + np.repeat(starts - first * p.stride, windows)
        act = np.empty((len(at), p.filters), np.float32)
        tables = np.stack([w["embed"] @ w["filters"][j * p.embed:(j + 1) * p.embed] for j in range(p.width)])
        for i in range(0, len(at), 16_384):  # a window's response is the sum of its bytes' table rows
            here = at[i:i + 16_384]
            part = tables[0].take(text[here], axis=0)
            for j in range(1, p.width):
                part += tables[j].take(text[here + j], axis=0)
            act[i:i + 16_384] = part
        act += w["bias"]
        lo = np.arange(int(chunks.sum())) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        lo = np.repeat(first, chunks) + lo * p.hop
        hi = np.minimum(lo + p.chunk, np.repeat(first + windows, chunks))
        bounds = np.stack([lo, hi], axis=1).ravel()
        act = np.concatenate([act, np.zeros((1, p.filters), np.float32)])
        pooled = np.maximum.reduceat(act, bounds, axis=0)[::2]
        begin = np.cumsum(chunks) - chunks
        mean = np.add.reduceat(pooled, begin, axis=0) / chunks[:, None].astype(np.float32)
        top, low = np.maximum.reduceat(pooled, begin, axis=0), np.minimum.reduceat(pooled, begin, axis=0)
        feats = np.concatenate([mean, top, low], axis=1)
        hidden = np.tanh(feats @ w["dense"] + w["dense_bias"])
        prob = 1 / (1 + np.exp(-np.clip(hidden @ w["out"] + w["out_bias"], -30, 30)))
        if not keep:
            return prob.astype(np.float64)
        return prob, (text, at, act, lo, hi, pooled, chunks, begin, top, low, feats, hidden)

    def gradients(self, data: np.ndarray, off: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, w = self.p, self.w
        prob, (text, at, act, lo, hi, pooled, chunks, begin, top, low, feats, hidden) = self.forward(data, off, keep=True)
        g = {}
        d = ((prob - label) / len(label)).astype(np.float32)
        g["out"], g["out_bias"] = hidden.T @ d, d.sum(keepdims=True)
        dh = d[:, None] * w["out"] * (1 - hidden ** 2)
        g["dense"], g["dense_bias"] = feats.T @ dh, dh.sum(axis=0)
        df = dh @ w["dense"].T
        f = p.filters
        owner = np.repeat(np.arange(len(chunks)), chunks)
        dp = df[owner, :f] / chunks[owner, None].astype(np.float32)
        dp += df[owner, f:2 * f] * (pooled == top[owner]) + df[owner, 2 * f:] * (pooled == low[owner])
        best = np.stack([lo[i] + act[lo[i]:hi[i]].argmax(axis=0) for i in range(len(lo))])  # window of each maximum
        g["bias"] = dp.sum(axis=0)
        g["filters"], g["embed"] = np.zeros_like(w["filters"]), np.zeros_like(w["embed"])
        for j in range(p.width):
            b = text[at[best] + j]
            rows = slice(j * p.embed, (j + 1) * p.embed)
            g["filters"][rows] = np.einsum("cfe,cf->ef", w["embed"][b], dp)
            np.add.at(g["embed"], b.ravel(), (dp[:, :, None] * w["filters"][rows].T[None]).reshape(-1, p.embed))
        return g

    def fit(self, texts: list[bytes], labels: np.ndarray) -> ByteCNN:
        """Adam on the cross entropy, whole texts in shuffled batches."""
        p, step = self.p, 0
        g = np.random.default_rng(p.seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        for epoch in range(p.epochs):
            order = g.permutation(len(texts))
            rate = p.rate * (1 - epoch / p.epochs)
            for i in range(0, len(order), p.batch):
                pick = order[i:i + p.batch]
                part = [texts[j] for j in pick]
                off = np.concatenate([[0], np.cumsum([len(x) for x in part])]).astype(np.int64)
                step += 1
                for k, d in self.gradients(np.frombuffer(b"".join(part), np.uint8), off, labels[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * d
                    s[k] = 0.999 * s[k] + 0.001 * d * d
                    self.w[k] = self.w[k] - (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


def held_out(doc_id) -> F.Column:
    """Rows that are never learned from: crc32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> ByteCNN | None:
    """Fit on whole labelled documents in the order of their ids' hash, until ``p.sample`` rows or ``p.sample_bytes`` are reached."""
    agreed = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
              .where("quality = most").select("doc_id", "quality"))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    sample = agreed.join(known, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.sample)
    text = F.coalesce(F.col("text"), F.lit(""))
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
             .join(F.broadcast(sample), "doc_id")  # at most p.sample pairs of numbers
             .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id"))
    rows, size = [], 0
    for r in found.toLocalIterator():  # a partition at a time; the row that reaches the bound is still whole
        rows.append((r["doc_id"], r["text"].encode(), r["quality"]))
        size += len(rows[-1][1])
        if size >= p.sample_bytes:
            break
    if not rows:
        return None
    rows.sort()
    return ByteCNN(p).fit([text for _, text, _ in rows], np.array([label for _, _, label in rows], np.float32))


def score(docs: DataFrame, model: ByteCNN | None, columns: list[str], name: str = "score") -> DataFrame:
    """``columns`` (with text among them or not) and the score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    own = [f"c{i}" for i in range(len(columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in scan.slices(batch)):
            data, off = scan.string_bytes(b.column("text"))
            s = shared.value.forward(data, off) if shared.value else np.full(b.num_rows, 0.5)
            yield pa.record_batch([*(b.column(c) for c in own), pa.array(s)], names=[*own, "score"])

    rows = docs.select(*(F.col(quoted(c)).alias(x) for c, x in zip(columns, own)), "text")
    types = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return rows.mapInArrow(run, ", ".join([*types, "score double"])).select(
        *(F.col(x).alias(c) for c, x in zip(columns, own)), F.col("score").alias(name))


def classify(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= the threshold)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(rows, train(docs, labels, p), ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= p.threshold, 1).otherwise(0).alias("predicted"))
