"""Document fingerprints: consistent weighted sampling.

Terms are five-word shingles weighted by how often they occur (a shorter text
is one term).  For each of ``samples`` independent samples every term draws
r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1) from its own hash; with weight w,
t = floor(ln w / r + b), ln y = r (t - b) and ln a = ln c - ln y - r.  The term
of least a is the sample, identified by (term, t).  Two texts agree in a sample
with the probability of their generalised Jaccard similarity, so the share of
equal samples estimates it.

Neighbours in descending doc_id meet in buckets of doc_id ranges; each bucket
also gets the first document of the bucket that follows, so no bucket needs
another one.

Defined cases: null text is empty; a text without words has the empty
fingerprint, two of them are alike to 1, and to 0 with any other; rows with
equal doc_id are ordered by their text's hash; a null doc_id comes last; an
empty table gives an empty result; a single document is its own next one;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm import scan

WORDS = 5
SAMPLES = 64
#: Characters of text that a bucket of neighbours aims at.
BUCKET_CHARS = 4 << 20
#: Buckets at most; above that they grow with the data and are sorted by Spark, with spilling.
MAX_BUCKETS = 2048
_U = np.uint64


def _gamma2_quantiles(n: int = 1 << 16) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at (i + 0.5) / n, by Newton steps on 1 - exp(-x)(1 + x)."""
    p = (np.arange(n) + 0.5) / n
    x = np.sqrt(2 * p) + p
    for _ in range(60):
        x = np.maximum(x - (1 - np.exp(-x) * (1 + x) - p) / (x * np.exp(-x)), x / 2)
    return x


class Sampler:
    """Consistent weighted samples of many weighted sets at once."""

    def __init__(self, samples: int):
        gamma = _gamma2_quantiles()
        self.r = gamma.astype(np.float32)
        self.log_c = np.log(gamma).astype(np.float32)
        self.keys = [np.frombuffer(hashlib.blake2b(f"sample{i}".encode(), digest_size=16).digest(), _U) | _U(1)
                     for i in range(samples)]

    def __call__(self, terms: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(sets, samples) identities; set i has terms[starts[i]:starts[i + 1]], all sets non-empty."""
        log_w = np.log(weights).astype(np.float32)
        out = np.empty((len(starts), len(self.keys)), np.uint32)
        unit = np.float32(1 / 65536)
        for s, (mul, add) in enumerate(self.keys):
            g = terms * mul
            g ^= g >> _U(32)
            g *= add
            r = self.r[(g >> _U(48)).astype(np.int64)]
            b = ((g >> _U(16)) & _U(0xFFFF)).astype(np.float32) * unit
            t = np.floor(log_w / r + b)
            log_a = self.log_c[((g >> _U(32)) & _U(0xFFFF)).astype(np.int64)] - r * (t - b + np.float32(1))
            place = (log_a + np.float32(4096)).view(np.uint32).astype(_U) << _U(32)  # positive floats order as integers
            name = ((g ^ (t.astype(np.int64).view(_U) * scan._LEVEL[5])) * scan._LEVEL[6]) >> _U(32)
            out[:, s] = (np.minimum.reduceat(place | name, starts) & _U(0xFFFFFFFF)).astype(np.uint32)
        return out


def weighted_terms(data: np.ndarray, off: np.ndarray, k: int = WORDS):
    """Distinct shingles with their counts: (document, term, weight), sorted by document."""
    starts, ends, by_doc = scan.words(data, off)
    h = scan.word_hashes(data, starts, ends, lower=False)
    sizes = np.diff(by_doc)
    grams = scan.gram_hashes(h, k)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    valid = np.flatnonzero(doc[:len(grams)] == doc[k - 1:k - 1 + len(grams)]) if len(grams) else np.empty(0, np.int64)
    docs, terms = [doc[valid]], [grams[valid]]
    for i in np.flatnonzero((sizes > 0) & (sizes < k)):
        docs.append(np.array([i]))
        terms.append(scan.gram_hashes(h[by_doc[i]:by_doc[i + 1]], int(sizes[i])))
    both = np.sort((np.concatenate(docs).astype(_U) << _U(44)) | (np.concatenate(terms) >> _U(20)))
    if not len(both):
        return np.empty(0, np.int64), both, np.empty(0)
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    weight = np.diff(np.concatenate([first, [len(both)]]))
    return (both[first] >> _U(44)).astype(np.int64), both[first] & _U((1 << 44) - 1), weight


def signatures(arr: pa.Array, sampler: Sampler) -> tuple[np.ndarray, np.ndarray]:
    """(non-empty flags, samples) for every text of an Arrow array."""
    data, off = scan.string_bytes(arr)
    doc, term, weight = weighted_terms(data, off)
    sig = np.zeros((len(off) - 1, len(sampler.keys)), np.uint32)
    has, starts = np.unique(doc, return_index=True)
    if len(has):
        sig[has] = sampler(scan.mix(term), weight, starts)
    full = np.zeros(len(off) - 1, bool)
    full[has] = True
    return full, sig


def likeness(a_full, a, b_full, b) -> np.ndarray:
    """Share of equal samples; two empty sets are alike, an empty and another are not."""
    return np.where(a_full & b_full, (a == b).mean(axis=1), (a_full == b_full).astype(float))


def _hex(full: np.ndarray, sig: np.ndarray) -> pa.Array:
    return pa.array([s.astype(">u4").tobytes().hex() if f else "" for f, s in zip(full, sig)], pa.string())


def neighbours(docs: DataFrame, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """Rows in descending doc_id order, within buckets that end with the head of the next bucket.

    Columns bucket, head (1 for that last row), doc_id, text.  The buckets form a ring.  At most
    ``MAX_BUCKETS`` cut points and first doc_ids pass through the driver.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    grid = ", ".join(repr(i / MAX_BUCKETS) for i in range(1, MAX_BUCKETS))
    stat = rows.agg(F.sum(F.length("text")).alias("chars"),
                    F.expr(f"approx_percentile(doc_id, array({grid}), 100000)").alias("cuts")).first()
    n = min(MAX_BUCKETS, int((stat["chars"] or 0) // bucket_chars) + 1)
    cuts = sorted({stat["cuts"][i * MAX_BUCKETS // n - 1] for i in range(1, n)}) if stat["cuts"] else []
    below = F.size(F.filter(F.lit(cuts).cast("array<long>"), lambda c: F.col("doc_id") < c)) if cuts else F.lit(0)
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(MAX_BUCKETS)).otherwise(below))
    first = {r["bucket"]: r["top"] for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()}
    used = sorted(first)
    is_first = F.col("doc_id").isin([v for v in first.values() if v is not None])
    if MAX_BUCKETS in first:
        is_first = is_first | F.col("doc_id").isNull()
    earlier = F.create_map(*[F.lit(x) for i, b in enumerate(used) for x in (b, used[i - 1])]) if used else None
    heads = (rows.where(is_first).groupBy("bucket", "doc_id").agg(F.min_by("text", "tie").alias("text"), F.min("tie").alias("tie"))
             .withColumn("bucket", earlier[F.col("bucket")] if used else F.col("bucket")).withColumn("head", F.lit(1)))
    return (rows.withColumn("head", F.lit(0)).unionByName(heads).repartition("bucket")
            .sortWithinPartitions("bucket", "head", F.col("doc_id").desc_nulls_last(), "tie")
            .select("bucket", "head", "doc_id", "text"))


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint(docs: DataFrame, samples: int = SAMPLES, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first ones of the
    next document in descending doc_id order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        held = None  # a row whose follower has not come yet
        for b in (p for batch in batches for p in scan.slices(batch)):
            full, sig = signatures(b.column("text"), sampler)
            head = b.column("head").to_numpy()
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            if held is not None:
                full, sig = np.concatenate([held[0], full]), np.concatenate([held[1], sig])
                head, ids, texts = np.concatenate([held[2], head]), held[3] + ids, held[4] + texts
            held = full[-1:], sig[-1:], head[-1:], ids[-1:], texts[-1:]
            own = np.flatnonzero(head[:-1] == 0)
            if not len(own):
                continue
            edited = [_edited(texts[i], texts[i + 1]) for i in own]
            e_full, e_sig = signatures(pa.array(edited, pa.string()), sampler)
            yield pa.record_batch([
                pa.array([ids[i] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                _hex(full[own], sig[own]), _hex(e_full, e_sig),
                pa.array(likeness(full[own], sig[own], e_full, e_sig)),
                pa.array(likeness(full[own], sig[own], full[own + 1], sig[own + 1]))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return neighbours(docs, bucket_chars).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
