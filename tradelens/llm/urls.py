"""URL filter: rules first, then logistic regression on hashed character n-grams.

The n-grams (3 to 5 bytes) of host and path are hashed into a fixed number of
weights.  The regression learns from a small table of labelled URLs: at most
``sample`` of the pages that the rules decide, or any table that is given.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no
rule and is judged by the model's intercept; without labelled rows everything
undecided is allowed; repeated rows are judged each; an empty table gives
an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm import scan

BUCKETS = 1 << 15
SIZES = (3, 4, 5)
#: Labelled URLs that the regression learns from, at most.
SAMPLE = 20_000


def parts(url) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), path


def matching(rules: Sequence[tuple[str, str]], host, path) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def features(host: pa.Array, path: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of every n-gram; a row's values have length 1."""
    rows, buckets = [], []
    for field, arr in enumerate((host, path)):
        data, off = scan.string_bytes(arr)
        values = scan.byte_values(data)
        owner = np.repeat(np.arange(len(arr)), np.diff(off))
        for n in SIZES:
            h = scan.gram_hashes(values, n)
            inside = np.flatnonzero(owner[:len(h)] == owner[n - 1:n - 1 + len(h)]) if len(h) else np.empty(0, np.int64)
            rows.append(owner[inside])
            buckets.append((scan.mix(h[inside] + np.uint64(field)) % np.uint64(BUCKETS)).astype(np.int64))
    row, bucket = np.concatenate(rows), np.concatenate(buckets)
    count = np.bincount(row, minlength=len(host))
    return row, bucket, 1 / np.sqrt(np.maximum(count[row], 1))


class Regression:
    """Logistic regression with a small ridge, fitted by Adam on all rows at once."""

    def __init__(self):
        self.weights, self.intercept = np.zeros(BUCKETS), 0.0

    def margin(self, row, bucket, value, n: int) -> np.ndarray:
        return np.bincount(row, self.weights[bucket] * value, minlength=n) + self.intercept

    def fit(self, host: pa.Array, path: pa.Array, label: np.ndarray, rounds: int = 150, rate: float = 0.1, ridge: float = 1e-5):
        row, bucket, value = features(host, path)
        m = s = np.zeros(BUCKETS + 1)
        for step in range(1, rounds + 1):
            off = (1 / (1 + np.exp(-np.clip(self.margin(row, bucket, value, len(label)), -30, 30))) - label) / len(label)
            d = np.append(np.bincount(bucket, off[row] * value, minlength=BUCKETS) + ridge * self.weights, off.sum())
            m, s = 0.9 * m + 0.1 * d, 0.999 * s + 0.001 * d * d
            move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
            self.weights, self.intercept = self.weights - move[:-1], self.intercept - move[-1]
        return self


def train(labelled: DataFrame, sample: int = SAMPLE) -> Regression:
    """Fit on at most ``sample`` rows of host, path, label (1: allow), chosen by hash."""
    rows = (labelled.select("host", "path", "label").distinct()
            .orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(sample).collect())
    if not rows:
        return Regression()
    column = lambda c: pa.array([r[c] for r in rows], pa.string())
    return Regression().fit(column("host"), column("path"), np.array([r["label"] for r in rows], float))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], labelled: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the model's probability of allow)."""
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matching(rules, F.col("host"), F.col("path"))
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("decided"))
    if labelled is None:
        labelled = rows.where("decided is not null").select("host", "path", (F.col("decided") == "allow").cast("int").alias("label"))
    shared = pages.sparkSession.sparkContext.broadcast(train(labelled, sample))  # BUCKETS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in scan.slices(batch, "path")):
            margin = shared.value.margin(*features(b.column("host"), b.column("path")), b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(margin, -30, 30))))],
                                             names=[*b.schema.names, "score"])

    kind = dict(pages.dtypes)["page_id"]
    scored = rows.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, decided string, score double")
    return scored.select("page_id", "host", "path", "rule", F.coalesce(
        "decided", F.when(F.col("score") >= 0.5, F.lit("allow")).otherwise(F.lit("block"))).alias("verdict"), "score")
