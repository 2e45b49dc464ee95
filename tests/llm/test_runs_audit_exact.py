"""Periodic runs, filter audit and exact dedup against brute force, with the defined edge cases."""

import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from tradelens.llm import audit, exact, periodic  # noqa: E402
from tradelens.llm.frames import prepare  # noqa: E402

SCHEMA = ("doc_id long, text string, lang string, n int, h int, _text string, _edit int, _w int, c0 int, runs int, part string, sha string, "
          "failed int, least int, keep_id int, kept int, found int, id int, sha256 string, words int, shard int, term int")
EXTRA = (1, 2, "x", 4, 5, 6, 7, "p", "s", 8, 9, 10, 11, 12, 13, "z", 14, 15, 16)


def texts():
    g = random.Random(5)
    word = lambda: g.choice(["a", "b", "Ab", "é", "#x", "longer", "9"])
    out = [None, "", " \t\n", "a", "a a a a a a", "a a a a a", "x " * 40 + "y", "A B " * 30, "\x85\xa0 a", "10% OFF & more"]
    for q in (1, 2, 3, 5, 15, 16, 17, 18, 31, 32, 33, 48, 64, 65, 100):
        root = [f"w{g.randrange(400)}" for _ in range(q)]
        n = 4 * q + g.randint(0, 2 * q)
        out.append(" ".join(["p", *[root[i % q] for i in range(n)], "s"] + [f"v{i}" for i in range(g.randint(0, 9))]))
        out.append(" ".join(root[i % q] for i in range(max(4 * q - 1, 1))))
    out += [" ".join(word() for _ in range(g.randint(0, 300))) for _ in range(40)]
    out += [" ".join(f"u{i}" for i in range(g.randint(90, 130))) for _ in range(12)]
    nested = (["a", "b"] * 5 + ["c"]) * 6
    out += [" ".join(nested), " ".join(nested * 2 + ["d"]), "x" * 4000, " ".join(f"t{i % 700}" for i in range(3000))]
    return out


ROWS = [(i, t, [None, "", "en", "de"][i % 4]) for i, t in enumerate(texts(), 50)]
ROWS += [ROWS[7], ROWS[7], ROWS[9], (7, ROWS[12][1], "en"), (900, ROWS[60][1], "fr"), (900, "other text", "en"), (None, ROWS[12][1], "en"),
         (None, None, None), (None, "only here", "en"), (None, "only here", "en")]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame([(*r, *EXTRA) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_periodic_runs(docs, none):
    same(periodic.digest(periodic.planted(docs)).collect(), [brute.runs_digest(d, t) for d, t, _ in ROWS])
    same(periodic.periodic_runs(docs, ("doc_id",)).select("doc_id", "n_words", F.col("runs").cast("string"), "collapsed").limit(0).collect(), [])
    assert periodic.digest(periodic.planted(none)).collect() == []


def test_periodic_runs_of_other_columns(docs):
    got = periodic.periodic_runs(docs, ("id", "lang", "doc_id")).collect()
    want = {(d, t): brute.periodic_runs(brute.WORD.findall(t or "")) for d, t, _ in ROWS}
    assert sorted([tuple(x) for x in r.runs] for r in got) == sorted(want[d, t] for d, t, _ in ROWS)
    assert {r.id for r in got} == {13}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 7)), max_size=6))
def test_runs_of_made_words(pieces):
    """Several documents at once; powers of roots up to 40 words long."""
    each = [(root * times) for root, times in pieces]
    each.append([x for d in each for x in d])
    off = np.concatenate([[0], np.cumsum([len(d) for d in each])])
    got = periodic.Finder(np.array([x for d in each for x in d], np.int64), off, periodic.Rule()).find()
    want = [(int(off[i]) + s, q, int(off[i]) + s + n) for i, d in enumerate(each) for s, n, q in brute.periodic_runs(d)]
    assert got == sorted(want)


def test_long_periods_by_minimizers():
    g = random.Random(9)
    for q in (17, 64, 129, 700, 2049):
        root = [g.randrange(50) for _ in range(q)]
        words = [g.randrange(50) for _ in range(300)] + root * 4 + root[:g.randrange(q)] + [g.randrange(50) for _ in range(300)]
        found = periodic.Finder(np.array(words, np.int64), np.array([0, len(words)]), periodic.Rule()).find()
        (a, p, b), = [r for r in found if r[1] > 16]
        assert p == q and all(words[i] == words[i + q] for i in range(a, b - q))
        assert words[a - 1] != words[a - 1 + q] and words[b] != words[b - q] and a <= 300 and b >= 300 + 4 * q


def test_runs_of_few_words():
    g = random.Random(2)
    words = [g.randrange(2) for _ in range(400)] + [g.randrange(9) for _ in range(20)] * 6 + [g.randrange(2) for _ in range(90)]
    got = periodic.Finder(np.array(words), np.array([0, len(words)]), periodic.Rule()).find()
    assert got == sorted((s, q, s + n) for s, n, q in brute.periodic_runs(words))
    with pytest.raises(ValueError):
        periodic.Rule(exponent=3)


@pytest.mark.parametrize("shard_bytes", [1, 900, 8 << 20])
def test_filter_audit(spark, docs, none, shard_bytes):
    g = random.Random(1)
    marks = {d: (g.randint(0, 1), g.randint(0, 1)) for d, _, _ in ROWS if d is not None and d % 3}
    extra = [(d, 0, 0) for d in list(marks)[:5]] + [(None, 1, 1), (99999, 1, 1)]
    labels = spark.createDataFrame([(d, q, t) for d, (q, t) in marks.items()] + extra, "doc_id long, quality int, toxic int")
    want = brute.audit(ROWS, marks)
    same(audit.audit(docs, labels, shard_bytes=shard_bytes).collect(), want)
    assert len(want) == 600 * len({x or "" for _, _, x in ROWS})
    if shard_bytes == 1:
        assert audit.audit(none, labels).collect() == []
        same(audit.audit(docs, labels.where("false")).select("good_lost", "toxic_lost").distinct().collect(), [(0, 0)])


def test_matrix_counts(docs):
    got = audit.matrix(docs, shard_bytes=2000).select("n_words", "n_distinct").collect()
    same(got, [(len(w), len(set(w))) for w in (brute.WORD.findall(t or "") for _, t, _ in ROWS)])


@pytest.mark.parametrize("held_words", [1, 40, 1 << 20])
def test_words_leave_by_shard(monkeypatch, held_words):
    """A task sends one row per shard and held words, not one per word."""
    monkeypatch.setattr(audit, "HELD_WORDS", held_words)
    monkeypatch.setattr(audit.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})()))
    g = random.Random(4)
    shards = {s: g.sample([f"w{i}" for i in range(300)], 100) for s in (7, 2, 5 << 32)}
    rows = sorted((w, s, i) for s, words in shards.items() for i, w in enumerate(words))
    batches = [pa.record_batch([pa.array(c) for c in zip(*rows[at:at + 30])], names=["word", "shard", "local"]) for at in range(0, len(rows), 30)]
    batches.insert(1, batches[0].slice(0, 0))
    got = [r for b in audit._numbered(iter(batches)) for r in b.to_pylist()]
    assert len(got) <= len(shards) * -(-len(rows) // max(held_words, 30))
    numbers = {s: audit._numbers([r for r in got if r["shard"] == s]).tolist() for s in shards}
    number_of = {w: n for s, words in shards.items() for w, n in zip(words, numbers[s])}
    assert all(number_of[w] == n for s, words in shards.items() for w, n in zip(words, numbers[s]))
    assert len(set(number_of.values())) == len(number_of) and min(number_of.values()) > 3 << 40
    assert audit._numbers(None).tolist() == []


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(docs, none, keep):
    want = brute.exact_copies([(d, t) for d, t, _ in ROWS], keep == "largest")
    same(exact.exact_dedup(docs, keep=keep).collect(), want)
    assert exact.exact_dedup(none, keep=keep).collect() == []


def test_exact_dedup_compares_bytes(docs):
    """With a hash that collides for most texts, the groups stay those of equal texts."""
    want = brute.exact_copies([(d, t) for d, t, _ in ROWS])
    same(exact.exact_dedup(docs, hashed=lambda t: F.unhex(F.hex((F.length(t) % 3).cast("string")))).collect(), want)


def test_exact_dedup_of_normalised_texts(docs):
    want = brute.exact_copies([(d, (t or "").lower()) for d, t, _ in ROWS])
    same(exact.exact_dedup(docs, normalise=F.lower).collect(), want)


def test_exact_dedup_many_identical_rows(spark):
    rows = spark.range(25_000).select(F.lit(3).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = exact.exact_dedup(rows)
    assert got.count() == 25_000 and got.where("kept").count() == 1 and got.agg(F.min("group_size")).first()[0] == 25_000
    plan = exact.exact_dedup(rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
