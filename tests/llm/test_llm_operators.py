"""Training-data operators against brute force, with the defined edge cases."""

import os
import random
import re
import sys
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
import public_tokenizers  # noqa: E402
import tiktoken  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402
from tradelens.llm import (  # noqa: E402
    ann, bpe, fingerprints, graph, jaccard, packing, pii, quality, registry, substring_dedup, suffix_dedup, urls)
from tradelens.llm.frames import prepare  # noqa: E402
from tradelens.llm.q_classify import RULES  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, key string, n int, h int, size int, score int, bucket int, head int, marks string, starts int"


def corpus():
    """Nulls, empty and very long texts, ties, repeated rows, near copies, shared passages, other alphabets."""
    g = random.Random(11)
    vocabulary = ["".join(g.choice("abcdefghé") for _ in range(g.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(g.choice(vocabulary) for _ in range(n))
    shared, base = prose(60), prose(90).split(" ")
    texts = [None, "", " ", "\n\t ", "a", "A b", "😀" * 90, "x" * 900, prose(9000), prose(40), prose(45)]
    texts += [prose(g.randint(0, 30)) + " " + shared + "\n" + prose(g.randint(0, 30)) for _ in range(6)]
    for _ in range(12):
        copy = list(base)
        for _ in range(g.randint(0, 2)):
            copy[g.randrange(len(copy))] = g.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [" ".join(base).upper(), shared, shared, "call +1 (743) 555-3824 a@b.co 1.2.3.4 or 4111 1111 1111 1111 é"]
    rows = list(enumerate(texts, 100))
    return rows + [rows[9], rows[9], rows[-1]]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame([(i, t, "k", 1, 2, 3, 4, 5, 6, "m", 7) for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("hot", [100_000, 2])
def test_suffix_dedup(docs, none, hot):
    want = [(i, *x) for (i, _), x in zip(ROWS, brute.repeated_bytes([t for _, t in ROWS]))]
    same(suffix_dedup.suffix_dedup(docs, hot=hot).collect(), want)
    assert suffix_dedup.suffix_dedup(none).collect() == []


@pytest.mark.parametrize("hot", [100_000, 2])
def test_substring_dedup(docs, none, hot):
    want = [(i, *x) for (i, _), x in zip(ROWS, brute.repeated_words([t for _, t in ROWS]))]
    same(substring_dedup.substring_dedup(docs, hot=hot).collect(), want)
    assert substring_dedup.substring_dedup(none).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=30), min_size=1, max_size=30), st.integers(0, 20))
def test_deep_shallow_order(strings, shallow):
    order, lcp = suffix_dedup.deep_shallow_sort(strings, 0, shallow)
    assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
    for a, b, n in zip(order, order[1:], lcp[1:]):
        assert n == len(os.path.commonprefix([strings[a], strings[b]]))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=120), st.integers(1, 9))
def test_matching_statistics(symbols, most):
    seq = np.array([*symbols, 0])
    index = substring_dedup.FMIndex(seq, 5, 16)
    ends = np.arange(1, len(symbols) + 1)
    for end, got in zip(ends, index.matched(seq, ends, most)):
        want = max(k for k in range(min(end, most) + 1) if k == 0 or sum(
            symbols[i:i + k] == symbols[end - k:end] for i in range(len(symbols) - k + 1)) > 1)
        assert got == want


def test_jaccard_join(docs, none):
    want = [(i, *x) for (i, _), x in zip(ROWS, brute.jaccard_components(ROWS))]
    same(jaccard.link(docs).collect(), want)
    assert jaccard.link(none).collect() == []


def test_jaccard_null_id(spark, docs):
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([(None, ROWS[9][1]), (None, None)], "doc_id long, text string"))
    got = jaccard.link(rows).where("doc_id is null").collect()
    assert sorted(r.n_shingles for r in got) == [0, len(brute.shingles(ROWS[9][1]))] and {r.component_id for r in got} == {None}


def test_jaccard_many_components(spark):
    """Sets around the threshold, in lists longer than a block."""
    g = random.Random(3)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(260):
        x = list(base)
        for _ in range(g.randint(0, 5)):
            x[g.randrange(40)] = f"v{g.randrange(60)}"
        rows.append((i, " ".join(x[:g.randint(20, 40)])))
    want = [(i, *x) for (i, _), x in zip(rows, brute.jaccard_components(rows))]
    same(jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect(), want)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 80), (80, 90)], "u long, v long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 80: 80, 90: 80}


def test_bpe_round_trip(docs, none):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = []
    for i, t in ROWS:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha((t or "").encode())))
    same(bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect(), want)
    assert bpe.round_trip(none, RANKS, public_tokenizers.PATTERN).collect() == []


CODECS = {}


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("ab ère!'s9\n\x1c\xa0", max_size=60), st.builds(lambda c, n: c * n, st.sampled_from("ab! é"), st.integers(1, 150))))
def test_bpe_tree(text):
    if not CODECS:
        ranks = bpe.read_ranks(RANKS)
        CODECS["library"] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        CODECS["own"] = bpe.Codec(ranks, public_tokenizers.PATTERN, leaf=1)
    text = text.encode("utf-8", "ignore").decode()
    ids = CODECS["own"].encode(text)
    assert ids == CODECS["library"].encode_ordinary(text) and CODECS["own"].decode(ids) == text.encode()


def test_bpe_halves_are_kept():
    codec, joined = bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN), []
    join = codec.join
    codec.join = lambda left, right: joined.append(1) or join(left, right)
    for data, joins in ((b"nationalthinking", 3), (b"nationalbetweens", 2), (b"betweensnational", 1)):
        joined.clear()
        assert codec.decode(codec.tree(data)) == data and len(joined) == joins


def test_bpe_decodes_lists_at_once(spark):
    prepare(spark)
    ranks = bpe.read_ranks(RANKS)
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    lists = [[], [5], None, list(range(250, 400)), [], [max(ranks.values())], [300] * 700]
    want = [None if x is None else b"".join(codec.bytes_of[i] for i in x) for x in lists]
    for at in range(len(lists)):
        assert codec.decode_lists(pa.array(lists, pa.list_(pa.int32())).slice(at, 3)).to_pylist() == want[at:at + 3]
    for bad in ([1, max(ranks.values()) + 1], [None]):
        with pytest.raises((KeyError, IndexError)):
            codec.decode_lists(pa.array([bad], pa.list_(pa.int32())))
    rows = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    assert {r.doc_id: None if r.decoded is None else bytes(r.decoded) for r in bpe.decode(rows, RANKS).collect()} == dict(enumerate(want))


def test_packing(docs, none):
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    rows = packing.pack(docs, WORDS, with_ids=True).collect()
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in ROWS}
    copies = {i: sum(j == i for j, _ in ROWS) for i, _ in ROWS}
    assert sum(r.length for r in rows) == sum(len(want[i]) * copies[i] for i in want)
    for r in rows:
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert r.ids == ids and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    for pieces in brute.grouped(rows, "sequence_id").values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 4096 or at & (at - 1) == 0
    assert packing.pack(none, WORDS).collect() == []


def test_packing_limits():
    limits = packing.Limits(tokens=64, segments=3, loss=20, pool=8)
    packer, g, rows = packing.Packer(limits, 0), random.Random(2), []
    for i in range(200):
        n = g.randint(1, 90)
        rows.extend(packer.add(packing.Example(i, bytes(4 * n), 0, g.randint(0, n))))
    rows.extend(packer.finish())
    for pieces in brute.grouped(rows, 5).values():
        assert sum(p[2] for p in pieces) <= 64 and len(pieces) <= 3


def test_fingerprints(docs, none):
    got = brute.grouped(fingerprints.fingerprint(docs, samples=128, bucket_chars=2000).collect(), "doc_id")
    order = sorted(dict(ROWS).items(), reverse=True)
    single = [(i, t) for i, t in order if sum(j == i for j, _ in ROWS) == 1]
    for i, t in single:
        at = order.index((i, t))
        following, t = order[(at + 1) % len(order)][1] or "", t or ""
        edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        (r,) = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == brute.sha(edited.encode())
        for near, other in ((r.near_edited, edited), (r.near_next, following)):
            a, b = brute.weighted_shingles(t), brute.weighted_shingles(other)
            assert abs(near - (sum((a & b).values()) / sum((a | b).values()) if a or b else 1)) < 0.2
    by_text = {}
    for i, t in ROWS:
        assert by_text.setdefault(t or "", got[i][0].fingerprint) == got[i][0].fingerprint
    assert len(got[ROWS[9][0]]) == 3 and fingerprints.fingerprint(none).collect() == []


def test_urls(spark):
    given_urls = [None, "", "no scheme", "http://", "HTTPS://A.Example.ORG/en/1?x", "http://example.org/es/2", "http://x.com/de/9",
                  "http://x.com/fr/9", "http://x.com:80/fr/#a", "http://org/", "http://org", "http://xorg/", "a://b://c/de/", "http://net/é"] * 2
    pages = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate(given_urls)], "page_id long, url string, host string, path string, rule string")
    got = urls.judge(pages, RULES).orderBy("page_id").collect()
    for u, r in zip(given_urls, got, strict=True):
        host, path, best = brute.url_rule(u, RULES)
        assert (r.host, r.path, r.rule) == (host, path, best and best[1]) and r.verdict in ("allow", "block")
        assert best is None or r.verdict == best[0]
    assert urls.judge(pages.limit(0), RULES).collect() == []
    assert {r.verdict for r in urls.judge(pages, ()).collect()} == {"allow"}


def test_url_model_learns(spark):
    rows = [(f"{w}{i}.net", f"/{i}", int(w == "good")) for i in range(60) for w in ("good", "spam")]
    labelled = spark.createDataFrame(rows, "host string, path string, label int")
    pages = spark.createDataFrame([(1, "http://good999.net/7"), (2, "http://spam999.net/7")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, (), labelled).collect()} == {1: "allow", 2: "block"}


def test_quality_learns(spark, none):
    g = random.Random(4)
    word = lambda: "".join(g.choice("abcdefgh") for _ in range(g.randint(2, 8)))
    rows = [(i, " ".join(word() + "$$$" * (i % 2) for _ in range(g.randint(5, 80)))) for i in range(400)]
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (1002, "q" * 300_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in rows] + [(0, 0), (2000, 1), (7, None)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 403 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert sum(r.predicted == 1 - r.doc_id % 2 for r in held) > 0.95 * len(held)
    assert quality.classify(none, labels).collect() == []
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_quality_learns_from_whole_texts(spark, monkeypatch):
    """Junk that begins after 17,000 characters; the bound of bytes takes fewer rows, all whole."""
    g = random.Random(13)
    word = lambda: "".join(g.choice("abcdefgh") for _ in range(g.randint(2, 8)))
    prefix = " ".join(word() for _ in range(3500))[:17_000]
    rows = [(i, prefix + " " + " ".join(word() + "$$$" * (i % 2) for _ in range(500))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in rows], "doc_id long, quality int")
    got = [r for r in quality.classify(docs, labels, quality.Params(batch=8, threshold=0.5)).collect() if r.held_out]
    assert len(got) > 10 and sum(r.predicted == 1 - r.doc_id % 2 for r in got) > 0.9 * len(got)
    taken = []
    monkeypatch.setattr(quality.ByteCNN, "fit", lambda self, texts, y: taken.append(texts) or self)
    quality.train(docs, labels, quality.Params())
    quality.train(docs, labels, quality.Params(sample_bytes=100_000))
    whole = {t.encode() for _, t in rows}
    assert set(taken[0]) | set(taken[1]) <= whole and len(taken[0]) == 120 - len(got)
    assert 100_000 <= sum(map(len, taken[1])) < 100_000 + max(map(len, whole))


def test_quality_gradients():
    p = quality.Params(embed=2, width=3, stride=2, filters=3, chunk=4, hop=3, hidden=2)
    net = quality.ByteCNN(p)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    g = np.random.default_rng(1)
    data, off, label = g.integers(0, 256, 90).astype(np.uint8), np.array([0, 0, 40, 90]), np.array([1.0, 0.0, 1.0])

    def loss():
        q = net.forward(data, off)
        return -np.mean(label * np.log(q) + (1 - label) * np.log(1 - q))

    for name, d in net.gradients(data, off, label).items():
        w, at = net.w[name], np.unravel_index(np.argmax(np.abs(d)), d.shape)
        keep = w[at]
        w[at] = keep + 1e-2
        up = loss()
        w[at] = keep - 1e-2
        slope = (up - loss()) / 2e-2
        w[at] = keep
        assert abs(slope - d[at]) < 0.1 * abs(d[at]) + 1e-3, name


def test_personal_data(docs, none, spark):
    g = random.Random(8)
    parts = ["a@b.c", "x", "@", ".", "1.2.3.4", "255", "256", "+1 (743) 555-3824", "4111111111111111", "4111 1111 1111 1111", " ", "-", "_", "😀", "+", "9", "\n"]
    texts = ["".join(g.choice(parts) for _ in range(g.randint(0, 25))) for _ in range(300)] + [t for _, t in ROWS] + ["9" * 20_000, "1 " * 5_000, "a." * 9_000]
    got = pii.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = brute.personal(texts[r.doc_id])
        base = ",".join(f"{k}:{a}:{b}" for k, x in spans.items() for a, b in x)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(len, spans.values()))
        assert r.base_sha256 == brute.sha(base.encode()) and r.spans.startswith(base)
    assert pii.digest(docs).count() == len(ROWS) and pii.digest(none).collect() == []


def test_addresses_with_zero_parts(spark):
    g = random.Random(9)
    parts = ["0", "00", "000", "007", "0255", "0256", "10.0.0.1", "0.0.0.0", "127.0.0.1", "1", "255", "256", ".", ".", ".", " "]
    texts = ["".join(g.choice(parts) for _ in range(g.randint(1, 15))) for _ in range(400)]
    texts += ["10.0.0.1", "127.0.0.1 192.168.0.1", "0" * 4_000 + ".0.0.0", "0" * 4_000 + "256.0.0.0"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = 0
    for r in pii.digest(docs).collect():
        spans = brute.personal(texts[r.doc_id])
        base = ",".join(f"{k}:{a}:{b}" for k, x in spans.items() for a, b in x)
        assert r.n_ip == len(spans["ip"]) and r.base_sha256 == brute.sha(base.encode()), texts[r.doc_id]
        found += r.n_ip
    assert found > 100
    assert {r.text for r in pii.redact(docs.where("doc_id = 400"), ["doc_id"]).collect()} == {"[IP]"}


def test_contexts_discover_identifiers(spark):
    g = random.Random(6)
    rows = [f'see token = "{"".join(g.choice("0123456789abcdef") for _ in range(38))}a1" here {i}' for i in range(30)]
    rows += ['the token = "Zk_77-Qx09PPvv" here', "the build Zk_99-Qx09PPvv here", "again Zk_77-Qx09PPvv 😀"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digest(docs).collect()}
    assert got[30] == f"id:{rows[30].index('Zk')}:{rows[30].index('Zk') + 14}" and got[31] == "" and got[32].startswith("id:6:")
    clean = {r.doc_id: r.text for r in pii.redact(docs, ["doc_id"]).collect()}
    assert clean[30] == 'the token = "[ID]" here' and clean[31] == rows[31]


def test_every_base_kind_seeds(spark):
    """A context of addresses vouches for the identifier of 200 characters that follows it elsewhere."""
    long = "Ab9_" * 50
    rows = [f"mail to: user{i}@site{i}.org please" for i in range(40)] + [f"mail to: {long} please", f"or {long} again", "or Zk_99-Qx09PPvv so"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digest(docs).collect()}
    assert got[40] == "id:9:209" and got[41] == "id:3:203" and got[42] == "" and got[0] == "email:9:24"


def _plain_identifiers(texts):
    """Accepted tokens by the stated rule, in plain Python, for texts of words and identifiers."""
    seeds, edges = set(), set()
    for t in texts:
        base = sorted(s for x in brute.personal(t).values() for s in x)
        hits = [(m.start(), m.end(), False) for m in re.finditer(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9][A-Za-z_-]*[0-9])[A-Za-z0-9_-]{8,}", t)]
        for kind, spans in ((True, base), (False, hits)):
            previous = 0
            for a, b, *_ in spans:
                gap, previous = t[previous:a], b
                if not kind and any(x < b and a < y for x, y in base):
                    continue
                pattern = " ".join(re.findall(r"[^\W\d_]+|[=:#]+", gap.lower())[-2:])
                edges.add((pattern, t[a:b]))
                if kind or re.fullmatch("(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{32,}", t[a:b]):
                    seeds.add(t[a:b])
    known, count = set(seeds), -1
    while count != len(known):
        count = len(known)
        by = {}
        for p, h in edges:
            by.setdefault(p, []).append(h in known)
        good = {p for p, x in by.items() if p and sum(x) >= pii.SUPPORT and sum(x) >= pii.CONFIDENCE * len(x)}
        known |= {h for p, h in edges if p in good}
    return known


def test_bootstrapping_against_the_rule(spark):
    """Chains of patterns that vouch for each other, over several rounds."""
    g = random.Random(4)
    ids = [f"Id{g.randrange(10**6)}x{i}" for i in range(60)]
    mails = [f"u{i}@s.org" for i in range(30)]
    contexts = ["write to ", "key is ", "code no ", "plain old ", "the the "]
    texts = []
    for _ in range(500):
        c = g.randrange(5)
        pool = (mails + ids[:3], ids[:10], ids[7:16], ids[20:60] + ids[:4], mails[:4] + ids[50:])[c]
        texts.append(f"so {contexts[c]}{g.choice(pool)} then")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = _plain_identifiers(texts)
    assert set(ids[:7]) & known and not set(ids[20:40]) & known
    for r in pii.digest(docs).collect():
        m = re.search(r"Id\d+x\d+", texts[r.doc_id])
        want = f"id:{m.start()}:{m.end()}" if m and m[0] in known else ""
        assert [x for x in r.spans.split(",") if x.startswith("id")] == [want] * bool(want)


@pytest.mark.parametrize("n", [10, 1_000, 100_000])
def test_many_matches_in_one_text(spark, n):
    """Work grows with the matches: each kind, secrets among them, in one text."""
    g = random.Random(n)
    kinds = [lambda i: f"id{i:08d}", lambda i: f"u{i}@site.org", lambda i: f"10.{i % 256}.0.1", lambda i: "4111 1111 1111 1111",
             lambda i: "+1 (743) 555-3824", lambda i: f"{g.getrandbits(160):040x}"]
    parts = [g.choice(kinds)(i) for i in range(n)]
    text = "; next = ".join(["é", *parts])
    docs = spark.createDataFrame([(1, text), (2, "none")], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    spans = brute.personal(text)
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == tuple(map(len, spans.values()))
    assert got[1].base_sha256 == brute.sha(",".join(f"{k}:{a}:{b}" for k, x in spans.items() for a, b in x).encode())
    ids = [tuple(map(int, x.split(":")[1:])) for x in got[1].spans.split(",") if x.startswith("id")]
    assert got[2].spans == "" and all(re.fullmatch("[0-9a-f]{40}|id[0-9]{8}", text[a:b]) for a, b in ids)
    clean = {r.doc_id: r.text for r in pii.redact(docs, ["doc_id"]).collect()}
    want, at = [], 0
    for a, b, k in sorted([(a, b, k) for k, x in spans.items() for a, b in x] + [(a, b, "id") for a, b in ids]):
        if a >= at:
            want += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    assert clean[1] == "".join(want) + text[at:] and clean[2] == "none"
    assert time.time() - began < 60


def test_words_of_constructed_collisions(spark):
    """A word and its complement over two letters, long enough to cancel in a hash that is linear in its letters."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    same_words = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{same_words} {word}"), (2, f"{same_words} {other}"), (3, f"{word} {word} {word} x"), (4, f"{other} {other} {other} x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_removed for r in substring_dedup.substring_dedup(docs).collect()} == {0}
    assert {r.doc_id: r.component_id for r in jaccard.link(docs.where("doc_id > 2")).collect()} == {3: 3, 4: 4}
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs.where("doc_id > 2")).collect()}
    assert prints[3] != prints[4]


def test_unlike_texts_of_one_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (1, b), (2, b + " more"), (3, a + " more"), (1, "lone words that none has"), (4, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.groups(docs).select("n_shingles", "least", "component_id", "key", "keeper").collect()
    assert {r.component_id for r in got} == {1} and len({r.keeper for r in got}) == 3
    kept = corpus_pipeline.near_copies(spark, docs, "").collect()
    assert sorted(r.text for r in kept) == sorted([a, b, "lone words that none has"])


CLASHES = ["email", "ip", "card", "phone", "ids", "_key", "key", "_kept", "kept", "_score", "score", "_text", "_null", "_tagged", "_walked", "row", "clean",
           "found", "least", "own", "id", "rest", "c0", "a.b", "n", "h"]


def test_pipeline_passes_any_column(spark):
    """Every stage but the last returns further columns as they came."""
    rows = [(i, t, "en", "s", len(t or ""), *(f"{c}-{i}" for c in CLASHES)) for i, t in dict(ROWS).items()]
    schema = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long", *(f"`{c}` string" for c in CLASHES)])
    docs = spark.createDataFrame(rows, schema)
    docs = docs.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "/root/testdata/sf0.001")
        assert got.columns == docs.columns and dict(got.dtypes) == dict(docs.dtypes), name
        for r in got.collect():
            assert r.m == {"k": r.doc_id} and all(r[c] == f"{c}-{r.doc_id}" for c in CLASHES), name


def test_near_copies_picks_one_row_by_a_stated_order(spark):
    text = ROWS[9][1]
    rows = [(5, text, x, "s", 1) for x in ("de", "en", "fr")] + [(6, text, "aa", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    for _ in range(2):
        kept = corpus_pipeline.near_copies(spark, docs.repartition(3), "").collect()
        assert [(r.doc_id, r.lang) for r in kept] == [(5, "de")]


def test_personal_data_stays_in_the_jvm(docs):
    plan = pii.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_nearest(spark):
    g = np.random.default_rng(5)
    v = g.standard_normal((3000, 8)).astype("float32")
    v[1000:2000] = v[7]
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    odd = [(5000, None, 0), (5050, [0.0] * 8, 0), (5100, [float("nan")] * 8, 0), (5150, [None] + [1.0] * 7, 0), (5200, [], 0),
           (5250, [1.0], 0), (None, [1.0] * 8, 0), rows[50], rows[50]]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = ann.nearest(table, F.col("vec_id") % 50 == 0, p=ann.Params(list_size=50, block=40)).collect()
    by, hits, total = brute.grouped(got, "query_id"), 0, 0
    assert set(by) == set(range(0, 3000, 50))
    d = v.astype(float)
    norm = np.sqrt((d * d).sum(axis=1))
    for q, found in by.items():
        s = (d * d[q]).sum(axis=1) / (norm * norm[q])
        s[q] = -9
        best = np.lexsort((np.arange(len(s)), -s))[:5]
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - s[r.vec_id]) < 1e-12 for r in found)
        hits, total = hits + len({r.vec_id for r in found} & set(best.tolist())), total + 5
    assert hits >= 0.9 * total
    copies = sorted(by[1000], key=lambda r: r.rank)
    assert [r.vec_id for r in copies] == [7, 1001, 1002, 1003, 1004]
    few = ann.nearest(table.where("vec_id in (0, 50, 51)"), F.col("vec_id") % 50 == 0).collect()
    assert {(r.query_id, r.vec_id) for r in few} == {(0, 50), (0, 51), (50, 0), (50, 51)}
    assert ann.nearest(table.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_pipeline(spark, tmp_dir):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, extra = docs.columns, docs.withColumn("_x", F.lit(1))
    extra = extra.union(spark.createDataFrame([(None, None, None, None, None, 1), (10**9, "", "en", "s", 0, 1)], extra.schema))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).collect() == []
        out = stage(spark, extra, sf)
        if name != "packing":
            assert out.columns == [*columns, "_x"] and dict(out.dtypes) == dict(extra.dtypes)
        out.write.parquet(f"{tmp_dir}/{name}")
        extra = spark.read.parquet(f"{tmp_dir}/{name}")
    pieces = extra.collect()
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())


def test_pipeline_stage_decisions(spark):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in dict(ROWS).items()]
    docs = spark.createDataFrame(rows + rows[9:11], "doc_id long, text string, lang string, source string, n_chars long")
    component = dict(zip([i for i, _ in ROWS], [c for _, c in brute.jaccard_components(ROWS)]))
    kept = [r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()]
    assert sorted(kept) == sorted(i for i in dict(ROWS) if component[i] == i)
    unique = docs.dropDuplicates(["doc_id"])
    ids = [i for i, _ in dict(ROWS).items()]
    want = dict(zip(ids, brute.repeated_words([dict(ROWS)[i] for i in ids])))
    for r in corpus_pipeline.repeated_passages(spark, unique, "").collect():
        n, removed, digest = want[r.doc_id]
        assert r.n_chars == (len(r.text) if r.text is not None else None)
        if removed:
            assert brute.sha(r.text.encode()) == digest
        else:
            assert r.text == dict(ROWS)[r.doc_id]


def test_pipeline_near_copies_rule(spark, monkeypatch):
    """Pairs on both sides of 0.8 on five-word shingles, many of them below 0.85 on four."""
    g, texts = random.Random(12), []
    for i in range(24):
        words = [f"w{i}x{j}" for j in range(200)]
        texts.append(words)
        texts.append(words + [f"v{i}x{j}" for j in range(30 + i)])
        edited = list(words)
        for j in g.sample(range(5, 195, 10), 3 + i % 4):
            edited[j] = "e"
        texts.append(edited)
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pairs = [r[:2] for r in rows]
    narrow = [c for _, c in brute.jaccard_components(pairs)]
    monkeypatch.setattr(brute.shingles, "__defaults__", (5,))
    wide = [c for _, c in brute.jaccard_components(pairs, 80)]
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert wide != narrow and kept == {i for i, c in enumerate(wide) if i == c}


def test_queries_are_registered():
    names = list(registry.load_all())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "substring dedup", "PII", "packing"]
