"""Suffix-array dedup: remove bytes that lie in a 200-byte string found elsewhere.

Method: deep-shallow sorting.  The suffixes that begin at content-chosen
anchors (a sparse suffix array, repeats.py) are dealt out by their first 48
bytes.  In a task a group is ordered by multikey quicksort on 8-byte chunks
down to a shallow depth; groups that are still equal there go into a blind
trie, which orders them and gives their common prefixes.  Merging neighbours
from the longest common prefix down, with each merged set ordered by its left
context, gives every anchor the widest repeated interval around it.

Defined cases: null text is empty; a text shorter than the window loses
nothing; repeated rows and equal texts are repeats of each other, so all their
bytes go if they are long enough; an empty table gives an empty result;
further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm import repeats, scan
from tradelens.llm.frames import distinct_texts, text_key

WINDOW = 200
ANCHOR = 48
#: Depth in bytes at which multikey quicksort hands over to blind tries.
SHALLOW = 72


def common_prefix(a: bytes, b: bytes, lo: int = 0) -> int:
    """Length of the common prefix, known to be at least ``lo``."""
    hi = min(len(a), len(b))
    if a[lo:hi] == b[lo:hi]:
        return hi
    while lo < hi:  # the prefix of length lo is equal, that of length hi is not
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class BlindTrie:
    """Patricia trie that stores only branching depths and bytes; strings are looked up to compare."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = None

    def _at(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def insert(self, i: int, known: int) -> None:
        if self.root is None:
            self.root = [i]  # a leaf: equal strings share it
            return
        node = self.root
        while isinstance(node, tuple):  # blind: only the branching bytes are looked at
            node = node[1].get(self._at(i, node[0])) or next(iter(node[1].values()))
        other = node[0]
        depth = common_prefix(self.strings[i], self.strings[other], known)
        if depth == len(self.strings[i]) == len(self.strings[other]):
            node.append(i)
            return
        parent, edge, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            parent, edge = node, self._at(i, node[0])
            node = node[1][edge]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][self._at(i, depth)] = [i]
            return
        split = (depth, {self._at(other, depth): node, self._at(i, depth): [i]})
        if parent is None:
            self.root = split
        else:
            parent[1][edge] = split

    def ordered(self) -> Iterator[tuple[int, int]]:
        """(string, common prefix with the one before) in order; the first has -1."""
        stack, lcp = [(self.root, -1)], -1
        while stack:
            node, above = stack.pop()
            if isinstance(node, tuple):
                kids = sorted(node[1].items(), reverse=True)
                stack.extend((kid, node[0]) for _, kid in kids[:-1])
                stack.append((kids[-1][1], above))
            else:
                for i in node:
                    yield i, above
                    above = len(self.strings[i])


def deep_shallow_sort(strings: list[bytes], known: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Suffix order and the common prefix of each with the one before (first: 0).

    All strings share their first ``known`` bytes.
    """
    order: list[int] = []
    lcp: list[int] = []

    def emit(i: int, with_previous: int) -> None:
        lcp.append(with_previous if with_previous >= 0 else (
            common_prefix(strings[order[-1]], strings[i], known) if order else 0))
        order.append(i)

    todo = [(list(range(len(strings))), known)]
    while todo:
        group, depth = todo.pop()
        if len(group) == 1:
            emit(group[0], -1)
        elif depth >= shallow:
            trie = BlindTrie(strings)
            for i in group:
                trie.insert(i, depth if depth <= len(strings[i]) else known)
            for i, common in trie.ordered():
                emit(i, common)
        else:
            pivot = strings[group[len(group) // 2]][depth:depth + 8]
            less, same, more = [], [], []
            for i in group:
                chunk = strings[i][depth:depth + 8]
                (less if chunk < pivot else more if chunk > pivot else same).append(i)
            if more:
                todo.append((more, depth))
            todo.append((same, depth + 8 if len(pivot) == 8 else shallow))
            if less:
                todo.append((less, depth))
    return order, lcp


def extents(ctxs: list[tuple[bytes, int]], window: int, k: int) -> list[tuple[int, int] | None]:
    """For each context the bytes left and right of its anchor that repeated windows cover.

    Every repeated window holds the anchor, so their union is one interval.
    """
    rights = [c[o:] for c, o in ctxs]
    lefts = [c[:o][::-1] for c, o in ctxs]
    best: list[list[int]] = [[0, 0] for _ in ctxs]

    def pair(a: int, b: int, right: int) -> None:
        left = common_prefix(lefts[a], lefts[b])
        if left + right >= window:
            for x in (best[a], best[b]):
                x[0], x[1] = max(x[0], left), max(x[1], right)

    if len(ctxs) == 2:
        pair(0, 1, common_prefix(rights[0], rights[1], k))
    else:
        order, lcp = deep_shallow_sort(rights, k)
        by_left, _ = deep_shallow_sort(lefts)
        rank = [0] * len(ctxs)
        for r, i in enumerate(by_left):
            rank[i] = r
        home = list(range(len(ctxs)))
        members: dict[int, list[int]] = {i: [rank[i]] for i in home}

        def find(i: int) -> int:
            while home[i] != i:
                home[i] = home[home[i]]
                i = home[i]
            return i

        least = window - max(o for _, o in ctxs)
        for at in sorted(range(1, len(order)), key=lambda j: -lcp[j]):
            right = lcp[at]
            if right < least:
                break
            a, b = find(order[at - 1]), find(order[at])
            if len(members[a]) < len(members[b]):
                a, b = b, a
            large, small = members[a], members.pop(b)
            for r in small:
                j = bisect_left(large, r)
                if j:
                    pair(by_left[large[j - 1]], by_left[r], right)
                if j < len(large):
                    pair(by_left[large[j]], by_left[r], right)
            home[b] = a
            large.extend(small)
            large.sort()
    return [(x[0], x[1]) if x[1] else None for x in best]


class DeepShallowJudge:
    """Finds, for the contexts of one anchor that occur once, what they share with others."""

    def __init__(self, sym: repeats.Symbols):
        self.sym = sym

    def group(self, held: list[repeats.Context], spans: repeats.Spans) -> None:
        if len(held) < 2 or all(c.n > 1 for c in held):
            return
        found = extents([(c.ctx, c.off) for c in held], self.sym.window, self.sym.k)
        for c, got in zip(held, found):
            if got and c.n == 1:
                key, pos = c.occ[0]
                spans.add(key, pos - got[0], pos + got[1])

    def close(self, spans: repeats.Spans) -> None:
        pass


def symbols(window: int = WINDOW, k: int = ANCHOR) -> repeats.Symbols:
    return repeats.Symbols(repeats.read_bytes, len, window, k)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (p for batch in batches for p in scan.slices(batch)):
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        data, off = scan.string_bytes(b.column("text"))
        raw, off = data.tobytes(), off.tolist()
        for i, (s, e) in enumerate(zip(b.column("starts").to_pylist(), b.column("ends").to_pylist())):
            text = raw[off[i]:off[i + 1]]
            runs = repeats.covered(s or [], e or [])
            at, parts = 0, []
            for x, y in runs:
                parts.append(text[at:x])
                at = y
            parts.append(text[at:])
            n_bytes.append(len(text))
            n_removed.append(sum(y - x for x, y in runs))
            n_spans.append(len(runs))
            kept.append(b"".join(parts))
        yield pa.record_batch([b.column("key"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                               pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                              names=["key", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, hot: int = repeats.HOT) -> DataFrame:
    """One row per distinct text: key, n_bytes, n_removed, n_spans, kept (remaining bytes, binary)."""
    texts = distinct_texts(docs)
    spans = repeats.repeated_spans(texts, symbols(window, k), DeepShallowJudge, hot)
    return repeats.with_spans(texts, spans).mapInArrow(
        _cut, "key binary, n_bytes long, n_removed long, n_spans long, kept binary")


def suffix_dedup(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, hot: int = repeats.HOT) -> DataFrame:
    """The digest per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    cut = remove_repeated_bytes(docs, window, k, hot).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    return (docs.select("doc_id", text_key(F.col("text")).alias("key")).join(cut, "key")
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
