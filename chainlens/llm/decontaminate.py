"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Documents and benchmark items are sequences of lower-cased words (runs of
letters and digits).  Windows of an item's length slide over every document,
and overhang its ends by as many words as the item may lose.
The CGK random walk copies a sequence, symbol by symbol, to one three times as
long; a random bit of (step, symbol) says whether it moves on.  Sequences at a
small edit distance then agree in most places, so samples of a few places,
repeated with new walks, collide for near windows.  A candidate is verified by
the exact edit distance, in words, of the item to the best stretch around the
window.  A document is contaminated by an item if 1 - distance / item length
is at least the threshold.

Before the walk bounds that lose nothing thin the windows.  A window within
distance e of an item of n words, r of them rare in the benchmark, holds at
least n - e words of the benchmark's vocabulary, r - e of its rare words, and
has at least n - e words in common with that item.

The benchmark goes to the workers in blocks of a fixed number of items; the
documents are read once for each block and never shuffled.

Defined results: null or empty text is clean; items of fewer words than
min_words are not looked for; items of equal text each give a row; rows of
equal doc_id are reported and filtered by their own text; an empty table gives
no rows; other columns are kept by ``clean``.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import by_value

by_value(__name__)

THRESHOLD = 0.8
MIN_WORDS = 5
#: Walks and sampled places of each: at the threshold's distance 95 % of windows collide (tests/llm).
WALKS, SAMPLES = 24, 2
#: A word in more than one of so many items counts as common.
COMMON_SHARE = 50
WINDOW_ROWS = 20_000
ITEM_BLOCK = 20_000
RUN_CHARS = 4 << 20
_WORD = re.compile(r"[^\W_]+")
_U = np.uint64


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def most_edits(n: int, threshold: float) -> int:
    return int(n * (1 - threshold) + 1e-9)


def embedded_samples(windows: np.ndarray) -> np.ndarray:
    """rows x WALKS LSH keys: each walk's symbols at its sampled places.  Places
    lie in the first half of the output, where a walk has hardly ended."""
    rows, n = windows.shape
    rng, half = np.random.default_rng(n), max(1, 3 * n // 2)
    places = np.stack([rng.choice(half, size=min(SAMPLES, half), replace=False) for _ in range(WALKS)])
    walks = np.arange(WALKS)
    at = np.zeros((rows, WALKS), np.int64)
    key = np.broadcast_to((walks * 1_000_003 + n).astype(_U), at.shape).copy()
    line = np.arange(rows)[:, None]
    for step in range(int(places.max()) + 1):
        symbol = np.where(at < n, windows[line, np.minimum(at, n - 1)], -2).astype(_U)
        here = np.flatnonzero((places == step).any(axis=1))
        if len(here):
            key[:, here] = mixed(key[:, here] * _U(31) + symbol[:, here])
        h = mixed(symbol + _U(step * 0x9E3779B97F4A7C15 % 2 ** 64) + walks.astype(_U) * _U(0xC2B2AE3D27D4EB4F))
        at += (h >> _U(63)).astype(np.int64)
    return key


def edit_distance_inside(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """(distance, end) of the item to the stretch of the region nearest to it."""
    j = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)  # a stretch may begin anywhere
    for i, w in enumerate(item.tolist()):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (region != w))
        row = np.minimum.accumulate(new - j) + j
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """A block of benchmark items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], threshold: float, min_words: int):
        self.vocab: dict[str, int] = {}
        self.threshold, self.ids, self.seqs = threshold, [], []
        lengths = defaultdict(list)
        for item_id, text in items:
            words = words_of(text or "")
            if len(words) >= min_words:
                lengths[len(words)].append(len(self.ids))
                self.ids.append(item_id)
                self.seqs.append(np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words]))
        self.sets = [np.unique(s, return_counts=True) for s in self.seqs]
        among = np.bincount(np.concatenate([np.zeros(0, np.int64), *(s for s, _ in self.sets)]), minlength=len(self.vocab))
        # any choice of rare words gives a bound; these are in few of the items
        self.rare = np.append(among <= max(1, len(self.seqs) // COMMON_SHARE), False)
        self.size = np.array([len(s) for s in self.seqs], np.int64)
        self.need = np.array([int(self.rare[s].sum()) - most_edits(len(s), threshold) for s in self.seqs], np.int64)
        # the items of every rare word
        word = np.concatenate([np.zeros(0, np.int64), *(s[self.rare[s]] for s, _ in self.sets)])
        item = np.repeat(np.arange(len(self.seqs)), [int(self.rare[s].sum()) for s, _ in self.sets])
        order = np.argsort(word, kind="stable")
        self.word_items = item[order]
        self.word_first = np.searchsorted(word[order], np.arange(len(self.vocab) + 2))
        self.classes = {}  # length: (most edits, has items of no rare-word bound, per walk: sorted keys and their items)
        for n, members in sorted(lengths.items()):
            keys, tables = embedded_samples(np.stack([self.seqs[m] for m in members])), []
            for walk in range(WALKS):
                order = np.argsort(keys[:, walk], kind="stable")
                tables.append((keys[order, walk], np.array(members)[order]))
            self.classes[n] = (most_edits(n, threshold), bool((self.need[members] <= 0).any()), tables)

    def _windows(self, ids: np.ndarray, doc: np.ndarray, first: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Starts and documents, by window length, of the windows that meet the rare-word bound of some item."""
        at = np.flatnonzero(self.rare[ids])  # id -1 reads the last place: not rare
        many = self.word_first[ids[at] + 1] - self.word_first[ids[at]]
        place = np.repeat(at, many)
        item = self.word_items[np.repeat(self.word_first[ids[at]], many) + np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)]
        order = np.lexsort((place, item))
        place, item = place[order], item[order]
        far = np.arange(len(place)) + self.need[item] - 1
        good = (self.need[item] > 0) & (far < len(place))
        near, far = np.flatnonzero(good), far[good]
        fits = (item[far] == item[near]) & (place[far] - place[near] < self.size[item[near]])
        near, far = near[fits], far[fits]
        fits = doc[place[far]] == doc[place[near]]
        near, far = near[fits], far[fits]
        n, d = self.size[item[near]], doc[place[near]]
        out = {}
        for length in np.unique(n).tolist():
            e, own = self.classes[length][0], n == length
            lo = np.maximum(place[far[own]] - length + 1, first[d[own]] - e)
            hi = np.minimum(place[near[own]], first[d[own] + 1] - length + e)
            ranges = set(zip(d[own].tolist(), lo.tolist(), hi.tolist()))
            found = np.array(sorted({(k, s) for k, a, b in ranges for s in range(a, b + 1)}), np.int64).reshape(-1, 2)
            out[length] = (found[:, 1], found[:, 0])
        for length, (e, weak, _) in self.classes.items():
            if weak:
                lo, many = first[:-1] - e, np.maximum(np.diff(first) - length + 2 * e + 1, 0)
                d = np.repeat(np.arange(len(many)), many)
                out[length] = (lo[d] + np.arange(len(d)) - np.repeat(np.cumsum(many) - many, many), d)
        return out

    def find(self, texts: list[str]) -> list[tuple[int, int, float, int]]:
        """(text number, item number, similarity, word where the window starts), the best for each pair."""
        ids, doc, start = [], [], []
        for k, t in enumerate(texts):
            words = words_of(t)
            ids.append(np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, len(words)))
            doc.append(np.full(len(words), k))
            start.append(len(words))
        ids, doc = np.concatenate([np.zeros(0, np.int64), *ids]), np.concatenate([np.zeros(0, np.int64), *doc])
        first = np.r_[0, np.cumsum(start)]
        held = np.r_[0, np.cumsum(ids >= 0)]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for n, (at, of) in self._windows(ids, doc, first).items():
            e, _, tables = self.classes[n]
            inside = held[np.minimum(at + n, first[of + 1])] - held[np.maximum(at, first[of])]
            at, of = at[inside >= n - e], of[inside >= n - e]
            pairs = set()
            for lo in range(0, len(at), WINDOW_ROWS):
                part, low, high = (x[lo:lo + WINDOW_ROWS, None] for x in (at, first[of], first[of + 1]))
                place = part + np.arange(n)
                # what overhangs a document is no word of any item
                own = embedded_samples(np.where((place >= low) & (place < high), ids[np.clip(place, low, high - 1)], -1))
                for walk, (keys, members) in enumerate(tables):
                    a, b = np.searchsorted(keys, own[:, walk], "left"), np.searchsorted(keys, own[:, walk], "right")
                    for w in np.flatnonzero(b > a).tolist():
                        pairs.update((lo + w, m) for m in members[a[w]:b[w]].tolist())
            for w, m in sorted(pairs):
                s, d = int(at[w]), int(of[w])
                if best.get((d, m), (e + 1, 0))[0] == 0:
                    continue
                own, count = np.unique(ids[max(first[d], s):min(first[d + 1], s + n)], return_counts=True)
                words, most = self.sets[m]
                place = np.minimum(np.searchsorted(words, own), len(words) - 1)
                if np.minimum(count, most[place])[words[place] == own].sum() < n - e:
                    continue
                region = ids[max(first[d], s - e):min(first[d + 1], s + n + e)]
                dist, _ = edit_distance_inside(self.seqs[m], region)
                if dist <= e and dist < best.get((d, m), (e + 1, 0))[0]:
                    best[d, m] = (dist, max(0, s - int(first[d])))
        return [(d, m, 1 - dist / len(self.seqs[m]), s) for (d, m), (dist, s) in sorted(best.items())]


def _runs(batches: Iterator[pa.RecordBatch], at: int):
    """(batch part, its texts), each of about RUN_CHARS characters."""
    for b in batches:
        lo, size, texts = 0, 0, []
        for k, t in enumerate(b.column(at)):
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= RUN_CHARS:
                yield b.slice(lo, k + 1 - lo), texts
                lo, size, texts = k + 1, 0, []
        if texts:
            yield b.slice(lo), texts


def _blocks(benchmark: DataFrame, threshold: float, min_words: int):
    """The benchmark as broadcast blocks of about ITEM_BLOCK items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        # as bytes that hold the class by value: executors need no copy of the package
        yield benchmark.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Items([(r.item_id, r.text) for r in rows], threshold, min_words)))


def find_contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, item_id, similarity, first_word): one row for every document and item that it holds."""
    out = None
    for shared in _blocks(benchmark, threshold, min_words):
        def run(batches, shared=shared):
            items = pickle.loads(shared.value)
            for part, texts in _runs(batches, 1):
                hits = items.find(texts)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(0).take(pa.array([h[0] for h in hits], pa.int64())),
                    "item_id": pa.array([items.ids[h[1]] for h in hits], pa.int64()),
                    "similarity": pa.array([h[2] for h in hits], pa.float64()),
                    "first_word": pa.array([h[3] for h in hits], pa.int64())})
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            run, "doc_id long, item_id long, similarity double, first_word long")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` (all its columns) that hold no benchmark item."""
    at = docs.columns.index("text")
    for shared in _blocks(benchmark, threshold, min_words):
        def run(batches, shared=shared):
            items = pickle.loads(shared.value)
            for part, texts in _runs(batches, at):
                keep = np.ones(len(texts), bool)
                keep[[h[0] for h in items.find(texts)]] = False
                yield part.filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
