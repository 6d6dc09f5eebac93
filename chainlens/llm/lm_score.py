"""Language-model scoring with a log-frequency Bloom filter of n-gram counts.

Every text is split and hashed once; its runs of documents are stored as arrays.
Training counts every word and every pair of neighbouring words over all training
documents.  Counts are quantised on a logarithmic scale: an n-gram of level q is
put into the filter q times, as (n-gram, 1) ... (n-gram, q), and a scorer reads it
back by probing levels 1, 2, ... until a probe misses.  The model is absolute
discounting, interpolated with the add-one unigram:

    P(w | v) = scale(v) (held(v w) - DISCOUNT) / held(v)  +  rest(v) (held(w) + 1) / z

with held the count that a level stands for, rest(v) what the pairs of v leave of
1, and scale(v) = 1 unless quantised pairs add up to more than their context.  No
n-gram is left out, however rare.

The filter grows with the corpus, so it is built in segments, one for each bucket
of words and of the pairs that they start.  If all segments together are small
(BROADCAST_BYTES, checked) they are broadcast to the scorers; else the probes of a
run of documents are sent to the segments and the levels come back.  Both ways
give the same scores.  A word that starts more than a bucket's share of the pairs
is spread over SPREAD segments; there are at most as many such words as buckets,
and only they are known everywhere.

Words are 64-bit hashed (xxh3); two words that collide share a count.  At 10^9
distinct words the expected number of colliding pairs is 0.03.  A pair that was
never seen is taken for one seen once in about 0.4 % of cases (the filter).

Defined results: null or empty text is one end token; very long texts are scored
whole, a text of any length being one entry of its run; rows of equal doc_id are
scored each by its own text, repeated rows each get a row; a document with null
doc_id is learned from; with no training rows every count is 0; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import by_value, partitions, stored, text_or_empty

by_value(__name__)

BASE = 2.0 ** 0.5
PROBES_FIRST, PROBES_NEXT = 6, 2
#: Filter bits for each bit that is set by a key of its own.
ROOM = 2
DISCOUNT = 0.75
END = b" "  # no word holds a space
#: Bytes of text of a run of documents: more where there are many segments to send probes to.
RUN_LEAST, RUN_MOST, RUN_PER_BUCKET = 8 << 20, 64 << 20, 16 << 10
CACHE_WORDS = 400_000
#: Size of all segments up to which they are broadcast.
BROADCAST_BYTES = 32 << 20
#: Segments over which the pairs of a very frequent word are spread.
SPREAD = 64
#: Questions that a segment answers at a time.
ANSWER_KEYS = 2_000_000
#: Bytes of a pair's key.  A bucket of a million pairs has half a collision among them.
KEY_BYTES = 5
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """40 bits of a pair; pairs meet only others of their bucket."""
    return mixed(a * _U(0x9E3779B97F4A7C15) + mixed(b)) >> _U(64 - 8 * KEY_BYTES)


def tokens(text: bytes) -> list[bytes]:
    """Words of the text with A-Z lower-cased, then the end token (bytes.lower
    and bytes.split touch ASCII letters and the six ASCII spaces only)."""
    words = text.lower().split()
    words.append(END)
    return words


END_HASH = _U(xxhash.xxh3_64_intdigest(END))


class WordHash(dict):
    """word -> hash; a cache of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Numbers(dict):
    """word -> its number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def added_up(keys: np.ndarray, counts: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, the sum of counts of each, and what else belongs to the key."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return (keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0], *(m[order][first] for m in more))


class Sums:
    """Adds up (key, count, ...) arrays, merging as it grows."""

    def __init__(self, more: int = 0, most: int = 4_000_000):
        self.rows, self.more, self.n, self.most, self.floor = [], more, 0, most, 0

    def add(self, *arrays: np.ndarray) -> None:
        self.rows.append(arrays)
        self.n += len(arrays[0])
        if self.n > self.most + 2 * self.floor:
            got = self.result()
            self.rows, self.n, self.floor = [got], len(got[0]), len(got[0])

    def result(self) -> tuple[np.ndarray, ...]:
        if not self.rows:
            return (np.zeros(0, _U), np.zeros(0, np.int64), *[np.zeros(0, _U)] * self.more)
        return added_up(*(np.concatenate(x) for x in zip(*self.rows)))


def pack(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True) if len(a) else b""


def unpack(b: bytes, n: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(b, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Pair keys, without their empty bytes."""
    return pack(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES])


def unpack_keys(b: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :KEY_BYTES] = unpack(b, n * KEY_BYTES, np.uint8).reshape(n, KEY_BYTES)
    return out.view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, byte by byte."""
    return pack(np.diff(keys, prepend=_U(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T)


def unpack_sorted(b: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(unpack(b, n * 8, np.uint8).reshape(8, n).T).view("<u8").ravel(), dtype=_U)


def by_group(group: np.ndarray, *arrays: np.ndarray):
    """(group number, its part of every array), stable order inside a group."""
    order = np.argsort(group, kind="stable")
    group = group[order]
    at = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else []
    for lo, hi in zip(at, [*at[1:], len(group)]):
        yield int(group[lo]), *(a[order[lo:hi]] for a in arrays)


#: Every exchanged or stored row: numbers, and packed arrays whose meaning goes by ``kind``.
ROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("batch", pa.int64()), ("n", pa.int64()), ("m", pa.int64()),
                 *[(c, pa.binary()) for c in "abcdef"]])
ROW_DDL = "bucket int, kind int, batch long, n long, m long, a binary, b binary, c binary, d binary, e binary, f binary"


def record(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows (missing arrays at the end are empty) as Arrow batches of a few megabytes."""
    def batch(some):
        cols = zip(*(r + (b"",) * (len(ROW) - len(r)) for r in some))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ROW)], schema=ROW)
    some, size = [], 0
    for r in rows:
        some.append(r)
        size += sum(len(x) for x in r if isinstance(x, bytes))
        if size > 8 << 20 or len(some) == 256:
            yield batch(some)
            some, size = [], 0
    if some:
        yield batch(some)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        names = b.schema.names
        for row in zip(*b.columns):
            yield dict(zip(names, (v.as_py() for v in row)))


def groups_of(batches: Iterator[pa.RecordBatch], column: str):
    """(key, iterator of its rows) of rows sorted by the key."""
    return groupby(rows_of(batches), key=lambda r: r[column])


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log_b(count)) for counts of at least 1."""
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def level_count(q: np.ndarray) -> np.ndarray:
    """The count that a level stands for, its middle on the logarithmic scale; 0 for level 0."""
    return np.where(q > 0, BASE ** (q - 0.5), 0.0)


def strides(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a key's probes begin and how they go on."""
    return mixed(keys), mixed(keys ^ _U(0xD6E8FEB86659FD93)) | _U(1)


def positions(a: np.ndarray, b: np.ndarray, level: int, bits: int) -> list[np.ndarray]:
    """Places of (key, level) in a segment of so many bits."""
    start = 0 if level == 1 else PROBES_FIRST + (level - 2) * PROBES_NEXT
    return [(((a + _U(start + t) * b) >> _U(7)) % _U(bits)).astype(np.int64) for t in range(PROBES_FIRST if level == 1 else PROBES_NEXT)]


def segment(keys: np.ndarray, q: np.ndarray) -> tuple[int, bytes]:
    """A filter segment with every (key, 1..q) in it: its number of bits and the bits."""
    size = max(64, ROOM * int((PROBES_FIRST + (q - 1) * PROBES_NEXT).sum()))
    bits, level = np.zeros(size, dtype=np.uint8), 1
    a, b = strides(keys)
    while len(a):
        for p in positions(a, b, level, size):
            bits[p] = 1
        level += 1
        more = q >= level
        a, b, q = a[more], b[more], q[more]
    return size, np.packbits(bits).tobytes()


def probe(bits: np.ndarray, size: int, keys: np.ndarray) -> np.ndarray:
    """Levels read back from a segment: probe 1, 2, ... until one misses."""
    found, live, level = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys)), 1
    a, b = strides(keys)
    while len(live):
        hit = np.ones(len(live), dtype=bool)
        for p in positions(a, b, level, size):
            hit &= (bits[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 == 1
        live, a, b = live[hit], a[hit], b[hit]
        found[live] = level
        level += 1
    return found


# -- the corpus as arrays --------------------------------------------------------------------

def hashed_runs(docs: DataFrame, buckets: int) -> DataFrame:
    """Runs of documents (columns text, doc_id, text_hash, train): kind 0, batch, n
    documents, m tokens; a = ids, b = id is null and training flags, c = token
    numbers of each document, d = hashes of the run's words, e = words of the
    tokens, f = how many words."""
    most = min(max(RUN_LEAST, buckets * RUN_PER_BUCKET), RUN_MOST)

    def run(batches):
        seen, seq = WordHash(), 0
        number, at, ids, flags, size = Numbers(), [], [], [], 0

        def flush():
            hashes = np.fromiter((seen[w] for w in number), _U, len(number))
            lengths = np.array([len(x) for x in at], np.int32)
            return record([(0, 0, (TaskContext.get().partitionId() << 32) + seq, len(ids), int(lengths.sum()), pack(np.array(ids, np.int64)),
                            pack(np.array(flags, np.int8)), pack(lengths), pack(hashes), pack(np.concatenate(at)), len(hashes).to_bytes(8, "little"))])
        for b in batches:
            for t, i, x in zip(*b.columns):
                t, i = t.as_py(), i.as_py()
                words = tokens(t)
                at.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                ids.append(i or 0)
                flags.append((i is None) + 2 * bool(x.as_py()))
                size += len(t)
                if size >= most:
                    yield from flush()
                    number, at, ids, flags, size = Numbers(), [], [], [], 0
                    seq += 1
        if ids:
            yield from flush()
    return docs.select("text", "doc_id", "train").mapInArrow(run, ROW_DDL)


class Run:
    """A run of documents, unpacked: words (hashes), the word before and the word of
    every token, and the first token of each document."""

    def __init__(self, r: dict):
        n, m = r["n"], r["m"]
        self.batch, self.ids, flags = r["batch"], unpack(r["a"], n, np.int64), unpack(r["b"], n, np.int8)
        self.null, self.train = flags & 1 == 1, flags & 2 == 2
        self.lengths = unpack(r["c"], n, np.int32).astype(np.int64)
        self.words = unpack(r["d"], int.from_bytes(r["f"], "little"), _U)
        self.next = unpack(r["e"], m, np.uint32).astype(np.int64)
        self.first = np.r_[0, np.cumsum(self.lengths)[:-1]]
        end = int(np.flatnonzero(self.words == END_HASH)[0])
        self.context = np.r_[end, self.next[:-1]]  # a document starts after an end

    def pairs(self, chosen=slice(None)) -> tuple[np.ndarray, ...]:
        """Distinct (context, word) of the chosen tokens as word numbers, each token's
        place among them, and how often each occurs."""
        code = self.context[chosen] * len(self.words) + self.next[chosen]
        code, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
        return code // len(self.words), code % len(self.words), inverse, count


def bucket_of(context: np.ndarray, keys: np.ndarray, buckets: int, spread: np.ndarray) -> np.ndarray:
    """The segment of each pair: its context's, or one of SPREAD for contexts in ``spread``."""
    wide = spread[np.minimum(np.searchsorted(spread, context), max(len(spread) - 1, 0))] == context if len(spread) else np.zeros(len(context), bool)
    return ((context + np.where(wide, keys % _U(SPREAD), _U(0))) % _U(buckets)).astype(np.int32)


# -- training -------------------------------------------------------------------------------------

def count_words(runs: DataFrame, buckets: int) -> DataFrame:
    """A row for each bucket: kind 0, n words; a = hashes, b = counts of training tokens."""

    def local(batches):
        total = Sums()
        for r in rows_of(batches):
            x = Run(r)
            of = np.bincount(x.next[np.repeat(x.train, x.lengths)], minlength=len(x.words))
            total.add(x.words[of > 0], of[of > 0].astype(np.int64))
        h, c = total.result()
        yield from record([(g, 0, 0, len(x), 0, pack(x), pack(y)) for g, x, y in by_group((h % _U(buckets)).astype(np.int32), h, c)])

    def merge(batches):
        for bucket, rows in groups_of(batches, "bucket"):
            total = Sums()
            for r in rows:
                total.add(unpack(r["a"], r["n"], _U), unpack(r["b"], r["n"], np.int64))
            h, c = total.result()
            yield from record([(bucket, 0, 0, len(h), int(c.sum()), pack(h), pack(c))])

    n = partitions(runs.sparkSession)
    return runs.mapInArrow(local, ROW_DDL).repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(merge, ROW_DDL)


def frequent_words(words: DataFrame, total: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The words, sorted by hash, that make up a bucket's share of all tokens or more: at most as
    many as buckets; and their counts."""
    def pick(batches):
        for r in rows_of(batches):
            h, c = unpack(r["a"], r["n"], _U), unpack(r["b"], r["n"], np.int64)
            keep = c * buckets >= total
            if keep.any():
                yield from record([(0, 0, 0, int(keep.sum()), 0, pack(h[keep]), pack(c[keep]))])
    got = words.mapInArrow(pick, ROW_DDL).collect()
    h = np.concatenate([np.zeros(0, _U), *(unpack(bytes(r.a), r.n, _U) for r in got)])
    c = np.concatenate([np.zeros(0, np.int64), *(unpack(bytes(r.b), r.n, np.int64) for r in got)])
    order = np.argsort(h)
    return h[order], c[order]


def weights(taken: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale / held, rest) of contexts, of which pairs take so much (discounted)."""
    share = np.minimum(taken / held, 0.99)
    return (share / np.maximum(taken, 1e-300)).astype(np.float32), (1 - share).astype(np.float32)


def train(runs: DataFrame, buckets: int) -> dict:
    """Count and build the segments.  ``model``: a stored row for each bucket: kind
    0, n words, m filter bits; a = word hashes, b = counts, c = scale / held of the
    word as context, d = rest, e = the segment.  For words in ``spread`` c and d are
    in ``spread_c``, ``spread_d``."""
    spark = runs.sparkSession
    words = stored(count_words(runs, buckets), "lm-words")
    sums = words.agg(F.sum("m").alias("n"), F.sum("n").alias("v")).first()
    n, v = int(sums.n or 0), int(sums.v or 0)
    spread, spread_counts = frequent_words(words, max(n, 1), buckets)

    def pairs(batches):
        """kind 1: pairs by context: n pairs, m contexts; a = contexts, b = pairs of each, c = keys, d = counts."""
        total = Sums(more=1)

        def flush():
            key, c, context = total.result()
            for g, k, count, ctx in by_group(bucket_of(context, key, buckets, spread), key, c, context):
                order = np.argsort(ctx, kind="stable")
                names, size = np.unique(ctx, return_counts=True)
                yield (g, 1, 0, len(k), len(names), pack(names), pack(size.astype(np.int32)), pack_keys(k[order]), pack(count[order].astype(np.int32)))
        for r in rows_of(batches):
            x = Run(r)
            a, b, _, count = x.pairs(np.repeat(x.train, x.lengths))
            total.add(pair_key(x.words[a], x.words[b]), count.astype(np.int64), x.words[a])
        yield from record(flush())

    def build(batches):
        for bucket, rows in groups_of(batches, "bucket"):
            h, c, total = np.zeros(0, _U), np.zeros(0, np.int64), Sums(more=1)
            for r in rows:
                if r["kind"] == 0:
                    h, c = unpack(r["a"], r["n"], _U), unpack(r["b"], r["n"], np.int64)
                else:
                    context = np.repeat(unpack(r["a"], r["m"], _U), unpack(r["b"], r["m"], np.int32))
                    total.add(unpack_keys(r["c"], r["n"]), unpack(r["d"], r["n"], np.int32).astype(np.int64), context)
            key, count, context = total.result()
            q = levels(count) if len(count) else count
            order = np.argsort(context, kind="stable")
            names, first = np.unique(context[order], return_index=True)
            taken = np.add.reduceat(level_count(q)[order] - DISCOUNT, first) if len(first) else np.zeros(0)
            own_q = levels(c) if len(c) else c
            mine = np.zeros(len(h))
            at = np.searchsorted(h, names)
            hit = at < len(h)
            hit[hit] = h[at[hit]] == names[hit]  # contexts of other buckets are spread words
            mine[at[hit]] = taken[hit]
            gain, rest = weights(mine, np.maximum(level_count(own_q), 1.0))
            bits, body = segment(np.concatenate([mixed(h), key]), np.concatenate([own_q, q]))
            wide = np.isin(names, spread)
            yield from record([(bucket, 0, 0, len(h), bits, pack(h), pack(c), pack(gain), pack(rest), body),
                               (bucket, 2, 0, int(wide.sum()), 0, pack(names[wide]), pack(taken[wide]))])

    counted = runs.mapInArrow(pairs, ROW_DDL).unionByName(words)
    model = stored(counted.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(build, ROW_DDL), "lm-model")
    taken = np.zeros(len(spread))
    for r in model.where((F.col("kind") == 2) & (F.col("n") > 0)).orderBy("bucket").toLocalIterator():  # SPREAD rows a spread word
        taken[np.searchsorted(spread, unpack(bytes(r.a), r.n, _U))] += unpack(bytes(r.b), r.n, np.float64)
    gain, rest = weights(taken, np.maximum(level_count(levels(spread_counts)), 1.0)) if len(spread) else (taken, taken)

    def mass(batches):
        for r in rows_of(batches):
            held = level_count(levels(unpack(r["b"], r["n"], np.int64))).sum() if r["n"] else 0.0
            yield pa.RecordBatch.from_arrays([pa.array([r["bucket"]], pa.int32()), pa.array([float(held)])], names=["bucket", "held"])
    # added up in a fixed order, so reruns agree to the last bit
    held = words.mapInArrow(mass, "bucket int, held double").agg(F.sum(F.col("held").cast("decimal(38,6)")).alias("h")).first().h
    return {"model": model.where(F.col("kind") == 0), "n": n, "v": v, "z": float(held or 0) + v + 1, "buckets": buckets,
            "spread": spread, "spread_c": gain, "spread_d": rest}


# -- scoring ----------------------------------------------------------------------------------------

class Segment:
    """One bucket of the model, unpacked."""

    def __init__(self, r: dict | None):
        n = r["n"] if r else 0
        self.words, self.counts = (unpack(r[c], n, kind) if r else np.zeros(0, kind) for c, kind in (("a", _U), ("b", np.int64)))
        self.gain, self.rest = (unpack(r[c], n, np.float32) if r else np.zeros(0, np.float32) for c in "cd")
        self.size, self.bits = (r["m"], np.frombuffer(r["e"], np.uint8)) if r else (64, np.zeros(8, np.uint8))

    def of_words(self, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Level, count, gain and rest of words; 0, 0, 0 and 1 for unknown ones."""
        q, count, gain, rest = probe(self.bits, self.size, mixed(hashes)), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.float32), np.ones(len(hashes), np.float32)
        at = np.minimum(np.searchsorted(self.words, hashes), max(len(self.words) - 1, 0))
        hit = np.flatnonzero(self.words[at] == hashes) if len(self.words) else []
        count[hit], gain[hit], rest[hit] = self.counts[at[hit]], self.gain[at[hit]], self.rest[at[hit]]
        q[count == 0] = 0
        return q, count, gain, rest

    def of_pairs(self, keys: np.ndarray) -> np.ndarray:
        return probe(self.bits, self.size, keys)


def questions(x: Run, buckets: int, spread: np.ndarray):
    """What a run asks: its distinct pairs (a, b, each token's), and for each bucket
    the places of words, and of pairs in the order of their keys."""
    a, b, inverse, _ = x.pairs()
    keys = pair_key(x.words[a], x.words[b])
    words = {g: at for g, at in by_group((x.words % _U(buckets)).astype(np.int32), np.arange(len(x.words)))}
    pairs = {g: at[np.argsort(keys[at], kind="stable")] for g, at in by_group(bucket_of(x.words[a], keys, buckets, spread), np.arange(len(keys)))}
    return a, b, inverse, keys, words, pairs


SCORES = "doc_id long, n_tokens long, known long, log_sum double, score double"


def scored(x: Run, asked, answers, m: dict) -> pa.RecordBatch:
    """The documents' scores, from answers by bucket: (levels, counts, gains, rests of words; levels of pairs)."""
    a, b, inverse, _, words, pairs = asked
    q, count = np.zeros(len(x.words), np.int64), np.zeros(len(x.words), np.int64)
    gain, rest = np.zeros(len(x.words), np.float32), np.ones(len(x.words), np.float32)
    pair_q = np.zeros(len(a), np.int64)
    for g, (of_words, of_pairs) in answers:
        if g in words:
            q[words[g]], count[words[g]], gain[words[g]], rest[words[g]] = of_words
        if g in pairs:
            pair_q[pairs[g]] = of_pairs
    at = np.searchsorted(m["spread"], x.words)
    hit = at < len(m["spread"])
    hit[hit] = m["spread"][at[hit]] == x.words[hit]
    gain[hit], rest[hit] = m["spread_c"][at[hit]], m["spread_d"][at[hit]]
    uni = (level_count(q) + 1) / m["z"]
    p = gain[a].astype(np.float64) * np.maximum(level_count(pair_q) - DISCOUNT, 0) + rest[a] * uni[b]
    log_p, known = np.log10(np.minimum(p, 1.0))[inverse], count[x.next] > 0
    logs = np.log10(count + 1.0)[x.next]
    sums = [np.add.reduceat(v, x.first) for v in (known.astype(np.int64), logs, log_p)]
    return pa.RecordBatch.from_arrays([pa.array(x.ids, pa.int64(), mask=x.null), pa.array(x.lengths), *map(pa.array, sums)],
                                      names=["doc_id", "n_tokens", "known", "log_sum", "score"])


def scores_by_broadcast(runs: DataFrame, m: dict) -> DataFrame:
    """The whole model goes to the workers."""
    rows = [r.asDict() for r in m["model"].collect()]  # at most BROADCAST_BYTES, checked
    small = {k: m[k] for k in ("z", "buckets", "spread", "spread_c", "spread_d")}
    shared = runs.sparkSession.sparkContext.broadcast(({r["bucket"]: {k: bytes(v) if isinstance(v, bytearray) else v for k, v in r.items()}
                                                        for r in rows}, small))

    def run(batches):
        packed, m = shared.value
        segments = {}
        for r in rows_of(batches):
            x = Run(r)
            asked = questions(x, m["buckets"], m["spread"])
            keys, words, pairs = asked[3:]
            answers = []
            for g in sorted(words.keys() | pairs.keys()):
                if g not in segments:
                    segments[g] = Segment(packed.get(g))
                answers.append((g, (segments[g].of_words(x.words[words[g]]) if g in words else None,
                                    segments[g].of_pairs(keys[pairs[g]]) if g in pairs else None)))
            yield scored(x, asked, answers, m)
    return runs.mapInArrow(run, SCORES)


def scores_by_segments(runs: DataFrame, m: dict) -> DataFrame:
    """Probes go to the segments, levels come back to the runs."""
    spark = runs.sparkSession
    shared = spark.sparkContext.broadcast({k: m[k] for k in ("z", "buckets", "spread", "spread_c", "spread_d")})
    n = partitions(spark)

    def ask(batches):
        """kind 1 to a bucket: n words, m pairs; a = hashes, b = keys."""
        m = shared.value
        for r in rows_of(batches):
            x = Run(r)
            *_, keys, words, pairs = questions(x, m["buckets"], m["spread"])
            none = np.zeros(0, np.int64)
            yield from record([(g, 1, x.batch, len(words.get(g, none)), len(pairs.get(g, none)), pack(x.words[words.get(g, none)]),
                                pack_sorted(keys[pairs.get(g, none)])) for g in sorted(words.keys() | pairs.keys())])

    def answer(batches):
        """kind 3 to a run: a to d = levels, counts, gains and rests of its words, e = levels of its pairs."""
        def replies(bucket, own, some):
            """Of several runs' questions each word and pair is probed once."""
            hashes, keys = ([unpack(r["a"], r["n"], _U) for r in some], [unpack_sorted(r["b"], r["m"]) for r in some])
            (words, of), (pairs, at) = (np.unique(np.concatenate(x), return_inverse=True) for x in (hashes, keys))
            q, count, gain, rest = own.of_words(words)
            q, pair_q = q.astype(np.int16), own.of_pairs(pairs).astype(np.int16)
            w = p = 0
            for r, h, k in zip(some, hashes, keys):
                i, j = of[w:w + len(h)], at[p:p + len(k)]
                w, p = w + len(h), p + len(k)
                yield (bucket, 3, r["batch"], r["n"], r["m"], pack(q[i]), pack(count[i]), pack(gain[i]), pack(rest[i]), pack(pair_q[j]))

        for bucket, rows in groups_of(batches, "bucket"):
            own, some, size = Segment(None), [], 0
            for r in rows:  # the model's row comes first
                if r["kind"] == 0:
                    own = Segment(r)
                    continue
                some.append(r)
                size += r["n"] + r["m"]
                if size > ANSWER_KEYS:
                    yield from record(replies(bucket, own, some))
                    some, size = [], 0
            if some:
                yield from record(replies(bucket, own, some))

    def settle(batches):
        m = shared.value
        for _, rows in groups_of(batches, "batch"):
            x = asked = None
            answers = []
            for r in rows:  # the run comes first
                if r["kind"] == 0:
                    x = Run(r)
                    asked = questions(x, m["buckets"], m["spread"])
                else:
                    words = [unpack(r[c], r["n"], kind) for c, kind in (("a", np.int16), ("b", np.int64), ("c", np.float32), ("d", np.float32))]
                    answers.append((r["bucket"], (words, unpack(r["e"], r["m"], np.int16))))
            yield scored(x, asked, answers, m)

    asked = runs.mapInArrow(ask, ROW_DDL).unionByName(m["model"])
    replies = asked.repartition(n, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(answer, ROW_DDL)
    both = runs.unionByName(replies).repartition(n, "batch").sortWithinPartitions("batch", "kind", "bucket")
    return both.mapInArrow(settle, SCORES)


def score_documents(docs: DataFrame, is_training: Column, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Learn from the rows where ``is_training`` holds and score all rows:
    doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    buckets = partitions(docs.sparkSession)
    rows = docs.select(text_or_empty().cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), is_training.alias("train"))
    runs = stored(hashed_runs(rows, buckets), "lm-runs")
    m = train(runs, buckets)
    size = m["model"].agg(F.sum(sum(F.octet_length(c) for c in "abcde"))).first()[0] or 0
    got = (scores_by_broadcast if size <= broadcast_bytes else scores_by_segments)(runs, m)
    bottom = float(np.log10(m["n"] + 1 * (m["v"] + 1)))
    return got.select("doc_id", "n_tokens", F.col("known").alias("n_known"), F.lit(m["n"]).cast("long").alias("train_tokens"),
                      (F.col("log_sum") - F.col("n_tokens") * F.lit(bottom)).alias("base_score"), "score")
