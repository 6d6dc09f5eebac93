"""Removal of long repeated byte strings by a common-prefix-aware distributed merge sort.

A byte goes if it lies in a string of ``length`` bytes (50) that also starts
in a document with a smaller doc_id.  Texts are UTF-8 bytes, matches never
cross documents, and all strings are judged on the input.

Sorting every suffix of a corpus would exchange fifty times its size.  Two
steps that lose nothing make the sort small:

* Anchors.  Of every string of 50 bytes the 20-byte piece of least hash is
  its anchor.  Equal strings have their anchor at the same place, and a text
  has one anchor in about 16 bytes.
* Repeats.  The anchors' hashes are exchanged, delta-coded, and only those
  that occur in two documents or more come back.

What is sorted are the suffixes that start at repeated anchors, 50 bytes of
each.  Every run (a hashed share of the documents) sorts its suffixes, drops
contexts that its own documents settle, and sends front-coded sorted runs,
dealt by anchor.  The receiver merges the runs with a loser tree on (known
common prefix, suffix): two candidates are compared only beyond their common
prefix with the last output, and the tree yields the common prefixes of the
merged order.  An occurrence has o bytes before its anchor and 50 - o after it
in common with a smaller document if, in the stretch of the merged order
with common prefix at least 50 - o, an entry with the same o bytes before has
a smaller doc_id.

Copies of a passage within a run meet before the exchange, so a passage that
a third of all documents share arrives once from each run.

Defined results: null text is empty; rows of equal doc_id do not count as
smaller than each other; a null doc_id is after all others; texts shorter
than 50 bytes keep all; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import by_value, partitions, text_or_empty

by_value(__name__)

LENGTH = 50
ANCHOR = 20
#: Anchor pieces in a string, and so the most bytes of a string before its anchor plus one.
PIECES = LENGTH - ANCHOR + 1
BEFORE = PIECES - 1
SEGMENT = 1 << 20
_U, _U32 = np.uint64, np.uint32
_HASH_BITS = _U((1 << 48) - 1)
_LAST = (1 << 63) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def pack(a: np.ndarray) -> bytes:
    return pa.compress(a.tobytes(), codec="zstd", asbytes=True) if a.size else b""


def unpack(b: bytes, n: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(b, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


def piece_hashes(b: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the 20 bytes at every place, by doubling: 1, 2, 4, 8, 16, then 16 + 4."""
    h, four = b.astype(_U32) + _U32(1), None
    base = 0x01000193
    for width in (1, 2, 4, 8):
        h = h[:-width] * _U32(pow(base, width, 1 << 32)) + h[width:]
        if width == 2:
            four = h
    h = h[:len(b) - ANCHOR + 1] * _U32(pow(base, 4, 1 << 32)) + four[16:16 + len(b) - ANCHOR + 1]
    h ^= h >> _U32(15)
    h *= _U32(0x2C1B3C6D)
    h ^= h >> _U32(13)
    return h


def anchor_places(b: np.ndarray, doc_ends: np.ndarray) -> np.ndarray:
    """Places of the anchors of all strings of LENGTH bytes that lie in one
    document; ``doc_ends`` are the documents' ends in ``b``."""
    out, last = [], len(b) - LENGTH + 1
    for lo in range(0, max(last, 0), SEGMENT):
        hi = min(lo + SEGMENT, last)
        h = piece_hashes(b[lo:hi + LENGTH - 1]).astype(_U)
        m = (h << _U(32)) | np.arange(len(h), dtype=_U)  # ties go to the left
        for width in (1, 2, 4, 8):
            m = np.minimum(m[:-width], m[width:])
        m = np.minimum(m[:hi - lo], m[PIECES - 16:PIECES - 16 + hi - lo])
        start = np.arange(lo, hi)
        end = doc_ends[np.searchsorted(doc_ends, start, side="right")]
        at = (m & _U(0xFFFFFFFF))[start + LENGTH <= end].astype(np.int64) + lo
        out.append(at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at)
    return np.unique(np.concatenate([np.zeros(0, np.int64), *out]))


def anchor_hashes(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """48-bit hashes of the anchors' bytes."""
    words = np.zeros((len(at), 24), np.uint8)
    words[:, :ANCHOR] = b[at[:, None] + np.arange(ANCHOR)]
    w = words.view("<u8").astype(_U)
    return mixed(mixed(mixed(w[:, 0]) + w[:, 1]) + w[:, 2]) & _HASH_BITS


class Run:
    """The documents of one run, joined, in a fixed order."""

    def __init__(self, table: pa.Table):
        ids, hashes, texts = table["doc_id"].to_pylist(), table["text_hash"].to_pylist(), table["text"].to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, hashes[k], len(texts[k])))
        self.ids = [ids[k] for k in order]
        self.texts = [texts[k] for k in order]
        self.bytes = np.frombuffer(b"".join(self.texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in self.texts])
        self.starts = self.ends - [len(t) for t in self.texts]
        self.rank = np.array([_LAST if i is None else i for i in self.ids], np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, document, hash) of every anchor."""
        at = anchor_places(self.bytes, self.ends)
        return at, np.searchsorted(self.ends, at, side="right"), anchor_hashes(self.bytes, at)


SENT = pa.schema([("bucket", pa.int32()), ("run", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("a", pa.binary()), ("b", pa.binary()),
                  ("c", pa.binary()), ("d", pa.binary())])
SENT_DDL = "bucket int, run int, kind int, n long, a binary, b binary, c binary, d binary"


def sent(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SENT)] if rows else [pa.array([], f.type) for f in SENT], schema=SENT)


def split_by(group: np.ndarray):
    """(group number, indices) in stable order."""
    order = np.argsort(group, kind="stable")
    g = group[order]
    at = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else []
    for lo, hi in zip(at, [*at[1:], len(g)]):
        yield int(g[lo]), order[lo:hi]


def groups_of(batches, column: str):
    """(key, iterator of row dicts) of rows sorted by the key."""
    def rows():
        for b in batches:
            for row in zip(*b.columns):
                yield dict(zip(b.schema.names, (v.as_py() for v in row)))
    return groupby(rows(), key=lambda r: r[column])


def send_hashes(buckets: int):
    """A run's distinct anchor hashes (a, delta-coded) with a bit (b) for those of two documents or more."""
    def emit(key, table):
        _, doc, h = Run(table).anchors()
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
        other = np.r_[False, (h[1:] == h[:-1]) & (doc[1:] != doc[:-1])] if len(h) else new
        first = np.flatnonzero(new)
        many = np.add.reduceat(other.astype(np.int32), first) > 0 if len(first) else new
        h = h[first]
        return sent([(g, key[0].as_py(), 0, len(i), pack(np.diff(h[i], prepend=_U(0))), pack(np.packbits(many[i])), b"", b"")
                     for g, i in split_by((h % _U(buckets)).astype(np.int32))])
    return emit


def repeated_hashes(batches):
    """To every run its hashes that occur in two documents or more (a, delta-coded)."""
    for _, rows in groups_of(batches, "bucket"):
        hs, runs, many = [], [], []
        for r in rows:
            n = r["n"]
            hs.append(np.cumsum(unpack(r["a"], n, _U), dtype=_U))
            runs.append(np.full(n, r["run"], np.int32))
            many.append(np.unpackbits(unpack(r["b"], -(-n // 8), np.uint8))[:n].astype(bool))
        h, run, many = np.concatenate(hs), np.concatenate(runs), np.concatenate(many)
        order = np.argsort(h, kind="stable")
        h, run, many = h[order], run[order], many[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        count = np.diff(first, append=len(h))
        keep = np.repeat((count > 1) | np.logical_or.reduceat(many, first), count)
        h, run = h[keep], run[keep]
        rows = [(0, g, 1, len(i), pack(np.diff(h[i], prepend=_U(0))), b"", b"", b"") for g, i in split_by(run)]
        yield from sent(rows).to_batches()


def whole_mask(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bit o is set where the document has o bytes before the anchor and 50 - o from it on."""
    mask = np.zeros(len(left), _U32)
    for o in range(PIECES):
        mask |= ((left >= o) & (right >= LENGTH - o)).astype(_U32) << _U32(o)
    return mask


def send_suffixes(buckets: int):
    """A run's suffixes at repeated anchors, as front-coded sorted runs (kind 2):
    a = common prefix with the suffix before, b = the bytes after it, c = the
    bytes before the anchor, d = (doc rank, place, bytes before, bytes after).
    What the run settles itself passes through (kind 3): a = place, b = mask,
    c = place whose answer holds too."""
    def emit(key, table, repeats):
        if not table.num_rows or not repeats.num_rows:
            return sent([])
        run = Run(table)
        at, doc, h = run.anchors()
        known = np.sort(np.concatenate([np.cumsum(unpack(a, n, _U), dtype=_U) for a, n in zip(repeats["a"].to_pylist(), repeats["n"].to_pylist())]))
        i = np.minimum(np.searchsorted(known, h), len(known) - 1)
        hit = known[i] == h
        at, doc, h = at[hit], doc[hit], h[hit]
        if not len(at):
            return sent([])
        left, right = np.minimum(at - run.starts[doc], BEFORE), np.minimum(run.ends[doc] - at, LENGTH)
        place = np.arange(-BEFORE, LENGTH)
        inside = (place >= -left[:, None]) & (place < right[:, None])
        ctx = np.where(inside, run.bytes[np.clip(at[:, None] + place, 0, len(run.bytes) - 1)], 0).astype(np.uint8)
        words = np.zeros((len(at), 96), np.uint8)  # 56 bytes from the anchor on, 40 before
        words[:, :LENGTH], words[:, 56:56 + BEFORE] = ctx[:, BEFORE:], ctx[:, :BEFORE]
        w = words.view(">u8").astype(_U)
        order = np.lexsort((at, run.rank[doc], left, right, *w.T[::-1]))
        at, doc, h, left, right, ctx, w = (x[order] for x in (at, doc, h, left, right, ctx, w))
        # equal contexts: the least document speaks for all
        same = np.r_[False, (w[1:] == w[:-1]).all(axis=1) & (left[1:] == left[:-1]) & (right[1:] == right[:-1])]
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
        later = run.rank[doc] > run.rank[doc[head]]
        rows = []
        mask = np.where(later, whole_mask(left, right), _U32(0)).astype(_U32)
        rest = np.flatnonzero(same)
        if len(rest):
            follow = np.where(later, at, at[head])
            rows.append((int(key[0].as_py()) % buckets, key[0].as_py(), 3, len(rest), pack(at[rest].astype(_U32)), pack(mask[rest]),
                         pack(follow[rest].astype(_U32)), b""))
        keep = np.flatnonzero(~same)
        for g, k in split_by((h[keep] % _U(buckets)).astype(np.int32)):
            k = keep[k]
            after = ctx[k][:, BEFORE:]
            differ = after[1:] != after[:-1]
            lcp = np.r_[0, np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)].astype(np.uint8)
            about = pack(run.rank[doc[k]]), pack(at[k].astype(_U32)), pack(left[k].astype(np.uint8)), pack(right[k].astype(np.uint8))
            sizes = np.array([len(x) for x in about], _U32).tobytes()
            rows.append((g, key[0].as_py(), 2, len(k), pack(lcp), pack(after[np.arange(LENGTH) >= lcp[:, None]]),
                         pack(ctx[k][:, :BEFORE].copy()), sizes + b"".join(about)))
        return sent(rows)
    return emit


def decoded(lcp: np.ndarray, tails: bytes) -> list[int]:
    """The suffixes of a front-coded run as big-endian numbers, which compare as the bytes do."""
    out, at, before = [], 0, b""
    for p in lcp.tolist():
        before = before[:p] + tails[at:at + LENGTH - p]
        at += LENGTH - p
        out.append(int.from_bytes(before, "big"))
    return out


def merge_runs(values: list[list[int]], prefixes: list[list[int]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs with a loser tree on (common prefix with the last
    output, suffix): the run of each output in order, and each output's common
    prefix with the one before.  Of two candidates the one with the longer
    known prefix comes first; only if they are equal are the suffixes compared,
    which gives the loser's common prefix with the winner."""
    k = 1
    while k < len(values):
        k *= 2
    runs = len(values)
    head = [v[0] if v else 0 for v in values] + [0] * (k - runs)
    known = [0 if v else -1 for v in values] + [-1] * (k - runs)  # -1: the run has ended
    at, ends = [0] * runs, [len(v) for v in values]
    loser, lost = [0] * k, [0] * k  # at every inner node: the run that lost there, its prefix

    def build(node: int) -> tuple[int, int]:
        if node >= k:
            return node - k, known[node - k]
        (a, ha), (b, hb) = build(2 * node), build(2 * node + 1)
        if ha < hb:
            a, ha, b, hb = b, hb, a, ha
        elif ha == hb >= 0:
            x = head[a] ^ head[b]
            p = LENGTH - ((x.bit_length() + 7) >> 3)
            if head[b] < head[a]:
                a, ha, b, hb = b, hb, a, ha
            hb = p
        loser[node], lost[node] = b, hb
        return a, ha

    w, hw = build(1)
    order, lcps = [], []
    while hw >= 0:
        order.append(w)
        lcps.append(hw)
        at[w] += 1
        i = at[w]
        if i < ends[w]:
            head[w], hw = values[w][i], prefixes[w][i]
        else:
            hw = -1
        node = (w + k) >> 1
        while node:
            hl = lost[node]
            if hl > hw:
                o = loser[node]
                loser[node], lost[node] = w, hw
                w, hw = o, hl
            elif hl == hw and hl >= 0:
                o = loser[node]
                x = head[w] ^ head[o]
                p = LENGTH - ((x.bit_length() + 7) >> 3)
                if head[o] < head[w] or (not x and o < w):
                    loser[node], lost[node] = w, p
                    w = o
                else:
                    lost[node] = p
            node >>= 1
    return order, lcps


def settled(lcp: np.ndarray, before: np.ndarray, rank: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Masks of merged suffixes: bit o where some entry with common prefix of at
    least 50 - o and the same o bytes before has a smaller document."""
    mask, h = np.zeros(len(lcp), _U32), np.zeros(len(lcp), _U)
    for o in range(PIECES):
        if o:
            h = mixed(h + before[:, BEFORE - o].astype(_U) + _U(1))
        r = LENGTH - o
        stretch = np.cumsum(lcp < r)
        can = np.flatnonzero((left >= o) & (right >= r))
        if not len(can):
            continue
        key = mixed(h[can] + stretch[can].astype(_U) * _U(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        least = np.repeat(np.minimum.reduceat(rank[can[order]], first), np.diff(first, append=len(key)))
        won = can[order][rank[can[order]] > least]
        mask[won] |= _U32(1 << o)
    return mask


def merge_suffixes(batches):
    """Merge the runs of a bucket; to every run its places and masks (kind 4: a, b), and what it settled itself."""
    for _, rows in groups_of(batches, "bucket"):
        values, prefixes, runs, before, rank, place, left, right, through = [], [], [], [], [], [], [], [], []
        for r in rows:
            n = r["n"]
            if r["kind"] == 3:
                through.append((0, r["run"], 3, n, r["a"], r["b"], r["c"], b""))
                continue
            lcp = unpack(r["a"], n, np.uint8)
            values.append(decoded(lcp, unpack(r["b"], int((LENGTH - lcp.astype(np.int64)).sum()), np.uint8).tobytes()))
            prefixes.append(lcp.tolist())
            runs.append(r["run"])
            before.append(unpack(r["c"], n * BEFORE, np.uint8).reshape(n, BEFORE))
            sizes = np.frombuffer(r["d"][:16], _U32)
            cut = np.cumsum(np.r_[16, sizes]).tolist()
            for out, lo, hi, kind in zip((rank, place, left, right), cut, cut[1:], (np.int64, _U32, np.uint8, np.uint8)):
                out.append(unpack(r["d"][lo:hi], n, kind))
        if values:
            order, lcp = merge_runs(values, prefixes)
            order, lcp = np.array(order), np.array(lcp)
            by_run = np.argsort(order, kind="stable")  # merged places of the entries, run after run
            cat = lambda parts: np.concatenate(parts)
            to = np.empty(len(order), np.int64)
            to[by_run] = np.arange(len(order))  # merged place -> place in the joined arrays
            mask = settled(lcp, cat(before)[to], cat(rank)[to], cat(left)[to].astype(np.int64), cat(right)[to].astype(np.int64))
            own = mask[by_run]
            ends = np.cumsum([len(p) for p in place])
            for run, p, hi in zip(runs, place, ends):
                m = own[hi - len(p):hi]
                got = m > 0
                if got.any():
                    through.append((0, run, 4, int(got.sum()), pack(p[got]), pack(m[got]), b"", b""))
        if through:
            yield from sent(through).to_batches(max_chunksize=64)


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept_sha256", pa.string()), ("kept", pa.binary())])


def cut_out(with_text: bool):
    """The run's documents without what the masks cover."""
    def emit(key, table, answers):
        run = Run(table)
        n = len(run.bytes)
        edge = np.zeros(n + 1, np.int32)
        if answers.num_rows:
            masks = np.zeros(n, _U32)
            answers = sorted(answers.to_pylist(), key=lambda r: -r["kind"])  # answers before what follows them
            for r in answers:
                p, m = unpack(r["a"], r["n"], _U32).astype(np.int64), unpack(r["b"], r["n"], _U32)
                if r["kind"] == 4:
                    masks[p] |= m
                else:
                    masks[p] |= m | masks[unpack(r["c"], r["n"], _U32).astype(np.int64)]
            at = np.flatnonzero(masks)
            for o in range(PIECES):
                s = at[(masks[at] >> _U32(o)) & _U32(1) == 1] - o
                edge[s] += 1
                edge[s + LENGTH] -= 1
        gone = np.cumsum(edge[:n]) > 0
        rows = []
        for i, text, lo, hi in zip(run.ids, run.texts, run.starts.tolist(), run.ends.tolist()):
            own = gone[lo:hi]
            removed = int(own.sum())
            kept = text if not removed else run.bytes[lo:hi][~own].tobytes()
            spans = int((own[1:] & ~own[:-1]).sum()) + int(own[0]) if removed else 0
            rows.append((i, hi - lo, removed, spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RESULT)] if rows else [pa.array([], f.type) for f in RESULT],
                                    schema=RESULT)
    return emit


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes; null unless with_text)."""
    n = partitions(docs.sparkSession)
    runs, buckets = 2 * n, n
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash"),
                       text_or_empty().cast("binary").alias("text"))
    # one exchange of the texts, by a hash of id and text, serves all three readings of them
    rows = rows.withColumn("run", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(runs)).cast("int"))
    deal = lambda sent_: sent_.repartition(n, "bucket").sortWithinPartitions("bucket", "kind", "run")
    repeats = deal(rows.groupBy("run").applyInArrow(send_hashes(buckets), SENT_DDL)).mapInArrow(repeated_hashes, SENT_DDL)
    suffixes = rows.groupBy("run").cogroup(repeats.groupBy("run")).applyInArrow(send_suffixes(buckets), SENT_DDL)
    answers = deal(suffixes).mapInArrow(merge_suffixes, SENT_DDL)
    return rows.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(
        cut_out(with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
