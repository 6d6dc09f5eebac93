"""Periodic runs of words, by Lyndon roots from the grouping phase of a suffix sorter.

A document's words are numbered, and the grouping phase of Baier's suffix
sorter is run on the numbers under an order and under its reverse.  That phase
starts with one group of positions for each symbol and takes the groups from
the greatest down.  When a group comes up, its blocks are final: the length of
a block is the length of the longest Lyndon word that starts there.  Each
stretch of k equal blocks is then absorbed by the lesser block before it, which
moves to a new group right above its own (more blocks: higher).  Every position
is absorbed once, so the phase takes linear time but for sorting the k's.

Every run has a Lyndon root that is such a block under one of the two orders
(the one in which the word that breaks the run is the smaller).  Each block
whose copy follows it is extended to both sides by longest common extension;
roots inside a run that is known already are passed over.

Positions that no run can hold are cut out first: a run of exponent e >= 4 holds
each of its words at least 4 times, so a word with fewer occurrences in its
stretch ends the stretch.  That is repeated until nothing changes.  It loses no
run, and neither does it lengthen or shorten one.

Defined results: null text has no words; empty and blank texts neither.  Runs
never cross documents.  Repeated rows each give a row.  A null id is no number
to derive a rewriting from, so its words stay as they are.  A very long text is
one task's work in linear time and about 300 bytes a word that a run may hold.
Ties for the longest run go to the smallest start, then period.  An empty table
gives no rows.  Other columns are kept where asked for.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import by_value

by_value(__name__)

#: Shortest run, in words, and in periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Passes that cut stretches; what is left then is searched as it is, with the same result.
MOST_PASSES = 32
#: Words that a first look at a common extension compares; it doubles from there.
FIRST_LOOK = 16


def lyndon_lengths(s: list[int], symbols: int) -> list[int]:
    """The length of the longest Lyndon word that starts at each position of
    ``s``, whose numbers are below ``symbols``, by Baier's grouping.

    Groups form a chain from the greatest to the least (``below``); a block is a
    position with the length of its group; ``left`` gives the block before one."""
    n = len(s)
    group = list(s)
    width = [1] * symbols           # of the blocks of a group
    below = list(range(-1, symbols - 1))
    members = [[] for _ in range(symbols)]
    for i in range(n):
        members[s[i]].append(i)
    above = list(range(1, symbols + 1))
    left = list(range(-1, n - 1))   # of a block: the start of the block before it
    out = [0] * n
    g = symbols - 1
    while g >= 0:
        w = width[g]
        mine = [i for i in members[g] if group[i] == g]
        members[g] = ()
        if mine:
            mine.sort()
            moved: dict[int, list[int]] = {}
            times: dict[int, int] = {}
            at = 0
            size = len(mine)
            while at < size:
                head = mine[at]
                out[head] = w
                k, at, end = 1, at + 1, head + w
                while at < size and mine[at] == end:  # equal blocks in a row
                    out[end] = w
                    end += w
                    k += 1
                    at += 1
                u = left[head]
                if u >= 0:
                    moved.setdefault(group[u], []).append(u)
                    times[u] = k
                if end < n:
                    left[end] = u
            for old, starts in moved.items():
                by_k: dict[int, list[int]] = {}
                for u in starts:
                    by_k.setdefault(times[u], []).append(u)
                upper = above[old]
                under = old
                for k in sorted(by_k):
                    new = len(width)
                    width.append(width[old] + k * w)
                    members.append(by_k[k])
                    for u in by_k[k]:
                        group[u] = new
                    below.append(under)
                    above.append(upper)
                    above[under] = new
                    under = new
                below[upper] = under  # a group that absorbs is less than g, so there is one above it
        g = below[g]
    return out


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end), of LEAST_WORDS words or more, outside of which no
    run holds a position: a word that occurs less than LEAST_PERIODS times in a
    stretch parts it."""
    todo, out = [(0, len(ids), 0)], []
    while todo:
        lo, hi, passes = todo.pop()
        if hi - lo < LEAST_WORDS:
            continue
        if passes == MOST_PASSES:
            out.append((lo, hi))
            continue
        part = ids[lo:hi]
        if hi - lo > 64:
            _, inverse, counts = np.unique(part, return_inverse=True, return_counts=True)
            rare = np.flatnonzero(counts[inverse] < LEAST_PERIODS).tolist()
        else:
            few, seen = part.tolist(), {}
            for v in few:
                seen[v] = seen.get(v, 0) + 1
            rare = [i for i, v in enumerate(few) if seen[v] < LEAST_PERIODS]
        if not rare:
            out.append((lo, hi))
            continue
        before = -1
        for r in (*rare, hi - lo):
            if r - before > LEAST_WORDS:
                todo.append((lo + before + 1, lo + r, passes + 1))
            before = r
    return sorted(out)


def extension(s: np.ndarray, i: int, j: int, step: int) -> int:
    """The number of equal words at i, i + step, ... and j, j + step, ...; i < j."""
    most = len(s) - j if step > 0 else i + 1
    known, look = 0, FIRST_LOOK
    while known < most:
        m = min(look, most - known)
        if step > 0:
            differ = s[i + known:i + known + m] != s[j + known:j + known + m]
        else:
            differ = (s[i - known - m + 1:i - known + 1] != s[j - known - m + 1:j - known + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return known + first
        known += m
        look *= 2
    return known


def runs_of_stretch(s: np.ndarray) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of a stretch, by both orders' roots."""
    names, s = np.unique(s, return_inverse=True)
    n, found = len(s), set()
    for order in (s, len(names) - 1 - s):
        width = np.array(lyndon_lengths(order.tolist(), len(names)), dtype=np.int64)
        i = np.arange(n)
        # only roots whose copy can follow
        i = i[i + 2 * width <= n]
        i = i[s[i] == s[i + width[i]]]
        end: dict[int, int] = {}  # period -> where the last run found ends
        for at, p in zip(i.tolist(), width[i].tolist()):
            if end.get(p, -1) >= at + p:
                continue
            right = extension(s, at, at + p, 1)
            if right < p:
                continue
            back = extension(s, at - 1, at + p - 1, -1) if at else 0
            end[p] = at + p + right
            length = back + p + right
            if length >= max(LEAST_WORDS, LEAST_PERIODS * p):
                found.add((at - back, length, p))
    return found


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of words, by start and period."""
    if len(words) < LEAST_WORDS:
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    return sorted((lo + at, length, p) for lo, hi in stretches(ids) for at, length, p in runs_of_stretch(ids[lo:hi]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def words_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text (bytes.split parts at the six ASCII spaces only)."""
    return text.split()


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a repetition in place of the end of every tenth document
    (by crc32 of the id): the report's own plants, from the document's words."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // len(unit) + 1))[:n - a]


RUNS = "array<struct<start: long, length: long, period: long>>"


def run_table(docs: DataFrame, keep: list[str] = (), rewrite: str | None = None, with_text: bool = True) -> DataFrame:
    """``keep``, n_words, runs (array of start, length, period by start, period)
    and collapsed (the kept words joined by spaces; sha256 of it if not
    ``with_text``) of each document.  ``rewrite`` names the id column by which
    the words are rewritten first (``planted``)."""
    cols = [*keep, *([rewrite] if rewrite and rewrite not in keep else [])]
    rows = docs.select(*cols, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_words_of_"))
    out = pa.schema([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                     ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            texts = b.column(names.index("_words_of_"))
            ids = b.column(names.index(rewrite)) if rewrite else None
            # a few megabytes of text leave at a time
            size, lo, got = 0, 0, []
            for k in range(b.num_rows):
                words = words_of(texts[k].as_py())
                if rewrite:
                    words = planted(words, ids[k].as_py())
                runs = find_runs(words)
                rest = b" ".join(collapsed(words, runs))
                rest = rest.decode("utf-8", "replace") if with_text else hashlib.sha256(rest).hexdigest()
                got.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], rest))
                size += len(rest) + 48 * len(runs)
                if size > 4 << 20 or k == b.num_rows - 1:
                    kept = [b.column(names.index(c)).slice(lo, len(got)) for c in keep]
                    made = [pa.array(c, f.type) for c, f in zip(zip(*got), out)]
                    yield pa.RecordBatch.from_arrays([*kept, *made], names=[*keep, *out.names])
                    size, lo, got = 0, k + 1, []

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.mapInArrow(run, f"{kinds}n_words long, runs {RUNS}, collapsed string")


def run_digests(table: DataFrame) -> DataFrame:
    """The report on a ``run_table`` without texts: doc_id, n_words, n_runs, the
    longest run, the digest of all runs and that of the collapsed text."""
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.try_element_at("runs", F.lit(1)),
                    lambda a, b: F.when(b.length > a.length, b).otherwise(a))  # runs come by start, then period
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n")))
    longest = F.col("longest")
    return table.withColumn("longest", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), longest.start.alias("start"), longest.length.alias("length"),
        longest.period.alias("period"), F.floor(1000 * longest.length / longest.period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))
