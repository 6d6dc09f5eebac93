"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is the weighted set of its five-word shingles (weight = number of
occurrences; words are split at ASCII spaces and A-Z lower-cased).  Each
shingle is a Poisson process whose rate is its weight: its arrivals fall into
registers at random, a register keeps the shingle that arrives first, and a
shingle's process ends once its next arrival is later than every register's
(early termination).  Two documents agree in a register with the probability
that is their probability Jaccard similarity.

Equal word sequences form one class.  Classes that share a band of registers
are candidates.  Groups are found without listing all pairs of a band: each
class is verified against its band's centres, the classes that meet the most
others (an original meets more than its copies do); whoever is then not
connected to most of the band is verified against every other class of the
band that is not in its group and shares a difference from the centre that a link
needs (an exact prefix filter, see _apart).  So no link between different texts that share
a band is lost for the grouping, and a band of n copies costs n verifications.

A pair is a link if its exact probability Jaccard or its exact set Jaccard on
shingles is at least the threshold.

Defined results: documents without words (null, empty, blank) are copies of
each other; shorter documents than a shingle are one shingle of all their
words; equal rows are copies; a null doc_id sorts after all others; an empty table gives
no rows; other columns are ignored by find_groups and kept by deduplicate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlens.llm.common import by_value, stored, text_or_empty, thinned
from chainlens.llm.graph import connected_components

by_value(__name__)

SHINGLE = 5
THRESHOLD = 0.8
#: At similarity 0.8 a pair shares one of 20 bands of 4 registers but for 2e-5 of cases.
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
#: Classes of a band that are tried as its centre, one after the other.
CENTRES = 3
RUN_BYTES = 4 << 20
CACHE_WORDS = 400_000
_U = np.uint64
_LAST = (1 << 63) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHash(dict):
    """word -> 64-bit hash; a cache of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(word_hashes: np.ndarray) -> np.ndarray:
    """One hash per run of SHINGLE words; one for all words of a shorter text."""
    k = min(SHINGLE, len(word_hashes))
    if not k:
        return np.zeros(0, _U)
    n = len(word_hashes) - k + 1
    h = np.zeros(n, _U)
    for j in range(k):
        h = mixed(h + word_hashes[j:j + n] + _U(0x9E3779B97F4A7C15))
    return h


def weighted_shingles(texts: list[bytes], cache: WordHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, weight) arrays, ordered by document and shingle."""
    parts, n = [], []
    for t in texts:
        words = t.lower().split()
        s = np.sort(shingle_hashes(np.fromiter(map(cache.__getitem__, words), _U, len(words))))
        parts.append(s), n.append(len(s))
    s = np.concatenate([np.zeros(0, _U), *parts])
    doc = np.repeat(np.arange(len(texts)), n)
    first = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])]) if len(s) else np.zeros(0, int)
    return doc[first], s[first], np.diff(first, append=len(s)).astype(float)


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    """docs x REGISTERS of the shingles that arrive first."""
    when, who = np.full(docs * REGISTERS, np.inf), np.zeros(docs * REGISTERS, _U)
    t, arrival = np.zeros(len(doc)), 0
    while len(doc):
        arrival += 1
        r = mixed(shingle + _U(arrival * 0x9E3779B97F4A7C15 % 2 ** 64))
        t = t - np.log(((r >> _U(11)).astype(float) + 0.5) * 2.0 ** -53) / weight
        at = doc * REGISTERS + (mixed(r ^ _U(0x2545F4914F6CDD1D)) % _U(REGISTERS)).astype(np.int64)
        np.minimum.at(when, at, t)
        won = t == when[at]
        who[at[won]] = shingle[won]
        latest = when.reshape(docs, REGISTERS).max(axis=1)
        live = t < latest[doc]  # later arrivals of the others cannot come first anywhere
        doc, shingle, weight, t = doc[live], shingle[live], weight[live], t[live]
    return who.reshape(docs, REGISTERS)


def band_hashes(who: np.ndarray) -> np.ndarray:
    h = np.broadcast_to(np.arange(BANDS, dtype=_U), (len(who), BANDS)).copy()
    for j in range(ROWS):
        h = mixed(h * _U(0x9E3779B97F4A7C15) + who[:, j::ROWS])
    return h.astype(np.int64)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (text bytes first) in lists of about RUN_BYTES of text."""
    run, size = [], 0
    for b in batches:
        for row in zip(*b.columns):
            run.append(tuple(v.as_py() for v in row))
            size += len(run[-1][0])
            if size >= RUN_BYTES:
                yield run
                run, size = [], 0
    if run:
        yield run


SIGNED = "doc_id long, text_hash long, words_hash binary, bands array<long>"
SETS = "node long, n long, shingles binary, weights binary"
DIFFS = "centre long, node long, spare double, diff array<long>"


def _sign(batches):
    cache = WordHash()
    for run in runs(batches):
        texts = [r[0] for r in run]
        doc, shingle, weight = weighted_shingles(texts, cache)
        bands = band_hashes(signatures(doc, shingle, weight, len(run)))
        has = np.zeros(len(run), bool)
        has[doc] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[1] for r in run], pa.int64()), pa.array([r[2] for r in run], pa.int64()),
             pa.array([xxhash.xxh3_128_digest(b" ".join(t.lower().split())) for t in texts], pa.binary()),
             pa.array([list(b) if h else None for b, h in zip(bands, has)], pa.list_(pa.int64()))],
            names=["doc_id", "text_hash", "words_hash", "bands"])


def _sets(batches):
    cache = WordHash()
    for run in runs(batches):
        doc, shingle, weight = weighted_shingles([r[0] for r in run], cache)
        at = np.searchsorted(doc, np.arange(len(run) + 1))
        sets = [shingle[lo:hi].tobytes() for lo, hi in zip(at[:-1], at[1:])]
        # weights are mostly 1: a byte string that compresses well
        ws = [pa.compress(weight[lo:hi].astype(np.int32).tobytes(), codec="zstd", asbytes=True) if hi > lo else b"" for lo, hi in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[1] for r in run], pa.int64()), pa.array(np.diff(at)), pa.array(sets, pa.binary()), pa.array(ws, pa.binary())],
            names=["node", "n", "shingles", "weights"])


def _read(shingles: pa.BinaryScalar, weights: pa.BinaryScalar, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, weights) of a row of SETS with n > 0."""
    return np.frombuffer(shingles.as_buffer(), _U), np.frombuffer(pa.decompress(weights.as_buffer(), 4 * n, codec="zstd", asbytes=True), np.int32)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> tuple[float, float]:
    """(probability Jaccard, set Jaccard) of two weighted sets with sorted elements."""
    both, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0, 0.0
    plain = len(both) / (len(a) + len(b) - len(both))
    # sum over common d of 1 / sum over d' of max(wa(d')/wa(d), wb(d')/wb(d)): the max
    # turns where wb(d')/wa(d') passes wb(d)/wa(d), so sorted ratios and prefix sums do
    ratio = wb[ib] / wa[ia]
    order = np.argsort(ratio, kind="stable")
    ra, sa, sb = ratio[order], wa[ia][order], wb[ib][order]
    only_a, only_b = wa.sum() - sa.sum(), wb.sum() - sb.sum()
    ca, cb = np.cumsum(sa), np.cumsum(sb)
    hi = np.searchsorted(ra, ra, side="right") - 1  # elements up to here count by wa
    need = (ca[hi] + only_a) / sa + (cb[-1] - cb[hi] + only_b) / sb
    return float((1 / need).sum()), plain


def _verify(threshold: float):
    def run(batches):
        for b in batches:
            keep = []
            for na, sa, wa, nb, sb, wb in zip(*(b.column(c) for c in ("na", "sa", "wa", "nb", "sb", "wb"))):
                na, nb = na.as_py(), nb.as_py()
                if min(na, nb) == 0:
                    keep.append(False)
                    continue
                a, wa = _read(sa, wa, na)
                b_, wb = _read(sb, wb, nb)
                keep.append(max(similarity(a, wa.astype(float), b_, wb.astype(float))) >= threshold)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])
    return run


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of class numbers with the sets of both."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("shingles").alias(f"s{x}"),
                                 F.col("weights").alias(f"w{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _linked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of class numbers that verification accepts."""
    # lengths alone rule out a set Jaccard; a probability Jaccard has no such bound, so all pairs are read
    return _with_sets(pairs, sets).mapInArrow(_verify(threshold), "a long, b long")


def _differ(threshold: float):
    """Of rows (centre a, class b) with their sets: how the class differs from the
    centre (diff), and how many shingles more than its share of a link (spare).

    A link (x, y) has |x xor y| <= edge * (g(x) + g(y)), where g adds up c + 2 max(w - c, 0)
    for shingles of weight w that the centre has with weight c, and 2 w - 1 for others.
    For a set Jaccard that is plain, as g is at least the size.  A probability Jaccard
    is at most 1 - W / M: W is the weight of what one set has alone, M is W and the
    greater weights of what both have, and 2 M <= 2 W + g(x) + g(y) - |x xor y|, as a greater
    weight is at most c + max(w - c, 0) of both sets and what one has alone is counted
    by half or more; weights are 1 or more, so |x xor y| <= W."""
    edge = (1 - threshold) / (1 + threshold)

    def run(batches):
        for b in batches:
            spare, diff = [], []
            for na, sa, wa, nb, sb, wb in zip(*(b.column(c) for c in ("na", "sa", "wa", "nb", "sb", "wb"))):
                (x, c), (y, w) = _read(sa, wa, na.as_py()), _read(sb, wb, nb.as_py())
                c, w = c.astype(np.int64), w.astype(np.int64)
                both, ix, iy = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                g = (c[ix] + 2 * np.maximum(w[iy] - c[ix], 0)).sum() + 2 * (w.sum() - w[iy].sum()) - (len(w) - len(both))
                diff.append(np.setxor1d(x, y, assume_unique=True).view(np.int64))
                spare.append(len(diff[-1]) - edge * int(g))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(spare, pa.float64()), pa.array(diff, pa.list_(pa.int64()))],
                                             names=["centre", "node", "spare", "diff"])
    return run


def _apart(named: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of classes that share a band and have two labels, all that can
    be links among them, but for those of a band's own centre.  ``named``: band,
    centre, node, label.

    Of the classes around a centre most have one label; every such pair has a class
    of another, and only those meet the rest.  They meet by their differences from
    the centre, not by the band, so a band of many texts that are alike but below
    the threshold has few such pairs.  What two sets differ in is what their
    differences differ in, so a link shares at least half the sum of their spares of
    them (see _differ), and with the rarest difference it shares come as many that are no
    rarer (rest).  Pairs whose spares need no shared difference meet on their own."""
    node = named.groupBy("centre", "node").agg(F.first("label").alias("label"))
    of_label = node.groupBy("centre", "label").agg(F.count("*").alias("n"))
    main = of_label.groupBy("centre").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels"))
    node = node.join(main.where(F.col("labels") > 1), "centre").where(F.col("node") != F.col("centre"))
    node = stored(node.select("centre", "node", "label", (F.col("label") != F.col("main")).alias("outside")), "dup-around")
    diffs = _with_sets(node.select(F.col("centre").alias("a"), F.col("node").alias("b")), sets).mapInArrow(_differ(threshold), DIFFS)
    diffs = stored(diffs.join(node, ["centre", "node"]), "dup-diffs")
    least = diffs.groupBy("centre").agg(F.min("spare").alias("least"), F.min(F.when(F.col("outside"), F.col("spare"))).alias("least_out"))
    diffs = diffs.join(least.where(F.col("least_out").isNotNull()), "centre")

    every = diffs.select("centre", "node", "label", "outside", "spare", "least", "least_out", F.explode("diff").alias("shingle"))
    held = every.groupBy("centre", "shingle").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    down = Window.partitionBy("centre", "node").orderBy(F.desc("held"), "shingle").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = every.join(held, ["centre", "shingle"]).withColumn("rest", F.count("*").over(down))
    lowest = F.when(F.col("outside"), F.col("least")).otherwise(F.col("least_out"))
    first = stored(first.where(F.col("rest") >= (F.col("spare") + lowest) / 2 - 1e-6).drop("held", "least"), "dup-prefixes")
    beside = lambda df, *by: df.where("outside").select("centre", *by, *[F.col(c).alias(f"o_{c}") for c in ("node", "label", "spare")])
    other = (F.col("label") != F.col("o_label")) & (~F.col("outside") | (F.col("o_node") < F.col("node")))
    needed = (F.col("spare") + F.col("o_spare")) / 2
    pair = lambda df: df.select(F.least("o_node", "node").alias("a"), F.greatest("o_node", "node").alias("b"))

    o = beside(first, "shingle", F.col("rest").alias("o_rest"))
    out = first.where(F.col("outside") & (F.col("rest") >= (F.col("spare") + F.col("least_out")) / 2 - 1e-6))
    enough = F.least("rest", "o_rest") >= needed - 1e-6
    met = [pair(beside(out, "shingle", F.col("rest").alias("o_rest")).join(out, ["centre", "shingle"]).where(other & enough)),
           pair(o.join(first.where("NOT outside"), ["centre", "shingle"]).where(other & enough))]
    # few texts but those of many repeated shingles come here
    slack = diffs.select("centre", "node", "label", "outside", "spare", "least", "least_out")
    o = beside(slack.where(F.col("spare") + F.col("least") <= 2e-6))
    met.append(pair(o.join(slack.where(F.col("spare") + F.col("least_out") <= 2e-6), "centre").where(other & (needed <= 1e-6))))
    met = met[0].union(met[1]).union(met[2]).distinct()
    bands = stored(named.groupBy("node").agg(F.collect_list("band").alias("bands")), "dup-bands-of")
    side = lambda x: bands.select(F.col("node").alias(x), F.col("bands").alias(f"bands_{x}"))
    return met.join(side("a"), "a").join(side("b"), "b").where(F.arrays_overlap("bands_a", "bands_b")).select("a", "b")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(text_or_empty().cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text_or_empty()).alias("text_hash"))


def find_groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, text_hash, group_id (least doc_id of its
    group), group_size, kept (true for one row of each group)."""
    rows = _rows(docs)
    signed = stored(rows.mapInArrow(_sign, SIGNED).withColumn("row", F.monotonically_increasing_id()), "dup-signed")
    has_words = signed.where(F.col("bands").isNotNull())
    rank = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("at"), "row")
    classes = stored(signed.groupBy("words_hash").agg(F.min(rank).alias("first")).select("words_hash", F.col("first.row").alias("node")), "dup-classes")

    # members of bands that two classes or more share, with the number of classes they meet
    first = has_words.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    member = first.select(F.col("row").alias("node"), F.explode("bands").alias("band"))
    shared = member.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    member = stored(member.join(shared, "band"), "dup-bands")
    met_by = member.groupBy("node").agg(F.sum("n").alias("meets"))
    # an original meets more than each of its copies does: the first CENTRES of a band are tried as its centre
    place = Window.partitionBy("band").orderBy(F.desc("meets"), "node")
    centres = member.join(met_by, "node").withColumn("place", F.row_number().over(place)).where(F.col("place") <= CENTRES)
    centres = stored(centres.select("band", F.col("node").alias("centre"), "place"), "dup-centres")

    wanted = member.select(F.col("node").alias("row")).distinct()
    by = ["id", "no_id", "text_hash"]
    own = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), "text_hash"]
    nodes = stored(signed.join(wanted, "row", "left_semi").select(F.col("row").alias("node"), *own), "dup-nodes")
    texts = thinned(rows.select("text", *own), nodes, by)
    # rows of one id and text come to one place, where one stays
    texts = texts.join(nodes, by).groupBy(*by).agg(F.first("text").alias("text"), F.first("node").alias("node"))
    sets = stored(texts.select("text", "node").mapInArrow(_sets, SETS), "dup-sets")

    links = tried = None
    label = member.select("node", F.col("node").alias("label")).limit(0)
    for k in range(1, CENTRES + 1):
        named = member.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        c = centres.where(F.col("place") == k).join(label.withColumnRenamed("node", "centre"), "centre", "left")
        c = c.select("band", "centre", F.coalesce("label", "centre").alias("centre_label"))
        apart = named.join(c, "band").where(F.col("label") != F.col("centre_label"))
        star = apart.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()
        star = stored(star if tried is None else star.join(tried, ["a", "b"], "left_anti"), "dup-star")
        found = stored(_linked(star, sets, threshold), "dup-links")
        tried = star if tried is None else tried.unionByName(star)
        links = found if links is None else links.unionByName(found)
        label = connected_components(links)

    # all pairs of a band of CENTRES + 1 classes have a centre, so they were tried or were connected
    named = member.where(F.col("n") > CENTRES + 1).join(centres.where(F.col("place") == 1).select("band", "centre"), "band")
    named = named.join(label, "node", "left").select("band", "centre", "node", F.coalesce("label", "node").alias("label"))
    named = stored(named, "dup-named")
    more = stored(_apart(named, sets, threshold).join(tried, ["a", "b"], "left_anti"), "dup-more")
    links = links.unionByName(_linked(more, sets, threshold))
    label = connected_components(links)

    named = classes.join(label, "node", "left").select("words_hash", F.coalesce("label", "node").alias("label"))
    every = signed.select("doc_id", "text_hash", "row", "words_hash").join(named, "words_hash")
    heads = every.groupBy("label").agg(F.min(rank).alias("head"), F.min("doc_id").alias("group_id"), F.count("*").alias("group_size"))
    return every.join(heads, "label").select("doc_id", "text_hash", "group_id", "group_size", (F.col("row") == F.col("head.row")).alias("kept"))


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all its columns) that find_groups keeps."""
    kept = find_groups(docs, threshold).where("kept").select(F.col("doc_id").cast("long").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    # a row is carried as one struct, so its columns may have any name
    own = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("own_id"), F.xxhash64(text_or_empty()).alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash"))
    out = own.join(kept.hint("merge"), same, "left_semi").groupBy("own_id", "own_hash").agg(F.first("doc").alias("doc"))  # equal rows: one stays
    return out.select("doc.*")
