"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents, in doc_id order, form one stream of words that is cut
into equal blocks.  The mix takes an exact quota of blocks per source: the
blocks are put in a pseudo-random order (an affine bijection), passed through
once or twice, and the first ``quota`` places are taken.  The quotas are
divided among the output shards by a splitting tree: at every node the left
half's share of each source is drawn from the multivariate hypergeometric
distribution, so shard contents are as from one great shuffle while every
count stays exact.  Shard m then owns a disjoint interval of each source's
places, and orders its own blocks by a hash.

Only one row per source (the catalogue) meets in one task; documents never do.

Defined results: null text has size 0 and is never taken; null source is a
source of its own, last in order; rows of equal doc_id are rows of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlens.llm.common import WORD, by_value, stored, text_or_empty

by_value(__name__)

#: Words in a block, unless the source has fewer than SOURCE_BLOCKS such blocks.
BLOCK_WORDS = 512
SOURCE_BLOCKS = 256
#: Blocks of all sources together: a hypergeometric draw takes fewer than 10^9.
MOST_BLOCKS = 250_000_000
SHARDS = 64

CATALOGUE = ("source string, source_size long, target double, block_words long, n_blocks long, quota long, "
             "step long, shift long, shard_ends array<long>")


def water_fill(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Targets of sum share * total in proportion to the weights, none above
    most * its size; what a capped source cannot take is shared again by weight."""
    total = share * sum(sizes)
    caps = [most * s for s in sizes]
    target, free = [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left = total - sum(caps[i] for i in range(len(sizes)) if i not in free)
        unit = left / sum(weights[i] for i in free)
        over = {i for i in free if unit * weights[i] > caps[i]}
        if not over:
            for i in free:
                target[i] = unit * weights[i]
            break
        for i in over:
            target[i] = float(caps[i])
        free -= over
    return target


def splitting_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """shards x sources block counts: columns sum to the quotas, rows differ by
    one block at most, and every split is a multivariate hypergeometric draw."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    total = int(quotas.sum())
    # rows 0..left-1 of an even deal of `total` blocks over `shards`
    n_left = total // shards * left + min(left, total % shards)
    took, rest, need = np.zeros_like(quotas), total, n_left
    for i, q in enumerate(quotas.tolist()):
        rest -= q
        took[i] = rng.hypergeometric(q, rest, need) if q and need else 0
        need -= int(took[i])
    return np.vstack([splitting_tree(took, left, rng), splitting_tree(quotas - took, shards - left, rng)])


def catalogue(sizes: pd.DataFrame, weights: tuple, share: float, most: float, shards: int, block_words: int,
              seed: int) -> pd.DataFrame:
    """The plan of every source; ``sizes`` has one row per source."""
    sizes = sizes.assign(none=sizes.source.isna(), point=[b"" if s is None else s.encode() for s in sizes.source])
    sizes = sizes.sort_values(["none", "point"]).reset_index(drop=True)
    total = [int(x) for x in sizes.source_size]
    target = water_fill(total, [weights[i % len(weights)] for i in range(len(total))], share, most)
    rng = np.random.default_rng(seed)
    least = -(-sum(total) // MOST_BLOCKS)  # the draws of the tree are bounded
    block = [max(least, min(block_words, max(1, s // SOURCE_BLOCKS))) for s in total]
    n_blocks = [-(-s // b) for s, b in zip(total, block)]
    quota = [min(round(t / b), int(most * n)) for t, b, n in zip(target, block, n_blocks)]
    step, shift = [], []
    for n in n_blocks:
        a = int(rng.integers(1, max(n, 2)))
        while math.gcd(a, max(n, 1)) != 1:
            a += 1
        step.append(a)
        shift.append(int(rng.integers(0, max(n, 1))))
    counts = splitting_tree(np.array(quota, dtype=np.int64), shards, rng)
    return pd.DataFrame({"source": sizes.source, "source_size": total, "target": target, "block_words": block,
                         "n_blocks": n_blocks, "quota": quota, "step": step, "shift": shift,
                         "shard_ends": list(np.cumsum(counts, axis=0).T)})


def word_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, source, size, start): where each document begins in its source's
    word stream.  Running sums are taken inside range partitions and shifted by
    the partition totals, so a source of any size is spread over many tasks."""
    sizes = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    dealt = sizes.repartitionByRange("source", "doc_id", "size", "text_hash").withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "mix-sizes")
    here = Window.partitionBy("part", "source").orderBy("doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("part", "source").agg(F.sum("size").alias("n"))
               .select("part", "source", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    x = dealt.withColumn("inner", F.coalesce(F.sum("size").over(here), F.lit(0))).alias("x")
    o = offsets.alias("o")
    return (x.join(o, (F.col("x.part") == F.col("o.part")) & F.col("x.source").eqNullSafe(F.col("o.source")))
            .select("x.doc_id", "x.text_hash", "x.source", "x.size", (F.col("inner") + F.col("offset")).alias("start")))


def mix_sources(docs: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, most: int = 2, shards: int = SHARDS,
                block_words: int = BLOCK_WORDS, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, text_hash, source, size, source_size, target, and the
    places its blocks take in the mix: pieces array<struct<place, first_word,
    n_words>>; first_word counts from the document's start, a repeated block
    is a second piece.  shard_ends, the shards' ends among the source's places,
    maps a place to its shard."""
    spans = word_spans(docs)
    plan = (spans.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("all", F.lit(0))
            .groupBy("all").applyInPandas(
                lambda rows: catalogue(rows[["source", "source_size"]], weights, share, most, shards, block_words, seed),
                CATALOGUE))
    plan = stored(plan, "mix-plan")
    x = spans.alias("x").join(plan.alias("p"), F.col("x.source").eqNullSafe(F.col("p.source"))).select(
        "x.doc_id", "x.text_hash", "x.source", "x.size", "x.start", "p.source_size", "p.target", "p.block_words", "p.n_blocks",
        "p.quota", "p.step", "p.shift", "p.shard_ends")
    end = F.col("start") + F.col("size")
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / F.col("block_words")),
                                                  F.floor((end - 1) / F.col("block_words")))).otherwise(
        F.array().cast("array<long>"))

    def piece(turn):
        def build(b):
            lo = F.greatest(F.col("start"), b * F.col("block_words"))
            hi = F.least(end, (b + 1) * F.col("block_words"))
            place = F.lit(turn) * F.col("n_blocks") + (b * F.col("step") + F.col("shift")) % F.col("n_blocks")
            return F.struct(place.alias("place"), (lo - F.col("start")).alias("first_word"), (hi - lo).alias("n_words"))
        return build

    taken = F.concat(*[F.filter(F.transform(blocks, piece(t)), lambda p: p["place"] < F.col("quota"))
                       for t in range(math.ceil(most))])
    return x.select("doc_id", "text_hash", "source", "size", "source_size", "target", taken.alias("pieces"), "shard_ends")


def shard_pieces(mix: DataFrame, seed: int = 7) -> DataFrame:
    """The mix dealt to its shards: one row per piece (shard, order_key, doc_id,
    source, first_word, n_words), each shard's pieces in hashed order."""
    rows = mix.select("doc_id", "source", "shard_ends", F.explode("pieces").alias("p"))
    shard = F.size(F.filter("shard_ends", lambda e: e <= F.col("p.place")))
    return (rows.select(shard.alias("shard"), F.xxhash64(F.lit(seed), "source", "p.place").alias("order_key"), "doc_id",
                        "source", "p.first_word", "p.n_words")
            .repartition("shard").sortWithinPartitions("shard", "order_key", "doc_id", "first_word"))


def mixed_texts(mix: DataFrame, docs: DataFrame, seed: int = 7) -> DataFrame:
    """Per document of the mix: doc_id, source, size, source_size, target, taken
    and its pieces array<struct<shard, order_key, first_word, n_words, text>>;
    a piece's text is its words, one space between.  Sorting a shard's pieces by
    order_key gives its order."""
    texts = docs.select(F.col("doc_id").alias("own_id"), F.xxhash64(text_or_empty()).alias("own_hash"), "text").groupBy(
        "own_id", "own_hash").agg(F.first("text").alias("text"))
    x = mix.join(texts, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")), "left")
    x = x.withColumn("words", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)))

    def piece(p):
        return F.struct(F.size(F.filter("shard_ends", lambda e: e <= p["place"])).alias("shard"),
                        F.xxhash64(F.lit(seed), "source", p["place"]).alias("order_key"), p["first_word"].alias("first_word"), p["n_words"].alias("n_words"),
                        F.array_join(F.slice("words", (p["first_word"] + 1).cast("int"), p["n_words"].cast("int")), " ").alias("text"))

    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["n_words"])
    return x.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), F.transform("pieces", piece).alias("pieces"))


def mix_totals(mix: DataFrame) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (words the mix takes)."""
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["n_words"])
    return mix.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"),
                      F.size("pieces").cast("long").alias("n_pieces"))
