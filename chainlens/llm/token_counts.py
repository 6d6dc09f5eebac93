"""Exact length histogram of encoded documents.

Documents are encoded where they lie and only a (length, count) histogram is
shuffled.  Suffix sums over the histogram then answer, for every context
limit L, how many documents fit, how many tokens a cut at L keeps, and every
quantile, without reading the documents again.

Null text counts as empty (length 0); an empty table gives an empty
histogram; other columns are ignored.  Texts are encoded whole.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlens.llm.common import by_value

by_value(__name__)

#: Local folder with the public tokenizer files; present on every worker.
TOKENIZER_DIR = "/opt/tokenizers"
TOKENIZER_FILE = "byte_bpe_50k.tiktoken"
#: The published pre-tokeniser pattern of that vocabulary (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

#: Lengths per block of the two-level suffix sums.
BLOCK = 128

_ENCODERS: dict = {}


def encoder(tokenizer_dir: str, file: str, pattern: str):
    """The byte-level BPE of a rank file, made once per worker process."""
    key = (tokenizer_dir, file, pattern)
    if key not in _ENCODERS:
        import tiktoken

        with open(f"{tokenizer_dir}/{file}", "rb") as lines:
            ranks = {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, lines)}
        _ENCODERS[key] = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def length_histogram(docs: DataFrame, tokenizer_dir: str = TOKENIZER_DIR, file: str = TOKENIZER_FILE,
                     pattern: str = PATTERN) -> DataFrame:
    """(n_tokens, n_docs): one row per distinct encoded length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(tokenizer_dir, file, pattern), Counter()
        for batch in batches:
            seen.update(len(enc.encode_ordinary(t.as_py() or "")) for t in batch.column(0))
        yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(list(seen.keys()), pa.int64()),
                                          "n_docs": pa.array(list(seen.values()), pa.int64())})

    part = docs.select("text").mapInArrow(count, "n_tokens long, n_docs long")
    return part.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row per distinct length, read as a context limit L:

    docs_over / tokens_over are suffix sums over lengths > L, docs_within and
    tokens_within their complements, tokens_kept = sum of min(length, L), and
    quantile = share of documents of at most L tokens.  Sums run inside blocks
    of 128 lengths and over the block totals (longest length / 128 rows),
    so no task holds the whole histogram.
    """
    block = F.floor(F.col("n_tokens") / BLOCK)
    rows = histogram.withColumn("block", block)
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = (rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
              .select("block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
                      F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
                      F.sum("d").over(everything).alias("d_all"), F.sum("t").over(everything).alias("t_all")))
    longer = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    x = rows.join(totals, "block").withColumns({
        "docs_over": F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("d_after"),
        "tokens_over": F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")).over(longer), F.lit(0)) + F.col("t_after"),
    })
    return x.select(
        F.col("n_tokens").alias("context_limit"), "n_docs", "docs_over", "tokens_over",
        (F.col("d_all") - F.col("docs_over")).alias("docs_within"),
        (F.col("t_all") - F.col("tokens_over")).alias("tokens_within"),
        (F.col("t_all") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("tokens_kept"),
        F.col("t_all").alias("total_tokens"), F.col("d_all").alias("total_docs"),
        ((F.col("d_all") - F.col("docs_over")) / F.col("d_all")).alias("quantile"))


def tokens_kept_at(limits: DataFrame, context_limit: int) -> DataFrame:
    """One row: documents and tokens of the corpus cut at any limit, also one
    that no document has (the nearest smaller length answers it)."""
    row = limits.where(F.col("context_limit") <= context_limit).agg(F.max_by(
        F.struct("tokens_within", "docs_over", "docs_within"), "context_limit").alias("r"))
    first = limits.agg(F.max("total_docs").alias("n"))
    return row.join(first).select(
        F.lit(context_limit).cast("long").alias("context_limit"),
        F.coalesce(F.col("r.docs_within"), F.lit(0)).alias("docs_within"),
        (F.coalesce(F.col("r.tokens_within"), F.lit(0))
         + F.coalesce(F.col("r.docs_over"), F.col("n"), F.lit(0)) * context_limit).alias("tokens_kept"))


def length_quantile(limits: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length that at least a share ``q`` of documents does not exceed."""
    return limits.where(F.col("quantile") >= q).agg(F.min("context_limit").alias("length"))
