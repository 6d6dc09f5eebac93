"""Keyed partial-column upsert and in-batch de-duplication.

Semantics (all tables, B-1 … B-8): on a key conflict only the spec's
``updated`` columns take the batch value and the ``stamp`` column is re-set;
every other column keeps the value first inserted.  A NULL in any key column
never conflicts (SQL UNIQUE), so such rows are appended as they are.  Within a
batch the last row per key (by ``seq``) wins (F-1).

Plan: the batch is reduced to the last row of each key, the stored rows to one of
each key, and the two meet in a full outer join on the key, which takes the kept
columns from the stored row, else the batch's, and the updated ones from the batch's
row, else the stored one.  The aggregates are partial (map-side), so a key holding
a third of all rows is reduced in every task before the shuffle, and dealt by the
key already, so the join moves nothing: each row is exchanged once, and a table
that was reduced by the same key before not at all.

When the batch is small next to the stored table (``strategy="touched"``, or
``"auto"`` with a counted batch under ``broadcast_rows``), only the current
rows whose key occurs in the batch are merged: a broadcast semi / anti join
against the batch keys splits the table without shuffling it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlens.schemas import UpsertSpec

BROADCAST_ROWS = 2_000_000  # batch rows up to which the key set is broadcast (checked by a count)


def dedup_last(df: DataFrame, key: list[str] | tuple[str, ...], seq: str | Column | list[str]) -> DataFrame:
    """F-1: the last row per key in ``seq`` order, as a partial hash aggregate.

    Rows with a NULL key column are de-duplicated too (the original keeps a
    Python dict, where None equals None).  ``seq`` may be a list of columns, which
    are compared in turn (NULLs first) and exchanged once; rows that tie are
    decided by the other columns.
    """
    if isinstance(seq, list):
        last = F.max(F.struct(*seq, *[c for c in df.columns if c not in key and c not in seq])).alias("_row")
        return df.groupBy(*key).agg(last).select(*key, "_row.*").select(*df.columns)
    seq_c = F.col(seq) if isinstance(seq, str) else seq
    rest = [c for c in df.columns if c not in key]
    agg = df.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), seq_c).alias("_row"))
    return agg.select(*key, "_row.*").select(*df.columns)


def _null_key(key) -> Column:
    cond = None
    for k in key:
        c = F.col(k).isNull()
        cond = c if cond is None else cond | c
    return cond


def _conform(batch: DataFrame, current: DataFrame, stamp: str, stamp_value: Column) -> DataFrame:
    """Batch rows in the current table's column order and types; the stamp is set."""
    cols = []
    for f in current.schema.fields:
        if f.name == stamp:
            cols.append(stamp_value.cast(f.dataType).alias(f.name))
        elif f.name in batch.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return batch.select(*cols)


def _last(batch: DataFrame, current: DataFrame, spec: UpsertSpec, as_of, seq: str | list[str] | None) -> tuple[DataFrame, DataFrame]:
    """The batch in the table's columns, stamped: its last row of each key, and its rows
    with a NULL in their key.  The stamp and what the batch is ordered by stay here: a row
    is exchanged once, with its own columns."""
    key, nk, given = list(spec.key), _null_key(spec.key), batch.columns
    typed = {k: current.schema[k].dataType for k in key}
    batch = batch.withColumns({k: (F.col(k) if k in given else F.lit(None)).cast(t) for k, t in typed.items()
                               if k not in given or batch.schema[k].dataType != t})
    stamp = F.current_timestamp() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    if isinstance(seq, list):
        last = dedup_last(batch.where(~nk), key, seq)
    else:
        # with no order given, the row's own content decides: the same winner however rows are dealt out
        by = F.col(seq) if seq and seq in given else F.to_json(F.struct(*given))
        own = [c for c in given if c in current.columns and c not in key and c != spec.stamp]
        rows = batch.where(~nk).select(*key, *own, by.alias("_seq"))
        last = rows.groupBy(*key).agg(F.max_by(_struct(own), F.struct("_seq")).alias("_row")).select(*key, "_row.*")
    return _conform(last, current, spec.stamp, stamp), _conform(batch.where(nk), current, spec.stamp, stamp)


def _struct(cols: list[str]) -> Column:
    return F.struct(*cols) if cols else F.struct(F.lit(True).alias("_is"))


def _rows(df: DataFrame, key: list[str], name: str, collapse: bool = False) -> DataFrame:
    """The key and the row as one struct; ``collapse`` makes a key that is held twice one row."""
    row = _struct([c for c in df.columns if c not in key])
    return df.groupBy(*key).agg(F.first(row).alias(name)) if collapse else df.select(*key, row.alias(name))


def _after(spec: UpsertSpec, cols: list[str]) -> list[Column]:
    """The columns after an upsert, of a stored row _c and a batch's row _t of a key, of which one may be missing."""
    def value(c):
        if c in spec.key:
            return F.col(c)
        first, other = ("_t", "_c") if c in spec.updated or c == spec.stamp else ("_c", "_t")
        return F.when(F.col(first).isNotNull(), F.col(f"{first}.{c}")).otherwise(F.col(f"{other}.{c}")).alias(c)
    return [value(c) for c in cols]


def _merge(current: DataFrame, batch: tuple[DataFrame, DataFrame], spec: UpsertSpec) -> DataFrame:
    """``current`` after the rows that _last gives."""
    key, cols, nk = list(spec.key), current.columns, _null_key(spec.key)
    last, appended = batch
    merged = _rows(current.where(~nk), key, "_c", collapse=True).join(_rows(last, key, "_t"), key, "full_outer").select(*_after(spec, cols))
    return merged.unionByName(current.where(nk)).unionByName(appended)


def upsert_feed(current: DataFrame, batch: DataFrame, spec: UpsertSpec, as_of=None, seq: str | list[str] | None = "_seq") -> DataFrame:
    """The change feed of an upsert: (old, new), structs of the table's columns, one
    row for each key of the batch and each batch row with a NULL in its key.  old is
    NULL for what is inserted.  Only stored rows of the batch's keys are read into
    the merge; ``current`` holds a key once."""
    cols, key, nk = current.columns, list(spec.key), _null_key(spec.key)
    last, appended = _last(batch, current, spec, as_of, seq)
    touched = current.join(last.select(*key), key, "left_semi").select(*cols)
    both = _rows(last, key, "_t").join(_rows(touched, key, "_c", collapse=True), key, "left")
    old = F.when(F.col("_c").isNotNull(), F.struct(*[F.col(c) if c in key else F.col(f"_c.{c}").alias(c) for c in cols])).alias("old")
    merged = both.select(old, F.struct(*_after(spec, cols)).alias("new"))
    return merged.unionByName(appended.select(F.lit(None).cast(merged.schema["old"].dataType).alias("old"), F.struct(*cols).alias("new")))


def upsert(
    current: DataFrame,
    batch: DataFrame,
    spec: UpsertSpec,
    as_of=None,
    seq: str | list[str] | None = "_seq",
    on_duplicate: str = "last",
    strategy: str = "merge",
    broadcast_rows: int = BROADCAST_ROWS,
    collapse_stored: bool = False,
) -> DataFrame:
    """Return the new state of ``current`` after upserting ``batch``.

    ``as_of`` is the stamp written on every inserted / updated row (default:
    the query's current timestamp).  ``seq`` orders the batch for last-wins;
    any orderable column (a number or a struct of file ordinal and position), or a
    list of the batch's own columns, which are exchanged once, as in ``dedup_last``.
    Without it the greatest row (as JSON text) of a key wins.
    ``on_duplicate="error"`` raises if the batch holds a key twice, as the
    relational original does for tables it does not pre-deduplicate.
    ``strategy``: "merge" (one shuffle of current + batch), "touched" (merge only
    current rows whose key is in the batch; the batch key set is broadcast), or
    "auto" (touched when the batch has at most ``broadcast_rows`` rows).  The
    stored table holds a key once when it was written by this function; for a
    table that may not, ``collapse_stored`` makes "touched" collapse such keys
    as "merge" does.
    """
    cols = current.columns
    key = list(spec.key)
    if on_duplicate == "error":
        dup = batch.where(~_null_key(key)).groupBy(*key).count().where("count > 1").limit(1).collect()
        if dup:
            raise ValueError(f"{spec.name}: batch holds key {tuple(dup[0][k] for k in key)} more than once")
    if strategy == "auto":
        strategy = "touched" if batch.count() <= broadcast_rows else "merge"
    last = _last(batch, current, spec, as_of, seq)
    if strategy == "merge":
        return _merge(current, last, spec)
    if strategy != "touched":
        raise ValueError(f"unknown strategy {strategy!r}")
    keys = F.broadcast(last[0].select(*key))
    touched, untouched = current.join(keys, key, "left_semi"), current.join(keys, key, "left_anti")
    if collapse_stored:  # a key that is stored twice is collapsed as in a merge, so both strategies agree
        nk = _null_key(key)
        once = _rows(untouched.where(~nk), key, "_c", collapse=True).select(*key, "_c.*").select(*cols)
        untouched = once.unionByName(untouched.where(nk).select(*cols))
    return untouched.select(*cols).unionByName(_merge(touched.select(*cols), last, spec))


def patch_column(df: DataFrame, column: str, value, where_col: str, equals) -> DataFrame:
    """B-10: keyed UPDATE ``SET column = value WHERE where_col = equals``."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(F.col(where_col) == F.lit(equals), v.cast(df.schema[column].dataType))
                         .otherwise(F.col(column)))
