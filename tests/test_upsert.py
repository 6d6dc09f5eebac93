import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from chainlens import schemas as SCH
from chainlens.operators import upsert as U
from chainlens.session import scratch_path
from chainlens.sources import store

SCHEMA = ("account_id string, resource_arn string, check_id string, check_title string, status string, "
          "severity string, description string, recommendation string, remediation_code string, raw_json string, "
          "ingested_at timestamp")
T0 = dt.datetime(2020, 1, 1)
AS_OF = "2021-01-01 00:00:00"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def current(spark):
    return spark.createDataFrame([
        ("A", "arn1", "c1", "Title one", "FAIL", "HIGH", "d", "r", "", "{}", T0),
        ("A", "arn2", "c1", "Title two", "PASS", "LOW", "d", "r", "", "{}", T0),
        ("A", None, "c1", "null key", "FAIL", "LOW", "d", "r", "", "{}", T0),
    ], SCHEMA)


@pytest.fixture()
def batch(spark):
    return spark.createDataFrame([
        (1, "A", "arn1", "c1", "New title", "PASS", "LOW", "d2", "r2", "x", "{}"),
        (2, "A", "arn1", "c1", "Newer title", "MANUAL", "MEDIUM", "d3", "r3", "y", "{}"),   # last wins
        (3, "A", "arn3", "c1", "Fresh", "FAIL", "CRITICAL", "d", "r", "", "{}"),
        (4, "A", None, "c1", "null key again", "FAIL", "LOW", "d", "r", "", "{}"),
    ], "_seq long, account_id string, resource_arn string, check_id string, check_title string, status string, "
       "severity string, description string, recommendation string, remediation_code string, raw_json string")


def test_kept_and_overwritten(current, batch):
    out = {(r.resource_arn, r.check_title): r for r in U.upsert(current, batch, SCH.FINDINGS_SPEC, as_of=AS_OF)
           .collect()}
    assert len(out) == 5
    r = out[("arn1", "Title one")]                 # kept column from the first insert
    assert (r.status, r.severity, r.description, r.remediation_code) == ("MANUAL", "MEDIUM", "d3", "y")
    assert r.ingested_at == dt.datetime(2021, 1, 1)
    assert out[("arn2", "Title two")].ingested_at == T0                 # untouched row keeps its stamp
    assert out[("arn3", "Fresh")].ingested_at == dt.datetime(2021, 1, 1)
    assert {k for k in out if k[0] is None} == {(None, "null key"), (None, "null key again")}


def test_idempotent(current, batch):
    once = U.upsert(current, batch, SCH.FINDINGS_SPEC, as_of=AS_OF)
    twice = U.upsert(once, batch.where(F.col("resource_arn").isNotNull()), SCH.FINDINGS_SPEC, as_of=AS_OF)
    assert _rows(once) == _rows(twice)


def test_batch_split_associative(current, batch):
    whole = U.upsert(current, batch, SCH.FINDINGS_SPEC, as_of=AS_OF)
    step = U.upsert(current, batch.where("_seq <= 2"), SCH.FINDINGS_SPEC, as_of=AS_OF)
    step = U.upsert(step, batch.where("_seq > 2"), SCH.FINDINGS_SPEC, as_of=AS_OF)
    assert _rows(whole) == _rows(step)


def test_strategies_agree(current, batch):
    a = U.upsert(current, batch, SCH.FINDINGS_SPEC, as_of=AS_OF, strategy="merge")
    b = U.upsert(current, batch, SCH.FINDINGS_SPEC, as_of=AS_OF, strategy="touched")
    assert _rows(a) == _rows(b)


def test_on_duplicate_error(current, batch):
    with pytest.raises(ValueError):
        U.upsert(current, batch, SCH.FINDINGS_SPEC, as_of=AS_OF, on_duplicate="error")


def test_dedup_last(spark):
    df = spark.createDataFrame([(1, "k", "a"), (3, "k", "c"), (2, "k", "b"), (1, None, "n1"), (2, None, "n2")],
                               "seq long, key string, v string")
    got = {r.key: r.v for r in U.dedup_last(df, ["key"], "seq").collect()}
    assert got == {"k": "c", None: "n2"}


def test_commit_and_read_latest(spark, current):
    root = scratch_path(spark, "store-test")
    assert store.versions(spark, root) == []
    p0 = store.commit(current, root, sort_by=["account_id", "resource_arn"])
    p1 = store.commit(current.limit(1), root)
    assert store.versions(spark, root) == [0, 1] and p1.endswith("version=1") and p0.endswith("version=0")
    assert store.read_latest(spark, root).count() == 1
    # an unfinished version (no _SUCCESS) is invisible
    os.makedirs(root.replace("file:", "") + "/version=7", exist_ok=True)
    assert store.versions(spark, root) == [0, 1]


def test_sync_log(spark):
    root = scratch_path(spark, "sync-log")
    store.append_sync_log(store.sync_log_rows(spark, [("A", "instances", 3, 12, "success", None)], as_of=AS_OF), root)
    store.append_sync_log(store.sync_log_rows(spark, [(None, "s3", 0, 5, "error", "boom")], as_of=AS_OF), root)
    log = spark.read.parquet(root)
    assert log.count() == 2 and log.where("status = 'error'").count() == 1


def test_commit_after_a_failed_write(spark):
    import os

    root = scratch_path(spark, "half-written").replace("file:", "")
    df = spark.range(5)
    store.commit(df, root)
    os.makedirs(f"{root}/version=1")          # a writer died here: files, no _SUCCESS
    with open(f"{root}/version=1/part-0.parquet", "w") as fh:
        fh.write("broken")
    assert store.versions(spark, root) == [0] and store.read_latest(spark, root).count() == 5
    assert store.commit(spark.range(9), root).endswith("version=2")
    assert store.versions(spark, root) == [0, 2] and store.read_latest(spark, root).count() == 9
    store.commit(spark.range(3), root, batch_id=7)
    assert store.committed_batch(spark, root, 7).endswith("version=3-batch=7") and store.committed_batch(spark, root, 8) is None
    assert store.read_latest(spark, root).count() == 3
    assert store.drop_old_versions(spark, root, keep=1) == [0, 1, 2] and store.versions(spark, root) == [3]


def test_last_wins_without_an_order_does_not_depend_on_partitions(spark):
    rows = [(f"v{i % 5}", "A", "r", f"10.{i}.0.0/16", False, "s") for i in range(40)]
    batch = spark.createDataFrame(rows, "vpc_id string, account_id string, region string, cidr_block string, is_default boolean, state string")
    empty = batch.limit(0).withColumn(SCH.VPCS_SPEC.stamp, F.lit(None).cast("timestamp"))
    out = [sorted(map(tuple, U.upsert(empty, batch.repartition(n), SCH.VPCS_SPEC, as_of="2021-01-01 00:00:00").collect())) for n in (1, 3, 7)]
    assert out[0] == out[1] == out[2] and len(out[0]) == 5


def test_an_upsert_exchanges_each_row_once(spark):
    from tests.test_scale import _exchanged
    root = scratch_path(spark, "upsert-rows")
    spark.range(1300).selectExpr(
        "'A' account_id", "'arn' || id resource_arn", "'c' check_id", "'t' check_title", "'FAIL' status", "'LOW' severity", "'d' description",
        "'r' recommendation", "'' remediation_code", "'{}' raw_json", "timestamp'2020-01-01' ingested_at", "id _seq").write.parquet(root)
    rows = spark.read.parquet(root)  # keys that the optimizer knows nothing of
    cur = U.dedup_last(rows.where("_seq < 1000"), SCH.FINDINGS_SPEC.key, "_seq").drop("_seq")
    out = U.upsert(cur, rows.where("_seq >= 800"), SCH.FINDINGS_SPEC, as_of=AS_OF)
    assert _exchanged(out) <= 1500 and out.count() == 1300


def test_an_order_of_listed_columns_is_that_of_their_struct(spark, current):
    rows = spark.createDataFrame([("A", "arn1", "c1", "x", "FAIL", n, m, "r", "", "{}", T0) for n, m in (("HIGH", "a"), ("LOW", None), ("LOW", "b"), (None, "z"))]
                                 + [("A", None, "c1", "x", "FAIL", "LOW", "n", "r", "", "{}", T0)] * 2, SCHEMA)
    by = ["severity", "description"]
    listed, plain = (U.upsert(current, b, SCH.FINDINGS_SPEC, as_of=AS_OF, seq=s) for b, s in
                     ((rows, by), (rows.withColumn("_seq", F.struct(*by)), "_seq")))
    assert _rows(listed) == _rows(plain) and listed.where("resource_arn = 'arn1'").first().description == "b" and listed.count() == 5
    old = lambda seq, b: _rows(U.upsert_feed(current, b, SCH.FINDINGS_SPEC, as_of=AS_OF, seq=seq))
    assert old(by, rows) == old("_seq", rows.withColumn("_seq", F.struct(*by))) and len(old(by, rows)) == 3
