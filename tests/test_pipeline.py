from chainlens.operators.summary import step_summary
from chainlens.plans.pipeline import run_steps, sync_inventory
from chainlens.session import scratch_path
from chainlens.sources import raw_inputs as RAW
from chainlens.sources import store
from tests.conftest import SF_SMALL


def test_sync_inventory_logs_and_continues(spark):
    root = scratch_path(spark, "inv")
    raw = {"vpcs": RAW.raw_vpcs(spark, SF_SMALL),
           "s3": RAW.raw_vpcs(spark, SF_SMALL),          # wrong shape: this step fails
           "instances": RAW.raw_instances(spark, SF_SMALL)}
    log = sync_inventory(spark, raw, root, as_of="2021-01-01 00:00:00").cache()
    failed = log.where("status = 'error'").collect()
    assert [r.table_name for r in failed] == ["buckets"]
    ok = {r.table_name for r in log.where("status = 'success'").collect()}
    assert ok == {"vpcs", "instances"}
    assert store.versions(spark, root + "/vpcs") == [0]
    s = step_summary(log).collect()[0]
    assert s.failed_steps == 1 and s.steps == log.count()
    # a second sync upserts into the stored tables (next version, same rows)
    sync_inventory(spark, {"vpcs": RAW.raw_vpcs(spark, SF_SMALL)}, root, as_of="2021-01-02 00:00:00")
    assert store.versions(spark, root + "/vpcs") == [0, 1]
    assert store.read_latest(spark, root + "/vpcs").count() == RAW.raw_vpcs(spark, SF_SMALL).count()


def test_a_live_source_is_read_once_and_failures_name_their_accounts(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    raw = RAW.raw_vpcs(spark, SF_SMALL)
    live = raw.mapInPandas(seen, raw.schema)
    root = scratch_path(spark, "inv-live")
    log = sync_inventory(spark, {"vpcs": live, "s3": raw}, root, as_of="2021-01-01 00:00:00", log_root=root + "/log", accounts=["a", "b"])
    assert reads.value == raw.count() == store.read_latest(spark, root + "/vpcs").count()
    rows = log.collect()
    assert sorted(r.account_id for r in rows if r.status == "error") == ["a", "b"]
    assert sum(r.rows_synced for r in rows) == raw.count()
    _, failed = run_steps({"good": raw.count, "bad": lambda: 1 / 0})
    assert failed == {"bad": "division by zero"}
