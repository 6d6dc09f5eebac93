"""Inputs and plans that grow with the tables: files, joins and tasks."""

import os

import pytest

from chainlens import registry as R
from chainlens.session import scratch_path
from chainlens.sources import files, landing


@pytest.fixture(scope="module")
def tables(spark):
    """A small set of driver tables, made of own rows."""
    root = scratch_path(spark, "scale-tables").replace("file:", "")
    orders = spark.range(4000).selectExpr("id o_orderkey", "id % 40 o_custkey", "element_at(array('F', 'O', 'P'), cast(id % 3 + 1 as int)) o_orderstatus",
                                          "'1-URGENT' o_orderpriority", "timestamp_ntz '1996-01-01' o_orderdate")
    line = spark.range(9000).selectExpr("id % 4000 l_orderkey", "id % 7 l_partkey", "id % 3 l_suppkey", "cast(id % 5 + 1 as int) l_linenumber")
    customer = spark.range(40).selectExpr("id c_custkey", "cast(id % 3 as int) c_nationkey")
    for name, df in (("orders", orders), ("lineitem", line), ("customer", customer)):
        df.write.parquet(f"{root}/{name}.parquet")
    return root


def _files(path):
    return [f for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_scanner_files_grow_in_number(spark, tables, monkeypatch):
    monkeypatch.setattr(R, "FINDINGS_A_FILE", 100)
    path = R.write_findings_files(spark, tables)
    assert len(_files(path.replace("file:", ""))) > 30
    every = files.read_findings_files(spark, path)
    assert every.count() == 4000
    assert every.groupBy("file").count().agg({"count": "max"}).first()[0] < 400


def test_ingest_takes_three_batches_whatever_the_files(spark, tables, monkeypatch):
    seen = []
    begin = R.start_findings_ingest
    monkeypatch.setattr(R, "FINDINGS_A_FILE", 100)
    monkeypatch.setattr(R, "start_findings_ingest", lambda *a, **k: seen.append(k["max_files_per_trigger"]) or begin(*a, **k))
    rows = R.QUERIES["incremental_ingest"](spark, tables)
    assert seen == [15] and rows.select("account_id", "resource_arn", "check_id").distinct().count() == rows.count() > 0


def test_reports_are_packed(spark, tables, monkeypatch):
    monkeypatch.setattr(landing, "BLOCK", 500)
    path = landing.write_cve_reports(spark, tables)
    packed = spark.read.parquet(path)
    assert packed.count() >= 3 * 6 and len(_files(path.replace("file:", ""))) <= 8
    got = files.read_cve_reports(spark, path, "acct", "reg", archive=True)
    assert got.count() == 9000 and {r[0] for r in got.select("instance_id").distinct().collect()} == {"i-0", "i-1", "i-2"}


@pytest.fixture(scope="module")
def wide_tables(spark):
    """Customers, parts and suppliers whose keys lie far apart."""
    root = scratch_path(spark, "wide-tables").replace("file:", "")
    spark.range(600).selectExpr("id * 1000 c_custkey", "cast(id % 3 as int) c_nationkey", "'c' || id c_name").write.parquet(f"{root}/customer.parquet")
    spark.range(300).selectExpr("id * 1000 p_partkey", "'p' || id p_name").write.parquet(f"{root}/part.parquet")
    spark.range(200).selectExpr("id * 1000 s_suppkey", "cast(id % 3 as int) s_nationkey", "'s' || id s_name",
                                "cast(id as double) s_acctbal").write.parquet(f"{root}/supplier.parquet")
    return root


def test_bundles_are_bounded_by_rows_not_by_keys(spark, wide_tables, monkeypatch):
    monkeypatch.setattr(landing, "BLOCK", 100)
    path = landing.write_bundles(spark, wide_tables)
    assert 6 <= len(_files(path.replace("file:", ""))) <= 30
    tables = files.read_inventory_bundle(spark, path)
    assert {t: rows.count() for t, rows in tables.items()} == {"instances": 600, "s3": 300, "vpcs": 200}
    assert tables["instances"].distinct().count() == 600


def test_path_findings_are_packed(spark, wide_tables):
    before = set(_folders(spark, "iam-paths"))
    assert R.QUERIES["scan_iam_paths"](spark, wide_tables).select("s_suppkey").distinct().count() == 200
    path, = set(_folders(spark, "iam-paths")) - before
    assert len(_files(path)) <= 8 and spark.read.parquet(path).count() >= 100


def _folders(spark, name):
    root = os.path.dirname(scratch_path(spark, name)).replace("file:", "")
    return [f"{root}/{d}" for d in os.listdir(root) if d.startswith(name)]


def test_broken_report_of_an_archive(spark):
    path = scratch_path(spark, "broken-archive")
    spark.createDataFrame([("i-1.json", '{"Results": [{"Vulnerabilities": [{"VulnerabilityID": "CVE-1"}]}]}'), ("i-2.json", '{"Results": ['), ("i-3.json", None)],
                          "scan string, value string").write.parquet(path)
    with pytest.raises(Exception, match="not a JSON document"):
        files.read_cve_reports(spark, path, "a", "r", archive=True).collect()
    assert [r.instance_id for r in files.read_cve_reports(spark, path, "a", "r", "skip", archive=True).collect()] == ["i-1"]


def test_wide_rows_are_dealt_to_bounded_tasks(spark, monkeypatch):
    from chainlens.sources import adapters as A
    monkeypatch.setattr(A, "TASK_ROWS", 100)
    rows = A.spread(spark.range(1000, numPartitions=1).selectExpr("id", "cast(null as string) empty"))
    sizes = [len(x) for x in rows.rdd.glom().collect()]
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) < 200
    few = spark.range(50)
    assert A.spread(few) is few


def _chains_sides(spark, paths):
    from chainlens.sources import adapters as A
    i, f, c, r = A.load(spark, "/root/testdata/sf0.001", "instances", "findings", "cves", "iam_risks")
    from pyspark.sql import functions as F
    copies = r.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(paths))))
    return i, f, c, copies.withColumn("path", F.concat("path", F.lit(" #"), "n")).drop("n")


def _exchanged(df):
    """Rows that the exchanges of a plan wrote, with broadcasts off."""
    df.collect()
    plan, rows, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(p.plan())
        if kind == "ShuffleExchangeExec":
            rows += p.metrics().apply("shuffleRecordsWritten").value()
        children = p.children()
        todo += [children.apply(k) for k in range(children.size())]
    return rows


def test_exchanges_do_not_hold_instances_times_paths(spark):
    from chainlens.operators import correlate as E
    few, many = (_exchanged(E.attack_chains(*_chains_sides(spark, n), hot_threshold=None)) for n in (1, 40))
    sides = _chains_sides(spark, 40)
    assert many - few <= 3 * sides[3].count()


def test_copies_of_a_group_are_not_joined_one_by_one(spark):
    from chainlens.operators import correlate as E
    i = spark.sql("SELECT 'i-1' instance_id, 'n' name_tag, 't' instance_type, 'running' instance_state, 'ip' public_ip, 'r' region, 'p' iam_instance_profile, 'v1' vpc_id UNION ALL "
                  "SELECT 'i-2', 'n', 't', 'running', 'ip', 'r', 'p', 'v2' UNION ALL SELECT 'i-3', 'n', 't', 'running', 'ip', 'r', 'p', NULL")
    g = spark.range(1000).selectExpr("'v1' vpc_id", "id % 2 = 0 allows_all_ingress", "cast(null as boolean) allows_ssh_public")
    got = E.instances_with_sg(i, g)
    assert {(r[0], r[1]): r[2] for r in got.groupBy("instance_id", "allows_all_ingress").count().collect()} == \
        {("i-1", True): 500, ("i-1", False): 500, ("i-2", None): 1, ("i-3", None): 1}
    assert "Generate" in got._jdf.queryExecution().executedPlan().toString()


def test_report_lines_from_the_tables_are_those_of_the_context(spark):
    from chainlens.operators import reports as K
    from chainlens.sources import adapters as A
    i, g, c = A.load(spark, "/root/testdata/sf0.001", "instances", "security_groups", "cves")
    i = i.unionByName(i.limit(5).selectExpr(*["cast(NULL as string) vpc_id" if x == "vpc_id" else x for x in i.columns]))
    ctx = K.public_instance_context(i, g)
    for made, plain in ((K.instance_lines(i, g), K.instance_block(ctx)), (K.cve_lines(i, g, c), K.instance_cve_block(ctx, c))):
        assert made.columns == plain.columns and made.count() > 0
        assert sorted(map(str, made.collect())) == sorted(map(str, plain.collect()))


def test_last_by_listed_columns_is_exchanged_once(spark):
    from pyspark.sql import functions as F
    from chainlens.operators.upsert import dedup_last
    rows = spark.createDataFrame([("a", 1, "x", "p"), ("a", 2, None, "q"), ("a", 2, "b", "r"), (None, 1, "c", "s"), (None, None, "d", "t")],
                                 "k string, n int, m string, other string")
    listed, plain = (dedup_last(rows, ["k"], s) for s in (["n", "m"], F.struct("n", "m")))
    assert sorted(map(str, listed.collect())) == sorted(map(str, plain.collect())) == [
        "Row(k='a', n=2, m='b', other='r')", "Row(k=None, n=1, m='c', other='s')"]


def test_large_tables_are_exchanged_before_they_are_widened(spark):
    from chainlens.sources import adapters as A
    for table in A.DEALT:
        dealt, plain = table(spark, "/root/testdata/sf0.001", dealt=True), table(spark, "/root/testdata/sf0.001")
        assert dealt.columns == plain.columns and dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
        plan = dealt._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("acct-") < plan.index("RepartitionByExpression")  # the widening stands above the exchange


def test_a_stored_step_leaves_no_shuffle_files(spark):
    from chainlens.llm import common
    from chainlens import session
    held = lambda: spark._jsparkSession.sparkContext().env().mapOutputTracker().shuffleStatuses().size()
    before, setting = held(), spark.conf.get(session.RELEASE, None)
    for module in (session, common):
        counted = module.stored(spark.range(1000).selectExpr("id % 10 k").groupBy("k").count(), "released")
        assert counted.count() == 10 and spark.conf.get(session.RELEASE, None) == setting
    assert held() - before <= 2  # those of the counts


def test_line_items_are_exchanged_once_for_orders_and_customers(spark, tables):
    from chainlens.sources import adapters as A
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        more = spark.read.parquet(f"{tables}/lineitem.parquet").selectExpr("*", *[f"cast(1 as double) {c}" for c in ("l_quantity", "l_discount", "l_tax")],
                                                                          "'O' l_linestatus", "timestamp_ntz '1996-01-01' l_shipdate")
        root = scratch_path(spark, "cve-tables").replace("file:", "")
        more.write.parquet(f"{root}/lineitem.parquet")
        for t in ("orders", "customer"):
            spark.read.parquet(f"{tables}/{t}.parquet").write.parquet(f"{root}/{t}.parquet")
        assert 9000 <= _exchanged(A.cves(spark, root)) <= 9000 + 2 * 4000 + 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_large_vpc_is_spread_before_it_meets_its_groups(spark):
    from chainlens.operators import correlate as E, reports as K
    root = scratch_path(spark, "large-vpc")
    spark.range(12_000).selectExpr("sha2(cast(id as string), 256) instance_id", "sha2(cast(-id as string), 256) name_tag", "'t' instance_type", "'running' instance_state", "'ip' public_ip",
                                   "'r' region", "'p' iam_instance_profile", "'a' account_id", "if(id % 4 = 0, 'v2', 'v1') vpc_id").write.parquet(root)
    i = spark.read.parquet(root)
    g = spark.range(3).selectExpr("'v1' vpc_id", "'g' || id group_id", "id = 0 allows_all_ingress", "true allows_ssh_public")
    small = E.FAN_OUT_ROWS * 9 // 10  # v1 holds 9,000 instances
    for made, rows in ((E.instances_with_sg(i, g, hot_threshold=small // 2), 9000 * 3 + 3000), (E.instances_with_sg(i, g, hot_threshold=None), 9000 * 3 + 3000),
                       (K.public_instance_context(i, g), 9000 * 3 + 3000), (K.instance_lines(i, g), 6 * (9000 * 3 + 3000))):
        assert made.count() == rows
    # six lines of 9,000 instances are more than FAN_OUT_ROWS
    assert "_salt" in K.instance_lines(i, g)._jdf.queryExecution().optimizedPlan().toString()
