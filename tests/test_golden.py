"""Values worked out by hand from tests/samples.py, computed through our
readers, normalisers and operators."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from chainlens.operators import correlate as E
from chainlens.operators import normalize as N
from chainlens.operators import ranking as H
from chainlens.operators import summary as G
from chainlens.operators.upsert import patch_column
from tests import samples as S

INST = ("instance_id string, account_id string, region string, resource_arn string, instance_state string, "
        "instance_type string, vpc_id string, public_ip string, iam_instance_profile string, name_tag string, "
        "tags map<string,string>")
BUCKET = ("bucket_name string, account_id string, region string, resource_arn string, public_access_blocked boolean, "
          "versioning_enabled boolean, encryption_enabled boolean")
USER = ("user_name string, account_id string, user_id string, resource_arn string, mfa_enabled boolean, "
        "has_access_keys boolean")
SG = ("group_id string, group_name string, account_id string, region string, vpc_id string, "
      "allows_all_ingress boolean, allows_ssh_public boolean, allows_rdp_public boolean")


def _df(spark, rows, schema):
    from pyspark.sql.types import _parse_datatype_string

    names = _parse_datatype_string(schema).fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


@pytest.fixture(scope="module")
def t(spark):
    f = N.normalize_findings(spark.createDataFrame([(json.dumps(o),) for o in S.FINDINGS], "raw string")) \
        .withColumn("ingested_at", F.lit(dt.datetime(2025, 3, 1, 12, 30)))
    docs = spark.createDataFrame([(S.CVE_INSTANCE, S.ACCOUNT, S.REGION, json.dumps(S.CVE_REPORT))],
                                 "instance_id string, account_id string, region string, doc string")
    c = N.normalize_cves(docs)
    r = N.normalize_iam_paths(spark.createDataFrame(
        [(json.dumps(o), S.ACCOUNT, S.REGION) for o in S.IAM_PATHS], "item string, account_id string, region string"))
    inv = S.INVENTORY
    u = _df(spark, inv["iam"], USER).withColumn("password_last_used", F.lit(None).cast("timestamp"))
    tables = dict(f=f, c=c, r=r, i=_df(spark, inv["instances"], INST), b=_df(spark, inv["s3"], BUCKET), u=u,
                  g=_df(spark, inv["security_groups"], SG))
    return {k: v.cache() for k, v in tables.items()}


def test_summaries(t):
    g1 = {(r.severity, r.total, r.failures) for r in G.severity_summary(t["f"]).collect()}
    assert g1 == {("CRITICAL", 3, 2), ("HIGH", 2, 1), ("MEDIUM", 2, 2), ("LOW", 1, 1)}
    g11 = {(r.service, r.failures) for r in G.services_breakdown(t["f"]).collect()}
    assert g11 == {("ec2", 3), ("iam", 2), ("s3", 1)}
    severe = E.open_severe(t["c"]).orderBy(F.desc("cvss_score")).collect()
    assert [float(r.cvss_score) for r in severe] == [9.4, 7.2]


def test_iam_paths_views(t):
    h3 = H.admin_escalation_paths(t["r"]).collect()
    assert [r.hops for r in h3] == [1, 2]


def test_joins(t):
    assert E.critical_risks(t["f"], t["c"]).count() == 4
    assert E.public_instances_with_findings(t["i"], t["f"]).count() == 2
    assert E.exposed_vulnerable_instances(t["i"], t["c"]).count() == 2
    assert E.risky_iam_users(t["u"], t["f"]).count() == 2
    assert E.public_s3_findings(t["b"], t["f"]).count() == 1
    assert E.instances_with_sg(t["i"], t["g"]).count() == 6
    # B-10: with another ARN on the host's CVEs nothing correlates
    moved = patch_column(t["c"], "resource_arn", "arn:elsewhere", "instance_id", S.CVE_INSTANCE)
    assert E.critical_risks(t["f"], moved).count() == 0


def test_attack_chains(t):
    chains = E.attack_chains(t["i"], t["f"], t["c"], t["r"])
    assert sorted(r.risk_score for r in chains.collect()) == [10.2, 12.2, 12.2, 12.4, 14.2, 14.4, 14.4, 16.4]
    alert = H.alert_chains(chains).collect()
    assert len(alert) == 7 and alert[0].risk_score == 16.4
    # IAM rows ingested under another account id: no path, four chains
    other = t["r"].withColumn("account_id", F.lit("999999999999"))
    scores = sorted(r.risk_score for r in E.attack_chains(t["i"], t["f"], t["c"], other).collect())
    assert scores == [9.2, 11.2, 11.4, 13.4]


def test_posture_summary(t):
    row = G.posture_summary(t["f"], t["c"], t["r"], t["i"], t["b"]).collect()[0]
    assert (row.failures, row.critical_findings, row.high_findings, row.critical_cves, row.admin_paths,
            row.attack_chains, row.running_instances, row.public_instances, row.s3_buckets,
            row.public_buckets) == (6, 2, 1, 2, 2, 8, 2, 1, 2, 1)
    assert row.last_scan == "2025-03-01 12:30 UTC"


def test_chain_totals_keep_rows_without_a_partner(t):
    i, f, c = t["i"], t["f"], t["c"]
    # a second instance with the same ARN, one without an ARN; findings and CVEs that meet nothing
    i = i.unionByName(i.withColumn("instance_id", F.concat(F.lit("twin-"), "instance_id"))) \
        .unionByName(i.limit(1).withColumn("instance_id", F.lit("bare")).withColumn("resource_arn", F.lit(None).cast("string")))
    f = f.unionByName(f.withColumn("resource_arn", F.lit(None).cast("string"))).unionByName(f.withColumn("resource_arn", F.lit("arn:none")))
    c = c.unionByName(c.withColumn("instance_id", F.lit("nowhere"))).unionByName(c.withColumn("instance_id", F.concat(F.lit("twin-"), "instance_id")))
    chains = E.attack_chains(i, f, c, t["r"])
    row = G.posture_summary(f, c, t["r"], i, t["b"]).first()
    assert row.attack_chains == chains.count() > 8
    assert G.admin_path_counts(t["r"], i, f, c).first().admin_chains == chains.where("target_is_admin").count() > 0
    assert row.failures == E.failed(f).count() == 18 and row.critical_cves == E.open_severe(c).count() == 6
    assert row.running_instances == E.running(i).count() and row.public_instances == E.public_running(i).count()
    counts = G.report_counts(f, c, t["r"], i).first()
    assert (counts.failures, counts.critical_cves, counts.full_attack_chains) == (18, 6, row.attack_chains)
    none = G.posture_summary(f.limit(0), c.limit(0), t["r"], i.limit(0), t["b"]).first()
    assert (none.failures, none.attack_chains, none.running_instances, none.last_scan) == (0, 0, 0, None)


def test_plan_shape(t):
    """The flagship never plans a cartesian product or a nested-loop join."""
    plan = E.attack_chains(t["i"], t["f"], t["c"], t["r"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    top = H.top_attack_chains(E.attack_chains(t["i"], t["f"], t["c"], t["r"]))
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_alert_payloads(t, spark):
    from chainlens.operators import reports as K

    chains = E.attack_chains(t["i"], t["f"], t["c"], t["r"])
    payload = json.loads(K.chain_alert_payload(chains).collect()[0].payload)
    blocks = payload["blocks"]
    assert blocks[0]["type"] == "header" and blocks[1]["text"]["text"].startswith("*7 complete attack chain(s)*")
    sections = [b for b in blocks if b["type"] == "section" and "fields" in b]
    assert len(sections) == 3
    assert sections[0]["fields"][5]["text"].startswith("*Risk Score:*\n`16.4` ")
    assert "ESCALATES TO ADMIN" in sections[0]["fields"][5]["text"]
    assert sections[0]["fields"][2]["text"] == "*CVE:*\n`CVE-2030-11` CVSS 9.4 (libimage)"
    assert sum(1 for b in blocks if b.get("text", {}).get("text", "").startswith("*IAM Path:*")) == 3
    # no chains: no chain alert; the risk alert is gated on the absence of alert chains
    assert K.chain_alert_payload(chains.limit(0)).count() == 0
    risks = spark.createDataFrame(
        [("arn1", "Open port " * 10, "HIGH", "CVE-1", 9.8, "p1", "t1"), ("arn2", "x", "LOW", "CVE-2", None, "p2", "t2")],
        "resource_arn string, exposure string, network_severity string, cve_id string, cvss_score double, "
        "package_name string, cve_title string")
    assert K.risk_alert_payload(risks, chains).count() == 0
    text = json.loads(K.risk_alert_payload(risks, chains.limit(0)).collect()[0].payload)["blocks"][0]["text"]["text"]
    lines = text.split("\n")
    assert lines[0].endswith("2 Critical/High CVE+Misconfiguration Correlations*") and lines[1] == ""
    assert lines[2] == "• `CVE-1` CVSS 9.8 | p1 | " + ("Open port " * 10)[:60]
    assert lines[3] == "• `CVE-2` CVSS None | p2 | x"


def test_report_lines(t):
    from chainlens.operators import reports as K

    lines = K.report_lines(t["i"], t["g"], t["c"], t["b"], t["f"], status="FAIL")
    doc = [r.line for r in lines.orderBy(*K.REPORT_ORDER).collect()]
    assert doc[1] == "Instance: i-shop01 (shop front)"
    assert doc[4] == "  IAM Role:       ShopRole"
    assert doc[5] == "  Security Group: sg-front — All ports open: False, SSH public: True"
    assert doc[6] == "  CVEs:" and doc[7].startswith("    - CVE-2030-11 [CRITICAL 9.4] libimage 2.0")
    assert doc[8] == "      Fix: upgrade to 2.1"
    assert "  - shop-uploads: public_access_blocked=False, versioning=False, encrypted=True" in doc
    assert "  [CRITICAL] User without mfa — user/olga" in doc


def test_role_match_strategies_agree(spark):
    from tests.conftest import SF_MID
    from chainlens.sources import adapters as A

    i, r = A.load(spark, SF_MID, "instances", "iam_risks")
    key = ["_acct", "_role", "path", "hops", "target_name", "target_is_admin", "iam_severity"]
    got = {s: sorted(tuple(x) for x in E.role_risk_matches(i, r, strategy=s).select(*key).collect())
           for s in ("plain", "trigram")}
    assert got["plain"] == got["trigram"] and len(got["plain"]) > 0


def test_hot_instance_split_equals_plain_join(spark):
    from tests.conftest import SF_MID
    from chainlens.sources import adapters as A

    i, f, c, r = A.load(spark, SF_MID, "instances", "findings", "cves", "iam_risks")
    plain = E.attack_chains(i, f, c, r, hot_threshold=None)
    split = E.attack_chains(i, f, c, r, hot_threshold=3)      # most instances count as hot here
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0
    assert split.count() == 8964


def test_hot_key_split_left_and_inner(spark):
    from tests.conftest import SF_MID
    from chainlens.sources import adapters as A

    i, g, f, c = A.load(spark, SF_MID, "instances", "security_groups", "findings", "cves")
    for plain, split in (
        (E.instances_with_sg(i, g, hot_threshold=None), E.instances_with_sg(i, g, hot_threshold=5)),
        (E.critical_risks(f, c, hot_threshold=None), E.critical_risks(f, c, hot_threshold=2)),
    ):
        assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_report_sink_writes_ordered_document(t, spark):
    import glob
    import os

    from chainlens.operators import reports as K
    from chainlens.session import scratch_path
    from chainlens.sources import store

    lines = K.report_lines(t["i"], t["g"], t["c"], t["b"], t["f"], status="FAIL")
    root = scratch_path(spark, "report")
    store.write_report(lines, root, K.REPORT_ORDER, partition_by=["account_id"])
    d = glob.glob(os.path.join(root.replace("file:", ""), "account_id=*"))
    assert len(d) == 1
    text = "".join(open(p).read() for p in sorted(glob.glob(os.path.join(d[0], "part-*"))))
    doc = text.split("\n")
    assert doc[1] == "Instance: i-shop01 (shop front)" and doc[6] == "  CVEs:"


def test_alert_chains_only_new(t):
    chains = E.attack_chains(t["i"], t["f"], t["c"], t["r"])
    first = H.alert_chains(chains)
    assert first.count() == 7
    # chains alerted in an earlier run are not alerted again (X-5 option)
    again = H.alert_chains(chains, already_sent=first.limit(2))
    assert again.count() == 5
    assert H.alert_chains(chains, already_sent=first).count() == 0


def test_best_chains_hold_the_top_lists(spark):
    """The lists from n rows of every factor equal those from the full fan-out,
    with ties, missing scores and duplicate rows."""
    from tests.conftest import SF_MID
    from chainlens.sources import adapters as A

    i, f, c, r = A.load(spark, SF_MID, "instances", "findings", "cves", "iam_risks")
    # a third of the CVEs without a score, coarse scores for ties, some rows twice
    c = c.withColumn("cvss_score", F.when(F.crc32("cve_id") % 3 == 0, F.lit(None))
                     .otherwise(F.floor(F.col("cvss_score"))).cast("decimal(4,1)"))
    c = c.unionByName(c.where(F.crc32("package_name") % 5 == 0))
    rows = lambda df: [tuple(x) for x in df.collect()]
    for cves in (c, c.where("cvss_score is null")):
        whole = E.attack_chains(i, f, cves, r).cache()
        for n, direct in ((1, 10**6), (7, 0), (20, 0), (20, 10**6)):  # factors ranked first, and not
            best = E.best_chains(i, f, cves, r, n, direct_rows=direct)
            assert rows(H.top_attack_chains(best, n)) == rows(H.top_attack_chains(whole, n))
            assert rows(H.alert_chains(best, n=n)) == rows(H.alert_chains(whole, n=n))
        whole.unpersist()
    risks = E.critical_risks(f, c)
    cols = ["resource_arn", "exposure", "network_severity", "cve_id", "cvss_score", "package_name", "cve_title"]
    assert rows(H.alert_risks(E.best_critical_risks(f, c, 10, cols))) == rows(H.alert_risks(risks))
    assert rows(H.report_critical_risks(E.best_critical_risks(f, c, 20, risks.columns))) == rows(H.report_critical_risks(risks))


def test_sorted_views_are_in_order(spark):
    """H-1, H-2, H-3 and H-15: every row stands at or after its neighbour, by values read back in Python."""
    from tests.conftest import SF_MID
    from chainlens.sources import adapters as A

    f, c, r = A.load(spark, SF_MID, "findings", "cves", "iam_risks")
    place = lambda names, x: names.index(x) if x in names else len(names)
    levels = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "INFORMATIONAL"]
    h1 = [(place(levels, x.severity), -x.ingested_at.timestamp()) for x in H.open_failures(f).collect()]
    h2 = [(place(levels[:4], x.severity), x.cvss_score is None, -(x.cvss_score or 0)) for x in H.open_cves(c).collect()]
    h3 = [(place(levels[:3], x.severity), x.hops) for x in H.admin_escalation_paths(r).collect()]
    h15 = [(x.cvss_score is not None, -(x.cvss_score or 0)) for x in H.report_cves(c).collect()]
    for rows in (h1, h2, h3, h15):
        assert len(rows) > 1 and rows == sorted(rows)
