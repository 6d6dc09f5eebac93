import json

from pyspark.sql import functions as F

from chainlens.operators import normalize as N
from tests import samples as S


def _raw(spark, objs):
    return spark.createDataFrame([(i, json.dumps(o) if not isinstance(o, str) else o) for i, o in enumerate(objs)],
                                 "seq long, raw string")


def test_findings_golden(spark):
    out = N.normalize_findings(_raw(spark, S.FINDINGS)).orderBy("seq").collect()
    assert len(out) == 8
    assert sum(r.status == "FAIL" for r in out) == 6
    # flat keys the parser never reads stay empty
    assert all(r.account_name == "" and r.resource_type == "" and r.recommendation_url == "" and
               r.remediation_code == "" for r in out)
    assert out[4].recommendation == "Close the listing."
    assert out[4].service == "s3" and out[4].severity == "CRITICAL"


def test_findings_ocsf_and_edge_cases(spark):
    ocsf = {
        "finding_info": {"uid": "chk", "title": "Title"}, "resources": [{"uid": "arn:x", "type": "T", "region": "eu"}],
        "severity_id": 3, "status_id": 2, "message": "msg", "cloud": {"account": {"uid": "A1", "name": "prod"}},
        "metadata": {"product": {"feature": {"name": "ec2"}}},
        "remediation": {"desc": "", "references": ["https://u", 5], "code": {"cli": "fix"},
                        "Recommendation": {"Text": "Do it"}},
    }
    objs = [
        ocsf,
        {**ocsf, "remediation": "plain text fix", "severity": "low", "status": ""},
        {**ocsf, "cloud": {"account": None}},            # dropped: .get on None
        {**ocsf, "resources": ["not-an-object"]},       # dropped
        {**ocsf, "finding_info": "x"},                  # dropped
        {**ocsf, "severity_id": 9, "status_id": 0, "resources": []},
        {**ocsf, "remediation": {"Recommendation": {"Text": None}}},
        {**ocsf, "metadata": {"product": None}},        # dropped
        "[1, 2]",                                       # not an object: dropped
    ]
    rows = {r.seq: r for r in N.normalize_findings(_raw(spark, objs)).collect()}
    assert sorted(rows) == [0, 1, 5, 6]
    r = rows[0]
    assert (r.account_id, r.account_name, r.region, r.resource_arn, r.resource_type) == ("A1", "prod", "eu", "arn:x", "T")
    assert (r.check_id, r.check_title, r.service, r.severity, r.status) == ("chk", "Title", "ec2", "HIGH", "FAIL")
    assert r.recommendation == "Do it" and r.recommendation_url == "https://u"
    assert json.loads(r.remediation_code) == {"cli": "fix"}
    r = rows[1]
    assert (r.recommendation, r.recommendation_url, r.remediation_code) == ("plain text fix", "", "")
    assert (r.severity, r.status) == ("LOW", "FAIL")
    r = rows[5]
    assert (r.severity, r.status, r.resource_arn, r.region) == ("INFORMATIONAL", "UNKNOWN", "", "")
    assert rows[6].recommendation == "None"


def test_cves_golden(spark):
    doc = json.dumps(S.CVE_REPORT)
    docs = spark.createDataFrame([(S.CVE_INSTANCE, S.ACCOUNT, S.REGION, doc)],
                                 "instance_id string, account_id string, region string, doc string")
    out = N.normalize_cves(docs).collect()
    assert len(out) == 3 and all(r.status == "OPEN" for r in out)
    sev = sorted(float(r.cvss_score) for r in out if r.severity in ("CRITICAL", "HIGH"))
    assert sev == [7.2, 9.4]
    assert out[0].resource_arn == f"arn:aws:ec2:{S.REGION}:{S.ACCOUNT}:instance/{S.CVE_INSTANCE}"


def test_cves_shapes(spark):
    v = {"VulnerabilityID": "C1", "Severity": "high", "Description": "x" * 1500,
         "CVSS": {"nvd": {"V3Score": 0}, "redhat": {"V3Score": 9.85}}}
    docs = [
        ("i-1.json", json.dumps([{"Vulnerabilities": [v, {"VulnerabilityID": None}]}, {"Vulnerabilities": None}])),
        ("i-2.x.json", json.dumps({"Results": [{"Vulnerabilities": [{"PkgName": "p"}]}]})),
        ("i-3.json", json.dumps({"SchemaVersion": 2})),
    ]
    df = spark.createDataFrame(docs, "file string, doc string").select(
        N.instance_id_from_file(F.col("file")).alias("instance_id"), F.lit("A").alias("account_id"),
        F.lit("R").alias("region"), "doc")
    rows = sorted(N.normalize_cves(df).collect(), key=lambda r: (r.instance_id, r._vuln))
    assert [r.instance_id for r in rows] == ["i-1", "i-1", "i-2"]
    a, b, c = rows
    assert (a.cve_id, a.severity, float(a.cvss_score), len(a.description)) == ("C1", "HIGH", 9.9, 1000)
    assert a.fixed_version == "" and b.cve_id is None and b.severity == "UNKNOWN" and b.cvss_score is None
    assert c.package_name == "p" and c.cve_id == ""


def test_iam_paths_golden(spark):
    items = spark.createDataFrame([(i, json.dumps(o), S.ACCOUNT, S.REGION) for i, o in enumerate(S.IAM_PATHS)],
                                  "seq long, item string, account_id string, region string")
    rows = {r.seq: r for r in N.normalize_iam_paths(items).collect()}
    w = rows[0]
    assert (w.hops, w.severity, w.target_is_admin, list(w.methods)) == (2, "CRITICAL", True,
                                                                        ["sts:AssumeRole", "iam:PassRole"])
    assert w.path.count(" -> ") == 2 and w.source_name == "ShopRole" and w.source_type == "role"
    assert (rows[1].severity, rows[1].target_is_admin) == ("MEDIUM", False)
    assert (rows[2].source_type, rows[2].hops, rows[2].severity) == ("user", 1, "CRITICAL")
    assert sum(r.target_is_admin for r in rows.values()) == 2


def test_iam_paths_shapes(spark):
    objs = [
        {"details": {"source": "arn:r:role/A", "destination": "arn:r:role/SuperUserX",
                     "path": ["arn:r:role/A", {"arn": "arn:r:role/B", "action": "x:Y"}, "arn:r:role/SuperUserX"]}},
        {"source_arn": "arn:r:user/u", "target_arn": "arn:r:role/T", "path": []},
        {"source_arn": None, "target_arn": "arn:r:role/T"},     # dropped
        {"target_arn": "arn:r:role/T", "is_admin_path": 1},
    ]
    items = spark.createDataFrame([(i, json.dumps(o)) for i, o in enumerate(objs)], "seq long, item string") \
        .withColumn("account_id", F.lit("A")).withColumn("region", F.lit("R"))
    rows = {r.seq: r for r in N.normalize_iam_paths(items).collect()}
    assert sorted(rows) == [0, 1, 3]
    a = rows[0]
    assert a.path == "arn:r:role/A -> arn:r:role/B -> arn:r:role/SuperUserX"
    assert list(a.methods) == ["x:Y"] and a.target_is_admin and a.severity == "CRITICAL" and a.hops == 2
    b = rows[1]
    assert (b.path, b.hops, list(b.methods), b.source_type, b.severity) == (
        "arn:r:user/u -> arn:r:role/T", 1, ["sts:AssumeRole"], "user", "MEDIUM")
    c = rows[3]
    assert (c.source_arn, c.source_name, c.target_is_admin, c.path) == ("", "", True, " -> arn:r:role/T")


def test_security_group_flags(spark):
    perms = "array<struct<FromPort:int,ToPort:int,IpRanges:array<struct<CidrIp:string>>>>"
    rows = [
        ("g1", [(22, 22, [("0.0.0.0/0",)])]),
        ("g2", [(None, None, [("0.0.0.0/0",)])]),
        ("g3", [(3000, 4000, [("10.0.0.0/8",), ("0.0.0.0/0",)])]),
        ("g4", None),
        ("g5", [(0, 65535, [])]),
    ]
    raw = spark.createDataFrame(rows, f"group_id string, ip_permissions {perms}").select(
        "group_id", F.lit("n").alias("group_name"), F.lit("A").alias("account_id"), F.lit("R").alias("region"),
        F.lit("v").alias("vpc_id"), F.lit("d").alias("description"), "ip_permissions",
        F.create_map().cast("map<string,string>").alias("tags"))
    got = {r.group_id: (r.allows_all_ingress, r.allows_ssh_public, r.allows_rdp_public)
           for r in N.project_security_groups(raw).collect()}
    assert got == {"g1": (True, True, False), "g2": (True, False, False), "g3": (True, False, True),
                   "g4": (False, False, False), "g5": (False, False, False)}


def test_findings_severity_map_parameter(spark):
    # OCSF numbering (1 informational ... 5 critical) instead of the default map
    ocsf_ids = {1: "INFORMATIONAL", 2: "LOW", 3: "MEDIUM", 4: "HIGH", 5: "CRITICAL"}
    raw = _raw(spark, [{"severity_id": 4, "account_id": "A"}])
    assert N.normalize_findings(raw).collect()[0].severity == "CRITICAL"
    assert N.normalize_findings(raw, severity_map=ocsf_ids).collect()[0].severity == "HIGH"


def test_security_group_flags_fixed(spark):
    perms = ("array<struct<FromPort:int,ToPort:int,IpRanges:array<struct<CidrIp:string>>,"
             "Ipv6Ranges:array<struct<CidrIpv6:string>>>>")
    rows = [("all", [(None, None, [("0.0.0.0/0",)], [])]), ("v6", [(22, 22, [], [("::/0",)])])]
    raw = spark.createDataFrame(rows, f"group_id string, ip_permissions {perms}").select(
        "group_id", F.lit("n").alias("group_name"), F.lit("A").alias("account_id"), F.lit("R").alias("region"),
        F.lit("v").alias("vpc_id"), F.lit("d").alias("description"), "ip_permissions",
        F.create_map().cast("map<string,string>").alias("tags"))

    def flags(df):
        return {r.group_id: (r.allows_all_ingress, r.allows_ssh_public, r.allows_rdp_public) for r in df.collect()}

    assert flags(N.project_security_groups(raw)) == {"all": (True, False, False), "v6": (False, False, False)}
    assert flags(N.project_security_groups(raw, fix_ingress=True)) == {"all": (True, True, True),
                                                                      "v6": (True, True, False)}
