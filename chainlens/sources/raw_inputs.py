"""Scanner-shaped raw inputs derived from the driver tables.

The normalisers read scanner JSON; the driver data is relational.  These
builders turn adapter rows into the JSON documents a scanner would emit, one
document per input row (no grouping, so nothing is gathered into one task),
mixing every shape the normalisers accept.  The oracle states the expected
normalised columns straight from the driver tables, without parsing JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens.sources import adapters as A


def _q(c: Column) -> Column:
    """A JSON string literal of a column known to hold no quote or backslash."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _s(c: str) -> Column:
    return F.col(c).cast("string")


# Fixed values of the findings generator: numeric ids of the scanner enums.
_SEV_ID = {"INFORMATIONAL": 0, "LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
_STATUS_ID = {"PASS": 1, "FAIL": 2, "MANUAL": 3}


def _id_of(col: str, mapping: dict) -> Column:
    e = None
    for k, v in mapping.items():
        e = F.when(F.col(col) == k, v) if e is None else e.when(F.col(col) == k, v)
    return e.otherwise(0)


def raw_findings(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """(seq, raw): one finding object per order, in four shapes by seq % 4.

    0  nested form, numeric severity/status ids, remediation object with code
    1  flat form, lower-case severity, remediation.Recommendation.Text
    2  flat form, remediation as a plain string
    3  nested form with text severity/status; cloud.account null when seq % 5 = 0
    """
    f = A.findings(spark, sf_dir)
    seq = F.col("finding_id")
    ocsf = F.struct(
        F.struct(F.col("check_id").alias("uid"), F.col("check_title").alias("title")).alias("finding_info"),
        F.array(F.struct(F.col("resource_arn").alias("uid"), F.lit("AwsResource").alias("type"),
                         F.col("region").alias("region"))).alias("resources"),
        _id_of("severity", _SEV_ID).alias("severity_id"),
        _id_of("status", _STATUS_ID).alias("status_id"),
        F.col("description").alias("message"),
        F.col("risk").alias("risk"),
        F.struct(F.col("recommendation").alias("desc"),
                 F.array(F.concat(F.lit("https://docs.example.org/"), F.col("check_id"))).alias("references"),
                 F.struct(F.concat(F.lit("fix "), F.col("check_id")).alias("cli")).alias("code")).alias("remediation"),
        F.struct(F.struct(F.col("account_id").alias("uid"),
                          F.concat(F.lit("Account "), F.col("account_id")).alias("name")).alias("account"))
        .alias("cloud"),
        F.struct(F.struct(F.struct(F.col("service").alias("name")).alias("feature")).alias("product"))
        .alias("metadata"),
    )
    flat_common = [
        F.col("account_id"), F.col("region"), F.col("resource_arn"), F.col("check_id"), F.col("check_title"),
        F.col("service").alias("service_name"), F.col("status"), F.col("description"), F.col("risk"),
    ]
    flat_obj = F.struct(
        *flat_common, F.lower(F.col("severity")).alias("severity"),
        F.struct(F.struct(F.col("recommendation").alias("Text"), F.lit("https://docs.example.org").alias("Url"))
                 .alias("Recommendation"),
                 F.struct(F.lit("terraform {}").alias("Terraform")).alias("Code")).alias("remediation"),
    )
    flat_str = F.struct(*flat_common, F.col("severity"), F.col("recommendation").alias("remediation"))
    ocsf_text = F.struct(
        F.struct(F.col("check_id").alias("uid"), F.col("check_title").alias("title")).alias("finding_info"),
        F.array(F.struct(F.col("resource_arn").alias("uid"))).alias("resources"),
        F.col("severity"), F.lit(0).alias("severity_id"), F.col("status"),
        F.col("description").alias("message"), F.col("risk"),
        F.struct(F.col("account_id").alias("uid")).alias("account"),
        F.col("region"),
        F.col("service").alias("service_name"),
    )
    ocsf_text_json = F.to_json(ocsf_text)
    # The account object moves under "cloud"; a null account drops the row.
    shape3 = F.when(seq % 5 == 0, F.regexp_replace(ocsf_text_json, r'"account":\{[^}]*\}', '"cloud":{"account":null}')) \
        .otherwise(F.regexp_replace(ocsf_text_json, r'"account":(\{[^}]*\})', '"cloud":{"account":$1}'))
    raw = (F.when(seq % 4 == 0, F.to_json(ocsf)).when(seq % 4 == 1, F.to_json(flat_obj))
           .when(seq % 4 == 2, F.to_json(flat_str)).otherwise(shape3))
    key = [F.col(c) for c in ("account_id", "resource_arn", "check_id")] if with_key else []
    return f.select(seq.alias("seq"), raw.alias("raw"), *key)


def raw_cve_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_linenumber, instance_id, account_id, region, doc): one CVE report per lineitem.

    Shape by l_linenumber % 3: 0 object root with an extra result whose
    Vulnerabilities is null; 1 bare list of results; 2 object root whose result
    holds a second, sparse vulnerability (no CVSS, no versions).
    Scores sit under nvd for even part keys, else nvd is 0 and redhat holds it.
    """
    li = A.read(spark, sf_dir, "lineitem")
    o = A.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = A.read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey"))
    q, ln, pk = F.col("l_quantity"), F.col("l_linenumber"), F.col("l_partkey")
    score = F.when(F.col("l_tax") >= 0.005, F.round(F.abs(F.col("l_discount")) * 100, 0).cast("decimal(4,1)"))
    sev = F.when(q <= 5, "CRITICAL").when(q <= 15, "high").when(q <= 35, "Medium").otherwise("LOW")
    cvss = F.when(score.isNull(), F.lit(None)).when(
        pk % 2 == 0, F.to_json(F.struct(F.struct(score.alias("V3Score")).alias("nvd")))
    ).otherwise(F.to_json(F.struct(F.struct(F.lit(0).alias("V3Score")).alias("nvd"),
                                   F.struct(score.alias("V3Score")).alias("redhat"))))
    desc = F.when(pk % 10 == 0, F.repeat(F.lit("d"), 1200)).otherwise(F.concat(F.lit("Issue in part "), _s("l_partkey")))
    vuln = F.to_json(F.struct(
        F.concat(F.lit("CVE-"), _s("l_partkey")).alias("VulnerabilityID"),
        F.concat(F.lit("pkg-"), _s("l_suppkey")).alias("PkgName"),
        F.concat(F.lit("1."), ln.cast("string")).alias("InstalledVersion"),
        F.when(ln % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("1."), (ln + 1).cast("string"))).alias("FixedVersion"),
        sev.alias("Severity"),
        F.concat(F.lit("Vulnerability in pkg-"), _s("l_suppkey")).alias("Title"),
        desc.alias("Description"),
        F.concat(F.lit("https://nvd.example.org/CVE-"), _s("l_partkey")).alias("PrimaryURL"),
    ))
    # splice the CVSS object in (to_json cannot nest pre-built JSON text)
    vuln = F.when(cvss.isNull(), vuln).otherwise(
        F.concat(F.substring(vuln, F.lit(1), F.length(vuln) - 1), F.lit(',"CVSS":'), cvss, F.lit("}")))
    sparse = F.concat(F.lit('{"VulnerabilityID":"CVE-'), _s("l_partkey"), F.lit('-b","Severity":"low"}'))
    res = F.concat(F.lit('{"Target":"/","Class":"os-pkgs","Vulnerabilities":['), vuln, F.lit("]}"))
    doc = (F.when(ln % 3 == 0, F.concat(F.lit('{"SchemaVersion":2,"ArtifactName":"/","Results":['), res,
                                        F.lit(',{"Target":"lang","Vulnerabilities":null}]}')))
           .when(ln % 3 == 1, F.concat(F.lit("["), res, F.lit("]")))
           .otherwise(F.concat(F.lit('{"Results":[{"Target":"/","Vulnerabilities":['), vuln, F.lit(","), sparse,
                               F.lit("]}]}"))))
    return j.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("i-"), _s("c_custkey")).alias("instance_id"),
        F.concat(F.lit("acct-"), _s("c_nationkey")).alias("account_id"),
        F.concat(F.lit("NATION_"), _s("c_nationkey")).alias("region"),
        doc.alias("doc"),
    )


def raw_iam_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, account_id, region, item): one path finding per supplier.

    hops h = s % 4 + 1 gives h + 1 nodes: source, Hop-s-i, target.  Node i < h
    carries action sts:AssumeRole (even i) or iam:PassRole (odd i); when s % 3 = 0
    the odd nodes are plain text.  s % 7 = 0 has an empty path, s % 5 = 0 spells
    the key "details", s % 6 = 5 starts from a user, s % 11 = 0 sets is_admin_path.
    Targets of suppliers with balance > 5000 are named AdminRole-s.
    """
    s = A.read(spark, sf_dir, "supplier")
    k, nat = F.col("s_suppkey"), _s("s_nationkey")
    base = F.concat(F.lit("arn:aws:iam::"), nat, F.lit(":"))
    tname = F.when(F.col("s_acctbal") > 5000, F.concat(F.lit("AdminRole-"), _s("s_suppkey"))) \
        .otherwise(F.concat(F.lit("Target-"), _s("s_suppkey")))
    # first name the parts, then assemble the document from them
    parts = s.select(
        "s_suppkey",
        F.concat(F.lit("acct-"), nat).alias("account_id"),
        F.concat(F.lit("NATION_"), nat).alias("region"),
        (k % 4 + 1).cast("int").alias("h"),
        base.alias("base"),
        tname.alias("tname"),
        F.when(k % 6 == 5, F.concat(base, F.lit("user/user-"), _s("s_suppkey")))
        .otherwise(F.concat(base, F.lit("role/Role-"), (k % 20).cast("string"), F.lit("-x"))).alias("src"),
        F.concat(base, F.lit("role/"), tname).alias("tgt"),
    )
    h, src, tgt = F.col("h"), F.col("src"), F.col("tgt")

    def node(i):
        arn = F.when(i == 0, src).when(i == h, tgt).otherwise(
            F.concat(F.col("base"), F.lit("role/Hop-"), _s("s_suppkey"), F.lit("-"), i.cast("string")))
        action = F.when(i % 2 == 0, F.lit("sts:AssumeRole")).otherwise(F.lit("iam:PassRole"))
        obj_with = F.concat(F.lit('{"arn":'), _q(arn), F.lit(',"action":'), _q(action), F.lit("}"))
        obj_last = F.concat(F.lit('{"arn":'), _q(arn), F.lit("}"))
        return F.when(i == h, obj_last).when((k % 3 == 0) & (i % 2 == 1), _q(arn)).otherwise(obj_with)

    nodes = F.when(k % 7 == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(0), h), node), ","), F.lit("]")))
    dkey = F.when(k % 5 == 0, F.lit("details")).otherwise(F.lit("detail"))
    item = F.concat(
        F.lit('{"title":"Escalation '), _s("s_suppkey"), F.lit('","description":'),
        _q(F.concat(F.lit("Path to "), F.col("tname"))),
        F.lit(',"source_arn":'), _q(src), F.lit(',"target_arn":'), _q(tgt),
        F.lit(',"is_admin_path":'), F.when(k % 11 == 0, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"'), dkey, F.lit('":{"source":'), _q(src), F.lit(',"destination":'), _q(tgt),
        F.lit(',"path":'), nodes, F.lit("}}"),
    )
    return parts.select("s_suppkey", "account_id", "region", item.alias("item"))


def raw_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory-service instance rows (input of C-12) from customer."""
    c = A.spread(A.read(spark, sf_dir, "customer"))
    key, nat, ck = _s("c_custkey"), _s("c_nationkey"), F.col("c_custkey")
    state = (F.when(ck % 13 == 0, F.lit("terminated")).when(ck % 17 == 0, F.lit(None).cast("string"))
             .when(F.col("c_mktsegment") == "BUILDING", F.lit("stopped")).otherwise(F.lit("running")))
    return c.select(
        F.concat(F.lit("i-"), key).alias("instance_id"),
        F.concat(F.lit("acct-"), nat).alias("account_id"),
        F.concat(F.lit("NATION_"), nat).alias("region"),
        F.concat(F.lit("arn:aws:ec2:"), nat, F.lit(":instance/i-"), key).alias("arn"),
        state.alias("instance_state"),
        F.concat(F.lit("t3."), (ck % 4).cast("string")).alias("instance_type"),
        F.lit(None).cast("timestamp").alias("launch_time"),
        F.concat(F.lit("vpc-"), (ck % 50).cast("string")).alias("vpc_id"),
        F.concat(F.lit("subnet-"), (ck % 10).cast("string")).alias("subnet_id"),
        F.concat(F.lit("172.16.0."), (ck % 250).cast("string")).alias("private_ip_address"),
        F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("10.0.0."), key)).alias("public_ip_address"),
        F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("ec2-"), key, F.lit(".example.com"))).alias("public_dns_name"),
        F.when(ck % 5 != 0, F.concat(F.lit("arn:aws:iam::"), nat, F.lit(":instance-profile/Role-"),
                                     (ck % 20).cast("string"), F.lit("-x"))).alias("iam_instance_profile_arn"),
        F.concat(F.lit("key-"), nat).alias("key_name"),
        F.when(ck % 9 == 0, F.create_map(F.lit("Env"), F.col("c_mktsegment")))
        .otherwise(F.create_map(F.lit("Name"), F.col("c_name"), F.lit("Env"), F.col("c_mktsegment"))).alias("tags"),
    )


def raw_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory-service bucket rows (input of C-13) from part."""
    p = A.spread(A.read(spark, sf_dir, "part"))
    key, size, pk = _s("p_partkey"), F.col("p_size"), F.col("p_partkey")
    acct = (pk % 25).cast("string")
    return p.select(
        F.concat(F.lit("bucket-"), key).alias("name"),
        F.concat(F.lit("acct-"), acct).alias("account_id"),
        F.concat(F.lit("NATION_"), acct).alias("region"),
        F.when(size % 7 != 0, size % 2 == 0).alias("bucket_policy_is_public"),
        (size % 5 == 0).alias("versioning_enabled"),
        F.when(pk % 2 == 0, F.struct(F.concat(F.lit("logs-"), acct).alias("TargetBucket"))).alias("logging"),
        F.when(size % 3 == 0, F.struct(F.lit("AES256").alias("SSEAlgorithm")))
        .alias("server_side_encryption_configuration"),
        F.lit(None).cast("timestamp").alias("creation_date"),
        F.create_map(F.lit("Owner"), F.col("p_brand")).alias("tags"),
    )


def raw_iam_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory-service user rows (input of C-14) from customer."""
    c = A.spread(A.read(spark, sf_dir, "customer"))
    key, nat, ck = _s("c_custkey"), _s("c_nationkey"), F.col("c_custkey")
    dev = F.struct(F.concat(F.lit("mfa-"), key).alias("SerialNumber"))
    return c.select(
        F.concat(F.lit("user-"), key).alias("name"),
        F.concat(F.lit("acct-"), nat).alias("account_id"),
        F.concat(F.lit("AIDA"), key).alias("user_id"),
        F.concat(F.lit("arn:aws:iam::"), nat, F.lit(":user/user-"), key).alias("arn"),
        (F.col("c_acctbal") > 0).alias("mfa_enabled"),
        F.when(ck % 3 == 0, F.struct(F.lit(True).alias("PasswordResetRequired"))).alias("login_profile"),
        F.when(ck % 4 == 0, F.lit(None)).when(ck % 4 == 1, F.array().cast("array<struct<SerialNumber:string>>"))
        .otherwise(F.array(dev)).alias("mfa_devices"),
        F.lit(None).cast("timestamp").alias("password_last_used"),
        F.lit(None).cast("timestamp").alias("create_date"),
        F.create_map(F.lit("Segment"), F.col("c_mktsegment")).alias("tags"),
    )


def raw_security_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory-service security groups with nested rules (input of C-15), one per part.

    rule A: ports (p_size-1)*100 .. +50+(p%7)*100 (NULL when p % 11 = 0), range 0.0.0.0/0 when p % 3 = 0
    rule B: port 22 from 10.1.0.0/16, plus 0.0.0.0/0 when p % 4 = 0
    rule C: port 3389 with no ranges, only when p % 5 = 0
    """
    p = A.spread(A.read(spark, sf_dir, "part"))
    pk, size = F.col("p_partkey"), F.col("p_size")
    null_port = pk % 11 == 0
    frm = F.when(~null_port, ((size - 1) * 100).cast("int"))
    to = F.when(~null_port, ((size - 1) * 100 + 50 + (pk % 7) * 100).cast("int"))

    def rng(cidr):
        return F.struct(F.lit(cidr).alias("CidrIp"))

    rule_a = F.struct(frm.alias("FromPort"), to.alias("ToPort"),
                      F.array(F.when(pk % 3 == 0, rng("0.0.0.0/0")).otherwise(rng("10.0.0.0/8"))).alias("IpRanges"))
    rule_b = F.struct(F.lit(22).alias("FromPort"), F.lit(22).alias("ToPort"),
                      F.when(pk % 4 == 0, F.array(rng("10.1.0.0/16"), rng("0.0.0.0/0")))
                      .otherwise(F.array(rng("10.1.0.0/16"))).alias("IpRanges"))
    rule_c = F.struct(F.lit(3389).alias("FromPort"), F.lit(3389).alias("ToPort"),
                      F.array().cast("array<struct<CidrIp:string>>").alias("IpRanges"))
    perms = F.when(pk % 5 == 0, F.array(rule_a, rule_b, rule_c)).otherwise(F.array(rule_a, rule_b))
    key = _s("p_partkey")
    acct = (pk % 25).cast("string")
    return p.select(
        F.concat(F.lit("sg-p"), key).alias("group_id"),
        F.concat(F.lit("group-"), key).alias("group_name"),
        F.concat(F.lit("acct-"), acct).alias("account_id"),
        F.concat(F.lit("NATION_"), acct).alias("region"),
        F.concat(F.lit("vpc-"), (pk % 50).cast("string")).alias("vpc_id"),
        F.concat(F.lit("Group for part "), key).alias("description"),
        perms.alias("ip_permissions"),
        F.create_map(F.lit("Name"), F.concat(F.lit("group-"), key)).alias("tags"),
    )


def raw_vpcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = A.read(spark, sf_dir, "nation")
    key = _s("n_nationkey")
    return n.select(
        F.concat(F.lit("vpc-"), key).alias("vpc_id"),
        F.concat(F.lit("acct-"), key).alias("account_id"),
        F.concat(F.lit("NATION_"), key).alias("region"),
        F.concat(F.lit("10."), key, F.lit(".0.0/16")).alias("cidr_block"),
        (F.col("n_nationkey") == 0).alias("is_default"),
        F.lit("available").alias("state"),
        F.create_map(F.lit("Name"), F.col("n_name")).alias("tags"),
    )
