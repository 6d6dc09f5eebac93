"""Independent SQL statements of every registered query (DuckDB dialect).

The adapter projections of ``chainlens.sources.adapters`` are restated here as
CTEs over the driver's tables; each oracle query is ``WITH <ctes> <body>``.
Only ``||`` is used for concatenation (NULL-propagating, as in the reference).
"""

from __future__ import annotations

ADAPTER_CTES = {
    "instances": """
SELECT 'i-' || c_custkey AS instance_id,
       'acct-' || c_nationkey AS account_id,
       'NATION_' || c_nationkey AS region,
       'arn:aws:ec2:' || c_nationkey || ':instance/i-' || c_custkey AS resource_arn,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'stopped' ELSE 'running' END AS instance_state,
       't3.' || (c_custkey % 4) AS instance_type,
       'vpc-' || (c_custkey % 50) AS vpc_id,
       CASE WHEN c_acctbal > 5000 THEN '10.0.0.' || c_custkey END AS public_ip,
       CASE WHEN c_custkey % 5 <> 0 THEN 'arn:aws:iam::' || c_nationkey || ':instance-profile/Role-' || (c_custkey % 20) || '-x' END AS iam_instance_profile,
       c_name AS name_tag
FROM customer""",
    "findings": """
SELECT o_orderkey AS finding_id,
       'acct-' || c_nationkey AS account_id,
       'NATION_' || c_nationkey AS region,
       CASE o_orderkey % 3 WHEN 0 THEN 'arn:aws:ec2:' || c_nationkey || ':instance/i-' || c_custkey
                           WHEN 1 THEN 'arn:aws:s3:::bucket-' || c_custkey
                           ELSE 'arn:aws:iam::' || c_nationkey || ':user/user-' || c_custkey END AS resource_arn,
       'check_' || (o_orderkey % 40) AS check_id,
       'Check ' || (o_orderkey % 40) AS check_title,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN '' ELSE 'svc-' || (o_orderkey % 13) END AS service,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH' WHEN '3-MEDIUM' THEN 'MEDIUM'
                            WHEN '4-NOT SPECIFIED' THEN 'LOW' ELSE 'INFORMATIONAL' END AS severity,
       CASE o_orderstatus WHEN 'F' THEN 'FAIL' WHEN 'O' THEN 'PASS' ELSE 'MANUAL' END AS status,
       'Finding ' || o_orderkey AS description,
       'Risk ' || (o_orderkey % 7) AS risk,
       CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'Remediate check ' || (o_orderkey % 40) END AS recommendation,
       o_orderdate AS ingested_at
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "cves": """
SELECT 'arn:aws:ec2:' || c_nationkey || ':instance/i-' || c_custkey AS resource_arn,
       'i-' || c_custkey AS instance_id,
       'acct-' || c_nationkey AS account_id,
       'NATION_' || c_nationkey AS region,
       'CVE-' || l_partkey AS cve_id,
       CASE WHEN l_quantity <= 5 THEN 'CRITICAL' WHEN l_quantity <= 15 THEN 'HIGH'
            WHEN l_quantity <= 35 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
       CASE WHEN l_tax >= 0.005 THEN CAST(round(abs(l_discount) * 100, 0) AS DECIMAL(4,1)) END AS cvss_score,
       'pkg-' || l_suppkey AS package_name,
       '1.' || l_linenumber AS installed_version,
       CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE '1.' || (l_linenumber + 1) END AS fixed_version,
       'Vulnerability in pkg-' || l_suppkey AS title,
       'https://nvd.example.org/CVE-' || l_partkey AS primary_url,
       CASE WHEN l_linestatus = 'O' THEN 'OPEN' ELSE 'FIXED' END AS status,
       l_shipdate AS ingested_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "iam_risks": """
SELECT 'acct-' || s_nationkey AS account_id,
       'NATION_' || s_nationkey AS region,
       'arn:aws:iam::' || s_nationkey || ':role/Role-' || (s_suppkey % 20) || '-x' AS source_arn,
       'role' AS source_type,
       'Role-' || (s_suppkey % 20) || '-x' AS source_name,
       'arn:aws:iam::' || s_nationkey || ':role/Target-' || s_suppkey AS target_arn,
       'role' AS target_type,
       'Target-' || s_suppkey AS target_name,
       s_acctbal > 5000 AS target_is_admin,
       'arn:aws:iam::' || s_nationkey || ':role/Role-' || (s_suppkey % 20) || '-x' || ' -> ' ||
       'arn:aws:iam::' || s_nationkey || ':role/Target-' || s_suppkey AS path,
       CAST(s_suppkey % 4 + 1 AS INTEGER) AS hops,
       CASE WHEN s_suppkey % 4 + 1 > 1 THEN ['sts:AssumeRole', 'iam:PassRole'] ELSE ['sts:AssumeRole'] END AS methods,
       CASE WHEN s_acctbal > 5000 AND s_suppkey % 4 + 1 <= 2 THEN 'CRITICAL'
            WHEN s_acctbal > 5000 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       'Path to Target-' || s_suppkey AS description
FROM supplier""",
    "buckets": """
SELECT 'bucket-' || p_partkey AS bucket_name,
       'acct-' || (p_partkey % 25) AS account_id,
       'NATION_' || (p_partkey % 25) AS region,
       'arn:aws:s3:::bucket-' || p_partkey AS resource_arn,
       CASE WHEN p_size % 7 <> 0 THEN p_size % 2 = 0 END AS public_access_blocked,
       p_size % 5 = 0 AS versioning_enabled,
       p_partkey % 2 = 0 AS logging_enabled,
       p_size % 3 = 0 AS encryption_enabled
FROM part""",
    "iam_users": """
SELECT 'user-' || c_custkey AS user_name,
       'acct-' || c_nationkey AS account_id,
       'AIDA' || c_custkey AS user_id,
       'arn:aws:iam::' || c_nationkey || ':user/user-' || c_custkey AS resource_arn,
       c_acctbal > 0 AS mfa_enabled,
       c_custkey % 3 = 0 AS has_console_access,
       c_custkey % 2 = 0 AS has_access_keys,
       CAST(NULL AS TIMESTAMP) AS password_last_used
FROM customer""",
    "sg_rules": """
SELECT 'sg-' || (p_partkey % 20) AS group_id,
       CASE WHEN p_partkey % 11 <> 0 THEN CAST((p_size - 1) * 100 AS INTEGER) END AS from_port,
       CASE WHEN p_partkey % 11 <> 0 THEN CAST((p_size - 1) * 100 + 50 + (p_partkey % 7) * 100 AS INTEGER) END AS to_port,
       CASE WHEN p_partkey % 3 = 0 THEN '0.0.0.0/0' ELSE '10.0.0.0/8' END AS cidr
FROM part""",
    "security_groups": """
SELECT 'sg-' || s_suppkey AS group_id,
       'group-' || s_suppkey AS group_name,
       'acct-' || s_nationkey AS account_id,
       'NATION_' || s_nationkey AS region,
       'vpc-' || (s_suppkey % 50) AS vpc_id,
       coalesce(f.allows_all_ingress, false) AS allows_all_ingress,
       coalesce(f.allows_ssh_public, false) AS allows_ssh_public,
       coalesce(f.allows_rdp_public, false) AS allows_rdp_public
FROM supplier LEFT JOIN (
    SELECT group_id,
           bool_or(cidr = '0.0.0.0/0') AS allows_all_ingress,
           bool_or(coalesce(cidr = '0.0.0.0/0' AND from_port <= 22 AND to_port >= 22, false)) AS allows_ssh_public,
           bool_or(coalesce(cidr = '0.0.0.0/0' AND from_port <= 3389 AND to_port >= 3389, false)) AS allows_rdp_public
    FROM sg_rules GROUP BY group_id) f ON f.group_id = 'sg-' || s_suppkey""",
    "vpcs": """
SELECT 'vpc-' || n_nationkey AS vpc_id,
       'acct-' || n_nationkey AS account_id,
       'NATION_' || n_nationkey AS region,
       '10.' || n_nationkey || '.0.0/16' AS cidr_block,
       n_nationkey = 0 AS is_default,
       'available' AS state
FROM nation""",
    "online_agents": """
SELECT 'i-' || c_custkey AS instance_id FROM customer WHERE c_acctbal >= 0""",
}


def with_adapters(body: str, extra: dict | None = None) -> str:
    """``WITH <adapter CTEs>, <extra CTEs> <body>``."""
    allc = {**ADAPTER_CTES, **(extra or {})}
    ctes = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in allc.items())
    return f"WITH {ctes}\n{body}"
