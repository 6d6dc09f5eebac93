"""Column lists of the stored security tables and their upsert specs.

Each table is a plain DataFrame; these lists fix the column order a
normaliser emits and an upsert keeps.  The surrogate SERIAL ids of the
relational original are dropped: no query reads them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

FINDINGS = [
    "account_id", "account_name", "region", "resource_arn", "resource_type", "check_id", "check_title",
    "service", "severity", "status", "description", "risk", "recommendation", "recommendation_url",
    "remediation_code", "raw_json", "ingested_at",
]

CVES = [
    "resource_arn", "instance_id", "account_id", "region", "cve_id", "severity", "cvss_score", "package_name",
    "installed_version", "fixed_version", "title", "description", "primary_url", "status", "raw_json",
    "ingested_at",
]

IAM_RISKS = [
    "account_id", "region", "source_arn", "source_type", "source_name", "target_arn", "target_type",
    "target_name", "target_is_admin", "path", "hops", "methods", "severity", "description", "raw_json",
    "ingested_at",
]

INSTANCES = [
    "instance_id", "account_id", "region", "resource_arn", "instance_state", "instance_type", "launch_time",
    "vpc_id", "subnet_id", "private_ip", "public_ip", "public_dns", "iam_instance_profile", "key_name",
    "name_tag", "tags", "raw_json", "synced_at",
]

BUCKETS = [
    "bucket_name", "account_id", "region", "resource_arn", "public_access_blocked", "versioning_enabled",
    "logging_enabled", "encryption_enabled", "creation_date", "tags", "raw_json", "synced_at",
]

IAM_USERS = [
    "user_name", "account_id", "user_id", "resource_arn", "mfa_enabled", "has_console_access",
    "has_access_keys", "password_last_used", "access_key_last_used", "create_date", "tags", "raw_json",
    "synced_at",
]

SECURITY_GROUPS = [
    "group_id", "group_name", "account_id", "region", "resource_arn", "vpc_id", "description",
    "allows_all_ingress", "allows_ssh_public", "allows_rdp_public", "tags", "raw_json", "synced_at",
]

VPCS = ["vpc_id", "account_id", "region", "cidr_block", "is_default", "state", "tags", "raw_json", "synced_at"]

SYNC_LOG = ["synced_at", "account_id", "table_name", "rows_synced", "duration_ms", "status", "error_msg"]


@dataclass(frozen=True)
class UpsertSpec:
    """Keyed partial-column upsert: on a key conflict only ``updated`` columns
    take the batch value and ``stamp`` is re-set; all other columns keep the
    value first inserted."""

    name: str
    key: tuple[str, ...]
    updated: tuple[str, ...]
    stamp: str
    dedup_batch: bool = False  # findings are de-duplicated last-wins before insert (F-1)
    extra: dict = field(default_factory=dict)


# The key and the overwritten columns of each table's upsert.
FINDINGS_SPEC = UpsertSpec(
    "findings", ("account_id", "resource_arn", "check_id"),
    ("status", "severity", "description", "recommendation", "remediation_code", "raw_json"),
    "ingested_at", dedup_batch=True,
)
CVES_SPEC = UpsertSpec(
    "cves", ("resource_arn", "cve_id", "package_name"),
    ("severity", "cvss_score", "installed_version", "fixed_version", "status", "raw_json"),
    "ingested_at",
)
INSTANCES_SPEC = UpsertSpec(
    "instances", ("instance_id",),
    ("instance_state", "public_ip", "iam_instance_profile", "tags", "raw_json"), "synced_at",
)
BUCKETS_SPEC = UpsertSpec(
    "buckets", ("bucket_name",), ("public_access_blocked", "encryption_enabled", "tags", "raw_json"), "synced_at",
)
IAM_USERS_SPEC = UpsertSpec(
    "iam_users", ("user_id",), ("mfa_enabled", "has_access_keys", "password_last_used", "tags", "raw_json"),
    "synced_at",
)
SECURITY_GROUPS_SPEC = UpsertSpec(
    "security_groups", ("group_id",),
    ("allows_all_ingress", "allows_ssh_public", "allows_rdp_public", "tags", "raw_json"), "synced_at",
)
VPCS_SPEC = UpsertSpec("vpcs", ("vpc_id",), ("state", "tags", "raw_json"), "synced_at")
IAM_RISKS_SPEC = UpsertSpec(
    "iam_risks", ("account_id", "source_arn", "target_arn"),
    ("path", "hops", "methods", "severity", "target_is_admin", "description", "raw_json"), "ingested_at",
)

SPECS = {s.name: s for s in (FINDINGS_SPEC, CVES_SPEC, INSTANCES_SPEC, BUCKETS_SPEC, IAM_USERS_SPEC,
                              SECURITY_GROUPS_SPEC, VPCS_SPEC, IAM_RISKS_SPEC)}
