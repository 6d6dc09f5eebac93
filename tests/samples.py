"""Own scanner inputs for the tests: a small shop's account with two web hosts,
a batch host that is off, two upload buckets and three people.

Account 400000000001 is the ingest context of the expectations in
tests/test_golden.py, which are worked out by hand from these rows.
"""

import json

ACCOUNT = "400000000001"
REGION = "eu-central-1"

HOST_A, HOST_B, HOST_OFF = "i-shop01", "i-shop02", "i-night01"


def _host_arn(host, region=REGION):
    return f"arn:aws:ec2:{region}:{ACCOUNT}:instance/{host}"


def _bucket_arn(name):
    return f"arn:aws:s3:::{name}"


def _user_arn(name):
    return f"arn:aws:iam::{ACCOUNT}:user/{name}"


def _role_arn(name):
    return f"arn:aws:iam::{ACCOUNT}:role/{name}"


def _finding(arn, service, check, severity, status, fix, **more):
    return {"account_id": ACCOUNT, "region": REGION, "resource_arn": arn, "service_name": service, "check_id": check,
            "check_title": check.replace("_", " ").capitalize(), "severity": severity, "status": status,
            "description": f"{check} on {arn}", "risk": "exposure",
            "remediation": {"Recommendation": {"Text": fix, "Url": f"https://docs.example.org/{check}"}}, **more}


FINDINGS = [
    _finding(_host_arn(HOST_A), "ec2", "metadata_service_open", "HIGH", "FAIL", "Require tokens."),
    _finding(_host_arn(HOST_A), "ec2", "disk_not_encrypted", "LOW", "FAIL", "Encrypt the disk."),
    _finding(_host_arn(HOST_B), "ec2", "metadata_service_open", "HIGH", "PASS", ""),
    _finding(_host_arn(HOST_OFF), "ec2", "disk_not_encrypted", "MEDIUM", "FAIL", "Encrypt the disk."),
    _finding(_bucket_arn("shop-uploads"), "s3", "bucket_listing_open", "CRITICAL", "FAIL", "Close the listing."),
    _finding(_bucket_arn("shop-logs"), "s3", "bucket_listing_open", "CRITICAL", "PASS", ""),
    _finding(_user_arn("olga"), "iam", "user_without_mfa", "CRITICAL", "FAIL", "Turn on MFA."),
    _finding(_user_arn("deploy"), "iam", "old_access_key", "MEDIUM", "FAIL", "Rotate the key."),
]


def _vuln(number, package, version, fixed, severity, score, title):
    return {"VulnerabilityID": f"CVE-2030-{number}", "PkgName": package, "InstalledVersion": version, "FixedVersion": fixed,
            "Severity": severity, "Title": title, "Description": f"{title}, in {package}", "PrimaryURL": f"https://cve.example.org/{number}",
            "CVSS": {"nvd": {"V3Score": score}}}


CVE_INSTANCE = HOST_A
CVE_REPORT = {"SchemaVersion": 2, "Results": [
    {"Target": "os", "Vulnerabilities": [
        _vuln(11, "libimage", "2.0", "2.1", "CRITICAL", 9.4, "Overflow in decoder"),
        _vuln(12, "netd", "1.4", "", "HIGH", 7.2, "Unchecked length")]},
    {"Target": "app", "Vulnerabilities": [
        _vuln(13, "templater", "5", "6", "MEDIUM", 5.0, "Reflected input")]},
]}


def _path(source, target, admin, *steps):
    """steps: (arn, action) of every hop; the target ends the path."""
    return {"title": f"{source} reaches {target}", "description": " then ".join(a for _, a in steps), "source_arn": source,
            "target_arn": target, "is_admin_path": admin,
            "detail": {"source": source, "destination": target,
                       "path": [{"arn": arn, "action": action} for arn, action in steps] + [{"arn": target}]}}


SHOP, OPS, OWNER = _role_arn("ShopRole"), _role_arn("OpsRole"), _role_arn("OwnerRole")
IAM_PATHS = [
    _path(SHOP, OWNER, True, (SHOP, "sts:AssumeRole"), (OPS, "iam:PassRole")),
    _path(SHOP, OPS, False, (SHOP, "ssm:SendCommand")),
    _path(_user_arn("deploy"), OWNER, True, (_user_arn("deploy"), "iam:PassRole")),
]


def _host(host, state, kind, public_ip, role, name):
    return {"instance_id": host, "account_id": ACCOUNT, "region": REGION, "resource_arn": _host_arn(host),
            "instance_state": state, "instance_type": kind, "vpc_id": "vpc-shop", "public_ip": public_ip,
            "iam_instance_profile": role and f"arn:aws:iam::{ACCOUNT}:instance-profile/{role}", "name_tag": name,
            "tags": {"Name": name}}


def _bucket(name, blocked):
    return {"bucket_name": name, "account_id": ACCOUNT, "region": REGION, "resource_arn": _bucket_arn(name),
            "public_access_blocked": blocked, "versioning_enabled": blocked, "encryption_enabled": True}


def _user(name, mfa):
    return {"user_name": name, "account_id": ACCOUNT, "user_id": f"U-{name}", "resource_arn": _user_arn(name), "mfa_enabled": mfa,
            "has_access_keys": not mfa}


def _group(group, ssh):
    return {"group_id": group, "group_name": f"{group}-rules", "account_id": ACCOUNT, "region": REGION, "vpc_id": "vpc-shop",
            "allows_all_ingress": False, "allows_ssh_public": ssh, "allows_rdp_public": False}


INVENTORY = {
    "instances": [
        _host(HOST_A, "running", "m6.large", "203.0.113.7", "ShopRole", "shop front"),
        _host(HOST_B, "running", "m6.large", None, "ShopRole", "shop back"),
        _host(HOST_OFF, "stopped", "m6.small", None, None, "night batch"),
    ],
    "s3": [_bucket("shop-uploads", False), _bucket("shop-logs", True)],
    "iam": [_user("olga", False), _user("deploy", False), _user("petra", True)],
    "security_groups": [_group("sg-front", True), _group("sg-inner", False), _group("sg-spare", False)],
    "vpcs": [{"vpc_id": "vpc-shop", "account_id": ACCOUNT, "region": REGION, "cidr_block": "10.9.0.0/16", "is_default": False,
              "state": "available"}],
}


def dumps_all(objs):
    return [json.dumps(o) for o in objs]
