import json
import os
import time

import pytest

from chainlens.operators import normalize as N
from chainlens.operators.upsert import dedup_last
from chainlens.session import scratch_path
from chainlens.sources import files as S
from tests import samples


def _local(spark, name):
    p = scratch_path(spark, name)
    p = p.replace("file://", "").replace("file:", "")
    os.makedirs(p, exist_ok=True)
    return p


def test_iter_documents():
    text = ' [{"a": 1}, 5, {"b": 2}] , {"c": 3}\n[{"d": 4}] trailing junk {"e": 5}'
    assert [json.loads(x) for x in S.iter_documents(text)] == [{"a": 1}, {"b": 2}, {"c": 3}, {"d": 4}]
    assert list(S.iter_documents("")) == [] and list(S.iter_documents("not json")) == [] and list(S.iter_documents(", {}")) == []


def test_findings_files_multi_array_and_order(spark):
    d = _local(spark, "findings-files")
    f1, f2 = os.path.join(d, "a.json"), os.path.join(d, "b.json")
    same = {"account_id": "A", "resource_arn": "r", "check_id": "c", "status": "FAIL", "check_title": "t"}
    with open(f1, "w") as fh:
        fh.write(json.dumps([{**same, "severity": "LOW"}]) + "\n" + json.dumps([{**same, "severity": "HIGH"}, 7]))
    with open(f2, "w") as fh:
        fh.write(json.dumps({**same, "severity": "MEDIUM"}) + " garbage [")
    # argument order decides last-wins: f2 then f1 -> f1's last row (HIGH) wins
    raw = S.read_findings_files(spark, [f2, f1])
    assert raw.count() == 3
    rows = N.normalize_findings(raw.select("seq", "raw"))
    final = dedup_last(rows, ["account_id", "resource_arn", "check_id"], "seq").collect()
    assert [r.severity for r in final] == ["HIGH"]
    raw2 = S.read_findings_files(spark, [f1, f2])
    final2 = dedup_last(N.normalize_findings(raw2.select("seq", "raw")), ["account_id", "resource_arn", "check_id"],
                        "seq").collect()
    assert [r.severity for r in final2] == ["MEDIUM"]


def test_findings_lines_equals_splitter(spark):
    d = _local(spark, "findings-lines")
    p = os.path.join(d, "f.jsonl")
    with open(p, "w") as fh:
        for o in samples.FINDINGS[2:]:
            fh.write(json.dumps(o) + "\n")
        fh.write(json.dumps([*samples.FINDINGS[:2], 7, {"b": 1}]) + "\n")   # an array on a line
    a = sorted(r.raw for r in S.read_findings_lines(spark, p).collect())
    b = sorted(r.raw for r in S.read_findings_files(spark, p).collect())
    assert a == b and len(a) == 9


def test_newest_file(spark):
    d = _local(spark, "newest")
    for name in ("old.ocsf.json", "new.ocsf.json", "other.json"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("[]")
        time.sleep(0.05)
    os.utime(os.path.join(d, "old.ocsf.json"), (1, 1))
    assert S.newest_file(spark, d).endswith("new.ocsf.json")
    e = _local(spark, "newest-empty")
    with pytest.raises(FileNotFoundError):
        S.newest_file(spark, e)


def test_cve_reports_from_files(spark):
    d = _local(spark, "cve-files")
    with open(os.path.join(d, samples.CVE_INSTANCE + ".json"), "w") as fh:
        json.dump(samples.CVE_REPORT, fh)
    with open(os.path.join(d, "i-0second.scan.json"), "w") as fh:
        json.dump(samples.CVE_REPORT["Results"], fh)          # bare list root
    rows = S.read_cve_reports(spark, d, samples.ACCOUNT, samples.REGION).collect()
    assert sorted({r.instance_id for r in rows}) == ["i-0second", "i-shop01"]
    assert len(rows) == 6


def test_iam_paths_from_files(spark):
    d = _local(spark, "iam-files")
    with open(os.path.join(d, "list.json"), "w") as fh:
        json.dump(samples.IAM_PATHS, fh)
    with open(os.path.join(d, "wrapped.json"), "w") as fh:
        json.dump({"findings": samples.IAM_PATHS[:2]}, fh)
    rows = S.read_iam_paths(spark, d, samples.ACCOUNT, samples.REGION).collect()
    assert len(rows) == 5
    assert sum(r.target_is_admin for r in rows) == 3


def test_inventory_bundle(spark):
    d = _local(spark, "bundle")
    p = os.path.join(d, "bundle.json")
    with open(p, "w") as fh:
        json.dump({**samples.INVENTORY, "vpcs": []}, fh)
    tables = S.read_inventory_bundle(spark, p)
    assert sorted(tables) == ["iam", "instances", "s3", "security_groups"]
    assert tables["instances"].count() == 3
    ser = N.serialize_nested(tables["instances"])
    assert dict(ser.dtypes)["tags"] == "string"


def test_accounts_and_select(spark):
    d = _local(spark, "accounts")
    p = os.path.join(d, "accounts.yaml")
    with open(p, "w") as fh:
        fh.write("accounts:\n  - id: '111'\n    name: prod\n    region: us-east-1\n    profile: p\n"
                 "  - id: '222'\n    name: '111'\n    region: eu-west-1\n    role_arn: arn:r\n")
    acc = S.read_accounts(spark, p)
    assert S.select_accounts(acc).count() == 2
    assert [r.id for r in S.select_accounts(acc, "111").collect()] == ["111"]    # id before name
    assert [r.id for r in S.select_accounts(acc, "prod").collect()] == ["111"]
    with pytest.raises(ValueError):
        S.select_accounts(acc, "nope")
    empty = os.path.join(d, "empty.yaml")
    with open(empty, "w") as fh:
        fh.write("accounts: []\n")
    with pytest.raises(ValueError):
        S.read_accounts(spark, empty)


def test_latest_report(spark):
    d = _local(spark, "reports")
    none = S.latest_report(spark, d).collect()
    assert len(none) == 1 and none[0].content is None
    for name, body in (("security_report_a.md", "old"), ("security_report_b.md", "new"), ("notes.md", "x")):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(body)
    os.utime(os.path.join(d, "security_report_a.md"), (1, 1))
    r = S.latest_report(spark, d).collect()[0]
    assert (r.content, r.filename) == ("new", "security_report_b.md") and r.generated.endswith("UTC")


def test_unreadable_documents_are_errors_or_counted(spark):
    d = _local(spark, "cut-off")
    whole = json.dumps(samples.CVE_REPORT)
    for name, text in (("i-1.json", whole), ("i-2.json", whole[:len(whole) // 2]), ("i-3.json", "")):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    with pytest.raises(Exception, match="not a JSON document"):
        S.read_cve_reports(spark, d, samples.ACCOUNT, samples.REGION).collect()
    kept = S.read_cve_reports(spark, d, samples.ACCOUNT, samples.REGION, on_error="skip").collect()
    assert {r.instance_id for r in kept} == {"i-1"} and len(kept) == 3
    assert tuple(S.count_unreadable(spark, d).first()) == (3, 2)
    with pytest.raises(ValueError):
        S.read_inventory_bundle(spark, os.path.join(d, "i-2.json"))
    with pytest.raises(Exception, match="not a JSON document"):
        S.read_iam_paths(spark, os.path.join(d, "i-2.json"), "a", "r").collect()


def test_folders_that_spark_jobs_leave(spark):
    d = _local(spark, "landed")
    spark.createDataFrame([("i-7.nightly.json", json.dumps(samples.CVE_REPORT))], "scan string, value string") \
        .write.mode("append").partitionBy("scan").text(os.path.join(d, "reports"))
    rows = S.read_cve_reports(spark, os.path.join(d, "reports"), samples.ACCOUNT, samples.REGION).collect()
    assert rows and {r.instance_id for r in rows} == {"i-7"}
    files = [(f'accounts:\n  - {{"id": {k}, "name": "n{k}"}}\n  - {{"id": "x{k}", "session_duration": 900}}',) for k in range(5)] + [("accounts: []",)]
    spark.createDataFrame(files, "value string").repartition(3).write.option("maxRecordsPerFile", 1).text(os.path.join(d, "registry"))
    acc = {r.id: r for r in S.read_accounts(spark, os.path.join(d, "registry")).collect()}
    assert set(acc) == {*"01234", *(f"x{k}" for k in range(5))}
    assert acc["3"].name == "n3" and acc["3"].session_duration is None and acc["x3"].session_duration == 900


def test_files_of_no_bytes_are_no_documents(spark):
    d = _local(spark, "no-bytes")
    os.makedirs(os.path.join(d, "sub"))
    for name in ("i-1.json", "sub/i-2.json"):
        open(os.path.join(d, name), "w").close()
    with open(os.path.join(d, "i-3.json"), "w") as fh:
        fh.write("[]")
    flat = S.count_unreadable(spark, os.path.join(d, "*.json")).first()
    assert (flat["files"], flat.unreadable) == (2, 1)
    with pytest.raises(ValueError, match="not a JSON document"):
        S.read_documents(spark, os.path.join(d, "sub"))


def test_landed_files_hold_bounded_rows(spark, monkeypatch):
    from chainlens.sources import landing

    sf = "/root/testdata/sf0.001"
    paths = {}
    for size in (4096, 64):
        monkeypatch.setattr(landing, "BLOCK", size)
        path = landing.write_accounts(spark, sf)
        paths[size] = spark.read.format("binaryFile").load(path).count()
        assert S.read_accounts(spark, path).count() == spark.read.parquet(f"{sf}/customer.parquet").count()
    assert paths[64] > paths[4096] == 1
