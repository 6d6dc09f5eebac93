"""Commits of touched parts, change feeds, maintained summaries and chains, sets of tables."""

import os
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chainlens import schemas as SCH
from chainlens.operators import changes as C
from chainlens.operators import correlate as E
from chainlens.operators import ranking as H
from chainlens.operators import summary as G
from chainlens.operators import upsert as U
from chainlens.session import scratch_path
from chainlens.sources import parts, table_set

AS_OF = "2021-01-01 00:00:00"
DDL = {
    "findings": "account_id string, resource_arn string, check_id string, check_title string, severity string, status string, "
                "recommendation string, ingested_at timestamp",
    "cves": "resource_arn string, cve_id string, package_name string, instance_id string, account_id string, severity string, "
            "cvss_score decimal(4,1), fixed_version string, title string, status string, ingested_at timestamp",
    "iam_risks": "account_id string, source_arn string, target_arn string, path string, hops int, target_name string, "
                 "target_is_admin boolean, severity string, ingested_at timestamp",
    "instances": "instance_id string, account_id string, region string, resource_arn string, instance_state string, instance_type string, "
                 "public_ip string, iam_instance_profile string, name_tag string, synced_at timestamp",
}
SPECS = {t: SCH.SPECS[t] for t in DDL}


def random_rows(table, rng, n):
    """Rows of few keys, so that batches meet stored rows; some keys are NULL."""
    host = lambda: rng.randrange(6)
    acct = lambda h: f"acct-{h % 2}"
    out = []
    for _ in range(n):
        h = host()
        arn = f"arn:{acct(h)}:i-{h}"
        if table == "findings":
            out.append((acct(h), None if rng.random() < .05 else arn, f"c{rng.randrange(3)}", f"t{rng.randrange(2)}", rng.choice(["HIGH", "LOW", "CRITICAL"]),
                        rng.choice(["FAIL", "PASS", "FAIL"]), "fix", None))
        elif table == "cves":
            out.append((arn, f"CVE-{rng.randrange(3)}", rng.choice(["p", "q", None]), f"i-{h}", acct(h), rng.choice(["HIGH", "CRITICAL", "LOW"]),
                        rng.choice([None, Decimal(7), Decimal(9)]), "2", "title", rng.choice(["OPEN", "OPEN", "FIXED"]), None))
        elif table == "iam_risks":
            role = rng.choice(["Role-1", "Role-2", "Other"])
            out.append((acct(h), f"arn:{role}-x", f"target-{rng.randrange(3)}", f"path {rng.randrange(3)}", 1, "T", rng.random() < .5,
                        rng.choice(["HIGH", "MEDIUM"]), None))
        else:
            out.append((f"i-{h}", acct(h), "r", arn, rng.choice(["running", "running", "stopped"]), "t3", rng.choice([None, "1.2.3.4"]),
                        rng.choice([None, "prof/Role-1", "prof/Role-2-x", "prof/_ole-1", "noslash"]), f"n{h}", None))
    return out


def last_of_key(table, rows):
    """One row for each key: ties within a batch are tested elsewhere."""
    key = [DDL[table].replace(",", "").split().index(k) // 2 for k in SPECS[table].key]
    return list({tuple(r[k] for k in key): r for r in rows}.values())


def chain_counts(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1])
def test_any_batches_give_the_full_joins_and_counts(spark, seed):
    rng = random.Random(seed)
    frame = lambda t, rows: spark.createDataFrame(rows, DDL[t])
    state = {t: frame(t, last_of_key(t, random_rows(t, rng, 8))) for t in DDL}
    summary = {n: C.summarise(n, state["cves" if "cve" in n else "findings"]) for n in C.SUMMARIES}
    total = chain_counts(E.attack_chains(*(state[t] for t in ("instances", "findings", "cves", "iam_risks"))))
    seen = 0
    for step in range(2):
        some = [t for t in DDL if rng.random() < .75] or ["instances"]
        feeds = {}
        for t in some:
            batch = frame(t, last_of_key(t, random_rows(t, rng, 6)))
            feed = U.upsert_feed(state[t], batch, SPECS[t], as_of=AS_OF, seq=None)
            feeds[t] = spark.createDataFrame(feed.collect(), feed.schema)
            new = U.upsert(state[t], batch, SPECS[t], as_of=AS_OF, seq=None)
            feeds[t + "+"] = spark.createDataFrame(new.collect(), new.schema)
        old = dict(state)
        state |= {t: feeds[t + "+"] for t in some}
        signed = {t: C.signed(feeds[t], C.CHAIN_COLUMNS[t]) for t in some}
        found = C.chain_changes(old, state, signed).collect()
        seen += len(found)
        for r in found:
            total[tuple(r)[:-1]] += r.change
        total = +total
        assert total == chain_counts(E.attack_chains(*(state[t] for t in ("instances", "findings", "cves", "iam_risks"))))
        for n in C.SUMMARIES:
            t = "cves" if "cve" in n else "findings"
            if t in some:
                kept = C.maintain(n, summary[n], feeds[t])
                summary[n] = spark.createDataFrame(kept.collect(), kept.schema)
            full = getattr(G, n)(state[t])
            assert Counter(map(tuple, summary[n].select(*full.columns).collect())) == Counter(map(tuple, full.collect())), n
    assert seen > 3


def _batch_on(spark, paths, moves):
    """Instances get another name, a finding changes and, with ``moves``, an instance
    comes to another ARN with the same finding; ``paths`` escalation paths for the role that all share."""
    frame = lambda t, rows: spark.createDataFrame(rows, DDL[t])
    host = lambda h, arn, tag: (f"i-{h}", "acct", "r", arn, "running", "t3", "1.2.3.4", "prof/Role-1", tag, None)
    fails = lambda arn, sev: ("acct", arn, "c", "t", sev, "FAIL", "fix", None)
    old = {"instances": [host(h, f"arn-{h}", "n") for h in range(30)], "findings": [fails(f"arn-{h}", "LOW") for h in range(30)] + [fails("arn-x", "LOW")],
           "cves": [(f"arn-{h}", f"CVE-{k}", "p", f"i-{h}", "acct", "HIGH", Decimal(7), "2", "t", "OPEN", None) for h in range(30) for k in range(2)],
           "iam_risks": [("acct", "arn:Role-1-x", f"t-{k}", f"path {k}", 1, "T", False, "HIGH", None) for k in range(paths)]}
    new = old | {"instances": [host(0, "arn-x" if moves else "arn-0", "n"), host(1, "arn-1", "n")] + [host(h, f"arn-{h}", "new") for h in range(2, 30)],
                 "findings": [fails("arn-1", "HIGH") if r[1] == "arn-1" else r for r in old["findings"]]}
    signed = {t: frame(t, [r for r in old[t] if r not in new[t]]).withColumn(C.SIGN, F.lit(-1)).unionByName(
        frame(t, [r for r in new[t] if r not in old[t]]).withColumn(C.SIGN, F.lit(1))).select(*C.CHAIN_COLUMNS[t], C.SIGN) for t in ("instances", "findings")}
    old, new = ({t: frame(t, rows) for t, rows in side.items()} for side in (old, new))
    return C.chain_changes(old, new, signed), old, new


def test_chains_of_a_batch_are_made_once_after_every_exchange(spark):
    from tests.test_scale import _exchanged
    few, many = (_exchanged(_batch_on(spark, n, False)[0]) for n in (1, 60))
    assert many - few <= 3 * 60


def test_an_instance_that_moves_keeps_the_chains_it_has_at_both_places(spark):
    found, old, new = _batch_on(spark, 3, True)
    total = chain_counts(E.attack_chains(*(old[t] for t in ("instances", "findings", "cves", "iam_risks"))))
    rows = found.collect()
    assert len(rows) == len({tuple(r)[:-1] for r in rows}) == (28 + 1) * 2 * 2 * 3
    for r in rows:
        total[tuple(r)[:-1]] += r.change
    assert +total == chain_counts(E.attack_chains(*(new[t] for t in ("instances", "findings", "cves", "iam_risks"))))


def part_files(root):
    root = root.replace("file:", "")
    return {os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root + "/data") for f in fs if f.endswith(".parquet")}


def findings(spark, accounts, per_account, severity="LOW"):
    rows = [(f"acct-{a:02d}", f"arn:{a:02d}:{k:04d}", "c", "t", severity, "FAIL", "fix", None) for a in accounts for k in range(per_account)]
    return spark.createDataFrame(rows, DDL["findings"])


def test_a_batch_rewrites_its_parts_alone(spark):
    root = scratch_path(spark, "parts")
    spec = SCH.FINDINGS_SPEC
    parts.create(findings(spark, range(10), 100), root, spec, part_rows=50)
    held = part_files(root)
    assert len({f.split("/")[2] for f in held}) == 20
    batch = findings(spark, [4], 100, "HIGH").unionByName(findings(spark, [4], 103, "HIGH").where("resource_arn > 'arn:04:0099'"))
    v = parts.upsert(spark, root, batch, spec, as_of=AS_OF, batch_id=7, part_rows=50)
    written = part_files(root) - held
    before = {p["part"]: p["low"] for p in parts._list(spark, root, 0)[2]}
    ranges = sorted(before.values(), key=tuple)
    touched = {int(f.split("part=")[1].split("/")[0]) for f in written}
    assert len(touched) <= 4 and all(before[p][0] in ("acct-03", "acct-04") for p in touched) and len(ranges) == 20
    now = parts.read(spark, root)
    assert now.count() == 1003 and now.where("severity = 'HIGH'").count() == 103
    assert parts.read(spark, root, 0).where("severity = 'HIGH'").count() == 0            # the version before is still there
    feed = parts.changes(spark, root, v)
    assert feed.count() == 103 and feed.where("old is null").count() == 3
    assert parts.upsert(spark, root, batch, spec, as_of=AS_OF, batch_id=7, part_rows=50) == v and len(part_files(root)) == len(held | written)
    # a write that fails after its data leaves the table as it was; the next one goes on
    commit, parts._commit = parts._commit, lambda *a: 1 / 0
    try:
        with pytest.raises(ZeroDivisionError):
            parts.upsert(spark, root, findings(spark, [5], 100, "CRITICAL"), spec, as_of=AS_OF, batch_id=8, part_rows=50)
    finally:
        parts._commit = commit
    assert parts.read(spark, root).where("severity = 'CRITICAL'").count() == 0
    parts.upsert(spark, root, findings(spark, [5], 100, "CRITICAL"), spec, as_of=AS_OF, batch_id=8, part_rows=50)
    assert parts.read(spark, root).where("severity = 'CRITICAL'").count() == 100
    # an account that grows is split, in key order
    parts.upsert(spark, root, findings(spark, [9], 1000, "MEDIUM"), spec, as_of=AS_OF, batch_id=9, part_rows=50)
    lists = parts._list(spark, root)[2]
    lows = [tuple(p["low"]) for p in lists]
    assert lows == sorted(lows) and max(p["rows"] for p in lists) <= 150 and sum(p["rows"] for p in lists) == 1903
    whole = U.upsert(parts.read(spark, root, 0), batch, spec, as_of=AS_OF, seq=None)
    assert whole.count() == 1003
    assert parts.vacuum(spark, root, keep=1)
    assert parts.read(spark, root).count() == 1903


def test_null_keys_and_empty_batches(spark):
    root = scratch_path(spark, "parts-null")
    spec = SCH.FINDINGS_SPEC
    rng = random.Random(4)
    rows = last_of_key("findings", random_rows("findings", rng, 30))
    table = spark.createDataFrame(rows, DDL["findings"])
    parts.create(table.limit(0), root, spec, part_rows=4)
    want = table.limit(0)
    for step in range(4):
        batch = spark.createDataFrame(last_of_key("findings", random_rows("findings", rng, 12 if step != 2 else 1)), DDL["findings"]).limit(0 if step == 2 else 99)
        want = U.upsert(want, batch, spec, as_of=AS_OF, seq=None)
        parts.upsert(spark, root, batch, spec, as_of=AS_OF, seq=None, part_rows=4)
        assert Counter(map(tuple, parts.read(spark, root).collect())) == Counter(map(tuple, want.collect()))


def test_a_batch_over_several_tables_is_one_commit(spark):
    root = scratch_path(spark, "set")
    rng = random.Random(11)
    give = {t: last_of_key(t, random_rows(t, rng, 30)) for t in DDL}
    batches = lambda rows: {t: (lambda t=t: spark.createDataFrame(rows[t], DDL[t])) for t in rows}
    table_set.commit(spark, root, 0, batches(give), SPECS, as_of=AS_OF, part_rows=5)
    first = table_set.versions(spark, root)
    whole = lambda: chain_counts(E.attack_chains(*(table_set.read(spark, root, t) for t in ("instances", "findings", "cves", "iam_risks"))))
    state = whole()
    assert state == chain_counts(C.added_chains(table_set.chains_of_batch(spark, root))) and sum(state.values()) > 0

    def dies():
        raise RuntimeError("lost")
    more = {t: last_of_key(t, random_rows(t, rng, 8)) for t in DDL}
    with pytest.raises(RuntimeError):  # between two tables
        table_set.commit(spark, root, 1, batches({k: more[k] for k in ("findings", "cves")}) | {"iam_risks": dies}, SPECS, as_of=AS_OF, on_error="raise")
    assert table_set.versions(spark, root) == first and whole() == state      # readers see the night before, whole
    assert table_set.sync_log(spark, root).count() == 4
    v = table_set.commit(spark, root, 1, batches(more), SPECS, as_of=AS_OF)
    assert table_set.commit(spark, root, 1, batches(more), SPECS, as_of=AS_OF) == v and table_set.sync_log(spark, root).count() == 8
    changes = table_set.chains_of_batch(spark, root).collect()
    for r in changes:
        state[tuple(r)[:-1]] += r.change
    assert +state == whole()
    # a failed step is logged and keeps its table; the others go on
    table_set.commit(spark, root, 2, {"cves": dies} | batches({"findings": give["findings"]}), SPECS, as_of=AS_OF)
    log = {(r.table_name, r.status) for r in table_set.sync_log(spark, root).collect()}
    assert ("cves", "error") in log and table_set.versions(spark, root)["cves"] == table_set.versions(spark, root, v)["cves"]
    alerts = H.alert_chains(C.added_chains(table_set.chains_of_batch(spark, root)))
    assert alerts.columns == H.CHAIN_LIST_COLS


def test_a_narrowed_feed_keeps_summaries_up_to_date(spark):
    row = lambda who, severity, status: (who, severity, status, "wide " * 10)
    schema = ", ".join(f"{side} struct<account_id string, severity string, status string, description string>" for side in ("old", "new"))
    feed = spark.createDataFrame([(None, row("A", "HIGH", "FAIL")), (row("A", "LOW", "FAIL"), row("A", "LOW", "PASS")), (row("B", "LOW", "FAIL"), row("B", None, "FAIL"))], schema)
    held = spark.createDataFrame([row("A", "LOW", "FAIL"), row("B", "LOW", "FAIL")], "account_id string, severity string, status string, description string")
    columns = list(C.SUMMARIES["severity_summary"].columns)
    slim = C.narrowed(feed, columns)
    assert slim.schema["new"].dataType.names == columns and slim.where("old IS NULL").count() == 1
    for name in ("severity_summary", "severity_totals", "severity_breakdown"):
        whole, narrow = (C.maintain(name, C.summarise(name, h), f).collect() for h, f in ((held, feed), (held.select(*columns), slim)))
        assert sorted(map(str, whole)) == sorted(map(str, narrow)) != []


def test_a_commit_takes_the_order_of_a_table_and_leaves_no_shuffle_files(spark):
    root = scratch_path(spark, "ordered-set")
    one = random_rows("cves", random.Random(3), 1)[0]
    names = [c.split(" ")[0] for c in DDL["cves"].split(", ")]
    rows = [tuple({"resource_arn": "arn", "cve_id": "CVE", "package_name": "p", "title": t, "severity": s}.get(n, v) for n, v in zip(names, one))
            for t, s in (("1", "HIGH"), ("3", "LOW"), ("2", "CRITICAL"))]
    held = lambda: spark._jsparkSession.sparkContext().env().mapOutputTracker().shuffleStatuses().size()
    before = held()
    table_set.commit(spark, root, 0, {"cves": lambda: spark.createDataFrame(rows, DDL["cves"])}, SPECS, as_of=AS_OF, on_error="raise", order={"cves": ["title"]})
    assert [(r.title, r.severity) for r in table_set.read(spark, root, "cves").collect()] == [("3", "LOW")]
    assert held() - before <= 4  # of what is counted; those of the written steps are gone
