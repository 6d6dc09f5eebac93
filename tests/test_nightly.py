"""All scanners through one stream: the same chains as from the normalisers, nights as units."""

import json
import os
from collections import Counter

from chainlens.operators import changes as C
from chainlens.operators import correlate as E
from chainlens.operators import ranking as H
from chainlens.session import scratch_path
from chainlens.sources import table_set
from chainlens.streaming import nightly
from tests import samples as S

AS_OF = "2021-01-01 00:00:00"
CHAIN_TABLES = ("instances", "findings", "cves", "iam_risks")


def put(folder, name, value):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(value if isinstance(value, str) else json.dumps(value))


def test_nights_of_all_scanners(spark):
    landing, root, ckpt = (scratch_path(spark, x).replace("file:", "") for x in ("landing", "nights", "ckpt"))
    at = f"account_id={S.ACCOUNT}/region={S.REGION}"
    put(landing, "findings/scan.json", json.dumps(S.FINDINGS[:3]) + json.dumps(S.FINDINGS[3:]))
    put(landing, f"cves/{at}/{S.CVE_INSTANCE}.json", S.CVE_REPORT)
    put(landing, f"iam/{at}/paths.json", S.IAM_PATHS)
    put(landing, "inventory/bundle.json", {k: S.INVENTORY[k] for k in ("instances", "vpcs")} | {"iam": []})
    nightly.start_ingest(spark, landing, root, ckpt, as_of=AS_OF).awaitTermination()
    tables = lambda: [table_set.read(spark, root, t) for t in CHAIN_TABLES]
    first = sorted(map(str, E.attack_chains(*tables()).collect()))
    log = {r.table_name: (r.rows_synced, r.status, r.error_msg) for r in table_set.sync_log(spark, root).collect()}
    assert {t: x[0] for t, x in log.items()} == {"findings": 8, "cves": 3, "iam_risks": 3, "instances": 3, "vpcs": 1}, log
    assert first and sorted(map(str, C.added_chains(table_set.chains_of_batch(spark, root)).collect())) == first
    # the next night: a finding is mended, a CVE report cannot be read
    mended = dict(S.FINDINGS[0], status="PASS")
    put(landing, "findings/scan-2.json", [mended])
    put(landing, f"cves/{at}/{S.HOST_B}.json", '{"Results": [')
    nightly.start_ingest(spark, landing, root, ckpt, as_of=AS_OF).awaitTermination()
    now = sorted(map(str, E.attack_chains(*tables()).collect()))
    changed = table_set.chains_of_batch(spark, root).collect()
    assert changed and all(r.change < 0 and r.misconfiguration == "Metadata service open" for r in changed)
    assert len(now) == len(first) + sum(r.change for r in changed)
    steps = Counter((r.table_name, r.status) for r in table_set.sync_log(spark, root).collect())
    assert steps["cves", "error"] == 1 and steps["findings", "success"] == 2 and sum(steps.values()) == 7
    assert H.alert_chains(C.added_chains(table_set.chains_of_batch(spark, root))).count() == 0     # nothing new to send
    # nothing landed: no record
    n = len(table_set.records(spark, root))
    nightly.start_ingest(spark, landing, root, ckpt, as_of=AS_OF).awaitTermination()
    assert len(table_set.records(spark, root)) == n == 2
