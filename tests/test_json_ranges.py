"""Files read by byte ranges against the whole-file reader."""

import json
import os
import random

import pytest

from chainlens.session import scratch_path
from chainlens.sources import files
from chainlens.sources import json_ranges as J


def by_ranges(text, cuts):
    """The reader's steps on one text cut into ranges after some of its braces."""
    pieces = text.split(J.CUT)
    rows = [p + J.CUT for p in pieces[:-1]] + ([pieces[-1]] if pieces[-1] else [])
    bounds = [0, *sorted({c % (len(rows) + 1) for c in cuts}), len(rows)]
    ranges = [rows[a:b] for a, b in zip(bounds, bounds[1:]) if a < b]
    at = (J.OUTSIDE, 0, "")
    value = element = 0
    texts, closed = {}, set()
    for some in ranges:
        v0, e0, last = value, element, None
        for v, e, raw, _, ends in J.fragments(iter(some), at):
            key = (v0 + v, (e0 if v == 0 else 0) + e)
            texts[key] = texts.get(key, "") + raw
            if ends:
                closed.add(key)
                last = (*key, raw[-1])
        if last:
            value, element = (last[0] + 1, 0) if last[2] in "]}" else (last[0], last[1] + 1)
        at = J.then(at, J.range_function(some))
    judged = {k: J.judged_at(*k, t, k in closed) for k, t in texts.items()}
    broken = [k[0] for k, (_, bad) in judged.items() if bad == 1 or bad == 2 and k[1] > 1]
    stop = min(broken + ([value] if at[:2] != (J.OUTSIDE, 0) else []), default=None)
    return [d for k, (d, _) in sorted(judged.items()) if d is not None and (stop is None or k[0] < stop)]


DOCS = ['{"a": 1}', '{"a": 1, "b": [2, 3], "c": {"d": 4, "e": ","}}', '{"t": "}{][,\\"\\\\"}', '{"n": {"m": [1, {"x": "}"}]}}', '{}', '{"u": "é\\u00e9\\\\"}', '{"q": "\\\\\\""}']
SAMPLES = [
    "", "  \n", "[]", "[ ]", "[" + ",".join(DOCS) + "]", "[" + ", \n".join(DOCS) + "]\n[" + DOCS[0] + "]", DOCS[0] + DOCS[1], DOCS[0] + " , " + DOCS[2] + "\n",
    "[1, \"}\", null, " + DOCS[1] + ", [2, {\"in\": 1}]]" + DOCS[3], "[" + DOCS[0] + ",]" + DOCS[1], "[" + DOCS[0] + "]" + "oops" + DOCS[1],
    "[" + DOCS[0] + "][" + DOCS[1] + ", {\"a\": }]" + DOCS[2], "[" + DOCS[0] + ", " + DOCS[1], DOCS[0] + '{"open": 1', "12 \"s\" true " + DOCS[0] + " null",
    "[" + DOCS[0] + "]}" + DOCS[1], "[" + DOCS[0] + " " + DOCS[1] + "]", "[,]", ", " + DOCS[0], "[" + DOCS[0] + "]]" + DOCS[1],
]


@pytest.mark.parametrize("text", SAMPLES)
def test_every_cut_gives_the_whole_file_readers_documents(text):
    want = list(files.iter_documents(text))
    n = text.count(J.CUT) + 1
    for a in range(n + 1):
        for b in range(a, n + 1):
            assert by_ranges(text, [a, b]) == want, (text, a, b)


@pytest.mark.parametrize("text", [t for t in SAMPLES if t])
def test_the_cut_mark_may_be_put_behind_a_range_function(text):
    for some in (text, text + "\\", text[1:], "\\" + text, '"' + text):
        assert J.then_cut(J.range_function([some])) == J.range_function([some + J.CUT])
        inside = J.range_function(['"' + some])[J.OUTSIDE]                              # a quote before it, and one with a backslash
        assert J.range_function([some])[J.STRING][:2] == inside[:2]
        assert J.range_function([some])[J.ESCAPE][:2] == J.range_function(['"\\' + some])[J.OUTSIDE][:2]


def test_ranges_are_cut_and_judged_once(spark):
    path = scratch_path(spark, "once")
    spark.createDataFrame([("[" + ",".join(DOCS) + "]",)], "value string").write.text(path)
    got = J.read_findings_ranges(spark, path)
    assert "MapInArrow" not in got._jdf.queryExecution().optimizedPlan().toString() and got.count() == len(DOCS)


def test_random_files_at_random_cuts():
    rng = random.Random(6)
    for _ in range(400):
        text = "".join(rng.choice(["[" + rng.choice([",", " , "]).join(rng.choice(DOCS) for _ in range(rng.randrange(4))) + "]", rng.choice(DOCS), " ", "\n", "7 "])
                       for _ in range(rng.randrange(7)))
        if rng.random() < .4 and text:  # damage it
            k = rng.randrange(len(text))
            text = text[:k] + rng.choice(['"', "}", "]", ",", "x", "{", "\\"]) + text[k + 1:]
        assert by_ranges(text, [rng.randrange(20) for _ in range(4)]) == list(files.iter_documents(text)), text


def test_one_file_over_several_tasks(spark):
    folder = scratch_path(spark, "ranges").replace("file:", "")
    os.makedirs(folder)
    many = [json.dumps({"k": i, "t": "x}{\"" * (i % 7)}) for i in range(3000)]
    texts = {"a.json": "[" + ",".join(many[:2000]) + "]" + "[" + ", ".join(many[2000:]) + "]", "b.json": many[0] + "\n" + many[1], "c.json": SAMPLES[11],
             "d.json": json.dumps([{"long": "y" * 50000, "in": [{"z": 1}] * 100}, {"after": 1}]) + "\n", "e.json": ""}
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w") as fh:
            fh.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = J.read_findings_ranges(spark, folder)
        assert spark.read.text(folder, lineSep=J.CUT).rdd.getNumPartitions() > 5
        ranged = [(r.file, r.raw) for r in got.orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = [(r.file, r.raw) for r in files.read_findings_files(spark, folder).orderBy("seq").collect()]
    assert ranged == whole and len(whole) == 3000 + 2 + 1 + 2
