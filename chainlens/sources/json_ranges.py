"""Scanner files of any size, read by byte ranges (A-1, A-2).

A scanner file holds JSON arrays and objects back to back, often on one line, so
neither lines nor a JSON reader split it.  Here Spark's text source cuts files into
its byte ranges at closing braces, wherever they stand, and an automaton finds out
what a range is part of:

1. Every range gives a function: for each lexical state it may begin in (outside
   of strings, inside, inside after a backslash) the state it ends in, the change of
   nesting depth, and the last bracket it opened at each depth down to the least it
   came to.  One small row a range.
2. The rows are composed in file order: the state, depth and top-level bracket each
   range begins in.
3. Every range cuts its text into elements, which are members of top-level
   arrays, top-level objects and scalars, and emits them; an element that goes on
   in the next range is put together from its fragments.
4. An element that is no JSON makes its top-level value broken.  As for the
   whole-file reader the first broken value ends its file; what came before counts.

Nothing but the rows of step 1, one for each range, passes through the driver, and
no task holds more than a range and an element.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator, Sequence
from itertools import groupby, pairwise

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CUT = "}"
OUTSIDE, STRING, ESCAPE = 0, 1, 2
_STRING_END = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*("|\\?$)', re.S)
_MARKS = re.compile(r'["{}\[\],]')
#: Up to the next bracket, over whole strings; stops at a string that the text does not end.
_TO_BRACKET = re.compile(r'(?:[^"{}\[\]]++|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+', re.S)
_BETWEEN = re.compile(r"[\s,]*")
ROWS = 2000


def skip_string(text: str, at: int, escaped: bool) -> tuple[int, int]:
    """From inside a string: (place after it, OUTSIDE), or the end and the state there."""
    if escaped:
        if at >= len(text):
            return at, ESCAPE
        at += 1
    m = _STRING_END.match(text, at)
    end = m.group(1)
    return m.end(), OUTSIDE if end == '"' else ESCAPE if end else STRING


def range_function(pieces: list[str]) -> list[tuple[int, int, dict[int, str]]]:
    """For each state a range may begin in: (end state, change of depth, the last
    bracket opened at each depth, from the range's begin, of 0 or less)."""
    out = []
    first = next((text[0] for text in pieces if text), None)
    for state in (OUTSIDE, STRING, ESCAPE):
        if state == ESCAPE and first not in (None, '"', "\\"):  # any other first character is the same after a backslash
            out.append(out[STRING])
            continue
        depth, opened = 0, {}
        for text in pieces:
            at = 0
            while True:
                if state != OUTSIDE:
                    at, state = skip_string(text, at, state == ESCAPE)
                    if state != OUTSIDE:
                        break
                at = _TO_BRACKET.match(text, at).end()
                if at == len(text):
                    break
                c, at = text[at], at + 1
                if c == '"':
                    state = STRING
                elif c in "{[":
                    if depth <= 0:
                        opened[depth] = c
                    depth += 1
                else:
                    depth -= 1
        out.append((state, depth, opened))
    return out


def then_cut(function: list[tuple[int, int, dict[int, str]]]) -> list[tuple[int, int, dict[int, str]]]:
    """``range_function`` of the same pieces with the cut mark after them."""
    return [(OUTSIDE, depth - 1, opened) if state == OUTSIDE else (STRING, depth, opened) for state, depth, opened in function]


def then(begin: tuple[int, int, str], function: list) -> tuple[int, int, str]:
    """(state, depth, top-level bracket) after a range that begins so."""
    state, depth, top = begin
    state, change, opened = function[state]
    return state, depth + change, opened.get(-depth, opened.get(str(-depth), top))


def fragments(pieces: Iterator[str], begin: tuple[int, int, str]) -> Iterator[tuple[int, int, str, bool, bool]]:
    """Cut a range into elements: (values ended before, elements ended before in this
    value, text, begins here, ends here).  Counts are from the range's start.  A
    top-level array's brackets and commas end elements, and so does the brace that
    closes a top-level object; what stands before a value is part of its first."""
    state, depth, top = begin
    value = element = 0
    buffer, begins = [], False
    for text in pieces:
        at = start = 0
        while True:
            if state != OUTSIDE:
                at, state = skip_string(text, at, state == ESCAPE)
                if state != OUTSIDE:
                    break
            if depth != 1 or top != "[":  # commas separate members of top-level arrays alone
                at = _TO_BRACKET.match(text, at).end()
            m = _MARKS.search(text, at)
            if m is None:
                break
            c, at = m.group(), m.end()
            if c == '"':
                state = STRING
                continue
            before = depth
            depth += (c in "{[") - (c in "}]")
            if before == 0 and c in "{[":
                top = c
            if c == "," and before == 1 and top == "[" or c == "[" and before == 0 or c in "]}" and before == 1:
                buffer.append(text[start:at])
                yield value, element, "".join(buffer), begins, True
                buffer, start, begins = [], at, True
                element += 1
                if c in "]}":
                    value, element = value + 1, 0
        buffer.append(text[start:])
    if any(buffer):
        yield value, element, "".join(buffer), begins, False


def judge(text: str) -> tuple[str | None, int]:
    """Of an element's whole text, closing mark included: (document or None, 1 if it
    is no JSON).  The mark tells what it was: ``[`` ends what stands before an array,
    a comma or a bracket ends a member, a brace a top-level object or member."""
    mark, body = text[-1:], text[:-1]
    if mark == "[":
        return None, between(body)
    if mark in ",]":
        try:
            value = json.loads(body)
        except ValueError:
            return None, 2 if mark == "]" and not body.strip() else 1  # 2: fine as the only member
        return (json.dumps(value) if isinstance(value, dict) else None), 0
    values, bad = top_level(text)
    return (json.dumps(values[-1]) if values and isinstance(values[-1], dict) and not bad else None), bad


def judged_at(value: int, element: int, text: str, closed: bool) -> tuple[str | None, int]:
    """``judge`` of an element at its place; one that the file's end cut off holds no
    document.  No comma may come before a file's first value."""
    if value == element == 0 and text.lstrip().startswith(","):
        return None, 1
    return judge(text) if closed else (None, between(text))


def top_level(text: str) -> tuple[list, int]:
    """The JSON values of a text, between white space and commas, and 1 if anything else is there."""
    read, at, out = json.JSONDecoder().raw_decode, 0, []
    while (at := _BETWEEN.match(text, at).end()) < len(text):
        try:
            value, at = read(text, at)
        except ValueError:
            return out, 1
        out.append(value)
    return out, 0


def between(text: str) -> int:
    """1 if a text between or after top-level values is no JSON."""
    return top_level(text)[1]


def _pieces(rows, last_cut: bool):
    """The texts of a range's rows with the cut mark put back."""
    before = None
    for r in rows:
        if before is not None:
            yield before + CUT
        before = r
    if before is not None:
        yield before + (CUT if last_cut else "")


def _ranges(batches: Iterator[pa.RecordBatch]):
    """((arg, path, block, size), texts) of each range, as the scan gives them; the
    rows of a batch are put together again, with the cut marks between them."""
    def rows():
        for b in batches:
            if not b.num_rows:
                continue
            changed = [pc.not_equal(c.slice(1), c.slice(0, b.num_rows - 1)) for c in b.columns[:3]]
            bounds = pc.indices_nonzero(pc.or_(pc.or_(changed[0], changed[1]), changed[2])).to_pylist()
            texts = b.column(4).to_pylist()
            for lo, hi in pairwise([0, *(k + 1 for k in bounds), b.num_rows]):
                yield tuple(b.column(k)[lo].as_py() for k in range(4)), CUT.join(texts[lo:hi])
    for key, some in groupby(rows(), key=lambda r: r[0]):
        yield key, (r[1] for r in some)


def read_findings_ranges(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Same rows as ``files.read_findings_files``: (file, seq, raw), in any number of
    ranges (``spark.sql.files.maxPartitionBytes``).  seq orders findings as they
    stand: argument, file, value, element."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    scan = None
    for i, p in enumerate(paths):
        one = spark.read.text(p, lineSep=CUT).select(
            F.lit(i).alias("arg"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("size"), "value")
        scan = one if scan is None else scan.unionByName(one)

    def functions(batches):
        for (arg, path, block, size), texts in _ranges(batches):
            texts = list(texts)
            held = sum(len(t.encode()) + 1 for t in texts)
            open_end = range_function(list(_pieces(texts, False)))
            ends = json.dumps([then_cut(open_end), open_end])
            yield pa.RecordBatch.from_pylist([{"arg": arg, "path": path, "block": block, "size": size, "held": held, "ends": ends}], schema=pa.schema(
                [("arg", pa.int32()), ("path", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("held", pa.int64()), ("ends", pa.string())]))

    got = scan.mapInArrow(functions, "arg int, path string, block long, size long, held long, ends string").collect()  # one row a range
    begin, unfinished = {}, set()
    for (arg, path), rows in groupby(sorted(got, key=lambda r: (r.arg, r.path, r.block)), key=lambda r: (r.arg, r.path)):
        rows, at = list(rows), (OUTSIDE, 0, "")
        whole = sum(r.held for r in rows) == rows[0].size  # the file ends with the cut mark
        for n, r in enumerate(rows):
            cut = n < len(rows) - 1 or whole
            begin[arg, path, r.block] = (n, at, cut)
            at = then(at, json.loads(r.ends)[0 if cut else 1])
        if at[:2] != (OUTSIDE, 0):
            unfinished.add((arg, path))  # the file ends inside a value

    kind = "arg int, path string, range int, value int, element int, begins boolean, ends boolean, raw string"
    names = [x.split(" ")[0] for x in kind.split(", ")]

    def cut(batches):
        out = []
        for (arg, path, block, _), texts in _ranges(batches):
            n, at, last = begin[arg, path, block]
            for value, element, text, begins, ends in fragments(_pieces(texts, last), at):
                out.append((arg, path, n, value, element, begins or n == 0, ends, text))
                if len(out) == ROWS:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
            pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()))], names=names)

    parts = stored(scan.mapInArrow(cut, kind), "json-elements")  # read three times below, cut once
    # counts from the start of the file: values and elements that earlier ranges ended
    ended = parts.where("ends").groupBy("arg", "path", "range").agg(
        F.max_by(F.struct("value", "element", "raw"), F.struct("value", "element")).alias("last"))
    tallies = {(r.arg, r.path, r.range): r.last for r in ended.select("arg", "path", "range", F.struct(
        F.col("last.value").alias("value"), F.col("last.element").alias("element"),
        F.substring(F.col("last.raw"), -1, 1).alias("mark")).alias("last")).collect()}  # one row a range
    first, seen = {}, {}
    for (arg, path, _), (n, _, _) in sorted(begin.items(), key=lambda x: (x[0][0], x[0][1], x[1][0])):
        value, element = seen.get((arg, path), (0, 0))
        first[arg, path, n] = (value, element)
        last = tallies.get((arg, path, n))
        if last is not None:
            started = (value + last.value, (element if last.value == 0 else 0) + last.element)
            closed = last.mark in "]}"
            seen[arg, path] = (started[0] + 1, 0) if closed else (started[0], started[1] + 1)
    place = spark.createDataFrame([(*k, *v) for k, v in first.items()], "arg int, path string, range int, v0 int, e0 int")
    placed = parts.join(F.broadcast(place), ["arg", "path", "range"]).select(
        "arg", "path", "range", "ends", "raw", (F.col("value") + F.col("v0")).alias("value"),
        (F.col("element") + F.when(F.col("value") == 0, F.col("e0")).otherwise(0)).alias("element"), "begins")
    # fragments of an element have its (value, element); a whole one needs no exchange
    whole = placed.where("begins AND ends").select("arg", "path", "value", "element", "raw", F.lit(True).alias("closed"))
    split = placed.where("NOT (begins AND ends)").groupBy("arg", "path", "value", "element").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("range", "raw"))), lambda x: x.raw), "").alias("raw"),
        F.bool_or("ends").alias("closed"))
    every = whole.unionByName(split.select(*whole.columns))

    def judged(batches):
        for b in batches:
            rows = [judged_at(*x) for x in zip(*(b.column(k).to_pylist() for k in range(2, 6)))]
            docs, bad = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(4)), pa.array(docs, pa.string()), pa.array(bad, pa.int32())],
                                             names=["arg", "path", "value", "element", "raw", "bad"])

    tested = stored(every.mapInArrow(judged, "arg int, path string, value int, element int, raw string, bad int"), "json-judged")
    # an empty member is fine where it is the only one: a value's elements are [ and then its members
    broken = tested.where((F.col("bad") == 1) | ((F.col("bad") == 2) & (F.col("element") > 1))).select("arg", "path", "value")
    cut_off = spark.createDataFrame([(*f, seen.get(f, (0, 0))[0]) for f in sorted(unfinished)], "arg int, path string, value int")
    broken = broken.unionByName(cut_off).groupBy("arg", "path").agg(F.min("value").alias("stop"))
    kept = tested.where(F.col("raw").isNotNull()).join(broken, ["arg", "path"], "left").where(F.col("stop").isNull() | (F.col("value") < F.col("stop")))
    return kept.select(F.col("path").alias("file"), F.struct("arg", "path", "value", "element").alias("seq"), "raw")
