"""Secret scans with multipart credential linking.

A task finds the parts of credentials in each whole text: strong ones, which
are always reported (``assign``: a value given to a password, secret, token or
key; ``access``: an access key identifier; ``hex``: a long hexadecimal string),
and weak ones, which mean little alone (``key``: a mixed string of letters and
digits; ``ident``: a name given to a user, login or client; ``endpoint``: the
address of a service).  Parts then meet in an interval join: two parts of one
document are in one scope if at most REACH characters lie between them.  A
weak part is reported only if its scope holds what it lacks: a secret needs an
identifier or an endpoint, an identifier a secret, an endpoint both.

The join is an equi-join on (document, bin of REACH characters): a part asks
in the bin of its end and the next one for parts that start there, so a text of
any length is many small groups, and a group holds at most the parts that fit
into two bins.

Defined results: null text is empty; positions count code points, ends are
exclusive; a weak part that overlaps a strong one, or a weak one of a kind
listed before (endpoint, ident, key), is none.  Repeated rows each get their
row, also with equal or null doc_id.  Very long texts are searched whole.
Parts that touch are 0 characters apart.  An empty table gives no rows.  Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import by_value, stored, text_or_empty

by_value(__name__)

#: Most characters between two parts of one scope.
REACH = 200
#: All kinds in the order in which spans at one start are listed; the first three are strong.
KINDS = ("assign", "access", "hex", "endpoint", "ident", "key")
STRONG = 3
#: What a kind can be in a credential.
SECRETS, IDENTIFIERS, ENDPOINTS = (0, 2, 5), (1, 4), (3,)

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
ENDPOINT = r"""(?:https?|ftp|s3|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]+"""
IDENT = r"""(?:user_?name|user_?id|user|login|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}"""
#: Strings of letters and digits; a weak key holds a capital, a small letter and a digit.
KEY = r"[A-Za-z0-9+/_=-]{20,}"

_ASSIGN = re.compile(ASSIGN, re.I | re.A)
_ACCESS, _HEX = re.compile(ACCESS), re.compile(f"[0-9a-f]{{{HEX_LENGTH},}}")  # runs are whole either way
_ENDPOINT, _IDENT, _KEY = re.compile(ENDPOINT), re.compile(IDENT, re.I | re.A), re.compile(KEY)
#: A text without any of these (small letters) holds no assignment, or no identifier.
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_IDENT_WORDS = ("user", "login", "client", "access")


def _overlaps(start: int, end: int, taken: list[tuple[int, int]]) -> bool:
    return any(s < end and start < e for s, e in taken)


def strong_parts(text: str, low: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strong parts; ``low`` is the text in small letters."""
    out = []
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(0, *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [(1, *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    return out + [(2, *m.span()) for m in _HEX.finditer(text)]


class Taken:
    """Intervals that are held, by bins of REACH characters."""

    def __init__(self):
        self.bins: dict[int, list[tuple[int, int]]] = {}

    def add(self, start: int, end: int) -> None:
        for b in range(start // REACH, (end - 1) // REACH + 1):
            self.bins.setdefault(b, []).append((start, end))

    def meets(self, start: int, end: int) -> bool:
        return any(_overlaps(start, end, self.bins.get(b, ())) for b in range(start // REACH, (end - 1) // REACH + 1))


def parts_of(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all parts of a text, strong ones first.  Weak keys
    are looked for only where an identifier or an endpoint could report them."""
    low = text.lower()
    strong = strong_parts(text, low)
    weak, taken = [], Taken()
    for _, start, end in strong:
        taken.add(start, end)
    looks = [(3, _ENDPOINT, "://" in text), (4, _IDENT, any(w in low for w in _IDENT_WORDS))]
    for kind, pattern, likely in looks:
        found = [m.span() for m in pattern.finditer(text)] if likely else []
        found = [x for x in found if not taken.meets(*x)]
        for x in found:
            taken.add(*x)
        weak += [(kind, *x) for x in found]
    if weak or any(k in IDENTIFIERS for k, _, _ in strong):
        for m in _KEY.finditer(text):
            s = m[0]
            if s != s.lower() and s != s.upper() and any(c.isdigit() for c in s) and not taken.meets(*m.span()):
                weak.append((5, *m.span()))
    return strong + weak


PARTS = "array<struct<kind: int, start: long, end: long>>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, row (a number of its own), parts of each document; stored, as row
    numbers hold for one run only."""
    part = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            found = [[dict(zip(("kind", "start", "end"), p)) for p in parts_of(t.as_py())] for t in b.column(1)]
            rows = pa.array(range(row, row + b.num_rows), pa.int64())
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), rows, pa.array(found, part)], names=["doc_id", "row", "parts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, row long, parts {PARTS}"), "secret-parts")


def _is(kind: Column, kinds: tuple[int, ...]) -> Column:
    return kind.isin(*kinds)


def linked_parts(scanned: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, kind, start, end) of the weak parts whose scope holds what they lack."""
    one = scanned.where(F.exists("parts", lambda p: p.kind >= STRONG)).select("row", F.inline("parts"))
    bin_of = lambda c: F.floor(F.col(c) / reach)
    first = one.select("row", *[F.col(c).alias(f"a_{c}") for c in ("kind", "start", "end")],
                       F.explode(F.array(bin_of("end"), bin_of("end") + 1)).alias("bin"))
    second = one.select("row", *[F.col(c).alias(f"b_{c}") for c in ("kind", "start", "end")], bin_of("start").alias("bin"))
    gap = F.col("b_start") - F.col("a_end")
    role = lambda c: F.when(_is(F.col(c), SECRETS), 0).when(_is(F.col(c), IDENTIFIERS), 1).otherwise(2)
    met = first.join(second, ["row", "bin"]).where(
        (gap >= 0) & (gap <= reach) & (role("a_kind") != role("b_kind")) & ((F.col("a_kind") >= STRONG) | (F.col("b_kind") >= STRONG)))
    side = lambda x, y: met.where(F.col(f"{x}_kind") >= STRONG).select(
        "row", *[F.col(f"{x}_{c}").alias(c) for c in ("kind", "start", "end")], role(f"{y}_kind").alias("other"))
    near = side("a", "b").unionByName(side("b", "a")).groupBy("row", "kind", "start", "end").agg(
        F.bool_or(F.col("other") == 0).alias("secret"), F.bool_or(F.col("other") == 1).alias("identifier"),
        F.bool_or(F.col("other") == 2).alias("endpoint"))
    enough = (F.when(_is(F.col("kind"), SECRETS), F.col("identifier") | F.col("endpoint"))
              .when(_is(F.col("kind"), IDENTIFIERS), F.col("secret")).otherwise(F.col("secret") & F.col("identifier")))
    return near.where(enough).select("row", "kind", "start", "end")


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, strong and spans of each document: arrays of (start, kind, end) by
    start, then kind as listed; spans holds the strong parts and the weak ones
    that are linked."""
    scanned = scan(docs)
    span = lambda p: F.struct(p.start.alias("start"), p.kind.alias("kind"), p.end.alias("end"))
    linked = linked_parts(scanned, reach).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    strong = F.array_sort(F.transform(F.filter("parts", lambda p: p.kind < STRONG), span))
    out = scanned.join(linked, "row", "left").withColumn("strong", strong)
    return out.select("doc_id", "strong", F.when(F.col("linked").isNull(), F.col("strong")).otherwise(
        F.array_sort(F.concat("strong", "linked"))).alias("spans"))


def spans_text(spans: Column | str) -> Column:
    """kind:start:end of each span, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", F.get(name, p.kind), p.start.cast("string"), p.end.cast("string"))), ",")


def secret_report(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    count = lambda k: F.size(F.filter("strong", lambda p: p.kind == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(STRONG)],
                        F.sha2(spans_text("strong"), 256).alias("base_sha256"), spans_text("spans").alias("spans"),
                        (F.size("spans") - F.size("strong")).cast("long").alias("n_linked"))
