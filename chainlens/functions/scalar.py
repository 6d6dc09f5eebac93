"""Scalar column builders.

Everything here returns a ``Column`` built from built-in expressions so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The severity ladder in rank order (J-1), and the points each
# level adds to the attack-chain score (J-2).  Must equal the reference.
SEVERITY_LEVELS = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "INFORMATIONAL")
SEVERITY_POINTS = {"CRITICAL": 3, "HIGH": 2, "MEDIUM": 1}
PUBLIC_IP_POINTS = 2


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sev_rank(col, levels: int = 5, else_: int | None = None) -> Column:
    """Simple CASE rank: CRITICAL 1, HIGH 2, ... for the first ``levels`` names,
    everything else (including NULL) gets ``else_`` (default levels + 1).

    The views differ in how many levels they name and in the ELSE value, e.g.
    open failures name 5 levels with ELSE 6, the public-instance view names 3
    with ELSE 4 (so LOW ties INFORMATIONAL).
    """
    c = _c(col)
    if else_ is None:
        else_ = levels + 1
    expr = None
    for i, name in enumerate(SEVERITY_LEVELS[:levels], start=1):
        expr = F.when(c == name, F.lit(i)) if expr is None else expr.when(c == name, F.lit(i))
    return expr.otherwise(F.lit(else_))


def severity_points(col) -> Column:
    """CASE sev WHEN CRITICAL 3 WHEN HIGH 2 WHEN MEDIUM 1 ELSE 0 (NULL -> 0)."""
    c = _c(col)
    expr = None
    for name, pts in SEVERITY_POINTS.items():
        expr = F.when(c == name, F.lit(pts)) if expr is None else expr.when(c == name, F.lit(pts))
    return expr.otherwise(F.lit(0))


def risk_score(cvss, misconfig_sev, iam_sev, public_ip) -> Column:
    """J-2: ROUND(cvss*1.0 + misconfig pts + iam pts + 2 if public, 1).

    Decimal arithmetic end to end (cvss is DECIMAL(4,1)), so the rounding is
    HALF_UP on exact values as in the reference; NULL cvss gives NULL.
    Returned as DOUBLE for consumers.
    """
    total = (
        _c(cvss).cast("decimal(4,1)") * F.lit(1.0).cast("decimal(2,1)")
        + severity_points(misconfig_sev)
        + severity_points(iam_sev)
        + F.when(_c(public_ip).isNotNull(), F.lit(PUBLIC_IP_POINTS)).otherwise(F.lit(0))
    )
    return F.round(total, 1).cast("double")


def nonblank(col) -> Column:
    """Python truthiness for a string: NULL and '' are both false -> NULL."""
    c = _c(col)
    return F.when(c != "", c)


def or_chain(*cols, default: str | None = "") -> Column:
    """``a or b or default`` over strings (J-11): the first non-empty value."""
    parts = [nonblank(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def json_or(raw, *paths: str, default: str | None = "") -> Column:
    """Or-chain over JSON paths of a JSON text column (case-sensitive keys)."""
    r = _c(raw)
    return or_chain(*[F.get_json_object(r, p) for p in paths], default=default)


def profile_role(profile) -> Column:
    """J-3: split_part(profile, '/', 2): '' if there is no '/', NULL if NULL."""
    return F.split_part(_c(profile), F.lit("/"), F.lit(2))


def report_role_name(profile) -> Column:
    """Report flavour: last '/' segment, or the text 'None' when absent/empty."""
    p = _c(profile)
    return F.when(nonblank(p).isNull(), F.lit("None")).otherwise(F.substring_index(p, "/", -1))


def arn_last_segment(arn, sep: str = ":", default: str | None = "unknown") -> Column:
    """J-5: last segment by ``sep``; ``default`` when the arn is NULL or ''."""
    a = _c(arn)
    seg = F.substring_index(a, sep, -1)
    if default is None:
        return seg
    return F.when(nonblank(a).isNull(), F.lit(default)).otherwise(seg)


def like_substring(text, pattern) -> Column:
    """``text LIKE '%' || pattern || '%'`` with a column pattern (D-11)."""
    return _like(_c(text), _c(pattern))


def _like(text: Column, pattern: Column) -> Column:
    return F.like(text, F.concat(F.lit("%"), pattern, F.lit("%")))


def substring_match(text, pattern) -> Column:
    """Same truth value as ``text LIKE '%'||pattern||'%'`` (R-5 fast path).

    A pattern without LIKE wildcards is a plain substring test, which skips
    building a matcher per row; ``_`` / ``%`` fall back to LIKE.  (IAM role
    names cannot hold a backslash; one is matched literally here, where
    Spark's LIKE would reject it as a dangling escape.)
    """
    t, p = _c(text), _c(pattern)
    return F.when(p.rlike(r"[_%]"), _like(t, p)).otherwise(t.contains(p))


def fmt_minute_utc(ts) -> Column:
    """J-15: '%Y-%m-%d %H:%M UTC'."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm 'UTC'")


def fmt_minute(ts) -> Column:
    """'%Y-%m-%d %H:%M' (critical findings list)."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm")
