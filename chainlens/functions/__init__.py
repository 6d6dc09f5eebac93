from chainlens.functions.scalar import (  # noqa: F401
    SEVERITY_LEVELS,
    arn_last_segment,
    fmt_minute,
    fmt_minute_utc,
    json_or,
    like_substring,
    nonblank,
    or_chain,
    profile_role,
    report_role_name,
    risk_score,
    severity_points,
    sev_rank,
    substring_match,
)
