"""Normalisers: scanner JSON -> fixed-schema rows.

Every normaliser is a ``select`` over built-in expressions.  A JSON document
is parsed once per row into a VARIANT (``try_parse_json``) and fields are
read with ``try_variant_get``; nothing runs in Python.  The rules mirror the
scanners' ingest scripts, including their truthiness: ``a or b or ''`` takes
the first value that is not missing, null, '', 0, false, [] or {}.

A row the original code would fail on (a ``.get`` on a non-object, a missing
ARN text, ...) is flagged in ``_parsed`` by the ``*_checked`` variants and
dropped by the plain ones, so ingest statistics can count it (G-13).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlens.functions.scalar import nonblank

# Scanner enum maps, the admin keywords and the fallback texts.
SEVERITY_BY_ID = {0: "INFORMATIONAL", 1: "LOW", 2: "MEDIUM", 3: "HIGH", 4: "CRITICAL"}
STATUS_BY_ID = {1: "PASS", 2: "FAIL", 3: "MANUAL", 4: "MUTED"}
ADMIN_KEYWORDS = ("admin", "root", "superuser", "fullaccess", "poweruser")
DEFAULT_METHOD = "sts:AssumeRole"
PATH_SEP = " -> "
# how falsy JSON non-strings print once cast to text
_FALSY_TEXTS = ("0", "0.0", "-0", "-0.0", "false", "{}", "[]")


class J:
    """Field access on one VARIANT column with Python-style truthiness.

    Type probes (``schema_of_variant`` of a sub-path) are not inlined into
    every expression that needs them: each distinct path becomes one column,
    added by ``stage(df)`` in a projection of its own.  That keeps the final
    expressions small enough for whole-stage codegen and evaluates each probe
    once per row.
    """

    def __init__(self, v: Column, prefix: str = "_t"):
        self.v = v
        self.prefix = prefix
        self.paths: dict[str, str] = {}
        self.falsy_paths: dict[str, str] = {}
        self.text_paths: dict[str, str] = {}

    def sub(self, path: str) -> Column:
        return F.try_variant_get(self.v, path, "variant")

    def get(self, path: str, typ: str = "string") -> Column:
        return F.try_variant_get(self.v, path, typ)

    def typ(self, path: str) -> Column:
        """'OBJECT', 'ARRAY', 'STRING', 'BIGINT', 'DECIMAL(..)', 'DOUBLE', 'BOOLEAN',
        'VOID' (JSON null), or NULL when the path is missing."""
        if path not in self.paths:
            self.paths[path] = f"{self.prefix}{len(self.paths)}"
        return F.col(self.paths[path])

    def stage(self, df: DataFrame) -> DataFrame:
        """Add the probed type columns, then the truthiness columns, to ``df``
        (which must carry the variant column)."""
        typed = df.select("*", *[
            F.substring_index(F.schema_of_variant(self.sub(p)), "<", 1).alias(n) for p, n in self.paths.items()
        ], *[self.get(p).alias(n) for p, n in self.text_paths.items()])
        return typed.select("*", *[self._falsy_expr(p).alias(n) for p, n in self.falsy_paths.items()])

    def drop(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.paths.values())

    def missing(self, path: str) -> Column:
        return self.typ(path).isNull()

    def falsy(self, path: str) -> Column:
        """Python falsiness of the value at ``path`` (missing counts as falsy)."""
        if path not in self.falsy_paths:
            self.typ(path)
            self.falsy_paths[path] = f"{self.prefix}f{len(self.falsy_paths)}"
        return F.col(self.falsy_paths[path])

    def _falsy_expr(self, path: str) -> Column:
        t = self.typ(path)
        return (
            F.when(t.isNull() | (t == "VOID"), True)
            .when(t == "STRING", self.get(path) == "")
            .when(t == "BOOLEAN", ~self.get(path, "boolean"))
            .when(t == "ARRAY", F.size(self.get(path, "array<variant>")) == 0)
            .when(t == "OBJECT", F.schema_of_variant(self.sub(path)) == "OBJECT<>")
            .otherwise(self.get(path, "double") == 0)
        )

    def truthy_non_object(self, path: str) -> Column:
        return ~self.falsy(path) & (self.typ(path) != "OBJECT")

    def present_non_object(self, path: str) -> Column:
        return self.typ(path).isNotNull() & (self.typ(path) != "OBJECT")

    def text(self, path: str) -> Column:
        """str(value) for a truthy value, else NULL (an or-chain link).

        The text cast (staged once) is NULL for a missing key or JSON null and
        '' is tested directly.  Only a text that a falsy non-string prints as
        ('0', 'false', '{}', '[]') needs the type probe, which CASE evaluates
        for those rows alone."""
        s = self._text_col(path)
        probe = F.substring_index(F.schema_of_variant(self.sub(path)), "<", 1)
        return (F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
                .when(s.isin(*_FALSY_TEXTS), F.when(probe == "STRING", s))
                .otherwise(s))

    def or_text(self, *paths: str, default: str | None = "") -> Column:
        parts = [self.text(p) for p in paths]
        if default is not None:
            parts.append(F.lit(default))
        return F.coalesce(*parts)

    def _text_col(self, path: str) -> Column:
        """The value at ``path`` cast to text, staged once per row."""
        if path not in self.text_paths:
            self.text_paths[path] = f"{self.prefix}s{len(self.text_paths)}"
        return F.col(self.text_paths[path])

    def get_default(self, path: str, default: str) -> Column:
        """``d.get(key, default)``: default only when the key is missing (null stays NULL).

        Only rows whose text is NULL (missing key or JSON null) run the probe
        that tells the two apart."""
        s = self._text_col(path)
        return F.when(s.isNotNull(), s).when(F.schema_of_variant(self.sub(path)).isNull(), F.lit(default))


def _enum(j: J, text_path: str, id_path: str, mapping: dict, default: str) -> Column:
    """``raw.get(text) or mapping.get(raw.get(id) or 0, default)``, upper-cased."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(float(k)), F.lit(v))])
    idv = F.when(j.typ(id_path) == "STRING", F.lit(None)).otherwise(F.coalesce(j.get(id_path, "double"), F.lit(0.0)))
    by_id = F.coalesce(F.try_element_at(m, idv), F.lit(default))
    return F.upper(F.coalesce(j.text(text_path), by_id))


# -- C-1 … C-9: misconfiguration findings ---------------------------------------------

def normalize_findings_checked(raw: DataFrame, raw_col: str = "raw", severity_map: dict | None = None,
                               status_map: dict | None = None) -> DataFrame:
    """C-1: one finding object (JSON text) per row -> FINDINGS columns + ``_parsed``.

    Reads both the flat form and the nested OCSF form of the scanner output.
    Input columns other than ``raw_col`` pass through (e.g. a sequence number).
    """
    v = F.col("_v")
    j = J(v)
    rem_t = j.typ("$.remediation")
    rem_is_str = rem_t == "STRING"
    refs_t = j.typ("$.remediation.references")
    refs_truthy = ~j.falsy("$.remediation.references")

    # Conditions under which the original parser raises, so the row is skipped.
    bad = (
        v.isNull()
        | (j.typ("$") != "OBJECT")
        # resources[0].get: resources truthy but its first item is not an object
        | (~j.falsy("$.resources") & ~((j.typ("$.resources") == "ARRAY") & (j.typ("$.resources[0]") == "OBJECT")))
        | j.truthy_non_object("$.finding_info")
        # remediation.get on a list / number / boolean
        | (~j.falsy("$.remediation") & ~rem_is_str & (rem_t != "OBJECT"))
        # remediation.get("Recommendation", {}).get: only reached when desc is falsy
        | ((rem_t == "OBJECT") & j.falsy("$.remediation.desc") & j.present_non_object("$.remediation.Recommendation"))
        # refs[0] on a non-empty object, number or boolean
        | ((rem_t == "OBJECT") & refs_truthy & ~refs_t.isin("ARRAY", "STRING"))
        | j.truthy_non_object("$.cloud")
        # cloud.get("account", {}).get("name"): account present but not an object
        | (~j.falsy("$.cloud") & j.present_non_object("$.cloud.account"))
        | j.truthy_non_object("$.metadata")
        | (~j.falsy("$.metadata") & j.present_non_object("$.metadata.product"))
        | (~j.falsy("$.metadata") & j.present_non_object("$.metadata.product.feature"))
    )

    rec_text = F.when(j.typ("$.remediation.Recommendation.Text") == "VOID", F.lit("None")).otherwise(
        F.coalesce(j.get("$.remediation.Recommendation.Text"), F.lit(""))
    )
    recommendation = (
        F.when(j.falsy("$.remediation"), F.lit(""))
        .when(rem_is_str, j.get("$.remediation"))
        .otherwise(F.coalesce(j.text("$.remediation.desc"), rec_text))
    )
    first_ref = (
        F.when(refs_t == "ARRAY", F.when(j.typ("$.remediation.references[0]") == "STRING",
                                         j.get("$.remediation.references[0]")).otherwise(F.lit("")))
        .otherwise(F.substring(j.get("$.remediation.references"), 1, 1))
    )
    recommendation_url = F.when((rem_t == "OBJECT") & refs_truthy, first_ref).otherwise(F.lit(""))
    code_t = j.typ("$.remediation.code")
    code_json = F.when(code_t.isin("OBJECT", "ARRAY"), F.get_json_object(F.col(raw_col), "$.remediation.code")) \
        .otherwise(F.to_json(j.sub("$.remediation.code")))
    remediation_code = F.when((rem_t == "OBJECT") & ~j.falsy("$.remediation.code"), code_json).otherwise(F.lit(""))

    # The id maps are parameters: the original's severity ids sit one below the
    # OCSF numbering (X-4); it is kept by default.
    severity = _enum(j, "$.severity", "$.severity_id", severity_map or SEVERITY_BY_ID, "INFORMATIONAL")
    status = _enum(j, "$.status", "$.status_id", status_map or STATUS_BY_ID, "UNKNOWN")

    out = {
        "account_id": j.or_text("$.cloud.account.uid", "$.account_id"),
        "account_name": j.or_text("$.cloud.account.name"),
        "region": j.or_text("$.region", "$.resources[0].region"),
        "resource_arn": j.or_text("$.resources[0].uid", "$.resource_arn"),
        "resource_type": j.or_text("$.resources[0].type"),
        "check_id": j.or_text("$.finding_info.uid", "$.check_id"),
        "check_title": j.or_text("$.finding_info.title", "$.check_title"),
        "service": j.or_text("$.metadata.product.feature.name", "$.service_name"),
        "severity": severity,
        "status": status,
        "description": j.or_text("$.message", "$.description"),
        "risk": j.or_text("$.risk"),
        "recommendation": recommendation,
        "recommendation_url": recommendation_url,
        "remediation_code": remediation_code,
        "raw_json": F.col(raw_col),
    }
    passthrough = [c for c in raw.columns if c != raw_col]
    staged = j.stage(raw.select("*", F.try_parse_json(F.col(raw_col)).alias("_v")))
    return staged.select(*passthrough, *[c.alias(n) for n, c in out.items()], (~bad).alias("_parsed"))


def keep_parsed(checked: DataFrame) -> DataFrame:
    """Drop the rows flagged ``_parsed = false``.

    Written as an explode of a 0/1-element array rather than ``where``: the
    optimizer pushes a Filter below the projections and substitutes every
    staged column into the predicate, which would re-parse the JSON once per
    reference.  A generator is not pushed through, so each row is parsed once.
    """
    return checked.select("*", F.explode(F.when(F.col("_parsed"), F.array(F.lit(1)))).alias("_keep")) \
        .drop("_keep", "_parsed")


def normalize_findings(raw: DataFrame, raw_col: str = "raw", severity_map: dict | None = None,
                       status_map: dict | None = None) -> DataFrame:
    """C-1 with unparseable rows dropped."""
    return keep_parsed(normalize_findings_checked(raw, raw_col, severity_map, status_map))


# -- C-10: CVE reports -----------------------------------------------------------------

_RESULTS_LIST = "array<struct<Vulnerabilities: array<variant>>>"
_RESULTS_OBJ = f"struct<Results: {_RESULTS_LIST}>"


def normalize_cves(docs: DataFrame, doc_col: str = "doc", instance_col: str = "instance_id",
                   account_col: str = "account_id", region_col: str = "region") -> DataFrame:
    """C-10: one CVE report per row -> one row per vulnerability.

    The report is ``{"Results": [...]}`` or a bare list of results; each result
    holds ``Vulnerabilities`` (null = none).  Account and region are columns of
    the input (the scan's context), so one job handles many accounts.
    Output keeps input order columns ``_result`` / ``_vuln`` (positions).
    """
    # One typed parse per report: the two shapes differ only at the root, and
    # each vulnerability stays a VARIANT for the field rules below.
    results = F.when(F.ltrim(F.col(doc_col)).startswith("["), F.from_json(F.col(doc_col), _RESULTS_LIST)) \
        .otherwise(F.from_json(F.col(doc_col), _RESULTS_OBJ).getField("Results"))
    passthrough = [c for c in docs.columns if c != doc_col]
    r = docs.select(*passthrough, F.posexplode(F.coalesce(results, F.array().cast(_RESULTS_LIST)))
                    .alias("_result", "_r"))
    vulns = F.col("_r").getField("Vulnerabilities")
    x = r.select(*passthrough, "_result",
                 F.posexplode(F.coalesce(vulns, F.array().cast("array<variant>"))).alias("_vuln", "_v"))
    v = J(F.col("_v"))
    nvd = v.get("$.CVSS.nvd.V3Score", "decimal(4,1)")
    redhat = v.get("$.CVSS.redhat.V3Score", "decimal(4,1)")
    iid, acct, reg = F.col(instance_col), F.col(account_col), F.col(region_col)
    cols = [
        F.concat(F.lit("arn:aws:ec2:"), reg, F.lit(":"), acct, F.lit(":instance/"), iid).alias("resource_arn"),
        iid.alias("instance_id"), acct.alias("account_id"), reg.alias("region"),
        v.get_default("$.VulnerabilityID", "").alias("cve_id"),
        F.upper(F.coalesce(v.get("$.Severity"), F.lit("UNKNOWN"))).alias("severity"),
        F.coalesce(F.nullif(nvd, F.lit(0).cast("decimal(4,1)")), F.nullif(redhat, F.lit(0).cast("decimal(4,1)")))
        .alias("cvss_score"),
        v.get_default("$.PkgName", "").alias("package_name"),
        v.get_default("$.InstalledVersion", "").alias("installed_version"),
        v.get_default("$.FixedVersion", "").alias("fixed_version"),
        v.get_default("$.Title", "").alias("title"),
        F.substring(F.coalesce(v.text("$.Description"), F.lit("")), 1, 1000).alias("description"),
        v.get_default("$.PrimaryURL", "").alias("primary_url"),
        F.lit("OPEN").alias("status"),
        F.to_json(F.col("_v")).alias("raw_json"),
    ]
    return v.stage(x).select(
        *[c for c in passthrough if c not in (instance_col, account_col, region_col)], "_result", "_vuln", *cols)


def instance_id_from_file(file_name: Column) -> Column:
    """A-4: the instance id is the report's file stem up to its first '.'."""
    return F.substring_index(F.substring_index(file_name, "/", -1), ".", 1)


# -- C-11: IAM escalation paths --------------------------------------------------------

def _last_part(arn: Column) -> Column:
    return F.when(nonblank(arn).isNotNull(), F.substring_index(arn, "/", -1)).otherwise(F.lit(""))


def _vtype(v: Column) -> Column:
    return F.substring_index(F.schema_of_variant(v), "<", 1)


def normalize_iam_paths_checked(items: DataFrame, item_col: str = "item", account_col: str = "account_id",
                                region_col: str = "region") -> DataFrame:
    """C-11: one path-finding object per row -> IAM_RISKS columns + ``_parsed``.

    Built as a chain of projections, each naming the values the next one
    reuses (detail object, source/target ARNs, node list, admin flag), so no
    sub-expression is copied into its consumers.
    """
    f = J(F.col("_f"), prefix="_tf")
    d = J(F.col("_d"), prefix="_td")
    use_detail = ~f.falsy("$.detail")
    # detail = finding.detail or finding.details or {}
    s2 = [F.when(use_detail, f.sub("$.detail")).otherwise(f.sub("$.details")).alias("_d"),
          F.when(use_detail, F.lit(False)).otherwise(f.falsy("$.details")).alias("_dfalsy"),
          f.get_default("$.source_arn", "").alias("_src_top"), f.get_default("$.target_arn", "").alias("_tgt_top"),
          (~f.falsy("$.is_admin_path")).alias("_is_admin_path"),
          ((f.typ("$") != "OBJECT") | f.typ("$").isNull()).alias("_bad_root"),
          f.get_default("$.description", "").alias("_description"),
          F.when(f.missing("$.path"), F.parse_json(F.lit("[]"))).otherwise(f.sub("$.path")).alias("_path_top")]
    dfalsy = F.col("_dfalsy")

    def from_detail(key: str, top: str) -> Column:
        return F.coalesce(F.when(~dfalsy & ~d.falsy(f"$.{key}"), d.get(f"$.{key}")), F.col(top))

    s4 = [from_detail("source", "_src_top").alias("_src"), from_detail("destination", "_tgt_top").alias("_tgt"),
          F.when(~dfalsy & ~d.falsy("$.path"), d.sub("$.path")).otherwise(F.col("_path_top")).alias("_p"),
          (~dfalsy & (_vtype(F.col("_d")) != "OBJECT")).alias("_det_bad")]

    pcol = F.col("_p")
    is_list = F.startswith(F.schema_of_variant(pcol), F.lit("ARRAY"))
    s5 = [F.when(is_list, F.try_variant_get(pcol, "$", "array<variant>")).alias("_nodes"),
          _last_part(F.col("_src")).alias("_src_name"), _last_part(F.col("_tgt")).alias("_tgt_name")]

    nodes = F.coalesce(F.col("_nodes"), F.array().cast("array<variant>"))
    n_nodes = F.size(nodes)

    def node_text(n):
        t = _vtype(n)
        arn = F.try_variant_get(n, "$.arn", "string")
        return (F.when(t == "OBJECT", F.coalesce(arn, F.to_json(n)))
                .when(t == "STRING", F.try_variant_get(n, "$", "string"))
                .when(t == "VOID", F.lit("None"))
                .otherwise(F.to_json(n)))

    def has_action(n):
        return (_vtype(n) == "OBJECT") & _vtype(F.try_variant_get(n, "$.action", "variant")).isNotNull()

    # n.get("arn") present but null makes the join raise: the row is skipped.
    null_arn = F.exists(nodes, lambda n: (_vtype(n) == "OBJECT") &
                        (_vtype(F.try_variant_get(n, "$.arn", "variant")) == "VOID"))
    actions = F.transform(F.filter(nodes, has_action), lambda n: F.try_variant_get(n, "$.action", "string"))
    kw = F.lower(F.col("_tgt_name"))
    keyword_hit = None
    for k in ADMIN_KEYWORDS:
        keyword_hit = kw.contains(k) if keyword_hit is None else keyword_hit | kw.contains(k)
    s6 = [
        F.when(n_nodes > 0, F.array_join(F.transform(nodes, node_text), PATH_SEP))
        .otherwise(F.concat_ws(PATH_SEP, F.col("_src"), F.col("_tgt"))).alias("_path"),
        F.when(F.size(actions) > 0, actions).otherwise(F.array(F.lit(DEFAULT_METHOD))).alias("_methods"),
        (keyword_hit | F.col("_is_admin_path")).alias("_admin"),
        F.when(n_nodes > 0, n_nodes - 1).otherwise(F.lit(1)).alias("_hops_raw"),
        (F.col("_bad_root") | F.col("_det_bad") | F.col("_src").isNull() | F.col("_tgt").isNull()
         | F.coalesce(null_arn, F.lit(False))).alias("_bad"),
    ]
    admin, hops_raw = F.col("_admin"), F.col("_hops_raw")
    src, tgt = F.col("_src"), F.col("_tgt")
    passthrough = [c for c in items.columns if c not in (item_col, account_col, region_col)]
    out = [
        F.col(account_col).alias("account_id"), F.col(region_col).alias("region"),
        src.alias("source_arn"),
        F.when(F.coalesce(src, F.lit("")).contains(":role/"), "role").otherwise("user").alias("source_type"),
        F.col("_src_name").alias("source_name"),
        tgt.alias("target_arn"),
        F.when(F.coalesce(tgt, F.lit("")).contains(":role/"), "role").otherwise("user").alias("target_type"),
        F.col("_tgt_name").alias("target_name"),
        admin.alias("target_is_admin"),
        F.col("_path").alias("path"),
        F.greatest(hops_raw, F.lit(1)).cast("int").alias("hops"),
        F.col("_methods").alias("methods"),
        F.when(admin & (hops_raw <= 2), "CRITICAL").when(admin, "HIGH").otherwise("MEDIUM").alias("severity"),
        F.col("_description").alias("description"),
        F.col(item_col).alias("raw_json"),
        (~F.col("_bad")).alias("_parsed"),
    ]
    x = f.stage(items.select("*", F.try_parse_json(F.col(item_col)).alias("_f")))
    x = x.select("*", *s2)
    x = d.stage(x)
    x = x.select("*", *s4)
    x = x.select("*", *s5)
    x = x.select("*", *s6)
    return x.select(*passthrough, *out)


def normalize_iam_paths(items: DataFrame, item_col: str = "item", account_col: str = "account_id",
                        region_col: str = "region") -> DataFrame:
    return keep_parsed(normalize_iam_paths_checked(items, item_col, account_col, region_col))


# -- C-12 … C-17: inventory projections ------------------------------------------------

def row_json(df: DataFrame) -> Column:
    """J-13: the whole input row as JSON text."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]))


def project_instances(raw: DataFrame) -> DataFrame:
    """C-12: inventory instances; state 'terminated' (and a NULL state) dropped."""
    return raw.where(F.col("instance_state") != "terminated").select(
        "instance_id", "account_id", "region", F.col("arn").alias("resource_arn"), "instance_state",
        "instance_type", "launch_time", "vpc_id", "subnet_id", F.col("private_ip_address").alias("private_ip"),
        F.col("public_ip_address").alias("public_ip"), F.col("public_dns_name").alias("public_dns"),
        F.col("iam_instance_profile_arn").alias("iam_instance_profile"), "key_name",
        F.try_element_at(F.col("tags"), F.lit("Name")).alias("name_tag"), "tags", row_json(raw).alias("raw_json"),
    )


def project_buckets(raw: DataFrame, fix_inverted_flag: bool = False) -> DataFrame:
    """C-13: buckets.  ``public_access_blocked`` is filled from "policy is public"
    as the original does (X-1); ``fix_inverted_flag`` negates it."""
    pab = F.col("bucket_policy_is_public")
    return raw.select(
        F.col("name").alias("bucket_name"), "account_id", "region",
        F.concat(F.lit("arn:aws:s3:::"), F.col("name")).alias("resource_arn"),
        (~pab if fix_inverted_flag else pab).alias("public_access_blocked"),
        "versioning_enabled",
        F.col("logging").isNotNull().alias("logging_enabled"),
        F.col("server_side_encryption_configuration").isNotNull().alias("encryption_enabled"),
        "creation_date", "tags", row_json(raw).alias("raw_json"),
    )


def project_iam_users(raw: DataFrame, access_keys_col: str | None = None) -> DataFrame:
    """C-14: users.  ``has_access_keys`` comes from the MFA device list, as in
    the original (X-2); ``access_keys_col`` names a list of access keys to use
    instead."""
    keys = F.col(access_keys_col) if access_keys_col else F.col("mfa_devices")
    return raw.select(
        F.col("name").alias("user_name"), "account_id", "user_id", F.col("arn").alias("resource_arn"),
        "mfa_enabled", F.col("login_profile").isNotNull().alias("has_console_access"),
        F.coalesce(F.size(keys) > 0, F.lit(False)).alias("has_access_keys"),
        "password_last_used", F.lit(None).cast("timestamp").alias("access_key_last_used"),
        "create_date", "tags", row_json(raw).alias("raw_json"),
    )


def ingress_open(perms: Column, port: int | None = None, fix: bool = False, ipv6: bool = False) -> Column:
    """C-15: EXISTS rule x range with CidrIp 0.0.0.0/0 (and FromPort <= port <= ToPort).

    Higher-order ``exists`` is three-valued (NULL when a port is NULL and no
    other rule matches) where SQL EXISTS is two-valued, hence the coalesce.
    ``fix`` (X-7, off by default): a rule with NULL ports (all traffic) counts
    as open on every port, and with ``ipv6`` an Ipv6Ranges entry ::/0 counts
    as open too.
    """
    def rule_ok(r):
        any_range = F.exists(r["IpRanges"], lambda ip: ip["CidrIp"] == "0.0.0.0/0")
        if fix and ipv6:
            any_range = any_range | F.exists(r["Ipv6Ranges"], lambda ip: ip["CidrIpv6"] == "::/0")
        if port is None:
            return any_range
        in_range = (r["FromPort"] <= port) & (r["ToPort"] >= port)
        if fix:
            in_range = F.coalesce(in_range, r["FromPort"].isNull() & r["ToPort"].isNull())
        return any_range & in_range

    return F.coalesce(F.exists(perms, rule_ok), F.lit(False))


SSH_PORT, RDP_PORT = 22, 3389  # fixed values


def project_security_groups(raw: DataFrame, fix_ingress: bool = False) -> DataFrame:
    """C-15: security groups with the three public-ingress flags.
    ``fix_ingress`` applies the X-7 fix (all-traffic rules, IPv6 ::/0 when the
    rules carry Ipv6Ranges)."""
    perms = F.col("ip_permissions")
    rule_t = raw.schema["ip_permissions"].dataType.elementType
    ipv6 = fix_ingress and "Ipv6Ranges" in rule_t.fieldNames()
    return raw.select(
        "group_id", "group_name", "account_id", "region",
        F.concat(F.lit("arn:aws:ec2:"), F.col("region"), F.lit(":"), F.col("account_id"),
                 F.lit(":security-group/"), F.col("group_id")).alias("resource_arn"),
        "vpc_id", "description",
        ingress_open(perms, fix=fix_ingress, ipv6=ipv6).alias("allows_all_ingress"),
        ingress_open(perms, SSH_PORT, fix_ingress, ipv6).alias("allows_ssh_public"),
        ingress_open(perms, RDP_PORT, fix_ingress, ipv6).alias("allows_rdp_public"),
        "tags", row_json(raw).alias("raw_json"),
    )


def project_vpcs(raw: DataFrame) -> DataFrame:
    """C-16."""
    return raw.select("vpc_id", "account_id", "region", "cidr_block", "is_default", "state", "tags",
                      row_json(raw).alias("raw_json"))


def serialize_nested(df: DataFrame) -> DataFrame:
    """C-17: every struct / map / array column becomes JSON text (found from the schema)."""
    nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("struct", "map", "array")}
    return df.select(*[F.to_json(F.col(c)).alias(c) if c in nested else F.col(c) for c in df.columns])


PROJECTIONS = {
    "instances": project_instances,
    "s3": project_buckets,
    "iam": project_iam_users,
    "security_groups": project_security_groups,
    "vpcs": project_vpcs,
}
