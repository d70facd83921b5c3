"""URL filters: block and allow rules for hosts with all their subdomains, and for paths below them.

A url becomes the expressions host suffix x path prefix ("example.net/en/" for https://m.example.net/en/25), up to the
label and folder counts that rules have. They meet the rules in an equi-join on the first 32 bits of a digest; then the
whole digests are compared, and of the rules that fit the longest wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_DIGITS = 8  # hex digits of a digest that are joined on
VERDICTS = ("block", "allow")
OWN = ("host", "path", "rule", "verdict")


def host_of(url: str) -> str:
    """SQL: what is after the first :// up to /, ?, # or the end, A-Z in lower case; empty without :// or for a null."""
    rest = f"substr({url}, locate('://', {url}) + 3)"
    host = f"regexp_extract({rest}, '^[^/?#]*', 0)"
    lower = f"translate({host}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"CASE WHEN locate('://', {url}) > 0 THEN {lower} ELSE '' END"


def path_of(url: str) -> str:
    """SQL: what is after the host up to ?, # or the end."""
    rest = f"substr({url}, locate('://', {url}) + 3)"
    return f"CASE WHEN locate('://', {url}) > 0 THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END"


def rule_frame(spark: SparkSession, rules: Sequence[str]) -> DataFrame:
    """Rules written as "block example.com/de/": a verdict, then a host with the path that follows it."""
    lines = F.explode(F.array(*[F.lit(r) for r in rules])) if rules else F.lit(None).cast("string")
    split = spark.range(1).select(lines.alias("line")).where("line IS NOT NULL")
    return split.selectExpr(
        "regexp_extract(line, '^\\\\S+\\\\s+([^/\\\\s]*)', 1) AS host",
        "regexp_extract(line, '^\\\\S+\\\\s+[^/\\\\s]*(.*)$', 1) AS path",
        "regexp_extract(line, '^\\\\S+', 0) AS verdict",
    )


def _expression(host: str, path: str) -> str:
    """Hosts hold no slash, so the first one ends the host."""
    return f"concat({host}, '/', {path})"


def prepared(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their digests. `near` is the digest of host and path up to its last slash: the
    expression of a url that the rule meets. A null path is empty. Left out are rules that can fit no url (no host, a host
    with /, ? or #, a path with ? or #) and those with another verdict than block or allow. Of equal rules block stays."""
    clean = rules.selectExpr(
        "translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r_host",
        "coalesce(path, '') AS r_path",
        "verdict AS r_verdict",
    ).where(f"r_host <> '' AND r_host NOT RLIKE '[/?#]' AND r_path NOT RLIKE '[?#]' AND r_verdict IN {VERDICTS}")
    folder = "regexp_extract(r_path, '^(?s:.*)/', 0)"
    return clean.groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict")).selectExpr(
        "concat(r_host, r_path) AS r_rule",
        "r_verdict",
        "length(r_path) AS r_length",
        f"sha2({_expression('r_host', folder)}, 256) AS near",
        f"sha2({_expression('r_host', 'r_path')}, 256) AS digest",
        "size(split(r_host, '[.]')) AS labels",
        f"length({folder}) - length(replace({folder}, '/', '')) AS folders",
    )


def expressions(host: str, path: str, labels: int, folders: int) -> str:
    """SQL: an array of (suffix, near) for all host suffixes of at most `labels` labels and all path prefixes of at most
    `folders` slashes that end in a slash, the empty one included."""
    n_labels = f"length({host}) - length(replace({host}, '.', '')) + 1"
    n_slashes = f"length({path}) - length(replace({path}, '/', ''))"
    suffixes = f"transform(sequence(1, greatest(1, least({labels}, {n_labels}))), i -> substring_index({host}, '.', -i))"
    prefixes = f"""transform(sequence(0, least({folders}, {n_slashes})),
      j -> CASE WHEN j = 0 THEN '' ELSE concat(substring_index({path}, '/', j), '/') END)"""
    return f"""flatten(transform({suffixes}, s -> transform({prefixes},
      p -> named_struct('suffix', s, 'near', sha2({_expression('s', 'p')}, 256)))))"""


def verdicts(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of those distinct `addresses` (host, path) that a rule fits.

    Only as many labels and folders are expanded as some rule has, which loses nothing: a longer suffix or prefix is no
    rule's. The join's sides are left to Spark, which broadcasts rules below its own size threshold only.
    """
    rules = prepared(rules)
    labels, folders = rules.agg(F.max("labels"), F.max("folders")).first()
    expanded = addresses.selectExpr("host", "path", f"explode({expressions('host', 'path', labels or 0, folders or 0)}) AS e").selectExpr(
        "host", "path", "e.suffix", "e.near", f"substr(e.near, 1, {PREFIX_DIGITS}) AS prefix"
    )
    keyed = rules.selectExpr("*", f"substr(near, 1, {PREFIX_DIGITS}) AS prefix").withColumnRenamed("near", "r_near")
    met = expanded.join(keyed, "prefix").where("near = r_near").where(
        f"digest = sha2({_expression('suffix', 'substr(path, 1, r_length)')}, 256)"
    )
    # The longest rule; of two as long, the one with the longer path, so never two different ones.
    best = "max(named_struct('n', length(r_rule), 'length', r_length, 'rule', r_rule, 'verdict', r_verdict))"
    return met.groupBy("host", "path").agg(F.expr(best).alias("best")).selectExpr("host", "path", "best.rule", "best.verdict")


def judged(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """`df` with the columns host, path, rule and verdict (columns of these names are replaced), one row for each of its
    rows: the longest rule that fits and its verdict, or no rule and `default`.

    A rule fits its host and all subdomains, if the url's path starts with the rule's. Rules are rows (host, path,
    verdict), see `prepared`; the same host and path as often as you like. Equal urls are judged once: they are counted
    together before anything is expanded or joined. A null url, or one without ://, has an empty host and path, as long
    a text as it may be, and only `default`. An empty table stays empty; without rules all urls get `default`.
    """
    if default not in VERDICTS:
        raise ValueError(f"the default verdict must be one of {VERDICTS}, not {default!r}")
    column = f"df_.`{url}`"
    kept = [c for c in df.columns if c.lower() not in OWN]
    parsed = df.alias("df_").selectExpr(*[f"df_.`{c}`" for c in kept], f"{host_of(column)} AS host", f"{path_of(column)} AS path")
    found = verdicts(parsed.select("host", "path").distinct(), rules)
    return parsed.join(found, ["host", "path"], "left").selectExpr(
        *[f"`{c}`" for c in kept], "host", "path", "rule", f"coalesce(verdict, '{default}') AS verdict"
    )


def allowed(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The rows of `df` whose url is not blocked, with all their columns unchanged."""
    column = f"df_.`{url}`"
    parsed = df.alias("df_").selectExpr("struct(df_.*) AS row_", f"{host_of(column)} AS host", f"{path_of(column)} AS path")
    found = verdicts(parsed.select("host", "path").distinct(), rules).select("host", "path", "verdict")
    left = parsed.join(found, ["host", "path"], "left").where(f"coalesce(verdict, '{default}') = 'allow'")
    return left.select("row_.*")


RULES = ("block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/")


def page_verdicts(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    rules = rule_frame(pages.sparkSession, RULES)
    return judged(pages.select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")
