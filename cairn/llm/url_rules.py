"""URL filters by hash prefixes of host-suffix and path-prefix expressions.

A rule is (host, path, verdict) and fits its host and every subdomain of it when the url's path
starts with the rule's path.  A url is expanded into its expressions: every suffix of its host that
begins at a label, joined to its path cut at the lengths that some rule's path has.  The first 32
bits of the expressions' SHA-256 are joined to those of the rules, the full digests confirm what the
prefix suggests, and of the rules that fit, the longest wins.

Only the url column is read.  The rules go to every task while their number is within
``MAX_SENT_RULES``; beyond, both sides are exchanged by (prefix, salt), the rules once per salt, as a
rule like ``com/`` may fit a third of all urls.  The url's verdict comes back by (host, path), the
deterministic key of an expansion, so a repeated url is expanded into one verdict.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and
gets the default verdict; so does an empty path under a rule with path ``/``.  Repeated rows, null ids
and extra columns stay as they are.  Of rules with the same expression a block wins; of different
rules equally long, the least in code-point order.  Rules need a host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DEFAULT_VERDICT = "allow"
PREFIX_DIGITS = 8  # hex digits of the short prefix: 32 bits
MAX_SENT_RULES = 100_000  # rows of about 200 bytes that may go to every task
SALTS = 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def expressions(host: Column, path: Column, path_lengths: list[int],
                longest_host: int) -> Column:
    """array<string>: host suffixes beginning at a label and no longer than ``longest_host``, each
    with the path's prefixes of the given lengths."""
    n = F.length(host)
    first = F.greatest(F.lit(1), n - longest_host + 1)
    starts = F.filter(F.sequence(first, F.greatest(first, n)), lambda i: (i <= n) & (
        (i == 1) | (F.substring(host, i - 1, F.lit(1)) == ".")))
    suffixes = F.transform(starts, lambda i: F.substring(host, i, n))
    lengths = F.filter(F.array(*[F.lit(x) for x in path_lengths]).cast("array<int>"),
                       lambda x: x <= F.length(path))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(
        lengths, lambda x: F.concat(s, F.substring(path, F.lit(1), x)))))


def rule_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(host, path, verdict)`` rows of a rule list."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url",
               names: tuple[str, str, str, str] = ("host", "path", "rule", "verdict"),
               default: str = DEFAULT_VERDICT,
               max_sent_rules: int = MAX_SENT_RULES) -> DataFrame:
    """The rows of ``urls`` with their host, path, winning rule (null if none) and verdict, in
    columns of the given names; input columns of these names go."""
    host_name, path_name, rule_name, verdict_name = names
    rule = F.concat(F.translate("host", _UPPER, _LOWER), "path")
    known = (rules.where("length(host) > 0 and path is not null and verdict is not null")
             .groupBy(rule.alias("rule"), F.length("host").alias("nh"), F.length("path").alias("np"))
             .agg(F.max("verdict").alias("verdict")))  # 'block' > 'allow'
    shape = known.agg(F.count(F.lit(1)).alias("n"), F.max("nh").alias("longest"),
                      F.collect_set("np").alias("lengths")).first()
    host, path = host_and_path(F.col(url))
    parsed = [c for c in urls.columns if c not in names]
    rows = urls.select(*[F.col(f"`{c}`") for c in parsed], host.alias(host_name),
                       path.alias(path_name))
    if not shape.n:
        return rows.withColumns({rule_name: F.lit(None).cast("string"),
                                 verdict_name: F.lit(default)})
    digest = F.sha2("rule", 256)
    known = known.select("rule", "verdict", digest.alias("full"),
                         F.substring(digest, 1, PREFIX_DIGITS).alias("short"))
    found = urls.select(host.alias("h"), path.alias("p")).where("h <> ''")
    found = found.select("h", "p", F.explode(expressions(
        F.col("h"), F.col("p"), sorted(shape.lengths), shape.longest)).alias("e"))
    found = found.select("h", "p", F.sha2("e", 256).alias("d"))
    found = found.withColumn("s", F.substring("d", 1, PREFIX_DIGITS))
    if shape.n <= max_sent_rules:
        hits = found.join(F.broadcast(known), F.col("s") == F.col("short"))
    else:
        known = known.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = found.withColumn("at", F.pmod(F.xxhash64("h", "p"), F.lit(SALTS)).cast("int"))
        hits = found.join(known, (F.col("s") == F.col("short")) & (F.col("at") == F.col("slot")))
    # the least of (-length, rule) is the longest rule
    best = (hits.where("d = full").groupBy("h", "p")
            .agg(F.min(F.struct((-F.length("rule")).alias("len"), "rule", "verdict")).alias("b"))
            .select("h", "p", F.col("b.rule").alias("r"), F.col("b.verdict").alias("v")))
    left, right = rows.alias("l"), best.alias("r")
    joined = left.join(right, (F.col(f"l.`{host_name}`") == F.col("r.h"))
                       & (F.col(f"l.`{path_name}`") == F.col("r.p")), "left")
    return joined.select("l.*", F.col("r.r").alias(rule_name),
                         F.coalesce(F.col("r.v"), F.lit(default)).alias(verdict_name))
