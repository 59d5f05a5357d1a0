"""URL filter: host-suffix and path-prefix expressions against a rule table.

A rule (host, path, verdict) fits its host and all subdomains of it when the
url's path starts with the rule's path; of several the longest wins. Each url
is expanded into the expressions ``host suffix || path prefix`` that any rule
could name (as many labels, and as many path characters, as some rule has).
Expressions meet the rules in an equi-join on a short prefix of their SHA-256
digest; the full digests then confirm, and precedence decides.

Only DataFrame functions. The rules are broadcast by Spark when they are under
its size threshold; beyond it the join shuffles and skewed keys are split.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and gets the default verdict. Repeated pages are judged row
by row. A rule table with no rows gives every page the default. Rules with a
null host, path or verdict are ignored; of equal rules a block wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.common import lower_ascii

#: Hex digits of the digest that the join matches before the full digest confirms.
SHORT = 8


def url_parts(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) of every page."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(coalesce(url, ''), instr(coalesce(url, ''), '://') + 3)")).otherwise("")
    parts = r"^([^/?#]*)([^?#]*)"
    return pages.select("page_id", rest.alias("rest")).select(
        "page_id",
        lower_ascii(F.regexp_extract("rest", parts, 1)).alias("host"),
        F.regexp_extract("rest", parts, 2).alias("path"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, rule_host, rule_path) of every page;
    ``rule`` is ``host || path`` of the deciding rule, or null."""
    rules = (rules.select(lower_ascii(F.col("host")).alias("r_host"), F.col("path").alias("r_path"),
                          F.col("verdict").alias("r_verdict"))
             .dropna()
             .withColumn("r_digest", F.sha2(F.concat("r_host", "r_path"), 256))
             .withColumn("r_short", F.substring("r_digest", 1, SHORT)))
    shape = rules.agg(F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels"),
                      F.collect_set(F.length("r_path")).alias("lengths")).first()
    # how many labels and path characters rules have: a few small numbers, bounded by a url's length
    labels, lengths = sorted(shape["labels"]), sorted(shape["lengths"])
    parts = url_parts(pages).withColumn("uid", F.monotonically_increasing_id())
    pairs = [F.when((F.size(F.split("host", r"\.")) >= n) & (F.length("path") >= m),
                    F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, m)))
             for n in labels for m in lengths]
    exprs = F.array_compact(F.array(*pairs)) if pairs else F.array().cast("array<string>")
    spread = (parts.withColumn("expr", F.explode_outer(exprs))
              .withColumn("digest", F.sha2("expr", 256)))
    hit = F.col("digest") == F.col("r_digest")
    # precedence: longest rule, then longest host, then block before allow
    found = F.when(hit, F.struct(
        (F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("n_host"),
        (F.col("r_verdict") == "block").alias("blocks"), "r_host", "r_path", "r_verdict"))
    best = (spread.join(rules, F.substring("digest", 1, SHORT) == F.col("r_short"), "left")
            .groupBy("uid").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"),
                                F.first("path").alias("path"), F.max(found).alias("best")))
    return best.select(
        "page_id", "host", "path", F.concat("best.r_host", "best.r_path").alias("rule"),
        F.coalesce("best.r_verdict", F.lit(default)).alias("verdict"),
        F.col("best.r_host").alias("rule_host"), F.col("best.r_path").alias("rule_path"))
