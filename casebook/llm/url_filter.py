"""URL filtering by rules and by path-template trees, in DataFrame operations only.

Rules ``(verdict, host, path)`` come first: a rule fits its host and all subdomains if the URL's path
starts with the rule's; the longest fitting rule decides. What the rules decide also labels the URLs of
the trees that judge the rest:

1. Per host, paths are read segment by segment. A segment with many, mostly different values below one node
   is variable and becomes ``*``.
2. Sibling branches whose share of rejected labels and of variable children do not differ from their parent's
   by a two-sided test are merged into one branch ``~``; branches without labels are merged with each other only, by
   their structure.
3. A template is rejected if its purity, the share of rejected labels smoothed towards one half, is
   high enough. One without labels is judged by its labelled siblings, or those of its nearest ancestor that has some: its
   purity is the mean of theirs, smoothed alike, each sibling being one observation. On hosts without labels all are allowed.

* Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``,
  ``#`` or the end. Null URLs and URLs without ``://`` have neither, fit no rule, and are judged as one host.
* Segments below ``depth`` are one wildcard tail. Ties between rules cannot be: two different rules of one length do not fit
  one URL unless one's host ends with the other's. Repeated rows are rows of their own; extra columns do not
  matter. An empty table gives an empty result.
* Paths are counted per host before anything is shuffled by host, so a hot host costs its distinct paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import Scratch, lower_ascii, narrow, query, table

DEPTH = 8
VARIABLE_VALUES = 10  # a segment with fewer values below a node is never variable
VARIABLE_SHARE = 0.2  # distinct values per distinct path
SIMILAR_Z = 1.96
PRIOR_LABELS = 2.0
REJECT_PURITY = 0.8

# Verdict, host and path of each rule.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The deciding rule, as host and path together, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def differs(share: Column, n: Column, pooled: Column) -> Column:
    """Whether a share of ``n`` observations differs from the pooled share."""
    spread = F.sqrt(pooled * (1 - pooled) / n)
    return F.when(n > 0, F.abs(share - pooled) > SIMILAR_Z * spread).otherwise(False)


def templates(scratch: Scratch, paths: DataFrame, depth: int) -> DataFrame:
    """``paths``: ``host, path, n, blocked, labelled``, one row per host and path. Adds ``template``, and
    the sum ``sibling_purity`` over the ``siblings`` that judge it if it has no labels."""
    level = paths.withColumn("segments", F.split(F.regexp_replace("path", "^/", ""), "/")).withColumn("template", F.lit(""))
    level = level.withColumn("sibling_purity", F.lit(0.0)).withColumn("siblings", F.lit(0).cast("long"))
    level = scratch.store(level, "level-0")
    deepest = min(level.agg(F.max(F.size("segments"))).first()[0] or 0, depth)
    node = ["host", "template"]
    for d in range(deepest):
        here = level.where(F.size("segments") > d).withColumn("segment", F.col("segments")[d])
        child = F.when(F.size("segments") > d + 1, F.col("segments")[d + 1].rlike("[0-9]").cast("int")).otherwise(0)
        branches = here.groupBy(*node, "segment").agg(
            F.count("*").alias("paths"), F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"), F.sum(child * F.col("n")).alias("varied")
        )
        branches = scratch.store(branches, f"branches-{d}")
        whole = branches.groupBy(*node).agg(
            F.count("*").alias("all_values"),
            F.sum("paths").alias("all_paths"),
            F.sum("n").alias("all_n"),
            F.sum("blocked").alias("all_blocked"),
            F.sum("labelled").alias("all_labelled"),
            F.sum("varied").alias("all_varied"),
            F.sum(F.when(F.col("labelled") > 0, F.col("blocked") / F.col("labelled"))).alias("all_purity"),
            F.count(F.when(F.col("labelled") > 0, 1)).alias("judging"),
        )
        variable = (F.col("all_values") >= VARIABLE_VALUES) & (F.col("all_values") >= VARIABLE_SHARE * F.col("all_paths"))
        share = lambda part, n: F.col(part) / F.when(F.col(n) > 0, F.col(n))
        other = F.coalesce(differs(share("blocked", "labelled"), F.col("labelled"), share("all_blocked", "all_labelled")), F.lit(False))
        other = other | differs(share("varied", "n"), F.col("n"), share("all_varied", "all_n"))
        merged = F.when(F.col("labelled") > 0, "~").otherwise("~?")
        name = F.when(variable, "*").when(other | (F.col("all_values") == 1), F.col("segment")).otherwise(merged)
        names = branches.join(whole, node).select(*node, "segment", F.concat("template", F.lit("/"), name).alias("next"), F.when(F.col("labelled") == 0, F.col("judging")).otherwise(0).alias("judging"), "all_purity")
        joined = here.join(names, [*node, "segment"]).withColumn("template", F.col("next"))
        joined = joined.withColumn("sibling_purity", F.when(F.col("judging") > 0, F.col("all_purity")).otherwise(F.col("sibling_purity")))
        joined = joined.withColumn("siblings", F.when(F.col("judging") > 0, F.col("judging")).otherwise(F.col("siblings"))).select(level.columns)
        done = level.where(F.size("segments") <= d)
        level = scratch.store(joined.union(done), f"level-{d + 1}")
        scratch.drop(f"level-{d}", f"branches-{d}")
    tail = F.when(F.size("segments") > depth, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return level.withColumn("template", tail).drop("segments")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: list[tuple[str, str, str]] | None = None, depth: int = DEPTH) -> DataFrame:
    """Per row: key, ``host, path, rule, verdict``, and the ``template`` with its ``purity``."""
    scratch = Scratch(pages.sparkSession, "url-filter")
    host, path = host_and_path(F.col("url"))
    rows = narrow(pages, key, url).toDF("key", "url").select("key", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), RULES if rules is None else rules)
    rows = scratch.store(rows.withColumn("rule", rule).withColumn("ruled", verdict), "rows")
    paths = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.sum((F.col("ruled") == "block").cast("long")).alias("b"),
        F.count("ruled").alias("labelled"),
    )
    found = templates(scratch, paths.withColumn("blocked", F.coalesce("b", F.lit(0))).drop("b"), depth)
    found = scratch.store(found, "templates")
    smoothed = lambda part, n: (part + PRIOR_LABELS / 2) / (n + PRIOR_LABELS)
    purity = F.when(F.sum("labelled") > 0, smoothed(F.sum("blocked"), F.sum("labelled")))
    purity = purity.otherwise(smoothed(F.max("sibling_purity"), F.max("siblings")))  # the same for all paths of a template without labels
    pure = scratch.store(found.groupBy("host", "template").agg(purity.alias("purity")), "pure")  # of known size
    judged = found.select("host", "path", "template").join(pure, ["host", "template"])
    own = F.when(F.col("purity") >= REJECT_PURITY, "block").otherwise("allow")
    joined = rows.join(judged, ["host", "path"])
    return joined.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "template", "purity")


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
