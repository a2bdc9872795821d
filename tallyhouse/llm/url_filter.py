"""URL filtering with a list of rules and with association rules mined from labelled URLs.

A URL becomes a set of tokens (labels of its host, segments of its path, names of its query
parameters; digits count as one token). Spark's FP-growth mines the token sets of labelled URLs
together with the label "block"; combinations with enough support whose share of blocked URLs
reaches the confidence become rules, unless a part of the combination already is at least as
confident. Rules are matched through an inverted index: a rule is filed under its rarest token, a
URL looks up its tokens and checks the whole combination. The list of rules, where one fits, wins.

Defined results: a null URL or one without "://" has an empty host and path, no tokens, and is
allowed; repeated rows are judged alike; without labelled URLs nothing is mined and all that no
listed rule fits is allowed. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import staged

BLOCKED = "label block"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def url_host(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), "^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, ascii_uppercase, ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """The distinct tokens of a URL, each with the part it comes from."""
    number = lambda part: F.regexp_replace(part, "[0-9]+", "0")
    mark = lambda parts, kind: F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(kind), number(p)))
    query = F.regexp_extract(_rest(url), "^[^?#]*[?]([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda pair: F.split_part(pair, F.lit("="), F.lit(1)))
    host = mark(F.split(url_host(url), "[.]"), "host ")
    path = mark(F.split(url_path(url), "[/.]"), "path ")
    return F.array_distinct(F.concat(host, path, mark(names, "query ")))


def listed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, host/path) that fits, else nulls.

    A rule fits its host and every subdomain if the path starts with the rule's path.
    """
    rule = verdict = F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def mine_rules(labelled: DataFrame, min_support: float, min_count: int, min_confidence: float) -> DataFrame:
    """(tokens, confidence, support_count) from ``labelled`` (tokens, blocked)."""
    label = F.when(F.col("blocked"), F.array(F.lit(BLOCKED))).otherwise(F.array().cast("array<string>"))
    baskets = labelled.select(F.concat("tokens", label).alias("items"))
    baskets = staged(baskets.where(F.size("items") > 0), "url-baskets")
    spark, total = labelled.sparkSession, baskets.count()
    nothing = spark.createDataFrame([], "tokens array<string>, confidence double, support double")
    if not total:
        return nothing
    support = max(min_support, min_count / total)
    if support > 1:
        return nothing
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0] == BLOCKED)
    rules = staged(rules.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"), "url-rules")
    # A rule adds nothing if leaving tokens out gives a rule that is as confident: look up every
    # combination with one token less, which has been mined as well, and so on down.
    parts = rules.where(F.size("tokens") > 1).withColumn("without", F.explode("tokens"))
    parts = parts.select("tokens", "confidence", F.array_remove("tokens", F.col("without")).alias("part"))
    smaller = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"))
    redundant = parts.join(smaller, "part").where("part_confidence >= confidence").select("tokens").distinct()
    return rules.join(redundant, "tokens", "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, tokens of the most confident rule, confidence) of every url in ``urls`` (url, tokens) that a rule matches."""
    listed = rules.select(F.explode("tokens").alias("token")).distinct()
    seen = urls.select("url", "tokens", F.explode("tokens").alias("token"))
    frequency = seen.groupBy("token").count().join(listed, "token", "left_semi")
    entries = rules.select(F.col("tokens").alias("wanted"), "confidence", F.explode("tokens").alias("token")).join(frequency, "token")
    entries = entries.groupBy("wanted", "confidence").agg(F.min(F.struct("count", "token")).alias("rarest"))
    index = entries.select("wanted", "confidence", F.col("rarest.token").alias("token"))
    hits = seen.join(index, "token").where(F.size(F.array_except("wanted", "tokens")) == 0)
    best = hits.groupBy("url").agg(F.max(F.struct("confidence", "wanted")).alias("best"))
    return best.select("url", F.col("best.wanted").alias("mined_rule"), F.col("best.confidence").alias("confidence"))


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]],
    min_support: float = 0.002,
    min_count: int = 20,
    min_confidence: float = 0.6,
    url_col: str = "url",
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, mined_rule and confidence added.

    ``labels`` are labelled URLs (url, blocked). A combination needs ``min_support`` of them, and
    ``min_count`` at least, and a share ``min_confidence`` of blocked ones.
    """
    mined = mine_rules(labels.select(url_tokens(F.col("url")).alias("tokens"), "blocked"), min_support, min_count, min_confidence)
    urls = pages.select(F.col(url_col).alias("url")).where("url is not null").distinct()
    matched = match_rules(urls.withColumn("tokens", url_tokens(F.col("url"))), mined)
    matched = matched.withColumnRenamed("url", "_matched_url")
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "mined_rule", "confidence")]
    judged = pages.select(*kept).join(matched, F.col(url_col) == F.col("_matched_url"), "left")
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    rule, verdict = listed_rule(host, path, rules)
    method = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    added = {"host": host, "path": path, "rule": rule, "verdict": F.coalesce(verdict, method)}
    return judged.withColumns(added).drop("_matched_url")
