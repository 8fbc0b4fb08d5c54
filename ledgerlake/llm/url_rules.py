"""Which pages to take, by host and path rules and by rules mined from labelled addresses.

Given rules come first: a rule fits its host and every subdomain when the path starts with
the rule's, and the longest one decides. Where none fits, mined rules decide: an address is a
set of tokens (host labels, path parts, query keys; numbers are alike), FP-growth finds the
token combinations of labelled addresses, and those that imply a label with enough support,
labelled rows and confidence become rules. They are matched through an inverted index: a rule is
listed under its rarest token only, and a listed rule must have all its tokens in the address.

Only DataFrame functions and Spark's FP-growth run here. Addresses are matched as distinct
token sets, so copies are matched once; verdicts return to the pages by an equi-join.

Defined results: a null address or one without ``://`` has empty host and path and the tokens of neither;
repeated rows get equal results; without labels, or when no combination passes, the default verdict is
``allow``; an empty table gives an empty one; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise

ALLOW, BLOCK = "allow", "block"

# The given rules (host, path, verdict).
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "label="


@dataclass(frozen=True)
class Mining:
    """Least share (none by default, so that rare hosts get rules in a table of any size) and least
    number of labelled rows with the tokens and the label, least confidence, and least lift: how
    much likelier the label must be than without the tokens.
    """

    support: float = 0.0
    rows: int = 20
    confidence: float = 0.8
    lift: float = 1.1


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of an address; both empty where there's no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens: host labels, path parts and query keys, numbers written ``0``."""

    def parts(text: Column, pattern: str, mark: str) -> Column:
        kept = F.filter(F.split(F.regexp_replace(text, "[0-9]+", "0"), pattern), lambda p: p != "")
        return F.transform(kept, lambda p: F.concat(F.lit(mark), p))

    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.regexp_replace(query, "=[^&]*", "")
    lower = F.translate(path, _UPPER, _LOWER)
    return F.array_sort(
        F.array_distinct(F.concat(parts(host, r"\.", "host:"), parts(lower, r"[/._-]+", "path:"), parts(keys, "&", "key:")))
    )


def mine_rules(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Rules (tokens, verdict, confidence, lift, n_rows) from rows of tokens and label (allow or block)."""
    rows = labelled.where(F.col("label").isin(ALLOW, BLOCK)).select(
        F.array_append("tokens", F.concat(F.lit(_LABEL), F.col("label"))).alias("items")
    )
    rows = materialise(rows, "labelled-addresses")
    count = rows.count()
    if not count:
        return rows.sparkSession.createDataFrame([], "tokens array<string>, verdict string, confidence double, lift double, n_rows long")
    # The number of rows decides; half a row less, so that no rounding takes a rule away.
    support = max(mining.support, min(1.0, (mining.rows - 0.5) / count))
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=mining.confidence).fit(rows)
    label = F.element_at("consequent", 1)
    rules = found.associationRules.where(F.startswith(label, F.lit(_LABEL)))
    rules = rules.where(~F.exists("antecedent", lambda t: F.startswith(t, F.lit(_LABEL))))
    return rules.select(
        F.array_sort("antecedent").alias("tokens"),
        F.substr(label, F.lit(len(_LABEL) + 1)).alias("verdict"),
        "confidence",
        "lift",
        F.round(F.col("support") * count).cast("long").alias("n_rows"),
    ).where((F.col("n_rows") >= mining.rows) & (F.col("lift") >= mining.lift))


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The strongest rule of every distinct token set: tokens, verdict and the rule's tokens.

    Most confident first, then most rows, most tokens and the order of the tokens.
    """
    distinct = sets.select("tokens").distinct()
    listed = distinct.select("tokens", F.explode("tokens").alias("token"))
    spread = listed.groupBy("token").agg(F.count("*").alias("n"))
    rules = rules.withColumnRenamed("tokens", "rule_tokens")
    one = rules.select("rule_tokens", F.explode("rule_tokens").alias("token")).join(spread, "token", "left")
    one = one.groupBy("rule_tokens").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).alias("rarest"))
    index = rules.join(one, "rule_tokens").withColumn("token", F.col("rarest.token"))
    hits = listed.join(index, "token").where(F.size(F.array_except("rule_tokens", "tokens")) == 0)
    rank = F.struct(
        F.col("confidence"), F.col("n_rows"), F.size("rule_tokens").alias("size"), F.array_join("rule_tokens", " ").alias("name"), "verdict"
    )
    best = hits.groupBy("tokens").agg(F.max(rank).alias("best"))
    return best.select("tokens", F.col("best.verdict").alias("mined_verdict"), F.col("best.name").alias("mined_rule"))


def judge(
    pages: DataFrame, labels: DataFrame, mining: Mining = Mining(), key: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per page: the key, host, path, rule, verdict and the mined rule where that decided.

    ``labels`` has columns url and label (allow or block).
    """

    def parsed(frame: DataFrame, address: Column, *columns: Column) -> DataFrame:
        host, path = host_and_path(address)
        rows = frame.select(*columns, address.alias("url"), host.alias("host"), path.alias("path"))
        return rows.withColumn("tokens", url_tokens(F.col("url"), F.col("host"), F.col("path")))

    rows = parsed(pages, pages[url], pages[key].alias("key"))
    rule, verdict = given_rule(F.col("host"), F.col("path"))
    rows = materialise(rows.select("key", "host", "path", "tokens", rule.alias("rule"), verdict.alias("given")), "addresses")
    rules = materialise(mine_rules(parsed(labels, labels["url"], labels["label"]), mining), "mined-rules")
    best = match_rules(rows.where("given is null"), rules)
    joined = rows.join(best, "tokens", "left")
    mined = F.when(F.col("given").isNull(), F.col("mined_rule"))
    return joined.select(
        F.col("key").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("given", "mined_verdict", F.lit(ALLOW)).alias("verdict"),
        mined.alias("mined_rule"),
    )
