"""URL filters: fixed host and path rules first, then association rules mined from labelled URLs.

FP-growth finds the URL tokens and combinations of tokens that go with a label; rules below the support or the
confidence bound, and rules that a shorter one matches at least as surely, are dropped. The rest form an inverted index: each rule is
filed under its rarest token and looked up by the tokens of a URL.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.store import saved

# Verdict, host and path of the base rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Fixed value: the label item, which no URL token can equal.
BAD = "label bad"
# A rule holds for so many labelled URLs at least, and for that share of them the label is bad.
LEAST_URLS, SUPPORT, CONFIDENCE = 10, 0.0005, 0.6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(own + start)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted tokens of a URL: scheme, host labels and their parts, path parts, endings, query names, fragment."""
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    kind = lambda x: F.when(x.rlike("^[0-9]+$"), F.lit("number")).otherwise(x)
    names = F.filter(F.split(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "&"), lambda x: x != "")
    return F.array_sort(
        F.array_distinct(
            F.concat(
                F.array(F.concat(F.lit("scheme "), F.coalesce(F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.lit("")))),
                F.transform(F.filter(labels, lambda x: x != ""), lambda x: F.concat(F.lit("host "), x)),
                F.transform(F.filter(F.flatten(F.transform(labels, lambda x: F.split(x, "-"))), lambda x: x != ""), lambda x: F.concat(F.lit("part "), x)),
                F.transform(segments, lambda x: F.concat(F.lit("path "), kind(F.regexp_replace(x, r"\.[A-Za-z0-9]+$", "")))),
                F.transform(F.filter(segments, lambda x: x.rlike(r"\.[A-Za-z0-9]+$")), lambda x: F.concat(F.lit("end "), F.regexp_extract(x, r"\.([A-Za-z0-9]+)$", 1))),
                F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda x: F.concat(F.lit("query "), F.substring_index(x, "=", 1))),
                F.when(F.coalesce(F.instr(url, "#"), F.lit(0)) > 0, F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
            )
        )
    )


def mine(labelled: DataFrame) -> DataFrame:
    """``(rule_tokens, confidence, filed)`` from ``(tokens, bad)``; no rows where nothing is sure enough."""
    items = saved(labelled.select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items")), "url-items")
    schema = "rule_tokens array<string>, confidence double, filed string"
    n = items.count()
    if not n:
        return items.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=max(SUPPORT, min(1.0, LEAST_URLS * CONFIDENCE / n)), minConfidence=CONFIDENCE).fit(items)
    found = model.associationRules.filter(F.element_at("consequent", 1) == BAD)
    found = saved(found.select(F.array_sort("antecedent").alias("rule_tokens"), "confidence"), "url-rules")
    single = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    # A longer rule stays only if it is surer than each shorter one within it; those meet it at one of their own tokens.
    longer = found.select(F.col("rule_tokens").alias("long"), F.col("confidence").alias("sure"), F.explode("rule_tokens").alias("token"))
    shorter = found.select("rule_tokens", "confidence", F.col("rule_tokens")[0].alias("token"))
    beaten = longer.join(shorter, "token").filter(
        (F.size("rule_tokens") < F.size("long")) & (F.size(F.array_except("rule_tokens", "long")) == 0) & (F.col("confidence") >= F.col("sure"))
    )
    kept = found.join(beaten.select(F.col("long").alias("rule_tokens")).distinct(), "rule_tokens", "left_anti")
    by_token = kept.select("rule_tokens", "confidence", F.explode("rule_tokens").alias("token")).join(single, "token")
    return by_token.groupBy("rule_tokens", "confidence").agg(F.min_by("token", F.struct("freq", "token")).alias("filed"))


def url_filter(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, confidence)`` per page.

    ``labels`` has ``page_id`` and ``bad``. Without a fixed rule a page is blocked if a mined rule matches, else
    allowed; ``confidence`` is that of the surest mined rule that matches. A null URL, or one without ``://``, has
    empty host and path and is allowed. Contradicting labels of a page, null labels and ids teach nothing. Repeated
    rows are judged each; other columns are ignored.
    """
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    rule, fixed = rule_of(F.col("host"), F.col("path"))
    rows = saved(
        rows.select("page_id", "host", "path", rule.alias("rule"), fixed.alias("fixed"), tokens(url, F.col("host"), F.col("path")).alias("tokens")),
        "url-tokens",
    )
    agreed = labels.select("page_id", "bad").dropna().groupBy("page_id").agg(F.min("bad").alias("bad"), F.max("bad").alias("most"))
    rules = mine(rows.join(agreed.filter("bad = most"), "page_id").select("tokens", "bad"))
    # The mined verdict depends on the tokens alone, so each set of tokens is looked up once.
    sets = rows.filter("fixed IS NULL").select("tokens").distinct()
    looked_up = sets.withColumn("filed", F.explode("tokens")).join(rules, "filed")
    matched = looked_up.filter(F.size(F.array_except("rule_tokens", "tokens")) == 0).groupBy("tokens").agg(F.max("confidence").alias("confidence"))
    out = rows.join(matched, "tokens", "left")
    mined = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("fixed", mined).alias("verdict"),
        F.when(F.col("fixed").isNull(), F.col("confidence")).alias("confidence"),
    )
