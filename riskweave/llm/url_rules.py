"""URL filter: association rules mined from labelled pages, matched by an inverted index.

URLs become token sets (host labels, path words, query keys).  Spark's FP-growth mines token
combinations together with the label of the page; combinations that point to the bad label with
enough support and confidence, and with no shorter combination that does so already, become block
rules.  Each rule is posted under its rarest token only, so a page meets a rule when it has that
token; the other tokens are then verified.  Fixed host/path rules are judged first.

Null and odd URLs: null or no ``://`` gives an empty host and path, no token and so no mined rule.
Repeated rows give repeated results; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import ascii_lower

BAD = "@bad"
HostRule = tuple[str, str, str]  # host, path, verdict


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    """Sorted distinct tokens: host labels, path words without digits, query keys."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host, path = url_parts(url)
    query = F.regexp_extract(text, "\\?([^#]*)", 1)
    keys = F.regexp_extract_all(query, F.lit("([^&=]+)=?[^&]*"), 1)
    tokens = F.concat(
        F.transform(F.split(host, "\\."), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(F.regexp_extract_all(path, F.lit("[^/.\\-_0-9]+"), 0), lambda x: F.concat(F.lit("path:"), ascii_lower(x))),
        F.transform(keys, lambda x: F.concat(F.lit("key:"), x)),
    )
    known = F.filter(tokens, lambda x: ~x.isin("host:", "path:", "key:"))
    return F.array_sort(F.array_distinct(F.when(host == "", F.array().cast("array<string>")).otherwise(known)))


def host_rule(host: Column, path: Column, rules: Sequence[HostRule]) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null.

    ``rules`` is a parameter list, not data: it is part of the expression.
    """
    fitting = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in rules
    ]
    return F.array_max(F.array(*fitting)) if fitting else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def least_confidence(hits: Column, rows: Column, z: float = 1.96) -> Column:
    """Lower end of the Wilson interval of a share of ``hits`` among ``rows``."""
    share, spread = hits / rows, z * z / rows
    return (share + spread / 2 - z * F.sqrt((share * (1 - share) + spread / 4) / rows)) / (1 + spread)


def mine_rules(
    labelled: DataFrame, url_col: str = "url", bad_col: str = "bad",
    min_support: float = 0.01, min_confidence: float = 0.6, certain: float = 0.5,
) -> DataFrame:
    """Block rules (rule_id, items, post, confidence, support) from rows with a URL and a 0/1 label.

    ``min_support`` is a share of the labelled rows, so the number of frequent combinations is
    bounded however many rows there are.  A combination of any length counts if the lower end of the
    95 % interval of its confidence (Wilson) also reaches ``certain``: many rows may prove what a
    handful cannot, by the same rule for every number of rows.  An empty input gives no rule.
    """
    spark = labelled.sparkSession
    items = labelled.select(
        F.when(F.col(bad_col) == 1, F.array_append(url_tokens(F.col(url_col)), F.lit(BAD)))
        .otherwise(url_tokens(F.col(url_col))).alias("items")
    ).filter(F.size("items") > 0)
    schema = T.StructType([
        T.StructField("rule_id", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("post", T.StringType()), T.StructField("confidence", T.DoubleType()),
        T.StructField("support", T.DoubleType()),
    ])
    rows = items.count()
    if not rows:
        return spark.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    bad = F.round(F.col("support") * rows)
    found = model.associationRules.filter(F.array_contains("consequent", BAD)).filter(
        least_confidence(bad, F.round(bad / F.col("confidence"))) >= certain
    ).select(F.array_sort("antecedent").alias("items"), "confidence", "support")
    single = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    return _prune(found, single)


def _prune(found: DataFrame, single: DataFrame) -> DataFrame:
    """Drop rules that contain the items of a shorter rule; post each rule under its rarest token."""
    rules = found.withColumn("rule_id", F.xxhash64("items"))
    post = (
        rules.select("rule_id", F.explode("items").alias("token")).join(single, "token")
        .groupBy("rule_id").agg(F.min(F.struct("freq", "token"))["token"].alias("post"))
    )
    posted = rules.join(post, "rule_id")
    shorter = posted.select(F.col("items").alias("few"), F.col("post").alias("token"))
    wider = (
        posted.select("rule_id", "items", F.explode("items").alias("token")).join(shorter, "token")
        .filter((F.size("few") < F.size("items")) & (F.size(F.array_except("few", "items")) == 0))
        .select("rule_id").distinct()
    )
    return posted.join(wider, "rule_id", "left_anti").select("rule_id", "items", "post", "confidence", "support")


def match_rules(pages: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct URLs (``_url``) that have all tokens of at least one rule."""
    posted = pages.select(F.col(url_col).cast("string").alias("_url")).distinct().select("_url", url_tokens(F.col("_url")).alias("_tokens"))
    return (
        posted.select("_url", "_tokens", F.explode("_tokens").alias("post"))
        .join(rules.select("post", "items"), "post")
        .filter(F.size(F.array_except("items", "_tokens")) == 0)
        .select("_url").distinct()
    )


def filter_urls(
    pages: DataFrame, rules: DataFrame, host_rules: Sequence[HostRule] = (),
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict): the fixed rule's verdict, else block where a mined rule matches."""
    host, path = url_parts(F.col("_url"))
    rows = pages.select(F.col(id_col).alias(id_col), F.col(url_col).cast("string").alias("_url"))
    hit = match_rules(pages, rules, url_col).withColumn("_hit", F.lit(True))
    fixed = host_rule(F.col("host"), F.col("path"), host_rules)
    return (
        rows.join(hit, "_url", "left")
        .select(id_col, host.alias("host"), path.alias("path"), "_hit")
        .withColumn("_fixed", fixed)
        .select(
            id_col, "host", "path", F.col("_fixed.rule").alias("rule"),
            F.coalesce(F.col("_fixed.verdict"), F.when(F.col("_hit"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        )
    )
