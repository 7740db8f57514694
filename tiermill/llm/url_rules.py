"""URL filters: curated rules, and association rules that FP-growth mines from the URLs those rules decide.

Only DataFrame and ML operations.  Labelled URLs become token sets (scheme, host labels, path segments, query keys, digits
folded); FP-growth finds frequent sets, and sets that imply a label with enough support and confidence become rules.  An
inverted index lists each rule under the rarest of its tokens, so a URL meets only rules it shares that token with.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.plans.staging import stage

MIN_SUPPORT = 0.005  # share of the labelled URLs a token set needs
MIN_COUNT = 5  # and their least number
MIN_CONFIDENCE = 0.8  # share of the URLs with the tokens that bear the label
LABEL = "="  # prefix of the item that stands for the label


def with_parts(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path``: what follows the first ``://``; both empty without it or for a null url."""
    part = lambda k: F.coalesce(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return pages.withColumns({"host": F.translate(part(1), ascii_uppercase, ascii_lowercase), "path": part(2)})


def curated(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule text or null, its verdict or null) of a row with host and path.

    A rule is (verdict, "host/path"): it fits the host and its subdomains when the path starts with its path.  The
    longest fitting rule decides; of equally long ones the smaller text.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        name, verdict = F.when(fits, F.lit(text)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def tokens() -> Column:
    """The sorted set of tokens of a row with url, host and path; digits are folded to one 0."""
    fold = lambda kind: lambda x: F.concat(F.lit(kind), F.regexp_replace(x, "[0-9]+", "0"))
    filled = lambda text, by: F.filter(F.split(text, by), lambda x: x != "")
    query = F.coalesce(F.regexp_extract("url", r"\?([^#]*)", 1), F.lit(""))
    scheme = F.regexp_extract(F.coalesce("url", F.lit("")), r"^([A-Za-z0-9+.-]*)://", 1)
    return F.array_sort(
        F.array_distinct(
            F.concat(
                F.transform(F.filter(F.array(scheme), lambda x: x != ""), fold("s:")),
                F.transform(filled("host", r"\."), fold("h:")),
                F.transform(filled("path", "/"), fold("p:")),
                F.transform(filled(query, "&"), lambda x: fold("q:")(F.substring_index(x, "=", 1))),
            )
        )
    )


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules (antecedent, verdict, confidence, support) from rows with ``tokens`` and ``verdict``; all rows count.

    Without labelled rows there are no rules.  A rule is left out when a part of its tokens already implies the verdict
    with at least its confidence through one token less.
    """
    spark = labelled.sparkSession
    n = labelled.count()
    schema = "antecedent array<string>, verdict string, confidence double, support double"
    if n == 0:
        return spark.createDataFrame([], schema)
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items"))
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, max(min_support, min_count / n)), minConfidence=min_confidence
    ).fit(items)
    is_label = lambda x: x.startswith(LABEL)
    rules = model.associationRules.where(
        is_label(F.col("consequent")[0]) & ~F.exists("antecedent", is_label)
    ).select(
        F.array_sort("antecedent").alias("antecedent"),
        F.expr(f"substring(consequent[0], {len(LABEL) + 1})").alias("verdict"),
        "confidence",
        "support",
    )
    rules = stage(rules, "url-rules")
    shorter = rules.select(
        "verdict", "confidence", F.explode("antecedent").alias("gone"), F.col("antecedent").alias("longer")
    ).select("verdict", "confidence", "longer", F.array_remove("longer", F.col("gone")).alias("antecedent"))
    known = rules.select("antecedent", "verdict", F.col("confidence").alias("known"))
    implied = shorter.join(known, ["antecedent", "verdict"]).where("known >= confidence")
    implied = implied.select(F.col("longer").alias("antecedent"), "verdict").distinct()
    return rules.join(implied, ["antecedent", "verdict"], "left_anti").select("antecedent", "verdict", "confidence", "support")


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (distinct ``tokens``) with the verdict of their best rule: the most confident, then most supported, then
    longest one; ties go to block.  Token sets that no rule fits are left out."""
    listed = rules.withColumn("rule", F.array_join("antecedent", "\x1f"))
    common = urls.select(F.explode("tokens").alias("token")).groupBy("token").count()
    places = listed.select("*", F.explode("antecedent").alias("token")).join(common, "token")
    index = places.groupBy("rule", "verdict").agg(
        F.min_by("token", F.struct("count", "token")).alias("token"),
        F.first("antecedent").alias("antecedent"),
        F.first("confidence").alias("confidence"),
        F.first("support").alias("support"),
    )
    met = urls.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    met = met.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.size("antecedent").alias("size"), "verdict", "rule"))
    return met.groupBy("tokens").agg(best.alias("best")).select(
        "tokens", F.col("best.verdict").alias("mined"), F.col("best.rule").alias("mined_rule"), F.col("best.confidence").alias("confidence")
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    min_support: float = MIN_SUPPORT,
    min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """One row per page: page_id, host, path, ``rule`` (the curated rule or null), ``verdict``, and the mined rule.

    URLs that a curated rule decides are the labelled ones that FP-growth learns from.  Every other URL gets the verdict
    of its best mined rule, or ``allow`` when none fits.  Null urls have empty host and path, fit no rule and are
    allowed.  Repeated rows are judged one by one; other columns are ignored; an empty table gives an empty result.
    """
    parts = with_parts(pages.select("page_id", "url"))
    rule, verdict = curated(rules)
    parts = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), tokens().alias("tokens"))
    mined = mine(
        parts.where("ruled is not null").select("tokens", F.col("ruled").alias("verdict")), min_support, min_count, min_confidence
    )
    open_sets = parts.where("ruled is null").select("tokens").distinct()  # many URLs share a token set
    judged = judge(open_sets, mined)
    return (
        parts.join(judged, "tokens", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("ruled", "mined", F.lit("allow")).alias("verdict"),
            F.when(F.col("ruled").isNull(), F.col("mined_rule")).alias("mined_rule"),
            F.when(F.col("ruled").isNull(), F.col("confidence")).alias("confidence"),
        )
    )
