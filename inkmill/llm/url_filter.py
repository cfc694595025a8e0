"""URL filter by character language-model ratio; built-in functions only.

Host rules (longest first) decide some URLs; those are also the training texts of two smoothed
Markov models, one of accepted and one of rejected URLs. A model mixes orders 1 to ``ORDER``: the
probability of a character after a context is (count + MASS * lower order) / (context + MASS), so
rare contexts lean on shorter ones. The score of a URL is the mean over its characters of the
log ratio of the two models, in millionths; the cut is the one with the best balanced accuracy
on the training texts. Other URLs are accepted at the cut and above.

Characters are folded to ``a`` to ``z``, one digit, ``. / _ -``, and one sign for all others, so
there are at most 33 ** ORDER (1.2 million) n-grams: that bounds the broadcast model.

Defined cases: a null URL or one without ``://`` has empty host and path, and scores 0, as every
URL does if a class has no training text; the cut is then 0 and they are accepted. Repeated
URLs count as often as they occur. All columns of the input are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.staging import stage

ORDER = 4
MASS = 2.0
BINS = 4_001
_BIN_WIDTH = 5_000  # millionths
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_START = "^"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct of rule and verdict of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = (host == rule_host) | host.endswith("." + rule_host)
        fits &= path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def folded(host: Column, path: Column) -> Column:
    lowered = F.translate(F.concat(host, path), _UPPER + "0123456789", _UPPER.lower() + "0" * 10)
    return F.regexp_replace(lowered, r"(?s)[^a-z0._/\-]", "~")


def grams(text: str) -> Column:
    padded = F.concat(F.lit(_START * (ORDER - 1)), F.col(text))
    places = F.sequence(F.lit(1), F.length(text))
    at = F.transform(places, lambda i: F.substring(padded, i, F.lit(ORDER)))
    return F.when(F.length(text) > 0, at).otherwise(F.array().cast("array<string>"))


def gram_ratios(texts: DataFrame) -> DataFrame:
    """gram, ratio (log, millionths) for the n-grams of ``texts`` (text, good, bad counts)."""
    each = texts.select(F.explode(grams("text")).alias("gram"), "good", "bad")
    table = each.groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    table = stage(table, "grams")  # bounded by the alphabet
    for k in range(1, ORDER + 1):
        end, context = F.substring("gram", ORDER - k + 1, k), F.substring("gram", ORDER - k + 1, k - 1)
        table = table.withColumn(f"e{k}", end).withColumn(f"c{k}", context)
    counted = table
    for key in [f"{kind}{k}" for k in range(1, ORDER + 1) for kind in "ec"]:
        sums = counted.groupBy(key).agg(F.sum("good").alias(f"good_{key}"), F.sum("bad").alias(f"bad_{key}"))
        table = table.join(F.broadcast(sums), key)

    def probability(side: str) -> Column:
        p = F.lit(1.0 / 32)
        for k in range(1, ORDER + 1):
            p = (F.col(f"{side}_e{k}") + MASS * p) / (F.col(f"{side}_c{k}") + MASS)
        return p

    ratio = F.round(F.log(probability("good") / probability("bad")) * 1_000_000).cast("long")
    return table.select("gram", ratio.alias("ratio"))


def scored(texts: DataFrame, ratios: DataFrame) -> DataFrame:
    """``texts`` (distinct in text) with ``score``: mean ratio over the characters, floored."""
    each = texts.select("text", F.explode(grams("text")).alias("gram"))
    sums = each.join(F.broadcast(ratios), "gram").groupBy("text").agg(F.sum("ratio").alias("sum"))
    joined = texts.join(sums, "text", "left")
    score = F.floor(F.coalesce("sum", F.lit(0)) / F.greatest(F.length("text"), F.lit(1)))
    return joined.withColumn("score", score.cast("long")).drop("sum")


def best_cut(texts: DataFrame) -> int:
    """Lowest bin edge of ``score`` with the best balanced accuracy on good and bad counts."""
    bins = F.least(F.greatest(F.floor(F.col("score") / _BIN_WIDTH), F.lit(-(BINS // 2))), F.lit(BINS // 2))
    table = texts.groupBy(bins.alias("bin")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # BINS rows at most
    everywhere = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    good_below = F.coalesce(F.sum("good").over(below), F.lit(0))
    bad_below = F.coalesce(F.sum("bad").over(below), F.lit(0))
    good_all, bad_all = F.sum("good").over(everywhere), F.sum("bad").over(everywhere)
    # Twice the balanced accuracy times both class sizes, as a whole number.
    gain = (good_all - good_below) * bad_all + bad_below * good_all
    table = table.where("good + bad > 0").select("bin", gain.alias("gain"), (good_all * bad_all).alias("both"))
    best = table.where("both > 0").orderBy(F.desc("gain"), "bin").first()
    return best["bin"] * _BIN_WIDTH if best else 0


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (null where a rule decides)."""
    own = "_url_" + "x" * max(map(len, pages.columns))
    rows = pages.withColumn(own, F.struct(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")))
    host, path = F.col(own)["host"], F.col(own)["path"]
    fit = rule_for(host, path, rules)
    text = folded(host, path)
    plain = rows.select(text.alias("text"), fit["verdict"].alias("label"))
    count = lambda label: F.sum((F.coalesce("label", F.lit("")) == label).cast("long"))
    texts = plain.groupBy("text").agg(count("allow").alias("good"), count("block").alias("bad"))
    texts = stage(texts, "url-texts")
    totals = texts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if totals["good"] and totals["bad"]:
        judged = stage(scored(texts, gram_ratios(texts)), "url-scores")
        cut = best_cut(judged)
    else:
        judged, cut = texts.withColumn("score", F.lit(0).cast("long")), 0
    scores = judged.select(F.col("text").alias(own + "t"), F.col("score").alias(own + "s"))
    joined = rows.withColumn(own + "k", text).join(scores, F.col(own + "k") == F.col(own + "t"))
    given = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score")]
    by_score = F.when(F.col(own + "s") >= cut, "allow").otherwise("block")
    return joined.select(
        *[pages[c] for c in given],
        host.alias("host"),
        path.alias("path"),
        fit["rule"].alias("rule"),
        F.coalesce(fit["verdict"], by_score).alias("verdict"),
        F.when(fit.isNull(), F.col(own + "s")).alias("score"),
    )
