"""Document quality: metrics, score and the first reason to reject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.config import CorpusConfig
from inkmill.functions import unicode_classes as uc
from inkmill.functions.cleaning import header_footer_pattern, strip

METRIC_NAMES = [
    "chars",
    "alpha_ratio",
    "digit_ratio",
    "space_ratio",
    "upper_ratio",
    "weird_ratio",
    "short_line_ratio",
    "headerish_ratio",
    "repeated_line_ratio",
    "blank_line_ratio",
    "line_count",
]


def _without(text: Column, char_class: str) -> Column:
    return F.regexp_replace(text, f"[{char_class}]+", "")


def with_text_metrics(df: DataFrame, text: str, out: str = "metrics") -> DataFrame:
    """Add the eleven-field metrics struct of column ``text``.

    Characters are counted by removing one class after the other: first everything that
    makes up ordinary prose (letters that are not upper-case, blanks, newlines) in long
    runs, then the rest from the little that is left. Lines are kept in one array; repeated
    lines are counted in its sorted copy, made only if there are any.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    n = F.col("_n")

    df = df.select(
        *kept,
        F.length(text).alias("_n"),
        F.split(text, "\n").alias("_lines"),
        F.length(F.replace(F.col(text), F.lit(" "), F.lit(""))).alias("_no_blank"),
        _without(F.col(text), r"\p{L} \n&&\P{Lu}").alias("_r1"),
    )
    df = df.withColumns(
        {
            "_r2": _without(F.col("_r1"), uc.space_class()),
            "_blanks": n - F.col("_no_blank") + F.size("_lines") - 1,
            "_body": F.filter(F.transform("_lines", strip), lambda s: s != ""),
        }
    )
    df = df.withColumn("_r3", _without(F.col("_r2"), r"\p{Lu}"))
    df = df.withColumns(
        {
            "_upper": F.length("_r2") - F.length("_r3"),
            "_alpha": n - F.length("_r1") - F.col("_blanks") + F.length("_r2") - F.length("_r3"),
            "_space": F.col("_blanks") + F.length("_r1") - F.length("_r2"),
            "_digit": F.length("_r3") - F.length(_without(F.col("_r3"), uc.digit_class())),
            "_weird": F.length(_without(F.col("_r3"), r"\p{N}\p{P}")),
            "_sorted": F.when(
                F.size(F.array_distinct("_body")) < F.size("_body"), F.sort_array("_body")
            ),
        }
    )
    repeated = F.coalesce(
        F.size(
            F.filter(
                "_sorted",
                lambda s, i: (s == F.get("_sorted", i - 1)) | (s == F.get("_sorted", i + 1)),
            )
        ),
        F.lit(0),
    )
    header = header_footer_pattern()
    df = df.withColumns(
        {
            "_short": F.size(F.filter("_body", lambda s: F.length(s) < 4)),
            "_header": F.size(F.filter("_body", lambda s: s.rlike(header))),
            "_repeated": F.when(F.col("_sorted").isNull(), 0).otherwise(repeated),
        }
    )

    def share(part: Column, whole: Column) -> Column:
        return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")

    body, lines, empty = F.size("_body"), F.size("_lines"), n == 0
    # The empty text has no lines at all and counts as fully short, headerish and blank.
    fields = {
        "chars": n.cast("long"),
        "alpha_ratio": share(F.col("_alpha"), n),
        "digit_ratio": share(F.col("_digit"), n),
        "space_ratio": share(F.col("_space"), n),
        "upper_ratio": share(F.col("_upper"), F.col("_alpha")),
        "weird_ratio": share(F.col("_weird"), n),
        "short_line_ratio": F.when(empty, 1.0).otherwise(share(F.col("_short"), body)),
        "headerish_ratio": F.when(empty, 1.0).otherwise(share(F.col("_header"), body)),
        "repeated_line_ratio": share(F.col("_repeated"), body),
        "blank_line_ratio": F.when(empty, 1.0).otherwise(F.lit(1.0) - share(body, lines)),
        "line_count": F.when(empty, 0).otherwise(lines).cast("long"),
    }
    metrics = F.struct(*[fields[name].alias(name) for name in METRIC_NAMES])
    return df.select(*kept, F.when(F.col(text).isNotNull(), metrics).alias(out))


def quality_score(m: Column) -> Column:
    """Weighted sum of the metrics, in the fixed term order that makes doubles match."""
    # Weights and cut-offs of the score.
    score = F.least(m["chars"] / F.lit(20000.0), F.lit(2.5))
    score = score + 3.0 * m["alpha_ratio"]
    for weight, name in (
        (8.0, "weird_ratio"),
        (2.5, "digit_ratio"),
        (2.0, "short_line_ratio"),
        (3.0, "headerish_ratio"),
        (2.0, "repeated_line_ratio"),
    ):
        score = score - weight * m[name]
    shouting = (m["chars"] > 5000) & (m["upper_ratio"] > 0.45)
    score = score - F.when(shouting, 1.5).otherwise(0.0)
    return score - F.when(m["blank_line_ratio"] > 0.35, 1.0).otherwise(0.0)


def metric_reject_reason(m: Column, cfg: CorpusConfig) -> Column:
    """First failed threshold in fixed order, or null."""
    return (
        F.when(m["chars"] < cfg.min_chars, "too_short")
        .when(m["alpha_ratio"] < cfg.min_alpha_ratio, "low_alpha_ratio")
        .when(m["weird_ratio"] > cfg.max_weird_ratio, "too_many_weird_chars")
        .when(m["short_line_ratio"] > 0.35, "too_many_short_lines")
        .when(m["headerish_ratio"] > 0.20, "too_many_headerish_lines")
        .when(m["repeated_line_ratio"] > 0.20, "too_many_repeated_lines")
    )


def reject_reason(text: Column, m: Column, score: Column, cfg: CorpusConfig) -> Column:
    """Missing text first, then the metric thresholds, then the score."""
    return (
        F.when(text.isNull(), "missing_text")
        .when(metric_reject_reason(m, cfg).isNotNull(), metric_reject_reason(m, cfg))
        .when(score < cfg.min_score, "low_quality_score")
    )
