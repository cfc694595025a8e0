import unicodedata
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from inkmill.config import CorpusConfig
from inkmill.functions.quality import (
    METRIC_NAMES,
    metric_reject_reason,
    quality_score,
    reject_reason,
    with_text_metrics,
)
from tests.test_cleaning import random_texts


def metrics_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = with_text_metrics(df, "t", "m").orderBy("i").collect()
    return [r["m"] and r["m"].asDict() for r in rows]


def brute_metrics(text):
    if not text:
        ones = ("short_line_ratio", "headerish_ratio", "blank_line_ratio")
        return {name: 1.0 if name in ones else 0 for name in METRIC_NAMES}
    kinds = Counter(unicodedata.category(ch) for ch in text)
    alpha = sum(n for k, n in kinds.items() if k[0] == "L")
    spaces = [ch for ch in text if ch.isspace()]
    odd = [ch for ch in text if unicodedata.category(ch)[0] not in "LNP" and not ch.isspace()]
    lines = text.split("\n")
    body = [s for s in map(str.strip, lines) if s]
    size = max(len(body), 1)
    copies = Counter(body)

    def head(s):
        short = len(s) < 4 and any(map(str.isdigit, s))
        core = s.removesuffix(".")
        return (
            short
            or (core and not core.strip("IVXLCDM"))
            or (len(s) > 3 and not s.strip("-_=*·•~ "))
            or all(unicodedata.category(ch) == "Nd" for ch in s)
        )

    n = len(text)
    return {
        "chars": n,
        "alpha_ratio": alpha / n,
        "digit_ratio": sum(map(str.isdigit, text)) / n,
        "space_ratio": len(spaces) / n,
        "upper_ratio": kinds["Lu"] / alpha if alpha else 0.0,
        "weird_ratio": len(odd) / n,
        "short_line_ratio": sum(len(s) < 4 for s in body) / size,
        "headerish_ratio": sum(bool(head(s)) for s in body) / size,
        "repeated_line_ratio": sum(v for v in copies.values() if v > 1) / size,
        "blank_line_ratio": 1.0 - len(body) / len(lines),
        "line_count": len(lines),
    }


def test_metrics_equal_brute_force(spark):
    texts = [
        "", " ", "\n\n", "x²③", "a\U0001f600b", "ab\nab\nc", "ab\nab\nab", "ǅAⅫ",
        "a b", "MIL\n12\n----\nabc",
    ] + random_texts(300, seed=8)
    assert metrics_of(spark, texts) == [brute_metrics(t) for t in texts]


def test_null_text_has_no_metrics(spark):
    assert metrics_of(spark, [None]) == [None]


def row(**values):
    base = dict.fromkeys(METRIC_NAMES, 0.0) | {"chars": 10_000, "line_count": 5, "alpha_ratio": 0.8}
    return Row(**(base | values))


def judge(spark, metrics, **cfg):
    schema = "struct<" + ",".join(
        f"{n}:{'bigint' if n in ('chars', 'line_count') else 'double'}" for n in METRIC_NAMES
    ) + ">"
    df = spark.createDataFrame([(metrics,)], f"m {schema}")
    score = quality_score(F.col("m"))
    got = df.select(
        score.alias("s"),
        metric_reject_reason(F.col("m"), CorpusConfig(**cfg)).alias("r"),
        reject_reason(F.lit("x"), F.col("m"), score, CorpusConfig(**cfg)).alias("all"),
    ).first()
    return got


@pytest.mark.parametrize(
    "values, reason",
    [
        ({"chars": 1999}, "too_short"),
        ({"chars": 2000}, None),
        ({"alpha_ratio": 0.5499}, "low_alpha_ratio"),
        ({"alpha_ratio": 0.55}, None),
        ({"weird_ratio": 0.0801}, "too_many_weird_chars"),
        ({"weird_ratio": 0.08}, None),
        ({"short_line_ratio": 0.351}, "too_many_short_lines"),
        ({"short_line_ratio": 0.35}, None),
        ({"headerish_ratio": 0.201}, "too_many_headerish_lines"),
        ({"headerish_ratio": 0.20}, None),
        ({"repeated_line_ratio": 0.201}, "too_many_repeated_lines"),
        ({"repeated_line_ratio": 0.20}, None),
        ({"chars": 10, "alpha_ratio": 0.0}, "too_short"),
    ],
)
def test_first_failed_threshold(spark, values, reason):
    assert judge(spark, row(**values))["r"] == reason


def test_score_terms(spark):
    assert judge(spark, row())["s"] == 0.5 + 3.0 * 0.8
    assert judge(spark, row(chars=100_000))["s"] == 2.5 + 3.0 * 0.8
    shouting = dict(alpha_ratio=0.8, upper_ratio=0.46)
    assert judge(spark, row(chars=5000, **shouting))["s"] == pytest.approx(0.25 + 2.4)
    assert judge(spark, row(chars=5001, **shouting))["s"] == pytest.approx(5001 / 20000 + 2.4 - 1.5)
    assert judge(spark, row(blank_line_ratio=0.36))["s"] == pytest.approx(1.9)
    assert judge(spark, row(blank_line_ratio=0.35))["s"] == pytest.approx(2.9)


def test_score_gate_comes_last(spark):
    got = judge(spark, row(), min_score=3.0)
    assert got["r"] is None and got["all"] == "low_quality_score"
    assert judge(spark, row(chars=5), min_score=3.0)["all"] == "too_short"
