"""Time the headline jobs on one machine; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default the largest test set), ``BENCH_CPUS`` (default 8).
Every job is run to the end (``noop`` sink), after one untimed run on the smallest test set
that warms up the JVM and the Python workers.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import queries as q
from inkmill.functions.cleaning import clean_for_model
from inkmill.operators import evaluation, profile
from inkmill.operators.bpe import BpeModel, learn_bpe, word_counts
from inkmill.operators.tokens import tokenize
from inkmill.plans.corpus_build import build_corpus
from inkmill.plans.token_dataset import encode_corpus
from inkmill.operators.selection import with_identity


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def jobs(spark: SparkSession, sf: str):
    """Name and thunk of each timed job, in order; later ones use the model learned before."""
    state: dict[str, BpeModel] = {}

    def learn() -> None:
        state["model"] = learn_bpe(word_counts(q.documents(spark, sf)), q.VOCAB)

    def encode() -> None:
        run(tokenize(q.documents(spark, sf), state["model"]).select("ordinal", "ids"))

    def bigrams() -> None:
        docs = with_identity(q.documents(spark, sf), q.VAL_RATIO)
        data = encode_corpus(docs, state["model"], q.BLOCK)
        train = data.tokens.where(F.col("split") == "train")
        run(evaluation.stream_pairs(train))

    def build() -> None:
        result = build_corpus(q.documents(spark, sf), q.DEFAULT)
        run(result.summary)
        run(result.corpus)
        run(result.kept_report)

    yield "clean", lambda: run(q.documents(spark, sf).select(clean_for_model(F.col("text"))))
    yield "score", lambda: run(q.scored(spark, sf).drop("cleaned"))
    yield "corpus_build", build
    yield "profile", lambda: run(profile.profile(q.profile_rows(spark, sf)))
    yield "word_counts", lambda: run(word_counts(q.documents(spark, sf)))
    yield "bpe_300", learn
    yield "encode", encode
    yield "bigrams", bigrams


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    for name, job in jobs(spark, warm if os.path.isdir(warm) else sf):
        job()
    seconds = {}
    for name, job in jobs(spark, sf):
        began = time.time()
        job()
        seconds[name] = round(time.time() - began, 3)
    chars = spark.read.parquet(f"{sf}/documents.parquet").agg(F.sum(F.length("text"))).first()[0]
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf,
                "cpus": cpus,
                "input_chars": chars,
                "build_chars_per_second": round(chars / seconds["corpus_build"]),
                "encode_chars_per_second": round(chars / seconds["encode"]),
            }
        )
    )


if __name__ == "__main__":
    main()
