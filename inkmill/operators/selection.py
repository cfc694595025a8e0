"""Keep, reject, deduplicate, identify, split and budget documents.

The functions work on a scored table (see ``score_documents``). Only hashes and ordinals
are shuffled; the text stays where it was staged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.config import CorpusConfig
from inkmill.functions.cleaning import clean_for_model
from inkmill.functions.quality import quality_score, reject_reason, with_text_metrics
from inkmill.operators.ordering import block_starts, with_running_total

META = ["file_id", "title", "author", "date"]


def score_documents(docs: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """Clean, measure, score and judge every document; narrow, one pass over the text.

    Stage the result before filtering on its columns: a filter put right on top is pushed
    below the projections and computes them twice.
    """
    cleaned = docs.select("ordinal", *META, clean_for_model(F.col("text")).alias("cleaned"))
    scored = with_text_metrics(cleaned, "cleaned")
    scored = scored.withColumn("score", quality_score(F.col("metrics")))
    reason = reject_reason(F.col("cleaned"), F.col("metrics"), F.col("score"), cfg)
    scored = scored.withColumn("reason", reason)
    return scored.withColumn(
        "content_hash", F.when(F.col("reason").isNull(), F.sha1("cleaned"))
    )


def first_copies(scored: DataFrame) -> DataFrame:
    """Ordinals of the first document of each content.

    Copies are pre-aggregated to one (hash, ordinal) per task before the shuffle, so a text
    that makes up a third of the corpus costs no more than a rare one.
    """
    passed = scored.where(F.col("reason").isNull())
    return passed.groupBy("content_hash").agg(F.min("ordinal").alias("ordinal")).select("ordinal")


def drop_exact_duplicates(scored: DataFrame) -> DataFrame:
    """Documents that passed the filter and are the first of their content.

    Joined by ordinal, which is unique, not by hash, which may be heavily skewed.
    """
    passed = scored.where(F.col("reason").isNull())
    return passed.join(first_copies(scored), "ordinal", "left_semi")


def exact_duplicates(scored: DataFrame) -> DataFrame:
    """Documents that passed the filter but repeat an earlier one."""
    passed = scored.where(F.col("reason").isNull())
    return passed.join(first_copies(scored), "ordinal", "left_anti")


def stable_doc_id(file_id: Column, title: Column, author: Column, ordinal: Column) -> Column:
    parts = [F.coalesce(c, F.lit("")) for c in (file_id, title, author)]
    return F.sha1(F.concat_ws("|", *parts, ordinal.cast("string")))


def assign_split(doc_id: Column, val_ratio: float) -> Column:
    """``val`` for the share ``val_ratio`` of ids with the smallest hash."""
    head = F.conv(F.substring(F.md5(doc_id), 1, 8), 16, 10).cast("bigint")
    return F.when(head / F.lit(4294967295.0) < val_ratio, "val").otherwise("train")


def with_identity(kept: DataFrame, val_ratio: float) -> DataFrame:
    doc_id = stable_doc_id(*(F.col(c) for c in ("file_id", "title", "author", "ordinal")))
    kept = kept.withColumn("doc_id", doc_id)
    return kept.withColumn("split", assign_split(F.col("doc_id"), val_ratio))


def with_running_chars(kept: DataFrame, block_rows: int = 100_000) -> DataFrame:
    """Characters kept up to and including each kept document (ordinal, chars)."""
    return with_running_total(kept, "chars", "running_chars", block_rows=block_rows)


def budget_cut(kept: DataFrame, target_chars: int, block_rows: int = 100_000) -> int | None:
    """Ordinal of the first kept document at which the budget is reached, or None.

    First the block that crosses the target is found in the small table of block totals;
    only that block is then summed up document by document.
    """
    reached = F.col("_start") + F.col("_block_total") >= target_chars
    crossing = (
        block_starts(kept, "chars", block_rows).where(reached).orderBy("_block").limit(1).first()
    )
    if crossing is None:
        return None
    in_block = (F.col("ordinal") > crossing["_block"] * block_rows) & (
        F.col("ordinal") <= (crossing["_block"] + 1) * block_rows
    )
    running = with_running_chars(kept.where(in_block), block_rows)
    total = F.col("running_chars") + int(crossing["_start"])
    return running.where(total >= target_chars).agg(F.min("ordinal")).first()[0]


def char_budget(kept: DataFrame, target_chars: int) -> DataFrame:
    """Kept documents up to the one that reaches the budget, that one included."""
    cut = budget_cut(kept, target_chars)
    return kept if cut is None else kept.where(F.col("ordinal") <= cut)
