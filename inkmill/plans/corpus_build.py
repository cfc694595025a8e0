"""From raw documents to kept and rejected documents, reports and the summary."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.config import CorpusConfig
from inkmill.operators.selection import (
    META,
    budget_cut,
    drop_exact_duplicates,
    first_copies,
    score_documents,
    with_identity,
)
from inkmill.sources.corpus import corpus_files, read_corpus_files
from inkmill.staging import stage

# Ordinals of dropped copies that may be broadcast (8 bytes each); beyond that the kept
# ordinals are joined by shuffle.
MAX_BROADCAST_ORDINALS = 2_000_000


@dataclass
class CorpusBuild:
    """Results of a corpus build.

    ``scored`` holds every document with its judgement, with its ``cleaned`` text if it passed
    and a ``sample`` of it if not; ``kept`` the identity (no text) of the documents that stay.
    Both are written tables. ``cut`` is the ordinal of the document that reached the character
    budget; nothing behind it is seen by any result. ``files`` are those read, if known.
    """

    scored: DataFrame
    kept: DataFrame
    cut: int | None
    cfg: CorpusConfig
    files: list[str] | None = None

    def _seen(self, df: DataFrame) -> DataFrame:
        return df if self.cut is None else df.where(F.col("ordinal") <= self.cut)

    @cached_property
    def summary(self) -> DataFrame:
        """One row of totals, reject counts and settings."""
        return _summary(self._seen(self.scored), self._seen(self.kept), self.cfg)

    @property
    def kept_identity(self) -> DataFrame:
        return self._seen(self.kept)

    @property
    def rejected_report(self) -> DataFrame:
        """Documents below a threshold; missing texts and exact copies are only counted."""
        judged = self._seen(self.scored)
        return judged.where(F.col("reason") != "missing_text").select(
            "ordinal",
            *["file_id", "title", "author", "date", "reason"],
            F.round("score", 4).alias("score"),
            "metrics",
            "sample",
        )

    @property
    def kept_report(self) -> DataFrame:
        """Kept documents with their metrics, without text."""
        details = self.scored.where(F.col("reason").isNull()).select("ordinal", "score", "metrics")
        return (
            self.kept_identity.join(details, "ordinal")
            .select(
                "ordinal",
                *["doc_id", "file_id", "title", "author", "date", "split", "chars"],
                F.round("score", 4).alias("score"),
                "metrics",
            )
        )

    @property
    def corpus(self) -> DataFrame:
        """Kept documents with text, ready for the train and validation outputs.

        Identity is recomputed from columns beside the text, and copies are taken out by a
        broadcast of their ordinals, so the text is not shuffled. Only if the copies are too
        many is it joined with the kept ordinals.
        """
        passed = self._seen(self.scored).where(F.col("reason").isNull())
        copies = passed.select("ordinal").join(
            self.kept.select("ordinal"), "ordinal", "left_anti"
        )
        if copies.count() <= MAX_BROADCAST_ORDINALS:
            kept = passed.join(F.broadcast(copies), "ordinal", "left_anti")
        else:
            kept = passed.join(self.kept.select("ordinal"), "ordinal", "left_semi")
        return with_identity(kept, self.cfg.val_ratio).select(
            "ordinal",
            "split",
            *["doc_id", "file_id", "title", "author", "date"],
            F.col("cleaned").alias("text"),
            F.col("metrics.chars").alias("chars"),
            F.round("score", 4).alias("quality_score"),
        )


def _summary(scored: DataFrame, kept: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """Copies are what passed the filter but was not kept, so no join is needed."""
    of_split = [
        F.coalesce(F.sum(F.when(F.col("split") == s, F.col("chars"))), F.lit(0)).alias(f"{s}_chars")
        for s in ("train", "val")
    ]
    reasons = scored.groupBy(F.coalesce("reason", F.lit("passed")).alias("reason")).agg(
        F.count("*").alias("n")
    )
    totals = kept.agg(
        F.count("*").alias("kept_docs"), F.coalesce(F.sum("chars"), F.lit(0)).alias("kept_chars"),
        *of_split,
    )
    # At most nine reasons: one small row of counts beside the one row of totals.
    counted = reasons.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_docs_seen"),
        F.coalesce(F.sum(F.when(F.col("reason") == "passed", F.col("n"))), F.lit(0)).alias("passed"),
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.when(F.col("reason") != "passed", F.struct("reason", "n")))
            )
        ).alias("failed"),
    )
    row = totals.withColumn("_one", F.lit(1)).join(counted.withColumn("_one", F.lit(1)), "_one")
    duplicates = F.col("passed") - F.col("kept_docs")
    counts = F.when(
        duplicates > 0,
        F.map_concat("failed", F.create_map(F.lit("exact_duplicate"), duplicates)),
    ).otherwise(F.col("failed"))
    return row.select(
        F.lit(cfg.target_chars).cast("long").alias("target_chars"),
        "kept_chars",
        "train_chars",
        "val_chars",
        "total_docs_seen",
        "kept_docs",
        (F.col("total_docs_seen") - F.col("kept_docs")).alias("rejected_docs"),
        duplicates.alias("duplicate_docs"),
        counts.alias("reject_counts"),
        F.struct(
            F.lit(cfg.min_chars).alias("min_chars"),
            F.lit(cfg.min_alpha_ratio).alias("min_alpha_ratio"),
            F.lit(cfg.max_weird_ratio).alias("max_weird_ratio"),
            F.lit(cfg.min_score).alias("min_score"),
            F.lit(cfg.val_ratio).alias("val_ratio"),
        ).alias("settings"),
    )


def build_corpus(docs: DataFrame, cfg: CorpusConfig, with_text: bool = True) -> CorpusBuild:
    """Judge all documents once, then decide what stays on the thin columns.

    ``with_text=False`` leaves the cleaned text out of the written table when only counts
    and the kept report are wanted.
    """
    scored = _judge(docs, cfg, with_text)
    kept = stage(_keep(scored, cfg), "kept").drop("content_hash")
    return CorpusBuild(scored, kept, budget_cut(kept, cfg.target_chars), cfg)


def build_corpus_in_waves(
    spark: SparkSession,
    folder: str,
    glob: str = "*.parquet",
    cfg: CorpusConfig = CorpusConfig(),
    with_text: bool = True,
    first_files: int = 8,
) -> CorpusBuild:
    """``build_corpus`` of the files in ``folder``, reading no more of them than the budget needs.

    Files are judged in waves, in name order. A wave has at most twice as many files as the
    one before, and no more than the budget seems to need from the characters kept so far.
    From wave to wave go the number of rows (so ordinals run on), the characters kept, and the
    written hashes of kept documents, which are unique, so that joining them has no hot key.
    The result equals that of the whole folder.
    """
    paths = corpus_files(spark, folder, glob)
    waves: list[tuple[DataFrame, DataFrame]] = []
    read = rows = chars = 0
    size, cut = max(1, first_files), None
    while read < len(paths) and cut is None:
        docs = read_corpus_files(spark, paths[read : read + size], cfg.columns)
        read = min(read + size, len(paths))
        scored = _judge(docs.withColumn("ordinal", F.col("ordinal") + rows), cfg, with_text)
        kept = _keep(scored, cfg)
        if waves:
            earlier = _all([k for _, k in waves]).select("content_hash")
            kept = kept.join(earlier, "content_hash", "left_anti")
        kept = stage(kept, "kept")
        waves.append((scored, kept))
        cut = budget_cut(kept, cfg.target_chars - chars)
        rows += scored.count()
        chars += kept.agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0]
        size *= 2
        if chars:  # a tenth more than the kept characters of a file suggest
            size = min(size, max(1, -(-11 * (cfg.target_chars - chars) * read // (10 * chars))))
    kept = _all([k for _, k in waves]).drop("content_hash")
    return CorpusBuild(_all([s for s, _ in waves]), kept, cut, cfg, paths[:read])


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _judge(docs: DataFrame, cfg: CorpusConfig, with_text: bool) -> DataFrame:
    """Judged documents as a written table. Reports need a short sample of rejected texts only."""
    scored = score_documents(docs, cfg)
    if with_text:
        failed = F.col("reason") != "missing_text"
        scored = scored.withColumn("sample", F.when(failed, F.substring("cleaned", 1, 400)))
        scored = scored.withColumn("cleaned", F.when(F.col("reason").isNull(), F.col("cleaned")))
    else:
        scored = scored.drop("cleaned")
    return stage(scored, "scored")


def _keep(scored: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """Identity and content hash of what passed and is the first of its content."""
    thin = scored.select("ordinal", *META, "content_hash", "reason", F.col("metrics.chars").alias("chars"))
    kept = with_identity(drop_exact_duplicates(thin), cfg.val_ratio)
    return kept.select("ordinal", "doc_id", *META, "split", "chars", "content_hash")


__all__ = ["CorpusBuild", "build_corpus", "build_corpus_in_waves", "first_copies"]
