"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.settings import (
    ADD_K,
    BLOCK,
    BUDGET,
    DRAWS,
    LIMIT,
    MIN_CHARS,
    SEED,
    SHARD,
    STRIDE,
    TEMPERATURE,
    TOP_K,
    VAL_RATIO,
    VOCAB,
    WHOLE,
    WINDOWS,
)
from checks.worn import gaps, listed, worn
from inkmill import ColumnMap, CorpusConfig
from inkmill.functions import cleaning
from inkmill.functions.pretokens import pretokens, symbol_id
from inkmill.functions.quality import METRIC_NAMES, with_text_metrics
from inkmill.operators import evaluation, profile, selection
from inkmill.operators.bpe import BpeModel, learn_bpe, pair_counts, word_counts, word_symbols
from inkmill.operators.codec import decode, encode, round_trip
from inkmill.operators.tokens import (
    append_eos,
    encode_stats,
    eos_id,
    token_dtype,
    token_windows,
    tokenize,
    with_offsets,
)
from inkmill.plans.corpus_build import CorpusBuild, build_corpus, build_corpus_in_waves
from inkmill.plans.token_dataset import (
    TokenDataset,
    encode_corpus,
    evaluate_splits,
    train_tokenizer,
    write_token_bins,
)
from inkmill.sources import corpus as src
from inkmill.sources import corpus_files, tokenbin, tokenizer_files
from inkmill.staging import spread, stage, staging_path

Query = Callable[[SparkSession, str], DataFrame]

COLUMNS = ColumnMap(text="text", file_id="doc_id", title="source", author="lang", date=None)
DEFAULT = CorpusConfig(columns=COLUMNS)
LOOSE = CorpusConfig(
    columns=COLUMNS, min_chars=MIN_CHARS, target_chars=WHOLE, val_ratio=VAL_RATIO
)
CUT = replace(LOOSE, target_chars=BUDGET)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return src.read_corpus(spark, sf, "documents.parquet", COLUMNS)


def worn_documents(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with defects, some lists of words, some null and some empty."""
    key = F.col("file_id").cast("long")
    text = gaps(worn(listed(F.col("text"), key)), key)
    return documents(spark, sf).withColumn("text", text)


def scored(spark: SparkSession, sf: str, cfg: CorpusConfig = LOOSE) -> DataFrame:
    return selection.score_documents(documents(spark, sf), cfg)


def judged(spark: SparkSession, sf: str, cfg: CorpusConfig) -> DataFrame:
    return selection.score_documents(worn_documents(spark, sf), cfg).select("ordinal", "reason")


def build(spark: SparkSession, sf: str, with_text: bool = False) -> CorpusBuild:
    return build_corpus(documents(spark, sf), LOOSE, with_text)


def each_document(step: Callable[[Column], Column]) -> Query:
    return lambda spark, sf: worn_documents(spark, sf).select(
        "ordinal", step(F.col("text")).alias("text")
    )


def each_page(step: Callable[[Column], Column]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        pages = spread(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id")
        html = gaps(worn(F.col("html")), F.col("page_id"))
        return pages.select("page_id", step(html).alias("text"))

    return run


def flat_metrics(df: DataFrame, *before: str | Column, after: tuple = ()) -> DataFrame:
    return df.select(*before, *[F.col(f"metrics.{m}").alias(m) for m in METRIC_NAMES], *after)


def joined(ids: str) -> Column:
    return F.array_join(F.col(ids).cast("array<string>"), ",").alias(ids)


# --- sources and sinks ---------------------------------------------------------------------


def jsonl_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as JSON lines to several files, read back in order."""
    docs = documents(spark, sf)
    sizes = docs.select("ordinal", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    quarter = -(-sizes.agg(F.sum("chars")).first()[0] // 4)
    path = staging_path(spark, "jsonl")
    ordered = corpus_files.in_scan_order(docs, sizes, quarter).sortWithinPartitions("ordinal")
    ordered.drop("ordinal").write.json(path)
    return src.read_jsonl_texts(spark, path)


def jsonl_line_count(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark, "jsonl")
    documents(spark, sf).write.json(path)
    return src.count_lines(spark, path)


def written_corpus(spark: SparkSession, sf: str) -> tuple[CorpusBuild, str]:
    result = build(spark, sf, with_text=True)
    folder = staging_path(spark, "corpus")
    corpus_files.write_corpus(result, folder, write_rejected=True)
    return result, folder


def corpus_output(spark: SparkSession, sf: str) -> DataFrame:
    result, folder = written_corpus(spark, sf)
    schema = result.corpus.drop("ordinal", "split").schema
    parts = [
        spark.read.schema(schema).json(f"{folder}/corpus/split={s}").withColumn("split", F.lit(s))
        for s in ("train", "val")
    ]
    return parts[0].unionByName(parts[1])


def many_files(spark: SparkSession, sf: str, n: int = 16) -> str:
    """The documents written again as ``n`` files in the order of their ordinals."""
    docs = documents(spark, sf)
    sizes = docs.select("ordinal", F.lit(1).alias("chars"))
    path = staging_path(spark, "many-files")
    ordered = corpus_files.in_scan_order(docs, sizes, -(-sizes.count() // n))
    ordered.sortWithinPartitions("ordinal").drop("ordinal").write.parquet(path)
    return path


def summary_in_waves(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a build that stops reading files when its budget is reached."""
    cfg = replace(CUT, columns=ColumnMap(text="text"))
    result = build_corpus_in_waves(spark, many_files(spark, sf), cfg=cfg, with_text=False, first_files=2)
    return result.summary.drop("reject_counts", "settings")


def kept_report_output(spark: SparkSession, sf: str) -> DataFrame:
    result, folder = written_corpus(spark, sf)
    schema = result.kept_report.drop("ordinal").schema
    return kept_columns(spark.read.schema(schema).json(f"{folder}/kept_report"))


def rejected_report_output(spark: SparkSession, sf: str) -> DataFrame:
    result, folder = written_corpus(spark, sf)
    schema = result.rejected_report.drop("ordinal").schema
    return rejected_columns(spark.read.schema(schema).json(f"{folder}/rejected_report"))


def kept_columns(report: DataFrame) -> DataFrame:
    # chars stands in the report itself and in its metrics
    report = report.drop("chars")
    return flat_metrics(report, "doc_id", "file_id", "title", "author", "date", "split", "score")


def rejected_columns(report: DataFrame) -> DataFrame:
    meta = ("file_id", "title", "author", "date", "reason", "score")
    return flat_metrics(report, *meta, after=("sample",))


def summary_output(spark: SparkSession, sf: str) -> DataFrame:
    result, folder = written_corpus(spark, sf)
    summary = spark.read.schema(result.summary.schema).json(f"{folder}/summary")
    return summary.drop("reject_counts", "settings")


def token_bin_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as plain byte tokens through the binary format and back."""
    tokenbin.register(spark)
    tokens = stage(
        tokenize(documents(spark, sf), BpeModel()).select("ordinal", "ids", "n_tokens"), "tokens"
    )
    path = staging_path(spark, "bin")
    placed = with_offsets(tokens, block_rows=100).select("start_offset", "ids")
    placed.write.format("tokenbin").option("dtype", "uint16").mode("append").save(path)
    back = spark.read.format("tokenbin").load(path)
    ids = back.select(F.posexplode("ids").alias("i", "id"), "start_offset")
    width = tokenbin.TOKENS_PER_ROW
    chunk = F.floor((F.col("start_offset") + F.col("i")) / width) * width
    return ids.groupBy(chunk.alias("start_offset")).agg(
        F.count("*").alias("n_tokens"), F.sum("id").alias("id_sum")
    )


def tokenizer_files_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A learned tokenizer saved and loaded in both forms; its merges as read back."""
    model = learned(spark, sf)
    tables, folder = staging_path(spark, "tokenizer"), staging_path(spark, "tokenizer-files")
    tokenizer_files.save_tables(spark, model, tables)
    loaded = tokenizer_files.load_tables(spark, tables)
    tokenizer_files.save_files(loaded, folder)
    again = tokenizer_files.load_files(folder)
    again.counts = loaded.counts
    return tokenizer_files.merges_table(spark, again)


def dtype_by_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Token type a word-level vocabulary would need, per language and over all."""
    words = documents(spark, sf).select(
        F.explode(F.array(F.col("author"), F.lit("all"))).alias("lang"),
        pretokens(cleaning.nfc(F.col("text"))).alias("words"),
    )
    distinct = words.select("lang", F.explode("words").alias("word")).distinct()
    sizes = distinct.groupBy("lang").agg((F.count("*") + 260).alias("vocab_size"))
    return sizes.withColumn("dtype", token_dtype(F.col("vocab_size")))


# --- cleaning and quality ------------------------------------------------------------------


def line_flags(flag: Callable[[Column], Column], name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        docs = spread(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), "doc_id")
        lines = F.split(worn(F.col("text")), "\n")
        return docs.select(
            "doc_id", F.size(lines).alias("lines"), F.size(F.filter(lines, flag)).alias(name)
        )

    return run


def text_metrics_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id")
    pages = pages.withColumnRenamed("page_id", "ordinal")
    return flat_metrics(with_text_metrics(pages, "html"), "ordinal")


# --- selection -----------------------------------------------------------------------------


def thin(spark: SparkSession, sf: str) -> DataFrame:
    return stage(scored(spark, sf).drop("cleaned"), "scored")


def identified(spark: SparkSession, sf: str) -> DataFrame:
    kept = selection.drop_exact_duplicates(thin(spark, sf))
    return selection.with_identity(kept, VAL_RATIO)


def kept_chars(spark: SparkSession, sf: str) -> DataFrame:
    kept = selection.drop_exact_duplicates(thin(spark, sf))
    return stage(kept.select("ordinal", F.col("metrics.chars").alias("chars")), "kept")


def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = build(spark, sf).summary.select(F.explode("reject_counts").alias("reason", "n"))
    return counts.select("reason", "n")


# --- profile -------------------------------------------------------------------------------


def profile_rows(spark: SparkSession, sf: str, glob: str = "documents.parquet") -> DataFrame:
    return profile.read_for_profile(spark, sf, glob, "text")


def text_column_detection(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, documents and characters of every table that has a text column to detect."""
    names = ["documents", "benchmark", "conversations", "region", "nation", "labels", "part"]
    found = []
    for name in names:
        table = spark.read.parquet(f"{sf}/{name}.parquet")
        try:
            column = profile.detect_text_column(table.schema)
        except ValueError:
            column = None
        chars = F.sum(F.length(column)) if column else F.lit(None)
        found.append(
            table.agg(F.count("*").alias("rows"), chars.cast("long").alias("chars")).select(
                F.lit(name).alias("table"), F.lit(column).alias("text_column"), "rows", "chars"
            )
        )
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def profile_folder(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a folder one by one; files without one clear text column count as failed."""
    result = profile.profile_folder(spark, sf, "*o*.parquet")
    return result.total.select(
        "files", F.lit(result.failed.count()).alias("failed"), "rows", "chars", "unique_chars"
    )


# --- tokenizer -----------------------------------------------------------------------------


def learned(spark: SparkSession, sf: str) -> BpeModel:
    return learn_bpe(word_counts(documents(spark, sf)), VOCAB)


def first_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = pair_counts(word_symbols(word_counts(documents(spark, sf))))

    def id_at(i: int) -> Column:
        # Ids of single bytes lie below the surrogates, where code point and id differ by a constant.
        offset = 0 - symbol_id("\0")
        code = F.conv(F.hex(F.encode(F.substring("pair", i, 1), "UTF-16BE")), 16, 10)
        return code.cast("int") - offset

    return pairs.select(id_at(1).alias("left_id"), id_at(2).alias("right_id"), "n")


def bpe_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    vocab = tokenizer_files.vocab_table(spark, learned(spark, sf))
    return vocab.select("id", F.hex("bytes").alias("bytes_hex"))


def tokenizer_report(spark: SparkSession, sf: str) -> DataFrame:
    size = src.corpus_size(documents(spark, sf))
    report = tokenizer_files.tokenizer_report(size, learned(spark, sf), 2, "documents")
    return report.drop("special_tokens", "input")


def trained_files(spark: SparkSession, sf: str) -> DataFrame:
    """The report beside the files of a tokenizer trained on the first documents with a text."""
    folder = staging_path(spark, "trained")
    docs = documents(spark, sf)
    gapped = docs.withColumn("text", gaps(F.col("text"), F.col("file_id").cast("long")))
    train_tokenizer(gapped, VOCAB, limit=LIMIT, folder=folder, source="documents")
    report = spark.read.json(f"{folder}/tokenizer_config.json", multiLine=True)
    whole = [F.col(c).cast("int").alias(c) for c in ("vocab_size", "min_frequency")]
    return report.select("type", *whole, "documents", "characters")


def encoded(spark: SparkSession, sf: str) -> DataFrame:
    return encode(documents(spark, sf), learned(spark, sf))


def decoded(spark: SparkSession, sf: str) -> DataFrame:
    model = learned(spark, sf)
    coded = encode(documents(spark, sf), model)
    return coded.select("ordinal", decode(F.col("ids"), model).alias("text"))


# --- token dataset and evaluation ----------------------------------------------------------


def with_eos(spark: SparkSession, sf: str) -> DataFrame:
    model = learned(spark, sf)
    ids = append_eos(F.col("ids"), eos_id(model))
    coded = encode(documents(spark, sf), model).withColumn("ids", ids)
    return coded.select("ordinal", joined("ids"), F.size("ids").alias("n_tokens"))


def stats_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of the documents, some of them null or empty, without end ids."""
    docs = documents(spark, sf)
    gapped = docs.withColumn("text", gaps(F.col("text"), F.col("file_id").cast("long")))
    return encode_stats(gapped, learned(spark, sf), with_eos=False)


def marked_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Round trip of all documents, of which every tenth ends in a literal special token."""
    docs = documents(spark, sf)
    marked = F.when(F.col("file_id").cast("long") % 10 == 0, F.concat("text", F.lit("[EOS]")))
    return round_trip(docs.withColumn("text", F.coalesce(marked, "text")), learned(spark, sf))


def dataset(spark: SparkSession, sf: str) -> TokenDataset:
    docs = selection.with_identity(documents(spark, sf), VAL_RATIO)
    return encode_corpus(docs, learned(spark, sf), BLOCK)


def starts(spark: SparkSession, data: TokenDataset) -> DataFrame:
    n_tokens = data.meta.select("val_tokens").first()[0]
    return spark.range(WINDOWS).select(
        F.col("id").alias("window_id"),
        ((F.col("id") * STRIDE) % (n_tokens - BLOCK - 1)).alias("start"),
    )


def windows(spark: SparkSession, data: TokenDataset) -> DataFrame:
    held_out = data.tokens.where(F.col("split") == "val")
    return token_windows(held_out, starts(spark, data), BLOCK, WINDOWS)


def written_windows(spark: SparkSession, data: TokenDataset) -> DataFrame:
    """The same windows, read from the files of the held-out stream."""
    folder = staging_path(spark, "bins")
    write_token_bins(data, folder, SHARD)
    return tokenbin.read_windows(starts(spark, data), f"{folder}/val", BLOCK)


def token_bin_windows(spark: SparkSession, sf: str) -> DataFrame:
    drawn = written_windows(spark, dataset(spark, sf))
    return drawn.select("window_id", "start", joined("x"), joined("y"))


def token_bin_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    data = dataset(spark, sf)
    targets = evaluation.window_pairs(written_windows(spark, data))
    train = stage(train_pairs(data), "pairs")
    scored = evaluation.score_pairs(targets, train, data.model.vocab_size, ADD_K)
    return rounded(evaluation.evaluation_report(scored, VOCAB))


def token_bin_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Place and size of every shard of both written streams."""
    folder = staging_path(spark, "bins")
    write_token_bins(dataset(spark, sf), folder, SHARD)
    listed = spark.read.json([f"{folder}/{s}/{tokenbin.MANIFEST}" for s in ("train", "val")], multiLine=True)
    split = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("split")
    return listed.select(split, "dtype", F.explode("shards").alias("s")).select(
        "split", "dtype", "s.offset", "s.tokens"
    )


def stats_by_split(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of an encoding of JSON lines that were written by split, some without a text."""
    docs = selection.with_identity(documents(spark, sf), VAL_RATIO)
    text = gaps(F.col("text"), F.col("file_id").cast("long")).alias("text")
    folder = staging_path(spark, "split-jsonl")
    docs.select("split", text).write.partitionBy("split").json(folder)
    parts = src.read_split_texts(spark, {s: f"{folder}/split={s}" for s in ("train", "val")})
    return encode_corpus(parts, learned(spark, sf), BLOCK).stats


def split_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    data = dataset(spark, sf)
    return rounded(evaluate_splits(data.tokens, VOCAB, BLOCK, DRAWS, SEED, ADD_K))


def given_windows(spark: SparkSession, sf: str) -> DataFrame:
    drawn = windows(spark, dataset(spark, sf))
    return drawn.select("window_id", "start", joined("x"), joined("y"))


def train_pairs(data: TokenDataset) -> DataFrame:
    return evaluation.stream_pairs(data.tokens.where(F.col("split") == "train"))


def pair_scores(spark: SparkSession, sf: str) -> DataFrame:
    data = dataset(spark, sf)
    targets = evaluation.window_pairs(windows(spark, data))
    train = stage(train_pairs(data), "pairs")
    return evaluation.score_pairs(targets, train, data.model.vocab_size, ADD_K)


def evaluation_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.evaluation_report(pair_scores(spark, sf), VOCAB))


def rounded(report: DataFrame) -> DataFrame:
    digits = {"loss": 7, "perplexity": 6, "gain_over_uniform": 6, "accuracy": 6}
    return report.withColumns({c: F.round(c, n) for c, n in digits.items()})


def random_window_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    from inkmill.plans.token_dataset import evaluate_tokens

    data = dataset(spark, sf)
    part = {s: data.tokens.where(F.col("split") == s) for s in ("train", "val")}
    report = evaluate_tokens(part["train"], part["val"], VOCAB, BLOCK, WINDOWS, seed=SEED)
    return rounded(report)


def top_k(spark: SparkSession, sf: str) -> DataFrame:
    pairs = train_pairs(dataset(spark, sf))
    logits = pairs.select(
        F.col("prev").alias("context"), F.col("next").alias("token"), F.log("n").alias("logit")
    )
    kept = evaluation.top_k_distribution(logits, TEMPERATURE, TOP_K)
    return kept.select("context", "token", F.round("probability", 9).alias("probability"))


def queries() -> dict[str, Query]:
    c = cleaning
    return {
        # sources and sinks
        "corpus_scan": documents,
        "row_ordinal": lambda s, sf: documents(s, sf).select("ordinal", "file_id"),
        "jsonl_texts": jsonl_texts,
        "limit_docs": lambda s, sf: src.limit_docs(
            documents(s, sf).select("ordinal", "text"), LIMIT
        ),
        "corpus_output": corpus_output,
        "kept_report_output": kept_report_output,
        "rejected_report_output": rejected_report_output,
        "summary_output": summary_output,
        "token_bin_round_trip": token_bin_round_trip,
        "token_dtype": dtype_by_vocabulary,
        # cleaning
        "nfc": each_document(c.nfc),
        "unify_newlines": each_page(c.unify_newlines),
        "plain_blanks": each_page(c.plain_blanks),
        "rstrip_lines": each_page(c.rstrip_lines),
        "collapse_blank_lines": each_page(c.collapse_blank_lines),
        "collapse_spaces": each_page(c.collapse_spaces),
        "strip_text": each_page(c.strip),
        "normalize_text": each_document(c.normalize_text),
        "normalize_pages": each_page(c.normalize_text),
        "header_footer_lines": line_flags(c.is_header_footer, "header_lines"),
        "symbol_soup_lines": line_flags(c.is_symbol_soup, "soup_lines"),
        "drop_noise_lines": each_document(c.drop_noise_lines),
        "clean_for_model": lambda s, sf: worn_documents(s, sf).select(
            "ordinal", c.clean_for_model(F.col("text")).alias("cleaned")
        ),
        # quality
        "text_metrics": lambda s, sf: flat_metrics(scored(s, sf), "ordinal"),
        "text_metrics_raw": lambda s, sf: flat_metrics(
            with_text_metrics(worn_documents(s, sf).where("text IS NOT NULL"), "text"), "ordinal"
        ),
        "text_metrics_pages": text_metrics_pages,
        "quality_score": lambda s, sf: scored(s, sf, DEFAULT).select(
            "ordinal", "score", F.round("score", 4).alias("rounded_score")
        ),
        "reject_reason": lambda s, sf: judged(s, sf, DEFAULT),
        "reject_reason_production": lambda s, sf: judged(
            s, sf, CorpusConfig.production(columns=COLUMNS)
        ),
        # selection
        "kept_documents": lambda s, sf: thin(s, sf)
        .where(F.col("reason").isNull())
        .select("ordinal", F.col("metrics.chars").alias("chars")),
        "content_hash": lambda s, sf: thin(s, sf)
        .where(F.col("reason").isNull())
        .select("ordinal", "content_hash"),
        "exact_dedup": lambda s, sf: selection.drop_exact_duplicates(thin(s, sf)).select(
            "ordinal", "content_hash"
        ),
        "exact_duplicates": lambda s, sf: selection.exact_duplicates(thin(s, sf)).select(
            "ordinal", "content_hash"
        ),
        "stable_doc_id": lambda s, sf: identified(s, sf).select("ordinal", "doc_id"),
        "hash_split": lambda s, sf: identified(s, sf).select("doc_id", "split"),
        "split_totals": lambda s, sf: identified(s, sf)
        .groupBy("split")
        .agg(F.count("*").alias("docs"), F.sum("metrics.chars").alias("chars")),
        "running_chars": lambda s, sf: selection.with_running_chars(kept_chars(s, sf), 100),
        "char_budget": lambda s, sf: selection.char_budget(kept_chars(s, sf), BUDGET),
        "reject_counts": reject_counts,
        "corpus_summary": lambda s, sf: build(s, sf).summary.drop("reject_counts", "settings"),
        "corpus_summary_cut": lambda s, sf: build_corpus(documents(s, sf), CUT, False).summary.drop(
            "reject_counts", "settings"
        ),
        "corpus_summary_waves": summary_in_waves,
        "rejected_report": lambda s, sf: rejected_columns(build(s, sf, True).rejected_report),
        "kept_report": lambda s, sf: kept_columns(build(s, sf).kept_report),
        "corpus_size": lambda s, sf: src.corpus_size(documents(s, sf)),
        "jsonl_line_count": jsonl_line_count,
        # profile
        "file_profile": lambda s, sf: profile.profile_files(profile_rows(s, sf)),
        "unique_chars": lambda s, sf: profile.unique_chars_per_file(profile_rows(s, sf)),
        "alphabet": lambda s, sf: profile.file_alphabet(profile_rows(s, sf)),
        "global_profile": lambda s, sf: profile.global_profile(
            profile_rows(s, sf, "{documents,conversations}.parquet")
        ).drop("sample"),
        "text_column_detection": text_column_detection,
        "profile_folder": profile_folder,
        # tokenizer
        "pretokens": lambda s, sf: documents(s, sf)
        .select("ordinal", pretokens(c.nfc(F.col("text"))).alias("w"))
        .select(
            "ordinal", F.size("w").alias("n_words"), F.md5(F.array_join("w", "|")).alias("words_md5")
        ),
        "word_counts": lambda s, sf: word_counts(documents(s, sf)),
        "pair_counts": first_pairs,
        "bpe_merges": lambda s, sf: tokenizer_files.merges_table(s, learned(s, sf)),
        "bpe_vocabulary": bpe_vocabulary,
        "tokenizer_files": tokenizer_files_round_trip,
        "trained_tokenizer_files": trained_files,
        "encode": lambda s, sf: encoded(s, sf).select("ordinal", joined("ids")),
        "decode": decoded,
        "round_trip": marked_round_trip,
        "tokenizer_report": tokenizer_report,
        # token dataset
        "append_eos": with_eos,
        "encode_stats": stats_with_gaps,
        "token_offsets": lambda s, sf: dataset(s, sf).tokens.select(
            "split", "ordinal", "n_tokens", "start_offset"
        ),
        "token_windows": given_windows,
        "token_bin_windows": token_bin_windows,
        "token_bin_shards": token_bin_shards,
        "encode_stats_by_split": stats_by_split,
        "dataset_meta": lambda s, sf: dataset(s, sf).meta.drop(
            "tokenizer_path", "train_jsonl", "val_jsonl"
        ),
        # evaluation
        "bigram_counts": lambda s, sf: train_pairs(dataset(s, sf)),
        "bigram_scores": lambda s, sf: pair_scores(s, sf).withColumn(
            "logprob", F.round("logprob", 9)
        ),
        "evaluation_report": evaluation_report,
        "random_window_evaluation": random_window_evaluation,
        "token_bin_evaluation": token_bin_evaluation,
        "split_evaluation": split_evaluation,
        "top_k_distribution": top_k,
    }
