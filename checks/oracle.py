"""The queries again as SQL, for comparison by another engine."""

from __future__ import annotations

import sys
import unicodedata

from checks.settings import (
    ADD_K,
    BLOCK,
    BUDGET,
    DRAWS,
    LIMIT,
    MERGES,
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
from checks.worn import EMPTY, LOST, gaps_sql, listed_sql, worn_sql


def _ranges(code_points) -> str:
    out = []
    for cp in code_points:
        if out and cp == out[-1][1] + 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "".join("\\x{%X}-\\x{%X}" % (a, b) for a, b in out)


_SPACES = [cp for cp in range(0x3001) if chr(cp).isspace()]
WS = _ranges(_SPACES)
WSL = _ranges(cp for cp in _SPACES if cp != 10)
WSP = _ranges(cp for cp in _SPACES if not 0x1C <= cp <= 0x1F)
DIGIT = r"\p{Nd}" + _ranges(
    cp for cp in range(sys.maxunicode + 1)
    if chr(cp).isdigit() and unicodedata.category(chr(cp)) != "Nd"
)
NL = "chr(10)"
WORD = (
    r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WSP}\p{{L}}\p{{N}}]+|[{WSP}]+"
)

# --- cleaning -----------------------------------------------------------------------------


def newlines(t):
    return f"replace(replace({t}, chr(13) || {NL}, {NL}), chr(13), {NL})"


def blanks(t):
    return f"replace(replace(replace({t}, chr(12), {NL}), chr(160), ' '), chr(9), ' ')"


def rstrip(t):
    return rf"regexp_replace({t}, '[{WSL}]+(\n|$)', '\1', 'g')"


def blank_lines(t):
    return rf"regexp_replace({t}, '\n{{3,}}', {NL} || {NL}, 'g')"


def spaces(t):
    return f"regexp_replace({t}, ' {{2,}}', ' ', 'g')"


def strip(t):
    return f"regexp_replace({t}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def normal(t):
    return strip(spaces(blank_lines(rstrip(blanks(newlines(f"nfc_normalize({t})"))))))


def header(s):
    return (
        f"({s} <> '' AND ((length({s}) <= 3 AND regexp_matches({s}, '[{DIGIT}]')) "
        rf"OR regexp_full_match({s}, '[IVXLCDM]+\.?') "
        f"OR regexp_full_match({s}, '[-_=*·•~ ]{{4,}}') "
        rf"OR regexp_full_match({s}, '\p{{Nd}}+')))"
    )


def soup(s):
    return (
        rf"(length({s}) >= 8 AND length(regexp_replace({s}, '[\p{{L}}\p{{N}}{WS}]+', '', 'g')) "
        f"/ greatest(length({s}), 1) > 0.55)"
    )


def no_noise(t):
    stripped = f"list_transform(string_split({t}, {NL}), lambda s: {strip('s')})"
    return (
        f"array_to_string(list_filter({stripped}, "
        f"lambda s: NOT {header('s')} AND NOT {soup('s')}), {NL})"
    )


DOCS = """docs AS (SELECT doc_id + 1 AS ordinal, CAST(doc_id AS VARCHAR) AS file_id,
  source AS title, lang AS author, CAST(NULL AS VARCHAR) AS date, text FROM documents)"""
_WORN = gaps_sql(worn_sql(listed_sql("text", "doc_id")), "doc_id")
WORN_DOCS = DOCS.replace("text FROM", f"{_WORN} AS text FROM")
NORMAL = f"normal AS (SELECT * EXCLUDE (text), {normal('text')} AS body FROM docs)"
LINED = f"lined AS (SELECT * EXCLUDE (body), {no_noise('body')} AS body FROM normal)"
CLEAN = (
    f"clean AS (SELECT * EXCLUDE (body), {strip(spaces(blank_lines('body')))} AS cleaned FROM lined)"
)
CLEANING = ", ".join([DOCS, NORMAL, LINED, CLEAN])
WORN_CLEANING = ", ".join([WORN_DOCS, NORMAL, LINED, CLEAN])

# --- metrics ------------------------------------------------------------------------------


def _count(col: str, char_class: str) -> str:
    return f"length(regexp_replace({col}, '[^{char_class}]+', '', 'g'))"


def metrics(source: str, col: str) -> str:
    """CTEs ending in ``measured``: the columns of ``source`` and the eleven metrics."""
    return f"""
split_lines AS (SELECT *, string_split({col}, {NL}) AS all_lines,
  list_filter(list_transform(string_split({col}, {NL}), lambda s: {strip('s')}),
              lambda s: s <> '') AS body_lines FROM {source}),
copies AS (SELECT ordinal, sum(c) AS repeated FROM (
  SELECT ordinal, line, count(*) AS c
  FROM (SELECT ordinal, unnest(body_lines) AS line FROM split_lines)
  GROUP BY ordinal, line HAVING count(*) > 1) GROUP BY ordinal),
counted AS (SELECT s.*, length({col}) AS n,
  {_count(col, chr(92) + 'p{L}')} AS alpha, {_count(col, DIGIT)} AS digits,
  {_count(col, WS)} AS spaces, {_count(col, chr(92) + 'p{Lu}')} AS uppers,
  length(regexp_replace({col}, '[\\p{{L}}\\p{{N}}\\p{{P}}{WS}]+', '', 'g')) AS weird,
  len(list_filter(body_lines, lambda s: length(s) < 4)) AS shorts,
  len(list_filter(body_lines, lambda s: {header('s')})) AS headers,
  coalesce(repeated, 0) AS repeated, len(body_lines) AS bodies, len(all_lines) AS lines
  FROM split_lines s LEFT JOIN copies USING (ordinal)),
measured AS (SELECT * EXCLUDE (all_lines, body_lines, n, alpha, digits, spaces, uppers, weird,
    shorts, headers, repeated, bodies, lines),
  CAST(n AS BIGINT) AS chars,
  alpha::DOUBLE / greatest(n, 1) AS alpha_ratio,
  digits::DOUBLE / greatest(n, 1) AS digit_ratio,
  spaces::DOUBLE / greatest(n, 1) AS space_ratio,
  uppers::DOUBLE / greatest(alpha, 1) AS upper_ratio,
  weird::DOUBLE / greatest(n, 1) AS weird_ratio,
  CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE shorts::DOUBLE / greatest(bodies, 1) END AS short_line_ratio,
  CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE headers::DOUBLE / greatest(bodies, 1) END AS headerish_ratio,
  repeated::DOUBLE / greatest(bodies, 1) AS repeated_line_ratio,
  CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - bodies::DOUBLE / greatest(lines, 1) END
    AS blank_line_ratio,
  CASE WHEN n = 0 THEN 0 ELSE CAST(lines AS BIGINT) END AS line_count
  FROM counted)"""


METRICS = (
    "chars, alpha_ratio, digit_ratio, space_ratio, upper_ratio, weird_ratio, short_line_ratio, "
    "headerish_ratio, repeated_line_ratio, blank_line_ratio, line_count"
)

SCORE = """least(chars / 20000.0::DOUBLE, 2.5::DOUBLE) + 3.0::DOUBLE * alpha_ratio
  - 8.0::DOUBLE * weird_ratio - 2.5::DOUBLE * digit_ratio - 2.0::DOUBLE * short_line_ratio
  - 3.0::DOUBLE * headerish_ratio - 2.0::DOUBLE * repeated_line_ratio
  - CASE WHEN chars > 5000 AND upper_ratio > 0.45 THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END
  - CASE WHEN blank_line_ratio > 0.35 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"""


def judged(min_chars: int, min_alpha=0.55, max_weird=0.08, min_score=1.25, cleaning=CLEANING) -> str:
    """CTEs ending in ``judged`` (with score and reason) and ``passed`` (with content hash)."""
    return f"""{cleaning}, {metrics('clean', 'cleaned')},
scored AS (SELECT *, {SCORE} AS score FROM measured),
judged AS (SELECT *, CASE WHEN cleaned IS NULL THEN 'missing_text'
  WHEN chars < {min_chars} THEN 'too_short'
  WHEN alpha_ratio < {min_alpha} THEN 'low_alpha_ratio'
  WHEN weird_ratio > {max_weird} THEN 'too_many_weird_chars'
  WHEN short_line_ratio > 0.35 THEN 'too_many_short_lines'
  WHEN headerish_ratio > 0.20 THEN 'too_many_headerish_lines'
  WHEN repeated_line_ratio > 0.20 THEN 'too_many_repeated_lines'
  WHEN score < {min_score} THEN 'low_quality_score' END AS reason FROM scored),
passed AS (SELECT *, sha1(cleaned) AS content_hash FROM judged WHERE reason IS NULL)"""


IDENTITY = f"""firsts AS (SELECT content_hash, min(ordinal) AS ordinal FROM passed GROUP BY content_hash),
kept AS (SELECT p.*, sha1(coalesce(file_id, '') || '|' || coalesce(title, '') || '|' ||
    coalesce(author, '') || '|' || CAST(p.ordinal AS VARCHAR)) AS doc_id
  FROM passed p JOIN firsts f ON p.ordinal = f.ordinal),
routed AS (SELECT *, CASE WHEN ('0x' || substr(md5(doc_id), 1, 8))::BIGINT / 4294967295.0::DOUBLE
    < {VAL_RATIO} THEN 'val' ELSE 'train' END AS split FROM kept)"""
KEPT = f"WITH {judged(MIN_CHARS)}, {IDENTITY}"

def cut_at(budget: int) -> str:
    return f"""{KEPT}, running AS (SELECT ordinal, chars, sum(chars) OVER (ORDER BY ordinal) AS running_chars
  FROM routed),
cut AS (SELECT coalesce((SELECT min(ordinal) FROM running WHERE running_chars >= {budget}),
  (SELECT max(ordinal) FROM docs)) AS last),
seen AS (SELECT * FROM judged WHERE ordinal <= (SELECT last FROM cut)),
stay AS (SELECT * FROM routed WHERE ordinal <= (SELECT last FROM cut))"""


def summary(budget: int) -> str:
    return f"""{cut_at(budget)}, t AS (SELECT count(*) AS kept_docs, coalesce(sum(chars), 0) AS kept_chars,
  coalesce(sum(chars) FILTER (split = 'train'), 0) AS train_chars,
  coalesce(sum(chars) FILTER (split = 'val'), 0) AS val_chars FROM stay),
s AS (SELECT count(*) AS total_docs_seen, count(*) FILTER (reason IS NULL) AS passed_docs FROM seen)
SELECT CAST({budget} AS BIGINT) AS target_chars, CAST(kept_chars AS BIGINT) AS kept_chars,
  CAST(train_chars AS BIGINT) AS train_chars, CAST(val_chars AS BIGINT) AS val_chars,
  total_docs_seen, kept_docs, total_docs_seen - kept_docs AS rejected_docs,
  passed_docs - kept_docs AS duplicate_docs FROM t, s"""


CUT = cut_at(WHOLE)
REJECTED = f"""{CUT} SELECT file_id, title, author, date, reason, round(score, 4) AS score,
  {METRICS}, substr(cleaned, 1, 400) AS sample FROM seen
  WHERE reason IS NOT NULL AND reason <> 'missing_text'"""
KEPT_REPORT = f"""{CUT} SELECT doc_id, file_id, title, author, date, split,
  round(score, 4) AS score, {METRICS} FROM stay"""
CORPUS = f"""{CUT} SELECT split, doc_id, file_id, title, author, date, cleaned AS text, chars,
  round(score, 4) AS quality_score FROM stay"""
COUNTS = f"""{CUT} SELECT reason, count(*) AS n FROM seen WHERE reason IS NOT NULL GROUP BY reason
  UNION ALL SELECT 'exact_duplicate', count(*) FROM seen WHERE reason IS NULL
    AND ordinal NOT IN (SELECT ordinal FROM stay) HAVING count(*) > 0"""

# --- tokenizer ----------------------------------------------------------------------------

BYTE_ID = """CASE WHEN b BETWEEN 33 AND 126 THEN b - 29 WHEN b BETWEEN 161 AND 172 THEN b - 63
  WHEN b BETWEEN 174 AND 255 THEN b - 64 WHEN b <= 32 THEN b + 192
  WHEN b BETWEEN 127 AND 160 THEN b + 98 ELSE 259 END"""


def _symbols(word: str) -> str:
    """Symbol string of a word: one character per byte, code point 256 + symbol id."""
    byte = f"list_transform(regexp_extract_all(hex(encode({word})), '..'), lambda h: ('0x' || h)::INT)"
    return f"array_to_string(list_transform({byte}, lambda b: chr(256 + {BYTE_ID})), '')"


def _pairs(symbols: str) -> str:
    return f"unnest(list_transform(range(1, length({symbols})), lambda i: substr({symbols}, i, 2)))"


WORDS = rf"""spoken AS (SELECT doc_id + 1 AS ordinal, lang, text,
  regexp_extract_all(nfc_normalize(text), '{WORD}') AS parts FROM documents),
words AS (SELECT word, count(*) AS freq FROM (SELECT unnest(parts) AS word FROM spoken) GROUP BY word),
spelled AS (SELECT word, freq, {_symbols('word')} AS symbols FROM words)"""
BPE = f"""{WORDS},
bpe AS (SELECT 0 AS step, word, symbols, freq, CAST(NULL AS VARCHAR) AS pair, CAST(0 AS BIGINT) AS n
  FROM spelled
  UNION ALL
  SELECT w.step + 1, w.word, replace(w.symbols, best.pair, chr(516 + w.step)), w.freq, best.pair, best.n
  FROM bpe w, (SELECT pair, CAST(sum(freq) AS BIGINT) AS n
      FROM (SELECT {_pairs('symbols')} AS pair, freq FROM bpe)
      GROUP BY pair ORDER BY n DESC, pair LIMIT 1) best
  WHERE w.step < {MERGES} AND best.n >= 2),
merges AS MATERIALIZED (SELECT DISTINCT step - 1 AS rank, pair, n FROM bpe WHERE step > 0),
coded AS (SELECT word, symbols FROM bpe WHERE step = {MERGES})"""
ENCODED = f"""{BPE},
placed AS (SELECT ordinal, unnest(parts) AS word, unnest(range(len(parts))) AS pos FROM spoken),
encoded AS (SELECT ordinal, string_agg(symbols, '' ORDER BY pos) AS symbols
  FROM placed JOIN coded USING (word) GROUP BY ordinal),
identified AS (SELECT e.*, sha1(CAST(doc_id AS VARCHAR) || '|' || source || '|' || lang || '|' ||
    CAST(ordinal AS VARCHAR)) AS stable_id FROM encoded e JOIN documents d ON d.doc_id + 1 = e.ordinal),
tokens AS (SELECT ordinal, symbols || chr(259) AS symbols, length(symbols) + 1 AS n_tokens,
  CASE WHEN ('0x' || substr(md5(stable_id), 1, 8))::BIGINT / 4294967295.0::DOUBLE < {VAL_RATIO}
    THEN 'val' ELSE 'train' END AS split FROM identified),
placed_tokens AS (SELECT *, CAST(coalesce(sum(n_tokens) OVER (PARTITION BY split ORDER BY ordinal
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_offset FROM tokens),
streams AS (SELECT split, string_agg(symbols, '' ORDER BY ordinal) AS stream,
  CAST(sum(n_tokens) AS BIGINT) AS total FROM tokens GROUP BY split)"""


def _ids(symbols: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({symbols}, ''), lambda c: unicode(c) - 256), ',')"
    )


def window(start: str) -> str:
    return f"""starts AS (SELECT w AS window_id, {start} % (total - {BLOCK} - 1) AS start, stream
  FROM streams, (SELECT unnest(range({WINDOWS})) AS w) WHERE split = 'val'),
windows AS (SELECT window_id, start, substr(stream, start + 1, {BLOCK}) AS x,
  substr(stream, start + 2, {BLOCK}) AS y FROM starts)"""


WINDOW = window(f"(w * {STRIDE})")
RANDOM = window(f"('0x' || substr(md5('{SEED}|' || w), 1, 15))::BIGINT")
PAIRS = """train_ids AS (SELECT unnest(chars) AS c, unnest(range(len(chars))) AS pos FROM (
  SELECT string_split(stream, '') AS chars FROM streams WHERE split = 'train')),
train_pairs AS (SELECT prev, next, count(*) AS n FROM (
  SELECT unicode(c) - 256 AS prev, unicode(lead(c) OVER (ORDER BY pos)) - 256 AS next FROM train_ids)
  WHERE next IS NOT NULL GROUP BY prev, next)"""
COMPARED = f"""{PAIRS},
targets AS (SELECT prev, next, count(*) AS n FROM (
  SELECT unicode(unnest(string_split(x, ''))) - 256 AS prev,
    unicode(unnest(string_split(y, ''))) - 256 AS next FROM windows) GROUP BY prev, next),
contexts AS (SELECT prev, sum(n) AS context_n FROM train_pairs GROUP BY prev),
leaders AS (SELECT prev, next AS predicted FROM train_pairs
  QUALIFY row_number() OVER (PARTITION BY prev ORDER BY n DESC, next) = 1),
fallback AS (SELECT next FROM train_pairs GROUP BY next ORDER BY sum(n) DESC, next LIMIT 1),
scored AS (SELECT t.prev, t.next, t.n,
  ln((coalesce(p.n, 0) + {ADD_K}) / (coalesce(c.context_n, 0) + {ADD_K} * {VOCAB})::DOUBLE) AS logprob,
  coalesce(l.predicted, (SELECT next FROM fallback)) AS predicted
  FROM targets t LEFT JOIN train_pairs p USING (prev, next) LEFT JOIN contexts c USING (prev)
  LEFT JOIN leaders l USING (prev))"""
SCORED = f"{WINDOW}, {COMPARED}"
BY_DRAW = f"""draws AS (SELECT unnest({list(DRAWS)}) AS draw, unnest({list(DRAWS.values())}) AS n),
drawn AS (SELECT draw, unnest(range(n)) AS w FROM draws),
starts AS (SELECT split, draw, stream, ('0x' || substr(md5('{SEED}|' || split || '|' || draw || '|' || w), 1, 15))::BIGINT
  % (total - {BLOCK} - 1) AS start FROM streams, drawn),
windows AS (SELECT split, draw, substr(stream, start + 1, {BLOCK}) AS x,
  substr(stream, start + 2, {BLOCK}) AS y FROM starts)"""
REPORT = f"""totals AS (SELECT CAST(sum(n) AS BIGINT) AS tokens, sum(-logprob * n) / sum(n) AS loss,
    sum(n) FILTER (predicted = next) AS correct FROM scored)
  SELECT tokens, round(loss, 7) AS loss, round(exp(loss), 6) AS perplexity,
    round({VOCAB} / exp(loss), 6) AS gain_over_uniform, round(100.0 * correct / tokens, 6) AS accuracy FROM totals"""
TOKENS = f"WITH RECURSIVE {ENCODED}"


def by_draw(sql: str) -> str:
    """Targets, scores and report once more, with a row per split and draw."""
    return (
        sql.replace("SELECT prev, next, count(*) AS n FROM (\n  SELECT unicode(unnest",
                    "SELECT split, draw, prev, next, count(*) AS n FROM (\n  SELECT split, draw, unicode(unnest")
        .replace("FROM windows) GROUP BY prev, next", "FROM windows) GROUP BY ALL")
        .replace("SELECT t.prev", "SELECT t.split, t.draw, t.prev")
        .replace("totals AS (SELECT", "totals AS (SELECT split, draw,")
        .replace("FROM scored)", "FROM scored GROUP BY ALL)")
        .replace("SELECT tokens, round", "SELECT split, draw, tokens, round")
    )


N_DOCS = "(SELECT count(*) FROM documents)"


def oracle_sql() -> dict[str, str]:
    each = f"WITH {WORN_DOCS} SELECT ordinal, {{}} AS text FROM docs"
    html = gaps_sql(worn_sql("html"), "page_id")
    page = f"SELECT page_id, {{}} AS text FROM (SELECT page_id, {html} AS html FROM pages)"
    line = f"(SELECT doc_id, unnest(string_split({worn_sql('text')}, {NL})) AS line FROM documents)"
    byte_ids = f"""WITH bytes AS (SELECT doc_id, unnest(list_append(list_transform(
      regexp_extract_all(hex(encode(nfc_normalize(text))), '..'), lambda h: ('0x' || h)::INT), -1)) AS b,
      unnest(range(octet_length(encode(nfc_normalize(text))) + 1)) AS pos FROM documents),
    stream AS (SELECT CASE WHEN b < 0 THEN 3 ELSE {BYTE_ID} END AS id,
      row_number() OVER (ORDER BY doc_id, pos) - 1 AS position FROM bytes)
    SELECT (position // 65536) * 65536 AS start_offset, count(*) AS n_tokens,
      CAST(sum(id) AS BIGINT) AS id_sum FROM stream GROUP BY 1"""
    profile = f"""SELECT 'documents.parquet' AS file, count(*) AS rows,
      count(*) FILTER ({strip('text')} <> '') AS non_empty_docs,
      CAST(sum(length(text)) FILTER ({strip('text')} <> '') AS BIGINT) AS chars,
      CAST(sum(length(text)) FILTER ({strip('text')} <> '') AS BIGINT) AS char_tokens,
      CAST(sum(length(text)) FILTER ({strip('text')} <> '') // 4 AS BIGINT) AS bpe_estimate,
      arg_min(substr(text, 1, 300), doc_id) FILTER ({strip('text')} <> '') AS sample FROM documents"""
    columns = {"documents": "text", "benchmark": "text", "conversations": "text", "region": "r_name", "nation": "n_name"}
    detected = " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS text_column, count(*) AS rows,
          CAST(sum(length({c})) AS BIGINT) AS chars FROM {t}"""
        for t, c in columns.items()
    ) + "".join(
        f""" UNION ALL SELECT '{t}', CAST(NULL AS VARCHAR), count(*), CAST(NULL AS BIGINT) FROM {t}"""
        for t in ("labels", "part")
    )
    alphabet = (
        f"SELECT count(DISTINCT c) AS unique_chars FROM (SELECT unnest(string_split(text, '')) AS c "
        f"FROM documents WHERE {strip('text')} <> '')"
    )
    both = f"""WITH rows_in AS (SELECT 'documents.parquet' AS file, doc_id AS position, text FROM documents
      UNION ALL SELECT 'conversations.parquet', row_number() OVER (), text FROM conversations),
      real_docs AS (SELECT * FROM rows_in WHERE {strip('text')} <> '')
    SELECT CAST(2 AS BIGINT) AS files, (SELECT count(*) FROM rows_in) AS rows, count(*) AS non_empty_docs,
      CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(length(text)) // 4 AS BIGINT) AS bpe_estimate,
      (SELECT count(DISTINCT c) FROM (SELECT unnest(string_split(text, '')) AS c FROM real_docs))
        AS unique_chars FROM real_docs"""
    return {
        # sources and sinks
        "corpus_scan": f"WITH {DOCS} SELECT * FROM docs",
        "row_ordinal": f"WITH {DOCS} SELECT ordinal, file_id FROM docs",
        "jsonl_texts": "SELECT doc_id + 1 AS ordinal, text FROM documents WHERE text <> ''",
        "limit_docs": f"WITH {DOCS} SELECT ordinal, text FROM docs WHERE text <> '' ORDER BY ordinal LIMIT {LIMIT}",
        "corpus_output": CORPUS,
        "kept_report_output": KEPT_REPORT,
        "rejected_report_output": REJECTED,
        "summary_output": summary(WHOLE),
        "token_bin_round_trip": byte_ids,
        "token_dtype": rf"""WITH {WORDS}, sizes AS (
          SELECT lang, 260 + count(DISTINCT word) AS vocab_size FROM (
            SELECT lang, unnest(parts) AS word FROM spoken
            UNION ALL SELECT 'all', unnest(parts) FROM spoken) GROUP BY lang)
          SELECT lang, vocab_size, CASE WHEN vocab_size <= 65535 THEN 'uint16' ELSE 'uint32' END AS dtype
          FROM sizes""",
        # cleaning
        "nfc": each.format("nfc_normalize(text)"),
        "unify_newlines": page.format(newlines("html")),
        "plain_blanks": page.format(blanks("html")),
        "rstrip_lines": page.format(rstrip("html")),
        "collapse_blank_lines": page.format(blank_lines("html")),
        "collapse_spaces": page.format(spaces("html")),
        "strip_text": page.format(strip("html")),
        "normalize_text": each.format(normal("text")),
        "normalize_pages": page.format(normal("html")),
        "header_footer_lines": f"""SELECT doc_id, CAST(count(*) AS INT) AS lines,
          CAST(count(*) FILTER ({header(strip('line'))}) AS INT) AS header_lines FROM {line} GROUP BY doc_id""",
        "symbol_soup_lines": f"""SELECT doc_id, CAST(count(*) AS INT) AS lines,
          CAST(count(*) FILTER ({soup('line')}) AS INT) AS soup_lines FROM {line} GROUP BY doc_id""",
        "drop_noise_lines": each.format(no_noise("text")),
        "clean_for_model": f"WITH {WORN_CLEANING} SELECT ordinal, cleaned FROM clean",
        # quality
        "text_metrics": f"WITH {CLEANING}, {metrics('clean', 'cleaned')} SELECT ordinal, {METRICS} FROM measured",
        "text_metrics_raw": f"""WITH {WORN_DOCS}, given AS (SELECT * FROM docs WHERE text IS NOT NULL),
          {metrics('given', 'text')} SELECT ordinal, {METRICS} FROM measured""",
        "text_metrics_pages": f"""WITH pages_in AS (SELECT page_id AS ordinal, html FROM pages),
          {metrics('pages_in', 'html')} SELECT ordinal, {METRICS} FROM measured""",
        "quality_score": f"WITH {judged(2000)} SELECT ordinal, score, round(score, 4) AS rounded_score FROM judged",
        "reject_reason": f"WITH {judged(2000, cleaning=WORN_CLEANING)} SELECT ordinal, reason FROM judged",
        "reject_reason_production": f"WITH {judged(2500, 0.58, 0.06, 1.5, WORN_CLEANING)} SELECT ordinal, reason FROM judged",
        # selection
        "kept_documents": f"WITH {judged(MIN_CHARS)} SELECT ordinal, chars FROM passed",
        "content_hash": f"WITH {judged(MIN_CHARS)} SELECT ordinal, content_hash FROM passed",
        "exact_dedup": f"{KEPT} SELECT ordinal, content_hash FROM routed",
        "exact_duplicates": f"{KEPT} SELECT ordinal, content_hash FROM passed WHERE ordinal NOT IN (SELECT ordinal FROM firsts)",
        "stable_doc_id": f"{KEPT} SELECT ordinal, doc_id FROM routed",
        "hash_split": f"{KEPT} SELECT doc_id, split FROM routed",
        "split_totals": f"{KEPT} SELECT split, count(*) AS docs, CAST(sum(chars) AS BIGINT) AS chars FROM routed GROUP BY split",
        "running_chars": f"{KEPT} SELECT ordinal, chars, CAST(sum(chars) OVER (ORDER BY ordinal) AS BIGINT) AS running_chars FROM routed",
        "char_budget": f"{cut_at(BUDGET)} SELECT ordinal, chars FROM stay",
        "reject_counts": COUNTS,
        "corpus_summary": summary(WHOLE),
        "corpus_summary_cut": summary(BUDGET),
        "corpus_summary_waves": summary(BUDGET),
        "rejected_report": REJECTED,
        "kept_report": KEPT_REPORT,
        "corpus_size": "SELECT count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS characters FROM documents WHERE text <> ''",
        "jsonl_line_count": "SELECT count(*) AS docs FROM documents",
        # profile
        "file_profile": profile,
        "unique_chars": f"SELECT 'documents.parquet' AS file, * FROM ({alphabet})",
        "alphabet": f"""SELECT DISTINCT 'documents.parquet' AS file, c AS character FROM (
          SELECT unnest(string_split(text, '')) AS c FROM documents WHERE {strip('text')} <> '')""",
        "global_profile": both,
        "text_column_detection": detected,
        "profile_folder": f"""WITH readable AS (SELECT text FROM documents UNION ALL SELECT text FROM conversations
            UNION ALL SELECT r_name FROM region UNION ALL SELECT n_name FROM nation)
          SELECT CAST(4 AS BIGINT) AS files, CAST(2 AS BIGINT) AS failed, count(*) AS rows,
            CAST(sum(length(text)) FILTER ({strip('text')} <> '') AS BIGINT) AS chars,
            (SELECT count(DISTINCT c) FROM (SELECT unnest(string_split(text, '')) AS c FROM readable
              WHERE {strip('text')} <> '')) AS unique_chars FROM readable""",
        # tokenizer
        "pretokens": f"WITH {WORDS} SELECT ordinal, CAST(len(parts) AS INT) AS n_words, md5(array_to_string(parts, '|')) AS words_md5 FROM spoken",
        "word_counts": f"WITH {WORDS} SELECT word, freq FROM words",
        "pair_counts": f"""WITH {WORDS} SELECT unicode(pair) - 256 AS left_id, unicode(substr(pair, 2)) - 256 AS right_id,
          CAST(sum(freq) AS BIGINT) AS n FROM (SELECT {_pairs('symbols')} AS pair, freq FROM spelled) GROUP BY pair""",
        "bpe_merges": f"""WITH RECURSIVE {BPE} SELECT rank, unicode(pair) - 256 AS left_id,
          unicode(substr(pair, 2)) - 256 AS right_id, 260 + rank AS new_id, n AS pair_count FROM merges""",
        "bpe_vocabulary": f"""WITH RECURSIVE {BPE}, byte_rows AS (SELECT {BYTE_ID} AS id, b FROM (SELECT unnest(range(256)) AS b)),
          grown AS (SELECT 260 AS id, chr(260) AS piece, -1 AS r WHERE false
            UNION ALL SELECT id, upper(printf('%02x', b)), -1 FROM byte_rows),
          folded AS MATERIALIZED (SELECT list(pair ORDER BY rank) AS pairs FROM merges),
          spelling(step, names) AS (
            SELECT 0, (SELECT list(piece ORDER BY id) FROM grown)
            UNION ALL
            SELECT step + 1, list_append(names, names[unicode(pairs[step + 1]) - 259] ||
              names[unicode(substr(pairs[step + 1], 2)) - 259]) FROM spelling, folded WHERE step < len(pairs)),
          named AS (SELECT names FROM spelling ORDER BY step DESC LIMIT 1)
          SELECT CAST(unnest(range(len(names))) + 4 AS INT) AS id, unnest(names) AS bytes_hex FROM named
          UNION ALL SELECT * FROM (VALUES (0, '5B5041445D'), (1, '5B554E4B5D'), (2, '5B424F535D'), (3, '5B454F535D'))""",
        "encode": f"{TOKENS} SELECT ordinal, {_ids('symbols')} AS ids FROM encoded",
        "decode": f"SELECT doc_id + 1 AS ordinal, nfc_normalize(text) AS text FROM documents",
        "round_trip": "SELECT count(*) AS documents, count(*) FILTER (doc_id % 10 = 0) AS mismatches FROM documents",
        "tokenizer_report": f"""WITH RECURSIVE {BPE} SELECT 'BPE' AS type, CAST(260 + (SELECT count(*) FROM merges) AS INT) AS vocab_size,
          2 AS min_frequency, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS characters FROM documents""",
        "trained_tokenizer_files": f"""SELECT 'BPE' AS type, CAST({VOCAB} AS INT) AS vocab_size, 2 AS min_frequency,
          count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS characters FROM (SELECT text FROM documents
          WHERE text <> '' AND doc_id % {LOST} <> 0 AND doc_id % {EMPTY} <> 1 ORDER BY doc_id LIMIT {LIMIT})""",
        # token dataset
        "append_eos": f"{TOKENS} SELECT ordinal, {_ids('symbols')} AS ids, CAST(n_tokens AS INT) AS n_tokens FROM tokens",
        "encode_stats": f"""{TOKENS}, gapped AS (SELECT t.n_tokens - 1 AS n, length(d.text) AS chars
          FROM documents d JOIN tokens t ON t.ordinal = d.doc_id + 1
          WHERE d.text <> '' AND d.doc_id % {LOST} <> 0 AND d.doc_id % {EMPTY} <> 1)
          SELECT (SELECT count(*) FROM documents) AS docs_seen, count(*) AS docs_written,
          count(*) FILTER (n = 0) AS empty_docs, CAST(sum(chars) AS BIGINT) AS characters,
          CAST(sum(n) AS BIGINT) AS tokens FROM gapped""",
        "token_offsets": f"{TOKENS} SELECT split, ordinal, CAST(n_tokens AS INT) AS n_tokens, start_offset FROM placed_tokens",
        "token_windows": f"{TOKENS}, {WINDOW} SELECT window_id, start, {_ids('x')} AS x, {_ids('y')} AS y FROM windows",
        "token_bin_windows": f"{TOKENS}, {WINDOW} SELECT window_id, start, {_ids('x')} AS x, {_ids('y')} AS y FROM windows",
        "token_bin_shards": f"""{TOKENS} SELECT split, 'uint16' AS dtype, "offset", least({SHARD}, total - "offset") AS tokens
          FROM (SELECT split, total, unnest(range(0, total, {SHARD})) AS "offset" FROM streams)""",
        "encode_stats_by_split": f"""{TOKENS}, gapped AS (SELECT t.split, t.n_tokens AS n, length(d.text) AS chars,
          d.text <> '' AND d.doc_id % {LOST} <> 0 AND d.doc_id % {EMPTY} <> 1 AS valid
          FROM documents d JOIN tokens t ON t.ordinal = d.doc_id + 1)
          SELECT split, count(*) AS docs_seen, count(*) FILTER (valid) AS docs_written,
          count(*) FILTER (valid AND n = 0) AS empty_docs, CAST(sum(chars) FILTER (valid) AS BIGINT) AS characters,
          CAST(sum(n) FILTER (valid) AS BIGINT) AS tokens FROM gapped GROUP BY split""",
        "dataset_meta": f"""{TOKENS} SELECT {VOCAB} AS vocab_size, 'uint16' AS dtype, {BLOCK} AS block_size,
          true AS append_eos, 3 AS eos_id,
          CAST(sum(n_tokens) FILTER (split = 'train') AS BIGINT) AS train_tokens,
          CAST(sum(n_tokens) FILTER (split = 'val') AS BIGINT) AS val_tokens,
          count(*) FILTER (split = 'train') AS train_docs, count(*) FILTER (split = 'val') AS val_docs FROM tokens""",
        # evaluation
        "bigram_counts": f"{TOKENS}, {PAIRS} SELECT prev, next, n FROM train_pairs",
        "bigram_scores": f"{TOKENS}, {SCORED} SELECT prev, next, n, round(logprob, 9) AS logprob, predicted FROM scored",
        "evaluation_report": f"{TOKENS}, {SCORED}, {REPORT}",
        "random_window_evaluation": f"{TOKENS}, {RANDOM}, {COMPARED}, {REPORT}",
        "token_bin_evaluation": f"{TOKENS}, {SCORED}, {REPORT}",
        "split_evaluation": f"{TOKENS}, {BY_DRAW}, {by_draw(COMPARED)}, {by_draw(REPORT)}",
        "top_k_distribution": f"""{TOKENS}, {PAIRS}, ranked AS (SELECT prev AS context, next AS token,
            ln(n) / {TEMPERATURE} AS logit, rank() OVER (PARTITION BY prev ORDER BY n DESC) AS place FROM train_pairs)
          SELECT context, token, round(exp(logit) / sum(exp(logit)) OVER w, 9) AS probability
          FROM ranked WHERE place <= {TOP_K} WINDOW w AS (PARTITION BY context)""",
    }
