"""SQL counterparts of the operator queries, where SQL can express them."""

from __future__ import annotations

from inkmill.llm.settings import RULES, WORDS
from inkmill.llm.url_filter import _BIN_WIDTH, BINS, MASS, ORDER

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()


def lowered(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
) WHERE rank <= 5
"""


def url_sql() -> str:
    fits = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{rest}') THEN "
        for h, _, rest in (rule.partition("/") for _, rule in sorted(RULES, key=lambda r: -len(r[1])))
    ]
    ordered = sorted(RULES, key=lambda r: -len(r[1]))
    rule = "CASE " + " ".join(f"{fit}'{r}'" for fit, (_, r) in zip(fits, ordered)) + " END"
    verdict = "CASE " + " ".join(f"{fit}'{v}'" for fit, (v, _) in zip(fits, ordered)) + " END"
    keys = ", ".join(
        f"substr(gram, {ORDER - k + 1}, {k}) AS e{k}, substr(gram, {ORDER - k + 1}, {k - 1}) AS c{k}"
        for k in range(1, ORDER + 1)
    )
    sums = ", ".join(
        f"sum({side}) OVER (PARTITION BY {key}) AS {side}_{key}"
        for k in range(1, ORDER + 1)
        for key in (f"e{k}", f"c{k}")
        for side in ("good", "bad")
    )

    def probability(side: str) -> str:
        p = "(1.0::DOUBLE / 32)"
        for k in range(1, ORDER + 1):
            p = f"(({side}_e{k} + {MASS}::DOUBLE * {p}) / ({side}_c{k} + {MASS}::DOUBLE))"
        return p

    return f"""
WITH parts AS (
  SELECT page_id,
         coalesce({lowered("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *, {rule} AS rule, {verdict} AS label,
         regexp_replace(translate(host || path, '{_UPPER}0123456789', '{_LOWER}0000000000'),
                        '(?s)[^a-z0._/\\-]', '~', 'g') AS text
  FROM parts
), texts AS (
  SELECT text, count(*) FILTER (label = 'allow') AS good, count(*) FILTER (label = 'block') AS bad
  FROM ruled GROUP BY text
), each AS (
  SELECT text, good, bad, substr('{"^" * (ORDER - 1)}' || text, i, {ORDER}) AS gram
  FROM (SELECT *, unnest(range(1, length(text) + 1)) AS i FROM texts)
), grams AS (
  SELECT gram, sum(good)::BIGINT AS good, sum(bad)::BIGINT AS bad FROM each GROUP BY gram
), ratios AS (
  SELECT gram, round(ln({probability("good")} / {probability("bad")}) * 1000000)::BIGINT AS ratio
  FROM (SELECT *, {sums} FROM (SELECT *, {keys} FROM grams))
), totals AS (
  SELECT sum(good) AS good_all, sum(bad) AS bad_all FROM texts
), scored AS (
  SELECT text, any_value(good) AS good, any_value(bad) AS bad,
         CASE WHEN (SELECT good_all * bad_all FROM totals) = 0 THEN 0
              ELSE floor(sum(ratio)::DOUBLE / length(text))::BIGINT END AS score
  FROM each JOIN ratios USING (gram) GROUP BY text
), binned AS (
  SELECT least(greatest(floor(score / {_BIN_WIDTH}.0::DOUBLE), -{BINS // 2}), {BINS // 2})::BIGINT AS bin,
         sum(good) AS good, sum(bad) AS bad
  FROM (SELECT * FROM scored UNION ALL SELECT text, good, bad, 0 FROM texts WHERE text = '') GROUP BY 1
), gains AS (
  SELECT bin, (good_all - coalesce(sum(good) OVER below, 0)) * bad_all
              + coalesce(sum(bad) OVER below, 0) * good_all AS gain
  FROM binned, totals WHERE good_all * bad_all > 0 AND good + bad > 0
  WINDOW below AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), cut AS (
  SELECT coalesce((SELECT bin * {_BIN_WIDTH} FROM gains ORDER BY gain DESC, bin LIMIT 1), 0) AS cut
)
SELECT page_id, host, path, rule,
       coalesce(label, CASE WHEN coalesce(score, 0) >= cut THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN label IS NULL THEN coalesce(score, 0)::BIGINT END AS score
FROM ruled LEFT JOIN scored USING (text), cut
"""


OP4 = f"""
WITH m AS (
  SELECT DISTINCT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS name, coalesce(text, '') AS text,
         0::BIGINT AS segment
  FROM conversations
), p AS (
  SELECT DISTINCT conv_id, name AS speaker FROM m WHERE name <> 'system'
), parts AS (
  SELECT m.conv_id, speaker, segment, turn, name, text, name = speaker AS own,
         CASE WHEN name = speaker THEN '<|assistant|>' || chr(10)
              WHEN name = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user|>' || chr(10) END AS head,
         CASE WHEN name = speaker OR name = 'system' THEN text ELSE name || ': ' || text END
           || '<|end|>' || chr(10) AS body
  FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (
    PARTITION BY conv_id, speaker, segment ORDER BY turn NULLS FIRST, name, text) AS stop
  FROM parts
)
SELECT conv_id, speaker, segment, count(*) AS n_messages, count(*) FILTER (own) AS n_own,
       string_agg(head || body, '' ORDER BY turn NULLS FIRST, name, text) AS text,
       coalesce(string_agg((stop - length(body))::BIGINT || '-' || stop::BIGINT, ',' ORDER BY stop) FILTER (own), '') AS spans
FROM placed GROUP BY conv_id, speaker, segment
"""

_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP7 = f"""
WITH d AS (
  SELECT doc_id, coalesce({_WORDS.format(lowered("text"))}, []) AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS.format(lowered("text"))} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT doc_id, item_id, i, places.n FROM places JOIN windows ON places.g = windows.g AND places.n = windows.n
), covered AS (
  SELECT doc_id, count(*) AS n_hit FROM (
    SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits)
  ) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits
  ) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP8 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) || '0' AS hex FROM pages
), f AS (
  SELECT html, min(page_id) AS first FROM p GROUP BY html
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (((('0x' || substr(hex, (i * 5) // 4 + 1, 2))::INTEGER >> (3 - (i * 5) % 4)) & 31) + 1)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p JOIN f USING (html)
"""

_SHINGLE = " || ' ' || ".join(f"w[i + {k}]" for k in range(WORDS))
OP10 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce({lowered("text")}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN []
         WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - {WORDS - 2}), lambda i: {_SHINGLE}) END) AS g
  FROM d
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL
  ) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM reach JOIN d ON d.doc_id = reach.a LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


# Polynomial of the checksum: a fixed value. The table of its bytes is built by rule.
OP12 = r"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT range::BIGINT AS i FROM range(256))
),
runs AS (
  SELECT doc_id, """ + lowered(r"unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+'))") + r""" AS run
  FROM documents
),
long_runs AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
coded AS (
  SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM long_runs
),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, length(bytes) + 1, 2), lambda i: ('0x' || substr(bytes, i, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM coded, crc_table
),
changed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
holes AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
  SELECT a.word AS word, b.word AS other FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.rest, a.word FROM holes a SEMI JOIN words w ON a.rest = w.word
  UNION SELECT a.word, a.rest FROM holes a SEMI JOIN words w ON a.rest = w.word
),
ranked AS (
  SELECT p.word, p.other, w.n, row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.other) AS r,
    count(*) OVER (PARTITION BY p.word) AS n_near
  FROM pairs p JOIN words w ON w.word = p.other
),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(r.n_near, 0)::BIGINT AS n_near,
    CASE WHEN r.n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.r = 1
),
chains AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
),
ends AS (SELECT c.word, c.root FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_bitsliced_topk": OP1,
        "op2_url_filter": url_sql(),
        "op4_chat_rotation": OP4,
        "op7_decontamination": OP7,
        "op8_warc": OP8,
        "op10_superminhash": OP10,
        "op12_spelling_variants": OP12,
    }
