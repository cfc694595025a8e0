"""URL filter, WARC archives and chat rotation."""

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from inkmill.llm import chat_rotation, url_filter, warc
from inkmill.llm.settings import RULES

PAGES = "page_id long, url string, html string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- URL filter ----------------------------------------------------------------------------


def brute_urls(urls, rules):
    parts = []
    for i, url in urls:
        found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = found.groups() if found else ("", "")
        host = host.translate({c: c + 32 for c in range(65, 91)})
        fit = None
        for verdict, rule in rules:
            rule_host, _, rest = rule.partition("/")
            inside = host == rule_host or host.endswith("." + rule_host)
            if inside and path.startswith("/" + rest) and (not fit or len(rule) > len(fit[0])):
                fit = (rule, verdict)
        text = (host + path).translate({c: c + 32 for c in range(65, 91)})
        text = re.sub(r"[^a-z0._/\-]", "~", re.sub("[0-9]", "0", text))
        parts.append((i, host, path, fit, text))
    grams = lambda t: [("^^^" + t)[k : k + 4] for k in range(len(t))]
    counts = {"allow": Counter(), "block": Counter()}
    contexts = {"allow": Counter(), "block": Counter()}
    labels = defaultdict(Counter)
    for _, _, _, fit, text in parts:
        if fit:
            labels[text][fit[1]] += 1
            for g in grams(text):
                for k in range(1, 5):
                    counts[fit[1]][g[4 - k :]] += 1
                    contexts[fit[1]][k, g[4 - k : 3]] += 1

    def probability(side, g):
        p = 1 / 32
        for k in range(1, 5):
            p = (counts[side][g[4 - k :]] + 2 * p) / (contexts[side][k, g[4 - k : 3]] + 2)
        return p

    both = any(f and f[1] == "allow" for *_, f, _ in parts) and any(
        f and f[1] == "block" for *_, f, _ in parts
    )

    def score(text):
        if not both or not text:
            return 0
        ratios = [
            math.floor(math.log(probability("allow", g) / probability("block", g)) * 1e6 + 0.5)
            for g in grams(text)
        ]
        return math.floor(sum(ratios) / len(text))

    cut = 0
    if both:
        bins = {t: max(-2000, min(2000, score(t) // 5000)) for t in labels}
        sums = [(b, labels[t]["allow"], labels[t]["block"]) for t, b in bins.items()]
        good, bad = sum(s[1] for s in sums), sum(s[2] for s in sums)
        best = max(
            (
                sum(g for b, g, _ in sums if b >= at) * bad + sum(x for b, _, x in sums if b < at) * good,
                -at,
            )
            for at in set(bins.values())
        )
        cut = -best[1] * 5000
    out = []
    for i, host, path, fit, text in parts:
        verdict = fit[1] if fit else "allow" if score(text) >= cut else "block"
        out.append((i, host, path, fit[0] if fit else None, verdict, None if fit else score(text)))
    return sorted(out, key=repr)


URLS = [
    "http://a.example.com/en/1",
    "https://WWW.Example.com/en/2?x=1",
    "http://b.example.com/fr/3#top",
    "http://com/x",
    "http://acom/x",
    "http://com",
    "http://x.net/es/4",
    "http://x.net/fr/5",
    "http://x.net/en/6",
    "http://x.org/es/7",
    "mailto:someone",
    "",
    None,
    "http://",
    "https://ünï.org/päth?q",
    "https://host/" + "long/" * 20_000,
    "a://b.net/es/c://d.com/",
    "http://x.net/es/4",
    "line\nbreak://x.net/fr/\n9",
]


def test_urls_against_brute_force(spark):
    urls = list(enumerate(URLS)) + [(3, URLS[3])]
    pages = spark.createDataFrame([(i, u, "text") for i, u in urls], PAGES)
    got = url_filter.judge_urls(pages, RULES)
    names = ["page_id", "host", "path", "rule", "verdict", "score"]
    assert rows(got.select(names)) == brute_urls(urls, RULES)
    assert "html" in got.columns
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_urls_without_training_texts(spark):
    urls = [(1, "http://x.org/a"), (2, None), (3, "http://y.com/")]
    pages = spark.createDataFrame([(i, u, None, "h") for i, u in urls], PAGES + ", host string")
    got = url_filter.judge_urls(pages, RULES)
    assert {r["page_id"]: r["verdict"] for r in got.collect()} == {1: "allow", 2: "allow", 3: "allow"}
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


# --- WARC ----------------------------------------------------------------------------------


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute_pages(pages, least=0):
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in pages:
        html = html or ""
        again = i is not None and i > first[html] and len(html.encode()) >= least
        kind = "revisit" if again else "response"
        out.append((i, len(html.encode()), sha1(html), kind, first[html] if again else None))
    return sorted(out, key=repr)


FAKE = (
    "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\n"
    "Content-Length: 4\r\n\r\nabcd\r\n\r\n"
)
WEB = [
    (1, "http://a/", "<p>one</p>"),
    (2, "http://b/", "<p>one</p>"),
    (0, "http://c/", "<p>one</p>"),
    (3, None, None),
    (4, "http://d/\r\nX-Evil: 1", ""),
    (5, "http://e/", "before " + FAKE + " after"),
    (6, "http://f/", "WARC/1.1\r\n"),
    (7, "http://g/", "ends with WARC/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 100000\r\n\r\n"),
    (8, "http://h/", "é" * 40_000 + FAKE * 20 + "漢" * 40_000),
    (9, "http://i/", "\r\n\r\n\r\n"),
    (None, "http://j/", "no id"),
    (9, "http://i/", "\r\n\r\n\r\n"),
    (10, "http://k/", "<p>two</p>"),
]


@pytest.mark.parametrize("split", ["128m", "7k"])
def test_warc_round_trip(spark, folder, split):
    pages = spark.createDataFrame(WEB, PAGES).repartition(2)
    warc.write_warc(pages, f"{folder}/warc")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        assert rows(warc.read_warc(spark, f"{folder}/warc")) == brute_pages(WEB)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_small_payloads_stay_responses(spark, folder):
    warc.write_warc(spark.createDataFrame(WEB, PAGES), f"{folder}/warc", revisit_bytes=1_000)
    assert rows(warc.read_warc(spark, f"{folder}/warc")) == brute_pages(WEB, 1_000)


def test_no_pages(spark, folder):
    warc.write_warc(spark.createDataFrame([], PAGES), f"{folder}/warc")
    assert warc.read_warc(spark, f"{folder}/warc").count() == 0


def test_chain_ends_at_a_gap(spark):
    links = [("f", 0, 10), ("f", 10, 25), ("f", 20, 30), ("f", 25, 99), ("f", 30, 40), ("g", 5, 9)]
    got = warc.reachable(spark.createDataFrame(links, "file string, offset long, successor long"))
    assert rows(got) == [("f", 0), ("f", 10), ("f", 25)]


# --- chat rotation -------------------------------------------------------------------------

TURNS = [
    (1, 0, "system", "Be kind."),
    (1, 1, "ann", "Hi"),
    (1, 2, "bob", "Hello\nthere"),
    (1, 3, "cy", None),
    (1, 2, "bob", "Hello\nthere"),
    (2, 0, None, "alone"),
    (2, None, "", "x"),
    (3, 0, "system", "nobody speaks"),
    (None, 0, "ann", "lost"),
    (4, 5, "ann", "one"),
    (4, 70, "bob", "two"),
    *[(5, i, ("ann", "bob", "cy")[i % 3], f"turn {i} " + "long " * (20_000 * (i == 77))) for i in range(130)],
]


def brute_chats(turns, segment_turns=None):
    talks = defaultdict(set)
    for conv, turn, role, text in turns:
        talks[conv].add((turn, role or "unknown", text or ""))
    out = []
    for conv, messages in talks.items():
        for speaker in {m[1] for m in messages} - {"system"}:
            parts = defaultdict(list)
            for m in sorted(messages, key=lambda m: (m[0] is not None, m[0] or 0, *m[1:])):
                part = 0 if segment_turns is None else m[0] if m[0] is None else m[0] // segment_turns
                parts[part].append(m)
            for segment, part in parts.items():
                text, spans = "", []
                for _, name, words in part:
                    own = name == speaker
                    role = "assistant" if own else name if name == "system" else "user"
                    text += f"<|{role}|>\n"
                    start = len(text)
                    text += words if own or role == "system" else f"{name}: {words}"
                    text += "<|end|>\n"
                    if own:
                        spans.append((start, len(text)))
                out.append((conv, speaker, segment, len(part), len(spans), text, spans))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment_turns", [None, 64])
def test_chats_against_brute_force(spark, segment_turns):
    kind = "conv_id long, turn long, role string, text string"
    turns = spark.createDataFrame(TURNS, kind).withColumn("speaker", F.lit("clash"))
    df = chat_rotation.rotate(turns, segment_turns)
    got = [
        (r["conv_id"], r["speaker"], r["segment"], r["n_messages"], r["n_own"], r["text"],
         [tuple(s) for s in r["spans"]])
        for r in df.collect()
    ]
    assert sorted(got, key=repr) == brute_chats(TURNS, segment_turns)
    for r in df.collect():
        own = [m["content"] + "<|end|>\n" for m in r["messages"] if m["mask"]]
        assert [r["text"][s["start"] : s["end"]] for s in r["spans"]] == own
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())
    assert chat_rotation.rotate(spark.createDataFrame([], kind)).count() == 0
