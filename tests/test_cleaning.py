import unicodedata
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from inkmill.functions import cleaning as c
from inkmill.functions import unicode_classes as uc


def apply(spark, step, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", step(F.col("t")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


def test_space_class_is_python_isspace():
    assert set(uc.space_chars()) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


@pytest.mark.parametrize(
    "step, text, want",
    [
        (c.nfc, "été", "\xe9t\xe9"),
        (c.nfc, "Ω", "Ω"),
        (c.nfc, "가", "가"),
        (c.unify_newlines, "a\r\nb\rc\n\rd", "a\nb\nc\n\nd"),
        (c.plain_blanks, "d\xa0e\tf\x0cg", "d e f\ng"),
        (c.rstrip_lines, "a \x85\nb \nc　", "a\nb\nc"),
        (c.collapse_blank_lines, "a\n\n\n\nb\n\nc", "a\n\nb\n\nc"),
        (c.collapse_spaces, "b   c d", "b c d"),
        (c.strip, " \n　x\x1c", "x"),
        (c.normalize_text, "  a\r\n\t\r\n\r\n\r\nb\xa0\xa0 c \x0c", "a\n\nb c"),
        (c.normalize_text, " \n　 ", ""),
        (c.normalize_text, None, None),
        (c.drop_noise_lines, " a \n12\n\n b", "a\n\nb"),
        (c.clean_for_model, "Text\n\n12\n\nXIV.\nmore\n* * * *\nend", "Text\n\nmore\nend"),
        (c.clean_for_model, "12\nXIV", ""),
        (c.clean_for_model, None, None),
    ],
)
def test_step(spark, step, text, want):
    assert apply(spark, step, [text]) == [want]


def test_header_lines(spark):
    yes = ["12", "p7", "XIV.", "MIL", "* * * *", "٣٤٥٦", " 3 ", "²", "----"]
    no = ["", "  ", "---", "page 12", "XIVa", "abc", "XIV..", "12a4", "XIV\nX"]
    got = apply(spark, c.is_header_footer, yes + no)
    assert got == [True] * len(yes) + [False] * len(no)


def test_symbol_soup(spark):
    # seven characters are too few; five of nine symbols are just over the limit
    got = apply(spark, c.is_symbol_soup, ["#%&*+=a", "#%&*+=ab", "#a#b#c#d#", "#a#b#c#d", "a" * 20])
    assert got == [False, True, True, False, False]


def test_long_runs_of_space_are_linear(spark):
    text = "a" + " " * 300_000 + "　" * 300_000 + "b"
    assert apply(spark, c.clean_for_model, [text]) == ["a " + "　" * 300_000 + "b"]


def brute_clean(text):
    """The cleaning rules once more, line by line in plain Python."""

    def noise(line):
        if not line:
            return False
        small = len(line) < 4 and any(map(str.isdigit, line))
        body = line[:-1] if line.endswith(".") else line
        roman = bool(body) and set(body) <= set("IVXLCDM")
        rule = len(line) > 3 and set(line) <= set("-_=*·•~ ")
        number = all(unicodedata.category(ch) == "Nd" for ch in line)
        symbols = [ch for ch in line if not (ch.isalnum() or ch.isspace())]
        soup = len(line) > 7 and len(symbols) / len(line) > 0.55
        return small or roman or rule or number or soup

    def squeeze(line):
        runs = ("".join(g) for _, g in groupby(line, key=lambda ch: ch == " "))
        return "".join(" " if run.startswith(" ") else run for run in runs)

    text = unicodedata.normalize("NFC", text)
    for old, new in (("\r\n", "\n"), ("\r", "\n"), ("\x0c", "\n"), ("\xa0", " "), ("\t", " ")):
        text = text.replace(old, new)
    lines = [squeeze(line.strip()) for line in text.split("\n")]
    lines = [line for line in lines if not noise(line)]
    out = []
    for line in lines:
        if line or (out and out[-1]):
            out.append(line)
    return "\n".join(out).strip()


PIECES = [
    "word", "été", "é", " ", "  ", "\n", "\n\n\n", "\r\n", "\r", "\t", "\xa0", "\x0c",
    "　", "\x85", "\x1f", " ", "12", "XIV", ".", "----", "#%&*+=", "٣", "²", "p7",
    "\U0001f600", "A", ",", "日本",
]


def random_texts(n=400, seed=5):
    import random

    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(n)]


def test_fused_cleaning_equals_its_steps_and_brute_force(spark):
    texts = random_texts()

    def by_steps(t):
        t = c.drop_noise_lines(c.normalize_text(t))
        return c.strip(c.collapse_spaces(c.collapse_blank_lines(t)))

    fused = apply(spark, c.clean_for_model, texts)
    assert fused == apply(spark, by_steps, texts)
    assert fused == [brute_clean(t) for t in texts]


def test_cleaning_is_idempotent(spark):
    once = apply(spark, c.clean_for_model, random_texts(seed=6))
    assert apply(spark, c.clean_for_model, once) == once
