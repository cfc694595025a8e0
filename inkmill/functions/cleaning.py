"""Text cleaning as Column expressions.

Everything is built-in except NFC. No pattern restarts inside a run of spaces, so a very
long run costs linear time.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions import unicode_classes as uc

# Above Latin: characters that can neither change under NFC nor combine with a neighbour
# (Greek and Cyrillic letters without marks, common punctuation, unified ideographs).
_NFC_INERT = (
    r"\x{391}-\x{3A9}\x{3B1}-\x{3C9}\x{400}-\x{482}\x{48A}-\x{52F}"
    r"\x{2010}-\x{2027}\x{2030}-\x{205E}\x{20A0}-\x{20CF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}"
)
# Latin is settled by the first comparison: nothing below the first combining mark changes.
_NFC_TOUCHED = rf"[\x{{300}}-\x{{10FFFF}}&&[^{_NFC_INERT}]]"


@F.arrow_udf(T.StringType())
def _nfc(text: pa.Array) -> pa.Array:
    return pa.array([t and unicodedata.normalize("NFC", t) for t in text.to_pylist()], pa.string())


def nfc(text: Column) -> Column:
    """Unicode NFC. Only texts with a character that NFC can touch are sent to Python."""
    touched = F.when(text.rlike(_NFC_TOUCHED), text)
    return F.coalesce(_nfc(touched), text)


def unify_newlines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def plain_blanks(text: Column) -> Column:
    """Form feed becomes a newline, no-break space and tab become a space."""
    text = F.replace(text, F.lit("\x0c"), F.lit("\n"))
    text = F.replace(text, F.lit("\xa0"), F.lit(" "))
    return F.replace(text, F.lit("\t"), F.lit(" "))


def rstrip_lines(text: Column) -> Column:
    spaces = F.lit(uc.space_chars())
    return F.array_join(F.transform(F.split(text, "\n"), lambda s: F.rtrim(s, spaces)), "\n")


def collapse_blank_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " {2,}", " ")


def strip(text: Column) -> Column:
    """``str.strip``: all Unicode white space, not just the ASCII blank."""
    return F.btrim(text, F.lit(uc.space_chars()))


def normalize_text(text: Column) -> Column:
    text = rstrip_lines(plain_blanks(unify_newlines(nfc(text))))
    return strip(collapse_spaces(collapse_blank_lines(text)))


def header_footer_pattern() -> str:
    """A stripped line that is a page number, roman numeral, ruler or tiny numbered mark."""
    return (
        rf"^(?:(?=[\s\S]{{0,2}}[{uc.digit_class()}])[\s\S]{{1,3}}"
        r"|[IVXLCDM]+\.?"
        r"|[-_=*·•~ ]{4,}"
        r"|\p{Nd}+)\z"
    )


def is_header_footer(line: Column) -> Column:
    return strip(line).rlike(header_footer_pattern())


def is_symbol_soup(line: Column) -> Column:
    """Eight or more characters, over 55 % of them neither alphanumeric nor space."""
    symbols = F.length(F.regexp_replace(line, rf"[\p{{L}}\p{{N}}{uc.space_class()}]+", ""))
    return (F.length(line) >= 8) & (symbols / F.greatest(F.length(line), F.lit(1)) > 0.55)


def _is_body_line(line: Column) -> Column:
    return ~line.rlike(header_footer_pattern()) & ~is_symbol_soup(line)


def drop_noise_lines(text: Column) -> Column:
    """Strip each line, keep blank ones, drop header/footer and symbol lines."""
    lines = F.transform(F.split(text, "\n"), strip)
    return F.array_join(F.filter(lines, _is_body_line), "\n")


def clean_for_model(text: Column) -> Column:
    """``normalize_text``, ``drop_noise_lines``, then collapse and strip again.

    Written as three passes over the text instead of a dozen, with the same result: blanks
    are unified and collapsed in one replacement, every line ending is handled by the split,
    and line-end spaces fall away when the lines are stripped.
    """
    text = F.regexp_replace(nfc(text), r" [ \t\xa0]+|[\t\xa0][ \t\xa0]*", " ")
    lines = F.transform(F.split(text, r"\r\n?|[\n\x0c]"), strip)
    return strip(collapse_blank_lines(F.array_join(F.filter(lines, _is_body_line), "\n")))
