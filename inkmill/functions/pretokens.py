"""Byte-level pre-tokens and symbol strings.

A word is handled as a *symbol string*: one code point per BPE symbol, in id order. A merge
of two symbols is then a plain string ``replace`` (left to right, non-overlapping), and
comparing symbol strings compares ids.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions import unicode_classes as uc

# Special tokens, with ids 0 to 3.
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[BOS]", "[EOS]"]
FIRST_BYTE_ID = len(SPECIAL_TOKENS)


@cache
def byte_chars() -> list[str]:
    """The printable character that stands for each byte in vocabulary files.

    Printable Latin-1 characters stand for themselves; the other bytes take the code points
    from 256 up, in byte order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + others.index(b)) for b in range(256)]


@cache
def bytes_by_id() -> list[int]:
    """Byte values in the order of their symbol ids (sorted by stand-in character)."""
    return sorted(range(256), key=lambda b: byte_chars()[b])


def symbol_char(symbol_id: int) -> str:
    """The code point of a symbol id, ascending and clear of the surrogates."""
    cp = 0x100 + symbol_id
    return chr(cp if cp < 0xD800 else cp + 0x800)


def symbol_id(char: str) -> int:
    cp = ord(char)
    return (cp if cp < 0xD800 else cp - 0x800) - 0x100


def _word_pattern() -> str:
    ws = uc.white_space_property()
    # Fixed value: the published byte-level pre-token pattern, with Unicode white space.
    return (
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
        rf"| ?[^{ws}\p{{L}}\p{{N}}]+|[{ws}]+(?![^{ws}])|[{ws}]+"
    )


def pretokens(text: Column) -> Column:
    """Words of a normalised text; joined, they give the text back."""
    return F.regexp_extract_all(text, F.lit(_word_pattern()), F.lit(0))


def pretokens_with_specials(text: Column) -> Column:
    """Like ``pretokens``, but special tokens written out in the text are one word each."""
    names = "|".join(rf"\[{name[1:-1]}\]" for name in SPECIAL_TOKENS)
    parts = F.split(text, rf"(?={names})|(?<={names})")
    special = [F.lit(s) for s in SPECIAL_TOKENS]
    words = F.transform(parts, lambda s: F.when(s.isin(*special), F.array(s)).otherwise(pretokens(s)))
    return F.when(text.rlike(names), F.flatten(words)).otherwise(pretokens(text))


def to_symbols(word: Column) -> Column:
    """UTF-8 bytes of a word as a symbol string."""
    latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    order = bytes_by_id()
    source = "".join(map(chr, order))
    target = "".join(symbol_char(FIRST_BYTE_ID + i) for i in range(256))
    return F.translate(latin, source, target)


def adjacent_pairs(symbols: Column) -> Column:
    """All two-character substrings, overlapping ones included."""
    return F.regexp_extract_all(symbols, F.lit(r"(?s)(?=(..))"), F.lit(1))
