"""Character classes as Java regex fragments.

The classes follow Python's ``str`` predicates. Java's own ``\\s`` and ``\\d`` are ASCII
only, so they are never used.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache


def _java_escape(code_point: int) -> str:
    return "\\x{%X}" % code_point


def _ranges(code_points) -> str:
    """Ascending code points as a class body.

    Characters below 256 are listed one by one, which Java tests with a single bit-set
    lookup. The ranges above are guarded by one comparison, so that Latin text does not pay
    for each of them.
    """
    low: list[int] = []
    high: list[list[int]] = []
    for cp in code_points:
        if cp < 256:
            low.append(cp)
        elif high and cp == high[-1][1] + 1:
            high[-1][1] = cp
        else:
            high.append([cp, cp])
    body = "".join(map(_java_escape, low))
    if high:
        ranges = "".join(f"{_java_escape(a)}-{_java_escape(b)}" for a, b in high)
        body += rf"[\x{{100}}-\x{{10FFFF}}&&[{ranges}]]"
    return body


@cache
def space_chars() -> str:
    """All characters for which ``str.isspace`` holds."""
    return "".join(c for c in map(chr, range(0x3001)) if c.isspace())


@cache
def space_class() -> str:
    return _ranges(map(ord, space_chars()))


@cache
def inline_space_class() -> str:
    """``space_class`` without the newline."""
    return _ranges(ord(c) for c in space_chars() if c != "\n")


@cache
def white_space_property() -> str:
    """Unicode White_Space: ``isspace`` without the four ASCII separators 1C-1F."""
    return _ranges(ord(c) for c in space_chars() if not "\x1c" <= c <= "\x1f")


@cache
def digit_class() -> str:
    """``str.isdigit``: decimal digits plus digit-valued characters such as superscripts."""
    extra = (
        cp
        for cp in range(sys.maxunicode + 1)
        if chr(cp).isdigit() and unicodedata.category(chr(cp)) != "Nd"
    )
    return r"\p{Nd}" + _ranges(extra)
