"""The given texts with defects that the cleaning rules mend, the same way in both engines.

Every row and every character of the tables is read; only what stands between words changes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands in a text, and what comes in its place, in this order.
WEAR = [
    ("\u00e9", "e\u0301"),
    ("\u00fc", "u\u0308"),
    (" a", "\ta"),
    (" d", "\u00a0d"),
    (", ", ",   "),
    (". A", ".\r\nA"),
    (". D", ".\rD"),
    (". E", ". \t\nE"),
    (". I", ".\fI"),
    (". L", ".\n\n\n\n\nL"),
    (". O", ".\n 12 \nO"),
    (". R", ".\nXIV.\nR"),
    (". S", ".\n-----\nS"),
    (". T", ".\n##@@!!%%^^&&**\nT"),
    (". U", ".\n1984\nU"),
]
LOST, EMPTY = 97, 89  # every 97th text is null, every 89th empty
LISTED = 11  # every 11th document becomes a list of words


def worn(text: Column) -> Column:
    for old, new in WEAR:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.concat(F.lit(" \n"), text, F.lit("\n\t "))


def gaps(text: Column, key: Column) -> Column:
    """``text`` with nulls and empty texts at keys that both engines know."""
    return F.when(key % LOST == 0, F.lit(None)).when(key % EMPTY == 1, F.lit("")).otherwise(text)


def listed(text: Column, key: Column) -> Column:
    return F.when(key % LISTED == 2, F.replace(text, F.lit(" "), F.lit("\n"))).otherwise(text)


def _literal(value: str) -> str:
    quoted = value.replace("'", "''")
    return "'" + "".join(c if c.isprintable() else f"' || chr({ord(c)}) || '" for c in quoted) + "'"


def worn_sql(text: str) -> str:
    for old, new in WEAR:
        text = f"replace({text}, {_literal(old)}, {_literal(new)})"
    return f"({_literal(chr(32) + chr(10))} || {text} || {_literal(chr(10) + chr(9) + chr(32))})"


def gaps_sql(text: str, key: str) -> str:
    return f"CASE WHEN {key} % {LOST} = 0 THEN NULL WHEN {key} % {EMPTY} = 1 THEN '' ELSE {text} END"


def listed_sql(text: str, key: str) -> str:
    return f"CASE WHEN {key} % {LISTED} = 2 THEN replace({text}, ' ', chr(10)) ELSE {text} END"
