"""What the tests of this folder share besides fixtures."""

from __future__ import annotations

#: Nulls, blanks, ties, repeated rows, and very long texts.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r"),
    (None, "no id at all but some text"),
    (None, None),
    (4, "A line that is long enough to count\nx"),
    (5, "a LINE that is long enough to count \nx"),
    (6, "\ta line that is long enough to count"),
    (6, "\ta line that is long enough to count"),
    (7, "Ünïcödé ☃ 𝔘𝔫𝔦 mixed spaces"),
    (8, "word " * 60_000),
    (9, "w" * 300_000),
]


def rows_of(df):
    return df.collect()
