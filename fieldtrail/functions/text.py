"""Text expressions: column names, keys, joined lists, numbers in text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

LIST_SEPARATOR = ", "
KEY_SEPARATOR = "-"
KEY_NULL = "_null_"


def slugify(name: str) -> str:
    """A field name as a column name: ``Story Points`` -> ``story_points``."""
    slug = re.sub(r"[ -]+", "_", name.lower())
    slug = re.sub(r"[^a-z0-9_]+", "", slug)
    return f"_{slug}" if slug[:1].isdigit() else slug


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts as text. Cast timestamps with :func:`instant_text` first."""
    return F.md5(
        F.concat_ws(KEY_SEPARATOR, *[F.coalesce(p.cast("string"), F.lit(KEY_NULL)) for p in parts])
    )


def instant_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def joined(value: str, *, separator: str = LIST_SEPARATOR, order: str | None = None) -> Column:
    """The non-null values of a group as one text, in a fixed order; null if there are none."""
    sep = separator.replace("\n", "\\n")
    return F.expr(f"listagg({value}, '{sep}') within group (order by {order or value})")


def string_to_numeric(text: Column) -> Column:
    """The first number in a text, thousands separators removed; null if there is none."""
    number = F.regexp_extract(F.replace(text, F.lit(","), F.lit("")), r"-?\d+(\.\d+)?", 0)
    return number.try_cast("decimal(28,6)")
