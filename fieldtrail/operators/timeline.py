"""Window functions along an entity's timeline, for timelines of any length.

A window per entity puts all its rows into one task. That is right for almost
all entities, but one entity may hold a large share of a change log. Such
entities are found first (:func:`find_hot`), their timelines are cut into
segments of similar size, the windows run per segment, and what crosses a
segment border (last known value, neighbouring row, row count) is carried over
in a small table with one row per segment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.sources.tables import read_written, write_table

SEGMENT, _SECOND = "_segment", "_second"


def _second(time: str) -> Column:
    return F.unix_seconds(F.col(time).cast("timestamp"))


def find_hot(df: DataFrame, keys: Sequence[str], time: str, cfg: Config, path: str) -> DataFrame | None:
    """The seconds of the entities with ``hot_rows`` rows or more, each with its segment; None if there are none.

    An action: what it finds is written below ``path``, and read from there ever after. Any number of entities may be
    hot, and any number of segments be cut from one; a segment has about ``hot_rows`` rows, or one second.
    """
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") >= cfg.hot_rows)
    write_table(counts, f"{path}/entities")
    entities = read_written(counts, f"{path}/entities")
    if entities.isEmpty():
        return None
    seconds = (
        df.withColumn(_SECOND, _second(time))
        .join(entities.select(*keys), keys, "left_semi")
        .groupBy(*keys, _SECOND)
        .agg(F.count("*").alias("rows"))
    )
    before = F.sum("rows").over(Window.partitionBy(*keys).orderBy(_SECOND)) - F.col("rows")
    segments = seconds.select(*keys, _SECOND, F.floor(before / cfg.hot_rows).cast("int").alias(SEGMENT))
    write_table(segments, f"{path}/segments")
    return read_written(segments, f"{path}/segments")


def with_segments(df: DataFrame, hot: DataFrame | None, keys: Sequence[str], time: str) -> DataFrame:
    """Add the segment number: -1 for ordinary entities, else 0, 1, ... along time.

    It is a function of the second, so rows of one instant stay together.
    """
    if hot is None:
        return df
    joined = df.withColumn(_SECOND, _second(time)).join(hot, [*keys, _SECOND], "left").drop(_SECOND)
    return joined.withColumn(SEGMENT, F.coalesce(SEGMENT, F.lit(-1)))


def _pack(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns]) if columns else F.struct(F.lit(True).alias("_any"))


def along(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    fill: Sequence[str] = (),
    lead: Mapping[str, str] | None = None,
    lag: Mapping[str, str] | None = None,
    number: str | None = None,
) -> DataFrame:
    """Window functions per entity, in ``order`` (ascending, nulls first).

    fill    columns replaced by their last non-null value so far
    lead    new column -> column read from the next row
    lag     new column -> column read from the previous row
    number  new column with the row number
    """
    keys, order, lead, lag = list(keys), list(order), dict(lead or {}), dict(lag or {})
    segmented = SEGMENT in df.columns
    window = Window.partitionBy(*keys, *([SEGMENT] if segmented else [])).orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not segmented:
        new = {out: F.lead(c).over(window) for out, c in lead.items()}
        new |= {out: F.lag(c).over(window) for out, c in lag.items()}
        new |= {c: F.last(c, ignorenulls=True).over(so_far) for c in fill}
        if number:
            new[number] = F.row_number().over(window).cast("long")
        return df.withColumns(new)

    next_cols, last_cols = sorted(set(lead.values())), sorted(set(lag.values()))
    at = F.struct(*order)
    summary = (
        df.filter(F.col(SEGMENT) >= 0)
        .groupBy(*keys, SEGMENT)
        .agg(
            F.min_by(_pack(next_cols), at).alias("_first"),
            F.max_by(_pack(last_cols), at).alias("_last"),
            F.count("*").alias("_rows"),
            *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_fill_{c}") for c in fill],
        )
    )
    by_segment = Window.partitionBy(*keys).orderBy(SEGMENT)
    earlier = by_segment.rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *keys,
        SEGMENT,
        F.lead("_first").over(by_segment).alias("_next"),
        F.lag("_last").over(by_segment).alias("_previous"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        *[F.last(f"_fill_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in fill],
    )
    local = df.withColumns(
        {
            "_lead": F.lead(_pack(next_cols)).over(window),
            "_lag": F.lag(_pack(last_cols)).over(window),
            "_number": F.row_number().over(window),
            **{f"_local_{c}": F.last(c, ignorenulls=True).over(so_far) for c in fill},
        }
    )
    merged = local.join(carried, [*keys, SEGMENT], "left")
    following, preceding = F.coalesce("_lead", "_next"), F.coalesce("_lag", "_previous")
    new = {out: following[c] for out, c in lead.items()}
    new |= {out: preceding[c] for out, c in lag.items()}
    new |= {c: F.coalesce(f"_local_{c}", f"_carry_{c}") for c in fill}
    if number:
        new[number] = (F.col("_number") + F.coalesce("_before", F.lit(0))).cast("long")
    kept = [c for c in df.columns if c not in new]
    return merged.select(*kept, *[value.alias(name) for name, value in new.items()])
