"""Raw tables of one or more sources -> staged tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtrail.config import Config
from fieldtrail.sources.schemas import OPTIONAL_TABLES, RAW_COLUMNS, STAGED
from fieldtrail.sources.tables import LazyTables, read_table

SOURCE = "source_relation"


def _columns(schema: str) -> list[tuple[str, str]]:
    """A column list ``name type, ...`` as pairs."""
    return [tuple(column.split()) for column in schema.split(",")]


def _typed(df: DataFrame, schema: str) -> dict[str, str]:
    """Column -> SQL text of its value in ``df``, cast; missing columns are null."""
    have = {c.lower(): c for c in df.columns}
    return {
        name: f"cast(`{have[name]}` as {kind})" if name in have else f"cast(null as {kind})"
        for name, kind in _columns(schema)
    }


def conform(df: DataFrame, schema: str, *extra: str) -> DataFrame:
    """Exactly the columns of ``schema``: cast, missing ones null, others dropped."""
    return df.selectExpr(*extra, *[f"{value} as `{name}`" for name, value in _typed(df, schema).items()])


def union_sources(sources: Mapping[str, DataFrame], cfg: Config | None = None) -> DataFrame:
    """Stack the same table of several sources; ``source_relation`` tells them apart."""
    keep_case = cfg is not None and cfg.preserve_source_case
    tagged = [
        df.withColumn(SOURCE, F.lit(name if keep_case else name.lower())) for name, df in sources.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def with_aliases(df: DataFrame, cfg: Config) -> DataFrame:
    return df.withColumnsRenamed(dict(cfg.column_aliases)) if cfg.column_aliases else df


def not_deleted(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(F.col("_deleted"), F.lit(False)))


def stage(table: str, raw: DataFrame, cfg: Config) -> DataFrame:
    """Conform, drop soft-deleted rows, rename and cast one table, in one projection."""
    spec = STAGED[table]
    raw = with_aliases(raw, cfg)
    if SOURCE not in raw.columns:
        raw = raw.withColumn(SOURCE, F.lit(""))
    value = _typed(raw, RAW_COLUMNS[table])
    if "_deleted" in value:
        raw = raw.filter(f"not coalesce({value['_deleted']}, false)")
    merged = {c for _, columns in spec.fallback for c in columns}
    casts = dict(spec.cast)
    plain = [
        f"cast({v} as {casts[c]}) as `{spec.rename.get(c, c)}`" if c in casts else f"{v} as `{spec.rename.get(c, c)}`"
        for c, v in value.items()
        if c not in spec.drop and c not in merged
    ]
    fallback = [f"coalesce({', '.join(value[c] for c in columns)}) as `{name}`" for name, columns in spec.fallback]
    return raw.selectExpr(SOURCE, *plain, *fallback)


def stage_all(raw: Mapping[str, DataFrame], cfg: Config) -> Mapping[str, DataFrame]:
    """Stage every table that the site has; optional tables switched off are left out."""

    def in_use(table: str) -> bool:
        return table in raw and getattr(cfg, OPTIONAL_TABLES.get(table, ""), True)

    return LazyTables({t: (lambda t=t: stage(t, raw[t], cfg)) for t in STAGED if in_use(t)})


def read_sources(
    spark: SparkSession,
    roots: Mapping[str, str],
    cfg: Config,
    folders: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Read ``<root>/<table>`` Parquet of each source and stack them per table.

    ``folders`` maps a table to its folder name where that differs. A source that
    lacks a table contributes no rows to it.
    """
    raw: dict[str, DataFrame] = {}
    for table, schema in RAW_COLUMNS.items():
        folder = (folders or {}).get(table, table)
        found = {name: read_table(spark, f"{root.rstrip('/')}/{folder}") for name, root in roots.items()}
        found = {
            name: conform(with_aliases(df, cfg), schema) for name, df in found.items() if df is not None
        }
        if found:
            raw[table] = union_sources(found, cfg)
    return raw
