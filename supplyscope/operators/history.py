"""History log: clean, dedupe, append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.functions.scalars import parse_ts, pct_to_double, strip_ws


def trim_columns(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace from every column name."""
    return df.toDF(*[c.strip() for c in df.columns])


def filter_status(df: DataFrame, status: str = K.VALID_STATUS, strip: bool = True,
                  col: str = "estado") -> DataFrame:
    """Keep rows whose status equals ``status`` (after stripping it, or exact)."""
    c = strip_ws(F.col(col)) if strip else F.col(col)
    return df.filter(c == F.lit(status))


def dedupe_first(df: DataFrame, keys: list[str], tie: str = "seq") -> DataFrame:
    """One row per ``keys``: the row with the smallest (non-NULL) ``tie``.

    Written as an aggregation -- ``min`` of a struct led by ``tie`` -- so a
    hot key (a group of copies holding a large share of all rows) is reduced
    map-side before the shuffle instead of landing whole in one task as a
    ``row_number`` window would (the struct minimum runs as a sort-based
    aggregate, which spills instead of failing on large groups).
    """
    others = [c for c in df.columns if c not in keys and c != tie]
    row = F.struct(F.col(tie).alias(tie), *[F.col(c) for c in others])
    return (df.groupBy(*keys).agg(F.min(row).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in [tie] + others])
            .select(*df.columns))


def clean_history(raw: DataFrame, supplies: list[str] | None = None, strip_status: bool = True,
                  dedupe: bool = True, tie: str = "seq") -> DataFrame:
    """Raw log -> clean wide log: timestamp parsed (``fecha``), rows with a
    valid status only, levels as doubles, one row per (ip, timestamp text).

    The original keeps the first row of each (IP, timestamp text) after a
    newest-first sort; rows of one key share the timestamp, so that is the
    earliest logged row (smallest ``tie``), taken here without a sort.
    """
    names = supplies or K.supply_names()
    df = trim_columns(raw)
    for s in names:
        c = K.SUPPLY_COLUMNS[s]
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    df = filter_status(df, strip=strip_status)
    df = df.withColumn("fecha", parse_ts("marca_de_tiempo"))
    df = df.select(*[pct_to_double(c).alias(c) if c in {K.SUPPLY_COLUMNS[s] for s in names} else F.col(c)
                     for c in df.columns])
    if dedupe:
        df = dedupe_first(df, ["ip", "marca_de_tiempo"], tie=tie)
    return df


def sort_history(df: DataFrame, tie: str = "seq") -> DataFrame:
    """Newest first, unparseable timestamps last, log order within ties."""
    return df.orderBy(F.col("fecha").desc_nulls_last(), F.col(tie).asc())


def history_batch(df: DataFrame, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Project a refreshed device table to the log columns it has, in log
    order (plus an ingest sequence ``seq`` when present)."""
    cols = [c for c in keep if c in df.columns] + [c for c in K.HISTORY_COLUMNS.values() if c in df.columns]
    return df.select(*cols)


def append_history(old: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Old log rows first, then the batch (by column name).

    Log columns the old log lacks are added to it as ``''``; columns the
    batch lacks are NULL for the batch rows.  With no old log the result is
    the projected batch.
    """
    new = history_batch(batch)
    if old is None:
        return new
    for c in new.columns:
        if c not in old.columns:
            old = old.withColumn(c, F.lit(""))
    return old.unionByName(new, allowMissingColumns=True)
