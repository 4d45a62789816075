"""Wide <-> long reshapes of supply columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope import config as K


def unpivot_supplies(df: DataFrame, ids: list[str], supplies: list[str] | None = None,
                     value_type: str | None = None, add_missing: bool = False,
                     columns: dict[str, str] = K.SUPPLY_COLUMNS) -> DataFrame:
    """Wide supply columns -> rows ``(*ids, consumible, consumible_ix, valor)``.

    ``consumible`` carries the display name and ``consumible_ix`` the report
    order; ``columns`` maps display names to columns.  Missing supply columns are skipped, or emitted as NULL values with
    ``add_missing=True``.  One ``Generate`` node, no shuffle.
    """
    names = supplies or list(columns)
    order = {s: i for i, s in enumerate(columns)}
    items = []
    for s in names:
        c = columns[s]
        if c in df.columns:
            v = F.col(c)
        elif add_missing:
            v = F.lit(None)
        else:
            continue
        if value_type:
            v = v.cast(value_type)
        items.append(F.struct(F.lit(s).alias("consumible"), F.lit(order[s]).alias("consumible_ix"),
                              v.alias("valor")))
    if not items:
        raise ValueError("no supply column to unpivot")
    return df.select(*ids, F.inline(F.array(*items)))


def pivot_supplies(long: DataFrame, ids: list[str], supply_col: str = "consumible",
                   value_col: str = "text", supplies: list[str] | None = None) -> DataFrame:
    """Rows of ``(ids, supply, value)`` -> one wide row per ``ids``.

    The pivot values are given explicitly (no extra job to discover them);
    ``max`` keeps it deterministic when a supply repeats.
    """
    names = supplies or K.supply_names()
    wide = long.groupBy(*ids).pivot(supply_col, names).agg(F.max(value_col))
    return wide.select(*ids, *[F.col(f"`{s}`").alias(K.SUPPLY_COLUMNS[s]) for s in names])
