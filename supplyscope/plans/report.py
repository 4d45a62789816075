"""Severity report: every percent cell of every device class banded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.functions.bands import severity
from supplyscope.operators.reshape import unpivot_supplies


def severity_cells(df: DataFrame, ids: list[str], low_below: float | None = K.SEVERITY_LOW_BELOW) -> DataFrame:
    """One row per (row, level column) with the cell text and its severity band; imaging units included."""
    long = unpivot_supplies(df, ids, value_type="string", columns={**K.SUPPLY_COLUMNS, **K.IMAGING_COLUMNS})
    return long.withColumn("severity", severity("valor", low_below))


def severity_counts(df: DataFrame, class_col: str = "device_class",
                    low_below: float | None = K.SEVERITY_LOW_BELOW) -> DataFrame:
    """Cells per (class, supply, band), NULL band included: a grouped count
    with map-side partial aggregation."""
    cells = severity_cells(df, [class_col], low_below)
    return (cells.groupBy(class_col, "consumible", "severity")
            .agg(F.count(F.lit(1)).alias("cells")))
