"""Inventory refresh: normalise keys, turn poll outcomes into poll rows,
merge them into the device table under the class update rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.functions.bands import MISSING_IS_ZERO, classify_status
from supplyscope.functions.scalars import clean_pct, format_ip, fraction_to_pct
from supplyscope.operators.merge import merge_left, merge_masked, merge_masked_clean

MONO_LEVELS = ["toner_negro", "ui_negro"]


def _class_rule(cls, df: DataFrame):
    rule = None
    for cname, sup in K.OK_RULE.items():
        r = None
        for s in sup:
            c = K.SUPPLY_COLUMNS[s]
            t = (F.coalesce(F.col(c), F.lit("")) != "") if c in df.columns else F.lit(False)
            r = t if r is None else (r | t)
        rule = F.when(cls == cname, r) if rule is None else rule.when(cls == cname, r)
    return rule


def poll_results(outcomes: DataFrame, inventory: DataFrame, variant: str = "v13",
                 levels: list[str] | None = None, by_class: bool = True) -> DataFrame:
    """Poll outcomes of devices -> poll rows keyed by (class,) normalised ip.

    Devices whose key normalises to NULL are never polled.  A key that
    normalises to ``''`` is a ``no_key`` outcome: status and stamp ``''``.
    Levels are ``''`` unless the page was read; a gauge that a page lacks
    reads ``0%`` in the generations that say so, else ``''``.
    """
    levels = levels or [c for c in outcomes.columns if c in K.supply_cols() or c == "ui_negro"]
    keys = inventory.select("device_id", "device_class", format_ip("ip").alias("ip")) \
        .filter(F.col("ip").isNotNull())
    p = outcomes.join(keys, on="device_id", how="inner")
    outcome = F.when(F.col("ip") == "", F.lit("no_key")).otherwise(F.col("outcome"))
    p = p.withColumn("outcome", outcome)
    read = F.col("outcome").isin("ok", "element_missing")
    blank = "0%" if variant in MISSING_IS_ZERO else ""
    lv = [F.when(read, F.coalesce(F.col(c), F.lit(blank))).otherwise(F.lit("")).alias(c) for c in levels]
    p = p.select("device_id", "device_class", "ip", "outcome", *lv,
                 F.when(F.col("outcome") == "no_key", F.lit("")).otherwise(F.col("marca_de_tiempo"))
                 .alias("marca_de_tiempo"))
    rule = _class_rule(F.col("device_class"), p)
    all_zero = None
    for c in levels:
        z = F.col(c) == "0%"
        all_zero = z if all_zero is None else (all_zero & z)
    p = p.withColumn("estado", classify_status("outcome", rule, all_zero, variant=variant))
    key_cols = ["device_class", "ip"] if by_class else ["ip"]
    return p.select(*key_cols, F.col("device_id").alias("seq"), *levels, "estado", "marca_de_tiempo")


def with_levels(inv: DataFrame, poll: DataFrame, levels) -> DataFrame:
    """``inv`` with a null column for every polled level that it lacks."""
    return inv.select("*", *[F.lit(None).cast("string").alias(c) for c in levels if c in poll.columns and c not in inv.columns])


def refresh_inventory(inventory: DataFrame, poll: DataFrame) -> DataFrame:
    """Current-generation refresh of every class in one job.

    Keys normalised, poll rows (one per class and key) left-joined, levels
    replaced by cleaned poll text only where the poll status is OK, status
    and stamp taken from the poll when there is one.  Row count equals the
    inventory's.  A polled level that the inventory lacks becomes a new column.
    """
    return refresh_keyed(with_levels(inventory.withColumn("ip", format_ip("ip")), poll, K.supply_cols()), poll)


def refresh_keyed(inv: DataFrame, poll: DataFrame) -> DataFrame:
    """:func:`refresh_inventory` of a table whose keys are normalised already
    (normalising a key again is not the same key) and whose levels are all there."""
    levels = [c for c in K.supply_cols() if c in inv.columns]
    j = merge_left(inv, poll, keys=["device_class", "ip"], dedupe_tie="seq")
    return merge_masked_clean(j, inv.columns, levels, class_col="device_class")


def refresh_inventory_mono(inventory: DataFrame, poll: DataFrame, levels: list[str] = MONO_LEVELS) -> DataFrame:
    """Generation-11 mono refresh: masked merge without cleaning, old NULL
    levels blanked, then every level converted from fraction to percent."""
    inv = with_levels(inventory.withColumn("ip", format_ip("ip")), poll, levels)
    levels = [c for c in levels if c in inv.columns]
    j = merge_left(inv, poll, keys=["ip"], dedupe_tie="seq")
    m = merge_masked(j, inv.columns, levels, blank_old=True)
    return m.select(*[fraction_to_pct(c).alias(c) if c in levels else F.col(c) for c in m.columns])


def refresh_inventory_color11(inventory: DataFrame, poll: DataFrame,
                              levels: tuple[str, ...] = K.COLOR11_LEVELS) -> DataFrame:
    """Generation-11 colour sheet: poll texts are cleaned to rounded percent
    text when read (the original cleans them again on merge, a no-op since
    cleaning is idempotent), levels change only where the poll status is OK,
    old levels are kept as they are (no blanking), status and stamp are
    coalesced."""
    inv = with_levels(inventory.withColumn("ip", format_ip("ip")), poll, levels)
    present = [c for c in levels if c in inv.columns]
    cleaned = poll.select(*[clean_pct(c, "").alias(c) if c in present else F.col(c) for c in poll.columns])
    j = merge_left(inv, cleaned, keys=["ip"], dedupe_tie="seq")
    return merge_masked(j, inv.columns, present)
