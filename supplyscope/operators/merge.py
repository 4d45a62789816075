"""Merging poll results into a device table.

The poll side is joined with every clashing column renamed ``<col>_new``;
four update contracts then decide which value survives.  The join is a
plain left equi-join: Catalyst/AQE broadcast the poll side when it is small
at run time and split skewed inventory partitions otherwise.  Both sides also
join on a salt: a hash of the key, or of the whole row where the key has a
NULL.  Such rows match nothing, and the salt spreads them over all tasks, so
the inventory is read once and no group of keyless rows lands in one task.
Tables bucketed by key and salt (:mod:`supplyscope.sources.buckets`) join
without a shuffle.  A fan-out join of a key with many rows on both sides is
cut into blocks of row pairs, since its output grows with their product.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.functions.scalars import clean_pct
from supplyscope.operators.history import dedupe_first

NEW = "_new"
SALT = "_salt"
FANOUT_BLOCK = 2048        # rows of a key on either side that meet in one block
_INV_BLOCK, _POLL_BLOCK, _HIT = "_inv_block", "_poll_block", "_hit"
_CUT = "_cut"
_NESTED = ("map", "array", "struct", "variant")


def has_key(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[f"`{c}`" for c, t in df.dtypes if not t.startswith(_NESTED)])


def salted(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the salt of its rows: alike for equal keys, spread for rows without one."""
    return df.withColumn(SALT, F.when(has_key(keys), F.xxhash64(*keys)).otherwise(_row_hash(df)))


def require_columns(df: DataFrame, cols: list[str], what: str = "table") -> None:
    """Fail before planning when a key column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{what} lacks column(s) {missing}")


def _blocked(inv: DataFrame, poll: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the block columns to join on beside ``by``, dealt over tasks by them.

    A key with more than ``FANOUT_BLOCK`` rows on a side is cut: each inventory row goes to
    one inventory block and meets every poll block, and the other way round, so each pair
    meets once. ``_CUT`` marks inventory rows of such keys; all of these have polls. The
    keys to cut are at most rows / ``FANOUT_BLOCK`` a side and are broadcast.
    """
    n = poll.groupBy(*by).agg(F.count(F.lit(1)).alias("_polls"))
    m = inv.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    parts = lambda c: F.ceil(F.col(c) / FANOUT_BLOCK).cast("int")
    cut = (n.join(m, by).filter(F.greatest("_polls", "_rows") > FANOUT_BLOCK)
           .select(*by, parts("_rows").alias(_CUT), parts("_polls").alias("_polls")))

    def dealt(df: DataFrame, own: str, own_parts: str, other: str, other_parts: str) -> DataFrame:
        return (df.withColumn("_spread", _row_hash(df)).join(F.broadcast(cut), by, "left")
                .withColumn(own, F.pmod("_spread", F.coalesce(F.col(own_parts), F.lit(1))).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other_parts), F.lit(1)) - 1)))
                .drop("_spread", "_polls"))

    both = [*by, _INV_BLOCK, _POLL_BLOCK]
    inv = dealt(inv, _INV_BLOCK, _CUT, _POLL_BLOCK, "_polls")
    poll = dealt(poll, _POLL_BLOCK, "_polls", _INV_BLOCK, _CUT).drop(_CUT).withColumn(_HIT, F.lit(True))
    # A set number of partitions: coalescing goes by the bytes read, and the output is what counts.
    width = int(inv.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return inv.repartition(width, *both), poll.repartition(width, *both), both


def merge_left(inv: DataFrame, poll: DataFrame, keys: list[str] | None = None,
               dedupe_tie: str | None = "seq", allow_fanout: bool = False) -> DataFrame:
    """``inv LEFT JOIN poll`` on ``keys``; poll columns clashing with the
    inventory get the ``_new`` suffix.

    The poll side is reduced to one row per key (smallest ``dedupe_tie``)
    so duplicate keys cannot multiply inventory rows; ``allow_fanout=True``
    keeps every poll row (the original many-to-many behaviour). Rows of either
    side that carry a salt already (bucketed tables) keep it.
    """
    keys = keys or ["ip"]
    require_columns(inv, keys, "inventory")
    require_columns(poll, keys, "poll result")
    by, columns = [*keys, SALT], [c for c in inv.columns if c != SALT]
    inv = inv if SALT in inv.columns else salted(inv, keys)
    poll = (poll if SALT in poll.columns else salted(poll, keys)).filter(has_key(keys))
    if not allow_fanout and dedupe_tie and dedupe_tie in poll.columns:
        poll = dedupe_first(poll, by, tie=dedupe_tie)
    if allow_fanout:
        inv, poll, by = _blocked(inv, poll, by)
    if dedupe_tie and dedupe_tie in poll.columns:
        poll = poll.drop(dedupe_tie)
    renamed = [F.col(c).alias(c + NEW if c in columns else c) for c in poll.columns if c not in by]
    joined = inv.join(poll.select(*by, *renamed), on=by, how="left")
    if allow_fanout:                  # a copy of a row in a block without polls is no row of the result
        joined = joined.filter(F.col(_CUT).isNull() | F.col(_HIT).isNotNull())
    return joined.drop(SALT, _INV_BLOCK, _POLL_BLOCK, _CUT, _HIT)


def _new(c: str, j: DataFrame | None = None) -> Column:
    """The poll value of ``c``; NULL when the poll side has no such column."""
    if j is not None and c + NEW not in j.columns:
        return F.lit(None).cast("string")
    return F.col(c + NEW)


def _finish(df: DataFrame, exprs: dict[str, Column], inv_cols: list[str]) -> DataFrame:
    out = [exprs.get(c, F.col(c)).alias(c) for c in inv_cols]
    return df.select(*out)


def merge_overwrite(j: DataFrame, inv_cols: list[str], cols: list[str]) -> DataFrame:
    """New value replaces the old one; unmatched rows get NULL."""
    return _finish(j, {c: _new(c, j) for c in cols}, inv_cols)


def merge_coalesce(j: DataFrame, inv_cols: list[str], cols: list[str]) -> DataFrame:
    """New value unless it is NULL (``''`` is a value and does replace)."""
    return _finish(j, {c: F.coalesce(_new(c, j), F.col(c)) for c in cols}, inv_cols)


def merge_masked(j: DataFrame, inv_cols: list[str], levels: list[str], status: str = "estado",
                 stamp: str = "marca_de_tiempo", blank_old: bool = False) -> DataFrame:
    """Levels change only where the new status is OK; status and stamp are
    coalesced for every row.  ``blank_old`` first turns old NULL levels into
    ``''`` (later generations)."""
    ok = _new(status) == F.lit(K.STATUS_OK)
    ex = {}
    for c in levels:
        old = F.coalesce(F.col(c), F.lit("")) if blank_old else F.col(c)
        ex[c] = F.when(ok, _new(c, j)).otherwise(old)
    ex[status] = F.coalesce(_new(status), F.col(status))
    ex[stamp] = F.coalesce(_new(stamp), F.col(stamp))
    return _finish(j, ex, inv_cols)


def merge_masked_clean(j: DataFrame, inv_cols: list[str], levels: list[str], status: str = "estado",
                       stamp: str = "marca_de_tiempo", class_col: str | None = "device_class",
                       on_fail: str | None = None) -> DataFrame:
    """Masked merge where the new level is cleaned to rounded percent text.

    Old NULL levels, status and stamp become ``''`` first.  A level is only
    updated for device classes that have that supply (when ``class_col`` is
    given); the value used when cleaning fails is per class (``''`` mono,
    ``'0%'`` colour) unless ``on_fail`` fixes it.
    """
    ok = _new(status) == F.lit(K.STATUS_OK)
    ex = {}
    for c in levels:
        old = F.coalesce(F.col(c), F.lit(""))
        if on_fail is not None or class_col is None:
            cleaned = clean_pct(_new(c, j), on_fail or "")
            applies = F.lit(True)
        else:
            zero_classes = [k for k, v in K.CLEAN_FAILURE.items() if v == "0%"]
            cleaned = F.when(F.col(class_col).isin(zero_classes), clean_pct(_new(c, j), "0%")) \
                .otherwise(clean_pct(_new(c, j), ""))
            owners = [k for k, sup in K.GAUGE_MAP.items() if any(K.SUPPLY_COLUMNS.get(s) == c for s in sup)]
            applies = F.col(class_col).isin(owners)
        ex[c] = F.when(applies & ok, cleaned).when(applies, old).otherwise(F.col(c))
    ex[status] = F.coalesce(_new(status), F.coalesce(F.col(status), F.lit("")))
    ex[stamp] = F.coalesce(_new(stamp), F.coalesce(F.col(stamp), F.lit("")))
    return _finish(j, ex, inv_cols)
