"""Per-series step metrics: elapsed days, deltas, step rates, EMA, slope.

A series is one ``keys`` group ordered by ``(ts, tie)``.  Positions and
previous-row values come from :mod:`supplyscope.operators.sequencing`, so a
hot series never sits in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.functions.scalars import elapsed_micros
from supplyscope.operators.sequencing import SeriesPlan, order_series, running_count
from supplyscope.session import conf_int

STEP = "_step"   # flag: row has positive elapsed time since the previous row


def days_between(start, end) -> Column:
    """Fractional days from ``start`` to ``end``: seconds / 86400."""
    return (elapsed_micros(start, end) / F.lit(1e6)) / F.lit(86400.0)


def ema_alpha(span: int) -> float:
    """Smoothing factor of an EMA given its span (centre of mass form)."""
    com = (span - 1) / 2.0
    return 1.0 / (1.0 + com)


def step_table(df: DataFrame, keys: list[str], ts: str = "ts", tie: str = "seq", val: str = "pct",
               mode: str | None = None, bound=None) -> tuple[DataFrame, SeriesPlan]:
    """Add the step columns of every row of every series.

    ``days``        elapsed days since the first row of the series
    ``delta_days``  days minus the previous row's days
    ``delta_pct``   previous level minus this level (consumption > 0)
    ``_step``       ``delta_days > 0`` (rows kept for rate/EMA)
    ``rate``        ``delta_pct / delta_days`` on step rows
    ``_rn``/``_n``  position and size; ``_cum__step``/``_tot__step`` rank and
                    count of step rows; ``_prev_<val>`` previous level.
    Rows must have non-NULL ``ts`` and ``val``.
    """
    s, plan = order_series(df, keys, [ts, tie], carry=[ts, val], mode=mode, bound=bound)
    t0 = F.col(f"_first_{ts}")
    days = days_between(t0, F.col(ts))
    prev_days = days_between(t0, F.col(f"_prev_{ts}"))
    s = (s.withColumn("days", days)
         .withColumn("delta_days", F.col("days") - prev_days)
         .withColumn("delta_pct", -(F.col(val) - F.col(f"_prev_{val}")))
         .withColumn(STEP, F.coalesce(F.col("delta_days") > F.lit(0.0), F.lit(False)))
         .withColumn("rate", F.when(F.col(STEP), F.col("delta_pct") / F.col("delta_days"))))
    s = running_count(s, plan, STEP)
    return s, plan


def ema_weight(span: int = K.EMA_SPAN) -> Column:
    """Weight of a step row in the last value of an EMA (adjust=False).

    With rank ``i`` among ``m`` step rows: ``(1-a)^(m-1)`` for ``i == 1``,
    else ``a * (1-a)^(m-i)``; the sum of ``weight * rate`` is the EMA's last
    value, so the EMA is a plain (partially aggregated) sum, not a loop.
    """
    a = ema_alpha(span)
    i = F.col(f"_cum_{STEP}")
    m = F.col(f"_tot_{STEP}")
    decay = F.pow(F.lit(1.0 - a), (m - i).cast("double"))
    return F.when(F.col(STEP), F.when(i == 1, F.pow(F.lit(1.0 - a), (m - 1).cast("double")))
                  .otherwise(F.lit(a) * decay))


def ema_chunk(span: int) -> tuple[int, int]:
    """(steps of a chunk, chunks that an EMA can remember).

    A chunk is long enough to shrink what came before it to ``e**-46`` (1e-20),
    so weights inside one stay far from overflow, and after 17 of them an
    earlier value is below the smallest double: the EMA at a step is made of
    its own chunk and at most 16 whole chunks before it, exactly.
    """
    fade = -math.log(1.0 - ema_alpha(span)) if span > 1 else math.inf
    return max(1, math.ceil(46 / fade)), 16


def ema_series(steps: DataFrame, keys: list[str], span: int = K.EMA_SPAN, name: str = "ema") -> DataFrame:
    """Add the EMA (adjust=False) of the rates at every step row; NULL on other rows.

    ``steps`` comes from :func:`step_table` or :func:`step_table_split`. A
    step with rate ``r`` is the map ``x -> (1-a) * x + a * r`` (the first one
    sets ``x = r``), and maps compose: a chunk of steps is one pair
    (multiplier, addend). So the steps of a series are cut into chunks by
    their rank, each chunk is scanned by itself (a hot series is spread over
    as many tasks as it has chunks), one row per chunk holds its pair, the
    pairs are composed along each series, and the value before a chunk joins
    its rows. Null keys form a series like any other. Empty input, empty result.
    """
    a = ema_alpha(span)
    size, reach = ema_chunk(span)
    d = 1.0 - a
    rank = F.col(f"_cum_{STEP}")
    s = steps.withColumn("_key", F.struct(*[F.col(k) for k in keys]))
    s = s.withColumn("_chunk", F.floor((F.greatest(rank, F.lit(1)) - 1) / F.lit(size)).cast("long"))
    at = ((rank - 1) - F.col("_chunk") * size).cast("double")                    # place in the chunk
    own = F.when(F.col(STEP), F.when(rank == 1, F.lit(1.0)).otherwise(F.lit(a)) * F.col("rate"))
    if span > 1:
        w = (Window.partitionBy("_key", "_chunk").orderBy(rank, F.col("_rn"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        local = F.sum(own / F.pow(F.lit(d), at)).over(w) * F.pow(F.lit(d), at)
    else:
        local = own
    s = s.withColumn("_local", F.when(F.col(STEP), local)).withColumn("_at", at)
    whole = s.where(STEP).groupBy("_key", "_chunk").agg(F.max_by("_local", rank).alias("_add"))
    along = Window.partitionBy("_key").orderBy("_chunk")
    before = None
    for back in range(1, reach + 1):                          # the chunks before are all full
        term = F.lit(d ** (size * (back - 1))) * F.coalesce(F.lag("_add", back).over(along), F.lit(0.0))
        before = term if before is None else before + term
    state = whole.select("_key", "_chunk", before.alias("_before"))
    out = s.join(state, ["_key", "_chunk"], "left")
    ema = F.col("_local") + F.pow(F.lit(d), F.col("_at") + 1) * F.coalesce("_before", F.lit(0.0))
    return out.withColumn(name, F.when(F.col(STEP), ema)).select(*steps.columns, name)


def step_table_split(df: DataFrame, keys: list[str], ts: str = "ts", tie: str = "seq", val: str = "pct",
                     block_rows: int | None = None) -> DataFrame:
    """:func:`step_table` with hot series split off.

    One size probe per series key; when no series exceeds ``block_rows`` this
    is the plain one-exchange form.  Otherwise the hot series (at most
    ``total / block_rows`` keys, matched null-safely; how the list is joined
    is left to its measured size) go through the blocked form and every
    other series keeps the plain form; series are disjoint, so the two
    results are unioned.
    """
    limit = block_rows or conf_int(df.sparkSession, K.SERIES_BLOCK_ROWS_CONF, K.SERIES_BLOCK_ROWS_DEFAULT)
    sizes = df.groupBy(*keys).count()
    over = F.col("count") > F.lit(limit)
    row = sizes.agg(F.max("count").alias("mx"), F.sum(F.when(over, F.col("count"))).alias("hot")).first()
    mx, tot = int(row["mx"] or 0), int(row["hot"] or 0)
    if mx <= limit:
        return step_table(df, keys, ts, tie, val, mode="off", bound=(mx, tot))[0]
    hot_keys = sizes.filter(over).select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    match = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
        match = e if match is None else match & e
    cold = step_table(df.join(hot_keys, match, "left_anti"), keys, ts, tie, val, mode="off", bound=(mx, tot))[0]
    hot = step_table(df.join(hot_keys, match, "left_semi"), keys, ts, tie, val, mode="force", bound=(mx, tot))[0]
    return cold.unionByName(hot.select(*cold.columns))
