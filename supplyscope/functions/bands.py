"""Status classification, severity and alert bands as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.functions.scalars import parse_number, strip_ws

# Poll outcomes (what happened when the device page was read).
OUTCOMES = ("ok", "element_missing", "timeout", "driver_error", "no_key")

# Outcome -> status label per script generation; "rule" means OK when the
# class rule holds, else "No disponible"; None means the generation has no
# such outcome (it falls back to the driver-error label).
_STATUS_TABLE = {
    # Generations 4-6 have no status column: their outcome stands in the level cells.
    "v4": {"no_key": K.STATUS_NO_KEY, "ok": K.STATUS_OK, "element_missing": K.STATUS_NO_FRAME,
           "timeout": K.STATUS_PRINTER_OFFLINE, "driver_error": K.STATUS_PRINTER_OFFLINE},
    "v5": {"no_key": K.STATUS_NO_KEY, "ok": K.STATUS_OK, "element_missing": K.STATUS_ERROR,
           "timeout": K.STATUS_PRINTER_OFFLINE, "driver_error": K.STATUS_PRINTER_OFFLINE},
    "v6": {"no_key": K.STATUS_NO_KEY, "ok": K.STATUS_OK, "element_missing": K.STATUS_ERROR,
           "timeout": K.STATUS_OFFLINE, "driver_error": K.STATUS_OFFLINE},
    "v7": {"no_key": K.STATUS_NO_KEY, "ok": K.STATUS_OK, "element_missing": K.STATUS_ERROR,
           "timeout": K.STATUS_NOT_AVAILABLE, "driver_error": K.STATUS_OFFLINE},
    "v8": {"no_key": K.STATUS_NO_KEY, "ok": K.STATUS_OK, "element_missing": K.STATUS_NOT_AVAILABLE,
           "timeout": K.STATUS_NOT_AVAILABLE, "driver_error": K.STATUS_OFFLINE},
    "v10": {"no_key": K.STATUS_NO_KEY, "ok": K.STATUS_OK, "element_missing": K.STATUS_OK,
            "timeout": K.STATUS_OFFLINE, "driver_error": K.STATUS_OFFLINE},
    "v10_normal": {"no_key": K.STATUS_NO_KEY, "ok": K.STATUS_OK, "element_missing": K.STATUS_OK,
                   "timeout": K.STATUS_OFFLINE, "driver_error": K.STATUS_OFFLINE},
    "v11": {"no_key": K.STATUS_NO_KEY, "ok": K.STATUS_OK, "element_missing": K.STATUS_OK,
            "timeout": K.STATUS_NOT_AVAILABLE, "driver_error": K.STATUS_OFFLINE},
    "v11_copy": {"no_key": K.STATUS_NO_KEY, "ok": "zero_rule", "element_missing": "zero_rule",
                 "timeout": K.STATUS_NOT_AVAILABLE, "driver_error": K.STATUS_OFFLINE},
    "v11_clx": {"no_key": K.STATUS_NO_KEY, "ok": "rule", "element_missing": K.STATUS_NOT_AVAILABLE,
                "timeout": K.STATUS_NOT_AVAILABLE, "driver_error": K.STATUS_OFFLINE},
    "v13": {"no_key": K.STATUS_NO_KEY, "ok": "rule", "element_missing": K.STATUS_NOT_AVAILABLE,
            "timeout": K.STATUS_NOT_AVAILABLE, "driver_error": K.STATUS_OFFLINE},
}


def classify_status(outcome, rule_ok=None, all_zero=None, variant: str = "v13") -> Column:
    """Poll outcome -> status label.

    ``rule_ok``: boolean column, the class rule (some required gauge text is
    non-empty).  ``all_zero``: boolean column, every gauge read ``"0%"``
    (used by the ``v11_copy`` generation).
    """
    table = _STATUS_TABLE[variant]
    o = F.col(outcome) if isinstance(outcome, str) else outcome
    expr = None
    for name in OUTCOMES:
        label = table[name]
        if label == "rule":
            val = F.when(rule_ok, F.lit(K.STATUS_OK)).otherwise(F.lit(K.STATUS_NOT_AVAILABLE_RULE))
        elif label == "zero_rule":
            val = F.when(all_zero, F.lit(K.STATUS_NOT_AVAILABLE)).otherwise(F.lit(K.STATUS_OK))
        else:
            val = F.lit(label)
        expr = F.when(o == name, val) if expr is None else expr.when(o == name, val)
    return expr


#: Generations whose mono pages read a missing gauge as 0 %.
MISSING_IS_ZERO = ("v10", "v10_normal", "v11", "v11_copy")


def severity(c, low_below: float | None = K.SEVERITY_LOW_BELOW) -> Column:
    """Percent cell -> ``critical`` (``0%``/``0``), ``low`` (ends with ``%``
    and the number before it is below ``low_below``; never without it) or NULL."""
    v = strip_ws(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("None")))
    num = parse_number(F.substring(v, F.lit(1), F.length(v) - F.lit(1)))
    if low_below is None:
        return F.when(v.isin("0%", "0"), F.lit(K.SEVERITY_CRITICAL))
    return (F.when(v.isin("0%", "0"), F.lit(K.SEVERITY_CRITICAL))
            .when(v.endswith("%") & (num < F.lit(float(low_below))), F.lit(K.SEVERITY_LOW)))


def level_severity(level, low_below: float = K.SEVERITY_LOW_BELOW) -> Column:
    """Severity of a numeric level as its cleaned percent cell would get it:
    the cell reads ``rint(level)%``, so ``critical`` when that is 0 and
    ``low`` when it is below ``low_below``."""
    r = F.rint(F.col(level) if isinstance(level, str) else level)
    return (F.when(r == F.lit(0.0), F.lit(K.SEVERITY_CRITICAL))
            .when(r < F.lit(float(low_below)), F.lit(K.SEVERITY_LOW)))


def alert_band(days, critical: float = K.ALERT_CRITICAL_DAYS, medium: float = K.ALERT_MEDIUM_DAYS,
               low: float = K.ALERT_LOW_STOCK_DAYS) -> Column:
    """Days left (already rounded) -> five-level alert label."""
    d = F.col(days) if isinstance(days, str) else days
    return (F.when(d.isNull() | F.isnan(d), F.lit(K.ALERT_INSUFFICIENT))
            .when(d <= F.lit(float(critical)), F.lit(K.ALERT_URGENT))
            .when(d <= F.lit(float(medium)), F.lit(K.ALERT_SOON))
            .when(d <= F.lit(float(low)), F.lit(K.ALERT_LOW_STOCK))
            .otherwise(F.lit(K.ALERT_OK)))


def alert_band2(days, limit: float = K.LINEAR_ALERT_DAYS) -> Column:
    """Days left -> two-level alert label (NULL counts as OK)."""
    d = F.col(days) if isinstance(days, str) else days
    return F.when(d <= F.lit(float(limit)), F.lit(K.ALERT2_SOON)).otherwise(F.lit(K.ALERT2_OK))
