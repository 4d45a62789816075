"""Scalar text and number functions of the fleet tables.

All helpers return Spark ``Column`` expressions made of built-ins, so they
stay inside whole-stage code generation; none of them is a Python UDF.
ANSI mode is on in Spark 4, hence every parse goes through a guard regex and
``try_*`` functions: bad input yields NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal literal accepted as a number: what Python's float() takes apart
# from nan/inf/underscores.  Spark's own cast would also take "5d", "5f",
# "nan" and "Infinity", which the original parser rejects or maps to NaN.
NUMBER_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Characters Python's str.strip() removes in ASCII text (and Java's \s).
WHITESPACE = " \t\n\r\x0b\x0c"

# Characters a decimal literal may consist of; with ``try_cast`` rejecting
# malformed arrangements this accepts exactly the strings of NUMBER_RE.
_NUMBER_CHARS = "0123456789.+-eE"


_BIGINT_LIMIT = 9.2e18


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace (tabs and
    newlines too, not only the spaces plain ``trim`` removes)."""
    return F.trim(_c(c), F.lit(WHITESPACE))


def parse_number(c) -> Column:
    """Text -> finite double, NULL when the (stripped) text is not a plain
    decimal number (``NUMBER_RE``) or overflows to infinity.

    A character check plus ``try_cast`` instead of a regex: the cast rejects
    malformed arrangements, the check rejects what Spark's cast accepts but
    a plain decimal is not (``5d``, ``NaN``, ``Infinity``).
    """
    t = strip_ws(c)
    plain = (F.translate(t, _NUMBER_CHARS, "") == F.lit("")) & (t != F.lit(""))
    x = F.when(plain, t.try_cast("double"))
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def round_to(x, decimals: int) -> Column:
    """numpy's rounding: scale, round half to even, unscale."""
    f = float(10 ** decimals)
    return F.rint(_c(x) * F.lit(f)) / F.lit(f)


def format_ip(c, style: str = "current", null_check: bool = True) -> Column:
    """Normalise a dirty device key by its digit count.

    Non-digits are dropped; 12 or 11 digits -> ``3.3.3.rest``, 10 or 9 ->
    ``3.3.2.rest``, 8 or 7 -> ``3.3.rest`` (``style="dots"`` appends one dot
    per missing digit up to 9, ``style="zero"`` appends ``.0``), any other
    count -> the digits unchanged.  With ``null_check`` NULL or blank input
    gives NULL; without it (oldest generation) it gives ``''``.
    """
    if style not in ("current", "dots", "zero"):
        raise ValueError(f"unknown format_ip style {style!r}")
    raw = _c(c)
    d = F.regexp_replace(raw if null_check else F.coalesce(raw, F.lit("")), "[^0-9]", "")
    n = F.length(d)
    head = F.concat(F.substring(d, 1, 3), F.lit("."), F.substring(d, 4, 3), F.lit("."))
    long4 = F.concat(head, F.substring(d, 7, 3), F.lit("."), F.substring(d, 10, 1 << 20))
    mid4 = F.concat(head, F.substring(d, 7, 2), F.lit("."), F.substring(d, 9, 1 << 20))
    short3 = F.concat(head, F.substring(d, 7, 1 << 20))
    if style == "dots":
        short3 = F.concat(short3, F.when(n == 8, F.lit("..")).otherwise(F.lit(".")))
    elif style == "zero":
        short3 = F.concat(short3, F.lit(".0"))
    out = (F.when(n.isin(12, 11), long4)
           .when(n.isin(10, 9), mid4)
           .when(n.isin(8, 7), short3)
           .otherwise(d))
    if null_check:
        return F.when(raw.isNull() | (strip_ws(raw) == ""), F.lit(None).cast("string")).otherwise(out)
    return out


# A valid dotted quad (each octet 0-255, no leading zeros).
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
DOTTED_QUAD_RE = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def normalize_ip(c) -> Column:
    """Lossless key normalization: a key that already is a valid dotted quad
    (after stripping) is kept as is; anything else goes through
    :func:`format_ip`.  ``format_ip`` alone rewrites ``192.168.1.50`` to
    ``192.168.15.0`` because it only counts digits."""
    t = strip_ws(_c(c))
    return F.when(t.rlike(DOTTED_QUAD_RE), t).otherwise(format_ip(c))


def ip_to_url(c) -> Column:
    """Device key -> page URL; NULL for a missing or empty key."""
    ip = _c(c)
    return F.when(ip.isNotNull() & (ip != ""), F.concat(F.lit("http://"), ip))


def clean_pct(c, on_fail: str = "") -> Column:
    """Gauge text -> rounded percent text (``"85.5 %"`` -> ``"86%"``).

    ``%`` removed, stripped, parsed, rounded half to even, ``%`` appended.
    Unparseable, NULL, NaN or infinite input gives ``on_fail`` (``''`` for
    mono classes, ``'0%'`` for colour classes).
    """
    x = parse_number(F.regexp_replace(_c(c), "%", ""))
    r = F.rint(x)
    ok = F.concat(r.cast("bigint").cast("string"), F.lit("%"))
    return F.when(F.abs(r) < F.lit(_BIGINT_LIMIT), ok).otherwise(F.lit(on_fail))


def clean_pct_float(c) -> Column:
    """Gauge text -> double percent, NULL when it does not parse."""
    return parse_number(F.regexp_replace(_c(c), "%", ""))


def pct_to_double(c) -> Column:
    """Logged percent text -> double (``''``/bad/NULL -> NULL)."""
    return parse_number(F.regexp_replace(_c(c).cast("string"), "%", ""))


def fraction_to_pct(c) -> Column:
    """Fraction text -> percent text, truncating (``"0,29"`` -> ``"28%"``).

    Decimal comma accepted; NULL -> ``''``; text that is not a number is
    returned unchanged (so ``"85%"`` stays).
    """
    v = _c(c).cast("string")
    x = parse_number(F.regexp_replace(v, ",", "."))
    y = x * F.lit(100.0)
    pct = F.concat(y.cast("bigint").cast("string"), F.lit("%"))
    return (F.when(v.isNull(), F.lit(""))
            .when(F.abs(y) < F.lit(_BIGINT_LIMIT), pct)
            .otherwise(v))


# Shape of the poller's stamp text; anything else is not a stamp.
TS_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def parse_ts(c) -> Column:
    """Stamp text ``yyyy-MM-dd HH:mm:ss`` -> ``timestamp_ntz``; other text or
    an impossible date -> NULL.

    Parsed straight to a wall-clock timestamp (``try_cast`` to NTZ), never
    through the session time zone, so a stamp inside a DST gap keeps its
    wall time whatever ``spark.sql.session.timeZone`` is.
    """
    t = _c(c)
    return F.when(t.rlike(TS_SHAPE), t.try_cast("timestamp_ntz"))


def wall_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall-clock (NTZ) timestamp,
    from its date and time fields: no session time zone is involved."""
    t = _c(ts)
    day = F.unix_date(F.to_date(t)).cast("bigint")
    sec = (F.extract(F.lit("SECOND"), t) * F.lit(1000000)).cast("bigint")   # seconds with fraction
    return (day * F.lit(86400000000) + F.hour(t).cast("bigint") * F.lit(3600000000)
            + F.minute(t).cast("bigint") * F.lit(60000000) + sec)


def elapsed_micros(start, end) -> Column:
    """Wall-clock microseconds from ``start`` to ``end`` (timestamp_ntz).

    Not ``timestampdiff``: it converts NTZ values through the session time
    zone, which would shorten or stretch a day that crosses a DST change.
    """
    return wall_micros(end) - wall_micros(start)


# Last wall-clock second a Spark timestamp is specified for.
LAST_SECOND = "9999-12-31 23:59:59"


def add_days(ts, days) -> Column:
    """``ts`` + fractional ``days`` rounded to the whole second (half even);
    NULL when that lies past the timestamp type's last year (9999).

    The original keeps microseconds, but below a second a projected date is
    floating-point noise of the rate (it changes with the summation order
    of the regression), so dates are projected to the second.
    """
    secs = F.rint(_c(days) * F.lit(86400.0))
    left = elapsed_micros(ts, F.lit(LAST_SECOND).cast("timestamp_ntz")) / F.lit(1e6)
    return F.when(secs <= left, F.timestamp_add("SECOND", secs.cast("bigint"), _c(ts)))
