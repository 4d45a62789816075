"""Gauge readings from captured device pages.

The original reads gauges from live pages through a browser.  Here pages
are data (``page_id, url, html``) and the gauge texts are pulled out in
bulk with ``regexp_extract_all``: a narrow, map-only job with no shuffle.
Supported element patterns:

* ``nav``           n-th ``<li><a ...>text</a></li>`` of the page
* ``supply_gauge``  elements with ``id="SupplyGauge<n>"`` (index in the id)
* ``toner_list``    first ``td.tonervalue_number`` cell of the
  ``table#toner_list`` (gauge 0) and ``table#imagine_list`` (gauge 1) tables
* ``grid``          second ``x-column`` cell of the n-th ``x-grid3-row``
* ``row_id``        nested tables addressed by row id (see
  :mod:`supplyscope.sources.tablefold`)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope import config as K
from supplyscope.functions.bands import classify_status
from supplyscope.functions.scalars import strip_ws
from supplyscope.operators.reshape import pivot_supplies
from supplyscope.sources.tablefold import once, row_id_texts

# Fixed element patterns of the device pages.
NAV_PATTERN = r'<li><a href="([^"]*)">([^<]*)</a></li>'
_SUPPLY_GAUGE = r"""(?is)<(\w+)\b[^>]*\bid\s*=\s*["']?SupplyGauge([0-9]+)(?=["'\s>])[^>]*>(.*?)</\1"""
_GRID_ROW = r"""(?i)<[^>]*\bclass\s*=\s*(?:"(?:[^"]*\s)?x-grid3-row(?:\s[^"]*)?"|'(?:[^']*\s)?x-grid3-row(?:\s[^']*)?')[^>]*>"""
_GRID_CELL = (r"""(?is)<(\w+)\b[^>]*\bclass\s*=\s*(?:"(?:[^"]*\s)?x-column(?:\s[^"]*)?"|'(?:[^']*\s)?x-column(?:\s[^']*)?')"""
              r"""[^>]*>(.*?)</\1""")
_TABLE_OPEN = r"""(?i)<table\b[^>]*\bid\s*=\s*["']?{table}(?=["'\s>])[^>]*>"""
_TONER_CELL = r"""(?is)<td\b[^>]*\bclass\s*=\s*["'][^"']*\btonervalue_number\b[^"']*["'][^>]*>(.*?)</td"""

# Positions a page can have: those of the class that reads most.
POSITIONS = max(map(len, K.GAUGE_MAP.values()))


def inner_text(markup: Column) -> Column:
    """Text of an element's inner markup, as a browser would show it."""
    t = F.replace(F.regexp_replace(markup, "<[^>]*>", ""), F.lit("&nbsp;"), F.lit(" "))
    return strip_ws(F.replace(t, F.lit("&amp;"), F.lit("&")))


def gauge_positions(html: Column, pattern: str) -> Column:
    """Array of ``POSITIONS`` gauge texts; null where the page has no such gauge.

    Positions are fixed: a missing gauge never moves another one. Only the
    first element of a position counts, ids beyond the positions are ignored.
    """
    if pattern == "supply_gauge":
        pairs = F.transform(F.regexp_extract_all(html, F.lit(_SUPPLY_GAUGE), 0), lambda m: F.struct(
            F.regexp_extract(m, _SUPPLY_GAUGE, 2).try_cast("int").alias("i"), F.regexp_extract(m, _SUPPLY_GAUGE, 3).alias("t")))
        return once(pairs, lambda found: F.array(*[
            inner_text(F.get(F.filter(found, lambda x: x["i"] == k), F.lit(0))["t"]) for k in range(POSITIONS)]))
    if pattern == "toner_list":
        found = []
        for table in ("toner_list", "imagine_list"):
            after = F.get(F.split(html, _TABLE_OPEN.format(table=table), 2), F.lit(1))
            body = F.get(F.split(after, "(?i)</table", 2), F.lit(0))
            found.append(inner_text(F.get(F.regexp_extract_all(body, F.lit(_TONER_CELL), 1), F.lit(0))))
        return F.array(*found, *[F.lit(None).cast("string")] * (POSITIONS - 2))
    if pattern == "grid":
        cell = lambda row: inner_text(F.get(F.regexp_extract_all(row, F.lit(_GRID_CELL), 2), F.lit(1)))
        return once(F.split(html, _GRID_ROW), lambda rows: F.array(*[cell(F.get(rows, F.lit(k + 1))) for k in range(POSITIONS)]))
    if pattern == "row_id":
        return row_id_texts(html, POSITIONS)
    raise ValueError(f"unknown gauge pattern {pattern!r}")


def extract_gauges(pages: DataFrame, pattern: str = "nav", keep: tuple[str, ...] = ()) -> DataFrame:
    """Pages -> one row per gauge ``(page_id, *keep, gauge_ix, text)``; no page can fail the job."""
    html = F.col("html")
    arr = F.regexp_extract_all(html, F.lit(NAV_PATTERN), 2) if pattern == "nav" else gauge_positions(html, pattern)
    return (pages.select("page_id", *keep, F.posexplode(arr).alias("gauge_ix", "raw")).where(F.col("raw").isNotNull())
            .select("page_id", *keep, F.col("gauge_ix").cast("int").alias("gauge_ix"), strip_ws(F.col("raw")).alias("text")))


def gauge_map_df(spark: SparkSession) -> DataFrame:
    """``(device_class, gauge_ix, consumible)``: the fixed position table."""
    rows = [(cls, i, s) for cls, sup in K.GAUGE_MAP.items() for i, s in enumerate(sup)]
    schema = T.StructType([T.StructField("device_class", T.StringType()),
                           T.StructField("gauge_ix", T.IntegerType()),
                           T.StructField("consumible", T.StringType())])
    return spark.createDataFrame(rows, schema)


def label_gauges(gauges: DataFrame, class_col: str = "device_class") -> DataFrame:
    """Gauge rows that carry their page's class -> ``(page_id, device_class, gauge_ix, consumible, text)``.

    The lookup side is the fixed gauge map (one row per class and position,
    a size bound independent of the data), so it is broadcast explicitly.
    Gauges a class does not read are dropped.
    """
    gm = F.broadcast(gauge_map_df(gauges.sparkSession))
    return gauges.join(gm, [class_col, "gauge_ix"], "inner").select("page_id", class_col, "gauge_ix", "consumible", "text")


def pivot_gauges(labelled: DataFrame, class_col: str = "device_class") -> DataFrame:
    """Labelled gauge rows -> one wide row per page (explicit pivot values)."""
    return pivot_supplies(labelled, ["page_id", class_col], value_col="text")


def _by_class(cls: Column, values: dict[str, Column]) -> Column:
    out = F.lit(None)
    for c, v in values.items():
        out = F.when(cls == c, v).otherwise(out)
    return out


def gauges_to_supplies(pages: DataFrame, pattern: str | None = None, class_col: str = "device_class",
                       variant: str = "v13") -> DataFrame:
    """Pages -> one poll row per page: level columns, outcome and status.

    Each class's pages are read by its own element pattern, or all by
    ``pattern``. The position -> level lookup is the fixed gauge map compiled
    into a CASE per column, so the job stays map-only. A page without any one
    of the gauges its class reads is an ``element_missing`` outcome (all its
    levels ``''``); a page without HTML is a ``driver_error``; a class that
    is not in the gauge map is an ``unknown_class`` (no levels, no status).
    """
    cls, html = F.col(class_col), F.col("html")
    used = dict.fromkeys([pattern] if pattern else K.GAUGE_PATTERN.values())
    if pattern:
        arr = gauge_positions(html, pattern)
    else:
        # A pattern sees only its own classes' pages.
        own = {p: cls.isin(*[c for c, q in K.GAUGE_PATTERN.items() if q == p]) for p in used}
        arr = F.coalesce(*[F.when(own[p], gauge_positions(F.when(own[p], html), p)) for p in used])
    base = pages.select("page_id", "url", class_col, "html", arr.alias("_g"))
    whole = _by_class(cls, {c: F.forall(F.slice("_g", 1, len(s)), lambda x: x.isNotNull()) for c, s in K.GAUGE_MAP.items()})
    outcome = (F.when(~F.coalesce(cls.isin(*K.GAUGE_MAP), F.lit(False)), F.lit("unknown_class"))
               .when(F.col("html").isNull(), F.lit("driver_error"))
               .when(F.coalesce(whole, F.lit(False)), F.lit("ok")).otherwise(F.lit("element_missing")))
    base = base.withColumn("outcome", outcome)
    cols = []
    for s, c in {**K.SUPPLY_COLUMNS, **K.IMAGING_COLUMNS}.items():
        at = {cname: sup.index(s) for cname, sup in K.GAUGE_MAP.items() if s in sup}
        value = _by_class(cls, {cname: F.get(F.col("_g"), F.lit(i)) for cname, i in at.items()})
        cols.append(F.when(F.col("outcome") == "ok", value).when(cls.isin(*at), F.lit("")).cast("string").alias(c))
    wide = base.select("page_id", "url", class_col, "outcome", *cols)
    rule = F.lit(False)
    for cname in K.GAUGE_MAP:
        texts = [F.coalesce(F.col(K.SUPPLY_COLUMNS[s]), F.lit("")) != "" for s in K.OK_RULE.get(cname, ())]
        rule = F.when(cls == cname, reduce(lambda x, y: x | y, texts) if texts else F.lit(True)).otherwise(rule)
    return wide.withColumn("estado", classify_status("outcome", rule, variant=variant))
