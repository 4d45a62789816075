"""Adapters that shape the shared test tables into fleet tables.

The fleet tool ships no data, so the checks run on the shared TPC-H-like
tables, reshaped by deterministic rules (every rule below is repeated as SQL
in :mod:`supplyscope.plans.oracle` for the DuckDB cross-check).  Nothing is
sampled or capped: each adapter reads its whole source table.

* ``readings_long``  events -> clean numeric series (device, supply, ts, pct)
* ``history_raw``    events -> dirty wide log: padded/other statuses, blank,
  bad and NULL levels, bad timestamps, NULL models, re-logged duplicates
* ``inventory_raw``  customer -> device table with blank, NULL, duplicate and short keys
* ``poll_raw``       orders -> newest order of each device as its poll outcome;
  devices whose newest order is low priority were not reached by the run
* ``gauge_pages``    pages -> captured device pages with a device class
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope import config as K
from supplyscope.sources.tables import read_table

# Rule constants of the adapters (shared with the SQL twins).
RELOG_ABOVE = 150.0          # readings above this value were logged twice
RELOG_SEQ_OFFSET = 100_000_000
NO_GAUGE_PRIORITY = "5-LOW"
WEEK = (datetime(2024, 1, 12), datetime(2024, 1, 19))
RUN_STAMP = "2024-02-01 00:00:00"
INVENTORY_STAMP = "2023-12-31 00:00:00"

_SUPPLY_OF_EVENT = {
    "click": "toner_negro",
    "view": "toner_cian",
    "purchase": "toner_magenta",
    "signup": "toner_amarillo",
    "error": "kit_mant",
}
_CLASS_OF_MOD3 = ("HP Admin", "Color Admin", "HP Planta")


def _case_mod(c, mapping) -> F.Column:
    e = None
    for i, v in enumerate(mapping):
        e = F.when(c == i, F.lit(v)) if e is None else e.when(c == i, F.lit(v))
    return e


def readings_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("seq"), F.col("user_id").alias("device"),
                     F.col("event_type").alias("supply"), "ts", F.col("value").alias("pct"))


def history_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    pct_text = F.concat((F.floor("value").cast("bigint") % 101).cast("string"),
                        F.when(F.col("event_id") % 3 == 0, F.lit(".5%")).otherwise(F.lit("%")))
    txt = (F.when(F.col("event_id") % 13 == 0, F.lit(""))
           .when(F.col("event_id") % 17 == 0, F.lit("--"))
           .when(F.col("event_id") % 19 == 0, F.lit(None).cast("string"))
           .otherwise(pct_text))
    base = ev.select(F.col("event_id").alias("seq"), "user_id", "event_type", "ts", txt.alias("txt"))
    relog = ev.filter(F.col("value") > F.lit(RELOG_ABOVE)).select(
        (F.col("event_id") + F.lit(RELOG_SEQ_OFFSET)).alias("seq"), "user_id", "event_type", "ts",
        F.lit("50%").alias("txt"))
    t = base.unionByName(relog)
    uid = F.col("user_id")
    levels = [F.when(F.col("event_type") == e, F.col("txt")).alias(c) for e, c in _SUPPLY_OF_EVENT.items()]
    return t.select(
        "seq",
        F.concat(F.lit("Printer "), uid.cast("string")).alias("nombre"),
        F.concat(F.lit("192.168."), (F.lit(100) + uid % 25).cast("string"), F.lit("."), uid.cast("string")).alias("ip"),
        F.when(uid % 40 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("M"), (uid % 5).cast("string"))).alias("modelo"),
        *levels,
        F.lit(None).cast("string").alias("kit_alim"),
        F.when(F.col("seq") % 10 == 3, F.lit("Fuera de Red")).when(F.col("seq") % 10 == 4, F.lit(" OK "))
        .otherwise(F.lit("OK")).alias("estado"),
        F.when(F.col("seq") % 97 == 0, F.lit("not a date"))
        .otherwise(F.substring(F.col("ts").cast("string"), 1, 19)).alias("marca_de_tiempo"),
    )


def inventory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    k = F.col("c_custkey")
    whole = F.abs(F.floor("c_acctbal").cast("bigint"))
    return cu.select(
        k.alias("device_id"),
        F.col("c_name").alias("nombre"),
        _case_mod(k % 3, _CLASS_OF_MOD3).alias("device_class"),
        F.when(k % 50 == 0, F.lit("  ")).when(k % 51 == 0, F.lit(None).cast("string"))
        .when(k % 23 == 1, F.lit("192-168"))
        .when(k % 23 == 2, F.concat(F.lit("192.168."), (k % 10).cast("string")))
        .when(k % 23 == 3, F.concat(F.lit("192.168."), F.lpad((k % 100).cast("string"), 2, "0")))
        .when(k % 23 == 4, F.concat(F.lit("192.168."), F.lpad((k % 1000).cast("string"), 3, "0")))
        .otherwise(F.concat(F.lit("192.168."), (F.lit(100) + F.col("c_nationkey")).cast("string"), F.lit("."),
                            (k % 256).cast("string"))).alias("ip"),
        F.concat(F.lit("M"), (k % 5).cast("string")).alias("modelo"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat((whole % 101).cast("string"), F.lit("%"))).alias("toner_negro"),
        F.when(k % 9 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("0"), F.when(k % 2 == 0, F.lit(",")).otherwise(F.lit(".")),
                            F.lpad((whole % 100).cast("string"), 2, "0"))).alias("ui_negro"),
        F.lit("OK").alias("estado"),
        F.lit(INVENTORY_STAMP).alias("marca_de_tiempo"),
    )


def inventory_blank_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory with keys that hold no digit on every 29th device."""
    inv = inventory_raw(spark, sf_dir)
    return inv.withColumn("ip", F.when(F.col("device_id") % 29 == 5, F.lit("n/a")).otherwise(F.col("ip")))


def poll_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order per customer (``max_by`` aggregate: partial aggregation,
    so a customer with a huge order history is reduced map-side)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                  "o_totalprice", "o_orderdate", "o_orderpriority")
    newest = o.groupBy("o_custkey").agg(F.max_by(
        F.struct("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
        F.struct("o_orderdate", "o_orderkey")).alias("o"))
    q = newest.select("o_custkey", "o.*")
    lacks = F.col("o_orderpriority") == F.lit(NO_GAUGE_PRIORITY)       # the page was read, without its gauges
    st, key = F.col("o_orderstatus"), F.col("o_orderkey")
    whole = F.floor("o_totalprice").cast("bigint")
    toner = (F.when(lacks, F.lit(None)).when(st != "F", F.lit(""))
             .when(key % 11 == 0, F.lit("--"))
             .otherwise(F.concat((whole % 101).cast("string"),
                                 F.when(key % 2 == 0, F.lit(".5%")).otherwise(F.lit(" %")))))
    ui = F.when(lacks, F.lit(None)).when(st != "F", F.lit("")).otherwise(
        F.concat(F.lit("0"), F.when(key % 2 == 0, F.lit(",")).otherwise(F.lit(".")),
                 F.lpad((whole % 100).cast("string"), 2, "0")))
    return q.select(
        F.col("o_custkey").alias("device_id"),
        F.when(lacks, F.lit("element_missing")).when(st == "F", F.lit("ok")).when(st == "O", F.lit("timeout")).otherwise(F.lit("driver_error")).alias("outcome"),
        toner.alias("toner_negro"),
        ui.alias("ui_negro"),
        F.lit(RUN_STAMP).alias("marca_de_tiempo"),
    )


def gauge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", "url", "html",
                    _case_mod((F.col("page_id") % 3).cast("int"), ("HP Admin", "Color Admin", "HP Planta"))
                    .alias("device_class"))


# Classes of the rewritten pages, by page id modulo 8.
_PAGE_CLASSES = ("HP Admin", "HP Planta", "Color Admin", "HP Planta - 2", "Color Planta", "Impresora CLX-6260",
                 "Impresoras Normales", "Impresoras a Color")


def device_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured pages, each with the gauges of one of the eight classes written
    in front, in the class's element pattern. ``shape`` (page id / 8 mod 6): 0 plain,
    1 single quotes and nested markup, 2 ids in descending order, 3 the last
    gauge missing, 4 ids that no class reads besides, 5 no page at all."""
    p = F.col("page_id")
    shape = F.pmod(F.floor(p / 8), F.lit(6))
    variants = []
    for k, cls in enumerate(_PAGE_CLASSES):
        n = len(K.GAUGE_MAP[cls])
        text = lambda i: F.concat(((p * 7 + i * 13) % 101).cast("string"), F.lit("%"))
        nested = lambda i: F.when(shape == 1, F.concat(F.lit("<b>"), text(i), F.lit("</b>"))).otherwise(text(i))
        kept = lambda i, x: F.when((shape == 3) & F.lit(i == n - 1), F.lit("")).otherwise(x)
        pattern = K.GAUGE_PATTERN[cls]
        if pattern == "supply_gauge":
            one = [kept(i, F.concat(F.when(shape == 1, f"<span class='g' id='SupplyGauge{i}'>")
                                    .otherwise(f'<span id="SupplyGauge{i}">'), nested(i), F.lit("</span>"))) for i in range(n)]
            far = F.when(shape == 4, '<i id="SupplyGauge99999999999">1%</i><i id="SupplyGauge2000000">2%</i>').otherwise("")
            body = F.concat(F.lit('<div id="SupplyName0">x</div>'), far,
                            F.when(shape == 2, F.concat(*one[::-1])).otherwise(F.concat(*one)))
        elif pattern == "grid":
            body = F.concat(*[kept(i, F.concat(F.when(shape == 1, "<div class='x-grid3-row'>").otherwise('<div class="a x-grid3-row">'),
                                               F.lit('<p class="x-column">c</p><p class="x-column b">'), nested(i), F.lit("</p></div>")))
                              for i in range(n)])
        elif pattern == "toner_list":
            body = F.concat(*[kept(i, F.concat(F.when(shape == 1, f"<table id='{t}'><tr><td class='tonervalue_number'>")
                                               .otherwise(f'<table id="{t}"><tr><td class="a tonervalue_number">'), nested(i),
                                               F.lit("</td></tr></table>"))) for i, t in enumerate(("toner_list", "imagine_list"))])
        else:
            cell = lambda i: kept(i, F.concat(F.lit("<tr><td>n</td><td>"), nested(i), F.lit("</td></tr>")))
            body = F.concat(F.lit("<table>"), *[F.concat(
                F.lit(f'<tr id="{r + 1}"><td>n<td><table><tr><td><table>'), cell(2 * r), cell(2 * r + 1),
                F.lit("</table></td></tr></table></td></tr>")) for r in range(4)], F.lit("</table>"))
        variants.append((k, cls, body))
    html, name = F.lit(None), F.lit(None)
    for k, cls, body in variants:
        html, name = F.when(p % 8 == k, body).otherwise(html), F.when(p % 8 == k, cls).otherwise(name)
    whole = F.when(shape != 5, F.concat(html, F.coalesce("html", F.lit(""))))
    return read_table(spark, sf_dir, "pages").select("page_id", "url", whole.alias("html"), name.alias("device_class"))


def class_sheets(spark: SparkSession, sf_dir: str):
    """Customers as devices of the eight classes, ``(class, generation, sheet)`` with columns of
    their own. Generation 1 (every other eight) has display names, its levels as numbers
    and not yet the last one; generation 2 has texts; one class counts pages besides."""
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    k = F.col("c_custkey")
    ip = F.concat(F.lit("10."), (k % 8).cast("string"), F.lit("."), F.col("c_nationkey").cast("string"), F.lit("."),
                  (k % 251).cast("string"))
    both = {**K.SUPPLY_COLUMNS, **K.IMAGING_COLUMNS}
    for i, cls in enumerate(_PAGE_CLASSES):
        level = lambda j: (k * 7 + j * 13) % 101
        for gen in (1, 2):
            rows = cu.filter((k % 8 == i) & (F.floor(k / 8) % 2 == gen - 1))
            names = K.GAUGE_MAP[cls][:-1] if gen == 1 else K.GAUGE_MAP[cls]
            if gen == 1:
                cols = [k.alias("device_id"), F.col("c_name").alias("Nombre"), ip.alias(" IP "), F.lit("M1").alias("Modelo")]
                cols += [(level(j) + 0.5).cast("double").alias(n) for j, n in enumerate(names)]
                cols += [F.lit("OK").alias("Estado"), F.lit(INVENTORY_STAMP).alias("Marca de Tiempo")]
            else:
                cols = [k.cast("string").alias("device_id"), F.col("c_name").alias("nombre"), ip.alias("ip"), F.lit("M2").alias("modelo")]
                cols += [F.concat(level(j).cast("string"), F.lit("%")).alias(both[n]) for j, n in enumerate(names)]
                cols += [F.lit("OK").alias("estado"), F.lit(RUN_STAMP).alias("marca_de_tiempo")]
                if cls == "Color Planta":
                    cols.append((k * 3).alias("contador"))
            yield cls, gen, rows.select(*cols)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history log as lines of text: every 29th line lacks its last fields, every 31st has
    one too many, every 37th has a level that is a word, every 41st no key."""
    raw = history_raw(spark, sf_dir)
    seq = F.col("seq")
    cell = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns}
    cell["kit_alim"] = F.when(seq % 37 == 0, F.lit("empty")).otherwise(cell["kit_alim"])
    cell["ip"] = F.when(seq % 41 == 0, F.lit("")).otherwise(cell["ip"])
    whole = F.concat_ws(",", *cell.values())
    line = (F.when(seq % 29 == 0, F.concat_ws(",", cell["seq"], cell["nombre"])).when(seq % 31 == 0, F.concat(whole, F.lit(",more")))
            .otherwise(whole))
    return raw.select(line.alias("value"))


def class_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls of three quarters of the class sheets' devices with every logged level of the class:
    each fifth was out of the net, each odd one's texts are no percentages."""
    k = F.col("device_id")
    parts = []
    for cls, _, sheet in class_sheets(spark, sf_dir):
        ip = " IP " if " IP " in sheet.columns else "ip"
        out, bad = k % 5 == 0, k % 2 == 1
        text = lambda j: F.when(out, "").when(bad, "--").otherwise(
            F.concat(((k * 11 + j * 17) % 103).cast("string"), F.lit(".4%")))
        levels = {K.SUPPLY_COLUMNS[n]: text(j) for j, n in enumerate(K.GAUGE_MAP[cls]) if n in K.SUPPLY_COLUMNS}
        parts.append(sheet.select(k.cast("long").alias("device_id"), F.col(f"`{ip}`").alias("ip")).filter(k % 4 != 3).select(
            F.lit(cls).alias("device_class"), "ip", k.alias("seq"),
            *[levels.get(c, F.lit(None).cast("string")).alias(c) for c in K.supply_cols()],
            F.when(out, K.STATUS_OFFLINE).otherwise(K.STATUS_OK).alias("estado"), F.lit(RUN_STAMP).alias("marca_de_tiempo")))
    return reduce(DataFrame.unionByName, parts)
