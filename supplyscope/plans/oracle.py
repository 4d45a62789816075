"""SQL twins of the query catalogue, for DuckDB.

Each entry is an independent formulation of the same result (row_number
dedupes instead of ``min_by``, an explicit positional join for the fallback
regression, ...), run by DuckDB over the same Parquet tables.  The adapters
of :mod:`supplyscope.sources.fixtures` are repeated as CTEs.
"""

from __future__ import annotations

from supplyscope import config as K
from supplyscope.functions.scalars import DOTTED_QUAD_RE, NUMBER_RE
from supplyscope.operators.series import ema_alpha
from supplyscope.sources import fixtures as X
from supplyscope.sources.pages import NAV_PATTERN

SUPPLIES = list(K.SUPPLY_COLUMNS.items())          # (display, column)
TS_FMT = "%Y-%m-%d %H:%M:%S"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# ------------------------------------------------------------ expressions
def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def num(x: str) -> str:
    t = strip(x)
    v = f"(CASE WHEN regexp_full_match({t}, {q(NUMBER_RE)}) THEN TRY_CAST({t} AS DOUBLE) END)"
    return f"(CASE WHEN abs({v}) < CAST('inf' AS DOUBLE) THEN {v} END)"


def round_to(x: str, n: int) -> str:
    f = float(10 ** n)
    return f"(round_even(({x}) * {f!r}, 0) / {f!r})"


def days_between(a: str, b: str) -> str:
    return f"(((epoch_us({b}) - epoch_us({a})) / 1e6) / 86400.0)"


def add_days(ts: str, d: str) -> str:
    secs = f"round_even(({d}) * 86400.0, 0)"
    left = f"(epoch_us(TIMESTAMP '9999-12-31 23:59:59') - epoch_us({ts})) / 1e6"
    return f"(CASE WHEN {secs} <= {left} THEN {ts} + to_seconds(CAST({secs} AS BIGINT)) END)"


def parse_ts(x: str) -> str:
    return f"try_strptime({x}, {q(TS_FMT)})"


def fmt_ip(x: str, style: str = "current", null_check: bool = True) -> str:
    src = x if null_check else f"coalesce({x}, '')"
    d = f"regexp_replace({src}, '[^0-9]', '', 'g')"
    head = f"substr({d}, 1, 3) || '.' || substr({d}, 4, 3) || '.'"
    short = f"{head} || substr({d}, 7)"
    if style == "dots":
        short = f"{short} || CASE WHEN length({d}) = 8 THEN '..' ELSE '.' END"
    elif style == "zero":
        short = f"{short} || '.0'"
    e = (f"CASE WHEN length({d}) IN (12, 11) THEN {head} || substr({d}, 7, 3) || '.' || substr({d}, 10) "
         f"WHEN length({d}) IN (10, 9) THEN {head} || substr({d}, 7, 2) || '.' || substr({d}, 9) "
         f"WHEN length({d}) IN (8, 7) THEN {short} ELSE {d} END")
    if null_check:
        return f"(CASE WHEN {x} IS NULL OR {strip(x)} = '' THEN NULL ELSE {e} END)"
    return f"({e})"


def clean_pct_sql(x: str, fail: str) -> str:
    v = num(f"replace({x}, '%', '')")
    r = f"round_even({v}, 0)"
    return f"(CASE WHEN abs({r}) < 9.2e18 THEN CAST(CAST({r} AS BIGINT) AS VARCHAR) || '%' ELSE {q(fail)} END)"


def pct_double(x: str) -> str:
    return num(f"replace(CAST({x} AS VARCHAR), '%', '')")


def fraction_pct(x: str) -> str:
    v = num(f"replace({x}, ',', '.')")
    y = f"({v} * 100.0)"
    return (f"(CASE WHEN {x} IS NULL THEN '' WHEN abs({y}) < 9.2e18 "
            f"THEN CAST(CAST(trunc({y}) AS BIGINT) AS VARCHAR) || '%' ELSE {x} END)")


def severity_sql(x: str, low: float = K.SEVERITY_LOW_BELOW) -> str:
    v = strip(f"coalesce(CAST({x} AS VARCHAR), 'None')")
    return (f"(CASE WHEN {v} IN ('0%', '0') THEN 'critical' "
            f"WHEN suffix({v}, '%') AND {num(f'substr({v}, 1, length({v}) - 1)')} < {float(low)!r} "
            f"THEN 'low' END)")


def class_case(cls: str, values: dict[str, str], default: str = "NULL") -> str:
    parts = " ".join(f"WHEN {cls} = {q(k)} THEN {v}" for k, v in values.items())
    return f"(CASE {parts} ELSE {default} END)"


def rule_sql(cls: str, present: list[str]) -> str:
    vals = {}
    for cname, sup in K.OK_RULE.items():
        terms = [f"coalesce({K.SUPPLY_COLUMNS[s]}, '') <> ''" if K.SUPPLY_COLUMNS[s] in present else "false"
                 for s in sup]
        vals[cname] = "(" + " OR ".join(terms) + ")"
    return class_case(cls, vals)


_STATUS = {
    "v4": {"no_key": "''", "ok": "'OK'", "element_missing": "'No se encontraron los elementos en el iframe.'",
           "timeout": "'Impresora Fuera de Red'", "driver_error": "'Impresora Fuera de Red'"},
    "v5": {"no_key": "''", "ok": "'OK'", "element_missing": "'Error'", "timeout": "'Impresora Fuera de Red'",
           "driver_error": "'Impresora Fuera de Red'"},
    "v6": {"no_key": "''", "ok": "'OK'", "element_missing": "'Error'", "timeout": "'Fuera de Red'",
           "driver_error": "'Fuera de Red'"},
    "v10_normal": {"no_key": "''", "ok": "'OK'", "element_missing": "'OK'", "timeout": "'Fuera de Red'",
                   "driver_error": "'Fuera de Red'"},
    "v7": {"no_key": "''", "ok": "'OK'", "element_missing": "'Error'", "timeout": "'No Disponible'",
           "driver_error": "'Fuera de Red'"},
    "v8": {"no_key": "''", "ok": "'OK'", "element_missing": "'No Disponible'", "timeout": "'No Disponible'",
           "driver_error": "'Fuera de Red'"},
    "v10": {"no_key": "''", "ok": "'OK'", "element_missing": "'OK'", "timeout": "'Fuera de Red'",
            "driver_error": "'Fuera de Red'"},
    "v11": {"no_key": "''", "ok": "'OK'", "element_missing": "'OK'", "timeout": "'No Disponible'",
            "driver_error": "'Fuera de Red'"},
    "v11_copy": {"no_key": "''", "ok": "ZERO", "element_missing": "ZERO", "timeout": "'No Disponible'",
                 "driver_error": "'Fuera de Red'"},
    "v11_clx": {"no_key": "''", "ok": "RULE", "element_missing": "'No Disponible'", "timeout": "'No Disponible'",
                "driver_error": "'Fuera de Red'"},
    "v13": {"no_key": "''", "ok": "RULE", "element_missing": "'No Disponible'", "timeout": "'No Disponible'",
            "driver_error": "'Fuera de Red'"},
}


def status_sql(outcome: str, rule: str, zero: str = "false", variant: str = "v13") -> str:
    parts = []
    for o, lab in _STATUS[variant].items():
        if lab == "RULE":
            lab = f"(CASE WHEN {rule} THEN 'OK' ELSE 'No disponible' END)"
        elif lab == "ZERO":
            lab = f"(CASE WHEN {zero} THEN 'No Disponible' ELSE 'OK' END)"
        parts.append(f"WHEN {outcome} = '{o}' THEN {lab}")
    return "(CASE " + " ".join(parts) + " END)"


# ------------------------------------------------------------ adapters
_EVENT_SUPPLY = [("click", "toner_negro"), ("view", "toner_cian"), ("purchase", "toner_magenta"),
                 ("signup", "toner_amarillo"), ("error", "kit_mant")]

ADAPTERS = f"""
readings_long AS (
  SELECT event_id AS seq, user_id AS device, event_type AS supply, ts, value AS pct FROM events),
hist_t AS (
  SELECT event_id AS seq, user_id, event_type, ts,
    CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 17 = 0 THEN '--' WHEN event_id % 19 = 0 THEN NULL
         ELSE CAST(CAST(floor(value) AS BIGINT) % 101 AS VARCHAR)
              || CASE WHEN event_id % 3 = 0 THEN '.5%' ELSE '%' END END AS txt
  FROM events
  UNION ALL
  SELECT event_id + {X.RELOG_SEQ_OFFSET}, user_id, event_type, ts, '50%' FROM events WHERE value > {X.RELOG_ABOVE!r}),
history_raw AS (
  SELECT seq, 'Printer ' || CAST(user_id AS VARCHAR) AS nombre,
    '192.168.' || CAST(100 + user_id % 25 AS VARCHAR) || '.' || CAST(user_id AS VARCHAR) AS ip,
    CASE WHEN user_id % 40 = 0 THEN NULL ELSE 'M' || CAST(user_id % 5 AS VARCHAR) END AS modelo,
    {", ".join(f"CASE WHEN event_type = '{e}' THEN txt END AS {c}" for e, c in _EVENT_SUPPLY)},
    CAST(NULL AS VARCHAR) AS kit_alim,
    CASE seq % 10 WHEN 3 THEN 'Fuera de Red' WHEN 4 THEN ' OK ' ELSE 'OK' END AS estado,
    CASE WHEN seq % 97 = 0 THEN 'not a date' ELSE CAST(date_trunc('second', ts) AS VARCHAR) END AS marca_de_tiempo
  FROM hist_t),
inventory_raw AS (
  SELECT c_custkey AS device_id, c_name AS nombre,
    CASE c_custkey % 3 WHEN 0 THEN 'HP Admin' WHEN 1 THEN 'Color Admin' ELSE 'HP Planta' END AS device_class,
    CASE WHEN c_custkey % 50 = 0 THEN '  ' WHEN c_custkey % 51 = 0 THEN NULL
         WHEN c_custkey % 23 = 1 THEN '192-168'
         WHEN c_custkey % 23 = 2 THEN '192.168.' || CAST(c_custkey % 10 AS VARCHAR)
         WHEN c_custkey % 23 = 3 THEN '192.168.' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0')
         WHEN c_custkey % 23 = 4 THEN '192.168.' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
         ELSE '192.168.' || CAST(100 + c_nationkey AS VARCHAR) || '.' || CAST(c_custkey % 256 AS VARCHAR) END AS ip,
    'M' || CAST(c_custkey % 5 AS VARCHAR) AS modelo,
    CASE WHEN c_custkey % 7 = 0 THEN NULL
         ELSE CAST(abs(CAST(floor(c_acctbal) AS BIGINT)) % 101 AS VARCHAR) || '%' END AS toner_negro,
    CASE WHEN c_custkey % 9 = 0 THEN NULL
         ELSE '0' || CASE WHEN c_custkey % 2 = 0 THEN ',' ELSE '.' END
              || lpad(CAST(abs(CAST(floor(c_acctbal) AS BIGINT)) % 100 AS VARCHAR), 2, '0') END AS ui_negro,
    'OK' AS estado, {q(X.INVENTORY_STAMP)} AS marca_de_tiempo
  FROM customer),
poll_q AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders),
poll_raw AS (
  SELECT o_custkey AS device_id,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'element_missing' WHEN o_orderstatus = 'F' THEN 'ok'
         WHEN o_orderstatus = 'O' THEN 'timeout' ELSE 'driver_error' END AS outcome,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus <> 'F' THEN '' WHEN o_orderkey % 11 = 0 THEN '--'
         ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 101 AS VARCHAR)
              || CASE WHEN o_orderkey % 2 = 0 THEN '.5%' ELSE ' %' END END AS toner_negro,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus <> 'F' THEN ''
         ELSE '0' || CASE WHEN o_orderkey % 2 = 0 THEN ',' ELSE '.' END
              || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS VARCHAR), 2, '0') END AS ui_negro,
    {q(X.RUN_STAMP)} AS marca_de_tiempo
  FROM poll_q WHERE rn = 1),
gauge_pages AS (
  SELECT page_id, url, html,
    CASE CAST(page_id % 3 AS INTEGER) WHEN 0 THEN 'HP Admin' WHEN 1 THEN 'Color Admin' ELSE 'HP Planta' END
      AS device_class
  FROM pages)"""

_INV_COLS = "device_id, nombre, device_class, ip, modelo, toner_negro, ui_negro, estado, marca_de_tiempo"


def _with(*ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return "WITH " + ADAPTERS + extra + "\n"


# --------------------------------------------------------- shared CTEs
def _poll_ctes(variant: str = "v13", by_class: bool = True, name: str = "poll_d", inv: str = "inventory_raw") -> list[str]:
    rule = rule_sql("device_class", ["toner_negro", "ui_negro"])
    zero = "(toner_negro = '0%' AND ui_negro = '0%')"
    blank = "'0%'" if variant in ("v10", "v10_normal", "v11", "v11_copy") else "''"
    part = "device_class, ip" if by_class else "ip"
    keys = "device_class, ip" if by_class else "ip"
    return [
        f"""inv_keys_{name} AS (SELECT device_id, device_class, {fmt_ip('ip')} AS ip FROM {inv}
            WHERE {fmt_ip('ip')} IS NOT NULL)""",
        f"""poll_j_{name} AS (SELECT p.device_id, k.device_class, k.ip,
              CASE WHEN k.ip = '' THEN 'no_key' ELSE p.outcome END AS outcome,
              p.toner_negro, p.ui_negro, p.marca_de_tiempo
            FROM poll_raw p JOIN inv_keys_{name} k ON p.device_id = k.device_id)""",
        f"""poll_l_{name} AS (SELECT device_id, device_class, ip, outcome,
              CASE WHEN outcome IN ('ok', 'element_missing') THEN coalesce(toner_negro, {blank}) ELSE '' END AS toner_negro,
              CASE WHEN outcome IN ('ok', 'element_missing') THEN coalesce(ui_negro, {blank}) ELSE '' END AS ui_negro,
              CASE WHEN outcome = 'no_key' THEN '' ELSE marca_de_tiempo END AS marca_de_tiempo
            FROM poll_j_{name})""",
        f"""poll_s_{name} AS (SELECT {keys}, device_id AS seq, toner_negro, ui_negro,
              {status_sql('outcome', rule, zero, variant)} AS estado, marca_de_tiempo,
              row_number() OVER (PARTITION BY {part} ORDER BY device_id) AS rn
            FROM poll_l_{name})""",
        f"""{name} AS (SELECT {keys}, toner_negro, ui_negro, estado, marca_de_tiempo FROM poll_s_{name} WHERE rn = 1)""",
    ]


def _merge_ctes() -> list[str]:
    return _poll_ctes() + [
        f"""inv_n AS (SELECT device_id, nombre, device_class, {fmt_ip('ip')} AS ip, modelo, toner_negro, ui_negro,
              estado, marca_de_tiempo FROM inventory_raw)""",
        """mj AS (SELECT i.*, p.toner_negro AS toner_negro_new, p.ui_negro AS ui_negro_new,
              p.estado AS estado_new, p.marca_de_tiempo AS marca_de_tiempo_new
            FROM inv_n i LEFT JOIN poll_d p ON i.device_class = p.device_class AND i.ip = p.ip)""",
    ]


def _refresh_ctes() -> list[str]:
    owners = [k for k, sup in K.GAUGE_MAP.items() if "Toner Negro" in sup]
    zero = [k for k, v in K.CLEAN_FAILURE.items() if v == "0%"]
    inl = lambda xs: "(" + ", ".join(q(x) for x in xs) + ")"
    cleaned = (f"CASE WHEN device_class IN {inl(zero)} THEN {clean_pct_sql('toner_negro_new', '0%')} "
               f"ELSE {clean_pct_sql('toner_negro_new', '')} END")
    return _merge_ctes() + [
        f"""refreshed AS (SELECT device_id, nombre, device_class, ip, modelo,
              CASE WHEN device_class IN {inl(owners)} AND estado_new = 'OK' THEN {cleaned}
                   WHEN device_class IN {inl(owners)} THEN coalesce(toner_negro, '') ELSE toner_negro END AS toner_negro,
              ui_negro,
              coalesce(estado_new, coalesce(estado, '')) AS estado,
              coalesce(marca_de_tiempo_new, coalesce(marca_de_tiempo, '')) AS marca_de_tiempo
            FROM mj)"""]


def _clean_ctes() -> list[str]:
    conv = ", ".join(f"{pct_double(c)} AS {c}" for _, c in SUPPLIES)
    return [
        f"""ch_ok AS (SELECT * FROM history_raw WHERE {strip('estado')} = 'OK')""",
        f"""ch_c AS (SELECT seq, nombre, ip, modelo, {conv}, estado, marca_de_tiempo,
              {parse_ts('marca_de_tiempo')} AS fecha FROM ch_ok)""",
        """ch_r AS (SELECT *, row_number() OVER (PARTITION BY ip, marca_de_tiempo
              ORDER BY fecha DESC NULLS LAST, seq) AS rn FROM ch_c)""",
        """clean AS (SELECT * EXCLUDE (rn) FROM ch_r WHERE rn = 1)""",
    ]


def _cells(src: str, ids: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, {q(d)} AS consumible, CAST({i} AS INTEGER) AS consumible_ix, CAST({c} AS VARCHAR) AS valor "
        f"FROM {src}" for i, (d, c) in enumerate(SUPPLIES))


def _steps_ctes(src: str, keys: str, ts: str, val: str, prefix: str) -> list[str]:
    """Window steps over ``src`` rows (non-null ts/val): days, deltas, step flag,
    rate, position rn, size n, step rank i and count m."""
    w = f"PARTITION BY {keys}"
    wo = f"PARTITION BY {keys} ORDER BY {ts}, seq"
    return [
        f"""{prefix}_s AS (SELECT *,
              {days_between(f'min({ts}) OVER ({w})', ts)} AS days,
              {days_between(f'min({ts}) OVER ({w})', f'lag({ts}) OVER ({wo})')} AS prev_days,
              lag({val}) OVER ({wo}) AS prev_val,
              row_number() OVER ({wo}) AS rn, count(*) OVER ({w}) AS n
            FROM {src})""",
        f"""{prefix}_t AS (SELECT *, days - prev_days AS delta_days, -({val} - prev_val) AS delta_pct,
              coalesce(days - prev_days > 0, false) AS step FROM {prefix}_s)""",
        f"""{prefix}_u AS (SELECT *, CASE WHEN step THEN delta_pct / delta_days END AS rate,
              sum(CASE WHEN step THEN 1 ELSE 0 END) OVER ({wo} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS i,
              sum(CASE WHEN step THEN 1 ELSE 0 END) OVER ({w}) AS m
            FROM {prefix}_t)""",
    ]


def _ema_weight(span: int = K.EMA_SPAN) -> str:
    a = ema_alpha(span)
    b = 1.0 - a
    return (f"(CASE WHEN step THEN (CASE WHEN i = 1 THEN pow({b!r}, CAST(m - 1 AS DOUBLE)) "
            f"ELSE {a!r} * pow({b!r}, CAST(m - i AS DOUBLE)) END) END)")


_READ_STEPS = _steps_ctes("(SELECT * FROM readings_long WHERE ts IS NOT NULL AND pct IS NOT NULL)",
                          "device, supply", "ts", "pct", "rd")


def _ema_series_sql(span: int = K.EMA_SPAN) -> str:
    """The recurrence itself, one step after the other."""
    a = ema_alpha(span)
    same = "u.device IS NOT DISTINCT FROM e.device AND u.supply IS NOT DISTINCT FROM e.supply"
    ctes = _with(*_READ_STEPS, "es AS MATERIALIZED (SELECT seq, device, supply, i, rate FROM rd_u WHERE step)",
                 f"""e AS (SELECT seq, device, supply, i, rate AS ema FROM es WHERE i = 1
                 UNION ALL SELECT u.seq, u.device, u.supply, u.i, {1.0 - a!r} * e.ema + {a!r} * u.rate
                 FROM e JOIN es u ON {same} AND u.i = e.i + 1)""").replace("WITH ", "WITH RECURSIVE ", 1)
    return ctes + (f"SELECT r.seq, r.device, r.supply, {round_to('e.ema', 6)} AS ema "
                   "FROM rd_u r LEFT JOIN e ON e.seq = r.seq")


def _alert5(d: str) -> str:
    return (f"(CASE WHEN {d} IS NULL OR isnan({d}) THEN {q(K.ALERT_INSUFFICIENT)} "
            f"WHEN {d} <= {float(K.ALERT_CRITICAL_DAYS)!r} THEN {q(K.ALERT_URGENT)} "
            f"WHEN {d} <= {float(K.ALERT_MEDIUM_DAYS)!r} THEN {q(K.ALERT_SOON)} "
            f"WHEN {d} <= {float(K.ALERT_LOW_STOCK_DAYS)!r} THEN {q(K.ALERT_LOW_STOCK)} ELSE {q(K.ALERT_OK)} END)")


def _alert2(d: str) -> str:
    return f"(CASE WHEN {d} <= {float(K.LINEAR_ALERT_DAYS)!r} THEN {q(K.ALERT2_SOON)} ELSE {q(K.ALERT2_OK)} END)"


def _nd(a: str, b: str, cols=("ip", "modelo", "consumible")) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def _forecast_ema_sql(alerts: bool, dedupe: bool = True) -> str:
    a = ema_alpha(K.EMA_SPAN)
    long = " UNION ALL ".join(
        f"SELECT seq, nombre, ip, modelo, fecha, {q(d)} AS consumible, {c} AS valor FROM clean"
        for d, c in SUPPLIES)
    ctes = (_clean_ctes() if dedupe else [*_clean_ctes()[:2], "clean AS (SELECT * FROM ch_c)"]) + [
        f"fl AS (SELECT * FROM ({long}) WHERE ip IS NOT NULL AND modelo IS NOT NULL)",
        "fv AS (SELECT * FROM fl WHERE fecha IS NOT NULL AND valor IS NOT NULL)",
    ] + _steps_ctes("fv", "ip, modelo, consumible", "fecha", "valor", "fe") + [
        """f_series AS (SELECT ip, modelo, consumible FROM fl GROUP BY ip, modelo, consumible
              HAVING count(valor) > 0)""",
        """f_name AS (SELECT ip, modelo, consumible, nombre FROM (SELECT *, row_number() OVER (
              PARTITION BY ip, modelo, consumible ORDER BY fecha DESC NULLS LAST, seq) AS r FROM fl) WHERE r = 1)""",
        """f_last AS (SELECT ip, modelo, consumible, valor AS p FROM (SELECT *, row_number() OVER (
              PARTITION BY ip, modelo, consumible ORDER BY fecha DESC, seq DESC) AS r FROM fv) WHERE r = 1)""",
        f"""f_stats AS (SELECT ip, modelo, consumible, count(*) AS n,
              sum(CASE WHEN step THEN 1 ELSE 0 END) AS m,
              sum({_ema_weight()} * rate) AS ema,
              max(CASE WHEN step THEN fecha END) AS last_ts
            FROM fe_u GROUP BY ip, modelo, consumible)""",
        """f_slope AS (SELECT x.ip, x.modelo, x.consumible, regr_slope(y.valor, x.days) AS slope
            FROM (SELECT * FROM fe_u WHERE step) x JOIN fe_u y
              ON x.ip = y.ip AND x.modelo = y.modelo AND x.consumible = y.consumible AND x.i = y.rn
            GROUP BY x.ip, x.modelo, x.consumible)""",
        """f_agg AS (SELECT s.ip, s.modelo, s.consumible, nm.nombre, coalesce(st.n, 0) AS n, lp.p,
              coalesce(st.m, 0) AS m, CASE WHEN st.m >= 1 THEN st.ema END AS ema, st.last_ts, sl.slope
            FROM f_series s JOIN f_name nm ON s.ip = nm.ip AND s.modelo = nm.modelo AND s.consumible = nm.consumible
            LEFT JOIN f_stats st ON s.ip = st.ip AND s.modelo = st.modelo AND s.consumible = st.consumible
            LEFT JOIN f_last lp ON s.ip = lp.ip AND s.modelo = lp.modelo AND s.consumible = lp.consumible
            LEFT JOIN f_slope sl ON s.ip = sl.ip AND s.modelo = sl.modelo AND s.consumible = sl.consumible)""",
        f"""f_r AS (SELECT *,
              CASE WHEN ema > 0 THEN ema WHEN m >= 3 THEN -coalesce(slope, 0.0) END AS r,
              CASE WHEN ema > 0 THEN {q(K.METHOD_EMA.format(span=K.EMA_SPAN))}
                   WHEN m >= 3 THEN {q(K.METHOD_FALLBACK)} ELSE {q(K.METHOD_INVALID_SLOPE)} END AS meth
            FROM f_agg)""",
        "f_d AS (SELECT *, CASE WHEN n >= 2 AND r > 0 THEN p / r END AS d FROM f_r)",
        f"""f_out AS (SELECT nombre, ip, modelo, consumible,
              CASE WHEN n < 2 THEN NULL WHEN r IS NULL OR r <= 0 THEN p ELSE {round_to('p', 1)} END AS porcentaje_actual,
              CASE WHEN n < 2 THEN NULL WHEN r IS NULL OR r <= 0 THEN 0.0
                   WHEN d > {float(K.MAX_FORECAST_DAYS)!r} THEN {round_to('r', 6)} ELSE {round_to('r', 4)} END AS consumo_diario,
              CASE WHEN n < 2 OR r IS NULL OR r <= 0 THEN NULL ELSE {round_to('d', 1)} END AS dias_restantes,
              CASE WHEN n < 2 OR r IS NULL OR r <= 0 OR d > {float(K.MAX_FORECAST_DAYS)!r} THEN NULL
                   ELSE {add_days('last_ts', 'd')} END AS fecha_agotamiento,
              CASE WHEN n < 2 THEN {q(K.METHOD_TOO_FEW)} WHEN r IS NULL OR r <= 0 THEN meth
                   WHEN d > {float(K.MAX_FORECAST_DAYS)!r} THEN meth || {q(K.SUFFIX_UNRELIABLE)} ELSE meth END AS metodo
            FROM f_d)""",
    ]
    assert a > 0
    sel = f"SELECT *, {_alert5('dias_restantes')} AS alerta FROM f_out" if alerts else "SELECT * FROM f_out"
    return _with(*ctes) + sel


def _forecast_linear_sql(alerts: bool) -> str:
    long = " UNION ALL ".join(
        f"SELECT seq, nombre, ip, modelo, fecha, {q(d)} AS consumible, {c} AS valor FROM lin"
        for d, c in SUPPLIES)
    x = days_between("t0s", "fecha")
    ctes = [
        f"lin AS (SELECT *, {parse_ts('marca_de_tiempo')} AS fecha FROM history_raw WHERE estado = 'OK')",
        f"ll AS (SELECT *, {pct_double('valor')} AS y FROM ({long}))",
        """lv AS (SELECT *, min(fecha) OVER (PARTITION BY ip, modelo, consumible) AS t0s FROM ll
              WHERE fecha IS NOT NULL AND valor IS NOT NULL AND y IS NOT NULL)""",
        """l_series AS (SELECT ip, modelo, consumible FROM ll GROUP BY ip, modelo, consumible HAVING count(valor) > 0)""",
        """l_name AS (SELECT ip, modelo, consumible, nombre FROM (SELECT *, row_number() OVER (
              PARTITION BY ip, modelo, consumible ORDER BY seq) AS r FROM ll) WHERE r = 1)""",
        """l_last AS (SELECT ip, modelo, consumible, y AS p, fecha AS t FROM (SELECT *, row_number() OVER (
              PARTITION BY ip, modelo, consumible ORDER BY fecha DESC, seq DESC) AS r FROM lv) WHERE r = 1)""",
        """l_first AS (SELECT ip, modelo, consumible, y AS p0, fecha AS t0 FROM (SELECT *, row_number() OVER (
              PARTITION BY ip, modelo, consumible ORDER BY fecha, seq) AS r FROM lv) WHERE r = 1)""",
        f"""l_stats AS (SELECT ip, modelo, consumible, count(*) AS n,
              CASE WHEN var_pop({x}) > 0 THEN regr_slope(y, {x}) END AS slope
            FROM lv GROUP BY ip, modelo, consumible)""",
        f"""l_agg AS (SELECT s.ip, s.modelo, s.consumible, nm.nombre, coalesce(st.n, 0) AS n, st.slope,
              la.p, la.t, fi.p0, fi.t0
            FROM l_series s JOIN l_name nm ON {_nd('s', 'nm')}
            LEFT JOIN l_stats st ON {_nd('s', 'st')}
            LEFT JOIN l_last la ON {_nd('s', 'la')}
            LEFT JOIN l_first fi ON {_nd('s', 'fi')})""",
        f"""l_r AS (SELECT *, CASE WHEN n >= 3 THEN -coalesce(slope, 0.0)
                   WHEN n = 2 THEN CASE WHEN {days_between('t0', 't')} > 0 THEN (p0 - p) / {days_between('t0', 't')} END
              END AS r,
              CASE WHEN n >= 3 THEN {q(K.METHOD_LINEAR)} ELSE {q(K.METHOD_SIMPLE)} END AS meth FROM l_agg)""",
        "l_d AS (SELECT *, CASE WHEN n >= 2 AND r > 0 THEN p / r END AS d FROM l_r)",
        f"""l_out AS (SELECT nombre, ip, modelo, consumible,
              CASE WHEN n < 2 THEN NULL WHEN r IS NULL OR r <= 0 THEN p ELSE {round_to('p', 1)} END AS porcentaje_actual,
              CASE WHEN n < 2 THEN NULL WHEN r IS NULL OR r <= 0 THEN 0.0 ELSE {round_to('r', 2)} END AS consumo_diario,
              CASE WHEN n < 2 OR r IS NULL OR r <= 0 THEN NULL ELSE {round_to('d', 1)} END AS dias_restantes,
              CASE WHEN n < 2 OR r IS NULL OR r <= 0 THEN NULL
                   ELSE CAST({add_days('t', 'd')} AS VARCHAR) END AS fecha_agotamiento,
              CASE WHEN n < 2 THEN {q(K.METHOD_TOO_FEW)} ELSE meth END AS metodo
            FROM l_d)""",
    ]
    sel = f"SELECT *, {_alert2('dias_restantes')} AS alerta FROM l_out" if alerts else "SELECT * FROM l_out"
    return _with(*ctes) + sel


# Rewritten pages: (class, element pattern, level columns by gauge position), by page id modulo 8.
DEVICE_PAGES = (
    ("HP Admin", "id", ("toner_negro", "kit_mant", "kit_alim")),
    ("HP Planta", "id", ("toner_negro",)),
    ("Color Admin", "id", ("toner_negro", "toner_cian", "toner_magenta", "toner_amarillo")),
    ("HP Planta - 2", "id", ("toner_negro", "kit_alim")),
    ("Color Planta", "id", ("toner_amarillo", "toner_magenta", "toner_cian", "toner_negro", "kit_alim")),
    ("Impresora CLX-6260", "grid", ("toner_negro", "toner_cian", "toner_magenta", "toner_amarillo")),
    ("Impresoras Normales", "toner_list", ("toner_negro", "ui_negro")),
    ("Impresoras a Color", "row_id", ("toner_negro", "ui_negro", "toner_cian", "ui_cian", "toner_magenta", "ui_magenta",
                                      "toner_amarillo", "ui_amarillo")),
)
DEVICE_LEVELS = ("toner_negro", "toner_cian", "toner_magenta", "toner_amarillo", "kit_mant", "kit_alim",
                 "ui_negro", "ui_cian", "ui_magenta", "ui_amarillo")


def _written_gauges(pattern: str | None = None) -> str:
    """The gauges the page rewrite puts in, from its rule alone: no page is parsed."""
    pos = " UNION ALL ".join(f"SELECT {k} AS k, {q(cls)} AS device_class, {i} AS gauge_ix, {q(c)} AS level, "
                             f"{i == len(cols) - 1} AS final" for k, (cls, how, cols) in enumerate(DEVICE_PAGES)
                             for i, c in enumerate(cols) if pattern in (None, how))
    return f"""SELECT page_id, url, device_class, CAST(gauge_ix AS INTEGER) AS gauge_ix, level, (page_id // 8) % 6 AS shape, final,
        CAST((page_id * 7 + gauge_ix * 13) % 101 AS VARCHAR) || '%' AS text
        FROM pages JOIN ({pos}) pos ON page_id % 8 = pos.k"""


def _extracted_sql(pattern: str) -> str:
    return (f"SELECT page_id, gauge_ix, text FROM ({_written_gauges(pattern)}) "
            "WHERE shape <> 5 AND NOT (shape = 3 AND final)")


def _gauges_sql() -> str:
    cols = ", ".join(f"max(CASE WHEN level = {q(c)} THEN CASE WHEN shape IN (3, 5) THEN '' ELSE text END END) AS {c}"
                     for c in DEVICE_LEVELS)
    return f"""SELECT page_id, url, device_class,
        CASE shape WHEN 5 THEN 'driver_error' WHEN 3 THEN 'element_missing' ELSE 'ok' END AS outcome, {cols},
        CASE shape WHEN 5 THEN 'Fuera de Red' WHEN 3 THEN 'No Disponible' ELSE 'OK' END AS estado
        FROM ({_written_gauges()}) GROUP BY page_id, url, device_class, shape"""


def _gauges_pivot_sql() -> str:
    gm = " UNION ALL ".join(f"SELECT {q(c)} AS device_class, {i} AS gauge_ix, {q(s)} AS consumible"
                            for c, sup in K.GAUGE_MAP.items() for i, s in enumerate(sup))
    cols = ", ".join(f"max(CASE WHEN consumible = {q(d)} THEN text END) AS {c}" for d, c in SUPPLIES)
    return _with(
        f"e AS (SELECT page_id, device_class, regexp_extract_all(html, {q(NAV_PATTERN)}, 2) AS l FROM gauge_pages)",
        "e2 AS (SELECT page_id, device_class, generate_subscripts(l, 1) - 1 AS gauge_ix, unnest(l) AS raw FROM e)",
        f"gm AS ({gm})",
        f"lab AS (SELECT e2.page_id, e2.device_class, gm.consumible, {strip('raw')} AS text FROM e2 "
        "JOIN gm ON e2.device_class = gm.device_class AND e2.gauge_ix = gm.gauge_ix)",
    ) + f"SELECT page_id, device_class, {cols} FROM lab GROUP BY page_id, device_class"


def _severity_counts_sql(low: float | None) -> str:
    cells = " UNION ALL ".join(f"SELECT device_class, '{s}' AS consumible, {c} AS cell FROM refreshed"
                               for s, c in (("Toner Negro", "toner_negro"), ("UI Negro", "ui_negro")))
    return _with(*_refresh_ctes()) + (
        f"SELECT device_class, consumible, {severity_sql('cell', -1e308 if low is None else low)} AS severity, "
        f"count(*) AS cells FROM ({cells}) GROUP BY ALL")


def _evolved_sql() -> str:
    """Levels by class, position and generation, straight from the customers."""
    gen = "CAST(floor(c_custkey / 8.0) AS BIGINT) % 2 + 1"
    cols = []
    for s, c in {**K.SUPPLY_COLUMNS, **K.IMAGING_COLUMNS}.items():
        parts = []
        for i, cls in enumerate(X._PAGE_CLASSES):
            names = K.GAUGE_MAP[cls]
            if s in names:
                j = names.index(s)
                value = f"(c_custkey * 7 + {j * 13}) % 101"
                old = "NULL" if j == len(names) - 1 else f"CAST({value} AS VARCHAR) || '.5'"
                parts.append(f"WHEN c_custkey % 8 = {i} THEN CASE WHEN g = 1 THEN {old} ELSE CAST({value} AS VARCHAR) || '%' END")
        cols.append(f"CASE {' '.join(parts)} END AS {c}")
    cls = " ".join(f"WHEN {i} THEN {q(c)}" for i, c in enumerate(X._PAGE_CLASSES))
    return f"""
        SELECT c_custkey AS device_id, c_name AS nombre, CASE c_custkey % 8 {cls} END AS device_class,
          '10.' || CAST(c_custkey % 8 AS VARCHAR) || '.' || CAST(c_nationkey AS VARCHAR) || '.'
            || CAST(c_custkey % 251 AS VARCHAR) AS ip, 'M' || CAST(g AS VARCHAR) AS modelo, {", ".join(cols)},
          'OK' AS estado, CASE WHEN g = 1 THEN {q(X.INVENTORY_STAMP)} ELSE {q(X.RUN_STAMP)} END AS marca_de_tiempo,
          CASE WHEN g = 2 AND c_custkey % 8 = {X._PAGE_CLASSES.index("Color Planta")}
               THEN '{{"contador":"' || CAST(c_custkey * 3 AS VARCHAR) || '"}}' END AS otros
        FROM (SELECT *, {gen} AS g FROM customer)"""


def _refresh_levels_sql() -> str:
    """Old and new level of every class and position, merged by hand."""
    inl = lambda xs: "(" + ", ".join(q(x) for x in xs) + ")"
    zero = [k for k, v in K.CLEAN_FAILURE.items() if v == "0%"]
    cols, k = [], "device_id"
    for s, c in K.SUPPLY_COLUMNS.items():
        owners = [cls for cls, names in K.GAUGE_MAP.items() if s in names]
        place = class_case("device_class", {cls: str(K.GAUGE_MAP[cls].index(s)) for cls in owners})
        text = f"(CASE WHEN {k} % 2 = 1 THEN '--' ELSE CAST(({k} * 11 + {place} * 17) % 103 AS VARCHAR) || '.4%' END)"
        clean = (f"CASE WHEN device_class IN {inl(zero)} THEN {clean_pct_sql(text, '0%')} ELSE {clean_pct_sql(text, '')} END")
        cols.append(f"CASE WHEN device_class IN {inl(owners)} THEN CASE WHEN ok THEN {clean} ELSE coalesce({c}, '') END ELSE {c} END AS {c}")
    rest = ", ".join(K.IMAGING_COLUMNS.values())
    # Two devices of a class may share an address: the poll with the smallest id counts for both.
    return f"""WITH e AS ({_evolved_sql()}),
        p AS (SELECT device_class, ip, min(device_id) AS polled FROM e WHERE device_id % 4 <> 3 GROUP BY device_class, ip),
        j AS (SELECT e.* EXCLUDE (device_id), e.device_id AS own, p.polled AS device_id,
                     p.polled IS NOT NULL AND p.polled % 5 <> 0 AS ok
              FROM e LEFT JOIN p ON e.device_class = p.device_class AND e.ip = p.ip)
        SELECT own AS device_id, nombre, device_class, ip, modelo, {", ".join(cols)}, {rest},
          CASE WHEN device_id IS NULL THEN estado WHEN ok THEN 'OK' ELSE {q(K.STATUS_OFFLINE)} END AS estado,
          CASE WHEN device_id IS NULL THEN marca_de_tiempo ELSE {q(X.RUN_STAMP)} END AS marca_de_tiempo FROM j"""


def _split_sql() -> str:
    """Lines by their sequence: broken ones as text, the others cell by cell. An empty cell reads as NULL."""
    cols = ["seq", *K.HISTORY_COLUMNS.values()]
    text = {c: f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols}
    text["kit_alim"] = f"CASE WHEN seq % 37 = 0 THEN 'empty' ELSE {text['kit_alim']} END"
    text["ip"] = f"CASE WHEN seq % 41 = 0 THEN '' ELSE {text['ip']} END"
    whole = " || ',' || ".join(f"({text[c]})" for c in cols)
    cells = ", ".join(f"nullif({text[c]}, '') AS {c}" for c in cols)
    blank = lambda c: f"({c} IS NULL OR {strip(c)} IN ('', '--'))"
    levels = ", ".join(f"CASE WHEN NOT {blank(c)} AND {pct_double(c)} IS NULL THEN '{c}: no percentage' END" for _, c in SUPPLIES)
    reasons = ("concat_ws('; ', CASE WHEN ip IS NULL OR " + strip("ip") + " = '' THEN 'ip: blank' END, " + levels
               + f", CASE WHEN {parse_ts('marca_de_tiempo')} IS NULL THEN 'marca_de_tiempo: no time' END)")
    shown = ", ".join(f"CASE WHEN line IS NULL THEN {c} END AS {c}" for c in cols)
    return _with(f"""ln AS (SELECT {cells}, CASE WHEN seq % 29 = 0 THEN {text['seq']} || ',' || {text['nombre']}
                       WHEN seq % 31 = 0 THEN {whole} || ',more' END AS line FROM history_raw)""",
                 f"lr AS (SELECT *, CASE WHEN line IS NOT NULL THEN 'no record' "
                 f"ELSE nullif({reasons}, '') END AS reasons FROM ln)") + f"""
        SELECT {shown}, line, reasons, (SELECT count(*) FROM lr) AS n_read, (SELECT count(*) FROM lr WHERE line IS NOT NULL) AS n_broken,
          (SELECT count(*) FROM lr WHERE line IS NULL AND reasons IS NOT NULL) AS n_bad_cells FROM lr"""


def oracle_sql() -> dict[str, str]:
    hist_cols = ", ".join(K.HISTORY_COLUMNS.values())
    cells = _cells("history_raw", "seq")
    pcl = ", ".join(f"{c}" for c in ["device_id", "nombre", "device_class"])
    sql = {
        "scan_inventory": _with() + "SELECT * FROM inventory_raw",
        "scan_history": _with() + "SELECT * FROM history_raw",
        "scan_classes_evolved": _evolved_sql(),
        "read_sheet_split": _split_sql(),
        "history_since": _with(f"hs AS (SELECT *, {parse_ts('marca_de_tiempo')} AS fecha FROM history_raw)") + (
            f"SELECT * FROM hs WHERE fecha >= TIMESTAMP {q(str(X.WEEK[0]))} AND fecha < TIMESTAMP {q(str(X.WEEK[1]))}"),
        "scan_all_classes": _with() + "SELECT * FROM inventory_raw",
        "extract_gauges": _with(
            f"e AS (SELECT page_id, regexp_extract_all(html, {q(NAV_PATTERN)}, 2) AS l FROM gauge_pages)",
            "e2 AS (SELECT page_id, generate_subscripts(l, 1) AS k, unnest(l) AS raw FROM e)",
        ) + f"SELECT page_id, CAST(k - 1 AS INTEGER) AS gauge_ix, {strip('raw')} AS text FROM e2",
        "extract_gauges_id": _extracted_sql("id"),
        "extract_gauges_toner_list": _extracted_sql("toner_list"),
        "extract_gauges_grid": _extracted_sql("grid"),
        "extract_gauges_row_id": _extracted_sql("row_id"),
        "gauges_to_supplies": _gauges_sql(),
        "gauges_pivot": _gauges_pivot_sql(),
        "trim_columns": _with() + "SELECT * FROM history_raw",
        "filter_valid_key": _with() + (
            f"SELECT {pcl}, {fmt_ip('ip')} AS ip, modelo, toner_negro, ui_negro, estado, marca_de_tiempo "
            f"FROM inventory_raw WHERE {fmt_ip('ip')} IS NOT NULL"),
        "filter_ok_trim": _with() + f"SELECT * FROM history_raw WHERE {strip('estado')} = 'OK'",
        "filter_ok_exact": _with() + "SELECT * FROM history_raw WHERE estado = 'OK'",
        "stamp_run": _with() + (
            f"SELECT {pcl}, ip, modelo, toner_negro, ui_negro, estado, {q(X.RUN_STAMP)} AS marca_de_tiempo "
            "FROM inventory_raw"),
        "ip_to_url": _with(f"u AS (SELECT device_id, {fmt_ip('ip')} AS ip FROM inventory_raw)") + (
            "SELECT device_id, ip, CASE WHEN ip IS NOT NULL AND ip <> '' THEN 'http://' || ip END AS url FROM u"),
        "parse_ts": _with() + f"SELECT seq, marca_de_tiempo, {parse_ts('marca_de_tiempo')} AS fecha FROM history_raw",
        "format_ip": _with() + f"SELECT device_id, ip, {fmt_ip('ip')} AS ip_fmt FROM inventory_raw",
        "format_ip_dots": _with() + (
            f"SELECT device_id, ip, {fmt_ip('ip', 'dots', False)} AS ip_v6, {fmt_ip('ip', 'dots')} AS ip_v7 "
            "FROM inventory_raw"),
        "format_ip_zero": _with() + f"SELECT device_id, ip, {fmt_ip('ip', 'zero')} AS ip_fmt FROM inventory_raw",
        "normalize_ip": _with() + (
            f"SELECT device_id, ip, CASE WHEN regexp_full_match({strip('ip')}, {q(DOTTED_QUAD_RE)}) "
            f"THEN {strip('ip')} ELSE {fmt_ip('ip')} END AS ip_fmt FROM inventory_raw"),
        "unpivot_supplies": _with() + _cells("history_raw", "seq, ip"),
        "clean_pct_blank": _with(f"c AS ({cells})") + f"SELECT *, {clean_pct_sql('valor', '')} AS out FROM c",
        "clean_pct_zero": _with(f"c AS ({cells})") + f"SELECT *, {clean_pct_sql('valor', '0%')} AS out FROM c",
        "clean_pct_float": _with(f"c AS ({cells})") + f"SELECT *, {num("replace(valor, '%', '')")} AS out FROM c",
        "pct_to_double": _with(f"c AS ({cells})") + f"SELECT *, {pct_double('valor')} AS out FROM c",
        "severity": _with(f"c AS ({cells})") + f"SELECT *, {severity_sql('valor')} AS severity FROM c",
        "fraction_to_pct": _with() + (
            f"SELECT device_id, toner_negro, ui_negro, {fraction_pct('toner_negro')} AS toner_pct, "
            f"{fraction_pct('ui_negro')} AS ui_pct FROM inventory_raw"),
        "classify_status": _with(
            "cs AS (SELECT p.*, i.device_class FROM poll_raw p JOIN inventory_raw i ON p.device_id = i.device_id)"
        ) + "SELECT device_id, device_class, outcome, " + ", ".join(
            f"{status_sql('outcome', rule_sql('device_class', ['toner_negro', 'ui_negro']), "(toner_negro = '0%' AND ui_negro = '0%')", v)} AS status_{v}"
            for v in ["v4", "v5", "v6", "v10_normal", "v7", "v8", "v10", "v11", "v11_copy", "v11_clx", "v13"]) + " FROM cs",
        "merge_left": _with(*_merge_ctes()) + "SELECT * FROM mj",
        "merge_bucketed": _with(*_merge_ctes()) + "SELECT * FROM mj",
        "merge_overwrite": _with(*_merge_ctes()) + (
            f"SELECT {pcl}, ip, modelo, toner_negro_new AS toner_negro, ui_negro_new AS ui_negro, "
            "estado_new AS estado, marca_de_tiempo_new AS marca_de_tiempo FROM mj"),
        "merge_coalesce": _with(*_merge_ctes()) + (
            f"SELECT {pcl}, ip, modelo, coalesce(toner_negro_new, toner_negro) AS toner_negro, "
            "coalesce(ui_negro_new, ui_negro) AS ui_negro, coalesce(estado_new, estado) AS estado, "
            "coalesce(marca_de_tiempo_new, marca_de_tiempo) AS marca_de_tiempo FROM mj"),
        "merge_masked": _with(*_merge_ctes()) + (
            f"SELECT {pcl}, ip, modelo, "
            "CASE WHEN estado_new = 'OK' THEN toner_negro_new ELSE toner_negro END AS toner_negro, "
            "CASE WHEN estado_new = 'OK' THEN ui_negro_new ELSE ui_negro END AS ui_negro, "
            "coalesce(estado_new, estado) AS estado, coalesce(marca_de_tiempo_new, marca_de_tiempo) AS marca_de_tiempo "
            "FROM mj"),
        "merge_masked_clean": _with(*_merge_ctes()) + (
            f"SELECT {pcl}, ip, modelo, "
            f"CASE WHEN estado_new = 'OK' THEN {clean_pct_sql('toner_negro_new', '')} ELSE coalesce(toner_negro, '') END "
            "AS toner_negro, ui_negro, coalesce(estado_new, coalesce(estado, '')) AS estado, "
            "coalesce(marca_de_tiempo_new, coalesce(marca_de_tiempo, '')) AS marca_de_tiempo FROM mj"),
        "refresh_inventory": _with(*_refresh_ctes()) + "SELECT * FROM refreshed",
        "refresh_inventory_mono": _with(
            *_poll_ctes("v11", by_class=False, name="poll_m"),
            f"""inv_m AS (SELECT device_id, nombre, device_class, {fmt_ip('ip')} AS ip, modelo, toner_negro, ui_negro,
                  estado, marca_de_tiempo FROM inventory_raw)""",
            """mm AS (SELECT i.*, p.toner_negro AS tn_new, p.ui_negro AS ui_new, p.estado AS estado_new,
                  p.marca_de_tiempo AS marca_new FROM inv_m i LEFT JOIN poll_m p ON i.ip = p.ip)""",
            """mm2 AS (SELECT device_id, nombre, device_class, ip, modelo,
                  CASE WHEN estado_new = 'OK' THEN tn_new ELSE coalesce(toner_negro, '') END AS toner_negro,
                  CASE WHEN estado_new = 'OK' THEN ui_new ELSE coalesce(ui_negro, '') END AS ui_negro,
                  coalesce(estado_new, estado) AS estado, coalesce(marca_new, marca_de_tiempo) AS marca_de_tiempo
                FROM mm)""",
        ) + (f"SELECT {pcl}, ip, modelo, {fraction_pct('toner_negro')} AS toner_negro, "
             f"{fraction_pct('ui_negro')} AS ui_negro, estado, marca_de_tiempo FROM mm2"),
        "refresh_inventory_color": _with(
            *_poll_ctes("v8", by_class=False, name="poll_c"),
            f"""inv_c AS (SELECT device_id, nombre, device_class, {fmt_ip('ip')} AS ip, modelo, toner_negro, ui_negro,
                  estado, marca_de_tiempo FROM inventory_raw)""",
            f"""mc AS (SELECT i.*, {clean_pct_sql('p.toner_negro', '')} AS tn_new, {clean_pct_sql('p.ui_negro', '')} AS ui_new,
                  p.estado AS estado_new, p.marca_de_tiempo AS marca_new FROM inv_c i LEFT JOIN poll_c p ON i.ip = p.ip)""",
        ) + (f"SELECT {pcl}, ip, modelo, "
             "CASE WHEN estado_new = 'OK' THEN tn_new ELSE toner_negro END AS toner_negro, "
             "CASE WHEN estado_new = 'OK' THEN ui_new ELSE ui_negro END AS ui_negro, "
             "coalesce(estado_new, estado) AS estado, coalesce(marca_new, marca_de_tiempo) AS marca_de_tiempo FROM mc"),
        "severity_counts": _severity_counts_sql(11),
        "severity_counts_below_5": _severity_counts_sql(5),
        "severity_counts_red": _severity_counts_sql(None),
        "refresh_new_level": _with(*(c.replace("FROM inventory_raw", "FROM (SELECT * REPLACE (NULL::VARCHAR AS toner_negro) FROM inventory_raw)")
                                     for c in _refresh_ctes())) + "SELECT * FROM refreshed",
        "history_append": _with(*_refresh_ctes()) + (
            f"SELECT seq, {hist_cols} FROM history_raw UNION ALL "
            "SELECT CAST(NULL AS BIGINT), nombre, ip, modelo, toner_negro, NULL, NULL, NULL, NULL, NULL, estado, "
            "marca_de_tiempo FROM refreshed"),
        "clean_history": _with(*_clean_ctes()) + "SELECT * FROM clean",
        "dedupe_history": _with(
            "dd AS (SELECT *, row_number() OVER (PARTITION BY ip, marca_de_tiempo ORDER BY seq) AS rn FROM history_raw)"
        ) + "SELECT * EXCLUDE (rn) FROM dd WHERE rn = 1",
        "history_sorted": _with(*_clean_ctes()) + "SELECT * FROM clean ORDER BY fecha DESC NULLS LAST, seq",
        "group_name_latest": _with(*_clean_ctes(), """gn AS (SELECT *, row_number() OVER (PARTITION BY ip, modelo
              ORDER BY fecha DESC NULLS LAST, seq) AS r FROM clean WHERE ip IS NOT NULL AND modelo IS NOT NULL)""")
        + "SELECT ip, modelo, nombre FROM gn WHERE r = 1",
        "elapsed_days": _with(*_READ_STEPS) + "SELECT seq, device, supply, days FROM rd_u",
        "delta_days": _with(*_READ_STEPS) + "SELECT seq, device, supply, delta_days FROM rd_u",
        "delta_pct": _with(*_READ_STEPS) + "SELECT seq, device, supply, delta_pct FROM rd_u",
        "step_rate": _with(*_READ_STEPS) + "SELECT seq, device, supply, rate FROM rd_u",
        "ema_last": _with(*_READ_STEPS) + (
            f"SELECT device, supply, CAST(sum(CASE WHEN step THEN 1 ELSE 0 END) AS BIGINT) AS m, "
            f"{round_to(f'sum({_ema_weight()} * rate)', 6)} AS ema FROM rd_u GROUP BY device, supply"),
        "ema_series": _ema_series_sql(),
        "regr_slope_supply": _with(*_READ_STEPS) + (
            "SELECT device, supply, count(*) AS n, CASE WHEN count(*) >= 2 THEN "
            + round_to("coalesce(CASE WHEN var_pop(days) > 0 THEN regr_slope(pct, days) END, 0.0)", 6)
            + " END AS slope FROM rd_u GROUP BY device, supply"),
        "latest_level": _with(
            """ll AS (SELECT *, row_number() OVER (PARTITION BY device, supply ORDER BY ts DESC NULLS LAST,
                  seq DESC) AS r, max(ts) OVER (PARTITION BY device, supply) AS last_ts FROM readings_long)"""
        ) + "SELECT device, supply, last_ts, pct FROM ll WHERE r = 1",
        "simple_rate": _with(*_READ_STEPS) + (
            "SELECT device, supply, CASE WHEN delta_days > 0 THEN delta_pct / delta_days END AS simple_rate "
            "FROM rd_u WHERE rn = n"),
        "alert_band": _with(*_READ_STEPS,
                            f"ab AS (SELECT seq, device, supply, {round_to('CASE WHEN rate > 0 THEN pct / rate END', 1)} "
                            "AS days_left FROM rd_u)") + f"SELECT *, {_alert5('days_left')} AS alerta FROM ab",
        "alert_band2": _with(*_READ_STEPS,
                             f"ab AS (SELECT seq, device, supply, {round_to('CASE WHEN rate > 0 THEN pct / rate END', 1)} "
                             "AS days_left FROM rd_u)") + f"SELECT *, {_alert2('days_left')} AS alerta FROM ab",
        "project_date": _with(*_READ_STEPS, "pd AS (SELECT *, CASE WHEN rate > 0 THEN pct / rate END AS d FROM rd_u)") + (
            f"SELECT seq, device, supply, {round_to('d', 1)} AS days_left, "
            f"{add_days('ts', 'd')} AS fecha_fin FROM pd"),
        "forecast_ema": _forecast_ema_sql(False),
        "forecast_ema_alerts": _forecast_ema_sql(True),
        "forecast_incremental": _forecast_ema_sql(True),
        "forecast_blocked": _forecast_ema_sql(True),
        "forecast_ties": _forecast_ema_sql(False, dedupe=False),
        "forecast_report": "SELECT " + ", ".join(f'{c} AS "{n}"' for n, c in K.FORECAST_COLUMNS.items())
                           + f" FROM ({_forecast_ema_sql(True)})",
        "merge_fanout": _with(*_merge_ctes()) + (
            "SELECT i.*, p.toner_negro AS toner_negro_new, p.ui_negro AS ui_negro_new, p.estado AS estado_new, "
            "p.marca_de_tiempo AS marca_de_tiempo_new FROM inv_n i LEFT JOIN poll_s_poll_d p "
            "ON i.device_class = p.device_class AND i.ip = p.ip"),
        "poll_no_key": _with(
            "inv_blank AS (SELECT * REPLACE (CASE WHEN device_id % 29 = 5 THEN 'n/a' ELSE ip END AS ip) FROM inventory_raw)",
            *_poll_ctes(inv="inv_blank")) + "SELECT device_class, ip, seq, toner_negro, ui_negro, estado, marca_de_tiempo FROM poll_s_poll_d",
        "refresh_levels": _refresh_levels_sql(),
        "refresh_one_class": _with(*_refresh_ctes()) + (
            f"SELECT {_INV_COLS} FROM refreshed WHERE device_class = 'HP Admin' UNION ALL "
            f"SELECT {_INV_COLS} FROM inventory_raw WHERE device_class <> 'HP Admin'"),
        "forecast_linear": _forecast_linear_sql(False),
        "forecast_linear_alerts": _forecast_linear_sql(True),
        "stream_dedupe": _with() + (
            f"SELECT DISTINCT ip, marca_de_tiempo, {parse_ts('marca_de_tiempo')} AS fecha FROM history_raw "
            f"WHERE {strip('estado')} = 'OK'"),
        "stream_refresh": _with(*_refresh_ctes()) + "SELECT * FROM refreshed",
        "stream_dedupe_ordered": _with(*_clean_ctes()) + "SELECT * FROM clean",
        "stream_latest": _with(
            """sl AS (SELECT *, row_number() OVER (PARTITION BY device, supply ORDER BY ts DESC NULLS LAST, seq DESC) AS r,
                  max(ts) OVER (PARTITION BY device, supply) AS last_ts,
                  count(*) OVER (PARTITION BY device, supply) AS n FROM readings_long)"""
        ) + ("SELECT device, supply, last_ts, pct, n, CASE WHEN round_even(pct, 0) = 0 THEN 'critical' "
             f"WHEN round_even(pct, 0) < {float(K.SEVERITY_LOW_BELOW)!r} THEN 'low' END AS severity "
             "FROM sl WHERE r = 1"),
    }
    return sql
