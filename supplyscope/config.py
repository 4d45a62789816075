"""Parameters and fixed values.

The strings below are *data*: they appear verbatim in output tables
(status, method and alert labels, supply names), so they must equal the
values the original fleet scripts produce.  They are kept together here in
their natural order and are never rebuilt elsewhere.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Fixed values (must match the original tool's output labels verbatim)
# --------------------------------------------------------------------------

# Supplies, in report order: display name -> internal column name.
SUPPLY_COLUMNS: dict[str, str] = {
    "Toner Negro": "toner_negro",
    "Toner Cian": "toner_cian",
    "Toner Magenta": "toner_magenta",
    "Toner Amarillo": "toner_amarillo",
    "Kit Mant.": "kit_mant",
    "Kit Alim.": "kit_alim",
}

# Imaging-unit levels of the generation-11 colour sheet (never logged).
IMAGING_COLUMNS: dict[str, str] = {
    "UI Negro": "ui_negro",
    "UI Cian": "ui_cian",
    "UI Magenta": "ui_magenta",
    "UI Amarillo": "ui_amarillo",
}

# Level columns of that sheet, in sheet order (toner and imaging unit per colour).
COLOR11_LEVELS: tuple[str, ...] = ("toner_negro", "ui_negro", "toner_cian", "ui_cian",
                                   "toner_magenta", "ui_magenta", "toner_amarillo", "ui_amarillo")

# Columns of the history log, in log order: display name -> internal name.
HISTORY_COLUMNS: dict[str, str] = {
    "Nombre": "nombre",
    "IP": "ip",
    "Modelo": "modelo",
    **SUPPLY_COLUMNS,
    "Estado": "estado",
    "Marca de Tiempo": "marca_de_tiempo",
}

# Columns of the forecast table: display name -> internal name.
FORECAST_COLUMNS: dict[str, str] = {
    "Nombre": "nombre",
    "IP": "ip",
    "Modelo": "modelo",
    "Consumible": "consumible",
    "Porcentaje actual": "porcentaje_actual",
    "Consumo diario (%)": "consumo_diario",
    "Días restantes estimados": "dias_restantes",
    "Fecha estimada de agotamiento": "fecha_agotamiento",
    "Método": "metodo",
    "Alerta": "alerta",
}

# Poll status labels (note the two spellings of "not available").
STATUS_OK = "OK"
STATUS_NOT_AVAILABLE_RULE = "No disponible"   # page loaded, class rule failed
STATUS_NOT_AVAILABLE = "No Disponible"        # element missing / timeout
STATUS_OFFLINE = "Fuera de Red"               # driver / network error
STATUS_ERROR = "Error"                        # gen 5-7 element missing
STATUS_NO_FRAME = "No se encontraron los elementos en el iframe."   # gen 4 element missing
STATUS_PRINTER_OFFLINE = "Impresora Fuera de Red"                   # gen 4-5
STATUS_NO_KEY = ""                            # device without a usable key

# EMA forecast method labels.
METHOD_TOO_FEW = "❌ Muy pocos datos"
METHOD_EMA = "⭐ EMA (span={span})"
METHOD_FALLBACK = "📈 Regresión Lineal (Fallback)"
METHOD_INVALID_SLOPE = "❌ Pendiente inválida"
SUFFIX_UNRELIABLE = " - Proyección no confiable"

# Linear forecast method labels.
METHOD_LINEAR = "📈 Regresión lineal"
METHOD_SIMPLE = "⚙️ Promedio simple"

# Five-level alert band (EMA forecast).
ALERT_INSUFFICIENT = "❓ Datos insuficientes"
ALERT_URGENT = "🚨 REEMPLAZAR URGENTE"
ALERT_SOON = "⚠️ Reemplazar pronto"
ALERT_LOW_STOCK = "🔔 Bajo stock (2 semanas)"
ALERT_OK = "🟢 OK"

# Two-level alert band (linear forecast).
ALERT2_SOON = "⚠️ Reemplazar pronto"
ALERT2_OK = "OK"

# Severity bands of a percent cell (re-aimed cell colours: red / orange).
SEVERITY_CRITICAL = "critical"
SEVERITY_LOW = "low"

# Gauge position -> supply, per device class (page gauge 0, 1, 2, ...).
GAUGE_MAP: dict[str, tuple[str, ...]] = {
    "HP Admin": ("Toner Negro", "Kit Mant.", "Kit Alim."),
    "HP Planta": ("Toner Negro",),
    "Color Admin": ("Toner Negro", "Toner Cian", "Toner Magenta", "Toner Amarillo"),
    "HP Planta - 2": ("Toner Negro", "Kit Alim."),
    "Color Planta": ("Toner Amarillo", "Toner Magenta", "Toner Cian", "Toner Negro", "Kit Alim."),
    "Impresora CLX-6260": ("Toner Negro", "Toner Cian", "Toner Magenta", "Toner Amarillo"),
    "Impresoras Normales": ("Toner Negro", "UI Negro"),
    "Impresoras a Color": ("Toner Negro", "UI Negro", "Toner Cian", "UI Cian",
                           "Toner Magenta", "UI Magenta", "Toner Amarillo", "UI Amarillo"),
}

# Element pattern of each class's pages (see sources/pages.py).
GAUGE_PATTERN: dict[str, str] = {
    "HP Admin": "supply_gauge",
    "HP Planta": "supply_gauge",
    "Color Admin": "supply_gauge",
    "HP Planta - 2": "supply_gauge",
    "Color Planta": "supply_gauge",
    "Impresora CLX-6260": "grid",
    "Impresoras Normales": "toner_list",
    "Impresoras a Color": "row_id",
}

# Status rule per class: OK when any of these supplies has a non-empty gauge.
# A class without an entry is OK as soon as its page was read.
OK_RULE: dict[str, tuple[str, ...]] = {
    "HP Admin": ("Toner Negro", "Kit Mant.", "Kit Alim."),
    "HP Planta": ("Toner Negro",),
    "Color Admin": ("Toner Negro",),
    "HP Planta - 2": ("Toner Negro", "Kit Alim."),
    "Color Planta": ("Toner Amarillo",),
    "Impresora CLX-6260": ("Toner Negro", "Toner Cian", "Toner Magenta", "Toner Amarillo"),
}

# Failed clean-percentage value per class: mono classes blank, colour "0%".
CLEAN_FAILURE: dict[str, str] = {
    "HP Admin": "",
    "HP Planta": "",
    "Color Admin": "0%",
    "HP Planta - 2": "",
    "Color Planta": "0%",
    "Impresora CLX-6260": "",
}

# --------------------------------------------------------------------------
# Tunable parameters (defaults equal the original tool's settings)
# --------------------------------------------------------------------------

EMA_SPAN = 10
ALERT_CRITICAL_DAYS = 3
ALERT_MEDIUM_DAYS = 7
ALERT_LOW_STOCK_DAYS = 15
MAX_FORECAST_DAYS = 365 * 2
SEVERITY_LOW_BELOW = 11          # gen 11 used 5
LINEAR_ALERT_DAYS = 3
VALID_STATUS = STATUS_OK

# Skew handling of ordered series: a series with more rows than this is
# "hot" and is split into range blocks instead of sitting in one task.
SERIES_BLOCK_ROWS_CONF = "supplyscope.series.blockRows"
SERIES_BLOCK_ROWS_DEFAULT = 2_000_000
SERIES_SKEW_MODE_CONF = "supplyscope.series.skewMode"   # auto | off | force


def supply_names() -> list[str]:
    return list(SUPPLY_COLUMNS)


def supply_cols() -> list[str]:
    return list(SUPPLY_COLUMNS.values())


def col_of(display: str) -> str:
    return SUPPLY_COLUMNS[display]
