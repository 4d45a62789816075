"""Column -> Column helpers built only from Spark built-in functions."""

from supplyscope.functions.scalars import (  # noqa: F401
    clean_pct,
    clean_pct_float,
    format_ip,
    fraction_to_pct,
    ip_to_url,
    normalize_ip,
    parse_number,
    parse_ts,
    pct_to_double,
    round_to,
    strip_ws,
)
from supplyscope.functions.bands import (  # noqa: F401
    alert_band,
    alert_band2,
    classify_status,
    level_severity,
    severity,
)
