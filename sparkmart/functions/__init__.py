"""Column -> Column scalar expressions. All are built-in Spark expressions
(JVM-side, whole-stage codegen); none is a Python UDF."""

from sparkmart.functions.dates import (  # noqa: F401
    calendar_columns, date_key, day_name, day_of_week, half_year, hour_bucket,
    is_weekend, minutes_between, month_name, season, season_order,
    standardize_date, year_month,
)
from sparkmart.functions.numeric import (  # noqa: F401
    deviation_pct, growth_pct, money, parse_int, parse_long, parse_price, round2,
    safe_divide, spike_label, volatility_pct, zscore,
)
