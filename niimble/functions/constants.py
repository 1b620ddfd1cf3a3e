"""Fixed values of the forecast. Changing one changes the results."""

# --- fixed values -----------------------------------------------------------
# Drivers: factor per currency and base yield per product, with the value for all others.
CURRENCY_MIX = {"USD": 1.0}
CURRENCY_MIX_OTHER = 0.95
NET_EXPOSURE_FACTOR = 0.98
NET_RATE_FACTOR = 1.02
BASE_YIELD = {"Loan": 0.055}
BASE_YIELD_OTHER = 0.015

# Defaults where a lookup finds nothing.
MISSING_BASE_YIELD = 0.05
MISSING_FACTOR = 1.0
MISSING_LAG = 0.0
MISSING_BALANCE = 0.0

# Actuals, forecast, launchpoint, income.
PREALLOCATION_FACTOR = 1.0
MONTHS_PER_YEAR = 12
SUBSTITUTION_FACTOR = {"prior_actual": 0.95}
SUBSTITUTION_FACTOR_OTHER = 1.0
DAY_COUNT_BASIS = 360
DAY_COUNT_FRACTION = 1.0
INFLATION_LAGS = ("lag_0", "lag_1", "lag_2", "lag_3")
LAG_UNIT = 100
MIN_WEIGHT = 0.0
# --- end of fixed values ----------------------------------------------------
