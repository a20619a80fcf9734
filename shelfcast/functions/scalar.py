"""Column expressions shared by the operators.

All are built-in Spark expressions (no Python UDF), so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stockout classes, their boundaries and recommended actions.
RISK_LOW_BELOW = 0.60
RISK_MEDIUM_UP_TO = 0.90
RISK_HIGH_UP_TO = 1.10
RISK_ACTIONS = {
    "Low": "Maintain current replenishment plan.",
    "Medium": "Monitor sell-through and review upcoming replenishment timing.",
    "High": "Prioritize replenishment review and consider shifting inventory from lower-risk locations.",
    "Critical": "Escalate immediately, expedite replenishment, and evaluate demand substitution options.",
}
RISK_ORDER = ("Critical", "High", "Medium", "Low")
EXECUTIVE_RISK_THRESHOLD = 0.90

# Anomaly labels.
SEVERITY_HIGH_AT = 3.0
DEFAULT_ANOMALY_THRESHOLD = 2.0
DIRECTION_SPIKE = "Sales spike"
DIRECTION_DROP = "Sales drop"

# Prediction interval factors.
INTERVAL_LOWER = 0.85
INTERVAL_UPPER = 1.15

# Money is summed as exact decimals: totals do not depend on partitioning
# or summation order, so every run and every cluster size gives one answer.
MONEY = "decimal(18,4)"

INF = float("inf")


def c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def stockout_score(predicted: str | Column, inventory: str | Column) -> Column:
    """inf when inventory <= 0, else predicted / inventory; NULL inventory -> NULL."""
    inv = c(inventory)
    return F.when(inv <= 0, F.lit(INF)).otherwise(F.try_divide(c(predicted).cast("double"), inv.cast("double")))


def risk_category(score: str | Column) -> Column:
    """Low / Medium / High / Critical; NULL, NaN and inf are Critical."""
    s = c(score)
    not_finite = s.isNull() | F.isnan(s) | (F.abs(s) == F.lit(INF))
    return (
        F.when(not_finite, "Critical")
        .when(s < RISK_LOW_BELOW, "Low")
        .when(s <= RISK_MEDIUM_UP_TO, "Medium")
        .when(s <= RISK_HIGH_UP_TO, "High")
        .otherwise("Critical")
    )


def recommended_action(category: str | Column) -> Column:
    """Sentence per risk class."""
    cat = c(category)
    expr = None
    for name, text in RISK_ACTIONS.items():
        expr = F.when(cat == name, text) if expr is None else expr.when(cat == name, text)
    return expr


def risk_rank(category: str | Column) -> Column:
    """Critical 1, High 2, Medium 3, anything else 4."""
    cat = c(category)
    return F.when(cat == "Critical", 1).when(cat == "High", 2).when(cat == "Medium", 3).otherwise(4)


def severity(z: str | Column, threshold: float = DEFAULT_ANOMALY_THRESHOLD) -> Column:
    """High from |z| >= 3, Medium from |z| >= threshold, else Low; NULL z -> Low."""
    a = F.abs(c(z))
    return F.when(a >= SEVERITY_HIGH_AT, "High").when(a >= threshold, "Medium").otherwise("Low")


def direction(z: str | Column) -> Column:
    """Spike when z > 0, otherwise drop (0 and NULL are drops)."""
    return F.when(c(z) > 0, DIRECTION_SPIKE).otherwise(DIRECTION_DROP)


def interval_lower(predicted: str | Column, scale: int | None = None) -> Column:
    v = F.greatest(c(predicted) * INTERVAL_LOWER, F.lit(0.0))
    return F.round(v, scale) if scale is not None else v


def interval_upper(predicted: str | Column, scale: int | None = None) -> Column:
    v = c(predicted) * INTERVAL_UPPER
    return F.round(v, scale) if scale is not None else v


def money(col: str | Column) -> Column:
    return c(col).cast(MONEY)


def money_sum(col: str | Column) -> Column:
    """Exact, order-independent sum of a money column, returned as double."""
    return F.sum(money(col)).cast("double")


def money_avg(col: str | Column) -> Column:
    """Exact sum over the non-NULL count (same value as avg, order-independent)."""
    return F.try_divide(money_sum(col), F.count(c(col)).cast("double"))


def money_stddev_pop(col: str | Column) -> Column:
    """Population standard deviation of a money column from exact moments.

    Values are taken at the money scale (4 places) as integers, their count,
    sum and sum of squares are summed exactly: one partial aggregate per
    partition, and the same result on any partitioning.  With the whole
    quotient q and remainder r of sum and count, the squares around q are
    ``sum(x^2) - 2 q sum(x) + n q^2`` and those around the mean ``r^2 / n``
    less, so no total is squared and only the last division is in doubles.
    """
    x = F.round(c(col) * F.lit(10000.0)).cast("bigint").cast("decimal(38,0)")
    n = F.nullif(F.count(c(col)), F.lit(0)).cast("decimal(38,0)")
    total = F.sum(x)
    q = F.call_function("div", total, n).cast("decimal(38,0)")
    r = total - q * n
    around = F.sum(x * x) - q * total - q * r  # n * q^2 = q * (total - r)
    size = n.cast("double")
    spread = around.cast("double") - (r * r).cast("double") / size
    return F.sqrt(F.greatest(spread, F.lit(0.0)) / size) / F.lit(10000.0)


def score_avg(col: str | Column) -> Column:
    """Mean of rounded scores that may hold +inf: inf if any, else the exact mean."""
    x = c(col)
    finite = F.when(x != F.lit(INF), x)
    return F.when(F.max(x) == F.lit(INF), F.lit(INF)).otherwise(money_avg(finite))


def wape(actual: str | Column, predicted: str | Column) -> Column:
    """sum|a - p| / nullif(sum|a|, 0): NULL on a zero denominator (SQL path)."""
    a, p = money(actual), money(predicted)
    num = F.sum(F.abs(a - p)).cast("double")
    den = F.sum(F.abs(a)).cast("double")
    return F.try_divide(num, F.nullif(den, F.lit(0.0)))


def sku(store: str | Column, dept: str | Column) -> Column:
    """SKU-<store>-<dept>."""
    return F.concat(F.lit("SKU-"), c(store).cast("string"), F.lit("-"), c(dept).cast("string"))


def calendar_columns(date: str | Column) -> dict[str, Column]:
    """year, month, ISO week, day of year."""
    d = c(date)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "week_of_year": F.weekofyear(d),
        "day_of_year": F.dayofyear(d),
    }


def day_of_week_sunday0(date: str | Column) -> Column:
    """Day of week with Sunday = 0 (warehouse default); Spark's Sunday is 1."""
    return F.dayofweek(c(date)) - 1


def no_negative_zero(col: Column) -> Column:
    return col + F.lit(0.0)


DISPLAY_ZONE = "America/New_York"  # fixed value: display time zone


def local_time_text(ts: str | Column, missing: str = "Not available") -> Column:
    """UTC wall time shown in New York time, e.g. 'Jan 05, 2024 07:00 PM EST' (B32)."""
    t = c(ts)
    local = F.from_utc_timestamp(t.cast("timestamp"), DISPLAY_ZONE)
    offset_h = (F.unix_timestamp(local) - F.unix_timestamp(t.cast("timestamp"))) / 3600
    zone = F.when(offset_h == -4, F.lit("EDT")).otherwise(F.lit("EST"))
    return F.coalesce(F.concat(F.date_format(local, "MMM dd, yyyy hh:mm a"), F.lit(" "), zone), F.lit(missing))
