"""Money and ratio expressions.

Numeric policy: amounts are summed as decimals so that totals do not depend on
the order in which partitions are combined; results are cast to double at the
very end.  Ratios use ``try_divide`` so a zero denominator gives NULL (plain
division raises under ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Decimal used to sum amounts that arrive as doubles: 16 digits before the point (more
# than bronze lets in) and 10 after it, so that small conversions count too.
SUM_DECIMAL = "decimal(26,10)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(df: DataFrame, name: str) -> Column:
    """The column as a decimal that sums exactly (doubles -> SUM_DECIMAL)."""
    if isinstance(df.schema[name].dataType, DecimalType):
        return F.col(name)
    return F.col(name).try_cast(SUM_DECIMAL)


def exact_sum(df: DataFrame, name: str) -> Column:
    return F.sum(exact(df, name))


def round_money(c, digits: int = 2) -> Column:
    """Round (half away from zero) and return a double."""
    return F.round(_col(c), digits).cast("double")


def ratio(num, den) -> Column:
    """num / NULLIF(den, 0) in double precision."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def round_half_up(c, digits: int = 2) -> Column:
    """floor(x * 10^d + 0.5) / 10^d on a double.

    For values that come out of a division (averages, forecasts) a binary
    double can sit exactly on a decimal tie; ``round`` then depends on how an
    engine converts the double to decimal.  These three IEEE operations give
    the same answer on every engine."""
    scale = float(10 ** digits)
    return (F.floor(_col(c) * scale + 0.5) / scale).cast("double")


def round_ratio(num, den, digits: int = 2) -> Column:
    return F.round(ratio(num, den), digits)


def fx_amount(amount, rate) -> Column:
    """ROUND(amount * COALESCE(rate, 1.0), 2) as a double.

    Computed in decimal: amount (up to 8 decimals) x rate (up to 6 decimals) is
    exact, so the half-cent rounding is exact too and does not depend on how a
    binary double happens to represent the product."""
    r = F.coalesce(_col(rate).cast("decimal(12,6)"), F.lit(1).cast("decimal(12,6)"))
    return F.round(_col(amount).try_cast("decimal(22,8)") * r, 2).cast("double")


def micros_to_dollars(c) -> Column:
    """ROUND(micros / 1e6, 2) as a double, exact (decimal) arithmetic."""
    return F.round(_col(c).cast("decimal(20,0)") * F.lit(0.000001).cast("decimal(7,6)"),
                   2).cast("double")


def currency_note(currency, missing) -> Column:
    cur = _col(currency)
    return (F.when(_col(missing) == 1, F.lit("Assumed USD (missing in source)"))
            .when(cur == "USD", F.lit("USD (native)"))
            .otherwise(F.concat(F.lit("Converted from "), cur)))


def growth_pct(current, previous, digits: int = 2) -> Column:
    """Percent change; NULL when there is no previous value or it is 0."""
    prev = _col(previous)
    return F.when(prev.isNull() | (prev == 0), F.lit(None).cast("double")).otherwise(
        F.round((_col(current) - prev) / prev * 100, digits))


def budget_status(spend, budget, with_missing: str | None = None) -> Column:
    """'OVER BUDGET' / 'WITHIN BUDGET' (and an optional label for NULL budget)."""
    s, b = _col(spend), _col(budget)
    expr = F.when(s > b, F.lit("OVER BUDGET"))
    if with_missing is not None:
        expr = F.when(b.isNull(), F.lit(with_missing)).when(s > b, F.lit("OVER BUDGET"))
    return expr.otherwise(F.lit("WITHIN BUDGET"))
