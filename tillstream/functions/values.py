"""Numbers and times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts from here on are whole numbers far beyond a double's precision.
HUGE = 2.0**62
MICROS = 1_000_000
_LOW_BITS = 20


def money_parts(amount: Column | str) -> list[Column]:
    """The amount as summands that add up exactly, in every order and in any number.

    High and low bits of the whole units, and millionths (rounded half to even) as whole numbers; an amount of
    2^62 and above is the fourth part, a double. A sum of parts stays in range up to a total of 10^24.
    """
    amount = _col(amount)
    small = F.abs(amount) < HUGE
    units = F.when(small, amount.cast("bigint"))
    millionths = F.rint((amount - units.cast("double")) * MICROS).cast("bigint")
    return [
        F.shiftright(units, _LOW_BITS),
        units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("bigint")),
        millionths,
        F.when(~small, amount),
    ]


def money_total(high: Column, low: Column, millionths: Column, huge: Column) -> Column:
    """The amount that summed parts stand for; null if there was nothing to sum."""
    carry = F.floor(millionths / MICROS)
    rest = millionths - carry * MICROS
    # Up to 2^33 units the total in millionths is an exact double, so there is one rounding.
    units = F.shiftleft(high, _LOW_BITS) + low + carry
    exact = F.when(
        F.abs(high) < 1 << 12, (units * MICROS + rest).cast("double") / MICROS
    ).when(
        F.abs(high) < 1 << 42, units.cast("double") + rest.cast("double") / MICROS
    ).otherwise(high.cast("double") * (1 << _LOW_BITS) + (low + carry).cast("double"))
    return F.when(huge.isNull(), exact).otherwise(huge + F.coalesce(exact, F.lit(0.0)))


def money_sum(amount: Column | str, sums: Callable[[Column], Column] = F.sum) -> Column:
    """Sum of money; ``sums`` may add a window."""
    return money_total(*(sums(part) for part in money_parts(amount)))


def money_round(amount: Column | str) -> Column:
    return F.round(_col(amount), 2)


def elapsed_ms(later: Column, earlier: Column) -> Column:
    return F.unix_millis(later) - F.unix_millis(earlier)


def whole_minutes(ms: Column) -> Column:
    return F.floor(ms / 60000)


def remaining_seconds(ms: Column) -> Column:
    return F.floor(ms / 1000) % 60


def cut_to_millis(ts: Column | str) -> Column:
    return F.timestamp_millis(F.unix_millis(_col(ts)))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
