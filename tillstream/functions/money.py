"""Money arithmetic on doubles."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec, functions as F

VAT_RATE = 0.14  # fixed value: the configured rate of the data


def round_half_away(amount: Column, digits: int = 2) -> Column:
    """Round half away from zero on the double itself (``F.round`` goes through a decimal string)."""
    scale = float(10 ** digits)
    return F.signum(amount) * F.floor(F.abs(amount) * scale + 0.5) / scale


def exact_sum(amount: Column, over: WindowSpec | None = None) -> Column:
    """Sum of amounts, exact to six decimals, that does not depend on the order of the rows.

    Whole units and millionths are summed as integers, which is much cheaper than a decimal per row
    and leaves room for some 10^12 rows in one group.
    """
    def total(part: Column) -> Column:
        summed = F.sum(part)
        return (summed if over is None else summed.over(over)).cast("decimal(20,0)")

    whole = F.floor(amount)
    millionths = F.floor((amount - whole) * 1e6 + 0.5)
    return (total(whole) * 1000000 + total(millionths)).cast("double") / 1e6


def vat_part(total: Column, rate: float = VAT_RATE) -> Column:
    """``total / (1 + rate)``, unrounded. The stored samples and the producer label this part as VAT."""
    return total / (1 + rate)


def basket_amounts(gross: Column, rate: float = VAT_RATE) -> dict[str, Column]:
    """Total, VAT and nett of a basket from its unrounded sum; each is rounded once."""
    vat = vat_part(gross, rate)
    return {"total": round_half_away(gross), "vat": round_half_away(vat), "nett": round_half_away(gross - vat)}
