"""Three-factor curve loadings, prediction and bond pricing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def loadings(tau: Column, lam: Column) -> tuple[Column, Column]:
    """Slope and curvature loadings at ``tau`` years for decay ``lam``."""
    x = tau / lam
    decay = F.exp(-x)
    slope = F.when(x <= 1e-8, F.lit(1.0)).otherwise((1 - decay) / x)
    return slope, slope - decay


def predict(tau: Column, lam: Column, b0: Column, b1: Column, b2: Column) -> Column:
    """Fitted yield in percent."""
    slope, hump = loadings(tau, lam)
    return b0 + b1 * slope + b2 * hump


def price_and_duration(yield_pct: Column, coupon_pct: Column, tau: Column) -> tuple[Column, Column]:
    """Price per 100 and modified duration; half-yearly flows are dated back from maturity.

    Both are null at yields of -200 percent and less, where nothing can be discounted, and
    where the price is no positive finite number.
    """
    count = F.greatest(F.ceil(2 * tau - 1e-9), F.lit(1)).cast("int")
    times = F.filter(F.transform(F.sequence(F.lit(0), count - 1), lambda k: tau - k / 2), lambda t: t > 1e-9)
    base = F.when(yield_pct > -200, 1 + yield_pct / 200)
    value = lambda t: (coupon_pct / 2 + F.when(t >= tau - 1e-9, 100.0).otherwise(0.0)) / F.pow(base, 2 * t)
    price = F.aggregate(times, F.lit(0.0), lambda s, t: s + value(t))
    moment = F.aggregate(times, F.lit(0.0), lambda s, t: s + value(t) * t)
    good = (price > 0) & (price < float("inf")) & (moment < float("inf"))
    return F.when(good, price), F.when(good, moment / price / base)
