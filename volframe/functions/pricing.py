"""Pricing as Column expressions: normal law, Black-Scholes and Black-76, Greeks, SVI and SABR. All stay in code generation."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR = 365.0
_A = 1 / math.sqrt(2 * math.pi)


def npdf(x: Column) -> Column:
    return F.lit(_A) * F.exp(-x * x / 2)


#: fixed values: rational approximation of the normal tail by W. J. Cody's scheme as given by G. West (2005)
NUM = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
DEN = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)


def _horner(x: Column, c: tuple[float, ...]) -> Column:
    out = F.lit(c[0])
    for k in c[1:]:
        out = out * x + F.lit(k)
    return out


def ncdf(x: Column) -> Column:
    """Normal distribution function, to about 1e-15."""
    z = F.abs(x)
    near = F.exp(-z * z / 2) * _horner(z, NUM) / _horner(z, DEN)
    far = npdf(z) / (z + 1 / (z + 2 / (z + 3 / (z + 4 / (z + F.lit(0.65))))))
    tail = F.when(z > 37, F.lit(0.0)).when(z < 7.07106781186547, near).otherwise(far)
    return F.when(x > 0, 1 - tail).otherwise(tail)


def d1(forward: Column, strike: Column, t: Column, sigma: Column) -> Column:
    return (F.log(forward / strike) + sigma * sigma * t / 2) / (sigma * F.sqrt(t))


def black76(forward: Column, strike: Column, t: Column, sigma: Column, discount: Column, is_call: Column) -> Column:
    """Price on the forward; without time or volatility, the discounted intrinsic value."""
    one = d1(forward, strike, t, sigma)
    two = one - sigma * F.sqrt(t)
    sign = F.when(is_call, F.lit(1.0)).otherwise(-1.0)
    price = discount * sign * (forward * ncdf(sign * one) - strike * ncdf(sign * two))
    return F.when((t > 0) & (sigma > 0), price).otherwise(discount * F.greatest(sign * (forward - strike), F.lit(0.0)))


def black_vega(forward: Column, strike: Column, t: Column, sigma: Column, discount: Column) -> Column:
    return discount * forward * npdf(d1(forward, strike, t, sigma)) * F.sqrt(t)


def bs_price(spot: Column, strike: Column, t: Column, r: Column, sigma: Column, is_call: Column) -> Column:
    """Spot price form; expired or without volatility, the undiscounted intrinsic value."""
    sign = F.when(is_call, F.lit(1.0)).otherwise(-1.0)
    live = black76(spot * F.exp(r * t), strike, t, sigma, F.exp(-r * t), is_call)
    return F.when((t <= 0) | (sigma <= 0), F.greatest(sign * (spot - strike), F.lit(0.0))).otherwise(live)


def with_black76(rows: DataFrame, name: str, forward: str, strike: str, t: str, sigma: str, discount: str, is_call: Column) -> DataFrame:
    """rows with the price of black76 as a column. What it is made of is staged in columns, so that nothing is computed twice."""
    f, k, d = F.col(forward), F.col(strike), F.col(discount)
    live = (F.col(t) > 0) & (F.col(sigma) > 0)
    p = rows.withColumn("_sign", F.when(is_call, F.lit(1.0)).otherwise(-1.0)).withColumn("_d1", F.when(live, d1(f, k, F.col(t), F.col(sigma))))
    p = p.withColumn("_d2", F.col("_sign") * (F.col("_d1") - F.col(sigma) * F.sqrt(t))).withColumn("_d1", F.col("_sign") * F.col("_d1"))
    p = p.withColumns({"_n1": ncdf(F.col("_d1")), "_n2": ncdf(F.col("_d2"))})
    price = F.when(live, d * F.col("_sign") * (f * F.col("_n1") - k * F.col("_n2"))).otherwise(d * F.greatest(F.col("_sign") * (f - k), F.lit(0.0)))
    return p.withColumn(name, price).drop("_sign", "_d1", "_d2", "_n1", "_n2")


def with_greeks(rows: DataFrame, spot: str, strike: str, t: str, r: str, sigma: str, is_call: Column) -> DataFrame:
    """rows with price, delta, gamma, vega (per 1.00), theta (per calendar day of 365.25), rho, vanna and volga.

    An expired option, or one without volatility, has its undiscounted intrinsic value, a delta of 0 or 1 (a put's is 0)
    and no other Greeks. A null among the inputs gives nulls.
    """
    s, k, y, v = F.col(spot), F.col(strike), F.col(t), F.col(sigma)
    live = (y > 0) & (v > 0)
    p = rows.withColumn("_sign", F.when(is_call, F.lit(1.0)).otherwise(-1.0)).withColumn("_root", F.sqrt(y)).withColumn("_disc", F.exp(-F.col(r) * y))
    p = p.withColumn("_d1", F.when(live, (F.log(s / k) + (F.col(r) + v * v / 2) * y) / (v * F.col("_root")))).withColumn("_d2", F.col("_d1") - v * F.col("_root"))
    p = p.withColumns({"_z1": F.col("_sign") * F.col("_d1"), "_z2": F.col("_sign") * F.col("_d2"), "_pdf": npdf(F.col("_d1"))})
    p = p.withColumns({"_n1": ncdf(F.col("_z1")), "_n2": ncdf(F.col("_z2")), "_vega": s * F.col("_pdf") * F.col("_root")})
    sign, root, disc, pdf, n1, n2, one, two = (F.col(c) for c in ("_sign", "_root", "_disc", "_pdf", "_n1", "_n2", "_d1", "_d2"))
    known = s.isNotNull() & k.isNotNull() & y.isNotNull() & v.isNotNull() & F.col(r).isNotNull()
    zero = F.when(known, F.lit(0.0))
    live_or = lambda x: F.when(live, x).otherwise(zero)
    out = {
        "price": F.when(live, sign * (s * n1 - k * disc * n2)).otherwise(F.when(known, F.greatest(sign * (s - k), F.lit(0.0)))),
        "delta": F.when(live, sign * n1).otherwise(F.when(known, F.when(is_call & (s > k), 1.0).otherwise(0.0))),
        "gamma": live_or(pdf / (s * v * root)), "vega": live_or(F.col("_vega")), "theta": live_or((-s * pdf * v / (2 * root) - sign * F.col(r) * k * disc * n2) / 365.25),
        "rho": live_or(sign * k * y * disc * n2), "vanna": live_or(-pdf * two / v), "volga": live_or(F.col("_vega") * one * two / v),
    }
    return p.withColumns(out).drop("_sign", "_root", "_disc", "_d1", "_d2", "_z1", "_z2", "_pdf", "_n1", "_n2", "_vega")


def svi(k: Column, a: Column, b: Column, rho: Column, m: Column, sigma: Column) -> Column:
    """Raw SVI total variance."""
    return a + b * (rho * (k - m) + F.sqrt((k - m) * (k - m) + sigma * sigma))


def svi_natural(k: Column, delta: Column, mu: Column, rho: Column, omega: Column, zeta: Column) -> Column:
    x = zeta * (k - mu)
    return delta + omega / 2 * (1 + rho * x + F.sqrt((x + rho) * (x + rho) + 1 - rho * rho))


def svi_slope(k: Column, b: Column, rho: Column, m: Column, sigma: Column) -> Column:
    return b * (rho + (k - m) / F.sqrt((k - m) * (k - m) + sigma * sigma))


def svi_extrapolated(k: Column, a: Column, b: Column, rho: Column, m: Column, sigma: Column, k_min: Column, k_max: Column) -> Column:
    """Beyond the quoted strikes the tangent goes on; its slope may not fall outwards."""
    edge = F.least(F.greatest(k, k_min), k_max)
    slope = svi_slope(edge, b, rho, m, sigma)
    slope = F.when(k < k_min, F.least(slope, F.lit(0.0))).when(k > k_max, F.greatest(slope, F.lit(0.0))).otherwise(0.0)
    return svi(edge, a, b, rho, m, sigma) + slope * (k - edge)


def sabr(forward: Column, strike: Column, t: Column, alpha: Column, beta: float, rho: Column, nu: Column, eps: float = 1e-7) -> Column:
    """Hagan's lognormal volatility (2002)."""
    c = 1 - beta
    mid, log_ = F.pow(forward * strike, F.lit(c / 2)), F.log(forward / strike)
    drift = 1 + t * (c * c / 24 * alpha * alpha / (mid * mid) + rho * beta * nu * alpha / (4 * mid) + (2 - 3 * rho * rho) / 24 * nu * nu)
    z = nu / alpha * mid * log_
    x = F.log((F.sqrt(1 - 2 * rho * z + z * z) + z - rho) / (1 - rho))
    wings = alpha / (mid * (1 + c * c / 24 * log_ * log_ + c**4 / 1920 * log_ * log_ * log_ * log_)) * F.when(F.abs(z) < eps, F.lit(1.0)).otherwise(z / x) * drift
    at = F.pow(forward, F.lit(c))
    money = alpha / at * (1 + t * (c * c / 24 * alpha * alpha / (at * at) + rho * beta * nu * alpha / (4 * at) + (2 - 3 * rho * rho) / 24 * nu * nu))
    return F.when((forward > 0) & (strike > 0) & (t > 0) & (alpha > 0), F.when(F.abs(forward - strike) < eps, money).otherwise(wings))


def qlike(actual: Column, forecast: Column) -> Column:
    r = F.try_divide(actual, forecast)
    return F.when((actual > 0) & (forecast > 0), r - F.log(r) - 1)


def interpolate(x: Column, points: Column) -> Column:
    """Linear in points (array of struct x, y sorted by x), flat beyond both ends; null without points."""
    pts = F.filter(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    below, above = F.filter(pts, lambda p: p["x"] <= x), F.filter(pts, lambda p: p["x"] > x)
    lo, hi = F.get(below, F.size(below) - 1), F.get(above, F.lit(0))
    return F.when(F.size(below) == 0, hi["y"]).when(F.size(above) == 0, lo["y"]).otherwise(lo["y"] + (hi["y"] - lo["y"]) * (x - lo["x"]) / (hi["x"] - lo["x"]))


def occ_symbol(symbol: Column) -> dict[str, Column]:
    """Option symbol parsed from the right: expiration yymmdd, C or P, strike in thousandths; the rest is the root."""
    s = F.trim(symbol)
    side = F.substring(s, -9, 1)
    return {
        "root": F.when(F.length(s) > 15, F.trim(F.substring(s, F.lit(1), F.length(s) - 15))),
        "expiration": F.try_to_timestamp(F.substring(s, -15, 6), F.lit("yyMMdd")).cast("date"),
        "option_type": F.when(side == "C", "call").when(side == "P", "put"),
        "strike": F.substring(s, -8, 8).try_cast("double") / 1000,
    }


def normal_cdf(x: np.ndarray) -> np.ndarray:
    """Normal distribution function on arrays, by the rational form of ncdf."""
    z = np.abs(x)
    with np.errstate(all="ignore"):
        near = np.exp(-z * z / 2) * np.polyval(NUM, z) / np.polyval(DEN, z)
        far = np.exp(-z * z / 2) / np.sqrt(2 * np.pi) / (z + 1 / (z + 2 / (z + 3 / (z + 4 / (z + 0.65)))))
    tail = np.where(z > 37, 0.0, np.where(z < 7.07106781186547, near, far))
    return np.where(x > 0, 1 - tail, tail)
