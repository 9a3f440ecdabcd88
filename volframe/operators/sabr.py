"""SABR fits: quotes are gathered into one row for each smile, and the smiles of a batch are fitted where they are."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of alpha, rho and nu.
LOW, HIGH = np.array([1e-4, -0.999, 1e-4]), np.array([5.0, 0.999, 5.0])
#: First guesses of rho and nu; alpha starts from the volatility nearest the money.
STARTS = ((-0.3, 0.5), (0.3, 0.5), (-0.6, 1.5), (0.0, 0.1))


def model(p: np.ndarray, f: float, k: np.ndarray, t: float, beta: float) -> np.ndarray:
    """Hagan's volatilities on arrays, as pricing.sabr has them for Columns."""
    alpha, rho, nu = p
    c, log_ = 1 - beta, np.log(f / k)
    mid = (f * k) ** (c / 2)
    z = nu / alpha * mid * log_
    with np.errstate(all="ignore"):
        ratio = np.where(np.abs(z) < 1e-7, 1 - rho * z / 2, z / np.log((np.sqrt(1 - 2 * rho * z + z * z) + z - rho) / (1 - rho)))
    drift = (c * alpha / mid) ** 2 / 24 + rho * beta * nu * alpha / (4 * mid) + (2 - 3 * rho * rho) * nu * nu / 24
    return alpha / mid / (1 + (c * log_) ** 2 / 24 + (c * log_) ** 4 / 1920) * ratio * (1 + t * drift)


def fit(f: float, k: np.ndarray, t: float, vol: np.ndarray, beta: float, rounds: int = 100) -> np.ndarray:
    """alpha, rho, nu and rmse of one smile: damped least squares within the bounds, the best of several starts."""
    best = np.full(4, np.nan)
    level = vol[np.argmin(np.abs(np.log(k / f)))] * f ** (1 - beta)
    for rho, nu in STARTS:
        p = np.clip([level, rho, nu], LOW, HIGH)
        miss, damp = model(p, f, k, t, beta) - vol, 1e-3
        for _ in range(rounds):
            steps = np.maximum(np.abs(p), 1e-2) * 1e-6
            slopes = np.stack([(model(p + d, f, k, t, beta) - model(p - d, f, k, t, beta)) / (2 * d.max()) for d in np.diag(steps)], axis=1)
            if not np.isfinite(slopes).all():
                break
            square = slopes.T @ slopes
            while damp < 1e12:
                new = np.clip(p - np.linalg.lstsq(square + damp * np.diag(np.diag(square) + 1e-12), slopes.T @ miss, rcond=None)[0], LOW, HIGH)
                left = model(new, f, k, t, beta) - vol
                if left @ left < miss @ miss:
                    break
                damp *= 4
            else:
                break
            done = miss @ miss - left @ left < 1e-20
            p, miss, damp = new, left, damp / 10
            if done:
                break
        error = np.sqrt(np.mean(miss * miss))
        if not error >= best[3]:
            best = np.array([*p, error])
        if error < 1e-10:  # exact; no start can do better
            break
    return best


def calibrate(quotes: DataFrame, by: Sequence[str], forward: str = "forward", strike: str = "strike", t: str = "T", vol: str = "iv", beta: float = 0.5) -> DataFrame:
    """quotes to one row per smile: by, beta, alpha, rho, nu, rmse and n, its quotes.

    A smile is one expiry of one snapshot, with as many quotes as it has strikes; it has one forward and one T (the largest
    if they differ). Quotes with a null or a value that isn't positive are left out; repeated ones count each time. With
    fewer than three quotes the parameters are null. Alpha grows with forward ** (1 - beta): above 5, pass moneyness.
    """
    used = [forward, strike, t, vol]
    good = quotes.where(" and ".join(f"`{c}` > 0 and not isnan(`{c}`)" for c in used))
    smiles = good.groupBy(*by).agg(F.max(forward).cast("double").alias("_f"), F.max(t).cast("double").alias("_t"), F.array_sort(F.collect_list(F.struct(F.col(strike).cast("double").alias("k"), F.col(vol).cast("double").alias("v")))).alias("_q"))
    smiles = smiles.select(*by, "_f", "_t", F.col("_q.k").alias("_k"), F.col("_q.v").alias("_v"))

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [fit(f, np.asarray(k), x, np.asarray(v), beta) if len(k) >= 3 else np.full(4, np.nan) for f, x, k, v in zip(b["_f"], b["_t"], b["_k"], b["_v"])]
            out = b[list(by)].copy()
            out["beta"], out["n"] = beta, [len(k) for k in b["_k"]]
            out[["alpha", "rho", "nu", "rmse"]] = np.array(rows).reshape(-1, 4)
            yield out

    types = ", ".join(f"`{c}` {smiles.schema[c].dataType.simpleString()}" for c in by)
    out = smiles.mapInPandas(fitted, f"{types}, beta double, n bigint, alpha double, rho double, nu double, rmse double")
    return out.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("alpha", "rho", "nu", "rmse")})
