"""Counter-based uniforms and draws from them: the same keys give the same numbers whatever the partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(*keys: Column | str) -> Column:
    """In [0, 1), from the first 52 bits of the MD5 of the keys joined by a bar."""
    text = F.concat_ws("|", *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def exponential(u: Column, rate: Column) -> Column:
    return F.greatest(-F.ln(1 - u) / rate, F.lit(1e-9))


def lognormal(u1: Column, u2: Column, mu: Column, sigma: Column) -> Column:
    z = F.sqrt(-2 * F.ln(F.greatest(u1, F.lit(1e-15)))) * F.cos(2 * math.pi * u2)
    return F.greatest(F.exp(mu + sigma * z), F.lit(1e-9))


def weibull(u: Column, shape: Column, scale: Column) -> Column:
    return F.greatest(scale * F.pow(-F.ln(1 - u), 1 / shape), F.lit(1e-9))


def gamma_whole(us: list[Column], scale: Column) -> Column:
    """A gamma draw with a whole shape: the sum of that many exponentials."""
    return F.greatest(scale * sum((-F.ln(1 - u) for u in us), F.lit(0.0)), F.lit(1e-9))


def gamma(shape: Column, scale: Column, *keys: Column | str, tries: int = 32) -> Column:
    """A gamma draw of any shape by Marsaglia and Tsang's rejection: the first of ``tries`` proposals that is accepted (each is with a chance of
    over 0.95); a shape below 1 is drawn one higher and scaled down."""
    low = shape < 1
    c = F.when(low, shape + 1).otherwise(shape) - 1 / 3

    def proposal(i: Column) -> Column:
        u = lambda s: uniform(*keys, i, F.lit(s))
        z = F.sqrt(-2 * F.ln(F.greatest(u("x"), F.lit(1e-15)))) * F.cos(2 * math.pi * u("y"))
        return F.struct(z.alias("z"), F.pow(1 + z / F.sqrt(9 * c), F.lit(3)).alias("v"), u("w").alias("u"))

    def good(x: Column) -> Column:
        return (x["v"] > 0) & (F.ln(F.greatest(x["u"], F.lit(1e-300))) < x["z"] * x["z"] / 2 + c - c * x["v"] + c * F.ln(F.greatest(x["v"], F.lit(1e-300))))

    drawn = F.get(F.filter(F.transform(F.sequence(F.lit(1), F.lit(tries)), proposal), good), F.lit(0))
    boost = F.when(low, F.pow(1 - uniform(*keys, F.lit("boost")), 1 / shape)).otherwise(1.0)
    return F.greatest(c * F.coalesce(drawn["v"], F.lit(1.0)) * boost * scale, F.lit(1e-9))
