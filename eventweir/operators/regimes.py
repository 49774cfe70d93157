"""Distributions of delays as plug-ins: a draw from uniform columns, a test of parameters and a description, under a name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import randomness as R
from .validate import PARAMETERS, params_valid


@dataclass(frozen=True)
class Regime:
    """draw(params, *keys) gives a delay as a column; params is a map column, keys are the columns a draw is keyed by."""

    name: str
    parameters: tuple[str, ...]
    draw: Callable[..., Column]
    valid: Callable[[Column], Column]

    def describe(self) -> dict:
        return {"name": self.name, "parameters": list(self.parameters)}


REGISTRY: dict[str, Regime] = {}


def register(regime: Regime) -> Regime:
    if regime.name in REGISTRY:
        raise ValueError(f"regime {regime.name!r} is there already")
    REGISTRY[regime.name] = regime
    return regime


def get_regime(name: str) -> Regime:
    if name not in REGISTRY:
        raise ValueError(f"unknown regime {name!r}; there are {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def _own(name: str, parameters: tuple[str, ...], draw: Callable[..., Column]) -> None:
    register(Regime(name, parameters, draw, lambda p: params_valid(F.lit(name), p)))


def _value(p: Column, key: str) -> Column:
    return F.try_element_at(p, F.lit(key))


_own("exponential", ("lambda",), lambda p, *k: R.exponential(R.uniform(*k, F.lit("a")), _value(p, "lambda")))
_own("gamma", ("shape", "scale"), lambda p, *k: R.gamma(_value(p, "shape"), _value(p, "scale"), *k))
_own("lognormal", ("mu", "sigma"), lambda p, *k: R.lognormal(R.uniform(*k, F.lit("a")), R.uniform(*k, F.lit("b")), _value(p, "mu"), _value(p, "sigma")))
_own("weibull", ("shape", "scale"), lambda p, *k: R.weibull(R.uniform(*k, F.lit("a")), _value(p, "shape"), _value(p, "scale")))
_own("deterministic_backoff", tuple(PARAMETERS["deterministic_backoff"]), lambda p, *k: _value(p, "value"))
