"""Scalar score and price expressions. All stay inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest argument of ln() in the log-sigmoid loss; keeps ln finite at 0.
LOG_FLOOR = 1e-8


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def binary_label(relevance="relevance") -> Column:
    return (_c(relevance) > 0).cast("int")


def price_log(price="price") -> Column:
    return F.log1p(_c(price))


def price_sqrt(price="price") -> Column:
    return F.sqrt(_c(price))


def nan_to_zero(x) -> Column:
    return F.coalesce(F.nanvl(_c(x).cast("double"), F.lit(0.0)), F.lit(0.0))


def price_power(price="price", power: float = 1.4) -> Column:
    return F.pow(nan_to_zero(price), F.lit(float(power)))


def sigmoid(x) -> Column:
    """Logistic link, written so that exp() never sees a large positive number."""
    x = _c(x)
    z = F.exp(-F.abs(x))
    return F.when(x >= 0, 1.0 / (1.0 + z)).otherwise(z / (1.0 + z))


def log_sigmoid(x) -> Column:
    x = _c(x)
    return F.least(x, F.lit(0.0)) - F.log1p(F.exp(-F.abs(x)))


def expected_revenue(prob, price="price") -> Column:
    return _c(price) * _c(prob)


def score_price_power(score, price="price", alpha: float = 0.8) -> Column:
    return _c(score) * price_power(price, alpha)


def score_sigmoid_price(logit, price="price", power: float = 1.0) -> Column:
    return sigmoid(logit) * F.pow(_c(price), F.lit(float(power)))


def trig_revenue(prob, price="price") -> Column:
    """Trigonometric expected-revenue score of the linear model."""
    p, c = _c(prob), _c(price)
    lift = (F.sin(p) + 1.0) * F.exp(p - 1.0)
    worth = F.log1p(c) * F.cos(c / 100.0)
    return lift * worth * (1.0 + F.tan(p * (math.pi / 4)))


def bpr_term(pos, neg, weight=None) -> Column:
    """Per-sample pairwise ranking loss, optionally weighted."""
    loss = -log_sigmoid(_c(pos) - _c(neg))
    return loss if weight is None else _c(weight) * loss


def rank_discount(rank="rank") -> Column:
    return 1.0 / F.log2(_c(rank) + F.lit(1.0))
