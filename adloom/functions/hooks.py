"""Named preprocessing hooks: a spec's ``preprocess: "name"`` or ``"name(column)"``.

A hook maps (DataFrame, column name) to a Column, so hooks stay inside the plan. Projects register
their own with :func:`hook`.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import scalars

Hook = Callable[[DataFrame, str], Column]
_HOOKS: dict[str, Hook] = {}
_CALL = re.compile(r"\s*(\w+)\s*(?:\(\s*([^()]*?)\s*\))?\s*")


def hook(name: str) -> Callable[[Hook], Hook]:
    def register(fn: Hook) -> Hook:
        _HOOKS[name] = fn
        return fn

    return register


def resolve(call: str, default_arg: str) -> tuple[Hook, str]:
    """The registered hook and its argument; without one the argument is the spec's own column."""
    m = _CALL.fullmatch(call)
    if m is None or m.group(1) not in _HOOKS:
        raise ValueError(f"unknown preprocess hook {call!r}; known: {sorted(_HOOKS)}")
    return _HOOKS[m.group(1)], m.group(2) if m.group(2) is not None else default_arg


@hook("copy_from")
def copy_from(df: DataFrame, source: str) -> Column:
    return F.col(source)


# Timestamp hooks always read the YYMMDDHH text in column ``hour``.
@hook("convert_weekday")
def convert_weekday(df: DataFrame, name: str) -> Column:
    return scalars.weekday("hour")


@hook("convert_weekend")
def convert_weekend(df: DataFrame, name: str) -> Column:
    return scalars.weekend("hour")


@hook("convert_hour")
def convert_hour(df: DataFrame, name: str) -> Column:
    return scalars.hour_of("hour")


@hook("convert_to_bucket")
def convert_to_bucket(df: DataFrame, name: str) -> Column:
    return scalars.log_square_bucket(name)


@hook("extract_country_code")
def extract_country_code(df: DataFrame, name: str) -> Column:
    return scalars.text_prefix(name, 2)


@hook("bucketize_age")
def bucketize_age(df: DataFrame, name: str) -> Column:
    return scalars.age_bucket(name)
