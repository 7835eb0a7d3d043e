"""Declarative column specs.

A spec entry is a plain dict such as::

    {"name": ["gender", "hour"], "type": "categorical", "dtype": "str"}
    {"name": "price", "type": "numeric", "dtype": "float", "normalizer": "MinMaxScaler", "fill_na": 0}
    {"name": "seq", "type": "sequence", "dtype": "str", "splitter": ",", "max_len": 100}
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from adloom.operators.clean import spark_type

TYPES = ("numeric", "categorical", "sequence", "meta")
PROCESSORS = ("quantile_bucket", "hash_bucket")


@dataclass(frozen=True)
class FeatureSpec:
    name: str
    type: str
    dtype: str = "str"
    active: bool = True
    fill_na: Any = None
    preprocess: str | None = None
    normalizer: str | Callable | None = None
    splitter: str | None = None
    max_len: int = 0
    padding: str = "pre"
    padding_idx: float | None = None
    min_categr_count: int | None = None
    num_ids: int | None = None
    lower: bool = False
    remap: bool = True
    share_embedding: str | None = None
    category_processor: str | None = None
    num_buckets: int | None = None
    source: str = ""
    feature_encoder: str | None = None
    embedding_dim: int | None = None
    emb_output_dim: int | None = None
    pretrained_emb: str | None = None
    freeze_emb: bool = True

    def __post_init__(self) -> None:
        if self.type not in TYPES:
            raise ValueError(f"column {self.name!r} has unknown type {self.type!r}")
        if self.category_processor not in (None, *PROCESSORS):
            raise ValueError(f"column {self.name!r}: category_processor {self.category_processor!r} is not supported")
        if self.type == "sequence" and not self.splitter:
            raise ValueError(f"sequence column {self.name!r} needs a splitter")
        if self.is_float_sequence and not self.share_embedding:
            raise ValueError(f"float sequence {self.name!r} must name the field it shares its scaler with")
        spark_type(self.dtype)

    @property
    def is_float_sequence(self) -> bool:
        return self.type == "sequence" and self.dtype == "float"

    @property
    def has_vocab(self) -> bool:
        if self.type == "categorical":
            return self.category_processor is None
        return (self.type == "sequence" and self.dtype == "str") or (self.type == "meta" and self.remap)

    @property
    def na_value(self) -> str:
        return "" if self.fill_na is None else str(self.fill_na)


@dataclass(frozen=True)
class LabelSpec:
    name: str
    dtype: str = "float"
    fill_na: Any = None
    preprocess: str | None = None
    active: bool = True


def expand(entries: Iterable[Mapping[str, Any] | FeatureSpec]) -> list[FeatureSpec]:
    """One FeatureSpec per column; an entry may list several names."""
    out: list[FeatureSpec] = []
    for e in entries:
        if isinstance(e, FeatureSpec):
            out.append(e)
            continue
        names = e["name"] if isinstance(e["name"], list) else [e["name"]]
        rest = {k: v for k, v in e.items() if k != "name"}
        out += [FeatureSpec(name=n, **rest) for n in names]
    return out


def labels(entries: Mapping[str, Any] | Sequence[Mapping[str, Any]]) -> list[LabelSpec]:
    entries = [entries] if isinstance(entries, Mapping) else entries
    return [e if isinstance(e, LabelSpec) else LabelSpec(**e) for e in entries]


def restrict(specs: Sequence[FeatureSpec], use: Sequence[str] | None = None, overrides: Iterable[Mapping[str, Any]] = ()) -> list[FeatureSpec]:
    """Keep the named features in the given order, then override attributes by feature name."""
    by_name = {s.name: s for s in specs}
    chosen = [by_name[n] for n in use] if use else list(specs)
    changes: dict[str, dict[str, Any]] = {}
    for o in overrides:
        names = o["name"] if isinstance(o["name"], list) else [o["name"]]
        for n in names:
            changes.setdefault(n, {}).update({k: v for k, v in o.items() if k != "name"})
    unknown = set(changes) - {s.name for s in chosen}
    if unknown:
        raise KeyError(f"no such features: {sorted(unknown)}")
    return [replace(s, **changes[s.name]) if s.name in changes else s for s in chosen]
