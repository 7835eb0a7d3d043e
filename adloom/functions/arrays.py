"""Fixed-length array expressions. All are row-local and safe on arrays shorter than asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters with a meaning in patterns, and those stripped from tokens.
REGEX_SPECIAL = ".$|()[{^?*+\\"
WHITE_SPACE = " \t\n\r\x0b\x0c"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def check_side(side: str) -> str:
    if side not in ("pre", "post"):
        raise ValueError(f"side must be 'pre' or 'post', not {side!r}")
    return side


def take(arr: str | Column, n: int, truncating: str = "pre") -> Column:
    """At most ``n`` elements: the last ones for 'pre', the first ones for 'post'."""
    arr = as_col(arr)
    if check_side(truncating) == "post":
        return F.slice(arr, 1, n)
    return F.slice(arr, F.greatest(F.size(arr) - n, F.lit(0)) + 1, n)


def pad(
    arr: str | Column, maxlen: int, value: object = 0, padding: str = "pre", truncating: str | None = None
) -> Column:
    """Exactly ``maxlen`` elements; a null array counts as empty."""
    kept = take(arr, maxlen, truncating or padding)
    fill = F.array_repeat(F.lit(value), F.greatest(F.lit(maxlen) - F.size(kept), F.lit(0)))
    whole = F.concat(fill, kept) if check_side(padding) == "pre" else F.concat(kept, fill)
    return F.coalesce(whole, F.array_repeat(F.lit(value), maxlen))


def split_tokens(text: str | Column, sep: str) -> Column:
    """Split on a literal separator; null and '' give an empty array."""
    text = as_col(text)
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(text, literal_pattern(sep))
    )


def literal_pattern(sep: str) -> str:
    """A split pattern for literal text; single characters take the split's non-regex fast path."""
    if len(sep) == 1:
        return "\\" + sep if sep in REGEX_SPECIAL else sep
    return "\\Q" + sep + "\\E"


def drop_blank(tokens: str | Column) -> Column:
    """Strip white space from every token and drop the empty ones."""
    return F.filter(F.transform(as_col(tokens), lambda t: F.btrim(t, F.lit(WHITE_SPACE))), lambda t: t != "")


def token_count(text: str | Column, sep: str) -> Column:
    return F.size(split_tokens(text, sep))


def non_pad_count(arr: str | Column, pad_value: object = 0) -> Column:
    return F.size(F.filter(as_col(arr), lambda x: x != F.lit(pad_value)))


def flatten_row(parts: Sequence[str | Column], array_parts: Sequence[str] = ()) -> Column:
    """One double vector from scalars and arrays, in the given order."""
    pieces = []
    for p in parts:
        c = as_col(p)
        is_array = isinstance(p, str) and p in array_parts
        pieces.append(c.cast("array<double>") if is_array else F.array(c.cast("double")))
    return F.concat(*pieces)


def slice_feature(vector: str | Column, offset: int, width: int) -> Column:
    """A feature's values from the flat vector; ``offset`` is 0-based."""
    return F.slice(as_col(vector), offset + 1, width)
