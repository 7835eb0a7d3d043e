"""Benchmark decontamination by q-gram lemma filtering.

If a region of a document lies within ``e`` edits of an item of ``n`` characters, the two share at least ``n + 1 - q * (e + 1)``
q-grams, all on diagonals (place in the document minus place in the item) that differ by at most ``e``. So q-grams of a
document that occur in some item are counted per item in bands of ``2 e + 1`` diagonals, each overlapping the next by half and
so holding any ``e + 1`` neighbours whole. Bands below the bound are passed over without loss; for each of the others one
alignment inside the band gives the least number of edits between the item and any region there, and regions over the budget
are dropped. Bands that touch are aligned together, in stretches of bounded width, so very long and repetitive texts take time
in proportion to their length and little memory.

``e`` is ``budget`` times ``n``, rounded down, and no more than leaves the bound at one shared q-gram. Texts are compared in lower case with every run of white space as one blank;
letters whose lower case is of another length stay as they are. Items shorter than ``q`` characters, and null texts on either
side, match nothing. Equal items are reported each by its own id. Items are taken in blocks of at most ``BLOCK_CHARS``
characters, each a pass over the documents with a broadcast of that size at most.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import extended, map_text

Q = 12
BUDGET = 0.05
BLOCK_CHARS = 4 << 20
FILTER_BITS = 22
REPEATED = 4  # a q-gram more often than this in an item is left out of the bands, and the item's bound lowered by its places
STRETCH = 1 << 15  # diagonals aligned at once
CHUNK = 1 << 18  # shared q-grams counted at once
RUNS = re.compile(r"\s{2,}")
OTHER_BLANK = re.compile(r"[^\S ]")
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


class Items(NamedTuple):
    ids: list[int]
    texts: list[np.ndarray]  # code points
    edits: np.ndarray
    bounds: np.ndarray  # least number of shared q-grams, of those kept with their places
    grams: np.ndarray  # sorted hashes of q-grams
    item: np.ndarray  # of each q-gram
    place: np.ndarray
    filter: np.ndarray  # whether some q-gram has these leading bits
    repeats: np.ndarray  # whether an item is found by counting places in the text instead of bands
    repeat_grams: np.ndarray  # sorted hashes of the different q-grams of such items
    repeat_item: np.ndarray


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def fold(text: str) -> tuple[str, np.ndarray | None]:
    """The compared form, and the place in the text of each of its characters (None if it is the same)."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    pieces, places, at = [], [], 0
    for m in RUNS.finditer(low):
        pieces.append(low[at : m.start() + 1])
        places.append(np.arange(at, m.start() + 1))
        at = m.end()
    if at:
        places.append(np.arange(at, len(low) + 1))
        low = "".join([*pieces, low[at:]])
    return OTHER_BLANK.sub(" ", low), np.concatenate(places) if at else None


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of each run of ``q`` characters, by doubling: runs of 1, 2, 4 … characters, then two that overlap."""
    out, n = codes.astype(np.uint64) * BASE, 1
    while n < q:
        step = min(n, q - n)
        out = (out[: len(out) - step] ^ (out[: len(out) - step] >> np.uint64(31))) * BASE + (out[step:] ^ (out[step:] >> np.uint64(29)))
        n += step
    return out ^ (out >> np.uint64(32))


def index(rows: list[tuple[int, str]], q: int, budget: float) -> Items:
    texts = [points(fold(t)[0]) for _, t in rows]
    hashes = [grams(t, q) if len(t) >= q else np.zeros(0, np.uint64) for t in texts]
    lengths = np.array([len(t) for t in texts], np.int64)
    edits = np.maximum(0, np.minimum((lengths * budget).astype(np.int64), lengths // q - 1))
    bounds = np.maximum(1, lengths + 1 - q * (edits + 1))
    repeats = np.zeros(len(rows), bool)
    flat, item, place, often, often_item = ([np.zeros(0, t)] for t in (np.uint64, np.int64, np.int64, np.uint64, np.int64))
    for i, h in enumerate(hashes):
        kinds, which, count = np.unique(h, return_inverse=True, return_counts=True)
        rare = count[which] <= REPEATED
        left = bounds[i] - np.count_nonzero(~rare)
        if left < 1 and not rare.all():
            repeats[i] = True
            often.append(kinds)
            often_item.append(np.full(len(kinds), i))
        else:
            bounds[i] = left
            flat.append(h[rare])
            item.append(np.full(np.count_nonzero(rare), i))
            place.append(np.flatnonzero(rare))
    flat, often = np.concatenate(flat), np.concatenate(often)
    order, often_order = np.argsort(flat, kind="stable"), np.argsort(often, kind="stable")
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[flat >> np.uint64(64 - FILTER_BITS)] = True
    seen[often >> np.uint64(64 - FILTER_BITS)] = True
    return Items(
        [i for i, _ in rows], texts, edits, bounds, flat[order], np.concatenate(item)[order], np.concatenate(place)[order], seen,
        repeats, often[often_order], np.concatenate(often_item)[often_order],
    )


def hits(at: np.ndarray, hashes: np.ndarray, known: np.ndarray):
    """Chunks of (place in the text, row of ``known``) of equal hashes, about ``CHUNK`` pairs each."""
    low = np.searchsorted(known, hashes, "left")
    n = np.searchsorted(known, hashes, "right") - low
    at, low, n = at[n > 0], low[n > 0], n[n > 0]
    total = np.cumsum(n)
    begin = 0
    while begin < len(at):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + CHUNK, "right")))
        m = n[begin:end]
        yield np.repeat(at[begin:end], m), np.repeat(low[begin:end] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        begin = end


def joined(item: int, firsts: np.ndarray, lasts: np.ndarray) -> list[tuple[int, int, int]]:
    """Ranges of diagonals, in rising order, those that touch as one of about ``STRETCH`` at most."""
    out: list[tuple[int, int, int]] = []
    for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True):
        if out and a <= out[-1][2] + 1 and b - out[-1][1] < STRETCH:
            out[-1] = (item, out[-1][1], b)
        else:
            out.append((item, a, b))
    return out


def bands(codes: np.ndarray, items: Items, q: int) -> list[tuple[int, int, int]]:
    """(item, first, last diagonal) of what meets the item's bound: overlapping diagonal bands, those that touch as one.

    An item most of whose q-grams recur in it would meet a repetitive text on every diagonal. For such items the places of the
    text that hold any of their q-grams are counted in every stretch as long as a region can be, which loses nothing either.
    """
    if len(codes) < q:
        return []
    hashes = grams(codes, q)
    at = np.flatnonzero(items.filter[hashes >> np.uint64(64 - FILTER_BITS)])
    counted = []
    for where, hit in hits(at, hashes[at], items.grams):
        item = items.item[hit]
        half = (where - items.place[hit]) // (items.edits[item] + 1)
        # A band holds two neighbouring halves, so each q-gram counts for the band of its half and for the one before.
        keys = item * (1 << 40) + half + (1 << 39)
        counted.append(np.unique(np.concatenate([keys, keys - 1]), return_counts=True))
    out = []
    if counted:
        kinds, place = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
        count = np.bincount(place, np.concatenate([n for _, n in counted]))
        good = kinds[count >= items.bounds[kinds >> 40]]
        which, band = good >> 40, (good & ((1 << 40) - 1)) - (1 << 39)
        for i in np.unique(which).tolist():
            first = band[which == i] * (items.edits[i] + 1)
            out += joined(i, first, first + 2 * items.edits[i] + 1)
    places: dict[int, list[np.ndarray]] = {}
    for where, hit in hits(at, hashes[at], items.repeat_grams):
        item = items.repeat_item[hit]
        for i in np.unique(item).tolist():
            places.setdefault(i, []).append(where[item == i])
    for i, found in places.items():
        held = np.concatenate(found)
        if len(held) < items.bounds[i]:
            continue
        # A region that begins at s has all its q-grams at s to s + reach; it suffices to begin shortly before or at one of them.
        e, reach = int(items.edits[i]), len(items.texts[i]) + int(items.edits[i]) - q
        enough = held[items.bounds[i] - 1 :] - held[: len(held) - items.bounds[i] + 1] <= reach
        begins = held[: len(enough)][enough]
        starts = held[items.bounds[i] - 1 :][enough] - reach
        out += [(i, a, b) for a, b in zip(*_spread(starts - e, begins + e, e), strict=True)]
    return out


def _spread(firsts: np.ndarray, lasts: np.ndarray, edits: int) -> tuple[list[int], list[int]]:
    """Unions of ranges whose ends both rise; longer ones than ``STRETCH`` are cut so that any ``2 edits + 1`` diagonals stay whole."""
    if not len(firsts):
        return [], []
    new = np.flatnonzero(np.concatenate([[True], firsts[1:] > lasts[:-1] + 1]))
    a, b = firsts[new], lasts[np.concatenate([new[1:] - 1, [len(lasts) - 1]])]
    whole = 2 * edits + 1
    size = max(STRETCH, 2 * whole)
    n = np.maximum(1, -(-(b - a + 1 - whole) // (size - whole)))
    begin = np.repeat(a, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * (size - whole)
    return begin.tolist(), np.minimum(np.repeat(b, n), begin + size - 1).tolist()


def align(codes: np.ndarray, item: np.ndarray, first: int, width: int, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, start, end) of the best region at each end, if within ``edits``, on diagonals ``first`` to ``first + width``.

    One row a character of the item; column ``k`` stands on diagonal ``first + k``. Insertions along a row are a running
    minimum of cost minus column. Begins are carried with the costs; of equal costs the latest begin, the shorter region, wins.
    """
    scale = 1 << 32  # cost in the high bits, distance of the begin in the low ones
    far = np.int64((1 << 20) * scale)
    k = np.arange(width + 1)
    slope = k * scale
    begin = first + k
    row = np.where((begin >= 0) & (begin <= len(codes)), np.int64(0), far) + (len(codes) - np.clip(begin, 0, len(codes)))
    window = np.full(width + 1 + len(item), -1, np.int64)
    low, high = max(0, first), min(len(codes), first + len(window))
    if low < high:
        window[low - first : high - first] = codes[low:high]
    outside = window < 0
    past = bool(outside.any())
    for j, c in enumerate(item.tolist()):
        best = row + (window[j : j + width + 1] != c) * scale
        if past:
            best = np.where(outside[j : j + width + 1], far + (best & (scale - 1)), best)
        best[:-1] = np.minimum(best[:-1], row[1:] + scale)  # a character of the item left out
        best -= slope
        row = np.minimum.accumulate(best, out=best)  # characters of the text put in
        row += slope
    end = first + k + len(item)
    good = np.flatnonzero(((row >> 32) <= edits) & (end <= len(codes)))
    return row[good] >> 32, len(codes) - (row[good] & (scale - 1)), end[good]


def apart(edits: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[int, int, int]]:
    """Regions that do not overlap: fewest edits first, then the earliest end, then the earliest start."""
    kept: list[tuple[int, int, int]] = []
    for level in np.unique(edits).tolist():
        here = np.flatnonzero(edits == level)
        here = here[np.lexsort((start[here], end[here]))]
        a, b = start[here], end[here]
        if kept:
            taken = np.array(sorted((x, y) for _, x, y in kept))
            free = np.searchsorted(taken[:, 0], b, "left") == np.searchsorted(taken[:, 1], a, "right")
            a, b = a[free], b[free]
        last = -1
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            if x >= last:
                kept.append((level, x, y))
                last = y
    return kept


def regions(text: str, items: Items, q: int) -> list[dict]:
    """All regions of a text within the budget of some item; of regions of one item that overlap, the best."""
    folded, places = fold(text)
    codes = points(folded)
    found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    for item, first, last in bands(codes, items, q):
        found.setdefault(item, []).append(align(codes, items.texts[item], first, last - first, int(items.edits[item])))
    out = []
    for item, spans in found.items():
        for edits, start, end in apart(*(np.concatenate(x) for x in zip(*spans, strict=True))):
            a, b = (start, end) if places is None else (int(places[start]), int(places[end]) if end < len(places) else len(text))
            out.append({"item_id": items.ids[item], "start": a, "end": b, "edits": edits})
    return sorted(out, key=lambda r: (r["start"], r["end"], r["item_id"]))


@lru_cache(maxsize=2)
def _items(holder, q: int, budget: float) -> Items:
    return index(holder.value, q, budget)


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", q: int = Q, budget: float = BUDGET, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``regions`` (item_id, start, end, edits), places being code points of the text, the end exclusive.

    Other columns pass through, but for one named ``regions``, which is replaced; rows without a region have an empty list.
    """
    spark = docs.sparkSession
    usable = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("long"), F.col(item_text))
    total = usable.agg(F.sum(F.length(item_text) + 1)).first()[0] or 0
    n = -(-total // BLOCK_CHARS) or 1
    out, columns = docs, [c for c in docs.columns if keep_text or c != text]
    for block in range(n):
        part = usable if n == 1 else usable.where(F.pmod(F.xxhash64(item_text), F.lit(n)) == block)
        holder = spark.sparkContext.broadcast(sorted(tuple(r) for r in part.collect()))  # about BLOCK_CHARS characters
        out = _searched(out, holder, text, columns, q, budget, last=block == n - 1, first=block == 0)
    return out


def _searched(docs: DataFrame, holder, text: str, columns: list[str], q: int, budget: float, first: bool, last: bool) -> DataFrame:
    carried = [c for c in (columns if last else docs.columns) if c != "regions"]

    def run(batch: pa.RecordBatch) -> dict:
        items = _items(holder, q, budget)
        before = [[]] * batch.num_rows if first else batch.column("regions").to_pylist()
        found = [b + (regions(t, items, q) if t else []) for b, t in zip(before, batch.column(text).to_pylist(), strict=True)]
        return {c: batch.column(c) for c in carried} | {"regions": found}

    return map_text(docs, text, run, extended(docs, carried, "regions array<struct<item_id:long,start:int,end:int,edits:int>>"))


def remove(text: str, spans: list[dict]) -> str:
    """The text without the regions."""
    out, at = [], 0
    for s in sorted(spans, key=lambda r: (r["start"], r["end"])):
        out.append(text[at : max(at, s["start"])])
        at = max(at, s["end"])
    return "".join(out) + text[at:]
