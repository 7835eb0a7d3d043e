"""Document fingerprints as invertible Bloom lookup sketches.

A text is cut into paragraphs (lines), these at sentence ends and after ``PIECE`` characters, and each piece is hashed to a
digest of 48 bits and a check of 16. Equal pieces of one text count by their number of occurrence. A sketch has three tables of
cells; each digest goes into one cell of each, where its number and sum are kept. The fingerprint is the sketch with ``CELLS``
cells a table, so equal texts have equal fingerprints.

Two sketches of one size subtract cell by cell: what the texts share vanishes. A cell left with a single digest, as its check
shows, is peeled off all three tables until nothing remains; the digests peeled are those of one text only. Where peeling gets
stuck the difference was too large for the size, and both sketches are built four times as large. The likeness of two texts is
the number of shared pieces over the number of all, 1 for two empty texts.

Null texts are empty texts. Rows of one id stand in the order of their texts; null ids stand after all others.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from adloom.llm.common import extended, slices
from adloom.session import shuffle_partitions

CELLS = 8
TABLES = 3
PIECE = re.compile(r"[^.!?\n]{1,32}[.!?\n]*|[.!?\n]+")
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
CHECK = np.uint64(0xD6E8FEB86659FD93)
TOP = np.uint64(0xFFFFFFFFFFFF0000)
ATTEMPTS = 12
ROUNDS = 100
LAST_ID = -(1 << 63)


def digests(text: str) -> np.ndarray:
    """Digests of a text's pieces, all different."""
    pieces = PIECE.findall(text)
    if len(set(pieces)) == len(pieces):
        raw = [xxhash.xxh64_intdigest(p) for p in pieces]
    else:
        seen: dict[str, int] = {}
        raw = []
        for p in pieces:
            seen[p] = n = seen.get(p, -1) + 1
            raw.append(xxhash.xxh64_intdigest(p, n))
    out = np.array(raw, np.uint64) & TOP
    return out | check(out)


def check(top: np.ndarray) -> np.ndarray:
    """16 bits that depend on the upper 48 in no linear way, so that sums of digests do not pass for digests."""
    mixed = (top ^ (top >> np.uint64(29))) * CHECK
    return ((mixed ^ (mixed >> np.uint64(32))) * MIX[0]) >> np.uint64(48)


class Sets:
    """Digests of several texts, joined end to end."""

    def __init__(self, parts: list[np.ndarray]) -> None:
        self.sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owners, numbered from 0, and digests of some of the texts."""
        sizes = self.sizes[which]
        owner = np.repeat(np.arange(len(which)), sizes)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return owner, self.values[self.starts[which][owner] + inside]


def cells_of(owner: np.ndarray, values: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each digest in each table: a row per table."""
    place = (values * MIX[:, None]) >> np.uint64(64 - int(cells).bit_length() + 1)
    return (owner * TABLES + np.arange(TABLES)[:, None]) * cells + place.astype(np.int64)


def sketch(owner: np.ndarray, values: np.ndarray, owners: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums of all cells, a row per owner."""
    at = cells_of(owner, values, cells)
    counts = np.bincount(at.ravel(), minlength=owners * TABLES * cells)
    sums = np.zeros(owners * TABLES * cells, np.uint64)
    for row in at:
        np.add.at(sums, row, values)
    return counts, sums


def peel(counts: np.ndarray, sums: np.ndarray, owners: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Peel differences of sketches, which it uses up: numbers of digests of the first and the second only, and failures."""
    only = np.zeros((2, owners), np.int64)
    live = np.arange(len(counts))
    for _ in range(ROUNDS):  # a chance match of a check can go back and forth; it ends as a failure
        live = live[np.abs(counts[live]) == 1]
        sign = counts[live]
        value = np.where(sign > 0, sums[live], -sums[live])
        true = check(value & TOP) == value & ~TOP
        owner, value, sign, cell = live[true] // (TABLES * cells), value[true], sign[true], live[true]
        own = (cells_of(owner, value, cells) == cell).any(0)
        owner, value, sign = owner[own], value[own], sign[own]
        if not len(owner):
            break
        order = np.lexsort((value, owner))
        owner, value, sign = owner[order], value[order], sign[order]
        new = np.r_[True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])]
        owner, value, sign = owner[new], value[new], sign[new]
        only += np.array([np.bincount(owner[sign == s], minlength=owners) for s in (1, -1)])
        signed = np.where(sign > 0, value, -value)
        at = cells_of(owner, value, cells)
        for row in at:
            np.subtract.at(counts, row, sign)
            np.subtract.at(sums, row, signed)
        live = np.unique(at.ravel())
    left = (counts != 0) | (sums != 0)
    return only[0], only[1], left.reshape(owners, -1).any(1)


def likeness(sets: Sets, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Likeness of pairs of texts from their subtracted sketches, starting at the fingerprints' size."""
    gone = np.zeros(len(first), np.int64)
    open_, cells = np.arange(len(first)), CELLS
    for _ in range(ATTEMPTS):
        if not len(open_):
            break
        n = len(open_)
        a, b = (sketch(*sets.take(side[open_]), n, cells) for side in (first, second))
        only_a, _, stuck = peel(a[0] - b[0], a[1] - b[1], n, cells)
        gone[open_[~stuck]] = only_a[~stuck]
        open_, cells = open_[stuck], cells * 4
    for k in open_.tolist():  # two digests that share all three cells at every size
        a, b = (sets.take(side[k : k + 1])[1] for side in (first, second))
        gone[k] = len(np.setdiff1d(a, b))
    shared = sets.sizes[first] - gone
    both = sets.sizes[first] + sets.sizes[second] - shared
    return np.where(both > 0, shared / np.maximum(both, 1), 1.0)


def fingerprints(sets: Sets) -> list[str]:
    """The sketch of each text as text: counts, then sums, of all cells."""
    n = len(sets.sizes)
    counts, sums = sketch(*sets.take(np.arange(n)), n, CELLS)
    counts, sums = counts.astype("<i4").reshape(n, -1), sums.astype("<u8").reshape(n, -1)
    return [base64.b64encode(c.tobytes() + s.tobytes()).decode() for c, s in zip(counts, sums, strict=True)]


def edit(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def follow(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Deal rows into ranges of descending id, each followed by a copy of the first row after it.

    Bounds are quantiles of the ids and the copies are the first ids of the ranges: one small value a partition, known to the
    driver. The range of a row depends on its id only, so a lost task deals the same rows again.
    """
    spark = docs.sparkSession
    n = max(1, shuffle_partitions(spark))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_key")
    cuts = docs.select(key).agg(F.percentile_approx("_key", [k / n for k in range(1, n)] or [0.5], F.lit(100 * n))).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64)) if n > 1 else np.zeros(0, np.int64)
    last = len(bounds)

    @F.pandas_udf("int")
    def place(k: pd.Series) -> pd.Series:
        return pd.Series(last - np.searchsorted(bounds, k.to_numpy(np.int64)))

    heads = dict(docs.select(key).groupBy(place("_key").alias("p")).agg(F.max("_key")).collect())
    filled = sorted(heads)
    before = {heads[p]: filled[i - 1] for i, p in enumerate(filled)}

    @F.pandas_udf("array<struct<part:int,copy:boolean>>")
    def places(k: pd.Series) -> pd.Series:
        own = last - np.searchsorted(bounds, k.to_numpy(np.int64))
        return pd.Series([[(int(p), False)] + ([(before[x], True)] if x in before else []) for x, p in zip(k, own, strict=True)])

    rows = docs.select(F.col(id_col).alias("_id"), key, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_to", F.explode(places("_key"))).select("_id", "_key", "_text", "_to.part", "_to.copy")
    rows = rows.repartitionById(max(n, last + 1), F.col("part")).sortWithinPartitions("part", "copy", F.desc("_key"), "_text")
    return rows.select("_id", "_text", "part", "copy"), n


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and likeness to the edited text's and the next document's."""
    rows, _ = follow(docs, id_col, text_col)
    schema = extended(rows, ["_id"], "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row still waiting for the one after it
        for batch in batches:
            for part in slices(batch, "_text"):
                ids, texts, copies = (part.column(c).to_pylist() for c in ("_id", "_text", "copy"))
                parts = part.column("part").to_pylist()
                if held is not None:
                    ids, texts, copies, parts = ([h, *x] for h, x in zip(held, (ids, texts, copies, parts), strict=True))
                held = (ids[-1], texts[-1], copies[-1], parts[-1])
                asks = [i for i in range(len(ids) - 1) if not copies[i] and parts[i] == parts[i + 1]]
                if asks:
                    yield pa.RecordBatch.from_pydict(_compared(ids, texts, asks), schema=arrow)

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def _compared(ids: list, texts: list[str], asks: list[int]) -> dict:
    edited = [edit(texts[i], texts[i + 1]) for i in asks]
    sets = Sets([digests(t) for t in texts] + [digests(t) for t in edited])
    marks = fingerprints(sets)
    own, after = np.array(asks), len(texts) + np.arange(len(asks))
    return {
        "_id": [ids[i] for i in asks], "n_chars": [len(texts[i]) for i in asks],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": [marks[i] for i in asks], "edited_fingerprint": marks[len(texts) :],
        "near_edited": likeness(sets, own, after), "near_next": likeness(sets, own, own + 1),
    }
