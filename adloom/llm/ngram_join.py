"""Jaccard self-join on word n-grams, with candidate pairs pruned by their posterior.

Two texts link if the Jaccard likeness of their sets of five-word shingles is at least 0.8. Words are runs without white space,
in lower case; a text of fewer words than a shingle takes has one shingle of all its words. Null and empty texts have none:
they are copies of each other and link to no other text.

1. Texts with one set of shingles form a class; one member stands for it from here on.
2. Each class gets ``HASHES`` MinHash values. Classes that agree on all values of some band are candidates.
3. Candidates are compared value by value. After every ``STEP`` values a pair is dropped if the chance that its likeness reaches
   0.8, given the matches so far and a flat prior, is below ``TOLERANCE``.
4. What survives is only kept as the pairs that connect it (a star for each group, never all pairs of a group). Classes that
   hang together this way meet again, with their texts, and all pairs among them are pruned once more as in 3 and the rest
   verified exactly. Every link lies within such a group, so none is lost between groups.
5. Links are summed up per class where they are found. Linked classes form near-duplicate groups.

A group of any size is cut into blocks of ``BLOCK`` members, and each pair of blocks is a unit of work of its own; so neither a
bucket nor a group ever meets whole in one task.

The chance to miss a link of likeness 0.8 is that no band agrees, (1 - 0.8^4)^24 < 3e-6, plus the tolerance at each test; it
falls steeply above 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from adloom.llm.common import map_text
from adloom.llm.components import components
from adloom.session import materialize, shuffle_partitions

WORDS = 5
LIKE = 0.8
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 8
TOLERANCE = 1e-6
BLOCK = 1024
PAIRS = 1 << 18  # pairs compared at once
PRIME = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    seen: dict[str, int] = {}
    kinds = [seen.setdefault(t, len(seen)) for t in tokens]
    h = np.fromiter(map(xxhash.xxh64_intdigest, seen), np.uint64, len(seen))[kinds]
    n = max(1, len(h) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(h))):
        out = (out ^ (out >> np.uint64(29))) * PRIME + h[k : k + n]
    return np.unique(out ^ (out >> np.uint64(32)))


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, HASHES, np.uint32)


def minhash(sets: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    mult, add = _functions()
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    folded = (sets >> np.uint64(32)).astype(np.uint32) ^ sets.astype(np.uint32)
    for start in range(0, len(folded), 4096):
        part = folded[start : start + 4096]
        values = part * mult[:, None] + add[:, None]
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        np.minimum(best, values.min(1), out=best)
    return best


def signatures(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Per row: ``_id``, a hash of its text, a digest of its shingle set, its size, and the MinHash values as bytes.

    ``short`` has the second byte of each value.
    """

    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t) for t in batch.column("_text").to_pylist()]
        values = [minhash(s).astype("<u4").tobytes() if len(s) else b"" for s in sets]
        return {
            "_id": batch.column("_id"), "hash": batch.column("hash"), "set": [xxhash.xxh128_digest(s.tobytes()) for s in sets],
            "n": [len(s) for s in sets], "sig": values, "short": [v[1::4] for v in values],
        }

    return map_text(_texts(docs, id_col, text), "_text", run, "_id long, hash long, set binary, n long, sig binary, short binary")


def _texts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(body).alias("hash"), body.alias("_text"))


@lru_cache(maxsize=4)
def least_matches(bits: int, like: float = LIKE) -> np.ndarray:
    """For each number of values compared: matches below which a pair is dropped.

    A value matches with the likeness, or else by chance of its ``bits`` bits. The posterior is summed over a grid.
    """
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 2.0**bits
    out = np.zeros(HASHES + 1, np.int64)
    for n in range(STEP, HASHES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(p) + (n - m) * np.log1p(-np.minimum(p, 1 - 1e-12))
        weight = np.exp(log - log.max(1, keepdims=True))
        chance = weight[:, s >= like].sum(1) / weight.sum(1)
        out[n] = int(np.argmax(chance >= TOLERANCE))
    return out


def survivors(sig: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of signature rows pass every test."""
    least = least_matches(8 * sig.dtype.itemsize)
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n in range(STEP, sig.shape[1] + 1, STEP):
        matches = matches + (sig[a[alive], n - STEP : n] == sig[b[alive], n - STEP : n]).sum(1)
        keep = matches >= least[n]
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node each of ``n`` nodes is connected to."""
    root = np.arange(n)
    while len(a):
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    while (root[root] != root).any():
        root = root[root]
    return root


def blocked(rows: DataFrame, group: str, member: str) -> DataFrame:
    """Copies of the rows of each group for every pair of blocks: with ``_unit`` to meet by and ``_side`` (0, 1, or 2 for both).

    Groups of one member are left out. A group of ``g`` members has ``p = ceil(g / BLOCK)`` blocks, and each row goes to ``p``
    units, one for each block it has to be compared with.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_g")).where("_g > 1")
    p = F.ceil(F.col("_g") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(member), p).cast("int")
    spread = rows.join(sizes, group).withColumns({"_p": p, "_own": own})
    spread = spread.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_p") - 1)))
    side = F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1)
    unit = F.xxhash64(group, F.least("_own", "_other"), F.greatest("_own", "_other"))
    return spread.select(*rows.columns, unit.alias("_unit"), side.alias("_side"))


def per_unit(rows: DataFrame, fn, schema: str) -> DataFrame:
    """Run ``fn`` over the rows of each unit, as a dict of columns; many small units are given to it together.

    ``fn`` gets the batch of whole units and the place where each begins.
    """
    spark_schema = _parse_datatype_string(schema)
    arrow = to_arrow_schema(spark_schema)

    def emit(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        units = table.column("_unit").to_numpy()
        starts = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
        out = fn(table, np.r_[starts, len(units)])
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            units = batch.column("_unit").to_numpy()
            # All before the last unit of this batch is whole.
            cut = int(np.flatnonzero(np.r_[True, units[1:] != units[:-1]])[-1])
            if cut or held and held[-1].column("_unit")[-1].as_py() != units[0]:
                if cut or held:
                    yield from emit([*held, batch.slice(0, cut)] if cut else held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from emit(held)

    n = max(1, shuffle_partitions(rows.sparkSession))
    return rows.repartition(n, "_unit").sortWithinPartitions("_unit").mapInArrow(run, spark_schema)


def unit_pairs(side: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs to be compared in a run of units, about ``PAIRS`` at a time; equal blocks give each pair once."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    total = 0
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        own = side[s:e]
        if own[0] == 2:
            n = e - s
            step = max(1, PAIRS // n)
            for i in range(0, n - 1, step):
                a, b = np.triu_indices(min(step, n - i), 1, n - i)
                held.append((a + s + i, b + s + i))
                total += len(a)
                if total >= PAIRS:
                    yield tuple(map(np.concatenate, zip(*held, strict=True)))
                    held, total = [], 0
        else:
            left, right = s + np.flatnonzero(own == 0), s + np.flatnonzero(own == 1)
            if len(left) and len(right):
                step = max(1, PAIRS // len(right))
                for i in range(0, len(left), step):
                    part = left[i : i + step]
                    held.append((np.repeat(part, len(right)), np.tile(right, len(part))))
                    total += len(held[-1][0])
                    if total >= PAIRS:
                        yield tuple(map(np.concatenate, zip(*held, strict=True)))
                        held, total = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def stars(ids: np.ndarray, root: np.ndarray) -> dict:
    """Pairs of each node with its root."""
    tied = np.flatnonzero(root != np.arange(len(root)))
    return {"a": ids[root[tied]], "b": ids[tied]}


def _matrix(column, width: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def candidate_edges(classes: DataFrame) -> DataFrame:
    """Pairs that connect the classes whose pairs survive the comparison of values, from the buckets of all bands."""
    width = 4 * ROWS
    buckets = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", 1 + b * width, width)) for b in range(BANDS)])
    rows = blocked(classes.select("rep", F.explode(buckets).alias("bucket")), "bucket", "rep")
    # A byte of each value is enough to connect; the exact step sees the whole values again.
    rows = rows.drop("bucket").join(classes.select("rep", "short"), "rep")

    def run(table: pa.Table, starts: np.ndarray) -> dict:
        sig, ids = _matrix(table.column("short"), HASHES, np.uint8), table.column("rep").to_numpy()
        found = [(a[k], b[k]) for a, b in unit_pairs(table.column("_side").to_numpy(), starts) for k in [survivors(sig, a, b)]]
        a, b = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
        return stars(ids, roots(len(ids), a, b))

    return per_unit(rows, run, "a long, b long")


def exact_links(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of sets have a Jaccard likeness of ``LIKE`` at least; pairs come grouped by their first set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    fit = np.minimum(sizes[a], sizes[b]) >= LIKE * np.maximum(sizes[a], sizes[b])
    out = np.zeros(len(a), bool)
    at = np.flatnonzero(fit)
    order = at[np.argsort(a[at], kind="stable")]
    if not len(order):
        return out
    cuts = np.r_[np.flatnonzero(np.r_[True, a[order][1:] != a[order][:-1]]), len(order)].tolist()
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        mine = sets[a[order[s]]]
        for chunk in range(s, e, 256):
            rows = order[chunk : min(e, chunk + 256)]
            others = b[rows]
            flat = np.concatenate([sets[j] for j in others.tolist()])
            at_ = np.searchsorted(mine, flat)
            at_[at_ == len(mine)] = 0
            ends = np.cumsum(sizes[others])
            hits = np.r_[0, np.cumsum(mine[at_] == flat)][np.r_[0, ends]]
            shared = np.diff(hits)
            out[rows] = shared * (1 + LIKE) >= LIKE * (len(mine) + sizes[others]) - 1e-9
    return out


def verified(members: DataFrame) -> DataFrame:
    """Per class and unit: documents linked to it there (``links``), and a pair ``a, b`` that connects it."""

    def run(table: pa.Table, starts: np.ndarray) -> dict:
        sig, ids, weight = _matrix(table.column("sig"), HASHES, np.uint32), table.column("rep").to_numpy(), table.column("copies").to_numpy()
        texts = table.column("text")
        sets: dict[int, np.ndarray] = {}
        links, found = np.zeros(len(ids), np.int64), []
        for a, b in unit_pairs(table.column("_side").to_numpy(), starts):
            k = survivors(sig, a, b)
            a, b = a[k], b[k]
            for i in np.union1d(a, b).tolist():
                if i not in sets:
                    sets[i] = shingles(texts[i].as_py())
            used = np.array(sorted(sets), np.int64)
            linked = exact_links([sets[i] for i in used.tolist()], np.searchsorted(used, a), np.searchsorted(used, b)) if len(a) else np.zeros(0, bool)
            a, b = a[linked], b[linked]
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            root = roots(len(ids), a, b)  # a chunk's links are kept as stars
            tied = np.flatnonzero(root != np.arange(len(ids)))
            found.append((root[tied], tied))
        a, b = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
        root = roots(len(ids), a, b)
        return {"rep": ids, "links": links, "root": ids[root]}

    return per_unit(blocked(members, "root", "rep"), run, "rep long, links long, root long")


def _classes(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and per set of shingles: least (id, hash of text) of its group, links and copies."""
    rows = materialize(signatures(docs, id_col, text), "signatures")
    known = rows.where("_id is not null")
    # Rows of one set have the same size and values.
    classes = known.groupBy("set").agg(
        F.min(F.struct("_id", "hash")).alias("who"), F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("n", "sig", "short")])
    classes = classes.select("set", F.xxhash64("set").alias("rep"), F.col("who._id").alias("_id"), F.col("who.hash").alias("hash"), "copies", "n", "sig", "short")
    classes = materialize(classes, "classes")
    full = classes.where("n > 0")
    groups = components(candidate_edges(full)).withColumnRenamed("node", "rep")
    members = materialize(full.select("rep", "_id", "hash", "copies", "sig").join(groups, "rep"), "members")
    texts = _texts(docs, id_col, text).join(members, ["_id", "hash"]).dropDuplicates(["rep"])
    found = materialize(verified(texts.select("rep", "copies", "sig", "root", F.col("_text").alias("text"))), "links")
    near = found.groupBy("rep").agg(F.sum("links").alias("links"))
    linked = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = linked.withColumnRenamed("node", "rep")
    placed = classes.select("rep", "set", "_id", "hash", "copies").join(near, "rep", "left").join(linked, "rep", "left").withColumn("group", F.coalesce("root", "rep"))
    least = placed.groupBy("group").agg(F.min(F.struct("_id", "hash")).alias("_least"))
    links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    return rows, placed.join(least, "group").select("set", "_least", links, "copies")


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``id_col``, ``class_id`` (smallest id of its near-duplicate group), ``n_links`` (other rows whose likeness to it
    is 0.8 or more, copies included) and ``copies`` (rows with its set of shingles, itself included).

    Ids are whole numbers; rows that repeat an id are rows of their own in the counts, and null ids form no group.
    """
    rows, classes = _classes(docs, id_col, text)
    out = rows.where("_id is not null").select("_id", "set").join(classes, "set")
    out = out.select("_id", F.col("_least._id").alias("class_id"), "n_links", "copies")
    lone = rows.where("_id is null").select("_id", F.lit(None).cast("long"), F.lit(0).cast("long"), F.lit(1).cast("long"))
    return out.union(lone).withColumnRenamed("_id", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one of smallest id, and of its texts the one of smallest hash.

    Of rows with this id and text one stays. Rows with a null id stay all.
    """
    _, classes = _classes(docs, id_col, text)
    kept = classes.select(F.col("_least._id").alias("_id"), F.col("_least.hash").alias("_hash")).distinct()
    keyed = docs.withColumns({"_id": F.col(id_col).cast("long"), "_hash": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    chosen = keyed.join(kept, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return chosen.select(*docs.columns).unionByName(keyed.where("_id is null").select(*docs.columns))
