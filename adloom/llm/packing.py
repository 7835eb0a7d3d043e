"""Packing documents into sequences by a grouping genetic algorithm on islands.

A solution is a grouping of items into bins of ``capacity``. Crossover injects whole well-filled bins of one parent into the other,
removes the bins that hold a duplicate, and puts the displaced items back by best fit, longest first; mutation dissolves a few bins.
Fewer bins win, then the larger mean of squared fillings, which gathers the free room in few bins.

Items are dealt to shards of about ``SHARD`` by a hash of their row; a shard is evolved on ``ISLANDS`` islands, whose best solution
moves on to the next island after every epoch. What lies in the emptiest bins of all shards is then dealt anew to fewer shards, and
so on until one shard is left. So no task holds more than a shard, and the free room left over does not grow with the table.

Null and empty texts are one token (the end). Rows are told apart by where they are stored, so repeated rows, null and repeated ids
are packed like any others. All random choices are seeded by shard, island and epoch; a task that is run again decides alike.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from adloom.llm import bpe
from adloom.llm.common import map_text
from adloom.session import materialize

CAPACITY = 2048
SHARD = 4096
ISLANDS = 2
MEMBERS = 4
EPOCHS = 3
# Generations of an epoch for a full shard, and at most; smaller shards get as many more as they have fewer items.
GENERATIONS, MOST_GENERATIONS = 10, 300
# Bins filled to this share may be injected; a crossover injects up to this share of them.
WELL_FILLED = 0.995
INJECTED = 0.25
# Bins that a shard hands on, emptiest first: this share, and at least so many.
REOPENED = 0.05
REOPENED_LEAST = 8
# Pieces of text and pair verdicts that a worker remembers; beyond them it starts anew, with the same results.
MEMORY = 300_000
# Symbols of a word up to which it is merged at once, in so many steps at most.
SHORT = 32

# Words of stretches that are each followed by a line feed, and the line feeds.
ASCII_LINES = re.compile(rf"\n|[a-z]+|{bpe.ASCII_WORDS.pattern}")
ANY_LINES = regex.compile(rf"\n|{bpe.ANY_WORDS.pattern}")


class Proposer:
    """Greedy longest match of many words side by side, in a trie whose edges are one sorted array."""

    def __init__(self, vocab: bpe.Vocabulary) -> None:
        nodes: dict[str, int] = {"": 0}
        for form in vocab.proposable:
            for n in range(1, len(form) + 1):
                nodes.setdefault(form[:n], len(nodes))
        edges = sorted((nodes[f[:-1]] * 512 + ord(f[-1]), n) for f, n in nodes.items() if f)
        self.edges = np.array([e for e, _ in edges] + [-1], np.int64)
        self.child = np.array([n for _, n in edges] + [0], np.int64)
        self.token = np.full(len(nodes), -1, np.int64)
        for form, i in vocab.proposable.items():
            self.token[nodes[form]] = i

    def propose(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, owner) of words whose symbols lie one after another in ``flat``."""
        word, end = np.arange(len(sizes)), np.cumsum(sizes)
        pos = end - sizes
        node, best, after = np.zeros_like(pos), np.full(len(pos), -1), pos.copy()
        ids, owners = [], []
        while len(word):
            inside = pos < end
            key = node * 512 + flat[np.minimum(pos, len(flat) - 1)]
            at = np.searchsorted(self.edges[:-1], key)
            hit = inside & (self.edges[at] == key)
            node = np.where(hit, self.child[at], 0)
            pos = pos + hit
            found = self.token[node]
            longer = hit & (found >= 0)
            best, after = np.where(longer, found, best), np.where(longer, pos, after)
            if not hit.all():
                # No longer match: the longest so far is a token, and the search goes on behind it.
                ids.append(best[~hit])
                owners.append(word[~hit])
                pos = np.where(hit, pos, after)
                best = np.where(hit, best, -1)
                live = hit | (pos < end)
                if not live.all():
                    word, end, pos, node, best, after = (x[live] for x in (word, end, pos, node, best, after))
        empty = [np.zeros(0, np.int64)]
        owner = np.concatenate(owners or empty)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(ids or empty)[order], owner[order]


class Merger:
    """Exact merging of many short words side by side. Words of equal length form a table; every step merges one pair in each of its
    rows, so that the rows stay equally long, and takes out the rows that are done."""

    def __init__(self, vocab: bpe.Vocabulary) -> None:
        self.vocab = vocab
        ranks = vocab.ranks[:-1]
        self.product = np.zeros(int(ranks.max(initial=0)) + 1, np.int64)
        self.product[ranks] = vocab.products[:-1]
        # Ranks of all pairs of symbols, with which every word begins.
        self.first = vocab.rank(np.repeat(vocab.single, 512), np.tile(vocab.single, 512))[0]

    def merge(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words whose symbols lie one after another in ``flat``, likewise, and how many each word has."""
        counts, tables = np.zeros(len(sizes), np.int64), []
        starts = np.cumsum(sizes) - sizes
        for n in np.unique(sizes).tolist():
            words = np.flatnonzero(sizes == n)
            for done, ids in self.table(flat[starts[words][:, None] + np.arange(n)]):
                counts[words[done]] = ids.shape[1]
                tables.append((words[done], ids))
        out, starts = np.zeros(int(counts.sum()), np.int64), np.cumsum(counts) - counts
        for words, ids in tables:
            out[starts[words][:, None] + np.arange(ids.shape[1])] = ids
        return out, counts

    def table(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, ids of these rows), as they are done."""
        rows, parts = np.arange(len(symbols)), self.vocab.single[symbols]
        ranks = self.first[symbols[:, :-1] * 512 + symbols[:, 1:]]
        while ranks.size:
            at = ranks.argmin(axis=1)  # The leftmost of equals.
            least = ranks[np.arange(len(at)), at]
            live = least != bpe.UNRANKED
            if not live.all():
                yield rows[~live], parts[~live]
                rows, parts, ranks, at, least = (x[live] for x in (rows, parts, ranks, at, least))
            each, width = np.arange(len(rows)), ranks.shape[1]
            parts[each, at] = self.product[least]
            parts = parts[np.arange(width + 1) != at[:, None] + 1].reshape(len(rows), width)
            ranks = ranks[np.arange(width) != at[:, None]].reshape(len(rows), width - 1)
            for changed, p in ((at > 0, at - 1), (at < width - 1, at)):
                r, q = each[changed], p[changed]
                ranks[r, q] = self.vocab.rank(parts[r, q], parts[r, q + 1])[0]
        if len(rows):
            yield rows, parts


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of many stretches, each from its start on, one stretch after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(sizes.sum())) + np.repeat(starts - (ends - sizes), sizes)


class Numbered:
    """Texts by the numbers of the different ones: Python sees only these, what they are worth is gathered by number."""

    def __init__(self, texts: pa.Array) -> None:
        coded = texts.dictionary_encode()
        self.kinds = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.numbers = coded.indices.to_numpy()

    def gather(self, coded: list[bytes]) -> tuple[bytes, np.ndarray]:
        """The bytes of all texts, from those of each kind, and where each text's begin, with the end of the last."""
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        own = sizes[self.numbers]
        ids = np.frombuffer(b"".join(coded), "<u4")[spread((np.cumsum(sizes) - sizes)[self.numbers], own)]
        return ids.tobytes(), 4 * np.r_[0, np.cumsum(own)]


class Coder:
    """Token ids as little-endian bytes, with a memory of words and of the stretches between white space.

    A slice of texts is cut into stretches in Arrow. New short words are merged side by side. Long ones are proposed together first,
    all adjacent pairs are looked up together, and words with a failing pair are merged exactly.
    """

    def __init__(self, vocab: bpe.Vocabulary) -> None:
        self.vocab, self.merger = vocab, Merger(vocab)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.plain = all(s.startswith("<|") for s in vocab.special)

    @cached_property
    def proposer(self) -> Proposer:
        return Proposer(self.vocab)

    def lines(self, text: str) -> Iterator[tuple[str, bytes]]:
        """What lies between special tokens, normalised, and the id of the special token behind it."""
        at = 0
        if "<|" in text or not self.plain:
            for m in self.vocab.split.finditer(text):
                yield normal(text[at : m.start()]), self.vocab.bytes[self.vocab.special[m.group()]]
                at = m.end()
        yield normal(text[at:]), b""

    def words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words."""
        raw = [w.encode() for w in words]
        short = [k for k, w in enumerate(raw) if len(w) <= SHORT]
        long = [k for k, w in enumerate(raw) if len(w) > SHORT]
        out = {}
        for some, fn in ((short, self.merger.merge), (long, self.proposed)):
            if some:
                sizes = np.fromiter((len(raw[k]) for k in some), np.int64, len(some))
                flat = np.frombuffer(b"".join([raw[k] for k in some]), np.uint8).astype(np.int64)
                if self.vocab.suffix:
                    flat[np.cumsum(sizes) - 1] += 256
                ids, counts = fn(flat, sizes)
                coded, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                out.update({words[k]: coded[i:j] for k, i, j in zip(some, [0, *ends], ends, strict=False)})
        return out

    def proposed(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of long words, and how many each word has."""
        if len(self.vocab.verdicts) > MEMORY:
            self.vocab.verdicts.clear()
        ids, owner = self.proposer.propose(flat, sizes)
        inner = owner[1:] == owner[:-1]
        kinds, back = np.unique((ids[:-1] * self.vocab.width + ids[1:])[inner], return_inverse=True)
        failed = np.unique(owner[1:][inner][~self.vocab.compatible(kinds.tolist())[back]])
        forms = ["".join(map(chr, flat[j - n : j])) for j, n in zip(np.cumsum(sizes)[failed], sizes[failed], strict=True)]
        coded = np.split(ids, np.searchsorted(owner, np.arange(1, len(sizes))))
        for k, exact in zip(failed.tolist(), self.vocab.merge(forms), strict=True):
            coded[k] = np.array(exact, np.int64)
        return np.concatenate(coded), np.fromiter(map(len, coded), np.int64, len(coded))

    def cut(self, stretches: list[str]) -> dict[str, bytes]:
        """Ids of stretches, from those of their words, which are remembered too."""
        ascii, others = ([s for s in stretches if s.isascii() == is_ascii] for is_ascii in (True, False))
        found = [w for pattern, some in ((ASCII_LINES, ascii), (ANY_LINES, others)) for w in pattern.findall("".join([s + "\n" for s in some]))]
        words = Numbered(pa.array(found, pa.large_string()))
        self.known.update(self.words([w for w in words.kinds if w not in self.known and w != "\n"]))
        coded, starts = words.gather([self.known[w] if w != "\n" else b"" for w in words.kinds])
        ends = starts[1:][words.numbers == words.kinds.index("\n")].tolist() if found else []
        return {s: coded[i:j] for s, i, j in zip([*ascii, *others], [0, *ends], ends, strict=False)}

    def learn(self, stretches: list[str]) -> list[bytes]:
        """Ids of stretches, all different."""
        if len(self.known) > MEMORY:
            self.known, self.before = {}, self.known
        out = list(map(self.known.get, stretches))
        new = []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            s = stretches[k]
            if (old := self.before.get(s)) is None:
                new.append(k)
            else:
                out[k] = self.known[s] = old
        coded = self.cut([stretches[k] for k in new])
        for k in new:
            out[k] = coded[stretches[k]]
        self.known.update(coded)
        return out

    def code(self, texts: list[str]) -> list[bytes]:
        lines = [(doc, *line) for doc, text in enumerate(texts) for line in self.lines(text)]
        # Words never reach across white space. What is not ASCII of it stays in a stretch and is left out where that is cut.
        cut = pc.ascii_split_whitespace(pa.array([line for _, line, _ in lines], pa.large_string()))
        stretches = Numbered(cut.flatten())
        coded, starts = stretches.gather(self.learn(stretches.kinds))
        ends = starts[cut.offsets.to_numpy()].tolist()
        out: list[list[bytes]] = [[] for _ in texts]
        for (doc, _, special), i, j in zip(lines, ends, ends[1:], strict=False):
            out[doc] += coded[i:j], special
        return [b"".join(parts) for parts in out]


def normal(text: str) -> str:
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    # Letter by letter: the rule for a sigma at the end of a word does not apply.
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


_CODERS: dict[int, Coder] = {}


def coder(content: str) -> Coder:
    key = hash(content)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(bpe.vocabulary(content))
    return _CODERS[key]


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """(``id_col``, piece, start, length, ids_crc32, _row): the token ids of every whole text and one ``end``, cut where they exceed
    ``capacity``. Stored, so that ``_row`` stays what it is."""
    with open(path, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    last = end.to_bytes(4, "little")

    def run(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("_doc", "piece", "start", "length", "ids_crc32")}
        for doc, raw in enumerate(coder(content.value).code(batch.column("_text").to_pylist())):
            raw += last
            for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[at : at + 4 * capacity]
                for c, v in zip(out, (doc, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                    out[c].append(v)
        return {"_id": batch.column("_id").take(pa.array(out.pop("_doc"), pa.int64())), **out}

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    cut = map_text(narrow, "_text", run, f"_id {kind}, piece int, start long, length long, ids_crc32 long")
    return materialize(cut.withColumnRenamed("_id", id_col).withColumn("_row", F.monotonically_increasing_id()), "pieces")


def best_fit(items: np.ndarray, length: list[int], bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Put items, one after another, into the bin that they fill best, or a new one; ``bins`` and ``room`` are changed."""
    by_room: dict[int, list[int]] = {}
    mask = 0  # Bit r is set where a bin has room r.
    for b, r in enumerate(room):
        if r:
            by_room.setdefault(r, []).append(b)
            mask |= 1 << r
    for i in items.tolist():
        n = length[i]
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            same = by_room[r]
            b = same.pop()
            if not same:
                mask ^= 1 << r
        else:
            b, r = len(room), capacity
            room.append(r)
        bins[i] = b
        r -= n
        room[b] = r
        if r:
            by_room.setdefault(r, []).append(b)
            mask |= 1 << r


class Island:
    """Solutions for the items of one shard. Lengths must fall, so that items in order of number are longest first."""

    def __init__(self, lengths: list[int], seed: list[int], capacity: int = CAPACITY) -> None:
        self.length, self.capacity = lengths, capacity
        self.weight = np.array(lengths, np.int64)
        self.bound = -(-int(self.weight.sum()) // capacity)
        self.random = np.random.default_rng(seed)
        self.members: list[tuple[tuple[int, float], np.ndarray]] = []

    def filling(self, bins: np.ndarray) -> np.ndarray:
        return np.bincount(bins, self.weight).astype(np.int64)

    def add(self, bins: np.ndarray) -> None:
        """Keep a solution if it is new and among the best ``MEMBERS``."""
        full = self.filling(bins)
        rank = (len(full), -float(np.square(full / self.capacity).mean()))
        if all(rank != r for r, _ in self.members):
            self.members = sorted([*self.members, (rank, bins)], key=lambda m: m[0])[:MEMBERS]

    def begin(self) -> None:
        """Best fit of the items in random orders that lean to the longest first, each more loosely."""
        for looseness in range(MEMBERS):
            order = np.argsort(self.weight * -1.0 + self.random.random(len(self.weight)) * self.capacity * looseness / MEMBERS, kind="stable")
            bins = np.zeros(len(self.weight), np.int64)
            best_fit(order, self.length, bins, [], self.capacity)
            self.add(bins)

    def rebuilt(self, bins: np.ndarray, free: np.ndarray) -> np.ndarray:
        """Number the bins anew without the free items, then put these back."""
        out = np.zeros_like(bins)
        kept, number = np.unique(bins[~free], return_inverse=True)
        out[~free] = number
        room = self.capacity - np.bincount(number, self.weight[~free], len(kept)).astype(np.int64)
        best_fit(np.flatnonzero(free), self.length, out, room.tolist(), self.capacity)
        return out

    def crossed(self, into: np.ndarray, giver: np.ndarray) -> np.ndarray:
        """Whole well-filled bins of the giver, and of the other parent the bins that share no item with them."""
        good = np.flatnonzero(self.filling(giver) >= WELL_FILLED * self.capacity)
        if not len(good):
            return into
        given = np.zeros(int(giver.max()) + 1, bool)
        given[self.random.choice(good, max(1, int(len(good) * INJECTED * self.random.random())), replace=False)] = True
        injected = given[giver]
        hit = np.zeros(int(into.max()) + 1, bool)
        hit[into[injected]] = True
        child = np.where(injected, giver + len(hit), into)
        return self.rebuilt(child, hit[into] & ~injected)

    def mutated(self, bins: np.ndarray) -> np.ndarray:
        """Some of the emptiest bins and some others give their items back."""
        full = self.filling(bins)
        few = max(2, len(full) // 20)
        gone = np.zeros(len(full), bool)
        gone[np.argsort(full, kind="stable")[:few]] = True
        gone[self.random.choice(len(full), min(few, len(full)), replace=False)] = True
        return self.rebuilt(bins, gone[bins])

    def evolve(self) -> None:
        for _ in range(min(MOST_GENERATIONS, GENERATIONS * math.ceil(SHARD / len(self.weight)))):
            if len(self.members) < 2 or self.members[0][0][0] <= self.bound and self.tight():
                return
            into, giver = self.random.choice(len(self.members), 2, replace=False)
            child = self.crossed(self.members[into][1], self.members[giver][1])
            self.add(child)
            self.add(self.mutated(child))

    def tight(self) -> bool:
        """Whether all bins but one are full, so that nothing can be gained."""
        return int((self.filling(self.members[0][1]) < self.capacity).sum()) <= 1


STATE = "shard long, island int, rows array<long>, lengths array<int>, members array<array<int>>, sequences int, filled double"


def _evolved(state: DataFrame, seed: int, capacity: int) -> DataFrame:
    """One epoch on every island; ``state`` also holds a solution that came from another island, or null."""
    arrow = to_arrow_schema(_parse_datatype_string(STATE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                island = Island(row["lengths"], [seed, row["shard"], row["island"]], capacity)
                for bins in [*(row["members"] or []), *([row["migrant"]] if row["migrant"] else [])]:
                    island.add(np.array(bins, np.int64))
                if not island.members:
                    island.begin()
                island.evolve()
                row["members"] = [b.tolist() for _, b in island.members]
                row["sequences"], row["filled"] = island.members[0][0][0], -island.members[0][0][1]
                yield pa.RecordBatch.from_pylist([{f.name: row[f.name] for f in arrow}], schema=arrow)

    return state.mapInArrow(run, STATE)


def _settled(best: DataFrame, capacity: int, last: bool) -> DataFrame:
    """(_row, length, sequence_id, offset, open) of each shard's best solution; the emptiest bins stay open unless it is the last."""
    schema = "_row long, length long, sequence_id long, offset long, open boolean"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                bins, length, rows = (batch.column(c)[k].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("bins", "lengths", "rows"))
                full = np.bincount(bins, length).astype(np.int64)
                reopened = np.zeros(len(full), bool)
                if not last:
                    n = max(REOPENED_LEAST, int(len(full) * REOPENED))
                    reopened[np.argsort(full, kind="stable")[:n]] = True
                order = np.lexsort((rows, bins))
                bins, length, rows = bins[order], length[order], rows[order]
                first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
                before = np.cumsum(length) - length
                size = np.diff(np.r_[first, len(bins)])
                out = [rows, length, np.repeat(rows[first], size), before - np.repeat(before[first], size), reopened[bins]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], schema=arrow)

    return best.mapInArrow(run, schema)


def packed(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(_row, sequence_id, offset) of items (_row, length): the sequence is named by the least row in it.

    ``_row`` must be unique and lengths lie between 1 and ``capacity``.
    """
    done, level = [], 0
    left = items.select("_row", "length")
    while n := left.count():
        shards = math.ceil(n / SHARD)
        row = F.struct((-F.col("length")).alias("n"), F.col("_row").alias("r"))
        dealt = left.groupBy(F.pmod(F.xxhash64("_row", F.lit(level)), F.lit(shards)).alias("shard")).agg(F.array_sort(F.collect_list(row)).alias("items"))
        state = dealt.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("items.r").alias("rows"),
            F.transform("items", lambda i: (-i.n).cast("int")).alias("lengths"),
            F.lit(None).cast("array<array<int>>").alias("members"), F.lit(None).cast("array<int>").alias("migrant"),
        ).repartition("shard", "island")
        for epoch in range(EPOCHS):
            state = _evolved(state, 1000 * level + epoch, capacity)
            if epoch < EPOCHS - 1:
                # Each island's best solution moves on to the next island.
                stays = F.struct("island", "rows", "lengths", "members", F.lit(None).cast("array<int>").alias("migrant"))
                moves = F.struct(
                    ((F.col("island") + 1) % ISLANDS).alias("island"), F.lit(None).cast("array<long>").alias("rows"), F.lit(None).cast("array<int>").alias("lengths"),
                    F.lit(None).cast("array<array<int>>").alias("members"), F.col("members")[0].alias("migrant"),
                )
                sent = state.select("shard", F.inline(F.array(stays, moves)))
                state = sent.groupBy("shard", "island").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("rows", "lengths", "members", "migrant")])
        # Members are sorted, best first.
        rank = F.struct((-F.col("sequences")).alias("n"), "filled", "island")
        best = state.groupBy("shard").agg(F.max_by(F.struct("rows", "lengths", F.col("members")[0].alias("bins")), rank).alias("b")).select("b.*")
        settled = materialize(_settled(best, capacity, shards == 1), f"level{level}")
        done.append(settled.where("not open").select("_row", "sequence_id", "offset"))
        left, level = settled.where("open"), level + 1
    if not done:
        return items.select("_row", F.col("_row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """(``id_col``, piece, start, length, ids_crc32, sequence_id, offset) of the pieces of every whole text.

    A full piece is a sequence of its own; the sequences of the others are named by the least row in them.
    """
    cut = pieces(docs, path, id_col, text_col, capacity, end)
    full = F.col("length") == capacity
    alone = cut.where(full).withColumn("sequence_id", F.col("_row")).withColumn("offset", F.lit(0).cast("long"))
    rest = cut.where(~full).join(packed(cut.where(~full), capacity), "_row")
    return alone.unionByName(rest).drop("_row")
