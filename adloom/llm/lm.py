"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a bigram model over lower-cased words and a mark that both begins and ends a text. With c(.) the counts of the
training texts, N all their tokens, V their distinct ones, and s(u) the number of different successors of u:

    P(w | u) = (c(u, w) - D) / c(u)          if u was followed by w,
               D s(u) / c(u) * P(w)          if u is known but was not,
               P(w)                          if u is unknown;
    P(w)     = (c(w) - D) / N, and D V / N for all unknown words together.

What falls back on P(w) is not raised by the share that known successors already have, so the probabilities sum to one or less.

Every word with its successor goes, once, to the shard of the word, as packed arrays. There the training pairs become a trie
(see ``elias_fano``) of counts and quantised logarithms, and all pairs are looked up in it. Only pairs of the second kind go on, to
the shard of their second word, which keeps the level of single words. Sums return to the slice of documents they came from.

No table of the whole corpus exists anywhere: a shard holds about ``SHARD_BYTES`` of text, and their number grows with the
input. A word so common that it would swell one shard is spread by its successor; its totals are added up afterwards. Such words
are picked from a hundredth of the documents, at most ``HOT`` of them; the choice moves work, not results.

Words are known by 48 bits of their hash: V distinct words share a hash about V^2 / 2^49 times. Null texts are empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType, _parse_datatype_string

from adloom.llm.common import slices
from adloom.llm.elias_fano import EliasFano, Trie, restore
from adloom.session import materialize, shuffle_partitions

D = 0.75
HASH_BITS = 48
HOT = 200
SHARD_BYTES = 10 << 20
SLICE_BYTES = 4 << 20
SLICE_ROWS = 1 << 15
SHIFT = 12.0
MARK = 0  # begins and ends every text
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLANKS = r"[\x20\x09-\x0D]+"

# Rows that travel: kind, the shard they go to, the slice of documents they belong to, and packed arrays.
DOCS, PAIRS, SUMS, WORDS, TOTALS, BACK = range(6)
PARTS = ["a", "b", "c", "d", "e"]
ROW = StructType([StructField("kind", IntegerType()), StructField("shard", IntegerType()), StructField("slice", LongType()), *(StructField(p, BinaryType()) for p in PARTS)])
ARROW = to_arrow_schema(ROW)


def row(kind: int, shard: int, slice_: int, *parts: np.ndarray | bytes) -> tuple:
    data = [p if isinstance(p, bytes) else p.tobytes() for p in parts]
    return (kind, shard, slice_, *data, *[None] * (len(PARTS) - len(data)))


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = (xxhash.xxh64_intdigest(word) >> (64 - HASH_BITS)) or 1
        return h


def tokens(text: str, memory: Hashes) -> list[int]:
    return [memory[w] for w in text.encode("utf-8", "replace").translate(LOWER).split()]


def narrow(h: np.ndarray) -> bytes:
    """Six bytes a hash."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def widen(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    mixed = h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def runs(sorted_: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(sorted_) else np.zeros(0, np.int64)


def send(docs: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    """Pairs of all documents, packed by slice and shard, and a row of each slice's documents."""

    def rows_of(part: pa.RecordBatch, slice_: int) -> list[tuple]:
        memory, train = Hashes(), part.column("_train").to_numpy(zero_copy_only=False)
        words = [tokens(t, memory) for t in part.column("_text").to_pylist()]
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        seq = np.fromiter((h for t in words for h in (MARK, *t)), np.uint64, int(sizes.sum()))
        ends = np.cumsum(sizes) - 1
        after = np.r_[seq[1:], np.zeros(1, np.uint64)]
        after[ends] = MARK
        doc = np.repeat(np.arange(len(words)), sizes)
        at = np.searchsorted(hot, seq)
        at[at == len(hot)] = 0
        common = hot[at] == seq if len(hot) else np.zeros(len(seq), bool)
        # Occurrences of common words by document: their totals are only known later.
        kinds, times = np.unique(doc[common] * 256 + at[common], return_counts=True)
        out = [row(DOCS, slice_ % shards, slice_, sizes.astype("<i8"), kinds.astype("<i8"), times.astype("<i8"))]
        to = shard_of(np.where(common, seq * np.uint64(31) + after, seq), shards)
        order = np.lexsort((after, seq, to))
        seq, after, to = seq[order], after[order], to[order]
        mine = (doc[order] * 2 + train[doc[order]]).astype("<u2")
        cut = np.r_[runs(to), len(to)]
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            first = runs(seq[s:e])
            length = np.diff(np.r_[first, e - s])
            out.append(row(PAIRS, int(to[s]), slice_, narrow(seq[s:e][first]), length.astype("<u4"), narrow(after[s:e]), mine[s:e]))
        return out

    fields = [StructField("_keep", docs.schema["_keep"].dataType), *ROW.fields]
    schema = StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_ = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                for k in range(0, part.num_rows, SLICE_ROWS):
                    few = part.slice(k, SLICE_ROWS)
                    rows = batch_of(rows_of(few, slice_))
                    kept = pa.array([[x[0] for x in few.column("_keep").to_pylist()], *[None] * (rows.num_rows - 1)], arrow[0].type)
                    yield pa.RecordBatch.from_arrays([kept, *rows.columns], schema=arrow)
                    slice_ += 1

    return docs.mapInArrow(run, schema)


def look_up(pairs: list[tuple], hot: np.ndarray, shard: int, shards: int) -> list[tuple]:
    """Build the shard's trie from its training pairs and look all its pairs up."""
    if not pairs:
        return []
    lengths = [np.frombuffer(p[1], "<u4") for p in pairs]
    u = np.concatenate([np.repeat(widen(p[0]), n) for p, n in zip(pairs, lengths, strict=True)])
    w = np.concatenate([widen(p[2]) for p in pairs])
    mine = np.concatenate([np.frombuffer(p[3], "<u2") for p in pairs])
    of = np.repeat(np.arange(len(pairs)), [int(n.sum()) for n in lengths])
    order = np.lexsort((w, u))
    u, w, mine, of = u[order], w[order], mine[order], of[order]
    train = (mine & 1).astype(bool)
    first = np.r_[True, (u[1:] != u[:-1]) | (w[1:] != w[:-1])]
    pair = np.cumsum(first) - 1
    begins = np.flatnonzero(first)
    pu, pw = u[begins], w[begins]
    c_pair = np.bincount(pair[train], minlength=len(begins))
    word_at = runs(pu)
    word = np.repeat(np.arange(len(word_at)), np.diff(np.r_[word_at, len(pu)]))
    c_word = np.bincount(word, weights=c_pair, minlength=len(word_at)).astype(np.int64)
    next_ = np.bincount(word, weights=c_pair > 0, minlength=len(word_at)).astype(np.int64)
    words = pu[word_at]
    at = np.searchsorted(hot, words)
    at[at == len(hot)] = 0
    common = hot[at] == words if len(hot) else np.zeros(len(words), bool)
    seen = c_pair > 0
    # Common words' totals come later; until then their logarithms are relative to 10^SHIFT, to fit the range of the codes.
    whole = np.where(common[word[seen]], SHIFT, np.log10(np.maximum(1, c_word[word[seen]])))
    trie = Trie.of(pu[seen], pw[seen], np.log10(c_pair[seen] - D) - whole, HASH_BITS)
    place = trie.find(pu, pw)
    hit = place >= 0
    value = np.zeros(len(pu))
    value[hit] = restore(trie.codes[place[hit]])
    value[common[word] & hit] += SHIFT
    fall = ~hit & (c_word[word] > 0) & ~common[word]
    value[fall] = np.log10(D * next_[word[fall]] / c_word[word[fall]])
    base = np.where(common, 0.0, np.log10(c_word + 1.0))
    known = (c_word > 0) & ~common
    out = []
    out.append(row(WORDS, shard, 0, EliasFano.of(words[known], 1 << HASH_BITS).dump(), c_word[known].astype("<i8")))
    if common.any():
        out.append(row(TOTALS, shard, 0, at[common].astype("<i8"), c_word[common].astype("<i8"), next_[common].astype("<i8")))
    # Sums per document of each slice.
    doc = (mine >> 1).astype(np.int64)
    by = np.lexsort((doc, of))
    pair, of, doc = pair[by], of[by], doc[by]
    group = runs(of * SLICE_ROWS + doc)
    if len(group):
        k = word[pair]
        sums = [np.add.reduceat(x, group) for x in (base[k], known[k].astype(np.int64), value[pair])]
        cut = np.r_[runs(of[group]), len(group)]
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            out.append(row(SUMS, 0, pairs[of[group[s]]][4], doc[group[s:e]].astype("<u2"), sums[0][s:e].astype("<f8"), sums[1][s:e].astype("<u4"), sums[2][s:e].astype("<f4")))
    # Pairs that fall back go to the shard of their second word, with the common word before them, if it is one.
    gone = np.flatnonzero(~hit[pair])
    if len(gone):
        target = pw[pair[gone]]
        before = np.where(common[word[pair[gone]]], at[word[pair[gone]]], 255).astype(np.uint8)
        to = shard_of(target, shards)
        by = np.lexsort((of[gone], to))
        gone, target, before, to = gone[by], target[by], before[by], to[by]
        cut = np.r_[runs(to), len(gone)]
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            begin = runs(of[gone[s:e]])
            from_ = np.array([pairs[k][4] for k in of[gone[s:e]][begin].tolist()], "<i8")
            length = np.diff(np.r_[begin, e - s]).astype("<u4")
            out.append(row(BACK, int(to[s]), 0, narrow(target[s:e]), doc[gone[s:e]].astype("<u2"), before[s:e], from_, length))
    return out


def fall_back(words: tuple | None, back: list[tuple], hot: np.ndarray, totals: np.ndarray, n: int, v: int) -> list[tuple]:
    """log10 P(w) of pairs that fell back, plus log10(D s(u)) where the word before is common: sums per slice and document."""
    level, counts = (EliasFano.load(words[0]), np.frombuffer(words[1], "<i8")) if words else (None, np.zeros(0, np.int64))
    unknown = np.log10(D * max(1, v) / max(1, n)) if v else 0.0
    extra = np.r_[np.log10(np.maximum(D * totals[:, 1], 1e-300)), np.zeros(256 - len(totals))]
    extra[: len(totals)][totals[:, 0] == 0] = 0.0
    kinds, which = np.unique(np.concatenate([widen(r[0]) for r in back]), return_inverse=True)
    doc, before = (np.concatenate([np.frombuffer(r[k], t) for r in back]) for k, t in ((1, "<u2"), (2, np.uint8)))
    slice_ = np.concatenate([np.repeat(np.frombuffer(r[3], "<i8"), np.frombuffer(r[4], "<u4")) for r in back])
    c = np.zeros(len(kinds))
    if level is not None and level.n:
        at = level.find(kinds)
        c[at >= 0] = counts[at[at >= 0]]
    if len(hot):
        at = np.minimum(np.searchsorted(hot, kinds), len(hot) - 1)
        c = np.where(hot[at] == kinds, totals[at, 0], c)
    log = np.where(c > 0, np.log10(np.maximum(c - D, 1e-9) / max(1, n)), unknown)[which] + extra[before]
    by = np.lexsort((doc, slice_))
    doc, slice_, log = doc[by], slice_[by], log[by]
    group = np.flatnonzero(np.r_[True, (slice_[1:] != slice_[:-1]) | (doc[1:] != doc[:-1])])
    sums = np.add.reduceat(log, group).astype("<f4")
    cut = np.r_[runs(slice_[group]), len(group)]
    ends = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
    return [row(SUMS, 0, int(slice_[group[s]]), doc[group[s:e]].astype("<u2"), b"", b"", sums[s:e]) for s, e in ends]


def gather(docs_row: tuple, sums: list[tuple], totals: np.ndarray, n: int, v: int) -> tuple[np.ndarray, ...]:
    """Numbers of tokens and of known tokens, base score and score of one slice's documents."""
    sizes, kinds, times = (np.frombuffer(docs_row[k], "<i8") for k in range(3))
    base, score, known = np.zeros(len(sizes)), np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
    for a, b, c, d in sums:
        doc = np.frombuffer(a, "<u2")
        score[doc] += np.frombuffer(d, "<f4")
        if b:
            base[doc] += np.frombuffer(b, "<f8")
            known[doc] += np.frombuffer(c, "<u4")
    doc, which = kinds // 256, kinds % 256
    if len(kinds):
        count = totals[which, 0]
        np.add.at(base, doc, times * np.log10(count + 1.0))
        np.add.at(known, doc, times * (count > 0))
        np.add.at(score, doc, -times * np.log10(np.maximum(count, 1.0)))
    return sizes, known, base - sizes * np.log10(n + v + 1.0), score


def _by_shard(rows: DataFrame, n: int, order: list[str], fn, schema: StructType) -> DataFrame:
    return rows.repartitionById(n, F.col("shard")).sortWithinPartitions(*order).mapInArrow(fn, schema)


def hot_words(docs: DataFrame, shards: int) -> np.ndarray:
    """Hashes of words that make up more than a quarter of a shard, from a hundredth of the documents."""
    few = docs.where(F.pmod(F.xxhash64("_text"), F.lit(100)) == 0)
    lower = F.translate("_text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = few.select(F.explode(F.split(lower, BLANKS)).alias("w")).where("w <> ''").groupBy("w").count()
    total = words.agg(F.sum("count")).first()[0] or 0
    top = words.where(F.col("count") * 4 * shards > total).orderBy(F.desc("count"), "w").limit(HOT).collect()
    memory = Hashes()
    found = [memory[r[0].encode("utf-8", "replace")] for r in top]
    return np.unique(np.array([MARK, *found], np.uint64))


def score(docs: DataFrame, train: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of every row with n_tokens, n_known, train_tokens, base_score and score.

    The model is learned from the rows for which the SQL condition ``train`` holds; a null counts as false.
    """
    spark = docs.sparkSession
    keep = keep or [c for c in docs.columns if c != text]
    body = F.coalesce(F.col(text), F.lit(""))
    frame = docs.select(F.struct(*keep).alias("_keep"), F.coalesce(F.expr(train), F.lit(False)).alias("_train"), body.alias("_text"))
    size = frame.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    shards = max(1, shuffle_partitions(spark), -(-size // SHARD_BYTES))
    hot = hot_words(frame, shards)
    sent = send(_listed(frame), hot, shards)
    carried = StructType([sent.schema["_keep"], *ROW.fields])
    arrow = to_arrow_schema(carried)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, shard = [], 0
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            docs_ = batch.filter(pa.array(kinds == DOCS))
            if docs_.num_rows:
                yield docs_
            rest = batch.filter(pa.array(kinds == PAIRS))
            if rest.num_rows:
                shard = rest.column("shard")[0].as_py()
                pairs += zip(*[rest.column(p).to_pylist() for p in PARTS[:4]], rest.column("slice").to_pylist(), strict=True)
        for part in _chunks(look_up(pairs, hot, shard, shards)):
            rows = batch_of(part)
            yield pa.RecordBatch.from_arrays([pa.nulls(rows.num_rows, arrow[0].type), *rows.columns], schema=arrow)

    one = materialize(_by_shard(sent, shards, ["shard", "kind", "slice"], first, carried), "lm-shards")

    # One small row a shard: its tokens and distinct words. Totals of common words: at most HOT + 1 rows a shard.
    counted = one.where(F.col("kind").isin(WORDS, TOTALS)).select("kind", "a", "b", "c")
    totals, n, v = _totals(counted, hot)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, back = None, []
        for batch in batches:
            for kind, *parts in zip(*[batch.column(x).to_pylist() for x in ("kind", *PARTS)], strict=True):
                if kind == WORDS:
                    words = (parts[0], parts[1])
                else:
                    back.append(parts)
        if back:
            for part in _chunks(fall_back(words, back, hot, totals, n, v)):
                yield batch_of(part)

    lower = _by_shard(one.where(F.col("kind").isin(WORDS, BACK)).drop("_keep"), shards, ["shard", "kind", "slice"], second, ROW)
    sums = one.where(F.col("kind").isin(DOCS, SUMS)).unionByName(lower, allowMissingColumns=True)
    kept = [f for f in sent.schema["_keep"].dataType.elementType.fields]
    result = StructType([*kept, *_parse_datatype_string("n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])
    out_arrow = to_arrow_schema(result)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                sizes, known, base, total = gather(held["docs"], held["sums"], totals, n, v)
                cols = [[r[f.name] for r in held["keep"]] for f in kept]
                data = [*cols, sizes, known, np.full(len(sizes), n), base, total]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(data, out_arrow, strict=True)], schema=out_arrow)

        for batch in batches:
            for kind, slice_, keep_, *parts in zip(*[batch.column(x).to_pylist() for x in ("kind", "slice", "_keep", *PARTS[:4])], strict=True):
                if kind == DOCS:
                    yield from done()
                    held = {"slice": slice_, "docs": parts, "keep": keep_, "sums": []}
                else:
                    held["sums"].append(parts)
        yield from done()

    return sums.repartition(shards, "slice").sortWithinPartitions("slice", "kind").mapInArrow(last, result)


def _listed(frame: DataFrame) -> DataFrame:
    """``_keep`` as a list of one struct in the schema only: a slice's rows travel as one list."""
    return frame.select(F.array("_keep").alias("_keep"), "_train", "_text")


def _chunks(rows: list[tuple], most: int = 200) -> Iterator[list[tuple]]:
    for k in range(0, len(rows), most):
        yield rows[k : k + most]


def _totals(counted: DataFrame, hot: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Counts and numbers of successors of common words, all tokens, and all distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for kind, a, b, c in zip(*[batch.column(x).to_pylist() for x in ("kind", "a", "b", "c")], strict=True):
                if kind == WORDS:
                    counts = np.frombuffer(b, "<i8")
                    out.append((-1, int(counts.sum()), len(counts)))
                else:
                    out += zip(*(np.frombuffer(x, "<i8").tolist() for x in (a, b, c)), strict=True)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["which", "n", "m"])

    rows = counted.mapInArrow(run, "which long, n long, m long").groupBy("which").agg(F.sum("n"), F.sum("m")).collect()
    totals = np.zeros((max(1, len(hot)), 2))
    n = v = 0
    for which, count, more in rows:
        if which < 0:
            n, v = n + count, v + more
        else:
            totals[which] = count, more
            n, v = n + count, v + (count > 0)
    return totals, int(n), int(v)
