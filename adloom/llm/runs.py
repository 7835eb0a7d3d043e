"""Periodic runs of words, found through a grammar.

A slice of texts is compressed by Re-Pair: round by round the pairs of neighbouring symbols that are more frequent than the pairs
they overlap become nonterminals, until no pair occurs twice; what is left of each text is then paired up, so that every text
ends as one symbol. Copies and repeated passages share their nonterminals.

A run lies across the boundary between the two halves of exactly one nonterminal that holds it whole. So the runs across each
nonterminal's boundary are computed once, in its first expansion, and moved to all places where the nonterminal is derived;
the parts of a longer run that smaller nonterminals saw are merged into it. Candidate periods are squares beside the boundary,
tested by fingerprints of prefixes; every run that is kept was compared word by word.

Null and empty texts have no words and no runs. A text is handled whole in one task, whatever its length, in memory of some
hundred bytes a word. Repeated rows give repeated results; ids, also null ones, and further columns are passed through.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import extended, map_text

# Fixed values of the definition: a run has at least this many words and holds its period at least so often.
MIN_LENGTH = 6
MIN_PERIODS = 4
# Period candidates tested at once.
TESTS = 1 << 20


class Grammar(NamedTuple):
    """Symbols below ``terminals`` are words; rules are numbered from there on, children before parents."""

    terminals: int
    left: np.ndarray
    right: np.ndarray
    first: np.ndarray  # Where each rule is first derived.
    rounds: list[int]  # Rules made before each round, and in all.
    size: np.ndarray  # Words below each symbol, words included.
    roots: np.ndarray  # The symbol of each text that has words, and where it starts.
    starts: np.ndarray


def mixed(keys: np.ndarray, salt: int, bits: int) -> np.ndarray:
    """Well spread numbers of some bits."""
    x = (keys.astype(np.uint64) + np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x >> np.uint64(64 - bits)


class RePair:
    """Texts as a sequence of symbols, replaced pair by pair."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray) -> None:
        self.terminals = self.total = int(words.max()) + 1 if len(words) else 0
        self.seq, self.owner, self.at = words.astype(np.int64), np.repeat(np.arange(len(sizes)), sizes), np.arange(len(words))
        self.fresh = np.ones(len(words), bool)  # The pair that begins here may occur twice.
        self.left, self.right, self.first, self.rounds = [], [], [], [0]

    def replace(self, places: np.ndarray, kind: np.ndarray, kinds: int) -> None:
        """Put one new symbol for each kind of pair, at places that do not overlap."""
        head = np.zeros(kinds, np.int64)
        head[kind[::-1]] = places[::-1]
        self.left.append(self.seq[head])
        self.right.append(self.seq[head + 1])
        self.first.append(self.at[head])
        self.seq[places] = self.total + kind
        self.fresh[places] = self.fresh[np.maximum(places - 1, 0)] = True
        keep = np.ones(len(self.seq), bool)
        keep[places + 1] = False
        self.seq, self.owner, self.at, self.fresh = self.seq[keep], self.owner[keep], self.at[keep], self.fresh[keep]
        self.total += kinds
        self.rounds.append(self.total - self.terminals)

    def inner(self) -> np.ndarray:
        """Whether a pair of one text begins at each place."""
        return np.r_[self.owner[1:] == self.owner[:-1], False][: len(self.seq)]

    def compress(self) -> None:
        """Replace pairs that occur twice; of overlapping ones the more frequent, ties by a hash that differs from round to round."""
        for salt in count():
            idx = np.flatnonzero(self.fresh & self.inner())
            if not len(idx):
                return
            key = self.seq[idx] * self.total + self.seq[idx + 1]
            # In a stretch of one symbol every second pair counts.
            again = np.r_[False, (idx[1:] == idx[:-1] + 1) & (key[1:] == key[:-1])]
            n = np.arange(len(idx))
            use = (n - np.maximum.accumulate(np.where(again, 0, n))) % 2 == 0
            idx = idx[use]
            kinds, back, counts = np.unique(key[use], return_inverse=True, return_counts=True)
            self.fresh[idx[counts[back] < 2]] = False
            weight = np.where(counts > 1, counts << 20 | mixed(kinds, salt, 20).astype(np.int64), 0)
            level = np.zeros(len(self.seq) + 2, np.int64)
            level[idx + 1] = weight[back]
            best = (level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])
            chosen = best[idx]
            places, kind = idx[chosen], back[chosen]
            good = np.bincount(kind, minlength=len(kinds)) > 1
            chosen = good[kind]
            if chosen.any():
                self.replace(places[chosen], (np.cumsum(good) - 1)[kind[chosen]], int(good.sum()))

    def join(self) -> None:
        """Pair up the symbols of each text until one is left."""
        while (inner := self.inner()).any():
            n = np.arange(len(self.seq))
            begins = np.r_[True, self.owner[1:] != self.owner[:-1]]
            places = np.flatnonzero(inner & ((n - np.maximum.accumulate(np.where(begins, n, 0))) % 2 == 0))
            self.replace(places, np.arange(len(places)), len(places))


def re_pair(words: np.ndarray, sizes: np.ndarray) -> Grammar:
    """The grammar of texts that lie one after another in ``words``; ``sizes`` holds their numbers of words."""
    g = RePair(words, sizes)
    g.compress()
    g.join()
    empty = [np.zeros(0, np.int64)]
    left, right, first = (np.concatenate(x or empty) for x in (g.left, g.right, g.first))
    size = np.ones(g.total, np.int64)
    for a, b in zip(g.rounds[:-1], g.rounds[1:], strict=True):
        size[g.terminals + a : g.terminals + b] = size[left[a:b]] + size[right[a:b]]
    return Grammar(g.terminals, left, right, first, g.rounds, size, g.seq, g.at)


class Prefixes:
    """Fingerprints of all prefixes: equal stretches have equal fingerprints; the converse is checked where it matters."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        base = np.full(len(words) + 1, 0x9E3779B97F4A7C15, np.uint64)
        base[0] = 1
        self.power = np.multiply.accumulate(base)
        self.sums = np.r_[np.uint64(0), np.add.accumulate(mixed(words, 1, 64) * self.power[:-1])]

    def same(self, i: np.ndarray, k: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from i on look like those from k on; i <= k."""
        return (self.sums[i + n] - self.sums[i]) * self.power[k - i] == self.sums[k + n] - self.sums[k]

    def extent(self, i: np.ndarray, k: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """How many words, at most ``limit``, agree from i and k on, or before them."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(i - mid, k - mid, mid) if back else self.same(i, k, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, … for n[0] numbers, then the same for the next."""
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def squares(p: Prefixes, low: np.ndarray, mid: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(job, period) of the squares that begin at a boundary (even jobs) or end there (odd jobs), by job and period.

    A run that holds its period four times across a boundary has two of them on one side.
    """
    job_mid = np.repeat(mid, 2)
    tests = np.minimum(np.stack([high - mid, mid - low], 1) // 2, ((high - low) // MIN_PERIODS)[:, None]).ravel()
    upto = np.cumsum(tests)
    jobs, periods = [], []
    for t in range(0, int(upto[-1]) if len(upto) else 0, TESTS):
        stop = min(t + TESTS, int(upto[-1]))
        a, b = np.searchsorted(upto, [t, stop - 1], "right")
        part = np.arange(a, b + 1)
        begin = np.maximum(upto[part] - tests[part], t)
        n = np.minimum(upto[part], stop) - begin
        job, q = np.repeat(part, n), ranges(begin - upto[part] + tests[part], n) + 1
        m, ends = job_mid[job], job % 2
        hit = p.words[m - ends] == p.words[m - ends + np.where(ends, -q, q)]
        job, q = job[hit], q[hit]
        s = job_mid[job] - 2 * q * (job % 2)
        hit = p.same(s, s + q, q)
        jobs.append(job[hit])
        periods.append(q[hit])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(jobs or empty), np.concatenate(periods or empty)


def plain_runs(words: np.ndarray, low: int, mid: int, high: int) -> list[tuple[int, int, int]]:
    """The runs across one boundary by comparing words, for the case that fingerprints lied."""
    out = []
    for q in range(1, (high - low) // MIN_PERIODS + 1):
        differ = np.flatnonzero(words[low : high - q] != words[low + q : high]) + low
        for i in {mid, mid - q}:
            if low <= i <= high - q:
                at = np.searchsorted(differ, i)
                begin = int(differ[at - 1]) + 1 if at else low
                end = (int(differ[at]) if at < len(differ) else high - q) + q
                out.append((begin, end, q))
    return [(b, e, q) for b, e, q in set(out) if b < mid < e and e - b >= max(MIN_LENGTH, MIN_PERIODS * q)]


def across(p: Prefixes, low: np.ndarray, mid: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(boundary, begin, end, period) of the runs across boundaries, each as far as its window reaches."""
    job, q = squares(p, low, mid, high)
    found = []
    while len(job):
        head = np.r_[True, job[1:] != job[:-1]]
        b, d = job[head] // 2, q[head]
        i = mid[b] - d * (job[head] % 2)
        k = i + d
        begin, end = i - p.extent(i, k, i - low[b], True), k + p.extent(i, k, high[b] - k, False)
        found.append((b, begin, end, d))
        # A square inside the run found repeats its period (two periods of a stretch of their sum share a divisor).
        reach = np.where(job[head] % 2, mid[b] - begin, end - mid[b])
        left = ~head & (2 * q > np.repeat(reach, np.diff(np.r_[np.flatnonzero(head), len(job)])))
        job, q = job[left], q[left]
    if not found:
        return (np.zeros(0, np.int64),) * 4
    b, begin, end, d = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = (begin < mid[b]) & (end > mid[b]) & (end - begin >= np.maximum(MIN_LENGTH, MIN_PERIODS * d))
    b, begin, end, d = b[keep], begin[keep], end[keep], d[keep]
    lied = [b[k] for k in range(len(b)) if not np.array_equal(p.words[begin[k] : end[k] - d[k]], p.words[begin[k] + d[k] : end[k]])]
    if lied:
        keep = ~np.isin(b, lied)
        true = [(x, *r) for x in sorted(set(map(int, lied))) for r in plain_runs(p.words, int(low[x]), int(mid[x]), int(high[x]))]
        b, begin, end, d = (np.r_[old[keep], np.array([t[j] for t in true], np.int64)] for j, old in enumerate((b, begin, end, d)))
    return b, begin, end, d


def derived(g: Grammar, rule: np.ndarray, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs given relative to their rule, at every place where it is derived."""
    order = np.argsort(rule, kind="stable")
    rule, begin, end, period = rule[order], begin[order], end[order], period[order]
    first = np.searchsorted(rule, np.arange(len(g.left) + 1))
    live = np.zeros(g.terminals + len(g.left), bool)
    live[g.terminals + rule] = True
    for a, b in zip(g.rounds[:-1], g.rounds[1:], strict=True):
        live[g.terminals + a : g.terminals + b] |= live[g.left[a:b]] | live[g.right[a:b]]
    sym, pos = g.roots[live[g.roots]], g.starts[live[g.roots]]
    out = []
    while len(sym):
        r = sym - g.terminals
        n = first[r + 1] - first[r]
        j, base = ranges(first[r], n), np.repeat(pos, n)
        out.append((base + begin[j], base + end[j], period[j]))
        sym, pos = np.r_[g.left[r], g.right[r]], np.r_[pos, pos + g.size[g.left[r]]]
        keep = live[sym]
        sym, pos = sym[keep], pos[keep]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (begin[:0], end[:0], period[:0])


def merged(begin: np.ndarray, end: np.ndarray, period: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals under their smallest period, by begin and period.

    Two runs of one period share less than a period, so intervals of one period that share more are parts of one run.
    """
    if not len(begin):
        return begin, end, period
    order = np.lexsort((begin, period))
    begin, end, period = begin[order], end[order], period[order]
    shift = np.cumsum(np.r_[0, period[1:] != period[:-1]]) * (width + 1)
    reach = np.maximum.accumulate(end + shift)
    first = np.flatnonzero(np.r_[True, begin[1:] + shift[1:] + period[1:] > reach[:-1]])
    begin, end, period = begin[first], np.maximum.reduceat(end, first), period[first]
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    least = np.r_[True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])]
    begin, end, period = begin[least], end[least], period[least]
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def runs_of(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, period) of the runs of all texts, which lie one after another in ``words``."""
    g = re_pair(words, sizes)
    rules = np.flatnonzero(g.size[g.terminals :] >= MIN_LENGTH)
    low = g.first[rules]
    mid, high = low + g.size[g.left[rules]], low + g.size[g.terminals + rules]
    b, begin, end, period = across(Prefixes(words), low, mid, high)
    return merged(*derived(g, rules[b], begin - low[b], end - low[b], period), len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words between white space, which is the blank and the characters 9 to 13, as UTF-8."""
    return text.encode().split() if text else []


def find(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but the text), ``runs`` array<struct<start, length, period>> in words, by start and
    period, and ``collapsed``: the words, with single blanks, that no run holds beyond its first period.

    Columns of ``docs`` named ``runs`` or ``collapsed`` must not be kept.
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep

    def run(batch: pa.RecordBatch) -> dict:
        texts = [words_of(t) for t in batch.column(text_col).to_pylist()]
        numbers: dict[bytes, int] = defaultdict(count().__next__)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        words = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(sizes.sum()))
        begin, end, period = runs_of(words, sizes)
        offsets = np.r_[0, np.cumsum(sizes)]
        cuts = np.searchsorted(begin, offsets)
        owner = np.repeat(offsets[:-1], np.diff(cuts))
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, begin + period, 1)
        np.add.at(change, end, -1)
        dropped = np.cumsum(change)[:-1] > 0
        collapsed = []
        for d, t in enumerate(texts):
            if cuts[d] < cuts[d + 1]:
                t = [w for w, gone in zip(t, dropped[offsets[d] : offsets[d + 1]].tolist(), strict=True) if not gone]
            collapsed.append(b" ".join(t).decode())
        rows = pa.StructArray.from_arrays([pa.array(x) for x in (begin - owner, end - begin, period)], ["start", "length", "period"])
        return {**{c: batch.column(c) for c in keep}, "runs": pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), rows), "collapsed": collapsed}

    schema = extended(docs, keep, "runs array<struct<start: long, length: long, period: long>>, collapsed string")
    narrow = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    return map_text(narrow, text_col, run, schema)
