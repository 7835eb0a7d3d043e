"""Toxic passages by maximum-scoring segments.

A token's score is its log-odds of occurring in toxic and in other labelled texts, under a Dirichlet prior whose means are its
share of both; tokens whose rate is not surely raised lower a sum a little. Each word is seen as itself and as its leading four
to eight letters; of the forms whose rates surely differ, by likelihood ratio, the one of highest log-odds speaks for the word.
Sums of scores rise only where toxic words lie close; one scan of linear time finds every segment of maximal sum. A segment is
significant if sums as high are rare in clean texts of the same length: the largest sum of a clean text follows an extreme-value
law, whose rate and size are fitted on the clean texts of the sample. The score of a text is one minus the chance that a clean
text of its length holds a segment as high, set to be 0.5 where the fitted texts are best parted.

Fitted on at most about ``per_label`` texts of each label (see ``fitting.label_sample``). Null and empty texts hold no
segment and score as the lowest.
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
from adloom.llm.fitting import label_sample, usable_text
from adloom.session import materialize

WORD = re.compile(r"[^\W\d_]+")
STEMS = range(4, 9)
PRIOR = 20.0  # weight of the prior, in texts
SURE = 4.5  # root of the likelihood ratio from which a form's log-odds count as raised
DRIFT = -0.05  # score of a word that no form speaks for
KEEP = 200_000  # forms kept at most, the surest first
SCAN = 1 << 20  # words scored at once


class Model(NamedTuple):
    weights: dict[str, float]
    rate: float
    size: float
    middle: float  # log of the expected number of segments as high, at the parting


def forms(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in STEMS if len(word) >= n)]


def log_odds(n1: np.ndarray, n0: np.ndarray, t1: float, t0: float) -> np.ndarray:
    """Log-odds under the prior."""
    prior = PRIOR * (n1 + n0) / (t1 + t0)
    odds = lambda n, t: np.log((n + prior) / np.maximum(t + PRIOR - n - prior, 0.5))
    return odds(n1, t1) - odds(n0, t0)


def sureness(n1: np.ndarray, n0: np.ndarray, t1: float, t0: float) -> np.ndarray:
    """Root of the likelihood ratio between own and equal rates, negative where toxic texts have the lower rate."""
    expected = (n1 + n0) * t1 / (t1 + t0)
    part = lambda n, e: n * np.log(np.maximum(n, 1e-9) / e)
    ratio = 2 * (part(n1, expected) + part(n0, n1 + n0 - expected))
    return np.sign(n1 - expected) * np.sqrt(np.maximum(ratio, 0))


def segments(at: np.ndarray, gains: np.ndarray, base: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of a sequence: (first, last, sum), as indexes of the given rising places.

    ``gains`` are the positive scores, ``base`` the sum of all scores before each. The scan keeps a stack of segments with
    the sums before (low) and after (high) them; a new one joins back to the nearest earlier segment of lower low while its
    own high is higher. Each segment joins once, so the time is linear.
    """
    stack: list[list] = []
    for i, (gain, low) in enumerate(zip(gains.tolist(), base.tolist(), strict=True)):
        seg = [i, i, low, low + gain, -1]
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= seg[2]:
                j = stack[j][4]
            seg[4] = j
            if j < 0 or stack[j][3] >= seg[3]:
                stack.append(seg)
                break
            seg[0], seg[2] = stack[j][0], stack[j][2]
            del stack[j:]
            j -= 1
    return [(s[0], s[1], s[3] - s[2]) for s in stack]


def passages(text: str, memory: Memory) -> tuple[list[tuple[int, int, float]], int]:
    """Maximal segments as (first word, last word, sum), and the number of words."""
    words = WORD.findall(text.lower())
    scores = np.fromiter(map(memory.__getitem__, words), float, len(words))
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return [], len(words)
    base = (np.cumsum(scores) - scores)[at]
    return [(int(at[a]), int(at[b]), s) for a, b, s in segments(at, scores[at], base)], len(words)


class Memory(dict):
    """Score of a word, worked out on its first use."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > KEEP:
            self.clear()
        found = [w for f in forms(word) if (w := self.weights.get(f)) is not None]
        self[word] = score = max(found, key=abs) if found else DRIFT
        return score


def count_forms(sample: DataFrame, text: str, label: str) -> DataFrame:
    """Number of texts of each label that hold a form: a text that repeats a word says no more than once."""

    def run(batch: pa.RecordBatch) -> dict:
        counts: dict[str, list[int]] = {}
        for t, y in zip(batch.column(text).to_pylist(), batch.column(label).to_pylist(), strict=True):
            for f in {f for w in set(WORD.findall(t.lower())) for f in forms(w)}:
                counts.setdefault(f, [0, 0])[y] += 1
        return {"form": list(counts), "n0": [c[0] for c in counts.values()], "n1": [c[1] for c in counts.values()]}

    return map_text(sample.select(text, label), text, run, "form string, n0 long, n1 long").groupBy("form").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", id_col: str = "doc_id", per_label: int = 4000) -> Model:
    """Learn from about ``per_label`` labelled documents of each label; labels other than 0 and 1 take no part.

    The labels are sampled by id before they meet the documents, so only about twice ``per_label`` ids are broadcast and no
    text is shuffled but the sample's. Equal texts are learned once, as toxic if at least half of their labels say so.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label")).where("_label in (0, 1) and _id is not null")
    ids = label_sample(known.distinct(), "_id", "_label", per_label, 2)
    texts = docs.where(usable_text(text)).select(F.col(id_col).alias("_id"), F.col(text).alias(text))
    sample = texts.join(F.broadcast(ids), "_id").groupBy(text).agg((F.avg("_label") >= 0.5).cast("int").alias(label))
    sample = materialize(sample, "toxicity-sample")
    totals = dict(sample.groupBy(label).count().collect())
    t1, t0 = totals.get(1, 0) + 1.0, totals.get(0, 0) + 1.0
    # Only forms with a raised rate can count, so only they come to the driver: bounded by the sample.
    counts = count_forms(sample, text, label).where((F.col("n1") >= 3) & (F.col("n1") * t0 > F.col("n0") * t1)).toPandas()
    weights: dict[str, float] = {}
    if len(counts):
        n1, n0 = counts["n1"].to_numpy(float), counts["n0"].to_numpy(float)
        odds, sure = log_odds(n1, n0, t1, t0), sureness(n1, n0, t1, t0)
        best = sorted(np.flatnonzero(sure >= SURE), key=lambda i: (-sure[i], counts["form"][i]))[:KEEP]
        weights = {counts["form"][i]: float(odds[i]) for i in best}
    tops = highest(sample, text, label, weights)
    return calibrate(weights, *tops)


def highest(sample: DataFrame, text: str, label: str, weights: dict[str, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Highest segment sum, number of words and label of each sampled text."""
    shared = sample.sparkSession.sparkContext.broadcast(weights)

    def run(batch: pa.RecordBatch) -> dict:
        memory = Memory(shared.value)
        found = [passages(t, memory) for t in batch.column(text).to_pylist()]
        return {"top": [max((s for _, _, s in p), default=0.0) for p, _ in found], "words": [n for _, n in found], "y": batch.column(label)}

    rows = map_text(sample.select(text, label), text, run, "top double, words long, y int").toPandas()
    return rows["top"].to_numpy(float), rows["words"].to_numpy(float), rows["y"].to_numpy(int)


def calibrate(weights: dict[str, float], top: np.ndarray, words: np.ndarray, y: np.ndarray) -> Model:
    """Extreme-value law of clean texts: P(top >= x) = 1 - exp(-size * words * exp(-rate * x))."""
    clean = top[(y == 0) & (top > 0)]
    rate = 1.0
    if len(clean) > 1 and clean.std() > 0:
        rate = float(min(5.0, np.pi / (np.sqrt(6) * clean.std())))
    lengths = words[(y == 0) & (top > 0)]
    size = float(1 / np.mean(lengths * np.exp(-rate * clean))) if len(clean) else 1e-3
    expected = np.log(size) + np.log(np.maximum(words, 1)) - rate * top
    middle = 0.0
    if (y == 1).any() and (y == 0).any():
        order = np.argsort(expected, kind="stable")
        e, t = expected[order], y[order]
        # Classes weigh alike; the parting lies midway in the widest of the best gaps.
        gain = np.cumsum(np.where(t == 1, 1 / (y == 1).sum(), -1 / (y == 0).sum()))
        last = np.r_[e[1:] > e[:-1], False]
        if last.any():
            best = gain[last].max()
            k = max(np.flatnonzero(last & (gain >= best - 1e-12)), key=lambda i: e[i + 1] - e[i])
            middle = float((e[k] + e[k + 1]) / 2)
    return Model(weights, rate, size, middle)


def chance(model: Model, top: float, words: int) -> float:
    """Score from the expected number of clean segments as high: 0.5 at the parting."""
    expected = np.log(model.size) + np.log(max(words, 1)) - model.rate * top
    return float(-np.expm1(-np.log(2) * np.exp(min(50.0, model.middle - expected)))) if top > 0 else 0.0


@lru_cache(maxsize=1)
def _memory(holder) -> tuple[Model, Memory]:
    model = Model(*holder.value)
    return model, Memory(model.weights)


def score(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``passages`` (first word, last word, sum, score) of every whole text.

    A passage is reported if it alone would make its text toxic. Columns of the added names are replaced.
    """
    holder = docs.sparkSession.sparkContext.broadcast(tuple(model))  # at most KEEP forms
    added = "score double, predicted int, passages array<struct<first:int,last:int,sum:double,score:double>>"
    others = [c for c in docs.columns if (keep_text or c != text) and c not in ("score", "predicted", "passages")]

    def run(batch: pa.RecordBatch) -> dict:
        fitted, memory = _memory(holder)
        scores, found = [], []
        for t in batch.column(text).to_pylist():
            segs, n = passages(t, memory) if t else ([], 0)
            rated = [(a, b, s, chance(fitted, s, n)) for a, b, s in segs]
            scores.append(max((r[3] for r in rated), default=0.0))
            found.append([{"first": a, "last": b, "sum": s, "score": p} for a, b, s, p in rated if p >= 0.5])
        return {c: batch.column(c) for c in others} | {"score": scores, "predicted": [int(s >= 0.5) for s in scores], "passages": found}

    return map_text(docs, text, run, extended(docs, others, added))
