"""Language identification by prediction with partial matching.

Each language has a tree of byte contexts of length 0 to 3, filled once and then frozen. A byte costs its code length: where
its context of three bytes has met it, log2((total + kinds) / count); else the escape log2((total + kinds) / kinds) and the
cost in the context shortened by its oldest byte, down to equal shares of all codes. The language with the shortest code wins.

The trees of all languages are stored as tables: costs of every (byte, two bytes before), escapes of every three bytes, and
costs of the four-byte strings that some language has met. Scoring a byte is then one or two look-ups for all languages.

Bytes are those of the lower-cased UTF-8 text. The 63 commonest of the sample have codes of their own; all others share one.
Fitted on at most about ``per_lang`` documents a language (see ``fitting.label_sample``). Null texts and texts without a letter
are ``und`` with score 0; so are all texts if nothing could be learned.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import extended, map_text
from adloom.llm.fitting import label_sample, usable_text

LETTER = regex.compile(r"\p{L}")
CODES, BITS = 64, 6
DEPTH = 3
# Bytes of evidence that the reported probability rests on at most; the decision uses the whole text.
EVIDENCE = 40
CHUNK = 1 << 20


class Trees(NamedTuple):
    languages: list[str]
    code_of: np.ndarray  # code of each byte
    row_of: np.ndarray  # row in ``costs`` of each string of four codes, 0 if no language has met it
    costs: np.ndarray  # cost of the last code of such a string, per language
    escapes: np.ndarray  # escape of each context of three codes, per language
    short: np.ndarray  # cost of the last of three codes, per language


def codes(text: str, code_of: np.ndarray) -> np.ndarray:
    """Codes of a text with three blanks before it, the context of its first byte."""
    return code_of[np.frombuffer(b"   " + text.lower().encode("utf-8", "replace"), np.uint8)]


def strings(seq: np.ndarray, n: int) -> np.ndarray:
    """The number of each run of ``n`` codes that ends at a byte of the text."""
    out = np.zeros(len(seq) - DEPTH, np.int32)
    for k in range(n):
        first = DEPTH - n + 1 + k
        out = (out << BITS) | seq[first : first + len(out)]
    return out


def count_strings(sample: DataFrame, text: str, lang: str, code_of: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Counts of strings of four codes per language."""

    def run(batch: pa.RecordBatch) -> dict:
        found: dict[str, list[np.ndarray]] = {}
        for t, g in zip(batch.column("_text").to_pylist(), batch.column("_lang").to_pylist(), strict=True):
            found.setdefault(g, []).append(strings(codes(t, code_of), DEPTH + 1))
        rows = [(g, *np.unique(np.concatenate(parts), return_counts=True)) for g, parts in found.items()]
        return {
            "lang": np.repeat([r[0] for r in rows], [len(r[1]) for r in rows]).tolist(),
            "string": np.concatenate([r[1] for r in rows]), "n": np.concatenate([r[2] for r in rows]),
        }

    narrow = sample.select(F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    counts = map_text(narrow, "_text", run, "lang string, string int, n long").groupBy("lang", "string").agg(F.sum("n").alias("n"))
    rows = counts.toPandas().sort_values(["lang", "string"])  # bounded by the sample
    return {g: (p["string"].to_numpy(np.int64), p["n"].to_numpy(np.int64)) for g, p in rows.groupby("lang")}


def byte_codes(sample: DataFrame, text: str) -> np.ndarray:
    def run(batch: pa.RecordBatch) -> dict:
        joined = "".join(batch.column("_text").to_pylist()).lower().encode("utf-8", "replace")
        n = np.bincount(np.frombuffer(joined, np.uint8), minlength=256)
        return {"byte": np.arange(256), "n": n}

    rows = map_text(sample.select(F.col(text).alias("_text")), "_text", run, "byte int, n long")
    counts = {r[0]: r[1] for r in rows.groupBy("byte").agg(F.sum("n")).collect()}
    common = sorted((b for b in counts if counts[b]), key=lambda b: (-counts[b], b))[: CODES - 1]
    code_of = np.full(256, CODES - 1, np.int32)
    code_of[common] = np.arange(len(common))
    return code_of


def grow(counts: dict[str, tuple[np.ndarray, np.ndarray]], code_of: np.ndarray) -> Trees:
    """Frozen trees from the counts of four-code strings; shorter contexts are sums over their oldest byte."""
    languages = sorted(counts)
    met = np.unique(np.concatenate([c[0] for c in counts.values()])) if counts else np.zeros(0, np.int64)
    row_of = np.zeros(CODES ** (DEPTH + 1), np.int32)
    row_of[met] = np.arange(1, len(met) + 1)
    costs = np.zeros((len(met) + 1, len(languages)), np.float32)
    escapes = np.zeros((CODES**DEPTH, len(languages)), np.float32)
    short = np.zeros((CODES**DEPTH, len(languages)), np.float32)
    for k, g in enumerate(languages):
        strings_, n = counts[g]
        cost = np.full(CODES, float(BITS))
        for order in range(DEPTH):
            dense = np.bincount(strings_ % CODES ** (order + 1), weights=n, minlength=CODES ** (order + 1)).reshape(-1, CODES)
            cost = dense_cost(dense, cost)
        short[:, k] = cost.ravel()
        context = strings_ // CODES
        total = np.bincount(context, weights=n, minlength=CODES**DEPTH)
        kinds = np.bincount(context, minlength=CODES**DEPTH)
        with np.errstate(divide="ignore", invalid="ignore"):
            escapes[:, k] = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
        costs[1:, k] = escapes[met // CODES, k] + short[met % CODES**DEPTH, k]
        costs[row_of[strings_], k] = np.log2((total + kinds)[context] / n)
    return Trees(languages, code_of, row_of, costs, escapes, short)


def dense_cost(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Cost of each code in each context, given the costs in the contexts one shorter."""
    total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    below = np.tile(shorter.reshape(-1, CODES), (max(1, counts.shape[0] // max(1, shorter.size // CODES)), 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
        return np.where(counts > 0, np.log2((total + kinds) / counts), escape + below)


def code_lengths(text: str, trees: Trees) -> tuple[np.ndarray, int]:
    """Code length of the whole text in bits per language, and its number of bytes."""
    seq = codes(text, trees.code_of)
    out = np.zeros(len(trees.languages))
    for start in range(0, len(seq) - DEPTH, CHUNK):
        part = seq[start : start + CHUNK + DEPTH]
        string = strings(part, DEPTH + 1)
        row = trees.row_of[string]
        out += np.bincount(row, minlength=1)[1:] @ trees.costs[1 : row.max() + 1] if len(row) > len(trees.costs) else trees.costs[row].sum(0, dtype=float)
        new = string[row == 0]
        out += trees.escapes[new >> BITS].sum(0, dtype=float) + trees.short[new & (CODES**DEPTH - 1)].sum(0, dtype=float)
    return out, len(seq) - DEPTH


@lru_cache(maxsize=1)
def _trees(holder) -> Trees:
    code_of, counts = holder.value
    return grow(counts, code_of)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", per_lang: int = 600, max_langs: int = 300):
    """Byte codes and counts per language, learned from at most about ``per_lang`` documents of each."""
    sample = label_sample(docs.select(text, lang).where(usable_text(text)), text, lang, per_lang, max_langs)
    code_of = byte_codes(sample, text)
    return code_of, count_strings(sample, text, lang, code_of)


def predict(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score`` of every whole text; other columns pass through, those of the added names are replaced."""
    holder = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    others = [c for c in docs.columns if c not in (text, "lang_pred", "score")]

    def run(batch: pa.RecordBatch) -> dict:
        trees = _trees(holder)
        best, score = [], []
        for t in batch.column(text).to_pylist():
            if not t or not trees.languages or not LETTER.search(t):
                best.append("und")
                score.append(0.0)
                continue
            bits, n = code_lengths(t, trees)
            k = int(np.argmin(bits))
            best.append(trees.languages[k])
            score.append(float(1 / np.exp2((bits[k] - bits) / n * min(n, EVIDENCE)).sum()))
        return {c: batch.column(c) for c in others} | {"lang_pred": best, "score": score}

    return map_text(docs, text, run, extended(docs, others, "lang_pred string, score double"))
