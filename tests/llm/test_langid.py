"""Operator 7: code lengths against a plain tree, and accuracy on held-out documents."""

import math
from collections import Counter

import numpy as np

from adloom.llm import langid
from adloom.llm.queries import op7_language
from tests.conftest import SF


def plain_length(text, samples, code_of):
    """Code length by walking the contexts, longest first."""
    seq = [langid.codes(t, code_of).tolist() for t in samples]
    counts = {k: Counter() for k in range(4)}
    for s in seq:
        for i in range(3, len(s)):
            for k in range(4):
                counts[k][tuple(s[i - k : i + 1])] += 1
    bits, s = 0.0, langid.codes(text, code_of).tolist()
    for i in range(3, len(s)):
        for k in (3, 2, 1, 0):
            context = tuple(s[i - k : i])
            here = {g[-1]: n for g, n in counts[k].items() if g[:-1] == context}
            total, kinds = sum(here.values()), len(here)
            if s[i] in here:
                bits += math.log2((total + kinds) / here[s[i]])
                break
            if kinds:
                bits += math.log2((total + kinds) / kinds)
        else:
            bits += langid.BITS
    return bits


def test_tables_equal_the_tree():
    samples = {"x": ["abra cadabra", "abc"], "y": ["zzz ab", "éé"]}
    code_of = np.full(256, langid.CODES - 1, np.int32)
    for c, b in enumerate(b"abcdrz "):
        code_of[b] = c
    counts = {}
    for g, texts in samples.items():
        counts[g] = np.unique(np.concatenate([langid.strings(langid.codes(t, code_of), 4) for t in texts]), return_counts=True)
    trees = langid.grow(counts, code_of)
    for text in ("abra", "zab", "q", "cad abé z", "aa bb"):
        bits, n = langid.code_lengths(text, trees)
        assert n == len(text.encode())
        assert np.allclose(bits, [plain_length(text, samples[g], code_of) for g in trees.languages], atol=1e-3), text


def test_accuracy_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    out = op7_language(spark, sf).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97


def test_odd_rows(spark, make, odd):
    fitted = langid.fit(make([(1, "the words of one language here")], "en").unionByName(make([(2, "und ganz andere wörter hier")], "de")).unionByName(make([(3, None)], None)))
    rows = [*odd, (7, "12 34 !?"), (8, "andere wörter"), (9, "other words")]
    out = langid.predict(make(rows), fitted).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert {got[k].lang_pred for k in (1, 2, 7)} == {"und"}
    assert (got[8].lang_pred, got[9].lang_pred) == ("de", "en")
    assert langid.predict(make(rows).limit(0), fitted).count() == 0


def test_nothing_to_learn_from(spark, make, odd):
    fitted = langid.fit(make(odd).limit(0))
    assert {r.lang_pred for r in langid.predict(make(odd), fitted).collect()} == {"und"}
