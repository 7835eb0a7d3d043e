"""Operator 10 against patterns and counts in plain code."""

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from adloom.llm import privacy
from tests.conftest import SF

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plausible(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        total = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d))))
        return 12 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind], text) if plausible(kind, m.group())]
    return sorted(found)


def written(spans):
    return ",".join(f"{[*BASE][k]}:{a}:{b}" for a, k, b in spans)


def check(texts, out):
    for k, t in texts:
        want, r = base_spans(t or ""), out[k]
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest(), (t, written(want), r.spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == i for s in want) for i in range(4))
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == [s for s in written(want).split(",") if s]


def test_random_texts(spark, make):
    rng = random.Random(5)
    bits = ["a@b.c", "a.b%@c-d.e_f@g.hi", "@", "1.2.3.4", "256.1.1.1", "007.1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111 1111 1112", "+1 (017) 555-7713", "+12345678", "é\U0001f600", " ", "\n", "x", "9", "..", "-", "+", "4111111111111111", "1 ", "0" * 25 + ".1.1.1"]
    texts = [(i, "".join(rng.choices(bits, k=rng.randint(0, 12)))) for i in range(400)]
    check(texts, {r.doc_id: r for r in privacy.report(make(texts)).collect()})


def test_every_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], {r.doc_id: r for r in privacy.report(docs).collect()})


def test_odd_rows_and_long_runs(spark, make, odd):
    rows = [r for r in odd if r[0] not in (4, None)] + [(30, "7" * 60_000), (31, "a" * 60_000 + "@"), (32, "1-" * 30_000), (33, "." * 60_000 + "1.1.1.1")]
    out = privacy.report(make([*rows, (4, "x a@b.cd"), (4, "x a@b.cd"), (None, "y e@f.gh")])).collect()
    check(rows, {r.doc_id: r for r in out})
    assert len(out) == len(rows) + 3 and sorted(r.n_email for r in out if r.doc_id in (4, None)) == [1, 1, 1]
    assert privacy.report(make(rows).limit(0)).count() == 0


def revealing(make):
    # "zanzibar" stands beside the address wherever it occurs; "hello" stands everywhere.
    docs = [(i, "hello zanzibar ann@x.org said hello") for i in range(4)] + [(10 + i, "hello others of all kinds") for i in range(1300)]
    return make([*docs, (900_000, "zanzibar was never mentioned")])


def test_terms_that_disclose(spark, make):
    out = {r.doc_id: r.spans for r in privacy.report(revealing(make)).collect()}
    assert out[0] == "term:6:14,email:15:24,term:25:29"
    assert out[10] == ""


def test_sanitised_texts(spark, make):
    docs = revealing(make)
    out = privacy.sanitise(docs)
    got = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns
    # 4 of the 5 documents with the word disclose it: generalised. "said" has no other use: removed.
    assert got[0] == "hello [TERM] [EMAIL]  hello" and got[10] == "hello others of all kinds"
    assert got[900_000] == "[TERM] was never mentioned"
    two = privacy.sanitise(make([(1, None), (2, ""), (3, "call +1 234 567 8901 or 1.2.3.4 now"), (3, "call +1 234 567 8901 or 1.2.3.4 now"), (None, "a@b.cd")])).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in two) == [(0, "[EMAIL]"), (1, ""), (2, ""), (3, "call [PHONE] or [IP] now"), (3, "call [PHONE] or [IP] now")]


def test_disclosing_words_go_wherever_they_stand(spark, make):
    docs = [(i, "hello Zanzibar ann@x.org said hello and then once more ZANZIBAR\U0001f600 zanzibar") for i in range(9)]
    docs += [(10 + i, "hello others of all kinds and then once more") for i in range(2600)]
    docs += [(9000, "\U0001f600\u0130 zanzibar, zanzibars; zanzibar@y.org " + "zanzibar " * 700)]
    out = {r.doc_id: r.spans.split(",") for r in privacy.report(make(docs)).collect()}
    want = {f"term:{m.start()}:{m.end()}" for m in re.finditer("zanzibar", docs[0][1].lower())}
    assert len(want) == 3 and want <= set(out[0])
    far = docs[-1][1]
    words = [m.span() for m in re.finditer(r"(?<![^\W\d_])zanzibar(?![^\W\d_])", far) if far[m.end()] != "@"]
    assert [s for s in out[9000] if s.startswith("term")] == [f"term:{a}:{b}" for a, b in words] and len(words) == 701
    clean = {r.doc_id: r.text for r in privacy.sanitise(make(docs)).collect()}
    assert not re.search(r"(?i)zanzibar(?!s)", clean[0] + clean[9000])


def test_words_anywhere_in_the_document_are_counted(spark, make):
    rng = random.Random(8)
    common, rare = [f"often{chr(97 + i)}" for i in range(20)], [f"rare{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(8)]
    docs = [(i, " ".join(rng.choices(common, k=8))) for i in range(3000)]
    for i in range(60):
        who = f"p{i % 8}@mail.org and q{i % 5}@post.org" if i % 3 else f"p{i % 8}@mail.org"
        words = rng.choices(rare[: 8 + i % 8 * 9], k=4)
        docs.append((5000 + i, f"Jane Smith{chr(97 + i % 8)} can be reached " + " ".join(words) + " by mail if at all " + who))
    docs += [(6000 + i, " ".join(rng.choices(rare, k=2))) for i in range(60)]
    mail = re.compile(BASE["email"])
    held = [({m.group() for m in mail.finditer(t)}, set(re.findall(r"[^\W\d_]{2,}", mail.sub(" ", t).lower()))) for _, t in docs]
    n_e, n_t, n_et = {}, {}, {}
    for es, ts in held:
        for counts, keys in ((n_e, es), (n_t, ts), (n_et, [(e, t) for e in es for t in ts])):
            for k in keys:
                counts[k] = counts.get(k, 0) + 1
    want = {t for (e, t), n in n_et.items() if n >= 2 and n / n_t[t] >= 0.5 and math.log2(n * len(docs) / (n_e[e] * n_t[t])) >= 8}
    assert len(want) > 10 and "smitha" in want
    for r in privacy.report(make(docs)).collect():
        text = dict(docs)[r.doc_id]
        masked = mail.sub(lambda m: " " * len(m.group()), text)
        places = [f"term:{m.start()}:{m.end()}" for m in re.finditer(r"[^\W\d_]{2,}", masked) if m.group().lower() in want]
        assert [s for s in r.spans.split(",") if s.startswith("term")] == places, text


def test_filter_holds_its_words_and_little_else(spark):
    words = spark.range(20_000).selectExpr("concat('word', id) AS term")
    probes = spark.range(40_000).selectExpr("concat('word', id) AS t", "id").withColumn("_bits", privacy._bitmap(words))
    hits = {r.id for r in probes.where(privacy._wanted(F.col("t"))).select("id").collect()}
    assert hits >= set(range(20_000)) and len(hits) < 20_020
    none = probes.select("t", "id").withColumn("_bits", privacy._bitmap(words.limit(0)))
    assert none.where(privacy._wanted(F.col("t"))).count() == 0


def test_a_full_filter_changes_no_result(spark, make, monkeypatch):
    want = {r.doc_id: r.spans for r in privacy.report(revealing(make)).collect()}
    monkeypatch.setattr(privacy, "MOST_BITS", 64)
    assert {r.doc_id: r.spans for r in privacy.report(revealing(make)).collect()} == want
