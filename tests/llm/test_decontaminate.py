"""Operator 8 against full alignment of every item with every text."""

import random
import time

import numpy as np

from adloom.llm import decontaminate as dc


def least_edits(text, item):
    """Least edits between the item and any region of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def items_and_texts(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choices("abcde ", k=n)).strip()
    items = [(i, text(rng.randint(60, 200))) for i in range(8)]
    texts = []
    for _ in range(25):
        parts = [text(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 2)):
            t = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 12)):
                k = rng.randrange(len(t))
                t[k : k + 1] = rng.choice([[], ["x"], [t[k], "y"]])
            parts += ["".join(t), text(rng.randint(0, 100))]
        texts.append(" ".join(parts))
    return items, texts


def test_finds_exactly_what_lies_within_the_budget():
    for seed in range(3):
        items, texts = items_and_texts(seed)
        index = dc.index(items, dc.Q, dc.BUDGET)
        for t in texts:
            found = {}
            for r in dc.regions(t, index, dc.Q):
                found[r["item_id"]] = min(r["edits"], found.get(r["item_id"], 99))
                part = dc.fold(t[r["start"] : r["end"]])[0]
                assert least_edits(part, dc.fold(dict(items)[r["item_id"]])[0]) <= r["edits"]
            folded = dc.fold(t)[0]
            want = {}
            for i, x in items:
                f = dc.fold(x)[0]
                e = least_edits(folded, f)
                if e <= int(len(f) * dc.BUDGET):
                    want[i] = e
            assert found == want


def test_fold_keeps_places():
    text = "A  b\n\n\tCİ d"
    low, places = dc.fold(text)
    assert low == "a b cİ d" and [text[p].lower()[:1] for p in places[:5]] == ["a", " ", "b", "\n", "c"]
    assert dc.fold("x\ny")[1] is None


def test_grams_are_of_their_run_only():
    a, b = dc.points("xxabcdefghijklmyy"), dc.points("abcdefghijklm")
    assert np.array_equal(dc.grams(a, 12)[2:4], dc.grams(b, 12))


def test_odd_rows(spark, make, odd, monkeypatch):
    items = [(1, "Some Benchmark question, long enough to count."), (2, None), (3, "short"), (4, "Some Benchmark question, long enough to count."), (5, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [*odd, (20, "before. SOME benchmark  question, long enough\nto count. after"), (21, "clean text without any of it")]
    for block in (dc.BLOCK_CHARS, 30):
        monkeypatch.setattr(dc, "BLOCK_CHARS", block)
        out = {r.doc_id: r for r in dc.search(make(rows), benchmark, keep_text=True).collect()}
        spans = sorted((r.item_id, out[20].text[r.start : r.end]) for r in out[20].regions)
        assert spans == [(i, "SOME benchmark  question, long enough\nto count.") for i in (1, 4)]
        assert all(not r.regions for k, r in out.items() if k != 20)
        assert dc.remove(out[20].text, out[20].regions) == "before.  after"
    assert dc.search(make(rows).limit(0), benchmark).count() == 0
    assert dc.search(make(rows), benchmark.limit(0)).where("size(regions) > 0").count() == 0


def test_short_items_lose_nothing():
    items = [(n, "abcdefghijklmnopqrstuvwxyz0123456789"[:n]) for n in (11, 12, 20, 23, 24, 30)]
    index = dc.index(items, dc.Q, 0.2)
    assert index.edits.tolist() == [0, 0, 0, 0, 1, 1]
    for n, t in items:
        k = n // 2
        edited = t[:k] + "#" + t[k + 1 :]
        found = {r["item_id"] for r in dc.regions(f"xx {edited} yy", index, dc.Q)}
        assert (n in found) == (n >= 24)
        assert (n in {r["item_id"] for r in dc.regions(f"xx {t} yy", index, dc.Q)}) == (n >= dc.Q)


def test_repetitive_items_and_texts():
    rng = random.Random(5)
    for piece in ("a", "ab", "abcdefghijklm ", "the answer is no. "):
        item = (piece * 100)[: rng.randint(120, 180)].strip()
        index = dc.index([(1, item), (2, "something else " + item[:60])], dc.Q, dc.BUDGET)
        assert index.repeats[0]
        for length in (0, 50, len(item) - 4, len(item), 400):
            t = list("x y z " * rng.randint(0, 9) + (piece * 400)[:length] + " tail of the text" * rng.randint(0, 3))
            for _ in range(rng.randint(0, 9) if t else 0):
                t[rng.randrange(len(t))] = "q"
            text = "".join(t)
            found = [r for r in dc.regions(text, index, dc.Q) if r["item_id"] == 1]
            want = least_edits(dc.fold(text)[0], dc.fold(item)[0])
            assert min((r["edits"] for r in found), default=None) == (want if want <= index.edits[0] else None)
            assert all(a["end"] <= b["start"] for a, b in zip(found, found[1:], strict=False))


def test_stretches_and_chunks_lose_nothing(monkeypatch):
    item = "".join(random.Random(1).choices("abcdefgh ", k=200)).strip()
    text = "".join(random.Random(2).choices("abcdefgh ", k=500)).join([item[:90] + "z" + item[91:]] * 9)
    for items in ([(1, item)], [(1, "ab" * 100)]):
        body = text if items[0][1] == item else "ab" * 900 + text + "ab" * 250
        want = dc.regions(body, dc.index(items, dc.Q, dc.BUDGET), dc.Q)
        monkeypatch.setattr(dc, "STRETCH", 64)
        monkeypatch.setattr(dc, "CHUNK", 7)
        assert dc.regions(body, dc.index(items, dc.Q, dc.BUDGET), dc.Q) == want and len(want) >= 9
        monkeypatch.undo()


def test_long_repetitive_text_ends():
    index = dc.index([(1, "a" * 500)], dc.Q, dc.BUDGET)
    begin = time.perf_counter()
    assert len(dc.regions("a" * 1_000_000, index, dc.Q)) == 2000
    assert time.perf_counter() - begin < 20
