"""Operator 9: damaged records are found by descending the trees, and only they."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adloom.llm import warc

SCHEMA = "page long, url string, hash string, length long"


def record(i, text=None):
    body = f"body {i}" if text is None else text
    return (i, f"http://h{i % 5}", hashlib.sha256(body.encode()).hexdigest(), len(body))


def expected(one, two):
    """Rows of the audit, from plain counts and sums."""
    sides = []
    for rows in (one, two):
        offset, side = 0, {}
        for key, n in sorted(Counter(rows).items()):
            side[key] = (n, offset)
            offset += n * key[3]
        sides.append(side)
    a, b = sides
    none = (0, None)
    return sorted(
        (*k, a.get(k, none)[0], b.get(k, none)[0], a.get(k, none)[1], b.get(k, none)[1])
        for k in a.keys() | b.keys() if a.get(k, none)[0] != b.get(k, none)[0]
    )


def audited(spark, one, two):
    out = warc.audit(spark.createDataFrame(one, SCHEMA), spark.createDataFrame(two, SCHEMA))
    assert out.columns == ["page", "url", "hash", "length", "copies_a", "copies_b", "offset_a", "offset_b"]
    return sorted(tuple(r) for r in out.collect())


ROWS = [record(i) for i in range(700)]
BOUNDARY = next(i for i in range(700) if hashlib.sha256("\n".join([str(i), ROWS[i][2], ROWS[i][1]]).encode()).hexdigest().endswith("0"))


@pytest.mark.parametrize("name,two", [
    ("changed", [record(i, "x" if i in (0, 300, 699) else None) for i in range(700)]),
    ("lost first, middle, last, and one that starts a range", [r for i, r in enumerate(ROWS) if i not in (0, 350, 699, BOUNDARY)]),
    ("added", [*ROWS, record(-5), record(10_000), record(350, "another body of the page")]),
    ("repeated", [*ROWS, ROWS[17], ROWS[17], ROWS[BOUNDARY]]),
    ("reordered", ROWS[::-1]),
    ("nothing left", []),
])
def test_reports_exactly_the_damage(spark, name, two):
    got = audited(spark, ROWS, two)
    assert got == expected(ROWS, two)
    assert bool(got) == (name != "reordered")


def test_small_and_hot(spark):
    assert audited(spark, [], []) == []
    assert audited(spark, ROWS[:1], []) == expected(ROWS[:1], [])
    hot = [(1, "u", "same", 3)] * 900 + [(1, "u", f"v{i}", 2) for i in range(300)]
    assert audited(spark, hot, hot[1:-1]) == expected(hot, hot[1:-1])


def test_damage_stays_in_its_ranges(spark):
    """A lost record leaves all ranges as they are but its own and those above."""
    levels = []
    for rows in (ROWS, ROWS[:100] + ROWS[101:]):
        levels.append(warc.tree(warc.distinct(spark.createDataFrame(rows, SCHEMA)), 3))
    for k, most in ((1, 2), (2, 2), (3, 1)):
        found = [{(r.id, r.hash) for r in side[k].collect()} for side in levels]
        assert 1 <= len(found[0] - found[1]) <= most
    assert levels[0][3].count() == 1 and levels[0][1].count() > 20


def test_depth():
    assert [warc.depth_of(n) for n in (0, 1, 16, 17, 256, 257)] == [1, 1, 1, 2, 2, 3]


def test_records(spark):
    pages = spark.createDataFrame([(2, "u", "é"), (None, None, None)], "page_id long, url string, html string")
    out = pages.select("page_id", *warc.leaf(warc.record(F.col("url"), F.col("html")))).collect()
    head = "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: {}\r\nContent-Type: text/html\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    for r, body in zip(out, (head.format("u", 2, "é"), head.format("", 0, "")), strict=True):
        assert (r.hash, r.length) == (hashlib.sha256(body.encode()).hexdigest(), len(body.encode()))
