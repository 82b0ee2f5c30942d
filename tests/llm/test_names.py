"""Columns of the caller's that are named like internal ones."""

import pytest

pytest.importorskip("plainweave.llm")

from plainweave.llm import queries, quality, simhash, urls  # noqa: E402

NAMES = ["_0", "_1", "k0", "k1", "k_text", "_url", "_digest", "_verdict", "id", "digest", "fp", "root", "key", "u", "v", "half", "copies", "full", "g", "l", "s", "x0"]
EXTRA = ", ".join(f"`{n}` int" for n in NAMES)
VALUES = tuple(range(len(NAMES)))


def test_urls(spark):
    frame = spark.createDataFrame([("http://x.org/a", *VALUES), ("http://y.com/de/", *VALUES), (None, *VALUES)], "url string, " + EXTRA)
    got = urls.judge(frame, queries.URL_RULES).collect()
    assert {(r["url"], r["verdict"]) for r in got} == {("http://x.org/a", "allow"), ("http://y.com/de/", "block"), (None, "allow")}
    assert all(tuple(r[n] for n in NAMES) == VALUES for r in got)


def test_near_duplicates(spark):
    text = "one two three four five six seven eight nine ten"
    frame = spark.createDataFrame([(1, text, *VALUES), (2, text, *VALUES), (3, "all other words stand in this one here", *VALUES)], "doc_id long, text string, " + EXTRA)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    got = kept.collect()
    assert sorted(r["doc_id"] for r in got) == [1, 3] and all(tuple(r[n] for n in NAMES) == VALUES for r in got)
    assert simhash.keep_one(frame.limit(0)).count() == 0


def test_quality(spark):
    frame = spark.createDataFrame([(1, "word " * 60, "en", "web", *VALUES), (2, None, None, None, *VALUES)], "doc_id long, text string, lang string, source string, " + EXTRA)
    got = quality.judge(frame).collect()
    assert len(got) == 2 and all(tuple(r[n] for n in NAMES) == VALUES for r in got)
    assert quality.keep_good(frame).columns == frame.columns
