"""Native operators against SQL, and on tables with odd rows."""

import pytest

pytest.importorskip("plainweave.llm")

from plainweave.llm import licences, oracles, queries, urls  # noqa: E402

TABLES = {"documents": "doc_id long, text string, lang string, source string", "pages": "page_id long, url string, html string"}
DOCS = [
    (20, "x\nReleased under the MIT License.\ny", "en", "a"), (21, "plain words", "en", "a"), (21, "plain words", "en", "a"),
    (40, "Licensed under the Apache License, Version 2.0.", "en", "a"), (1030, None, None, None), (None, "", "en", None),
    (30, "Licensed under CC BY-NC 4.0.", "en", "b"), (31, "a licence of its own\nReleased under the MIT License.", "en", "b"),
    (3131, "the work\nis\nlicensed under", "en", "b"), (50, "This work is licensed under the GNU\nGeneral Public License, version 3.", "de", "c"),
    (51, "the of and to " * 500, "de", "c"),
]
URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org", "http://example.org/en/1?x", "https://a.b.example.org/es/#f",
    "http://notexample.org/es/", "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/de", "http://x.net/1", "http://x.net/1",
    "ftp://é.com:80/fr/x?y#z", "http://x.net/" + "long/" * 400, "http://user@org/a", "http://𝔘.org/ü",
]


def rows(got, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in got)


def compare(spark, name, folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{'/*.parquet' if 'testdata' not in folder else ''}')")
    cursor = con.execute(oracles.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(columns) == sorted(got.columns)
    made = got.collect()
    assert rows([tuple(r) for r in made], got.columns) == rows(cursor.fetchall(), columns)
    return made


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_same_as_sql(spark, sf, name):
    assert compare(spark, name, sf)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(DOCS, TABLES["documents"]).write.parquet(f"{folder}/documents.parquet")
    pages = [(k, u, "") for k, u in enumerate(URLS)] + [(None, URLS[5], None)]
    spark.createDataFrame(pages, TABLES["pages"]).write.parquet(f"{folder}/pages.parquet")
    return folder


def test_odd_licences(spark, odd):
    got = {r["doc_id"]: r for r in compare(spark, "op1_license_scans", odd)}
    assert (got[20]["licence"], got[20]["origin"]) == ("MIT", "own")
    assert got[21]["origin"] == "inherited" and got[21]["licence_path"] == "a/en/0/0/LICENSE-40"  # Apache before MIT
    assert got[31]["licence"] == "MIT" and got[3131]["licence"] is None


def test_odd_urls(spark, odd):
    got = {r["page_id"]: r for r in compare(spark, "op3_url_filters", odd)}
    assert (got[4]["host"], got[4]["path"], got[4]["rule"]) == ("example.org", "", None)
    assert (got[5]["rule"], got[5]["verdict"]) == ("example.org/en/1", "block")
    assert (got[6]["rule"], got[6]["verdict"]) == ("example.org/es/", "block")
    assert got[7]["rule"] == "org/" and got[10]["rule"] is None and got[8]["rule"] == "com/fr/"
    assert got[0]["host"] == "" and got[0]["verdict"] == "allow" and got[0]["score"] is None


def test_nearest_directory_wins(spark):
    files = spark.createDataFrame(
        [
            ("LICENSE", "Released under the MIT License."), ("x/COPYING", "Licensed under CC BY-NC 4.0."), ("x/y/a.c", "int"),
            ("x/y/licenses.c", "int"), ("z/b.c", None), ("xx/c.c", "int"), (None, "int"), ("x/NOTICE", "nothing of the kind"),
        ],
        "path string, text string",
    )
    got = {r["path"]: r["licence"] for r in licences.scan(files).collect()}
    assert got == {
        "LICENSE": "MIT", "x/COPYING": "CC-BY-NC-4.0", "x/y/a.c": "CC-BY-NC-4.0", "x/y/licenses.c": "CC-BY-NC-4.0",
        "z/b.c": "MIT", "xx/c.c": "MIT", None: "MIT", "x/NOTICE": "CC-BY-NC-4.0",
    }


def test_empty_and_clashing(spark):
    files = spark.createDataFrame([("a", "t", "old", 3)], "path string, text string, licence string, score int")
    assert licences.scan(files).first()["licence"] is None
    assert licences.scan(files.limit(0)).count() == 0
    pages = spark.createDataFrame([("http://x.net/", 1, "old")], "url string, score int, host string")
    judged = urls.judge(pages, queries.URL_RULES).first()
    assert judged["host"] == "x.net" and judged["verdict"] == "allow"
    assert urls.judge(pages.limit(0), queries.URL_RULES).count() == 0


def test_model_tells_good_from_bad(spark):
    good = [f"http://news.example/{a}/story-{k}" for k in range(40) for a in ("world", "science")]
    bad = [f"http://win.example/casino-bonus-{k}{k}x{k}" for k in range(80)]
    new = ["http://other.test/world/story-7", "http://other.test/casino-bonus-99x9"]
    rules = [("allow", "news.example/"), ("block", "win.example/")]
    pages = spark.createDataFrame([(u,) for u in good + bad + new], "url string")
    got = {r["url"]: r["verdict"] for r in urls.judge(pages, rules).collect()}
    assert [got[u] for u in new] == ["allow", "block"]


def test_real_headers_and_licence_files(spark):
    notices = dict(licences.NOTICES)
    import textwrap

    def comment(text, mark="# "):
        return "\n".join(mark + line for line in textwrap.wrap(text, 68))

    gpl = notices["GPL-3.0"].replace(" This program is distributed", "\n\nThis program is distributed").replace(" You should", "\n\nYou should")
    wrapped = "\n#\n".join(comment(p) for p in gpl.split("\n\n"))
    plain = [(f"plain/{k}.c", f"int f{k}(void) {{ return it_as_by({k}); }} // the work of a name as it is by the file and of use {k}") for k in range(30)]
    files = spark.createDataFrame(
        [
            ("a.py", f"#!/usr/bin/python\n# A tool that sorts apples.\n#\n# Copyright (C) 2020 Some Body\n#\n{wrapped}\nimport os\n\nprint(1)\n"),
            ("b.c", "/*\n * Copyright 2020 Some Body\n *\n" + comment(notices["Apache-2.0"], " * ") + "\n */\nint main() {}\n"),
            ("c.js", "/*\n" + "\n".join(textwrap.wrap(notices["MPL-2.0"], 60)) + "\n*/\nvar x = 1"),
            ("d/LICENSE", "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + "\n".join(textwrap.wrap(notices["MIT"], 70))), ("d/e.c", "int x;"),
            ("f/COPYING", licences.WHOLE["GPL-3.0"]), ("g/COPYING", licences.WHOLE["LGPL-3.0"]), ("h/x.c", comment(notices["BSD-2-Clause"], "// ")),
            ("i/x.c", "int main() {}\n" + comment("Sort the apples by size and print them", "// ")), ("j/x", None), *plain,
        ],
        "path string, text string",
    )
    got = {r["path"]: (r["licence"], r["origin"]) for r in licences.scan(files).collect()}
    assert {p: got[p] for p in got if not p.startswith("plain/")} == {
        "a.py": ("GPL-3.0", "own"), "b.c": ("Apache-2.0", "own"), "c.js": ("MPL-2.0", "own"), "d/LICENSE": ("MIT", "own"),
        "d/e.c": ("MIT", "inherited"), "f/COPYING": ("GPL-3.0", "own"), "g/COPYING": ("LGPL-3.0", "own"),
        "h/x.c": ("BSD-2-Clause", "own"), "i/x.c": (None, None), "j/x": (None, None),
    }
    assert len(got) == 40 and all(got[p] == (None, None) for p, _ in plain)
