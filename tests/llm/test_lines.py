"""Line dedup against a plain version and SQL, on odd tables too."""

import hashlib

import pytest

pytest.importorskip("plainweave.llm")

from plainweave.llm import lines, oracles, queries  # noqa: E402

LONG = "\n".join(f"a line of its own {k % 4000}" for k in range(40_000))
ODD = [
    (3, "Shared line here\nown line of three\nshared LINE here"), (2, "  shared line here\t\n\nshort"), (1, "first own line\nshort\n"),
    (None, None), (None, "shared line here\nonly null holds this"), (None, "only null holds this"), (4, ""), (4, "own line of three"),
    (5, "ÉCOLE des arts"), (6, "école des arts"), (7, "école des arts\r\n\v école des arts"), (8, "\n\n\n"), (9, "ten chars!"), (10, "ten chars!"),
    (11, "nine char"), (12, "nine char"), (13, LONG), (14, LONG + "\ntail of fourteen"), (3, "Shared line here\nown line of three\nshared LINE here"),
    (15, "a  b        c\x1cd"), (16, "\x0ba  b        c\x1cd"), (17, "𝔘𝔘𝔘𝔘𝔘𝔘𝔘𝔘𝔘𝔘"), (18, "𝔘𝔘𝔘𝔘𝔘𝔘𝔘𝔘𝔘𝔘\nend of the last"), (19, "own line of three\nx"),
]


def plain(rows, min_chars=10, min_documents=2):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        every = (text or "").split("\n")
        kept = [
            x for x in every
            if len(key(x)) < min_chars or len(holders[key(x)]) < min_documents
            or i == min(h for h in holders[key(x)] if h is not None)
        ]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return out


def in_order(rows):
    return sorted(rows, key=repr)


def found(frame, **settings):
    made = lines.drop_repeated(frame, **settings).select("doc_id", "n_lines", "n_dropped", "text")
    return in_order(tuple(r) for r in made.collect())


def test_same_as_plain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert found(docs) == in_order(plain(rows))
    assert found(docs, min_chars=3, min_documents=3) == in_order(plain(rows, 3, 3))


@pytest.mark.parametrize("threshold", [2, 3])
def test_odd_rows(spark, threshold):
    frame = spark.createDataFrame(ODD, "doc_id long, text string").repartition(5)
    assert found(frame, min_documents=threshold) == in_order(plain(ODD, 10, threshold))


def test_odd_rows_as_sql(spark, tmp_path):
    import duckdb

    spark.createDataFrame(ODD, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cursor = con.execute(oracles.ORACLES["op11_line_dedup"])
    names = [d[0] for d in cursor.description]
    got = queries.op11_line_dedup(spark, str(tmp_path))
    assert sorted(names) == sorted(got.columns)
    assert in_order(tuple(r) for r in got.select(*names).collect()) == in_order(cursor.fetchall())


def test_digests(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in queries.op11_line_dedup(spark, sf).collect()}
    assert got == {(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain(rows)}


def test_empty_and_clashing(spark):
    names = ["g", "h", "id", "owner", "position", "tg", "og", "row", "gone", "lines", "doc", "key", "n_lines"]
    schema = "doc_id string, body string, " + ", ".join(f"{n} int" for n in names)
    frame = spark.createDataFrame([("b", "the same line", *range(13)), ("a", "the same line\nx", *range(13))], schema)
    got = {r["doc_id"]: r for r in lines.drop_repeated(frame, text_col="body").collect()}
    assert (got["b"]["body"], got["b"]["n_lines"], got["b"]["n_dropped"]) == ("", 1, 1)
    assert got["a"]["body"] == "the same line\nx" and [got["a"][n] for n in names[:-1]] == list(range(12))
    assert lines.drop_repeated(frame.limit(0), text_col="body").count() == 0
