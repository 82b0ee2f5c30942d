"""The pipeline against plain versions of its stages."""

import pytest

pytest.importorskip("plainweave.llm")
pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from plainweave.llm import pseudonyms, queries  # noqa: E402
from test_operators import plain_components, plain_matches, plain_print, sha  # noqa: E402


def test_stages(spark, sf):
    import sentencepiece

    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    good = [r["doc_id"] for r in queries.op2_quality_rules(spark, sf).collect() if r["kept"]]
    prints = plain_components([(i, plain_print(rows[i]["text"])) for i in good])
    once = [i for i, _, owner in prints if i == owner]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [m[0] for m in plain_matches([(i, rows[i]["text"]) for i in once], items) if not m[5]]
    names = pseudonyms.Pseudonyms(queries.PSEUDONYM_KEY)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path())
    expected = {i: library.encode(names.text(rows[i]["text"])[0]) for i in clean}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert {i: r["ids"] for i, r in got.items()} == expected
    assert all(r["ids_sha256"] == sha(",".join(map(str, r["ids"]))) for r in got.values())
    assert 0 < len(clean) < len(once) < len(good) < len(rows)


def test_stages_return_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.limit(0)
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, sf).columns == docs.columns
        assert step(spark, odd, sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf).count() == 0
