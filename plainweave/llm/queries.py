"""The registered queries of this subpackage: the operators with production
parameters on whole tables, and what SQL can say of their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plainweave.llm import blocks, conversations, decontaminate, licences, lines, pagetext, pieces, placement, pseudonyms
from plainweave.llm import quality, simhash, urls, whitening
from plainweave.sources.tables import table

SHARDS = [f"shard-{k:03d}" for k in range(64)]
KEY_SETTING = "spark.plainweave.pseudonymKey"
PSEUDONYM_KEY = b"replace by a secret of your own"  # where the session has none: good for trials only
URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
    ("block", "com/de/"),
]
# a tree of files over the documents: every tenth is its directory's licence file
FOLDER = "concat_ws('/', coalesce(source, ''), coalesce(lang, ''), {thousand}, {hundred}, {name})"


def tokenizer_path() -> str:
    """The public tokenizer; any file of its kind will do."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pseudonym_key(spark: SparkSession) -> bytes:
    """The secret of the session. Who has it can turn pseudonyms back."""
    given = spark.conf.get(KEY_SETTING, None)
    return given.encode() if given else PSEUDONYM_KEY


def op1_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    """Licences of all documents, as files of a tree by source, language and id."""
    number = F.coalesce("doc_id", F.lit(-1))
    name = F.when(number % 10 == 0, F.concat(F.lit("LICENSE-"), number)).otherwise(F.concat(number, F.lit(".txt")))
    path = F.concat_ws(
        "/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")),
        F.floor(number / 1000).cast("string"), F.floor(number / 100).cast("string"), name,
    )
    files = table(spark, sf, "documents").select("doc_id", path.alias("path"), "text")
    return licences.scan(files)


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    judged = quality.judge(docs, keep_columns=["doc_id"])
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", F.round("distance", 6).alias("distance"))


def op3_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages").select("page_id", "url"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "score"
    )


def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"), with_text=False)


def op5_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, tokenizer_path(), with_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", text.alias("fingerprint"), "component_id")


def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf, "documents").select("doc_id", "text"), pseudonym_key(spark))


def op8_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return placement.place(table(spark, sf, "documents").select("doc_id"), SHARDS)


def op9_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest")


def op10_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return pagetext.extract(pages).select("page_id", "url", "text", "n_chars")


def op11_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = lines.drop_repeated(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.Repair(conversations.damage(given), given).digests()


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    made = whitening.coordinates(vectors, "embedding").withColumn("deviation", F.col("deviation").try_cast("long"))
    return made.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scans, op2_quality_rules, op3_url_filters, op4_substring_dedup, op5_sentencepiece,
        op6_simhash_near_dedup, op7_pii, op8_sharding, op9_benchmark_decontamination, op10_html_extraction,
        op11_line_dedup, op12_conversation_repair, op13_embedding_whitening, pipeline,
    )
}
