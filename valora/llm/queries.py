"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valora.llm.chat import digests, format_chats
from valora.llm.decontaminate import with_leaks
from valora.llm.extract import main_text
from valora.llm.langid import learn, with_language
from valora.llm.mixing import default_domain, mix
from valora.llm.native_sql import PREFIX_TRIE, SPELLING_VARIANTS
from valora.llm.ngram_join import near_classes
from valora.llm.packing import pack
from valora.llm.quality import with_quality
from valora.llm.session import table
from valora.llm.sharding import reshard_table
from valora.llm.substring_dedup import remove_repeats
from valora.llm.turn_trie import trie, turn_rows, with_openings
from valora.llm.variants import spelling_variants, word_counts
from valora.llm.vector_tree import nearest

#: Parameters of the queries.
MIX = {"weights": {("d0",): 2.0, ("d1",): 1.0, ("d2",): 1.0, ("d3",): 1.0}, "share": 0.5, "max_epochs": 2, "seed": 7}
OLD_SHARDS, NEW_SHARDS = 20, 24


def _remainder(column: str, n: int):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    rest = ["n_chars", "n_lines", "dup_line_chars", "echo_words", "rep_chars_2", "rep_chars_3", "rep_chars_4",
            "rep_chars_5", "rep_chars_6", "rep_chars_8", "rep_chars_10"]
    return docs.select("doc_id", *(F.col(f"quality.{c}").alias(c) for c in [*first, *rest]))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), repeated="n_repeated")
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_repeated")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    return digests(format_chats(turns.unionByName(extra)))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"),
                       short=True)
    return (found.select("doc_id", F.explode("leaks").alias("l"))
            .select("doc_id", "l.item_id", "l.n_shared", "l.n_item", (F.col("l.n_shared") / F.col("l.n_item")).alias("containment")))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return (mix(docs, **MIX).withColumn("domain", default_domain(F.col("source")))
            .select("doc_id", "domain", "lang", "source", "epoch"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", _remainder("source", OLD_SHARDS).alias("old"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return reshard_table(docs, F.col("old"), NEW_SHARDS).select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op8_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held = _remainder("doc_id", 4) == 2
    model = learn(docs.filter(~F.coalesce(held, F.lit(False))))
    return (with_language(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "language.lang_pred", "language.score",
                    F.transform("language.mixture", lambda m: m["lang"]).alias("languages")))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "dedup.n_words", "dedup.n_removed",
                       F.sha2("dedup.kept", 256).alias("kept_sha256"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_ = F.col("id")
    turns = with_openings(turn_rows(table(spark, sf_dir, "conversations")), id_ - id_ % 100, id_ % 100 == 0,
                          _remainder("id", 6), most=5)
    return trie(turns)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = word_counts(table(spark, sf_dir, "documents"), min_length=6, min_count=5, noise=199)
    return spelling_variants(words, ratio=5)


#: Queries that SQL can express over whole tables.
SQL = {"op12_conversation_trie": PREFIX_TRIE, "op13_spelling_variants": SPELLING_VARIANTS}

#: name -> (query, DuckDB SQL or None).  Where there is no whole-table SQL form
#: in DuckDB, tests/llm compares the query with a brute-force version.
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    f.__name__: (f, SQL.get(f.__name__)) for f in (
        op1_quality_rules, op2_html_extraction, op3_chat_formatting, op4_benchmark_decontamination,
        op5_ngram_jaccard_join, op6_source_mixing, op7_sharding, op8_token_packing, op9_language_id,
        op10_substring_dedup, op11_nearest_neighbours, op12_conversation_trie, op13_spelling_variants)
}
