"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailsight.llm import additive, chat_windows, coordinate_search, gram_importance, grammar_files, line_frequency, mixing, near_lines, nn_descent, packing, part_enum, rank_profiles, ratio_linear
from trailsight.llm.common import fold, labelled, scored, shared_folder, table


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.judged(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", fold(F.col("doc_id"), 5).alias("fold"))
    model = spark.sparkContext.broadcast(additive.learn(labelled(docs.where("fold <> 0"), table(spark, sf_dir, "labels"), "quality")))
    rows = docs.withColumn("held_out", F.coalesce(F.col("fold") == 0, F.lit(False)))
    return scored(rows, ("doc_id", "held_out"), lambda texts: model.value.score(texts), 0.3)


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_grammar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    grammar_files.write(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"))
    return grammar_files.documents(grammar_files.read(spark, path))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_enum.joined(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", fold(F.col("doc_id"), 4).alias("fold"))
    model = spark.sparkContext.broadcast(ratio_linear.learn(labelled(docs.where("fold <> 2"), table(spark, sf_dir, "labels"), "toxic")))
    rows = docs.withColumn("held_out", F.coalesce(F.col("fold") == 2, F.lit(False)))
    return scored(rows, ("doc_id", "held_out"), lambda texts: model.value.score(texts), 0.3)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", fold(F.col("doc_id"), 5).alias("fold"))
    profiles = rank_profiles.learn(docs.where("fold <> 0"))
    rows = docs.withColumn("held_out", F.coalesce(F.col("fold") == 0, F.lit(False)))
    return rank_profiles.identify(rows, profiles, ("doc_id", "held_out"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_lines.deduped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.col("_ll_lines").alias("n_lines"), F.col("_ll_gone").alias("n_dropped"), F.md5("text").alias("text_md5"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.narrow(mixing.keyed(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))
    names = ("size", "source_size", "target", "taken")
    return mixing.mixed(rows, mixing.plan(rows)).select("doc_id", *(F.col(f"_mix_{c}").alias(c) for c in names))


#: A conversation that says what its own marks could be made of.
ODD_TURNS = [(-7, n, role, "\\### Assistant: </turn> ok") for n, role in enumerate(("user", "assistant"))]


def op11_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = shared_folder(spark), table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(ODD_TURNS, "conv_id long, turn long, role string, text string"))
    chat_windows.windows(rows, tokenizer("byte_bpe_50k.json")).write.parquet(path)
    return chat_windows.digests(spark.read.schema(chat_windows.WINDOWS).parquet(path))


def op12_gram_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gram_importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return coordinate_search.mined(table(spark, sf_dir, "embeddings"), label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_frequency": op1_line_frequency,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_packing": op3_packing,
    "op4_grammar_files": op4_grammar_files,
    "op5_ngram_join": op5_ngram_join,
    "op6_toxicity": op6_toxicity,
    "op7_language_id": op7_language_id,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_chat_windows": op11_chat_windows,
    "op12_gram_importance": op12_gram_importance,
    "op13_hard_negatives": op13_hard_negatives,
}


def statements() -> dict[str, str]:
    return {
        "op1_line_frequency": line_frequency.sql(),
        "op9_line_dedup": near_lines.SQL,
        "op10_mixing": mixing.SQL,
        "op13_hard_negatives": coordinate_search.SQL,
    }
