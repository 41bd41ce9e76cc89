"""Registered queries of the text operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segue.llm.decontaminate import contamination
from segue.llm.lexical import lexical_search
from segue.llm.licenses import license_scan
from segue.llm.line_dedup import line_dedup
from segue.llm.mixing import mix
from segue.llm.near_dups import near_duplicates
from segue.llm.periodic import periodic_runs
from segue.llm.prefix_tokens import prefix_tokens
from segue.llm.quality import classify
from segue.llm.simhash import hex_digits, simhash_groups
from segue.llm.token_files import read_token_files, write_token_files
from segue.llm.topk import top_k
from segue.llm.url_filter import Rule, url_filter
from segue.sources.storage import scratch_path

TOKEN_BUDGET = 1024
END_ID = 1
TOP_K = 5
SHORT_CHARS = 1000
FOLDER_IDS = 1000

URL_RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_tokens(
        _table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), TOKEN_BUDGET
    )
    return counted.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > TOKEN_BUDGET).alias("over_limit"),
        "kept_chars",
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    docs = _table(spark, sf_dir, "documents")
    write_token_files(docs, path, tokenizer("word_bpe_49k.json"), END_ID)
    return read_token_files(spark, path)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: short ones in source/lang, others a level below."""
    docs = _table(spark, sf_dir, "documents")
    below = F.when(
        F.col("n_chars") >= SHORT_CHARS,
        F.floor(F.col("doc_id") / FOLDER_IDS).cast("string"),
    )
    folder = F.concat_ws("/", "source", "lang", below)
    return license_scan(docs.select("doc_id", folder.alias("folder"), "text"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(_table(spark, sf_dir, "pages"), URL_RULES)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, TOP_K)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "class_texts"
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_table(spark, sf_dir, "documents")).select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id", "component_fps"
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with periodic words in some texts.

    With h the crc32 of the id's digits and g = h div 10, the texts with h % 10 = 0
    have, from word a = g % n on, the p words from there over and over, p = 1 + (n - a)
    div (3 + g % 8). A NULL id leaves its text as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[ \\t-\\r]+", -1), lambda w: w != "")
    n, g, a, p = (F.col(f"_{c}") for c in "ngap")
    chosen = (
        docs.withColumn("_h", h)
        .withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
        .withColumn("_n", F.size("_w"))
        .withColumn("_g", F.floor(F.col("_h") / 10))
        .withColumn("_a", F.when(n > 0, g % n).cast("int"))
        .withColumn("_p", (1 + F.floor((n - a) / (3 + g % 8))).cast("int"))
    )
    again = F.array_repeat(F.slice("_w", a + 1, p), F.ceil((n - a) / p).cast("int"))
    planted = F.slice(F.concat(F.slice("_w", F.lit(1), a), F.flatten(again)), F.lit(1), n)
    text = F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text"))
    return chosen.withColumn("text", text).drop(*(f"_{c}" for c in "hwngap"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    # Products instead of quotients compare exactly; runs come in the order of ties.
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda b, r: F.when(
            b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r
        ).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {n: f for n, f in globals().items() if n.startswith("op")}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
