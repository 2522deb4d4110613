"""Registered queries of this subpackage, one for each operator, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm import (
    chat_format,
    decontaminate,
    html_blocks,
    mixing,
    ngram_join,
    oracles,
    periodic_runs,
    prefix_trie,
    quality_rules,
    suffix_dedup,
    surrogates,
    token_counts,
    token_files,
    url_filter,
)
from dimflow.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(tune(spark), folder)
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


@query("op7_decontamination")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages found in documents, within the edit budget."""
    return decontaminate.matches(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op8_ngram_join", oracles.OP8)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles are at least 85 % alike."""
    return ngram_join.similar_documents(read(spark, folder, "documents"))


@query("op10_quality_rules")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Rule counts and verdict of every document."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    judged = quality_rules.judge(docs, quality_rules.fit(docs, read(spark, folder, "labels")))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *counts, "base_failed", "kept", "score")


#: Secret of the surrogates in the registered query; a user passes their own.
SURROGATE_KEY = "registered-query"


@query("op3_mixing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every document in the stream mixed to the square root of the sources' sizes."""
    mixed = mixing.mix(read(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select("row.doc_id", "row.source", "block", "slot", "offset")


@query("op4_surrogates")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY).select("row.doc_id", "text", "n_entities")


#: A conversation whose texts are control strings.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op5_chat_format", oracles.OP5)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every conversation, read back from its tokens and mask."""
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.format_conversations(turns.union(probe)))


@query("op9_token_counts")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under the unigram vocabulary."""
    return token_counts.token_counts(read(spark, folder, "documents"))


@query("op1_html_blocks")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_blocks.extract(read(spark, folder, "pages"))


RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query("op2_url_filter", oracles.op2(RULES))
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of every page's url."""
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return url_filter.judge(read(spark, folder, "pages"), rules)


@query("op6_suffix_dedup", oracles.OP6)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """What every document loses to strings of 50 bytes in documents before it."""
    return suffix_dedup.remove_repeats(read(spark, folder, "documents"))


@query("op13_token_files")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as read back from the corpus' token files."""
    import public_tokenizers

    docs = read(spark, folder, "documents")
    files = token_files.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_documents(files, docs.schema["doc_id"].dataType.simpleString())


def replanted(docs: DataFrame) -> DataFrame:
    """doc_id and text; of a tenth of the documents, by the checksum of the id, the words from some place on repeat."""
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    said = F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", quality_rules.SPACE), ""))
    rows = rows.select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), said.alias("said"))
    n = F.size("said")
    a = F.pmod("g", n).cast("int")
    rows = rows.withColumn("n", F.when(n > 0, n)).withColumn("a", F.when(n > 0, a))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.pmod("g", F.lit(8)))).cast("int")
    rows = rows.withColumn("p", period)
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("said", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("n") - F.col("a"))
    text = F.array_join(F.concat(F.slice("said", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), text).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, the strongest of them, and the text without repeats."""
    docs = replanted(read(spark, folder, "documents"))
    found = periodic_runs.find_runs(docs, keep=["doc_id"])
    found = found.select(
        "row.doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        periodic_runs.strongest(F.col("runs")).alias("best"),
        F.sha2(periodic_runs.runs_text(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    milli = F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli")
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli, "runs_sha256", "collapsed_sha256")


@query("op12_prefix_trie")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of conversations that begin like the first of their five."""
    turns, convs = prefix_trie.number_turns(prefix_trie.digest_turns(read(spark, folder, "conversations")))
    lender = F.col("conv_id") - F.pmod("conv_id", F.lit(5))
    take = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(9))
    return prefix_trie.prefix_trie(*prefix_trie.rebuild(turns, convs, lender, take, 8))
