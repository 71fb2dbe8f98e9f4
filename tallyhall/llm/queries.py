"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhall.llm import (
    ann, backoff, chat, cotrain, decontam, fim, linededup, outliers, packing, simhash, sql, token_orc, vector_codes, warc,
)
from tallyhall.llm.common import ship, table
from tallyhall.session import saved, shared_dir

# Words in a packed sequence.
SEQUENCE_WORDS = 2048


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of all documents whose fingerprints of three-word shingles are chained by three bits at most."""
    ship(spark)
    return simhash.classes(table(spark, folder, "documents"), size=3, radius=3)


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC records, read back from the archives."""
    ship(spark)
    out = f"{shared_dir(spark)}/archives"
    warc.write_archives(warc.roles(table(spark, folder, "pages")), out)
    return warc.read_archives(spark, out, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def op3_cotrain(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by the two views, and the verdict."""
    ship(spark)
    docs = table(spark, folder, "documents")
    return cotrain.score(docs, cotrain.train(docs, table(spark, folder, "labels")))


def op4_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Base statistics and the verdict on every document."""
    return outliers.judge(table(spark, folder, "documents"))


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations as event logs, folded, formatted, written, read back and parsed."""
    ship(spark)
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.format_events(chat.events_of(rows), ["turn", "role", "order", "step"])
    return chat.digests(saved(formatted))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of SEQUENCE_WORDS words; copies and near copies of a text are a cluster."""
    ship(spark)
    docs = packing.clustered(table(spark, folder, "documents"))
    parts = packing.pieces(docs, F.col("length"), F.col("cluster"), SEQUENCE_WORDS)
    return packing.pack(saved(parts), SEQUENCE_WORDS)


def op7_backoff(spark: SparkSession, folder: str) -> DataFrame:
    """Every document under the trigram model of all others."""
    ship(spark)
    return backoff.score(table(spark, folder, "documents"))


def op8_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE ids of all documents, written as ORC and read back."""
    import public_tokenizers

    ship(spark)
    out = f"{shared_dir(spark)}/tokens"
    token_orc.write_token_orc(table(spark, folder, "documents"), out, public_tokenizers.path("byte_bpe_50k.json"))
    return token_orc.token_index(spark, out)


def op9_decontam(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, and which."""
    return decontam.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_linededup(spark: SparkSession, folder: str) -> DataFrame:
    """Which lines of every document go, of all lines similar to another one."""
    ship(spark)
    found = linededup.removals(table(spark, folder, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_lines", F.size("removed").alias("n_removed"), "removed")


def op11_graph_ann(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest others of every fiftieth vector, by graphs over all vectors."""
    ship(spark)
    return ann.nearest(table(spark, folder, "embeddings"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes and errors of all vectors under codebooks fitted on all of them."""
    ship(spark)
    return vector_codes.compress(table(spark, folder, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents cut for filling in the middle, as digests of the output and of the text told back."""
    ship(spark)
    cut = fim.transform(table(spark, folder, "documents"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def queries() -> dict:
    found = (
        op1_simhash, op2_warc, op3_cotrain, op4_outliers, op5_chat, op6_packing, op7_backoff, op8_token_orc, op9_decontam,
        op10_linededup, op11_graph_ann, op12_vector_codes, op13_fill_in_middle,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return sql.all_queries()
