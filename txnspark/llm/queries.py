"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixing, phrases, prefix_trie, secret_scan, shards, warc
from .decontaminate import WINDOW, find_benchmark
from .embeddings import link_vectors
from .langid import identify_held_out
from .minhash import near_duplicates
from .mixing import mix
from .phrases import collocations
from .prefix_trie import rebuilt_trie
from .quality import score_quality
from .secret_scan import report, scan_secrets
from .shards import shard_documents
from .tokens import count_tokens
from .toxicity import score_toxicity
from .warc import archive_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_minhash_near_dedup(spark, sf):
    """Components of documents of which at least 80 % of the 4-word shingles are shared."""
    return near_duplicates(table(spark, sf, "documents"), width=4)


@query
def op2_toxicity(spark, sf):
    """Toxicity of every document by class-conditional Kneser-Ney models."""
    return score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op7_language_id(spark, sf):
    """Language of every document by naive Bayes over hashed character n-grams."""
    return identify_held_out(table(spark, sf, "documents"))


@query
def op3_mixing(spark, sf):
    """Documents mixed to target weights of their sources."""
    return mix(table(spark, sf, "documents"), keep=["doc_id"]).drop("copies")


@query
def op9_warc(spark, sf):
    """Pages written to a content-addressed archive and read back."""
    back = archive_round_trip(table(spark, sf, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES |= {"op3_mixing": mixing.ORACLE, "op9_warc": warc.ORACLE}


@query
def op10_secrets(spark, sf):
    """Secrets in every document, by trigram index and verification."""
    return report(scan_secrets(table(spark, sf, "documents"), keep=["doc_id"]))


ORACLES["op10_secrets"] = secret_scan.ORACLE


@query
def op5_decontamination(spark, sf):
    """Passages of the benchmark, whole or in part, in every document."""
    return find_benchmark(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=WINDOW)


@query
def op6_token_counts(spark, sf):
    """Tokens of every document."""
    return count_tokens(table(spark, sf, "documents"), keep=["doc_id"], blank_runs=True)


@query
def op8_quality(spark, sf):
    """Quality of every document by positive-unlabelled learning."""
    return score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op4_embedding_near_dedup(spark, sf):
    """Links between embeddings of one label by collision counting."""
    return link_vectors(table(spark, sf, "embeddings"))


@query
def op12_sharding(spark, sf):
    """Documents in shards of near equal bytes, by virtual slots."""
    sharded = shard_documents(table(spark, sf, "documents"), keep=["doc_id"]).drop("virtual_slot")
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


ORACLES["op12_sharding"] = shards.ORACLE


@query
def op11_prefix_trie(spark, sf):
    """Shared beginnings of all conversations, by hashed blocks of turns."""
    return rebuilt_trie(table(spark, sf, "conversations"))


ORACLES["op11_prefix_trie"] = prefix_trie.ORACLE


@query
def op13_collocations(spark, sf):
    """Phrases of two or three words that go together, by language."""
    return collocations(table(spark, sf, "documents"))


ORACLES["op13_collocations"] = phrases.ORACLE
