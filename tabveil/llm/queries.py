"""The registered queries of this package and their SQL: one ``opN_<name>`` for each operator."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabveil.llm import oracle
from tabveil.llm.common import read
from tabveil.llm.conversations import damaged, repair, with_digests
from tabveil.llm.decontamination import contaminated_documents
from tabveil.llm.fill_middle import fill_in_middle, restored
from tabveil.llm.jaccard_join import similar_documents
from tabveil.llm.license_scan import known_licences, license_matches
from tabveil.llm.line_dedup import later_lines, without_lines
from tabveil.llm.minhash_dedup import near_copies
from tabveil.llm.piece_sampling import sample_pieces
from tabveil.llm.quality_rules import calibrate, judge
from tabveil.llm.secret_ledger import BASE, joined, scan_paths
from tabveil.llm.token_counts import count_tokens
from tabveil.llm.token_frames import read_shards, write_shards
from tabveil.llm.warc import read_archives, write_archives
from tabveil.session import scratch_folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_folder(spark)}/tabveil/{label}-{uuid.uuid4().hex}"


def tokenizer_file(name: str) -> bytes:
    """A file of the installed public tokenizers, read on the driver; tasks get its bytes."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


END_ID = 2


def op1_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' ids written to shards, then read back from them."""
    docs = read(spark, folder, "documents")
    model = tokenizer_file("word_bpe_49k.json")
    manifest = write_shards(docs, fresh_folder(spark, "shards"), model, END_ID)
    return read_shards(manifest).drop("shard")


def op2_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near copies among all documents, by 2-word shingles."""
    return near_copies(read(spark, folder, "documents"), size=2).drop("mark", "group")


def op3_piece_sampling(spark: SparkSession, folder: str) -> DataFrame:
    """Sampled pieces of all documents, decoded again."""
    docs = read(spark, folder, "documents")
    made = sample_pieces(docs, tokenizer_file("piece_bpe_32k.model"), keep=("doc_id", "text"))
    return made.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines that an earlier line resembles."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    made = without_lines(docs, later_lines(docs), "doc_id", "text")
    return made.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.col("rest").alias("text"), "emptied"
    )


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to archives, then read back through verified boundaries."""
    manifest = write_archives(read(spark, folder, "pages"), fresh_folder(spark, "warc"))
    return read_archives(manifest, payloads=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Piece counts and best scores of all documents."""
    return count_tokens(read(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op6_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All secrets of all documents, through a ledger that starts empty."""
    docs = read(spark, folder, "documents")
    scanned = scan_paths(docs, fresh_folder(spark, "ledger"), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", *[count(kind) for kind in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdicts of all documents, cutoffs from all labels."""
    docs = read(spark, folder, "documents")
    chosen = calibrate(docs, read(spark, folder, "labels"))
    return judge(docs, chosen).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
    )


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Known licences as whole texts or whole lines of all documents."""
    found = license_matches(read(spark, folder, "documents"), known_licences(spark))
    return found.withColumn("notices", F.array_join("notices", ","))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in all documents."""
    return contaminated_documents(read(spark, folder, "documents"), read(spark, folder, "benchmark")).drop("mark")


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents cut at line ends and put in another order, with the digests of the output and of the text made from it."""
    made = fill_in_middle(read(spark, folder, "documents"))
    return made.select(
        F.col("row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents that share most of their 5-word shingles."""
    return similar_documents(read(spark, folder, "documents")).drop("mark", "group")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged by a checksum and repaired at the least cost."""
    rows = damaged(read(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    return with_digests(*repair(rows)).withColumnRenamed("conv", "conv_id")


QUERIES = {
    "op1_token_frames": (op1_token_frames, None),
    "op2_minhash_dedup": (op2_minhash_dedup, oracle.NEAR_COPIES),
    "op3_piece_sampling": (op3_piece_sampling, None),
    "op4_line_dedup": (op4_line_dedup, oracle.LINES),
    "op5_warc": (op5_warc, oracle.ARCHIVES),
    "op7_token_counts": (op7_token_counts, None),
    "op6_secret_ledger": (op6_secret_ledger, oracle.SECRETS),
    "op8_quality_rules": (op8_quality_rules, oracle.QUALITY),
    "op9_license_scan": (op9_license_scan, oracle.LICENCES),
    "op10_decontamination": (op10_decontamination, oracle.LEAKS),
    "op11_fill_middle": (op11_fill_middle, oracle.MIDDLES),
    "op12_jaccard_join": (op12_jaccard_join, oracle.SIMILAR),
    "op13_conversation_repair": (op13_conversation_repair, oracle.REPAIRS),
}
