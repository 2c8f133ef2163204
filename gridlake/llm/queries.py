"""The registered queries of this folder: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, embeddings, fixity, jaccard_join, language, mixing, packing, phrases, repeats, secret_scan, token_files, tokens, toxicity, whitening
from .common import Stage, held_out, table, texts


def _ids(items: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ",")


def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokens.default_path())


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Stage(spark, 'token-ids').base}/files"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokens.default_path(), end_id=2)
    return token_files.read_documents(spark, path).drop("ids")


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    fold = F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return scored.select("doc_id", fold, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontamination.mark(texts(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(_ids(F.col("items")), 256).alias("items_sha256"),
        decontamination.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, language.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    return language.op_frame(docs, model)


def scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("secret_sha256"), "probability")


def fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of pages against a replica with damage in known places."""
    pages = table(spark, sf_dir, "pages")
    return fixity.ledger(fixity.Tree(fixity.records(pages), "a"), fixity.Tree(fixity.records(fixity.bit_rot(pages)), "b"))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated(table(spark, sf_dir, "documents")).drop("text_key")


def near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc.doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_embedding_near_dedup": near_embeddings,
    "op2_secret_scan": scan_secrets,
    "op3_best_fit_packing": pack,
    "op4_ngram_jaccard_join": jaccard,
    "op5_token_id_files": token_ids,
    "op6_toxicity": toxic,
    "op7_benchmark_decontamination": decontaminate,
    "op8_warc_fixity": fixity_audit,
    "op9_language_id": languages,
    "op10_line_dedup": repeated_lines,
    "op11_collocations": collocations,
    "op12_whitening": whitened,
    "op13_source_mix": mixed_sources,
}
