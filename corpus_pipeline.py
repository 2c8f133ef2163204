"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it
as Parquet and gives the reread table to the next stage. Stages 1 to 4 return
the columns of documents; the last one returns packed pieces.

1. language: documents without a recognisable language go.
2. near_duplicates: of each group of linked documents the one with the smallest id stays.
3. decontamination: contaminated documents go; from others the spans of test items are cut.
4. secrets: confirmed secrets are replaced by a mark.
5. packing: what is left is tokenised and packed into sequences.

Null and empty texts have no language and go in stage 1. Rows that repeat are
judged alike; of identical rows (same id and text) stage 2 keeps them all, as
they are one document. An empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import decontamination, jaccard_join, language, packing, secret_scan, tokens
from gridlake.llm.common import Stage, ship, table

MIN_SCORE = 0.5

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(df: DataFrame, cut: bool = False) -> DataFrame:
    """The columns of documents; n_chars follows a text that was cut."""
    n_chars = F.length("text").cast("long").alias("n_chars") if cut else F.col("n_chars")
    return df.select("doc_id", "text", "lang", "source", n_chars)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship(spark)
    model = language.train(docs, language.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    return _columns(language.identify(docs, model).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE)))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = jaccard_join.jaccard_join(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return _columns(docs.join(gone, "doc_id", "left_anti"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = decontamination.mark(docs, table(spark, sf_dir, "benchmark"))
    kept = marked.where(~decontamination.contaminated(F.col("n_hit"), F.col("n_words")))
    return _columns(decontamination.cut_spans(kept), cut=True)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(secret_scan.redact(docs), cut=True)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokens.default_path())


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the language model nor the forest nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, apply) in enumerate(STAGES):
        docs = stage.write(apply(spark, docs, sf_dir), name)
        if i:
            stage.drop(STAGES[i - 1][0])
    return docs
