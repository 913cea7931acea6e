"""From raw documents to token ids: five stages, each of which works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.decontaminate import remove_hits
from panelkit.llm.langid import predict_language, train_language_model
from panelkit.llm.pieces import encode_decode, load_vocabulary
from panelkit.llm.simhash import keep_one
from panelkit.llm.substring import remove_repeats
from panelkit.session import fresh_path

#: Where the tokenizer's files lie; the model is read on the driver and never copied.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No stage but the second and third can be said in SQL: the first is a trained model, the last a tokenizer.
ORACLE_SQL = None



def _with_text(docs: DataFrame, text) -> DataFrame:
    return docs.withColumn("text", text).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)).select(*DOCUMENTS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough certainty; the model learns from this stage's own labelled documents, and none
    stays if none is labelled. Null and empty texts, and texts without a letter, have no language and go. Rows are judged one by one, so
    repeated ones stay or go together; a null lang is not learned from, a null id neither, but both are judged."""
    model = train_language_model(docs, required=False)
    rows = docs.select(F.struct(*[c for c in DOCUMENTS if c != "text"]).alias("row"), "text")
    kept = predict_language(rows, model, "row", with_text=True).filter("accepted")
    return kept.select("row.*", "text").select(*DOCUMENTS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id. Null, empty and wordless texts are copies of each other (they
    have the fingerprint zero), so one of them stays. Of repeated rows one stays; rows without an id stay only in groups without any."""
    return keep_one(docs.select(*DOCUMENTS), size=4, distance=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 35 words or more that occur elsewhere too; the words left are joined by spaces. Documents that lose
    nothing keep their text as it is, null and empty ones too. Every occurrence goes, the first as well; of rows that are equal in all a
    text of 35 words or more loses its words in each."""
    found = remove_repeats(docs, 35, carry=tuple(DOCUMENTS)).select("carried.*", "n_removed", "kept")
    return _with_text(found, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that lie in any occurrence of ten benchmark words; all rows stay, repeated ones, null and empty texts as
    they are."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_text(remove_hits(docs.select(*DOCUMENTS), benchmark, 10), F.col("text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they spell its text. A null text has null ids, an empty one none; every row gives one."""
    return encode_decode(docs, load_vocabulary(MODEL_FILE)).select("doc_id", "n_pieces", "pieces", F.sha2("decoded", 256).alias("decoded_sha256"), "lossless")


STAGES = [("language ID", language), ("SimHash near-dedup", near_duplicates), ("substring dedup", repeated_passages),
          ("benchmark decontamination", benchmark_passages), ("SentencePiece", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            path = fresh_path(spark, f"stage-{number}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
