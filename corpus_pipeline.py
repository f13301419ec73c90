"""From raw documents to packed training sequences.

Stages, each over all that the one before kept, each written and read again: toxic documents go; lines that break
the quality rules go, and documents that lose too much; one document of each group of near copies stays;
passages that repeat across documents stay in one of them; what is left is packed into windows of ids.

Null and repeated ids, null texts and empty tables are handled as each operator's module says. All stages but the
last return the columns of their input; ``n_chars``, where there is one, follows the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import chunks, jaccard, packing, quality, toxicity
from orderlens.llm.queries import remainder, vocabulary
from orderlens.llm.store import temporary, unused, written
from orderlens.session import ensure_utc

WINDOW, END_ID, MAX_TOXIC = 4096, 2, 0.3


def _with_text(rows: DataFrame, columns: dict[str, Column], text: Column) -> DataFrame:
    """The columns with a new text and the length that belongs to it."""
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return rows.select(*[new[c].alias(c) if c in new else old.alias(c) for c, old in columns.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels, remainder(4) != 2)
    name = unused(docs, "score")
    return toxicity.score(docs, model, out=name).where(F.col(name) < MAX_TOXIC).drop(name)


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # As a struct beside the text, the row's columns meet no name of the rules; the number keeps the filter above
    # the rules: moved below, it would repeat all their expressions.
    plain = docs.select(F.struct("*").alias("own"), "text")
    judged = quality.judged(plain).withColumn("_at", F.monotonically_increasing_id())
    kept = judged.where(F.col("q.kept") & (F.col("_at") >= 0)).select("own", F.col("q.cleaned").alias("cleaned"))
    return _with_text(kept, {c: F.col("own").getField(c) for c in docs.columns}, F.col("cleaned"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Numbers follow the partitions of a read, and these the cores of the moment: written once, they stay the same.
    number = unused(docs, "row")
    numbered = written(docs.withColumn(number, F.monotonically_increasing_id()), "pipeline-numbered", codec="zstd")
    kept = jaccard.linked_documents(numbered, row=number).where("kept").select(F.col("row").alias(number))
    return numbered.join(kept, number, "left_semi").drop(number)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A column called spans would give way to the operator's own.
    name = unused(docs, "own")
    others = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c != "text"]
    cut = chunks.without_repeats(docs.select("doc_id", "text", F.struct(*others).alias(name)))
    left = cut.where(F.rlike("text", F.lit(r"[^ \t-\r]")))  # nothing but repeats: nothing to train on
    rest = {c: F.col("text") if c == "text" else F.col(name).getField(c) for c in docs.columns}
    return _with_text(left, rest, F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"), WINDOW, END_ID)
    return packing.sequences(pieces).withColumn("doc_ids", F.transform("pieces", lambda p: p["doc_id"]))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", clean_lines),
    ("near copies", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]

#: A classifier is trained on the way, so SQL cannot state the result; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read by the next.

    What a stage has written besides is deleted with the stage.
    """
    ensure_utc(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with temporary(spark):
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}", keep=True)
    return docs
