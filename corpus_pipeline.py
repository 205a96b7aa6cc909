"""The corpus pipeline: every stage takes (spark, docs, sf_dir) and works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import lines, minhash, mixing, pieces, quality
from tabulon.llm.steps import Steps

#: The first four stages return these columns.
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]
#: Similarity in percent from which documents are near copies.
NEAR = 80


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of documents; n_chars is the length of the text as it is now, null for a null text."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go. Fitted on the labelled rows of ``docs``; rows keep as they are."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = docs.select(*DOCUMENT)
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.filter("predicted = 1").select(*DOCUMENT)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that repeat too often keep one occurrence; documents left without text go, however little is left of others stays."""
    return _documents(lines.dedup_lines(docs.select(*DOCUMENT), min_left=0).filter("kept"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup at a similarity of 0.8: one row of each group stays, the one with the smallest doc_id, a null one
    last. Every row is a document of its own, whatever its doc_id, so no text goes that no near copy stands for. Texts without words stay."""
    # the rows are numbered in a written table, so a number names the same row wherever it is read
    docs = Steps(spark, "near").write(docs.select(*DOCUMENT).withColumn("row", F.monotonically_increasing_id()))
    near = minhash.near_duplicates(docs.select(F.col("row").alias("doc_id"), "text"), percent=NEAR)
    near = near.select(F.col("doc_id").alias("row"), "component_id").join(docs.select("row", "doc_id"), "row")
    first = near.groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row")).alias("first"))
    return docs.join(first.select("first.row").hint("merge"), "row", "left_semi").select(*DOCUMENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: every row as often as the mix takes it, also rows without a doc_id and rows that repeat one. Texts
    without words are never taken, so they go."""
    # the rows are numbered in a written table, so a number names the same row wherever it is read
    docs = Steps(spark, "mixed").write(docs.select(*DOCUMENT).withColumn("row", F.monotonically_increasing_id()))
    copies = mixing.mix(docs, keep=("row",)).filter("copies > 0").select("row", "copies")
    rows = docs.join(copies.hint("merge"), "row").withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    return rows.select(*DOCUMENT)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding: (doc_id, lang, source, n_chars, ids, n_pieces), one row per row of ``docs``."""
    return pieces.encode(docs.select(*DOCUMENT), pieces.load_pieces()).drop("text")


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", to_pieces),
]

#: A trained classifier, Newton iterations and connected components have no SQL form; tests/llm has the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = Steps(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        after = steps.write(stage(spark, docs, sf_dir))
        steps.drop(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
