"""A corpus-cleaning pipeline over the documents table.

Each stage reads what its predecessor wrote. All but the last return the columns of documents, whatever further columns there are;
names that a stage makes for itself are chosen apart from them. An empty table gives an empty one in every stage. Texts are read
whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagegrid.llm import decontaminate, ngram_join, pieces, quality, secret_scan
from triagegrid.llm.common import stored, table, unused


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier accepts stay.

    Null and empty texts get the score of an empty document. Rows without an id and repeated rows are judged each. Without labels
    every score is about one half and everything stays.
    """
    score = unused(docs, "score")
    scored = quality.with_scores(docs, quality.train(docs, table(spark, folder, "labels")), score)
    return scored.filter(F.col(score) >= quality.LIMIT).select([F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents whose shingle sets link, directly or through others, the one with the smallest id stays, once.

    Null and empty texts link with nothing and stay. Of rows repeated with one id and one text a single one stays. Rows without an
    id, and rows of an id that stands for different texts, can't be told apart by their ids; they take no part and all stay.
    """
    text = F.struct(*[F.xxhash64(F.coalesce("text", F.lit("")), F.lit(seed)) for seed in (1, 2)])
    ids = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), (F.min(text) == F.max(text)).alias("alike"))
    again = stored(ids.filter("n > 1"), "repeated-ids")
    if again.isEmpty():
        several, single = None, docs
    else:
        mixed = again.filter("NOT alike").select("doc_id")
        several, single = docs.join(mixed, "doc_id", "left_semi").select(docs.columns), docs.join(mixed, "doc_id", "left_anti").select(docs.columns)
    groups = ngram_join.jaccard_components(single.select("doc_id", "text"))
    keep = groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = single.join(keep, "doc_id", "left_semi").select(docs.columns)
    if several is not None:
        row, repeated = unused(docs, "row"), again.filter("alike").select("doc_id")
        first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])))
        once = kept.join(repeated, "doc_id", "left_semi").withColumn(row, first).filter(F.col(row) == 1)
        kept = kept.join(repeated, "doc_id", "left_anti").select(docs.columns).union(once.select(docs.columns)).union(several)
    return kept.union(docs.filter("doc_id IS NULL"))


def without_benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold benchmark items go.

    Rows are judged by id and text together, so rows without an id are judged, too, rows of one id with different texts each for itself,
    and repeated rows alike. Null and empty texts hold nothing and stay. An empty benchmark leaves everything.
    """
    key = unused(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    held = decontaminate.contaminated(keyed.select(F.col(key).alias("doc_id"), "text"), table(spark, folder, "benchmark"))
    held = held.select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(held, key, "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets in texts are replaced by a mark, and the count of characters is renewed. Every row stays; null texts stay null."""
    return secret_scan.redact_secrets(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids and their number in place of texts. Every row stays; null and empty texts have no ids."""
    return pieces.encode_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmarks),
    ("secret scans", without_secrets),
    ("SentencePiece encoding and decoding", as_tokens),
]

#: No SQL expresses the classifier and the tokens; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
