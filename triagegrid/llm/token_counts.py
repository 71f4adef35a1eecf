"""Exact token counts by a length histogram.

Every whole text is encoded once and only its length is kept. Documents are counted by length; sums over the longer lengths then
answer, for every context limit, how many documents are cut, how many tokens remain and where the quantiles lie.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagegrid.llm.common import Local, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that cuts texts for this public vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lengths in one block of the sums.
BLOCK = 1024


_encodings = Local()


def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    if (len(ranks), pattern) not in _encodings:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _encodings[len(ranks), pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _encodings[len(ranks), pattern]


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``length`` of every row's whole text in tokens, however long; null and empty texts have none, rows given twice count twice.

    Special tokens in a text are ordinary text. No rows give no rows. Columns other than the text are not looked at.
    """
    with open(vocabulary, "rb") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        encoding = _encoding(held.value, pattern)
        for batch in batches:
            made = [len(encoding.encode_ordinary(t.as_py() or "")) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.int64())], names=["length"])

    return docs.select("text").mapInArrow(run, "length long")


def length_histogram(docs: DataFrame, **how: str) -> DataFrame:
    """length, documents."""
    return token_lengths(docs, **how).groupBy("length").agg(F.count("*").alias("documents"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length that occurs: length, documents, longer (documents), longer_tokens, total_documents, total_tokens.

    Blocks of lengths are summed first, so no window runs over more than the blocks or one block. No rows give no rows.
    """
    h = stored(histogram.withColumn("block", F.floor(F.col("length") / BLOCK)), "histogram")
    tokens = F.col("length") * F.col("documents")
    block = h.groupBy("block").agg(F.sum("documents").alias("bd"), F.sum(tokens).alias("bt"))
    after = Window.partitionBy(F.lit(0)).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    zero = F.lit(0).cast("long")
    block = block.select(
        "block", F.coalesce(F.sum("bd").over(after), zero).alias("bd"), F.coalesce(F.sum("bt").over(after), zero).alias("bt"),
        F.sum("bd").over(every).alias("total_documents"), F.sum("bt").over(every).alias("total_tokens"),
    )
    inner = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    within = h.withColumn("d", F.coalesce(F.sum("documents").over(inner), zero)).withColumn("t", F.coalesce(F.sum(tokens).over(inner), zero))
    return within.join(block, "block").select(
        "length", "documents", (F.col("bd") + F.col("d")).alias("longer"), (F.col("bt") + F.col("t")).alias("longer_tokens"), "total_documents", "total_tokens"
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """For each limit: context_limit, cut (documents longer than it), kept_tokens (total with every text truncated to it).

    A limit lies between two lengths: documents longer than the largest length up to it are cut, and keep the limit's tokens.
    """
    asked = sums.withColumn("context_limit", F.explode(F.array(*(F.lit(x).cast("long") for x in limits))))
    over = F.col("length") > F.col("context_limit")
    cut = F.coalesce(F.sum(F.when(over, F.col("documents"))), F.lit(0))
    short = F.coalesce(F.sum(F.when(~over, F.col("length") * F.col("documents"))), F.lit(0))
    return asked.groupBy("context_limit").agg(cut.alias("cut"), (short + F.col("context_limit") * cut).alias("kept_tokens"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """For each share: share, length: the smallest length that at least that share of the documents doesn't exceed."""
    asked = sums.withColumn("share", F.explode(F.array(*(F.lit(float(x)) for x in shares))))
    upto = F.col("total_documents") - F.col("longer")
    return asked.filter(upto >= F.col("share") * F.col("total_documents")).groupBy("share").agg(F.min("length").alias("length"))


def token_table(docs: DataFrame) -> DataFrame:
    """What every context limit asks for, at each length that occurs: context_limit, documents, longer, share_within, kept_tokens, total_tokens."""
    kept = F.col("total_tokens") - F.col("longer_tokens") + F.col("longer") * F.col("length")
    share = (F.col("total_documents") - F.col("longer")) / F.col("total_documents")
    return suffix_sums(length_histogram(docs)).select(
        F.col("length").alias("context_limit"), "documents", "longer", F.round(share, 9).alias("share_within"), kept.alias("kept_tokens"), "total_tokens"
    )
