"""Token counts through a digest cache (operator 7).

The cache is a Parquet table (content_digest, tokenizer_digest, n_tokens).  A
document's key is the SHA-256 of its normalised content (the UTF-8 bytes; null
is empty) with the SHA-256 of the tokenizer's file.  Documents are joined to
the cache; of those that miss, each distinct content is encoded once, and the
new counts are appended before the documents are joined again.

Cases: a null or empty text has no bytes and no tokens.  Repeated rows give
repeated rows.  An empty table gives an empty one.  Null ids are kept.  Only
``id_col`` and ``text_col`` are read; other columns may have any name.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import new_folder, stage, tokenizer_path
from .tokens import PieceCounts, opened

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"
#: Rows handed to a Python worker at once; bounds its memory on long texts.
BATCH = 500


def tokenizer_digest(name: str) -> str:
    with open(tokenizer_path(name), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _encode(name: str):
    def run(batches):
        lib = opened(PieceCounts, name)
        for b in batches:
            counts = [lib.count(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("content_digest"), pa.array(counts, pa.int64())], ["content_digest", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", cache: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row of ``docs``.

    ``cache``: folder of the stored counts, which grows by the misses; None
    begins an empty one in the shared folder.  Misses are deduplicated inside
    each task before they are shuffled (a text held by a third of all rows is
    sent once a task), and the text itself travels only with the misses.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    path = cache or new_folder(spark, "token-cache")
    content = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), content.alias("text")).withColumn(
        "content_digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))

    def stored() -> DataFrame:
        try:
            old = spark.read.schema(CACHE_SCHEMA).parquet(path)
        except Exception as e:  # no cache yet: its folder doesn't exist
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = spark.createDataFrame([], CACHE_SCHEMA)
        return old.where(F.col("tokenizer_digest") == version).groupBy("content_digest").agg(F.min("n_tokens").alias("n_tokens"))

    first = keyed.join(stored(), "content_digest", "left_anti").groupBy("content_digest").agg(F.first("text").alias("text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    new = first.mapInArrow(_encode(tokenizer), "content_digest binary, n_tokens long")
    new.select("content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens").write.mode("append").parquet(path)
    # ids and digests are narrow: the second join moves no texts, and as both sides are
    # plain tables a digest that a third of all rows have is split by adaptive execution
    sizes = stage(keyed.select("id", "content_digest", F.octet_length("text").cast("long").alias("n_bytes")), "token-sizes")
    out = sizes.join(stage(stored(), "token-counts"), "content_digest")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def q_op7(spark, sf_dir: str) -> DataFrame:
    """Contract query: counts of every document, and whether they pass 4096 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))
