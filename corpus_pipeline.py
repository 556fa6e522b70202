"""A training corpus from raw documents: each stage calls one operator of govlake/llm, is written as Parquet and read again.

Stages, in order (every one works on all rows its predecessor kept, and all
but the last return the columns of ``documents``, whatever their names):

1. quality rules (operator 5): documents that it rejects go;
2. n-gram Jaccard join (operator 8): of each group of near duplicates the
   document with the smallest id stays (of its repeated rows one), and every
   document without a shingle;
3. benchmark decontamination (operator 9): documents that hold an item go;
4. PII (operator 6): the spans found are replaced in the text by their kind;
   ``n_chars`` follows the text;
5. best-fit packing (operator 2): the texts left, as pieces of token sequences.

When a stage begins, the result of the one before has been written, so the
tables that that one had put into the shared folder are removed.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.llm import contamination, jaccard, packing, pii, quality
from govlake.llm.stage import free, importable, noted, remove, stage

#: Folders of the tables behind the last stage's result.
_behind: list[str] = []


def _stage(step):
    """A stage works on columns with names of our own, and returns the caller's."""

    @functools.wraps(step)
    def run(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        remove(spark, _behind)
        _behind.clear()
        names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
        with noted(_behind):
            out = step(spark, docs.toDF(*names.values()), sf_dir, names)
        return out.select(*[F.col(own).alias(c) for c, own in names.items()]) if set(names.values()) <= set(out.columns) else out

    return run


@_stage
def keep_sound(spark, docs: DataFrame, sf_dir: str, names: dict[str, str]) -> DataFrame:
    return quality.apply_rules(docs, host=names["source"], text_col=names["text"]).where("kept")


@_stage
def keep_one_of_each_group(spark, docs: DataFrame, sf_dir: str, names: dict[str, str]) -> DataFrame:
    """Of each component the rows with its smallest (id, text hash), once; rows without a shingle all stay."""
    number, text = names["doc_id"], names["text"]
    mark = F.xxhash64(F.coalesce(text, F.lit("")))
    with noted([]) as used:
        members = jaccard.near_duplicates(docs.select(F.struct(F.col(number).alias("doc_id"), mark.alias("mark")).alias("row"), F.col(text).alias("text")), id_col="row")
        heads = members.where((F.col("n_shingles") == 0) | (F.col("component_id") == F.col("row"))).groupBy(
            F.col("row.doc_id").alias("id"), F.col("row.mark").alias("head")).agg(((F.count(F.lit(1)) > 1) & (F.max("n_shingles") > 0)).alias("repeated"))
        heads = stage(heads, "corpus-heads")
    remove(spark, [path for path in used if path not in heads._staged])
    marked = docs.withColumn("mark", mark)
    kept = [marked.join(heads.where(which), F.col(number).eqNullSafe(F.col("id")) & (F.col("mark") == F.col("head")), "left_semi") for which in ("NOT repeated", "repeated")]
    # texts are sent once: only rows that stand there more than once meet by their key, one from each task
    one = kept[1].groupBy(number, "mark").agg(F.first(F.struct(*names.values())).alias("row")).select("row.*")
    return kept[0].drop("mark").unionByName(one)


@_stage
def drop_benchmarks(spark, docs: DataFrame, sf_dir: str, names: dict[str, str]) -> DataFrame:
    return contamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=names["doc_id"], text_col=names["text"], by_text=True)


@_stage
def mask_personal_data(spark, docs: DataFrame, sf_dir: str, names: dict[str, str]) -> DataFrame:
    clean = pii.sanitise(docs, id_col=names["doc_id"], text_col=names["text"])
    if "n_chars" not in names:
        return clean
    changed = F.when(F.col(names["text"]).isNull(), F.col(names["n_chars"])).otherwise(F.length(names["text"]).cast("long"))
    return clean.withColumn(names["n_chars"], changed)


@_stage
def pack(spark, docs: DataFrame, sf_dir: str, names: dict[str, str]) -> DataFrame:
    return packing.pack_documents(docs.select(F.col(names["doc_id"]).alias("doc_id"), F.col(names["text"]).alias("text")))


STAGES = [
    ("quality_rules", keep_sound),
    ("near_duplicates", keep_one_of_each_group),
    ("benchmark_decontamination", drop_benchmarks),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: SQL can't run the tokenizer of the last stage; tests/llm/test_pipeline.py has a brute-force version of all stages.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        before, docs = docs, step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"corpus-{name}")
            free(before)
    return docs
