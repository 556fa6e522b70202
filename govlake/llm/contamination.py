"""Benchmark decontamination by size-partitioned MinHash containment search (operator 9), with DataFrame functions only.

A document holds an item when at least ``num / den`` of the item's distinct
``width``-word shingles (lower case) are among the document's.

1. An item of q shingles must share ``need = ceil(num * q / den)``; its
   signature is its ``q - need + 1`` smallest shingle hashes (a bottom-k
   MinHash).  A document that holds the item has at least one of any that many
   shingles of it, so the search misses nothing.
2. Documents are partitioned by size (powers of two).  In each partition only
   items small enough to be held take part, and a document's own sketch is its
   hashes up to the largest signature hash of those items; it probes the
   signatures.
3. Candidates are read again and verified: the number of shared distinct
   shingles is counted exactly.

Cases: null and empty texts hold nothing and nothing holds them; an item of
fewer words than ``width`` is one shingle, found only in a document that
consists of it.  Repeated documents are reported as often as they occur.  An
item is an id with a text: equal rows count once, and each of several texts
under one id (or under none) is searched for and reported on its own; with
``by_text=False`` an id's texts are one item with the shingles of all.  Empty
tables give an empty result.  Only the id and text columns are read, so other
columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import private, stage
from .words import with_shingles, words

#: Signatures are broadcast up to so many rows (16 bytes each); beyond, they are joined by shuffling both sides.
BROADCAST_ROWS = 1_000_000


def _shingled(df: DataFrame, width: int) -> DataFrame:
    """Adds s, the distinct shingle hashes of ``text``."""
    return with_shingles(df.withColumn("w", words(F.lower("text"))), "w", "s", width).drop("w")


def _hinted(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _items(benchmark: DataFrame, item_id: str, item_text: str, width: int, num: int, den: int, by_text: bool) -> DataFrame:
    """item (its id, and the hash of its text where that tells it apart), g (a distinct shingle), place (from 1, by hash), need, probes (size of the signature)."""
    text = F.col(item_text).cast("string")
    own = F.when(F.lit(by_text) | F.col(item_id).isNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))
    plain = _shingled(benchmark.select(F.struct(F.col(item_id).alias("id"), own.alias("own")).alias("item"), text.alias("text")), width)
    whole = plain.select("item", F.explode("s").alias("g")).groupBy("item").agg(F.array_sort(F.collect_set("g")).alias("s"))
    q = F.size("s")
    need = F.ceil(q * num / den).cast("int")
    return stage(whole.select("item", need.alias("need"), (q - need + 1).alias("probes"), F.posexplode("s").alias("at", "g")).select(
        "item", "need", "probes", (F.col("at") + 1).alias("place"), "g"), "contamination-items")


def _bound(signatures: DataFrame) -> Column:
    """For a document of n shingles the largest signature hash of the items its size partition may hold; null if none."""
    by_need = signatures.select(F.floor(F.log2(F.col("need"))).cast("int").alias("c"), "g").groupBy("c").agg(F.max("g").alias("g"))
    bound, so_far = F.lit(None).cast("long"), None
    cases = []
    for r in sorted(by_need.collect(), key=lambda r: r.c):  # a row for each power of two
        so_far = r.g if so_far is None else max(so_far, r.g)
        cases.append((r.c, so_far))
    for c, g in cases:
        bound = F.when(F.col("n") >= 2 ** c, F.lit(g).cast("long")).otherwise(bound)
    return bound


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 5, num: int = 3, den: int = 4, id_col: str = "doc_id",
                 text_col: str = "text", item_id: str = "item_id", item_text: str = "text", by_text: bool = True) -> DataFrame:
    """(id, mark, item, n_shared, n_item): every document with every item that it holds, a row each; ``mark`` is the hash of the text."""
    text = F.col(text_col).cast("string")
    rows = docs.where(text.isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    items = _items(benchmark, item_id, item_text, width, num, den, by_text)
    n_items = items.count()
    signatures = items.where("place <= probes").select("item", "need", "g")
    sized = _shingled(rows, width).select("id", "mark", "s", F.size("s").alias("n")).withColumn("bound", _bound(signatures))
    sketch = sized.select("id", "mark", "n", F.explode(F.filter("s", lambda g: g <= F.col("bound"))).alias("g"))
    candidates = sketch.join(_hinted(signatures, n_items), "g").where("n >= need").select("id", "mark", "item").distinct()
    candidates = stage(candidates, "contamination-candidates")
    # only candidates are shingled again, each text once
    due = candidates.select(F.col("id").alias("due_id"), F.col("mark").alias("due_mark")).distinct()
    again = rows.join(due, F.col("id").eqNullSafe(F.col("due_id")) & (F.col("mark") == F.col("due_mark")), "left_semi").dropDuplicates(["id", "mark"])
    exact = _shingled(again, width).select("id", "mark", F.explode("s").alias("g"))
    shared = exact.join(_hinted(items.select("item", "need", "g"), n_items), "g").groupBy("id", "mark", "item", "need").agg(
        F.count(F.lit(1)).alias("n_shared")).where("n_shared >= need")
    found = shared.join(candidates.withColumnsRenamed({"id": "cid", "mark": "cmark", "item": "citem"}),
                        F.col("id").eqNullSafe(F.col("cid")) & (F.col("mark") == F.col("cmark")) & F.col("item").eqNullSafe(F.col("citem")), "left_semi")
    sizes = items.groupBy("item").agg(F.count(F.lit(1)).alias("n_item")).withColumnRenamed("item", "sized_item")
    return stage(found.join(sizes, F.col("item").eqNullSafe(F.col("sized_item"))).select("id", "mark", "item", "n_shared", "n_item"), "contamination-found")


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, item, n_shared, n_item) of every row of ``docs`` with every item that it holds."""
    found = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **how).withColumnsRenamed({"id": "found_id", "mark": "found_mark"})
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("mark"))
    return rows.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("mark") == F.col("found_mark"))).select(
        F.col("id").alias(id_col), F.col("item.id").alias(how.get("item_id", "item_id")), "n_shared", "n_item")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    own = private(docs)
    known, held, mark = map(own, ("id", "held", "mark"))
    found = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **how).select(F.col("id").alias(known), F.col("mark").alias(held)).distinct()
    marked = docs.withColumn(mark, F.xxhash64(F.col(text_col).cast("string")))
    return marked.join(found, F.col(id_col).eqNullSafe(F.col(known)) & (F.col(mark) == F.col(held)), "left_anti").drop(mark)


def q_op9(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: The same by definition: shingle texts joined, shared ones counted for each id and text of an item.
SQL_OP9 = r"""
WITH t AS (SELECT 'd' AS kind, doc_id AS id, '' AS of, text FROM documents UNION ALL SELECT DISTINCT 'b', item_id, md5(text), text FROM benchmark),
w AS (SELECT kind, id, of, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM t WHERE text IS NOT NULL),
s AS (SELECT kind, id, of, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END) AS g FROM w),
n AS (SELECT id, of, count(*) AS n_item FROM s WHERE kind = 'b' GROUP BY id, of)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared, any_value(n_item) AS n_item
FROM s d JOIN s b ON d.kind = 'd' AND b.kind = 'b' AND d.g = b.g JOIN n ON n.id IS NOT DISTINCT FROM b.id AND n.of = b.of
GROUP BY d.id, b.id, b.of HAVING 4 * count(*) >= 3 * any_value(n_item)
"""
