"""N-gram Jaccard join by grouped prefixes (operator 8).

A document's set is its distinct ``width``-word shingles (A-Z folded); two
documents link when their sets' Jaccard similarity is at least
``num / den``.  Steps:

1. Shingles are put in one order for all documents: those whose hash bucket
   is far above the mean come last (a counter array of fixed size, counted
   over all documents), else by hash.
2. Documents with equal sets are one class (16-byte set digest).  Classes with
   an identical prefix and size are one group, whatever their number.
3. Groups that share prefix shingles are candidates: within each shingle's
   run, sorted by size, a group is first paired with the one before it and
   with the run's hub, its group with the most frequent shingles (the text
   that a family of near copies has in common).  Candidates that pass the size
   and the count filter are expanded to classes and verified on their whole
   texts, and links give first components.
4. What is left are pairs of classes that share prefix shingles (or the whole
   prefix, inside a group) and lie in different components: all of these that
   pass the size, position and count filter are verified too.  So no link
   between components is lost, and no family of near copies is ever expanded
   into all its pairs.

The position filter: at the first shared shingle neither set may have fewer
shingles left than the overlap that the threshold asks for.  The count filter:
of sets x and y let x's prefix end first in the common
order.  Then x's shingles outside both prefixes are at most those after its
prefix, so the shared prefix shingles must make up the rest of the overlap
that the threshold asks for.  A pair's shared shingles are counted on arrays
of 16 bits a shingle, which the class brings along whole: a pair is one row,
not one for each shingle of its sets, and a count too high by equal bits only
sends a pair to the exact verification.

``all_links`` keeps also the pairs inside components and so returns every link.

Cases: null and empty texts and texts without words have no shingle and link
with nothing; a text of fewer words is one shingle.  Repeated rows are members
of one class.  Rows with a null id have a component like others: its
smallest non-null id.  An empty table gives an empty result.  Only ``id_col``
and ``text_col`` are read, so other columns may have any name.  Set and shingle
hashes have 128 and 64 bits; a link could only change by a hash collision.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .shingles import as_bytes, shingle_sets
from .stage import free, stage

BATCH = 500
#: Buckets of the counter array, and bits of the set of wanted classes: both bounds hold at any input size.
SKETCH_BITS, WANTED_BITS = 17, 20
#: Set digests that a task remembers, so as to send the prefix of a repeated set once.
REMEMBERED = 100_000
#: Bits of a shingle that are enough to count what two prefixes share; fewer only send more pairs to the verification.
PACKED = 0xFFFF
#: Parts of all shingles whose runs are formed one part after another.
SLICES = 3


def _count_buckets(width: int):
    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for s in shingle_sets(as_bytes(b.column("text")), width):
                total += np.bincount(s >> np.uint64(64 - SKETCH_BITS), minlength=1 << SKETCH_BITS) if len(s) > 5000 else 0
                if len(s) <= 5000:
                    np.add.at(total, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    return run


def _heat(texts: DataFrame, width: int) -> np.ndarray:
    """A level for each bucket: 0 unless its count is six deviations above the mean, else the logarithm of the excess."""
    counts = texts.mapInArrow(_count_buckets(width), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(1 << SKETCH_BITS)
    total[counts["bucket"].to_numpy(int)] = counts["n"].to_numpy(float)
    mean = total.mean()
    over = total - mean
    return np.where(over > 6 * np.sqrt(mean) + 6, np.ceil(np.log2(np.maximum(over, 1))), 0).astype(np.uint8)


def _set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _profiles(width: int, num: int, den: int, heat: np.ndarray):
    def run(batches):
        seen: set[bytes] = set()
        for b in batches:
            keys, sizes, tags, hots, prefixes = [], [], [], [], []
            for s in shingle_sets(as_bytes(b.column("text")), width):
                key, n = _set_key(s), len(s)
                level = heat[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = s[np.lexsort((s, level))]
                prefix = order[: n - -(-num * n // den) + 1] if n else s
                keys.append(key)
                sizes.append(n)
                hots.append(int(np.count_nonzero(level)))
                tags.append(int.from_bytes(hashlib.blake2b(prefix.tobytes(), digest_size=8).digest(), "little", signed=True))
                if key in seen:
                    prefixes.append(None)
                else:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    prefixes.append(prefix.view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(tags, pa.int64()),
                                              pa.array(hots, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))], ["id", "key", "n", "tag", "hot", "prefix"])

    return run


def _texts_of(width: int, wanted: np.ndarray):
    """(key, text) of the documents whose set may be wanted, each set once a task (as long as it is remembered)."""

    def run(batches):
        seen: set[bytes] = set()
        for b in batches:
            texts, keys, out = as_bytes(b.column("text")), [], []
            for t, s in zip(texts, shingle_sets(texts, width)):
                key = _set_key(s)
                if not len(s) or key in seen or not wanted[int.from_bytes(key[:4], "big") >> (32 - WANTED_BITS)]:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                keys.append(key)
                out.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.binary())], ["key", "text"])

    return run


def _verify(width: int, num: int, den: int):
    def run(batches):
        for b in batches:
            sets = shingle_sets(as_bytes(b.column("text_a")) + as_bytes(b.column("text_b")), width)
            n = b.num_rows
            keep = []
            for x, y in zip(sets[:n], sets[n:]):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _prefix(n, num: int, den: int):
    """Length of the prefix of a set of n."""
    return n - F.ceil(n * num / den) + 1


def _size_fits(num: int, den: int, n: str, m: str):
    return (F.least(n, m) * den >= F.greatest(n, m) * num) if n != m else F.lit(True)


def _place_fits(num: int, den: int):
    """Whether a first shared shingle at pos_x and pos_y leaves enough of both sets."""
    left = F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))
    return left * (num + den) >= (F.col("n_x") + F.col("n_y")) * num


def _count_fits(num: int, den: int, n: str, m: str, shared):
    """Whether ``shared`` prefix shingles may be enough for sets of n and m."""
    after = [F.col(k) - _prefix(F.col(k), num, den) for k in (n, m)]
    return (shared + F.greatest(*after)) * (num + den) >= (F.col(n) + F.col(m)) * num


def jaccard_join(docs: DataFrame, width: int = 5, num: int = 3, den: int = 4, all_links: bool = False, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, links).

    members: id, key, n_shingles and component_id of every row; classes: cid, key, n, doc (its smallest id), component;
    links: verified pairs of classes a, b - all of them with ``all_links``, else enough for the components.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    kind = docs.select(id_col).dtypes[0][1]
    texts = docs.select(F.col(id_col).cast("long" if kind == "void" else kind).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.dtypes[0][1]
    heat = _heat(texts.select("text"), width)
    wide = stage(texts.mapInArrow(_profiles(width, num, den, heat), f"id {kind}, key binary, n long, tag long, hot long, prefix array<long>"), "jaccard-rows")
    sets = wide.where("n > 0").groupBy("key", "n", "tag").agg(F.min("id").alias("doc"))
    # a group's prefix travels once, however many tasks and classes hold it
    groups = stage(wide.where("prefix IS NOT NULL AND n > 0").groupBy("n", "tag").agg(F.first("prefix").alias("prefix"), F.max("hot").alias("hot"))
                   .withColumn("g", F.monotonically_increasing_id()), "jaccard-groups")
    classes = stage(sets.join(groups.select("n", "tag", "g"), ["n", "tag"]).select("key", "n", "doc", "g", F.monotonically_increasing_id().alias("cid")), "jaccard-classes")
    rows = stage(wide.select("id", "key", "n"), "jaccard-members")
    free(wide)

    # prefix shingles that more than one group has; a row keeps the group before it in its shingle's run, and the run's hub
    tokens = groups.select("g", "n", "hot", F.posexplode("prefix").alias("pos", "token")).select(
        "token", "g", "n", (F.least("hot", F.lit((1 << 31) - 1)) * F.lit(1 << 32) + F.col("pos")).alias("place"))
    run = Window.partitionBy("token").orderBy("n", "g")
    hub = F.max(F.struct(F.shiftright("place", 32).alias("hot"), "n", "g")).over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    met = [*[F.lag(k).over(run).alias(f"before_{k}") for k in ("n", "g")], F.lead("g").over(run).alias("after_g"), hub.alias("hub")]
    # a slice of the shingles at a time: the prefixes are read for each, but only a slice's rows are in shuffle files at once
    slices = [stage(tokens.where(F.pmod("token", F.lit(SLICES)) == i).select("token", "g", "n", "place", *met).where("before_g IS NOT NULL OR after_g IS NOT NULL").select(
        "token", "g", "n", F.col("place").bitwiseAND((1 << 32) - 1).alias("pos"), "before_n", "before_g", F.col("hub.n").alias("hub_n"), F.col("hub.g").alias("hub_g")),
        "jaccard-tokens") for i in range(SLICES)]
    shared = functools.reduce(DataFrame.unionByName, slices)
    free(groups)

    heads = classes.groupBy("g").agg(F.min("cid").alias("head"), F.count(F.lit(1)).alias("members"))
    crowded = heads.where("members > 1")
    inside = classes.join(crowded, "g").where("cid != head")
    # half of what the count filter asks for is enough here: a run's neighbour and hub may change from shingle to shingle
    met = [shared.where(F.col(f"{k}_g") != F.col("g")).select("g", "n", F.col(f"{k}_g").alias("h"), F.col(f"{k}_n").alias("m")).where(_size_fits(num, den, "n", "m"))
           .groupBy("g", "n", "h", "m").agg(F.count(F.lit(1)).alias("c")).where(_count_fits(num, den, "n", "m", F.col("c") * 2))
           for k in ("before", "hub")]
    next_to = met[0].unionByName(met[1]).select("g", "h").distinct()
    first = next_to.join(heads.select("g", F.col("head").alias("a")), "g").join(heads.select(F.col("g").alias("h"), F.col("head").alias("b")), "h")
    first = stage(first.select("a", "b").unionByName(inside.select(F.col("cid").alias("a"), F.col("head").alias("b"))).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-first")

    def verified(pairs: DataFrame, tag: str) -> DataFrame:
        """The pairs (in the shared folder) that link; only texts of their classes are read again and sent."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct().join(classes.select("cid", "key"), "cid")
        ends = stage(ends, f"{tag}-ends")
        bit = F.shiftright(F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long"), 32 - WANTED_BITS)
        wanted = np.zeros(1 << WANTED_BITS, bool)
        for r in ends.select(bit.alias("bit")).distinct().toLocalIterator():
            wanted[r.bit] = True
        found = texts.select("text").mapInArrow(_texts_of(width, wanted), "key binary, text binary").join(ends, "key")
        bodies = stage(found.groupBy("cid").agg(F.first("text").alias("text")), f"{tag}-texts")
        of = [bodies.select(F.col("cid").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab"]
        links = stage(pairs.join(of[1], "b").join(of[0], "a").select("a", "b", "text_a", "text_b").mapInArrow(
            _verify(width, num, den), "a long, b long"), f"{tag}-links")
        free(ends, bodies)
        return links

    links = verified(first, "jaccard1")
    known = connected_components(links)
    labelled = stage(classes.join(known.withColumnsRenamed({"node": "cid", "component": "comp"}), "cid", "left").withColumn("comp", F.coalesce("comp", "cid")), "jaccard-labelled")
    free(known)

    # classes by shared shingle, where its run has more than one component
    split = "cid" if all_links else "comp"
    slot = shared.select("token", "g", "pos").join(labelled.select("g", "n", "cid", "comp"), "g")
    open_tokens = slot.groupBy("token").agg(F.min(split).alias("lo"), F.max(split).alias("hi")).where("lo < hi").select("token")
    slot = stage(slot.join(open_tokens, "token").select("token", "n", "pos", "cid", "comp"), "jaccard-slots")
    free(*slices)
    apart = (F.col(f"{split}_x") != F.col(f"{split}_y")) & (F.col("cid_x") < F.col("cid_y"))
    ends = lambda df, k: [F.col(c).alias(f"{c}_{k}") for c in ("n", "cid", "comp", "pos") if c in df.columns]
    across = stage(slot.select("token", *ends(slot, "x")).join(slot.select("token", *ends(slot, "y")), "token").where(
        apart & _size_fits(num, den, "n_x", "n_y") & _place_fits(num, den)).select("cid_x", "cid_y", "n_x", "n_y").distinct(), "jaccard-across")
    # a pair meets each side's shingles as one array of 16 bits each: what of x isn't in y is at most what differs, so the count is never too small
    packs = stage(slot.groupBy("cid").agg(F.collect_list((F.col("token").bitwiseAND(PACKED) - 0x8000).cast("short")).alias("pack")), "jaccard-packs")
    pack = lambda k: packs.select(F.col("cid").alias(f"cid_{k}"), F.col("pack").alias(f"pack_{k}"))
    counted = across.join(pack("x"), "cid_x").join(pack("y"), "cid_y").where(
        _count_fits(num, den, "n_x", "n_y", F.size("pack_x") - F.size(F.array_except("pack_x", "pack_y"))))
    # classes of one group share its whole prefix
    packed = labelled.join(crowded.select("g"), "g")
    together = packed.select("g", *ends(packed, "x")[1:3]).join(packed.select("g", *ends(packed, "y")[1:3]), "g").where(apart)
    rest = counted.select(F.col("cid_x").alias("a"), F.col("cid_y").alias("b")).unionByName(
        together.select(F.col("cid_x").alias("a"), F.col("cid_y").alias("b"))).distinct().join(first, ["a", "b"], "left_anti")
    rest = stage(rest, "jaccard-rest")
    free(slot, packs, across, first, labelled)
    links = links.unionByName(verified(rest, "jaccard2"))

    comp = connected_components(links)
    named = classes.join(comp.withColumnsRenamed({"node": "cid"}), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = stage(named.select("cid", "key", "n", "doc", "component"), "jaccard-named")
    free(rest, comp, classes)
    least = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    by_key = stage(named.join(least, "component").select("key", "component_id"), "jaccard-keys")
    members = rows.select("id", "key", F.col("n").alias("n_shingles")).join(by_key, "key", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")))
    return members, named, links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``."""
    members, _, _ = jaccard_join(docs, id_col=id_col, text_col=text_col, **how)
    return members.select(F.col("id").alias(id_col), "n_shingles", "component_id")


def q_op8(spark, sf_dir: str) -> DataFrame:
    """Contract query: the component of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same by definition: all shingles joined, links counted exactly, reachability by recursion.
SQL_OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n_shingles + nb.n_shingles - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.doc_id)
SELECT n.doc_id, n_shingles, min(r.c) AS component_id FROM n JOIN r USING (doc_id) GROUP BY 1, 2
"""
