"""Best-fit packing by a grouping genetic algorithm (operator 2).

Documents become token pieces of at most ``capacity``; only longer documents
are cut, and their first piece takes the remainder, so every other piece fills
a sequence by itself.  The rest is bin packing, in blocks of about
``block_pieces`` pieces dealt out evenly.  Pieces of one length are
interchangeable, so a block's problem is its histogram of lengths (at most
``capacity`` rows), and a solution is a list of bins by content with a count.

Islands: each (block, island) is one group of a grouped map.  It evolves a
small population by grouping crossover - a child takes whole well-filled bins
of one parent, then those bins of the other that need no piece already used
(duplicates go), and best-fits the displaced pieces into what is open.  After
each epoch every island's elite also goes to the next island of the ring; in
the end the best island of each block deals its slots out to the pieces.

Cases: a null or empty text is one piece holding the end id alone.  Repeated
rows are packed as rows of their own (every row gets an internal number when
the pieces are written).  An empty table gives an empty result.  Null ids are
kept.  Very long texts are cut, never truncated.  Only ``id_col`` and
``text_col`` are read, so other columns may have any name.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import stage
from .tokens import BytePairIds, opened

BATCH = 500
PIECES = "id long, piece int, start long, length long, ids_crc32 long"


# ------------------------------------------------------------------ pieces
def _cut(name: str, capacity: int, end_id: int):
    end = end_id.to_bytes(4, "little")

    def run(batches):
        lib = opened(BytePairIds, name)
        for b in batches:
            cols = ([], [], [], [], [])
            for doc, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                ids = lib.ids(text or "") + end
                n = len(ids) // 4
                at, step = 0, (n - 1) % capacity + 1
                for piece in range(-(-n // capacity)):
                    for c, v in zip(cols, (doc, piece, at, step, zlib.crc32(ids[4 * at:4 * (at + step)]))):
                        c.append(v)
                    at, step = at + step, capacity
            types = (b.schema.field("id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["id", "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """One row a piece: id, piece, start, length, ids_crc32."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    kind = docs.select(id_col).dtypes[0][1]
    kind = "long" if kind == "void" else kind
    return docs.select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _cut(tokenizer, capacity, end_id), PIECES.replace("id long", f"id {kind}", 1))


# ------------------------------------------------------------------ the genetic algorithm on histograms
# A bin's content is a tuple of lengths, longest first; a solution {content: count}.
def _best_fit(left: dict[int, int], opened_bins: dict[tuple, int], capacity: int, order: list[int]) -> dict[tuple, int]:
    """Add the pieces of ``left`` in the given order, each to the open bin it fits most tightly."""
    done: dict[tuple, int] = {}
    by_gap: dict[int, dict[tuple, int]] = {}

    def put(content: tuple, count: int) -> None:
        gap = capacity - sum(content)
        if gap == 0:
            done[content] = done.get(content, 0) + count
            return
        if gap not in by_gap:
            by_gap[gap] = {}
            insort(gaps, gap)
        by_gap[gap][content] = by_gap[gap].get(content, 0) + count

    gaps: list[int] = []
    for content, count in opened_bins.items():
        put(content, count)
    for size in order:
        todo = left.get(size, 0)
        while todo:
            at = bisect_left(gaps, size)
            if at == len(gaps):  # nothing fits: open bins for the rest, as full of this size as they go
                each = capacity // size
                if whole := todo // each:
                    put((size,) * each, whole)
                if rest := todo % each:
                    put((size,) * rest, 1)
                break
            gap = gaps[at]
            content, count = by_gap[gap].popitem()
            each = min(gap // size, todo)  # the tightest bin stays the tightest while it takes more
            used = min(count, todo // each)
            if used < count:
                by_gap[gap][content] = count - used
            if not by_gap[gap]:
                del by_gap[gap]
                gaps.pop(at)
            put(tuple(sorted(content + (size,) * each, reverse=True)), used)
            todo -= used * each
    for bins in by_gap.values():
        for content, count in bins.items():
            done[content] = done.get(content, 0) + count
    return done


def _fitness(bins: dict[tuple, int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (Falkenauer's squared fill)."""
    return sum(bins.values()), -sum(n * (sum(c) / capacity) ** 2 for c, n in bins.items())


def _cross(a: dict[tuple, int], b: dict[tuple, int], sizes: dict[int, int], capacity: int, rng: random.Random) -> dict[tuple, int]:
    """Inject well-filled bins of ``a``, keep the bins of ``b`` that need no used piece, best-fit the displaced pieces."""
    left, child = dict(sizes), {}

    def take(content: tuple, count: int) -> None:
        need: dict[int, int] = {}
        for s in content:
            need[s] = need.get(s, 0) + 1
        count = min([count, *(left[s] // k for s, k in need.items())])
        if count:
            for s, k in need.items():
                left[s] -= k * count
            child[content] = child.get(content, 0) + count

    share = rng.uniform(0.3, 0.8)
    for content, count in sorted(a.items(), key=lambda x: (-sum(x[0]), x[0])):
        if sum(content) >= 0.98 * capacity and rng.random() < share:
            take(content, count)
    for content, count in sorted(b.items(), key=lambda x: (-sum(x[0]), x[0])):
        take(content, count)
    # the emptier half of what isn't full is opened again, so that displaced pieces meet
    loose = [c for c in child if sum(c) < 0.9 * capacity]
    rng.shuffle(loose)
    for content in loose[: (len(loose) + 1) // 2]:
        for s in content:
            left[s] += child[content]
        del child[content]
    return _best_fit(left, child, capacity, sorted((s for s, n in left.items() if n), reverse=True))


def _evolve(sizes: dict[int, int], elites: list[dict[tuple, int]], capacity: int, population: int, generations: int,
            rng: random.Random) -> dict[tuple, int]:
    least = -(-sum(s * n for s, n in sizes.items()) // capacity)
    order = sorted(sizes, reverse=True)
    key = lambda x: _fitness(x, capacity)
    alive = list(elites) or [_best_fit(sizes, {}, capacity, order)]
    best = min(alive, key=key)
    if sum(best.values()) <= least:
        return best
    while len(alive) < population:  # best fit over orders near the decreasing one
        shaken = sorted(order, key=lambda s: -s * rng.uniform(0.8, 1.0))
        alive.append(_best_fit(sizes, {}, capacity, shaken))
    for _ in range(generations):
        alive.sort(key=key)
        if sum(alive[0].values()) <= least:
            break
        a, b = rng.sample(alive[: max(2, population // 2)], 2)
        alive[-1] = _cross(a, b, sizes, capacity, rng)
        alive[-2] = _cross(b, a, sizes, capacity, rng)
    return min(alive, key=key)


def _solutions(rows: pd.DataFrame) -> list[dict[tuple, int]]:
    """The elites among a group's rows; kind 0 holds the histogram, other kinds one solution each."""
    out: dict[int, dict[tuple, int]] = {}
    for kind, content, count in zip(rows["kind"], rows["content"], rows["n"]):
        if kind:
            out.setdefault(kind, {})[tuple(int(s) for s in content)] = int(count)
    return [out[k] for k in sorted(out)]


def _histogram(rows: pd.DataFrame) -> dict[int, int]:
    own = rows[rows["kind"] == 0]
    return {int(c[0]): int(n) for c, n in zip(own["content"], own["n"])}


def _island(capacity: int, population: int, generations: int, epoch: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, island = int(key[0]), int(key[1])
        best = _evolve(_histogram(rows), _solutions(rows), capacity, population, generations, random.Random(f"{block}:{island}:{epoch}"))
        return pd.DataFrame({"block": block, "island": island, "content": [list(c) for c in best], "n": list(best.values())})

    return run


def _slots(capacity: int):
    """The best island's bins, dealt out: a row for each slot, by the rank of its piece among those of its length."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found: dict[int, dict[tuple, int]] = {}
        for island, content, n in zip(rows["island"], rows["content"], rows["n"]):
            found.setdefault(int(island), {})[tuple(int(s) for s in content)] = int(n)
        best = found[min(found, key=lambda i: (_fitness(found[i], capacity), i))]
        used: dict[int, int] = {}
        cols: tuple[list, list, list, list] = ([], [], [], [])
        bin_no = 0
        for content in sorted(best):
            for _ in range(best[content]):
                at = 0
                for s in content:
                    used[s] = used.get(s, 0) + 1
                    for c, v in zip(cols, (s, used[s], bin_no, at)):
                        c.append(v)
                    at += s
                bin_no += 1
        return pd.DataFrame({"block": int(key[0]), "length": cols[0], "rank": cols[1], "bin": cols[2], "offset": cols[3]})

    return run


def pack(pieces: DataFrame, capacity: int = 1024, block_pieces: int = 40_000, islands: int = 3, epochs: int = 2,
         population: int = 6, generations: int = 12) -> DataFrame:
    """``pieces`` (with ``length`` of 1 to ``capacity``) plus sequence_id and offset.

    A block's group holds at most ``capacity`` histogram rows and an elite's
    distinct bins; its slots are about ``block_pieces`` rows.  Nothing grows
    with the number of documents but the number of blocks.
    """
    numbered = stage(pieces.withColumn("_no", F.monotonically_increasing_id()), "pieces")
    full = numbered.where(F.col("length") == capacity)
    short = numbered.where(F.col("length") < capacity)
    n_blocks = max(1, -(-short.count() // block_pieces))
    short = stage(short.withColumn("block", F.pmod(F.xxhash64("_no"), F.lit(n_blocks)).cast("int")), "pack-blocks")
    histogram = short.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n")).select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.lit(0).alias("kind"),
        F.array(F.col("length").cast("int")).alias("content"), "n")
    histogram = stage(histogram, "pack-histogram")
    elite = None
    for epoch in range(epochs):
        problem = histogram
        if elite is not None:  # ring: an island keeps its elite and gets its neighbour's
            problem = problem.unionByName(elite.select(
                "block", F.explode(F.array(F.struct(F.col("island").alias("island"), F.lit(1).alias("kind")),
                                           F.struct(F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.lit(2).alias("kind")))).alias("to"),
                "content", "n").select("block", "to.island", "to.kind", "content", "n"))
        elite = stage(problem.groupBy("block", "island").applyInPandas(
            _island(capacity, population, generations, epoch), "block int, island int, content array<int>, n long"), f"pack-elite{epoch}")
    slots = elite.groupBy("block").applyInPandas(_slots(capacity), "block int, length long, rank int, bin long, offset long")
    from pyspark.sql import Window

    ranked = short.withColumn("rank", F.row_number().over(Window.partitionBy("block", "length").orderBy("_no")))
    placed = ranked.join(slots.hint("merge"), ["block", "length", "rank"]).withColumn(
        "sequence_id", (F.col("bin") * n_blocks + F.col("block")) * 2 + 1)
    own = full.withColumn("sequence_id", F.col("_no") * 2).withColumn("offset", F.lit(0).cast("long"))
    keep = [*pieces.columns, "sequence_id", "offset"]
    return placed.select(*keep).unionByName(own.select(*keep))


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = 1024, end_id: int = 2,
                   id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Pieces of ``docs`` with their sequence_id and offset; ``how`` goes to :func:`pack`."""
    return pack(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), capacity, **how).withColumnRenamed("id", id_col)


def q_op2(spark, sf_dir: str) -> DataFrame:
    """Contract query: the packed pieces of every document."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
