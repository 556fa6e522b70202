"""Exact ranked lexical search with ball trees over sparse vectors (operator 11).

A document's vector has, for each term of the queries, its share
(10^9 * tf) div (1000 * tf + 8 * m); a query's has its terms' weights, so a
score is an inner product of integers.  Each task builds ball trees over its
documents, a bounded number of them a tree: a node splits its documents at the
median of their projections on the line between two far ones, and keeps the
centroid and the radius around it, as a whole and for groups of terms.  A
document x of a node with centroid c and radii r_g has

    q . x <= q . c + min(|q| r, sum over groups g of |q_g| r_g),

computed in doubles and rounded up.  A query opens nodes best bound first and
ends where the bound is below its k-th best score so far; the heap goes on from
tree to tree of a task.  Leaves are scored exactly, in 64-bit integers.

Queries are taken in blocks of bounded numbers of rows and terms, which the
tasks get by closure.  All documents are read for each block.  From the corpus
come to the driver only N, L and a block's document frequencies.

Cases: a null or empty text has no terms: as a document it isn't counted and
has no score, as an item it has no results.  Repeated rows of either table are
rows of their own.  Equal scores rank by ascending id, null ids last.  Empty
tables give empty results.  Only id and text columns are read; other columns
may have any name.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .stage import stage

#: Rows and distinct terms of a block of queries (a single query may have more terms).
BLOCK_ITEMS, BLOCK_TERMS = 1024, 32768
#: Documents and vector entries of a tree, documents of a leaf, and groups of terms with a radius of their own.
TREE_DOCS, TREE_ENTRIES, LEAF, GROUPS = 8192, 4_000_000, 32, 512
#: Tasks' results of an item meet in this many parts first.
MEET = 64
#: Bytes that aren't ASCII letters, digits or parts of other code points separate terms; A-Z are a-z.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_UP = 1 + 1e-9


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order, as UTF-8."""
    return text.encode().translate(_LETTERS).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Rows:
    """Sparse rows: row i has the entries ``start[i]`` to ``start[i + 1]`` of ``term`` and ``value``; none is empty."""

    def __init__(self, start: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.start, self.term, self.value = start, term, value

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(dense[self.term] * self.value, self.start[:-1])

    def take(self, rows: np.ndarray) -> Rows:
        size = (self.start[1:] - self.start[:-1])[rows]
        start = np.append(0, np.cumsum(size))
        at = np.repeat(self.start[rows] - start[:-1], size) + np.arange(start[-1])
        return Rows(start, self.term[at], self.value[at])

    def __len__(self) -> int:
        return len(self.start) - 1


class BallTree:
    """Nodes in ``first``/``last`` (runs of ``order``) and ``children``; leaves have no children."""

    def __init__(self, rows: Rows, width: int, groups: int = GROUPS, leaf: int = LEAF):
        self.width, self.groups = width, min(groups, width)
        self.group = np.arange(width) * self.groups // max(width, 1)
        self.order = np.arange(len(rows))
        self.first, self.last, self.children, self.leaves = [], [], [], {}
        centers, radii, spreads = [], [], []
        waiting = [(0, len(rows), rows, -1)]
        while waiting:
            a, b, part, parent = waiting.pop()
            node = len(self.first)
            if parent >= 0:
                self.children[parent].append(node)
            self.first.append(a)
            self.last.append(b)
            self.children.append([])
            center = np.bincount(part.term, part.value, width) / len(part)
            norm = np.add.reduceat(part.value.astype(float) ** 2, part.start[:-1])
            far = self._squares(part, norm, center)
            centers.append(center)
            radii.append(math.sqrt(far.max()) * _UP)
            spreads.append(self._spread(part, center))
            if len(part) <= leaf or not far.max() > 1:  # a leaf, or copies of one vector
                self.leaves[node] = part
                continue
            one = self._dense(part, int(far.argmax()))
            two = self._dense(part, int(self._squares(part, norm, one).argmax()))
            along = part.dot(two - one)
            half = len(part) // 2
            split = np.argpartition(along, half)
            here = self.order[a:b][split]
            self.order[a:b] = here
            waiting += [(a + half, b, part.take(split[half:]), node), (a, a + half, part.take(split[:half]), node)]
        self.center = np.array(centers).reshape(-1, width)
        self.radius = np.array(radii)
        self.spread = np.array(spreads).reshape(-1, self.groups)

    def _dense(self, rows: Rows, i: int) -> np.ndarray:
        out = np.zeros(self.width)
        out[rows.term[rows.start[i]:rows.start[i + 1]]] = rows.value[rows.start[i]:rows.start[i + 1]]
        return out

    @staticmethod
    def _squares(rows: Rows, norm: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Squared distances of the rows to a point, not below the true ones."""
        own = float(point @ point)
        return np.maximum(norm - 2 * rows.dot(point) + own, 0) + 1e-9 * (norm + own)

    def _spread(self, rows: Rows, center: np.ndarray) -> np.ndarray:
        """The radius in each group of terms, not below the true one."""
        own = np.bincount(self.group, center ** 2, self.groups)
        value = rows.value.astype(float)
        row = np.repeat(np.arange(len(rows)), np.diff(rows.start))
        cell = row * self.groups + self.group[rows.term]
        size = len(rows) * self.groups
        norm = np.bincount(cell, value ** 2, size)
        cross = np.bincount(cell, value * center[rows.term], size)
        square = (np.maximum(norm - 2 * cross + np.tile(own, len(rows)), 0) + 1e-9 * (norm + np.tile(own, len(rows)))).reshape(len(rows), self.groups)
        return np.sqrt(square.max(0)) * _UP

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node a number no score of the node's rows is above."""
        squares = np.zeros((len(queries), self.groups))
        np.add.at(squares.T, self.group, queries.T ** 2)
        whole = np.sqrt(squares.sum(1))[:, None] * self.radius[None, :]
        parts = np.sqrt(squares) @ self.spread.T
        return (queries @ self.center.T + np.minimum(whole, parts)) * _UP + 1

    def search(self, query: np.ndarray, bound: np.ndarray, offer, least) -> int:
        """Offers the rows of leaves, best bound first, until the bound is below ``least()``; the number of rows scored."""
        heap, scored = [(-bound[0], 0)], 0
        while heap:
            above, node = heapq.heappop(heap)
            if -above < least():
                break
            rows = self.leaves.get(node)
            if rows is None:
                for c in self.children[node]:
                    heapq.heappush(heap, (-bound[c], c))
            else:
                scored += len(rows)
                offer(self.order[self.first[node]:self.last[node]], rows.dot(query))
        return scored


class _Best:
    """The k best (score, id) of a query; ties go to the smaller id, null ids come last."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def least(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def offer(self, ids: list, rows: np.ndarray, scores: np.ndarray) -> None:
        for i in np.flatnonzero(scores >= self.least()).tolist():
            entry = (int(scores[i]), _Late(ids[rows[i]]))
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


class _Late:
    """An id that is the greater, the earlier it stands."""

    __slots__ = ("id",)

    def __init__(self, value):
        self.id = value

    def __lt__(self, other):
        if self.id is None or other.id is None:
            return self.id is None and other.id is not None
        return self.id > other.id

    def __eq__(self, other):
        return self.id == other.id


def _vectors(vocabulary: dict[bytes, int]):
    def run(batches):
        for b in batches:
            size, places, found, times = [], [0], [], []
            for text in b.column("text").to_pylist():
                words = terms(text)
                counts = Counter(words)
                here = [(vocabulary[w], n) for w, n in counts.items() if w in vocabulary]
                size.append(len(words))
                found += [t for t, _ in here]
                times += [n for _, n in here]
                places.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(x, kind)) for x, kind in ((found, pa.int32()), (times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(size, pa.int64()), *lists], ["id", "n", "terms", "tf"])

    return run


def _shares(n: np.ndarray, tf: np.ndarray, size: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """Each entry's (10^9 * tf) div (1000 * tf + 8 * m)."""
    if 90 * n_docs * int(n.max(initial=0)) < 1 << 62:
        m = 10 + 90 * n * n_docs // length
    else:
        m = np.array([10 + 90 * x * n_docs // length for x in n.tolist()], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, size))


def _search(items: list[tuple[object, list[tuple[int, int]]]], width: int, n_docs: int, length: int, k: int, item_type, id_type):
    """Arrow map: documents' vectors -> the task's k best of each item."""

    def run(batches):
        exact = np.zeros((len(items), width), np.int64)
        for i, (_, own) in enumerate(items):
            for t, w in own:
                exact[i, t] = w
        queries = exact.astype(float)
        best = [_Best(k) for _ in items]

        def look(parts: list) -> None:
            ids = [x for p in parts for x in p.column("id").to_pylist()]
            lists = [pa.chunked_array([p.column(c) for p in parts]).combine_chunks() for c in ("terms", "tf")]
            term, tf = (x.flatten().to_numpy() for x in lists)
            size = np.concatenate([np.diff(p.column("terms").offsets.to_numpy()) for p in parts]).astype(np.int64)
            n = np.concatenate([p.column("n").to_numpy() for p in parts])
            rows = Rows(np.append(0, np.cumsum(size)), term, _shares(n, tf, size, n_docs, length))
            tree = BallTree(rows, width)
            for query, own, bound in zip(exact, best, tree.bounds(queries)):
                tree.search(query, bound, lambda at, scores, own=own: own.offer(ids, at, scores), own.least)

        held, docs, entries = [], 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                b = batch.slice(at, min(TREE_DOCS - docs, 512))
                held.append(b)
                at, docs = at + b.num_rows, docs + b.num_rows
                entries += len(b.column("terms").flatten())
                if docs >= TREE_DOCS or entries >= TREE_ENTRIES:
                    look(held)
                    held, docs, entries = [], 0, 0
        if held:
            look(held)
        out = [(i, item, x.id, s) for i, ((item, _), b) in enumerate(zip(items, best)) for s, x in b.heap]
        if out:
            number, item, doc, score = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(item, item_type), pa.array(doc, id_type), pa.array(score, pa.int64())],
                                             ["number", "item", "doc", "score"])

    return run


def _blocks(items: Iterator, rows: int, most: int) -> Iterator[tuple[list, dict[bytes, int]]]:
    block, vocabulary = [], {}
    for item, text in items:
        own = set(terms(text))
        if block and (len(block) >= rows or len(vocabulary.keys() | own) > most):
            yield block, vocabulary
            block, vocabulary = [], {}
        for t in sorted(own):
            vocabulary.setdefault(t, len(vocabulary))
        block.append((item, own))
    if block:
        yield block, vocabulary


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """(item, rank, doc, score) of the ``k`` documents with the highest scores above 0, for each row of ``items``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text"))
    id_type, item_type = rows.schema["id"].dataType, asked.schema["item"].dataType
    shape = f"number int, item {item_type.simpleString()}, doc {id_type.simpleString()}, score long"
    out = rows.sparkSession.createDataFrame([], f"item {item_type.simpleString()}, rank int, doc {id_type.simpleString()}, score long")
    for block, vocabulary in _blocks(((r.item, r.text) for r in asked.toLocalIterator()), BLOCK_ITEMS, BLOCK_TERMS):
        vectors = stage(rows.mapInArrow(_vectors(vocabulary), f"id {id_type.simpleString()}, n long, terms array<int>, tf array<long>"), "term-vectors")
        n_docs, length = vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row for each term of the block
        asked_for = [(item, [(vocabulary[t], weight(n_docs, df.get(vocabulary[t], 0))) for t in own]) for item, own in block]
        found = vectors.where(F.size("terms") > 0).select("id", "n", "terms", "tf").mapInArrow(
            _search(asked_for, len(vocabulary), n_docs, length, k, to_arrow_type(item_type), to_arrow_type(id_type)), shape)
        order = [F.desc("score"), F.asc_nulls_last("doc")]
        for by in (["number", "part"], ["number"]):
            rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
            found = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MEET))) if "part" in by else found
            found = found.withColumn("rank", rank).where(F.col("rank") <= k)
        out = out.unionByName(found.select("item", F.col("rank").cast("int").alias("rank"), "doc", "score"))
    return out


def q_op11(spark, sf_dir: str) -> DataFrame:
    """Contract query: the ten best documents of each benchmark item."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, items).select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


SQL_OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS length FROM d WHERE len(ts) > 0),
v AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
q AS (SELECT DISTINCT r, item_id, t FROM (SELECT row_number() OVER () AS r, item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT t, count(*) AS df FROM v WHERE t IN (SELECT t FROM q) GROUP BY t), s),
x AS (SELECT q.r, q.item_id, d.doc_id, d.r AS dr,
        sum(w.w * ((1000000000 * v.tf) // (1000 * v.tf + 8 * (100 - 90 + ((90 * len(d.ts) * s.n_docs) // s.length)))))::BIGINT AS score
      FROM q JOIN w USING (t) JOIN v USING (t) JOIN d ON d.r = v.r, s GROUP BY q.r, q.item_id, d.doc_id, d.r),
k AS (SELECT item_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM x WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
"""
