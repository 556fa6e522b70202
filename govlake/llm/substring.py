"""Substring dedup by fixed-block anchors (operator 3).

A word is removed when it lies in a window of ``window`` consecutive words
whose word sequence also starts earlier (smaller id, or same id and earlier
start).  Steps:

1. Reference blocks: every document's non-overlapping blocks of ``(window + 1)
   // 2`` words, so each window holds a whole block.  Blocks are indexed by a
   rolling hash, and every rolling window of that length of every document
   probes the index.  Blocks and probes meet in the part of the hash space
   they fall into; they travel as packed arrays, one row for each batch of
   documents and part, about six bytes a probe.
2. A probe is a hit if a block elsewhere has its hash.  Hits go back to their
   documents, packed again by the bucket of (id, text hash) that the
   document's row goes to as well, and are extended to the windows around them.
3. Extended windows with the same words (64-bit hash) meet in one part again;
   all but the earliest are repeats.  Inside a batch only the earliest is
   sent, so a passage that a third of all documents hold is one entry a batch.
4. Overlapping repeats merge into maximal repeated spans, and their words go.

The texts themselves are shuffled twice, to meet their hits and their repeats.

Cases: a null text has no words; a text of fewer than ``window`` words keeps
all.  Rows with the same id count as one document for what starts earlier;
repeated rows are treated alike.  A null id counts as the smallest.  An empty
table gives an empty result.  Texts of any length are taken whole, in batches
of ``BATCH`` rows.  Only ``id_col`` (whole numbers) and ``text_col`` are read,
so other columns may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import as_bytes, rolling, word_hashes
from .stage import stage

BATCH = 500
#: A part of the hash space is cut into so many slices, taken one after another.
SLICES = 4
#: Entries that a task gathers before it sends them on.
HELD = 2_000_000
PACKED = "part int, slice int, kind int, keys binary, ids binary, marks binary, runs binary, places binary"
_NAMES = ["part", "slice", "kind", "keys", "ids", "marks", "runs", "places"]
_TYPES = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 5]


def _planes(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers byte plane by byte plane: the upper, mostly zero ones compress away."""
    return np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _runs(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    at = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1]) if len(doc) else np.zeros(0, int)
    return at, np.diff(np.append(at, len(doc)))


def _packed(ids: np.ndarray, marks: np.ndarray, doc: np.ndarray, place: np.ndarray, run: np.ndarray | None = None) -> tuple[bytes, bytes, bytes, bytes]:
    """Entries in order of document and place: the documents once each (ids and marks at ``doc``), entries by their gaps."""
    at, n = _runs(doc if run is None else run)
    gap = np.diff(place, prepend=0)
    gap[at] = place[at]
    return ids[doc[at]].tobytes(), marks[doc[at]].tobytes(), _planes(n), _planes(gap)


def _unpacked(ids: bytes, marks: bytes, runs: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, mark, place) of each entry."""
    n = _unplanes(runs).astype(np.int64)
    gap = _unplanes(places).astype(np.int64)
    at = np.cumsum(n) - n
    total = np.cumsum(gap)
    place = total - np.repeat(total[at] - gap[at], n)
    return np.repeat(np.frombuffer(ids, np.int64), n), np.repeat(np.frombuffer(marks, np.int64), n), place


def _slice_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(parts * SLICES)) >> np.uint64(32)


def _columns(b) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    return b.column("id").to_numpy(zero_copy_only=False), b.column("mark").to_numpy(zero_copy_only=False), as_bytes(b.column("text"))


def _frame(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(_NAMES), _TYPES)], _NAMES)


def _slices(h: np.ndarray, parts: int):
    """(part, slice, entries) of each slice of the hash space that has entries; entries stay in order."""
    where = _slice_of(h, parts).astype(np.int64)
    order = np.argsort(where, kind="stable")
    at, n = _runs(where[order])
    for a, k in zip(at.tolist(), n.tolist()):
        yield int(where[order[a]]) // SLICES, int(where[order[a]]), order[a:a + k]


# ------------------------------------------------------------------ step 1
def _blocks_and_probes(window: int, parts: int):
    block = (window + 1) // 2

    def run(batches):
        for b in batches:
            ids, marks, texts = _columns(b)
            h, _, _, bounds = word_hashes(texts)
            words = np.diff(bounds)
            doc = np.repeat(np.arange(len(texts)), words)
            place = np.arange(len(h)) - bounds[doc]
            r = rolling(h, block)
            valid = np.flatnonzero((place + block <= words[doc]) & (words[doc] >= window))
            h, doc, place = r[valid], doc[valid], place[valid]
            rows = []
            for part, piece, at in _slices(h, parts):
                keys = h[at].astype(np.uint32)
                aligned = place[at] % block == 0
                index, n = np.unique(keys[aligned], return_counts=True)
                if len(index):
                    rows.append((part, piece, 0, index.tobytes(), b"", b"", np.minimum(n, 2).astype(np.uint8).tobytes(), b""))
                rows.append((part, piece, 1, keys.tobytes(), *_packed(ids, marks, doc[at], place[at])))
            yield _frame(rows)

    return run


class _Outbox:
    """Gathers (id, mark, place) and packs them by the bucket of the document's row."""

    def __init__(self, parts: int):
        self.parts, self.held, self.n = parts, [], 0

    def put(self, ids: np.ndarray, marks: np.ndarray, place: np.ndarray) -> None:
        self.held.append((ids, marks, place))
        self.n += len(ids)

    def full(self) -> bool:
        return self.n >= HELD

    def rows(self) -> pa.RecordBatch:
        out: list[tuple] = []
        if self.n:
            ids, marks, place = (np.concatenate(x) for x in zip(*self.held))
            bucket = (ids ^ marks) % self.parts
            order = np.lexsort((place, marks, ids, bucket))
            ids, marks, place, bucket = ids[order], marks[order], place[order], bucket[order]
            doc = _change(ids, marks)
            at, n = _runs(bucket)
            out = [(int(bucket[a]), 0, 0, b"", *_packed(ids[a:a + k], marks[a:a + k], np.arange(k), place[a:a + k], doc[a:a + k]))
                   for a, k in zip(at.tolist(), n.tolist())]
        self.held, self.n = [], 0
        return _frame(out)


def _change(ids: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """A number for each run of equal (id, mark)."""
    if not len(ids):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.cumsum((np.diff(ids) != 0) | (np.diff(marks) != 0))])


def _hits(window: int, parts: int):
    """Of rows in order of (slice, kind): the probes with a block elsewhere, to their documents."""
    block = (window + 1) // 2

    def run(batches):
        piece, index, counts, ready = None, [], [], None
        out = _Outbox(parts)
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in _NAMES[1:])):
                if row[0] != piece:
                    piece, index, counts, ready = row[0], [], [], None
                if row[1] == 0:
                    index.append(np.frombuffer(row[2], np.uint32))
                    counts.append(np.frombuffer(row[5], np.uint8))
                    continue
                if ready is None:
                    keys, back = np.unique(np.concatenate([np.zeros(0, np.uint32), *index]), return_inverse=True)
                    ready = keys, np.bincount(back, np.concatenate([np.zeros(0, np.uint8), *counts]), len(keys))
                    index, counts = [], []
                if not len(ready[0]):
                    continue
                probe = np.frombuffer(row[2], np.uint32)
                at = np.minimum(np.searchsorted(ready[0], probe), len(ready[0]) - 1)
                found = np.flatnonzero(ready[0][at] == probe)
                if len(found):
                    ids, marks, place = _unpacked(*row[3:])
                    found = found[ready[1][at[found]] > (place[found] % block == 0)]  # an aligned probe meets its own block
                    out.put(ids[found], marks[found], place[found])
            if out.full():
                yield out.rows()
        yield out.rows()

    return run


# ------------------------------------------------------------------ steps 2 and 3
def _around(place: np.ndarray, words: int, window: int) -> np.ndarray:
    """Starts of the windows of a document that hold a hit."""
    block = (window + 1) // 2
    edge = np.zeros(words + 2, np.int64)
    np.add.at(edge, np.maximum(place - (window - block), 0), 1)
    np.add.at(edge, place + 1, -1)
    return np.flatnonzero(np.cumsum(edge[: max(words - window + 1, 0)]) > 0)


def _addressed(batches):
    """Of rows in order of kind - what was sent to documents, then the documents: each batch of documents with its places."""
    held: list[tuple] = []
    found = None
    for b in batches:
        kinds = b.column("kind").to_numpy(zero_copy_only=False)
        n = int((kinds == 0).sum())
        if n:
            held += [_unpacked(*x) for x in zip(*(b.column(c).slice(0, n).to_pylist() for c in _NAMES[4:]))]
        if n == b.num_rows:
            continue
        if found is None:
            found = {}
            if held:
                ids, marks, place = (np.concatenate(x) for x in zip(*held))
                order = np.lexsort((place, marks, ids))
                ids, marks, place = ids[order], marks[order], place[order]
                at, k = _runs(_change(ids, marks))
                found = {(i, m): place[a:a + c] for i, m, a, c in zip(ids[at].tolist(), marks[at].tolist(), at.tolist(), k.tolist())}
            held = []
        docs = b.slice(n)
        ids, marks = docs.column("id").to_pylist(), docs.column("mark").to_pylist()
        yield docs, [found.get(k) for k in zip(ids, marks)]


def _windows(window: int, parts: int):
    """The windows around hits, the earliest of a batch to its part (kind 1); the others are repeats (kind 2)."""

    def run(batches):
        for b, hits in _addressed(batches):
            with_hits = np.array([x is not None for x in hits], bool)
            if not with_hits.any():
                continue
            b = b.filter(pa.array(with_hits))
            ids, marks, texts = _columns(b)
            h, _, _, bounds = word_hashes(texts)
            r = rolling(h, window)
            starts = [_around(x, int(n), window) for x, n in zip([x for x in hits if x is not None], np.diff(bounds))]
            doc = np.repeat(np.arange(len(texts)), [len(x) for x in starts])
            place = np.concatenate([np.zeros(0, np.int64), *starts])
            key = r[place + bounds[doc]] if len(place) else np.zeros(0, np.uint64)
            order = np.lexsort((place, ids[doc], key))
            first = _firsts(key[order], ids[doc][order], place[order])
            later, sent = np.sort(order[~first]), np.sort(order[first])
            rows = []
            # repeats found here are dealt like the documents that they go to, so that no part gets them all
            bucket = (ids ^ marks)[doc[later]] % parts
            order = np.argsort(bucket, kind="stable")
            later, bucket = later[order], bucket[order]
            for a, k in zip(*(x.tolist() for x in _runs(bucket))):
                own = later[a:a + k]
                rows.append((int(bucket[a]), -1, 2, b"", *_packed(ids, marks, doc[own], place[own])))
            # of repeated rows with one id both are kept here: neither starts earlier
            for part, piece, at in _slices(key[sent], parts):
                at = sent[at]
                rows.append((part, piece, 1, key[at].tobytes(), *_packed(ids, marks, doc[at], place[at])))
            yield _frame(rows)

    return run


def _firsts(key: np.ndarray, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """In order of (key, id, place): whether an entry has the id and place of its key's first."""
    at, n = _runs(key)
    return (ids == np.repeat(ids[at], n)) & (place == np.repeat(place[at], n))


def _repeats(parts: int):
    """Of rows in order of slice: the windows that also start earlier, to their documents."""

    def run(batches):
        piece, held, out = None, [], _Outbox(parts)

        def judge() -> None:
            key, ids, marks, place = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((place, ids, key))
            later = order[~_firsts(key[order], ids[order], place[order])]
            out.put(ids[later], marks[later], place[later])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in _NAMES[1:])):
                if row[1] == 2:
                    out.put(*_unpacked(*row[3:]))
                    continue
                if row[0] != piece:
                    if held:
                        judge()
                    piece, held = row[0], []
                held.append((np.frombuffer(row[2], np.uint64), *_unpacked(*row[3:])))
            if out.full():
                yield out.rows()
        if held:
            judge()
        yield out.rows()

    return run


# ------------------------------------------------------------------ step 4
def _cut(window: int):
    def run(batches):
        for b, repeats in _addressed(batches):
            texts = as_bytes(b.column("text"))
            cols: tuple[list, list, list, list, list] = ([], [], [], [], [])
            for text, place in zip(texts, repeats):
                words = text.split()
                spans: list[list[int]] = []
                kept = words
                if place is not None:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, place, 1)
                    np.add.at(edge, place + window, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                    at, n = _runs(gone)
                    spans = [[a, a + k] for a, k in zip(at.tolist(), n.tolist()) if gone[a]]
                rest = b" ".join(kept)
                for c, v in zip(cols, (len(words), len(words) - len(kept), rest, hashlib.sha256(rest).hexdigest(), spans)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("given"), *[pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.list_(pa.list_(pa.int32()))))]],
                ["id", "n_words", "n_removed", "kept", "kept_sha256", "spans"])

    return run


def dedup_substrings(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept, kept_sha256, spans) of every row; ``kept`` is the text left (kept words, one
    space between), ``spans`` the maximal repeated spans as word places [begin, end)."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("given"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
                       F.xxhash64(text).alias("mark"), text.alias("text"))

    def met(df: DataFrame, how, tag: str) -> DataFrame:
        """Rows of a part of the hash space together; what comes of them is small."""
        return stage(df.repartitionById(parts, F.col("part")).sortWithinPartitions("slice", "kind").mapInArrow(how, PACKED), tag)

    def addressed(sent: DataFrame) -> DataFrame:
        """The documents behind what was sent to them: both sides go to the bucket of (id, mark)."""
        own = rows.withColumn("part", F.pmod(F.col("id").bitwiseXOR(F.col("mark")), F.lit(parts)).cast("int")).withColumn("kind", F.lit(1))
        both = sent.unionByName(own, allowMissingColumns=True)
        return both.repartitionById(parts, F.col("part")).sortWithinPartitions("kind").select("kind", "given", "id", "mark", "text", *_NAMES[4:])

    hits = met(rows.select("id", "mark", "text").mapInArrow(_blocks_and_probes(window, parts), PACKED), _hits(window, parts), "substring-hits")
    repeats = met(addressed(hits).mapInArrow(_windows(window, parts), PACKED), _repeats(parts), "substring-repeats")
    out = addressed(repeats).mapInArrow(_cut(window), "id long, n_words long, n_removed long, kept binary, kept_sha256 string, spans array<array<int>>")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"), "kept_sha256", "spans")


def q_op3(spark, sf_dir: str) -> DataFrame:
    """Contract query: words removed from every document, and the digest of the rest."""
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")


#: The same by definition: all 20-word windows by their words, the earliest of each kept.
SQL_OP3 = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM w WHERE len(w) >= 20),
h AS (SELECT doc_id, i, array_to_string(w[i:i+19], ' ') AS s FROM g),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM h),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM f WHERE r > 1),
x AS (SELECT doc_id, list(p) AS p FROM c GROUP BY doc_id),
k AS (SELECT w.doc_id, len(w) AS n, coalesce(len(p), 0) AS r,
        CASE WHEN p IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(p, i)), lambda i: w[i]) END AS kept
      FROM w LEFT JOIN x ON w.doc_id = x.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""
