"""Alignment of the tokens of two tokenizers over the same bytes (operator 12).

Side A is a byte-level BPE file on a space and the text, side B a sentencepiece
file on the text (it adds that space itself); special strings are plain text.
All tokens of both sides are sorted by their first byte, the running maximum of
their ends is taken, and a group breaks where a token starts at or beyond that
maximum: there a token of A and one of B end at the same byte.  Inside its
group each token of A is expanded into the tokens of B that it overlaps.

Neither side merges across a single space between two other characters, so a
text is a row of units that begin with a space, and units repeat far more than
texts do.  The distinct units of a run of rows are encoded and aligned together,
in one pass of numpy, and the rows are put together from them.  Texts for which
that law isn't certain are one unit.

``with_link_counts`` needs the corpus: links are summed a block (a run of rows
of a task, bounded by rows and bytes) and id pair, blocks are summed over the
corpus, and the totals go back to the blocks' rows: what is shuffled is the
distinct pairs of blocks, not links.  No table of pairs is broadcast.

Cases: a null or empty text, and one whose tokens of either side don't give
back the space and the text, has no tokens: zeros and an empty ``groups``.
Repeated rows give repeated rows and each counts, an empty table gives an empty
one, null ids are kept.  Only ``id_col`` and ``text_col`` are read; other
columns may have any name.
"""

from __future__ import annotations

import re
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import _byte_letters
from .stage import stage, tokenizer_path
from .tokens import opened

#: A block's rows and bytes of text (a longer text is a block of its own).
BLOCK_ROWS, BLOCK_BYTES = 2000, 8 << 20
#: Rows and characters aligned at once.
ROWS, CHARS = 1000, 4 << 20
#: White space next to a space, or a space at an end: the text isn't cut into units.
_WHOLE = re.compile(r"\s | \s|^\s|\s\Z")


def coalesce_intervals(end_a: np.ndarray, end_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray):
    """Groups of the tokens of two sides that cover the same bytes.

    ``end`` and ``size``: a side's tokens in order, in bytes.  Returns the
    number of groups, each token's group on both sides, and the overlapping
    pairs (token of A, token of B, whether they end at the same byte).
    """
    start = np.concatenate([end_a - size_a, end_b - size_b])
    end = np.concatenate([end_a, end_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(end_a), len(end_b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    new = np.ones(len(order), bool)
    new[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    # both sides are sorted and without gaps: what a token of A overlaps is a run of B
    first = np.searchsorted(end_b, end_a - size_a, side="right")
    last = np.searchsorted(end_b - size_b, end_a, side="left")
    n = last - first
    a = np.repeat(np.arange(len(end_a)), n)
    b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return int(new.sum()), group[: len(end_a)], group[len(end_a):], a, b, end_a[a] == end_b[b]


class _Aligned:
    """Units in columns: ``numbers`` (tokens of A and B, groups, links), the groups as text, each ending in ``;``, and
    the linked id pairs (A's id in the upper half); ``place[i]`` is unit i's row there, the last row for one without tokens."""

    def __init__(self, place: np.ndarray, numbers: np.ndarray, groups: pa.Array, pairs: np.ndarray):
        self.place, self.numbers, self.groups, self.pairs = place, numbers, groups, pairs


def _joined(texts: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Runs of a text column, each as one text: the bytes lie there one after another."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1][bounds]
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(ends.tobytes()), texts.buffers()[2])


class Aligner:
    """The two tokenizers and the memo of units; ``overlaps`` links all tokens that overlap, not only those that end together."""

    def __init__(self, name: tuple[str, str, bool]):
        import sentencepiece
        from tokenizers import Tokenizer

        side_a, side_b, self.overlaps = name
        self.a = Tokenizer.from_file(tokenizer_path(side_a))
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        labels_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            labels_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(side_b))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        labels_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.labels = (labels_a, labels_b)
        self.size = tuple(np.array([len(x) for x in side], np.int64) for side in self.labels)
        #: each id as text with what may stand behind it: another of its side's, or the end of its side's part of a group
        self.said = pa.array([f"{i}{c}" for side, marks in zip(self.labels, (",|", ",;")) for c in marks for i in range(len(side))], pa.large_string())
        self.by_unit = not any("▁" in p.lstrip("▁") for p in pieces) and self.b.normalize("a  b ") == "▁a▁▁b▁"

    def cuts(self, text: str) -> bool:
        """Whether a text may be cut at its spaces."""
        return self.by_unit and "▁" not in text and not _WHOLE.search(text)

    def _whole(self, units: list[str], ids: list[list[list[int]]]) -> list[bool]:
        """Whether the tokens of both sides give back each unit behind its space."""
        texts = [b" " + u.encode() for u in units]
        sizes = np.fromiter(map(len, texts), np.int64)
        every = b"".join(texts)
        for labels, size, side in zip(self.labels, self.size, ids):
            flat = list(chain.from_iterable(side))
            ends = np.append(0, np.cumsum(size[flat]))[np.cumsum(list(map(len, side)))] if flat else np.zeros(len(side), np.int64)
            if not np.array_equal(ends, np.cumsum(sizes)) or b"".join([labels[i] for i in flat]) != every:
                return [all(b"".join([table[i] for i in x[k]]) == t for table, x in zip(self.labels, ids)) for k, t in enumerate(texts)]
        return [True] * len(units)

    def align(self, units: list[str]) -> _Aligned:
        ids = [[e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)], self.b.encode(units, num_threads=1)] if units else [[], []]
        whole = np.array(self._whole(units, ids), bool)
        kept = ids if whole.all() else [[x for x, ok in zip(side, whole) if ok] for side in ids]
        flat = [np.fromiter(chain.from_iterable(side), np.int64) for side in kept]
        size = [s[f] for s, f in zip(self.size, flat)]
        n, *group, a, b, together = coalesce_intervals(np.cumsum(size[0]), np.cumsum(size[1]), *size)
        if not self.overlaps:
            a, b = a[together], b[together]
        # the groups as text: in each group A's ids and then B's, each with its mark behind it
        last = [np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in group]
        width = [len(labels) for labels in self.labels]
        said = np.concatenate([flat[0] + last[0] * width[0], flat[1] + last[1] * width[1] + 2 * width[0]])
        said = self.said.take(pa.array(said[np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")]))
        # a unit's part of the tokens, of the groups and of the links; the row without tokens is the last
        tokens = [np.cumsum([0, *map(len, side)]) for side in kept]
        counted = [*tokens, np.append(group[0], n)[tokens[0]], np.searchsorted(a, tokens[0])]
        numbers = np.array([np.append(np.diff(c), 0) for c in counted], np.int64)
        both = tokens[0] + tokens[1]
        place = np.where(whole, np.cumsum(whole) - 1, len(kept[0]))
        return _Aligned(place, numbers, _joined(said, np.append(both, both[-1])), flat[0][a] << 32 | flat[1][b])

    def columns(self, column: pa.Array, texts: list[str | None]) -> list[pa.Array]:
        """n_a, n_b, n_groups, n_links, groups, pairs and times of each text."""
        cut = [k for k, t in enumerate(texts) if t and self.cuts(t)]
        lists = pc.split_pattern(column.take(pa.array(cut, pa.int64())), pattern=" ")
        coded = lists.flatten().dictionary_encode()
        place, bounds = coded.indices.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64)
        units = self.align(coded.dictionary.to_pylist())
        place = units.place[place]
        # a text with a unit that isn't given back is decided as a whole, like those that may not be cut
        lost = np.diff(np.append(0, np.cumsum(place == len(units.groups) - 1))[bounds]) > 0
        run = {k: i for i, k in enumerate(cut) if not lost[i]}
        whole = [k for k, t in enumerate(texts) if t and k not in run]
        more = self.align([texts[k] for k in whole])
        # runs of units: those of texts that are cut, then whole texts, then one for texts without tokens
        run |= {k: len(cut) + i for i, k in enumerate(whole)}
        place = np.concatenate([place, len(units.groups) + np.append(more.place, len(more.groups) - 1)])
        bounds = np.append(bounds, bounds[-1] + np.arange(1, len(whole) + 2))
        runs = pa.array([run.get(k, len(bounds) - 2) for k in range(len(texts))], pa.int64())
        numbers = np.concatenate([units.numbers, more.numbers], axis=1)
        linked = numbers[3]
        sums = np.array([np.append(0, np.cumsum(c[place]))[bounds] for c in numbers])
        groups = pc.ascii_rtrim(_joined(pa.concat_arrays([units.groups, more.groups]).take(pa.array(place)), bounds), characters=";")
        # a run's distinct pairs
        pairs, code = np.unique(np.concatenate([units.pairs, more.pairs]), return_inverse=True)
        n, width = linked[place], max(len(pairs), 1)
        at = np.repeat(np.append(0, np.cumsum(linked))[place] - np.append(0, np.cumsum(n))[:-1], n) + np.arange(n.sum())
        key, times = np.unique(np.repeat(np.arange(len(bounds) - 1), np.diff(sums[3])) * width + code[at], return_counts=True)
        places = pa.array(np.searchsorted(key, np.arange(len(bounds)) * width), pa.int32())
        lists = [pa.ListArray.from_arrays(places, pa.array(x, kind)) for x, kind in ((pairs[key % width], pa.int64()), (times, pa.int32()))]
        return [x.take(runs) for x in (*(pa.array(np.diff(c)) for c in sums), groups.cast(pa.string()), *lists)]


_COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>, block string"


def _parts(batch: pa.RecordBatch):
    """The batch in runs of bounded rows and characters (a longer text alone), each with its texts."""
    texts = batch.column("text").to_pylist()
    first, chars = 0, 0
    for k, t in enumerate(texts):
        if k - first == ROWS or chars and chars + len(t or "") > CHARS:
            yield batch.slice(first, k - first), texts[first:k]
            first, chars = k, 0
        chars += len(t or "")
    if texts:
        yield batch.slice(first), texts[first:]


def _run(name: tuple):
    def run(batches):
        aligner = opened(Aligner, name)
        block, rows, size = uuid.uuid4().hex, 0, 0
        for batch in batches:
            for b, texts in _parts(batch):
                blocks = []
                for t in texts:
                    rows, size = rows + 1, size + len(t or "")
                    if rows > BLOCK_ROWS or size > BLOCK_BYTES and rows > 1:
                        block, rows, size = uuid.uuid4().hex, 1, len(t or "")
                    blocks.append(block)
                yield pa.RecordBatch.from_arrays([b.column("id"), *aligner.columns(b.column("text"), texts), pa.array(blocks)], [
                    "id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times", "block"])

    return run


def align_tokens(docs: DataFrame, side_a: str = "byte_bpe_50k.json", side_b: str = "piece_bpe_32k.model", id_col: str = "doc_id",
                 text_col: str = "text", overlaps: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, pairs, times, block) of every row.

    ``groups``: ids as ``a1,a2|b1;a3|b2,b3``.  ``pairs`` and ``times``: the
    distinct linked id pairs (A's id * 2^32 + B's id) and how many links hold
    them; links end at the same byte, or with ``overlaps`` share a byte.
    ``block`` is a name for a run of rows that a task had together.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_run((side_a, side_b, overlaps)), f"id {rows.schema['id'].dataType.simpleString()}, {_COLUMNS}")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, links, best): how many links of the corpus hold a pair, and whether no pair of its B id has more."""
    total = stage(blocks.groupBy("pair").agg(F.sum("n").alias("links")), "pair-counts")
    piece = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = total.groupBy(piece.alias("b")).agg(F.max("links").alias("most"))
    return total.withColumn("b", piece).join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def _score(_, rows: pa.Table, known: pa.Table) -> pa.Table:
    """A block's rows and its pairs' counts -> each row's n_best and count_sum."""
    pair, links, best = (known.column(c).to_numpy() for c in ("pair", "links", "best"))
    order = np.argsort(pair)
    pair, links, best = pair[order], links[order], best[order].astype(np.int64)
    lists = [rows.column(c).combine_chunks() for c in ("pairs", "times")]
    sizes = np.array([len(x) for x in lists[0]], np.int64) if len(lists[0]) else np.zeros(0, np.int64)
    flat, times = lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy().astype(np.int64)
    at = np.searchsorted(pair, flat)
    of = np.cumsum(np.append(0, sizes))
    sums = [np.append(0, np.cumsum(v[at] * times)) if len(flat) else np.zeros(1, np.int64) for v in (best, links)]
    out = [pa.array(s[of[1:]] - s[of[:-1]], pa.int64()) for s in sums]
    kept = rows.select([c for c in rows.column_names if c not in ("pairs", "times", "block")])
    return kept.append_column("n_best", out[0]).append_column("count_sum", out[1])


def with_link_counts(aligned: DataFrame) -> DataFrame:
    """Adds n_best (links whose pair is its B id's most frequent one, ties included) and count_sum (the corpus counts of a row's links, summed).

    ``pairs``, ``times`` and ``block`` go; other columns are kept.  ``aligned``
    is written once, so what it doesn't need later should be dropped before.
    """
    rows = stage(aligned, "aligned")
    linked = rows.select("block", F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy("block", F.col("x.pairs").alias("pair"))
    blocks = stage(linked.agg(F.sum("x.times").alias("n")), "block-pairs")
    known = blocks.select("block", "pair").join(pair_counts(blocks), "pair")
    kept = [f for f in rows.schema if f.name not in ("pairs", "times", "block")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_best long, count_sum long"
    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_score, schema)


def q_op12(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document's numbers of tokens, groups and links, and its links' corpus counts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = align_tokens(docs).withColumn("groups_sha256", F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups")
    return with_link_counts(found).select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
