"""Operators 11 to 13 against brute force and the libraries, and their edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import EDGES, _workers, edges, nothing  # noqa: F401

from govlake.llm import alignment, automaton, ball_tree
from govlake.llm.stage import tokenizer_path

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a ", " a", "a  b", "x\n y", "don't we'll", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<s> </s> <unk> <0x41>", "▁a b", "\x00a b",
       "﻿x y", "日本語 テキスト", "ﬁ ｆｕｌｌ ①", "՘꟎ ab", "x" * 3000, "ab" * 2000, " " * 300, "-" * 700, "　 a"]


def texts(seed):
    rnd = random.Random(seed)
    kinds = ["abcdefgh ethnai", "aab ", "aaa bb\n\t  ", "zyxéñó語 ", "'strellvmd 0189 ", "▁a b", "-=_. #", "ЖжЯ ё", "<|endoftext|>ab "]
    return [None, *ODD] + ["".join(rnd.choice(kind) for _ in range(rnd.randint(0, 50))) for kind in kinds for _ in range(40)]


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


# --- 13
def by_rank(word, ranks):
    """Merges in rank order, the leftmost first."""
    parts = [bytes([b]) for b in word]
    while True:
        k = min((ranks[p] for p in zip(parts, parts[1:]) if p in ranks), default=None)
        if k is None:
            return parts
        out = []
        while parts:
            if len(parts) > 1 and ranks.get((parts[0], parts[1])) == k:
                out.append(parts[0] + parts[1])
                parts = parts[2:]
            else:
                out.append(parts[0])
                parts = parts[1:]
        parts = out


@pytest.mark.parametrize("seed", range(40))
def test_automaton_of_random_merges(seed):
    """Small alphabets, so that gadgets meet: runs of one letter, merges that can't happen, tokens inside tokens."""
    rnd = random.Random(seed)
    letters = [b"a", b"b", b"c"][: rnd.randint(1, 3)]
    tokens, merges = list(letters), []
    for _ in range(rnd.randint(1, 14)):
        u, v = rnd.choice(tokens), rnd.choice(tokens)
        if u + v not in tokens:
            tokens.append(u + v)
            merges.append((u, v))
    machine = automaton.compile_automaton(merges, {t: i for i, t in enumerate(tokens)})
    ranks = {p: k for k, p in enumerate(merges)}
    for _ in range(150):
        word = b"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 14)))
        assert [tokens[i] for i in machine.encode(word)] == by_rank(word, ranks), (merges, word)


def test_automaton_accepts_only_encodings():
    """The automaton's paths over a and b are the encodings, one for each word."""
    merges = [(b"a", b"b"), (b"b", b"a"), (b"ab", b"a"), (b"a", b"a")]
    tokens = [b"a", b"b"] + [u + v for u, v in merges]
    machine = automaton.compile_automaton(merges, {t: i for i, t in enumerate(tokens)})
    ranks = {p: k for k, p in enumerate(merges)}
    paths, seen = [(-1, b"", [])], defaultdict(list)
    while paths:
        state, word, ids = paths.pop()
        for t, label in enumerate(tokens):
            if len(word + label) <= 6 and t not in machine.dead and machine.arc(state, t):
                seen[word + label].append([tokens[i] for i in [*ids, t]])
                paths.append((t, word + label, [*ids, t]))
    assert len(seen) == sum(2 ** n for n in range(1, 7)) and all(x == [by_rank(w, ranks)] for w, x in seen.items())


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


def test_encode_decode_as_the_library(spark):
    values = texts(1) + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    lib = library()
    for r in automaton.encode_decode(frame(spark, values)).collect():
        ids = lib.encode(values[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.ids, r.decoded) == (ids, lib.decode(ids, skip_special_tokens=False)), values[r.doc_id]


def test_op13(spark):
    lib, docs = library(), {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = automaton.q_op13(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = lib.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert tuple(r) == (r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False)))


def test_encode_decode_edges(edges, nothing):
    rows = automaton.encode_decode(edges).collect()
    assert sorted(((r.doc_id, r.decoded) for r in rows), key=str) == sorted(((r[0], r[1] or "") for r in EDGES), key=str)
    assert [r.ids for r in rows if r.doc_id == 4] == [[]] and automaton.encode_decode(nothing).count() == 0


# --- 12
def aligned(values):
    """Each text's (n_a, n_b, groups, links) token by token, and the corpus counts of the links."""
    side = alignment.Aligner(("byte_bpe_50k.json", "piece_bpe_32k.model", False))
    out = []
    for t in values:
        ids = (side.a.encode(" " + t, add_special_tokens=False).ids, side.b.encode(t)) if t else ([], [])
        if not t or any(b"".join(label[i] for i in x) != b" " + t.encode() for label, x in zip(side.labels, ids)):
            out.append((0, 0, [], []))
            continue
        ends = [dict(zip(np.cumsum([len(label[i]) for i in x]).tolist(), range(1, len(x) + 1))) for label, x in zip(side.labels, ids)]
        cuts, groups, links, at = sorted(ends[0].keys() & ends[1].keys()), [], [], (0, 0)
        for c in cuts:
            p, q = ends[0][c], ends[1][c]
            groups.append(",".join(map(str, ids[0][at[0]:p])) + "|" + ",".join(map(str, ids[1][at[1]:q])))
            links.append((ids[0][p - 1], ids[1][q - 1]))
            at = p, q
        out.append((len(ids[0]), len(ids[1]), groups, links))
    counts = Counter(x for *_, links in out for x in links)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(a, b, len(g), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha(";".join(g)) if g else "")
            for a, b, g, links in out]


def digest(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, sha(r.groups) if r.n_groups else r.groups


def test_alignment_of_odd_texts(spark):
    values = texts(2)
    rows = alignment.with_link_counts(alignment.align_tokens(frame(spark, values))).collect()
    expected = aligned(values)
    assert len(rows) == len(values) and all(digest(r) == expected[r.id] for r in rows)


def test_op12(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_ROWS", 30)  # several blocks a task
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r.doc_id: tuple(r)[1:] for r in alignment.q_op12(spark, SF).collect()}
    assert rows == dict(zip(docs, aligned(docs.values())))


def test_coalesced_intervals():
    """A: 2 3 1 4 bytes, B: 1 4 5: cuts at 5 and 10; the second of A overlaps the second of B only."""
    a, b = np.array([2, 3, 1, 4]), np.array([1, 4, 5])
    n, ga, gb, x, y, together = alignment.coalesce_intervals(a.cumsum(), b.cumsum(), a, b)
    assert n == 2 and ga.tolist() == [0, 0, 1, 1] and gb.tolist() == [0, 0, 1]
    assert list(zip(x.tolist(), y.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2), (3, 2)] and together.tolist() == [False, False, True, False, True]


def test_alignment_overlaps(spark):
    docs = frame(spark, ["unbelievable tokenizations", "x"])
    narrow, wide = (alignment.align_tokens(docs, overlaps=o).orderBy("id").collect() for o in (False, True))
    assert [r.groups for r in narrow] == [r.groups for r in wide] and wide[0].n_links > narrow[0].n_links == narrow[0].n_groups


def test_alignment_edges(edges, nothing):
    rows = alignment.with_link_counts(alignment.align_tokens(edges)).collect()
    by = {r.id: r for r in rows}
    assert len(rows) == len(EDGES) and (by[4].n_a, by[4].n_links, by[4].groups) == (0, 0, "") and by[7].n_links > 30000
    assert by[1].count_sum == by[2].count_sum == by[None].count_sum > 0
    assert alignment.with_link_counts(alignment.align_tokens(nothing)).count() == 0


# --- 11
def ranked(docs, items, k=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(i, Counter(cut(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    n_docs, length = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in bags:
            m = 10 + 90 * n * n_docs // length
            scored.append((-sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                                for t in set(cut(text)) if c[t]), i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(x for x in scored if x[0] < 0)[:k])]
    return out


def test_search_brute_force(spark, monkeypatch):
    """Small trees and blocks, ties, repeated rows, nulls and letters beyond ASCII."""
    for name, value in (("TREE_DOCS", 23), ("LEAF", 3), ("BLOCK_ITEMS", 7)):
        monkeypatch.setattr(ball_tree, name, value)
    rnd = random.Random(5)
    word = lambda: rnd.choice(["Ab", "ab", "É", "é", "x1", "the", "of"] + [f"w{i}" for i in range(60)])
    docs = [(i, rnd.choice([" ", "-", "\n"]).join(word() for _ in range(rnd.randint(0, 30)))) for i in range(300)]
    docs += [(i % 7, docs[i][1]) for i in range(40)] + [(400, None), (401, ""), (402, "the " * 5000), (None, docs[3][1])]
    items = [(i, " ".join(word() for _ in range(rnd.randint(0, 12)))) for i in range(20)] + [(20, None), (20, "the of the"), (20, "the of the"), (None, "w1 w2"), (21, "never")]
    got = ball_tree.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(ranked(docs, items), key=str)


def test_bounds_hold_and_prune():
    """No row's score is above the bound of any node over it, and a query for one cluster leaves the others unscored."""
    rnd = np.random.default_rng(3)
    dense = np.zeros((400, 80), np.int64)
    for i in range(400):
        at = rnd.choice(20, 8, replace=False) + 20 * (i % 4)
        dense[i, at] = rnd.integers(1, 10 ** 6, 8)
    term = [np.flatnonzero(x) for x in dense]
    rows = ball_tree.Rows(np.cumsum([0, *map(len, term)]), np.concatenate(term), np.concatenate([x[t] for x, t in zip(dense, term)]))
    tree = ball_tree.BallTree(rows, 80, groups=8, leaf=5)
    queries = np.zeros((8, 80), np.int64)
    for q in range(8):
        queries[q, rnd.choice(20, 5, replace=False) + 20 * (q % 4)] = rnd.integers(1, 10 ** 4, 5)
    bounds, scores = tree.bounds(queries.astype(float)), queries @ dense.T
    for node, (a, b) in enumerate(zip(tree.first, tree.last)):
        assert (bounds[:, node] >= scores[:, tree.order[a:b]].max(1)).all()
    for q in range(8):
        best = ball_tree._Best(10)
        scored = tree.search(queries[q], bounds[q], lambda at, s: best.offer(list(range(400)), at, s), best.least)
        assert sorted(s for s, _ in best.heap) == sorted(scores[q])[-10:] and scored <= 200


def test_search_edges(spark, edges, nothing):
    items = spark.createDataFrame([(1, "one two", 5), (2, None, 5)], "item_id long, text string, rank int")
    got = sorted(map(tuple, ball_tree.search(edges, items).collect()), key=str)
    assert got == sorted(ranked([r[:2] for r in EDGES], [(1, "one two"), (2, None)]), key=str)
    assert ball_tree.search(nothing, items).count() == 0 and ball_tree.search(edges, items.limit(0)).count() == 0


# --- 6: places of terms
def test_places_over_blocks(spark):
    """Places of chosen words in texts of none to several blocks of words, beside Python's."""
    from pyspark.sql import functions as F

    from govlake.llm import pii

    rnd = random.Random(9)
    values = [" ".join(rnd.choice(["Alpha", "beta", "gamma-ray", "é", "x1"]) for _ in range(n)) for n in (0, 1, 2, 127, 128, 129, 256, 257, 700)]
    df = frame(spark, values).select(F.col("doc_id").alias("mark"), F.array(F.lit("alpha"), F.lit("gamma-ray")).alias("terms"),
                                     pii._occurrences(F.col("text"), F.lit(pii.TERMS[0]), 4).alias("found"))
    got = sorted((r.mark, r.term, r.start, r.end) for r in pii._places(df).collect())
    assert got == sorted((i, m[0].lower(), *m.span()) for i, t in enumerate(values) for m in re.finditer(r"Alpha|gamma-ray", t))
