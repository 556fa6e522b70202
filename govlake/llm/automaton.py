"""Byte-pair encoding and decoding with a tokenization automaton (operator 13).

``compile_automaton`` turns the merges of a tokenizers file into a deterministic
automaton over tokens that accepts exactly the encodings.  It begins with one
arc for each byte between any two states and applies one gadget a merge, in
rank order: merge (u, v) -> w gives w the incoming arcs that u has and the
outgoing arcs that v has at that moment, and then cuts the arc v behind u.  All
arcs of a token lead to one state, so a state is the token just read, and
gadgets that come later copy what earlier ones have cut.

What gadget k cuts, seen from the finished automaton, is every arc from a state
whose token still ends in a u of its own when merge k runs to a token that
still begins with a v of its own then.  Tokens that end in u are a subtree of
the forest "token -> its right half", and with children in falling order of
rank those not yet merged at k are a run of that tree's preorder; likewise for
the left halves.  So each gadget cuts a rectangle (run of states x run of
tokens), and a state's row of the table is a sorted list of runs of tokens
without an arc.

Encoding walks a word's bytes once: each place has one state, for a prefix of a
word has one encoding; from it the lexicon (a trie of the tokens' bytes)
proposes tokens, and the table says which of them have an arc.  Decoding emits
the bytes that an arc's token stands for.

Cases: a null or empty text has no tokens and decodes to "".  Strings of added
tokens inside a text become their ids, as the library does by default.
Repeated rows give repeated rows, an empty table an empty one, null ids are
kept.  Very long words take time in proportion to their length.  Only
``id_col`` and ``text_col`` are read; other columns may have any name.
"""

from __future__ import annotations

import json
from array import array
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import tokenizer_path
from .tokens import _Memo, opened

#: Rows encoded at once in a task.
ROWS = 500
#: Code points whose classes are compared with the library's at load; texts with others are split by the library.
CHECKED = ((0x00, 0x530), (0x2010, 0x2028), (0x3041, 0x3097), (0x30A1, 0x30FB), (0x4E00, 0x9FA6), (0xAC00, 0xD7A4))


def _byte_letters() -> dict[str, int]:
    """Byte-level files write a byte as a letter: printable ones as themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


class _Forest:
    """Preorder of the forest ``token -> half[token]``; a node's children stand in falling order of rank."""

    def __init__(self, half: list[int], rank: list[int]):
        n = len(half)
        self.children: list[list[int]] = [[] for _ in range(n)]
        for t in sorted(range(n), key=lambda t: -rank[t]):
            if half[t] >= 0:
                self.children[half[t]].append(t)
        self.at, self.end, self.rank = [0] * n, [0] * n, rank
        count = 0
        for root in (t for t in range(n) if half[t] < 0):
            stack = [(root, False)]
            while stack:
                t, done = stack.pop()
                if done:
                    self.end[t] = count
                    continue
                self.at[t] = count
                count += 1
                stack.append((t, True))
                stack += [(c, False) for c in reversed(self.children[t])]

    def unmerged(self, t: int, k: int) -> tuple[int, int]:
        """The run of tokens whose outermost ``t`` on this side is still whole after the merges up to k."""
        end = self.at[t] + 1
        for c in self.children[t]:
            if self.rank[c] <= k:
                break
            end = self.end[c]
        return self.at[t], end


class Automaton:
    """States and tokens are numbered by their places in the two preorders.

    ``first`` and ``beyond``: the runs of absent arcs, as state * (tokens + 1) +
    token, sorted and disjoint; ``row``: where each state's runs begin.
    """

    def __init__(self, half_left: list[int], half_right: list[int], rank: list[int], labels: list[bytes]):
        n = len(rank)
        self.labels = labels
        states, tokens = _Forest(half_right, rank), _Forest(half_left, rank)
        self.state_of, self.token_at = states.at, tokens.at
        rules = {(half_left[t], half_right[t]): t for t in range(n) if rank[t] >= 0}
        self.dead = set()
        for t in sorted((t for t in range(n) if rank[t] >= 0), key=rank.__getitem__):
            if half_left[t] in self.dead or half_right[t] in self.dead or self._cut_before(t, half_left, half_right, rank, rules):
                self.dead.add(t)
        cuts = []
        for (u, v), t in rules.items():
            if t not in self.dead:  # of a run u u u the first two merge: then a w in front of which a u stands is broken too
                cuts.append((*states.unmerged(u, rank[t]), *tokens.unmerged(v, rank[t] - (u == v))))
        cut = np.array(cuts, np.int64).reshape(-1, 4)
        wide = cut[:, 1] - cut[:, 0]
        each = np.repeat(np.arange(len(cut)), wide)
        rows = np.arange(len(each)) - np.repeat(np.cumsum(wide) - wide, wide) + cut[each, 0]
        low, high = rows * (n + 1) + cut[each, 2], rows * (n + 1) + cut[each, 3]
        order = np.argsort(low, kind="stable")
        low, high = low[order], np.maximum.accumulate(high[order]) if len(order) else high
        new = np.ones(len(low), bool)
        new[1:] = low[1:] > high[:-1]
        starts = np.flatnonzero(new)
        self.first = array("q", low[starts].tobytes())
        self.beyond = array("q", (high[np.append(starts[1:], len(low)) - 1] if len(starts) else low).tobytes())
        self.row = array("q", np.searchsorted(low[starts], np.arange(n + 1) * (n + 1)).astype(np.int64).tobytes())
        self.width = n + 1
        # the lexicon: (node * 256 + byte) -> node, and the token that ends there
        self.step, self.ends = {}, [-1]
        for t, label in enumerate(labels[:n]):
            if t in self.dead:
                continue
            node = 0
            for b in label:
                at = node << 8 | b
                if at not in self.step:
                    self.step[at] = len(self.ends)
                    self.ends.append(-1)
                node = self.step[at]
            self.ends[node] = t

    @staticmethod
    def _cut_before(t: int, left, right, rank, rules) -> bool:
        """Whether the arc that merge t needs was cut before: then w never arises and its gadget adds nothing."""
        a, up_a = left[t], rank[t]
        while a >= 0:
            b, up_b = right[t], rank[t]
            while b >= 0:
                other = rules.get((a, b))
                if other is not None and other != t and (rank[other] < min(up_a, up_b) or a == b and rank[other] == up_b < up_a):
                    return True
                up_b, b = rank[b], left[b]
            up_a, a = rank[a], right[a]
        return False

    def arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow ``state`` (a token, or -1: the start)."""
        if state < 0:
            return True
        s = self.state_of[state]
        key = s * self.width + self.token_at[token]
        at = bisect_right(self.first, key, self.row[s], self.row[s + 1])
        return at == self.row[s] or self.beyond[at - 1] <= key

    def encode(self, word: bytes) -> list[int]:
        """The one path through ``word`` from the start state."""
        n, step, ends = len(word), self.step, self.ends
        first, beyond, row, width, state_of, token_at = self.first, self.beyond, self.row, self.width, self.state_of, self.token_at
        state = [-2] * (n + 1)
        state[0] = -1
        for i in range(n):
            node = 0
            if i:
                s = state_of[state[i]]
                low, high, base = row[s], row[s + 1], s * width
            for j in range(i, n):
                node = step.get(node << 8 | word[j])
                if node is None:
                    break
                token = ends[node]
                if token >= 0 and state[j + 1] == -2:
                    if i:  # as in arc()
                        key = base + token_at[token]
                        at = bisect_right(first, key, low, high)
                        if at > low and beyond[at - 1] > key:
                            continue
                    state[j + 1] = token
        ids, at = [], n
        while at:
            ids.append(state[at])
            at -= len(self.labels[state[at]])
        return ids[::-1]


def compile_automaton(merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]) -> Automaton:
    """The automaton of ``merges`` in rank order over the tokens ``ids`` (0 to their number less one)."""
    n = len(ids)
    labels = [b""] * n
    for label, t in ids.items():
        labels[t] = label
    left, right, rank = [-1] * n, [-1] * n, [-1] * n
    for k, (a, b) in enumerate(merges):
        t = ids[a + b]
        if rank[t] >= 0 or len(a + b) < 2:
            raise ValueError(f"two merges give {a + b!r}")
        left[t], right[t], rank[t] = ids[a], ids[b], k
    if any(r < 0 and len(x) != 1 for r, x in zip(rank, labels)):
        raise ValueError("a token of several bytes has no merge")
    return Automaton(left, right, rank, labels)


class Codec:
    """Pre-splitting, encoding and decoding of a byte-level BPE file of the tokenizers library."""

    def __init__(self, name: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        path = tokenizer_path(name)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or any(
                model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{name} isn't a plain byte-level BPE file")
        letters = _byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        added = {t["content"]: t for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added.values()):
            raise ValueError("added tokens that take in their surroundings")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.machine = compile_automaton([(raw(a), raw(b)) for a, b in pairs], {raw(s): i for s, i in model["vocab"].items() if s not in added})
        self.special = {s: t["id"] for s, t in added.items()}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.other = self._unchecked()
        self.memo = _Memo(lambda w: np.array(self.machine.encode(w.encode()), "<u4").tobytes())
        labels = self.machine.labels + [b""] * (1 + max([-1, *self.special.values()]) - len(self.machine.labels))
        for s, i in self.special.items():
            labels[i] = s.encode()
        self.size = np.array([len(x) for x in labels], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(labels), np.uint8)

    def _unchecked(self):
        """Matches code points outside the ranges in which the pattern was seen to split as the library does."""
        import regex

        good = []
        for low, high in CHECKED:
            probe = "".join(f"a{chr(c)}1 {chr(c)}{chr(c)}!\n" for c in range(low, high))
            if [m.span() for m in self.pattern.finditer(probe)] == [at for _, at in self.splitter.pre_tokenize_str(probe)]:
                good.append((low, high))
        return regex.compile("[^" + "".join(rf"\U{a:08x}-\U{b - 1:08x}" for a, b in good) + "]") if good else regex.compile("(?s).")

    def words(self, text: str) -> list[str]:
        if self.other.search(text):
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        memo = self.memo
        if self.cut_special is None or not any(s in text for s in self.special):
            return b"".join([memo[w] for w in self.words(text)])
        out = []
        for k, part in enumerate(self.cut_special.split(text)):
            if k % 2:
                out.append(int(self.special[part]).to_bytes(4, "little"))
            else:
                out += [memo[w] for w in self.words(part)] if part else []
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The labels of ``ids`` one after another."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.blob[np.repeat(self.start[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


def _run(name: str):
    def run(batches):
        codec = opened(Codec, name)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                b = batch.slice(at, ROWS)
                coded = [codec.encode(t) if t else b"" for t in b.column("text").to_pylist()]
                places = np.cumsum([0, *(len(x) // 4 for x in coded)])
                ids = np.frombuffer(b"".join(coded), "<u4")
                texts = [codec.decode(ids[p:q]).decode("utf-8", "replace") for p, q in zip(places[:-1], places[1:])]
                lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column("id"), lists, pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    return run


def encode_decode(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every row of ``docs``; nothing is shuffled."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    out = rows.mapInArrow(_run(tokenizer), f"id {kind.simpleString()}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)


def q_op13(spark, sf_dir: str) -> DataFrame:
    """Contract query: digests of every document's ids and of their decoding."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_decode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
