"""Token ids and counts of whole texts.

The byte-level BPE file of the tokenizers library has the same vocabulary as a
rank file of tiktoken, which encodes four times as fast; the two are compared
when they are loaded, and texts that they might treat differently (special
strings) or slowly (very long runs) go to the tokenizers library.

The sentencepiece file never merges across the start of a word that follows a
space, so a text's count is the sum over its words.  Words repeat far more than
texts do, so each Python worker keeps a bounded memo of words.  Texts for which
that law isn't certain (runs of spaces, the marker character) go to the library.
"""

from __future__ import annotations

import base64
import os
import re
import struct

from .stage import tokenizer_path

#: Entries of each of a memo's two generations.
MEMO = 300_000

#: Longer words or runs of white space are left to the tokenizers library.
RUN = 1000
_WIDE = re.compile(rf"\s{{{RUN}}}")


class _Memo(dict):
    """chunk -> value; bounded: a full generation becomes the old one.

    What is asked for again moves back into the young generation, so frequent
    chunks stay.
    """

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, chunk):
        value = self.old.get(chunk)
        if value is None:
            value = self.make(chunk)
        if len(chunk) <= 64:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[chunk] = value
        return value


class BytePairIds:
    """Ids of a byte-level BPE file of the tokenizers library, as little-endian unsigned 32-bit bytes."""

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(tokenizer_path(name))
        self.lib.no_truncation()
        self.lib.no_padding()
        self.special = tuple(t.content for t in self.lib.get_added_tokens_decoder().values())
        self.fast = self._ranks(name)

    def _ranks(self, name: str):
        """The rank file of the same name, if its vocabulary and pattern are those of the library's file."""
        path = tokenizer_path(name).removesuffix(".json") + ".tiktoken"
        if not os.path.exists(path):
            return None
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # the library writes bytes as letters: printable ones as themselves, the others from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = dict(zip(plain, map(chr, plain)))
        letters |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in letters)}
        vocabulary = self.lib.get_vocab(with_added_tokens=False)
        if {"".join(letters[b] for b in token): rank for token, rank in ranks.items()} != {k: v for k, v in vocabulary.items() if k not in self.special}:
            return None
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self.fast is None or any(s in text for s in self.special) or max(map(len, text.split()), default=0) > RUN or _WIDE.search(text):
            ids = self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


class PieceCounts:
    """Token counts of a sentencepiece file, without begin or end tokens."""

    def __init__(self, name: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        pieces = [self.lib.id_to_piece(i) for i in range(self.lib.get_piece_size())]
        #: no piece goes on after a word's end, and the normaliser leaves texts alone
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces) and self.lib.normalize("a  b ") == "▁a▁▁b▁"
        self.memo = _Memo(lambda w: len(self.lib.encode(w)))

    def count(self, text: str) -> int:
        if not self.by_word or "  " in text or "▁" in text or text[:1] == " " or text[-1:] == " ":
            return len(self.lib.encode(text))
        memo = self.memo
        return sum([memo[w] for w in text.split(" ")]) if text else 0


_OPEN: dict[tuple, object] = {}


def opened(kind: type, name: str):
    """The worker's tokenizer, loaded once a process."""
    if (kind, name) not in _OPEN:
        _OPEN[kind, name] = kind(name)
    return _OPEN[kind, name]
