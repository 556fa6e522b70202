"""All stages of the pipeline against plain Python over the same rows."""

import re
from collections import Counter, defaultdict

from llm_fixtures import _workers  # noqa: F401
from test_brute_force import _base, _components, _pieces, _sets

import corpus_pipeline
from govlake.llm.quality import SYMBOLS
from govlake.llm.stage import tokenizer_path

SF = "/root/testdata/sf0.001"
TAGS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}


def _measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    twice = {p for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(text.count(s) for s in SYMBOLS), len(lines) - len(set(lines)), len(twice)


def _rules(n, chars, symbols, dup, rep):
    base = n < 20 or 100 * rep > 30 * n
    strict = 100 * symbols > 20 * n or chars < 3 * n or chars > 10 * n
    lenient = (base or 100 * symbols > 5 * n or 10 * chars < 35 * n or chars > 8 * n or 100 * rep > 20 * n or (dup >= 5 and 100 * dup > 10 * n))
    return base, strict, lenient


def _sound(docs):
    found = {d: _rules(*_measures(t or "")) for d, (t, _) in docs.items()}
    hosts = defaultdict(lambda: [0, 0])
    for d, (_, source) in docs.items():
        hosts[source][0] += 1
        hosts[source][1] += found[d][2]
    n, k = sum(a for a, _ in hosts.values()), sum(b for _, b in hosts.values())
    p = k / n
    between = (sum(b * b / a for a, b in hosts.values()) - n * p * p) / n
    drawn = p * (1 - p) * len(hosts) / n
    weight = max(p * (1 - p) / (between - drawn) - 1, 2) if between > drawn and 0 < p < 1 else 2
    bad = {h for h, (a, b) in hosts.items() if (b + weight * p) / (a + weight) > 0.5}
    return {d: v for d, v in docs.items() if not found[d][0] and not found[d][1] and not (v[1] in bad and found[d][2])}


def _mask(text):
    """Spans replaced in order of start; overlapping ones are one, under the first's tag."""
    out, at = [], 0
    for a, e, kind in sorted((a, e, k) for k, a, e in _base(text)):
        if e <= at:
            continue
        if a >= at:
            out += [text[at:a], TAGS[kind]]
        at = e
    return "".join([*out, text[at:]])


def test_pipeline_equals_brute_force(spark):
    from tokenizers import Tokenizer

    docs = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(i, _sets(t)) for i, t in ((r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect())]
    docs = _sound(docs)
    comps, _ = _components([(d, t) for d, (t, _) in docs.items()])
    docs = {d: v for d, v in docs.items() if comps[d][1] == d}
    docs = {d: v for d, v in docs.items() if not any(4 * len(s & _sets(v[0])) >= 3 * len(s) for _, s in items if s)}
    lib = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = {(d, *p) for d, (t, _) in docs.items() for p in _pieces(lib.encode(_mask(t or ""), add_special_tokens=False).ids + [2], 1024)}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    bins = defaultdict(int)
    for r in rows:
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 1024 and len(bins) <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 1
