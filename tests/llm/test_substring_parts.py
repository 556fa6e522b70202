"""Repeats found inside a batch are dealt over the parts of their documents."""

import pyarrow as pa

from govlake.llm import substring


def test_repeats_of_a_batch_are_spread(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{shared} own{i}") for i in range(400)], "doc_id long, text string")
    rows = {r.doc_id: r for r in substring.dedup_substrings(docs).collect()}
    assert rows[0].n_removed == 0 and all(rows[i].n_removed == 60 and rows[i].kept == f"own{i}" for i in range(1, 400))


def test_parts_of_a_batch(monkeypatch):
    text = (" ".join(f"w{i}" for i in range(40))).encode()
    n, parts = 64, 8
    batch = pa.table({"id": pa.array(range(n), pa.int64()), "mark": pa.array([5] * n, pa.int64()), "text": pa.array([text] * n, pa.binary())}).to_batches()[0]
    import numpy as np
    monkeypatch.setattr(substring, "_addressed", lambda batches: ((b, [np.arange(0, 30)] * b.num_rows) for b in batches))
    out = next(substring._windows(20, parts)([batch])).to_pylist()
    repeats = [r for r in out if r["kind"] == 2]
    assert {r["part"] for r in repeats} == set(range(parts))
    assert sum(len(substring._unpacked(*(r[c] for c in substring._NAMES[4:]))[0]) for r in repeats) == (n - 1) * 21
