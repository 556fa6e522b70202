"""Nulls, empty and very long texts, ties and repeated rows, empty tables and clashing column names."""

import hashlib

import pytest
from llm_fixtures import EDGES, LONG, _workers, edges, nothing  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from govlake.llm import contamination, jaccard, packing, pii, quality, secrets, sharding, substring, token_counts, warc

BENCH = "item_id long, text string, s string, n int"


def test_secrets(edges, nothing):
    rows = secrets.scan(edges).collect()
    assert [(r.doc_id, r.value) for r in rows] == [(13, "abc123def456")]
    assert secrets.scan(nothing).count() == 0


def test_packing(edges, nothing):
    rows = packing.pack_documents(edges).collect()
    assert sorted({r.doc_id for r in rows}, key=str) == sorted({r[0] for r in EDGES}, key=str)
    assert sum(r.piece == 0 for r in rows) == len(EDGES) and [r.length for r in rows if r.doc_id == 4] == [1]
    assert packing.pack_documents(nothing).count() == 0


def test_substrings(edges, nothing):
    rows = substring.dedup_substrings(edges).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(rows) == len(EDGES) and len(by[6]) == 2 and by[6][0].n_removed == 0  # rows of one id are one document
    words = LONG.split()
    assert by[7][0].n_words == len(words) and by[7][0].n_removed == by[7][1].n_removed == len(words) - 5
    assert by[8][0].n_removed == len(words) and by[8][0].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[4][0].n_words == 0 and substring.dedup_substrings(nothing).count() == 0


def test_sharding(edges, nothing):
    dims = lambda df: {"source": sharding.category("source"), "n_chars": F.col("n_chars")}
    rows = sharding.hilbert_shards(edges, dims(edges), 4).collect()
    assert len(rows) == len(EDGES) and sorted(sum(r.shard == s for r in rows) for s in range(4)) == [4, 4, 4, 4]
    assert sharding.hilbert_shards(nothing, dims(nothing), 4).count() == 0


def test_quality(edges, nothing):
    rows = quality.apply_rules(edges).collect()
    assert len(rows) == len(EDGES) and set(edges.columns) <= set(rows[0].asDict())
    by = {r.doc_id: r for r in rows}
    assert by[4].n_words == 0 and by[4].base_failed and not by[4].kept and by[8].n_repeat_words == by[8].n_words == len(LONG.split())
    assert quality.apply_rules(nothing).count() == 0


def test_host_verdicts_spare_clean_documents(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    loud = " ".join(f"word{i}" + ("#" if i % 10 == 0 else "") for i in range(60))  # lenient failure only
    junk = " ".join(["same words here again"] * 30)
    rows = [(i, clean, "good") for i in range(40)] + [(100 + i, loud, "good") for i in range(2)]
    rows += [(200 + i, junk, "bad") for i in range(40)] + [(300, clean, "bad"), (301, loud, "bad"), (302, loud, None)]
    got = {r.doc_id: r for r in quality.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].kept and got[100].kept and not got[200].kept and got[300].kept and not got[301].kept and got[301].host_suspect
    assert not got[0].host_suspect and len(got) == len(rows)


def test_pii(edges, nothing):
    rows = pii.find_pii(edges).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(EDGES) and (by[10].n_email, by[10].n_ip, by[10].n_card, by[10].n_phone) == (1, 1, 1, 1) and by[4].spans == ""
    clean = {r.doc_id: r.text for r in pii.sanitise(edges).collect()}
    assert clean[10] == "mail <EMAIL> or <PHONE> from <IP>, card <CARD>." and clean[4] is None and clean[7] == LONG
    assert pii.sanitise(edges).columns == edges.columns and pii.find_pii(nothing).count() == 0 and pii.sanitise(nothing).count() == 0


def test_token_counts(edges, nothing):
    rows = token_counts.count_tokens(edges).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(EDGES) and (by[4].n_bytes, by[4].n_tokens) == (0, 0) and by[7].n_bytes == len(LONG)
    assert token_counts.count_tokens(nothing).count() == 0


def test_jaccard(edges, nothing):
    rows = jaccard.near_duplicates(edges).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(EDGES) and by[2].component_id == 1 and by[None].component_id == 1 and by[8].component_id == 7
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0 and by[5].component_id == 5 and by[6].n_shingles == 1
    assert jaccard.near_duplicates(nothing).count() == 0


def test_contamination(spark, edges, nothing):
    bench = spark.createDataFrame([(1, "two three four five six", "x", 1), (2, None, "x", 1), (3, "", None, None), (None, "short text", "x", 1),
                                   (4, "Lorem ipsum dolor sit amet lorem ipsum", "x", 1), (4, "never seen words in any document", "x", 1)], BENCH)
    united = sorted(((r.doc_id, r.item_id) for r in contamination.find_contamination(edges, bench, by_text=False).collect()), key=str)
    assert united == sorted([(1, 1), (2, 1), (None, 1), (6, None), (6, None)], key=str)
    got = sorted(((r.doc_id, r.item_id) for r in contamination.find_contamination(edges, bench).collect()), key=str)
    assert got == sorted(united + [(7, 4), (7, 4), (8, 4)], key=str)  # one of the two texts of item 4
    assert contamination.find_contamination(edges, spark.createDataFrame([], BENCH)).count() == 0
    assert contamination.find_contamination(nothing, bench).count() == 0
    left = contamination.decontaminate(edges, bench)
    assert left.columns == edges.columns and left.count() == len(EDGES) - 8
    assert contamination.decontaminate(edges, bench, by_text=False).count() == len(EDGES) - 5


def test_contamination_tells_texts_apart(spark):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"x {a} y"), (2, f"x {b} y"), (3, "nothing of it is in here")], "doc_id long, text string")
    nulls = spark.createDataFrame([(None, a), (None, b), (None, a), (None, None)], "item_id long, text string")
    assert sorted(map(tuple, contamination.find_contamination(docs, nulls).collect())) == [(1, None, 16, 16), (2, None, 16, 16)]
    one = spark.createDataFrame([(7, a), (7, b), (7, a)], "item_id long, text string")
    assert sorted(map(tuple, contamination.find_contamination(docs, one).collect())) == [(1, 7, 16, 16), (2, 7, 16, 16)]
    assert [r.doc_id for r in contamination.decontaminate(docs, one).collect()] == [3]
    assert contamination.find_contamination(docs, one, by_text=False).count() == 0  # each holds half of the united item


def test_contamination_sql_tells_texts_apart(spark):
    import duckdb

    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    docs = [(1, f"x {a} y"), (2, f"x {b} y {a}"), (3, "nothing of it is in here"), (4, None)]
    items = [(7, a), (7, b), (7, a), (None, a), (8, None), (9, "")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    got = contamination.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(con.execute(contamination.SQL_OP9).fetchall(), key=str)
    assert got.count() == 5


def test_warc(edges, nothing):
    shape = lambda df: df.withColumn("url", F.col("lang"))
    folder, manifest = warc.write_archives(shape(edges), id_col="doc_id", payload_col="text")
    rows = warc.read_archives(folder, manifest).collect()
    assert len(rows) == len(EDGES) and sum(r.record_type == "response" for r in rows) == 11  # repeated (6, short text) are both responses
    folder, manifest = warc.write_archives(shape(nothing), id_col="doc_id", payload_col="text")
    assert warc.read_archives(folder, manifest).count() == 0


@pytest.mark.parametrize("k", range(4))
def test_pipeline_stages(spark, edges, nothing, k):
    _, step = corpus_pipeline.STAGES[k]
    assert step(spark, edges, "/root/testdata/sf0.001").columns == edges.columns
    assert step(spark, nothing, "/root/testdata/sf0.001").count() == 0


#: Names that the operators use or used for columns of their own, and names of their outputs.
CLASHES = ["_run_id", "_run1", "_id", "_mark", "_spans", "_w", "_h", "_lines", "_text", "_head", "_host", "_again", "_blank", "_found_id", "_found_mark", "_doc_mark", "__x",
           "n_words", "n_repeat_words", "kept", "base_failed", "host_rate", "mark", "id", "head", "row", "c0", "c1", "w", "s", "bound"]


def _clashing(spark):
    sound = [" ".join(f"word{i}x{j}" for j in range(40)) for i in range(4)] + ["mail a.b@c.example.org " + " ".join(f"other{j}" for j in range(40))]
    rows = [(i, t, "en", "host", len(t), *[f"{c}-{i}" for c in CLASHES]) for i, t in enumerate(sound)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))


@pytest.mark.parametrize("k", range(4))
def test_pipeline_stages_keep_clashing_columns(spark, k):
    docs = _clashing(spark)
    got = corpus_pipeline.STAGES[k][1](spark, docs, "/root/testdata/sf0.001")
    assert got.columns == docs.columns
    values = lambda df: sorted(tuple(r[c] for c in ["doc_id", "lang", "source", *CLASHES]) for r in df.collect())
    assert values(got) == values(docs)


def test_operators_keep_clashing_columns(spark):
    docs, bench = _clashing(spark), spark.createDataFrame([(1, "never in a document at all")], "item_id long, text string")
    outputs = {*quality.MEASURES, "base_failed", "host_rate", "host_suspect", "kept"}
    for df, but in ((quality.apply_rules(docs), outputs), (contamination.decontaminate(docs, bench), set()), (pii.sanitise(docs), {"text"})):
        same = [c for c in docs.columns if c not in but]
        assert sorted(map(tuple, df.select(*same).collect())) == sorted(map(tuple, docs.select(*same).collect()))


def test_stages_remove_what_the_one_before_left(spark):
    import os

    docs = _clashing(spark)
    first = corpus_pipeline.keep_sound(spark, docs, "/root/testdata/sf0.001")
    left = [p.removeprefix("file:") for p in corpus_pipeline._behind]
    rows = first.collect()
    assert left and all(map(os.path.isdir, left))
    corpus_pipeline.keep_one_of_each_group(spark, spark.createDataFrame(rows, docs.schema), "/root/testdata/sf0.001")
    assert not any(map(os.path.isdir, left)) and len(corpus_pipeline._behind) >= 1
