"""Information-theoretic sanitisation of personal data (operator 6), with DataFrame functions only.

Base spans are found by pattern and checked: e-mail addresses, IPv4 addresses,
card numbers (Luhn) and phone numbers; these are the protected entities.  A
match's place is the sum of the lengths before it, from the text split at the
pattern's matches.  Then the corpus tells which terms reveal an entity:

1. a text's terms are its words without the punctuation around them, and the
   runs of letters and digits in these; a term supports an entity by the number
   of distinct texts that hold both, so that copies of one document count once;
2. over all documents, with ``df`` counting distinct texts, the pointwise mutual
   information ``log2(n(e,t) * N / (df(t) * df(e)))`` of a term and an entity is
   compared with the entity's information content ``log2(N / df(e))``;
3. a pair with enough support and ``PMI >= alpha * IC`` discloses: every text
   that holds the term gets a span at each place of it that overlaps no entity
   (a run inside a marked word none of its own).  The term is removed if it
   gives the entity away entirely (``PMI >= IC``), else generalised.

Cases: a null or empty text has no spans.  Repeated rows and copies get the
same spans.  A null id is kept.  An empty table gives an empty result.  Patterns
never back up over a run they have failed on, so long runs of one character
take linear time, and groups don't recurse.  An extra column with the name of an
output is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stage import private, stage

KINDS = ("email", "ip", "card", "phone", "term")

#: The contract's patterns, with possessive repeats and no second start inside a run that has failed
#: (\G: a run may go on right after a match).
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What a text must hold for a pattern to match.
NEEDS = ("@", ".", "", "+")

SPAN = "array<struct<kind: int, start: int, end: int, tag: string>>"
#: Terms: from a word's first letter or digit to its last, and the runs of letters and digits in it.
TERMS = (r"[\p{L}\p{N}](?:[^\x20\x09-\x0D]*[\p{L}\p{N}])?", r"[\p{L}\p{N}]+")
#: One text in so many gives a lower bound of each term's document frequency.
GLIMPSE = 8
#: Occurrences whose lengths are summed up together.
BLOCK = 128


def _occurrences(text: Column, pattern: Column, kind: int) -> Column:
    """An array of (kind, gap, value): matches with the length of the text before each, back to the match before."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    before = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    return F.zip_with(found, before, lambda x, a: F.struct(F.lit(kind).alias("kind"), F.length(a).alias("gap"), x.alias("value")))


_FOUND = "array<struct<kind: int, gap: int, value: string>>"


def _all_occurrences(text: Column) -> Column:
    out = []
    for kind, (pattern, need) in enumerate(zip(PATTERNS, NEEDS)):
        p = F.lit(pattern)
        has = text.rlike(pattern)
        if need:
            has = text.contains(need) & has
        out.append(F.when(has, _occurrences(text, p, kind)).otherwise(F.array().cast(_FOUND)))
    return F.concat(*out)


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + (
        F.when(i % 2 == 1, back.substr(i, F.lit(1)).cast("int")).otherwise(
            F.pmod(back.substr(i, F.lit(1)).cast("int") * 2, F.lit(10)) + F.when(back.substr(i, F.lit(1)) >= "5", 1).otherwise(0))))
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == 0, F.lit(True))
            .when(kind == 1, value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$"))
            .when(kind == 2, F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
            .otherwise(n.between(9, 15)))


def _placed(found: DataFrame) -> DataFrame:
    """Places of exploded occurrences: lengths summed up along each (id, mark, kind, term)."""
    along = Window.partitionBy("id", "mark", "kind", "which").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(along).cast("int")
    return found.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, mark (a hash that tells texts of one id apart) and text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Checked matches: id, mark, kind (its place in KINDS), start, end, value; written in the shared folder."""
    rows = _keyed(docs, id_col, text_col).withColumn("found", _all_occurrences(F.col("text"))).where(F.size("found") > 0)
    found = rows.select("id", "mark", F.posexplode("found").alias("pos", "f")).select("id", "mark", "pos", "f.*").withColumn("which", F.lit(""))
    found = found.dropDuplicates(["id", "mark", "pos"])  # repeated rows
    return stage(_placed(found).where(_valid(F.col("kind"), F.col("value"))).select(
        "id", "mark", "kind", "start", "end", "value"), "pii-base")


def _terms(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in TERMS]), F.lower))


def disclosing_terms(docs: DataFrame, base: DataFrame, alpha: float = 0.9, min_support: int = 3, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(kind, entity, term, removed): terms that give an entity away, by co-occurrence over all documents."""
    texts = _keyed(docs, id_col, text_col).select("mark", "text")
    n_texts = float(texts.select("mark").distinct().count())
    ic = F.log2(F.lit(n_texts) / F.col("df_e"))
    pmi = lambda df_t: F.log2(F.col("n") * F.lit(n_texts) / (F.col(df_t) * F.col("df_e")))
    entities = base.select("kind", F.lower("value").alias("entity"), "mark").distinct()
    # no term has more support than the entity has texts
    of_entity = entities.groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("df_e")).where((F.col("df_e") >= min_support) & (ic > 0))
    entities = stage(entities.join(of_entity, ["kind", "entity"]), "pii-entities")
    due = entities.select("mark").distinct().withColumn("due", F.lit(True))
    seen = texts.join(due, "mark", "left").where(F.col("due") | (F.pmod("mark", F.lit(GLIMPSE)) == 0))
    seen = stage(seen.select("mark", F.coalesce("due", F.lit(False)).alias("due"), _terms(F.col("text")).alias("terms")).dropDuplicates(["mark"]), "pii-seen")
    held = seen.select("mark", "due", F.explode("terms").alias("term"))
    # a term is in at least as many texts as were seen: what fails by that number needn't be counted
    least = held.groupBy("term").agg(F.count(F.lit(1)).alias("least"), F.count_if("due").alias("most"))
    together = entities.join(held.where("due"), "mark").groupBy("kind", "entity", "term").agg(F.count(F.lit(1)).alias("n"), F.first("df_e").alias("df_e"))
    strong = together.where(F.col("n") >= min_support).join(least.where(F.col("most") >= min_support), "term").where(pmi("least") >= alpha * ic)
    strong = stage(strong.select("kind", "entity", "term", "n", "df_e"), "pii-pairs")
    words = texts.select("mark", F.explode(_terms(F.col("text"))).alias("term"))
    of_term = words.join(strong.select("term").distinct(), "term", "left_semi").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    scored = strong.join(of_term, "term").where(pmi("df_t") >= alpha * ic)
    return stage(scored.select("kind", "entity", "term", (F.col("n") >= F.col("df_t")).alias("removed")), "pii-terms")


def _places(texts: DataFrame) -> DataFrame:
    """mark, term, start, end of the occurrences (``found``) of each text's own ``terms``; others don't become rows.

    An occurrence begins where the lengths before it end.  These are summed up
    by blocks first, so that a place costs a block and the blocks before it.
    """
    texts = texts.where(F.size("found") > 0).withColumn("lengths", F.transform("found", lambda x: x["gap"] + F.length(x["value"])))
    total = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + x)
    last = F.floor((F.size("lengths") - 1) / BLOCK).cast("int")
    texts = texts.withColumn("blocks", F.transform(F.sequence(F.lit(0), last), lambda b: total(F.slice("lengths", b * BLOCK + 1, F.lit(BLOCK)))))
    own = F.filter(F.transform("found", lambda x, i: F.struct(i.alias("i"), x["gap"].alias("gap"), F.length(x["value"]).alias("n"), F.lower(x["value"]).alias("term"))),
                   lambda x: F.array_contains(F.col("terms"), x["term"]))
    block = lambda x: F.floor(x["i"] / BLOCK).cast("int")
    before = lambda x: total(F.slice("blocks", F.lit(1), block(x))) + total(F.slice("lengths", block(x) * BLOCK + 1, x["i"] - block(x) * BLOCK))
    rows = texts.select("mark", F.explode(F.transform(own, lambda x: F.struct(x["term"].alias("term"), (before(x) + x["gap"]).alias("start"), x["n"].alias("n")))).alias("x"))
    return rows.select("mark", "x.term", "x.start", (F.col("x.start") + F.col("x.n")).alias("end"))


def _term_spans(docs: DataFrame, base: DataFrame, terms: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """mark, start, end, tag: the places of disclosing terms in each distinct text that holds one."""
    texts = _keyed(docs, id_col, text_col).select("mark", "text")
    holders = texts.select("mark", F.explode(_terms(F.col("text"))).alias("term")).join(terms.select("term").distinct(), "term", "left_semi")
    # with the entities of the text itself: removed if the term gives all that it discloses there away entirely
    own = base.select("mark", "kind", F.lower("value").alias("entity")).join(terms, ["kind", "entity"]).select("mark", "term", F.col("removed").cast("int"))
    due = stage(holders.withColumn("removed", F.lit(None).cast("int")).unionByName(own).groupBy("mark", "term").agg(
        F.coalesce(F.min("removed"), F.lit(0)).alias("removed")), "pii-due")
    whole = texts.join(due.select("mark").distinct(), "mark", "left_semi").dropDuplicates(["mark"])
    whole = whole.join(due.groupBy("mark").agg(F.collect_set("term").alias("terms")), "mark")
    found = [_places(whole.select("mark", "terms", _occurrences(F.col("text"), F.lit(p), 4).alias("found"))) for p in TERMS]
    hits = found[0].unionByName(found[1]).join(due, ["mark", "term"]).select("mark", F.lit(4).alias("kind"), "start", "end", "removed")
    # entities and terms in one row of places a text: what overlaps an entity goes, then what lies in a term before it
    entities = base.join(due.select("mark").distinct(), "mark", "left_semi").select("mark", "kind", "start", "end", F.lit(0).alias("removed")).distinct()
    along = Window.partitionBy("mark").orderBy("start", F.desc("end"), "kind")
    reached = F.max(F.when(F.col("kind") < 4, F.col("end"))).over(along.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(F.col("kind") < 4, F.col("start"))).over(along.rowsBetween(0, Window.unboundedFollowing))
    places = hits.unionByName(entities).withColumn("reached", reached).withColumn("ahead", ahead)
    clear = places.where((F.col("kind") == 4) & (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.coalesce("ahead", F.col("end")) >= F.col("end")))
    inside = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    return clear.withColumn("inside", inside).where(F.coalesce("inside", F.lit(0)) < F.col("end")).select(
        "mark", "start", "end", F.when(F.col("removed") == 1, "").otherwise("<TERM>").alias("tag"))


def spans(docs: DataFrame, alpha: float = 0.9, min_support: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, mark, kind, start, end, tag of every span, the method's included (kind 4)."""
    base = base_spans(docs, id_col, text_col)
    terms = disclosing_terms(docs, base, alpha, min_support, id_col, text_col)
    tags = F.element_at(F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS]), F.col("kind") + 1)
    own = base.select("id", "mark", "kind", "start", "end", tags.alias("tag"))
    extra = stage(_term_spans(docs, base, terms, id_col, text_col), "pii-extra")
    rows = _keyed(docs, id_col, text_col).select("id", "mark").join(extra.select("mark").distinct(), "mark", "left_semi").distinct()
    return stage(own.unionByName(rows.join(extra, "mark").select("id", "mark", F.lit(4).alias("kind"), "start", "end", "tag")), "pii-spans")


def _by_document(found: DataFrame) -> DataFrame:
    """Spans as one sorted array a document: as many as its text has."""
    return found.groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end", "tag"))).alias("_spans"))


def _with_spans(keyed: DataFrame, found: DataFrame) -> DataFrame:
    joined = keyed.join(_by_document(found), F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    return joined.withColumn("_spans", F.coalesce("_spans", F.array().cast(SPAN))).drop("_id", "_mark")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, n_term, base_sha256 and spans of every row."""
    found = spans(docs, id_col=id_col, text_col=text_col, **how)
    out = _with_spans(_keyed(docs, id_col, text_col).drop("text"), found)
    name = F.array(*[F.lit(k) for k in KINDS])
    text_of = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.transform("_spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    base = F.filter("_spans", lambda s: s["kind"] < 4)
    return out.select(F.col("id").alias(id_col), *counts, F.sha2(F.encode(text_of(base), "UTF-8"), 256).alias("base_sha256"),
                      text_of(F.col("_spans")).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the spans of their texts replaced by their tags (removed terms by nothing); null texts stay null."""
    found = spans(docs, id_col=id_col, text_col=text_col, **how)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = private(docs)
    mark, known, held, places = map(own, ("mark", "id", "held", "spans"))
    by_document = _by_document(found).select(F.col("_id").alias(known), F.col("_mark").alias(held), F.col("_spans").alias(places))
    joined = docs.withColumn(mark, F.xxhash64(text)).join(by_document, F.col(id_col).eqNullSafe(F.col(known)) & (F.col(mark) == F.col(held)), "left")
    # by start; of overlapping spans the text from the first's start to the last's end goes, once
    ordered = F.array_sort(F.transform(places, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["tag"].alias("tag"))))
    done = F.aggregate(ordered, F.struct(F.lit("").alias("text"), F.lit(0).alias("at")), lambda acc, s: F.when(
        s["end"] <= acc["at"], acc).otherwise(F.struct(
            F.concat(acc["text"], F.when(s["start"] >= acc["at"], F.concat(text.substr(acc["at"] + 1, s["start"] - acc["at"]), s["tag"])).otherwise(""))
            .alias("text"), s["end"].alias("at"))),
        lambda acc: F.concat(acc["text"], text.substr(acc["at"] + 1, F.length(text))))
    new = F.when(F.col(places).isNull(), F.col(text_col)).otherwise(done)
    return joined.withColumn(text_col, new).select(*docs.columns)


def q_op6(spark, sf_dir: str) -> DataFrame:
    """Contract query: personal data of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_pii(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term")
