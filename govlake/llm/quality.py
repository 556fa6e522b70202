"""Host-level quality rules (operator 5), with DataFrame functions only.

A document is measured once: words, their characters, symbols, repeated lines
and words in repeated windows.  From these it fails the base rule, strict
rules and lenient rules (see :data:`STRICT` and :data:`LENIENT`).  Then:

1. failures of the lenient rules are summed up by host;
2. the hosts' failure rates give a beta prior by the method of moments, each
   host weighted by its documents, and every host's rate is shrunk towards
   the prior's mean;
3. a host whose shrunk rate is above ``host_limit`` is suspect; the verdict is
   joined back to the documents.

A document is kept if it passes the base rule and the strict rules and, where
its host is suspect, also the lenient ones.  So a clean document is kept on any
host, and a borderline one only on a sound host.

Cases: a null or empty text has no words and fails the base rule.  A null host
is a host of its own.  Repeated rows count as often as they occur.  Without
documents there are no verdicts.  The prior needs two hosts that differ;
otherwise hosts are shrunk to the mean with weight ``least_prior``.  An extra
column with the name of an output is replaced by that output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import private, stage
from .words import with_runs, words

WIDTH = 8
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: rule -> SQL condition of failure.  Conditions are in whole numbers, so that they hold exactly.
BASE = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"
STRICT = {
    "symbols": "100 * n_symbols > 20 * n_words",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
}
LENIENT = {
    "base": BASE,
    "symbols": "100 * n_symbols > 5 * n_words",
    "word_length": "10 * word_chars < 35 * n_words OR word_chars > 8 * n_words",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "lines": "n_dup_lines >= 5 AND 100 * n_dup_lines > 10 * n_words",
}


def _any(rules: dict[str, str]) -> Column:
    return F.expr(" OR ".join(f"({r})" for r in rules.values()))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus :data:`MEASURES`; the text is split into words once."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.drop(*[c for c in MEASURES if c in docs.columns and c != text_col])
    own = private(base)
    w, lines, h = map(own, ("w", "lines", "h"))
    marked = text
    for symbol in SYMBOLS:
        marked = F.replace(marked, F.lit(symbol), F.lit(""))
    df = base.withColumn(w, words(text)).withColumn(lines, F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = with_runs(df, w, h, WIDTH)
    df = df.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(marked)).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_cover_size(h)).cast("long"),
    })
    return df.drop(w, lines, h)


def _cover_size(hashes: str) -> Column:
    """How many words the windows that occur twice or more cover."""
    starts = _repeated_starts(hashes)
    # sorted starts: each adds the words up to the next start, WIDTH at most
    return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-WIDTH).alias("end")),
                       lambda acc, s: F.struct((acc["n"] + F.lit(WIDTH) - F.greatest(F.lit(0), acc["end"] - s)).alias("n"), (s + WIDTH).alias("end")),
                       lambda acc: acc["n"])


def _repeated_starts(hashes: str) -> Column:
    """The places, in order, of the hashes that occur twice or more: neighbours after sorting by hash."""
    placed = F.array_sort(F.transform(F.col(hashes), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    # each sorted place beside the one before and the one after
    n = F.size(F.col(hashes))
    first = F.concat(F.array(F.lit(None).cast(_PLACE)), F.slice(placed, F.lit(1), F.greatest(n - 1, F.lit(0))))
    after = F.concat(F.slice(placed, F.lit(2), F.greatest(n - 1, F.lit(0))), F.array(F.lit(None).cast(_PLACE)))
    with_before = F.zip_with(placed, first, lambda x, b: F.struct(x["h"].alias("h"), x["i"].alias("i"), b["h"].alias("b")))
    around = F.zip_with(with_before, after, lambda x, a: F.struct(
        x["i"].alias("i"), (x["h"].eqNullSafe(x["b"]) | x["h"].eqNullSafe(a["h"])).alias("twice")))
    return F.array_sort(F.transform(F.filter(around, lambda x: x["twice"]), lambda x: x["i"]))


_PLACE = "struct<h: bigint, i: int>"


def host_rates(measured: DataFrame, host: str, least_prior: float = 2.0) -> DataFrame:
    """(host, n, failed, rate): the rate of lenient failures, shrunk by a beta prior fitted to all hosts."""
    by_host = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_any(LENIENT).cast("long")).alias("failed"))
    moments = by_host.agg(
        F.sum("n").alias("all_n"), F.sum("failed").alias("all_failed"), F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("failed").cast("double") * F.col("failed") / F.col("n")).alias("second"))
    p = F.col("all_failed") / F.col("all_n")
    # variance of the rates between hosts beyond that of drawing n documents each
    between = (F.col("second") - F.col("all_n") * p * p) / F.col("all_n")
    drawn = p * (1 - p) * F.col("hosts") / F.col("all_n")
    strength = F.when((between > drawn) & (p > 0) & (p < 1), p * (1 - p) / (between - drawn) - 1)
    prior = moments.select(p.alias("mean"), F.greatest(F.coalesce(strength, F.lit(least_prior)), F.lit(least_prior)).alias("weight")).first()
    mean, weight = F.lit(prior["mean"]), F.lit(prior["weight"])  # two numbers
    return by_host.select("host", "n", "failed", ((F.col("failed") + weight * mean) / (F.col("n") + weight)).alias("rate"))


def verdicts(measured: DataFrame, host: str, host_limit: float = 0.5) -> DataFrame:
    """``measured`` (a table with the measures and the host) plus base_failed, host_rate, host_suspect and kept."""
    known = private(measured)("host")
    rates = stage(host_rates(measured, host).select(F.col("host").alias(known), F.col("rate").alias("host_rate")), "quality-hosts")
    # the documents' side is a plain scan, so adaptive execution can split a hot host where the hosts aren't broadcast
    joined = measured.join(rates, F.col(host).eqNullSafe(F.col(known)), "left").drop(known)
    return joined.withColumns({"base_failed": F.expr(BASE), "host_suspect": F.col("host_rate") > host_limit}).withColumn(
        "kept", ~F.col("base_failed") & ~_any(STRICT) & ~(F.col("host_suspect") & _any(LENIENT)))


def apply_rules(docs: DataFrame, host: str = "source", text_col: str = "text", host_limit: float = 0.5) -> DataFrame:
    """``docs`` plus the measures, base_failed, host_rate, host_suspect and kept; written once in the shared folder."""
    keep = [c for c in docs.columns if c not in ("base_failed", "host_rate", "host_suspect", "kept")]
    return verdicts(stage(measure(docs.select(*keep), text_col), "quality-measured"), host, host_limit)


def q_op5(spark, sf_dir: str) -> DataFrame:
    """Contract query: measures and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    narrow = stage(measure(docs).select("doc_id", "source", *MEASURES), "quality-measured")
    return verdicts(narrow, "source").select("doc_id", *MEASURES, "base_failed", "kept")


#: The same by definition.
SQL_OP5 = rf"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
x AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS s FROM g),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM x),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM d WHERE c > 1) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
m AS (
  SELECT w.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
f AS (SELECT *, {BASE} AS base_failed, {" OR ".join(f"({x})" for x in STRICT.values())} AS strict,
    {" OR ".join(f"({x})" for x in LENIENT.values())} AS lenient FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (lenient) AS k FROM f GROUP BY source),
a AS (SELECT sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, count(*)::DOUBLE AS hosts, sum(k::DOUBLE * k / n) AS second FROM h),
p AS (SELECT k / n AS mean, (second - n * (k / n) * (k / n)) / n AS between_hosts, (k / n) * (1 - k / n) * hosts / n AS drawn FROM a),
q AS (SELECT mean, greatest(CASE WHEN between_hosts > drawn AND mean > 0 AND mean < 1 THEN mean * (1 - mean) / (between_hosts - drawn) - 1
    ELSE 2.0 END, 2.0) AS weight FROM p),
v AS (SELECT source, (k + weight * mean) / (n + weight) > 0.5 AS suspect FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT strict AND NOT (suspect AND lenient) AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
