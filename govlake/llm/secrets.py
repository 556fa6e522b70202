"""Secret scan with a random forest against false positives (operator 1).

1. One pass over all documents counts byte transitions and words: the
   transitions' log probabilities, and as dictionary the ``dictionary_size``
   most frequent words of 3 to 12 letters.
2. A second pass takes as candidates the values of assignments to a name that
   holds a word like ``password`` or ``token`` (a quoted value up to its closing
   quote), and all tokens of 12 characters or more but runs of one character
   (entropy 0), each with its features: length, character classes and transitions,
   entropy, dictionary coverage, path, and neighbouring words.
3. Labelled findings train a random forest (Spark ML): a column of known
   labels where the caller has them, else labels by provenance (see
   :func:`_label`).  It is fitted on at most ``sample`` findings of each class,
   those with the smallest hashes of the value, and then scores every
   candidate.

Cases: null and empty texts have no candidates.  Repeated rows give repeated
findings.  Null ids and paths are kept (no path: no path words).  An empty
table, or labels of a single class, give candidates without a forest: the score
is then the labels' own class, 0 without any.  Texts are scanned whole; a token
of more than ``LONGEST`` characters is one candidate with features of its whole
length.  Only ``id_col``, ``text_col`` and ``path_col`` are read, so other
columns may have any name.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import as_bytes
from .stage import stage

BATCH = 500
LONGEST = 4096

_NAMES = r"passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth"
_NAME = re.compile(rf"(?i:{_NAMES})")
#: A name that has the word as a part of its own (client_secret, dbPassword, tokens; not tokenizer, author).
_OWN_PART = re.compile(rf"(?:^|[^a-z])(?:{_NAMES})s?(?:$|[^a-z])")
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_KEY = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)[\"']?\s*+(?:=>|:=|=|:)\s*+")
_VALUE = re.compile(r"\"(?P<double>(?:[^\"\\\n]|\\.){6,}+)\"|'(?P<single>(?:[^'\\\n]|\\.){6,}+)'|[\"']?(?P<bare>[^\s\"'<>,;]{6,})")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
#: Formats that providers give their keys.
_ISSUED = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{35}")
_WORD = re.compile(r"[A-Za-z]+")
_HEX = re.compile(r"[0-9a-fA-F]+")
_NEAR_SECRET = frozenset("password passwd pwd secret token key apikey api auth credential credentials bearer login".split())
_NEAR_PUBLIC = frozenset("example sample dummy test placeholder fake checksum digest hash commit sha uuid id isbn doi".split())
_PATH_PUBLIC = frozenset("test tests example examples sample samples doc docs fixture fixtures mock mocks demo".split())

FEATURES = ("length", "digits", "uppers", "lowers", "others", "hex", "distinct", "entropy", "class_changes", "mean_transition", "worst_transition",
            "coverage", "after_assignment", "after_quote", "secret_word_near", "public_word_near", "in_address", "path_depth", "path_public")
_COVERAGE = FEATURES.index("coverage")
CANDIDATE = "id {kind}, start long, end long, value string, features array<double>, label int"


# ------------------------------------------------------------------ corpus statistics
def _count(batches):
    pairs = np.zeros(1 << 16, np.int64)
    words: Counter = Counter()

    def rows(counted: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())], ["key", "n"])

    for b in batches:
        for t in as_bytes(b.column("text")):
            raw = np.frombuffer(t, np.uint8).astype(np.int64)
            if len(raw) > 1:
                step = (raw[:-1] << 8) | raw[1:]
                if len(step) > 1 << 15:
                    pairs += np.bincount(step, minlength=1 << 16)
                else:
                    np.add.at(pairs, step, 1)
            words.update(w for w in t.decode("utf-8", "replace").lower().split() if 3 <= len(w) <= 12 and w.isalpha())
        if len(words) > 200_000:
            yield rows(words)
            words = Counter()
    at = np.flatnonzero(pairs)
    words.update({f" {p}": int(pairs[p]) for p in at.tolist()})  # no word begins with a space
    yield rows(words)


def corpus_statistics(texts: DataFrame, dictionary_size: int = 20_000) -> tuple[np.ndarray, frozenset]:
    """(log probability of each byte after each byte, dictionary): at most 65536 and ``dictionary_size`` rows come to the driver."""
    counts = texts.mapInArrow(_count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("key").startswith(" ") | (F.col("n") >= 3))
    counts = stage(counts, "secret-counts")
    pairs = np.ones((256, 256))
    for r in counts.where(F.col("key").startswith(" ")).toLocalIterator():
        pairs[divmod(int(r.key), 256)] += r.n
    top = counts.where(~F.col("key").startswith(" ")).orderBy(F.desc("n"), "key").limit(dictionary_size)
    return np.log(pairs / pairs.sum(axis=1, keepdims=True)), frozenset(r.key for r in top.collect())


# ------------------------------------------------------------------ candidates
def _coverage(value: str, dictionary: frozenset) -> float:
    """The share of characters in dictionary words, longest first from the left of each run of letters."""
    covered = 0
    for run in _WORD.findall(value.lower()):
        at = 0
        while at < len(run):
            n = next((n for n in range(min(12, len(run) - at), 2, -1) if run[at:at + n] in dictionary), 0)
            covered += n
            at += n or 1
    return covered / len(value)


def _classes(value: str) -> str:
    return "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value)


def _features(text: str, start: int, end: int, path: str, log_p: np.ndarray, dictionary: frozenset) -> list[float]:
    value = text[start:end]
    n = len(value)
    kinds = Counter(c := _classes(value))
    raw = np.frombuffer(value.encode(), np.uint8)
    steps = log_p[raw[:-1], raw[1:]] if len(raw) > 1 else np.zeros(1)
    share = np.array(list(Counter(value).values())) / n
    before = [w.lower() for w in _WORD.findall(text[max(0, start - 60):start])][-3:]
    after = [w.lower() for w in _WORD.findall(text[end:end + 60])][:3]
    near = {*before, *after}
    lead = text[max(0, start - 4):start].rstrip(" ")
    segments = [s for s in re.split(r"[/\\.]", path.lower()) if s]
    return [float(n), kinds["d"] / n, kinds["u"] / n, kinds["l"] / n, kinds["o"] / n, float(bool(_HEX.fullmatch(value))), len(share) / n,
            float(-(share * np.log2(share)).sum()), sum(a != b for a, b in zip(c, c[1:])) / n, float(steps.mean()), float(steps.min()),
            _coverage(value, dictionary), float(lead.rstrip("\"'")[-1:] in ("=", ":")), float(text[max(0, start - 1):start] in ("'", '"')),
            float(bool(near & _NEAR_SECRET)), float(bool(near & _NEAR_PUBLIC)),
            float("@" in text[max(0, start - 1):start] + text[end:end + 1] or "//" in text[max(0, start - 40):start].rsplit(" ", 1)[-1]),
            float(len(segments)), float(bool(_PATH_PUBLIC & set(segments)))]


def _label(text: str, start: int, end: int, assigned: bool, coverage: float) -> int | None:
    """What a finding's provenance says: 1 for issued key formats and assigned values with a digit, 0 for numbers,
    addresses and plain words; None if it says nothing."""
    value = text[start:end]
    if _ISSUED.fullmatch(value) or assigned and any(c.isdigit() for c in value) and len(value) >= 8:
        return 1
    if not any(c.isalpha() for c in value) or "@" in text[max(0, start - 1):start] + text[end:end + 1]:
        return 0
    if assigned and value.isalpha() or not assigned and coverage == 1:
        return 0
    return None


def _spans(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whether assigned to a name with a secret's word as a part of its own) of each candidate."""
    found: dict[tuple[int, int], bool] = {}
    until = 0
    for m in _KEY.finditer(text):
        if m.start() >= until and _NAME.search(m[1]) and (v := _VALUE.match(text, m.end())):
            s, until = v.span(v.lastgroup)
            found[s, until] = bool(_OWN_PART.search(_HUMP.sub("_", m[1]).lower()))
    taken = sorted(found)
    ends = [e for _, e in taken]
    for m in _TOKEN.finditer(text):
        s, e = m.span()
        k = bisect_left(ends, s + 1)  # the first value that ends after the token's start
        if (k == len(taken) or taken[k][0] >= e) and len(set(m.group())) > 1:
            found[s, e] = False
    return sorted((s, e, assigned) for (s, e), assigned in found.items())


def _scan(log_p: np.ndarray, dictionary: frozenset, kind):
    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            labels = b.column("known").to_pylist()
            for doc, text, path, known in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), b.column("path").to_pylist(), labels):
                for s, e, assigned in _spans(text or ""):
                    x = _features(text, s, e, path or "", log_p, dictionary)
                    label = known if known is not None else _label(text, s, e, assigned, x[_COVERAGE])
                    rows.append((doc, s, e, text[s:e], x, label))
            types = (b.schema.field("id").type, pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()), pa.int32())
            cols = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["id", "start", "end", "value", "features", "label"])

    return run


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", label_col: str | None = None,
               dictionary_size: int = 20_000) -> DataFrame:
    """id, start, end (code points), value, features and label of every candidate; written in the shared folder.

    ``label_col``: a column that labels a row's findings (1 secret, 0 not), for rows that are labelled findings.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    kind = docs.select(id_col).dtypes[0][1]
    kind = "long" if kind == "void" else kind
    rows = docs.select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).cast("string").alias("text"),
                       (F.col(path_col) if path_col else F.lit(None)).cast("string").alias("path"),
                       (F.col(label_col) if label_col else F.lit(None)).cast("int").alias("known"))
    log_p, dictionary = corpus_statistics(rows.select("text"), dictionary_size)
    return stage(rows.mapInArrow(_scan(log_p, dictionary, kind), CANDIDATE.format(kind=kind)), "secret-candidates")


# ------------------------------------------------------------------ the forest
def train(findings: DataFrame, sample: int = 5_000, trees: int = 30, depth: int = 8, seed: int = 7):
    """A random forest on at most ``sample`` labelled findings of each class; None if a class is missing."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    known = findings.where(F.col("label").isNotNull()).select("value", "features", "label").dropDuplicates(["value"]).withColumn("h", F.xxhash64("value"))
    parts = [known.where(F.col("label") == k).orderBy("h", "value").limit(sample) for k in (0, 1)]
    rows = stage(parts[0].unionByName(parts[1]).select(array_to_vector("features").alias("x"), F.col("label").cast("double").alias("y")), "secret-training")
    if rows.select("y").distinct().count() < 2:
        return None
    # one partition of at most 2 * sample rows: the same rows give the same forest
    return RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed).fit(rows.coalesce(1))


def score(found: DataFrame, model) -> DataFrame:
    """``found`` plus score, the forest's probability of a secret, and is_secret."""
    if model is None:
        scored = found.withColumn("score", F.coalesce(F.col("label").cast("double"), F.lit(0.0)))
    else:
        from pyspark.ml.functions import array_to_vector, vector_to_array

        out = model.transform(found.withColumn("x", array_to_vector("features")))
        scored = out.withColumn("score", F.element_at(vector_to_array("probability"), 2)).select(*found.columns, "score")
    return scored.withColumn("is_secret", F.col("score") >= 0.5)


def scan(docs: DataFrame, labelled: DataFrame | None = None, sample: int = 5_000, id_col: str = "doc_id", text_col: str = "text",
         path_col: str | None = "source", label_col: str = "label", dictionary_size: int = 20_000) -> DataFrame:
    """Every candidate of ``docs`` with its score; ``labelled`` (rows of the same shape with ``label_col``) trains the forest where it is given."""
    found = candidates(docs, id_col, text_col, path_col, None, dictionary_size)
    lessons = found if labelled is None else candidates(labelled, id_col, text_col, path_col, label_col, dictionary_size)
    return score(found, train(lessons, sample)).withColumnRenamed("id", id_col)


def q_op1(spark, sf_dir: str) -> DataFrame:
    """Every candidate of all documents, with its score."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), F.round("score", 6).alias("score"), "is_secret")
