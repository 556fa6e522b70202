"""Scalar column transforms (no aggregation, no shuffle).

Each function returns a ``Column`` built from built-in Spark functions so
that it compiles into whole-stage codegen; none uses a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- fixed values ---------------------------------------------------------
# They must equal the source system's for matching results.
ZERO_GUID = "00000000-0000-0000-0000-000000000000"
EMPTY_END_DATE = "0001-01-01"
# Item type -> URL path segment of the item page.
ITEM_URL_PATHS = {
    "Report": "reports",
    "SemanticModel": "datasets",
    "Dataflow": "dataflows-gen2",
    "Lakehouse": "lakehouses",
    "Warehouse": "warehouses",
    "SQLEndpoint": "mirroredwarehouses",
    "DataPipeline": "pipelines",
}
ITEM_URL_BASE = "https://app.powerbi.com/groups/"
REPORT_URL_BASE = "https://app.powerbi.com/groups/me/reports/"
# Size and time units (unit name -> divisor).
SIZE_UNITS = {"bytes": 1, "kilobytes": 1024, "megabytes": 1048576, "gigabytes": 1073741824}
TIME_UNITS = {"milliseconds": 1, "seconds": 1000, "minutes": 60000, "hours": 3600000}
# Windows-1252 characters for bytes 0x80-0x9F (undefined bytes map to themselves).
CP1252_HIGH = ("€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f"
               "\x90‘’“”•–—˜™š›œ\x9džŸ")
# --------------------------------------------------------------------------


def date_parts(ts, prefix: str = "Creation") -> dict[str, Column]:
    """Date parts of an ISO timestamp (text or timestamp).

    ``<prefix>Date`` (date of the first 10 characters), ``<prefix>DateKey``
    (``yyyyMMdd`` text), ``<prefix>Hour`` (``H``) and ``<prefix>Minute`` (``mm``).
    """
    t = _c(ts)
    return {
        f"{prefix}Date": F.to_date(t.cast("string").substr(1, 10), "yyyy-MM-dd"),
        f"{prefix}DateKey": F.date_format(t, "yyyyMMdd"),
        f"{prefix}Hour": F.date_format(t, "H"),
        f"{prefix}Minute": F.date_format(t, "mm"),
    }


def date_slice(ts) -> Column:
    """The date of the first ten characters of an ISO text timestamp."""
    return F.to_date(_c(ts).cast("string").substr(1, 10))


def duration_s(start, end) -> Column:
    """Whole seconds between two timestamps (end - start)."""
    return F.unix_timestamp(_c(end).cast("timestamp")) - F.unix_timestamp(_c(start).cast("timestamp"))


def activity_status(result_status="ResultStatus", is_success="IsSuccess") -> Column:
    """Failed / InProgress / Succeeded from the status text, else Succeeded when
    the success flag is 1, else 'N/A'."""
    rs, ok = _c(result_status), _c(is_success)
    return (F.when(rs == "Failed", "Failed")
            .when(rs == "InProgress", "InProgress")
            .when(rs == "Succeeded", "Succeeded")
            .when(ok.cast("int") == 1, "Succeeded")
            .otherwise("N/A"))


def yn_status(flag) -> Column:
    """'Y' -> Success, 'N' -> Error, anything else -> 'N/A'."""
    f = _c(flag)
    return F.when(f == "Y", "Success").when(f == "N", "Error").otherwise("N/A")


def item_key(artifact_id="ArtifactId", object_id="ObjectId") -> Column:
    """First non-null upper-cased id."""
    return F.coalesce(F.upper(_c(artifact_id)), F.upper(_c(object_id)))


def item_kind(object_type="ObjectType", artifact_kind="ArtifactKind") -> Column:
    return F.coalesce(_c(object_type), _c(artifact_kind))


def sha_key(*cols) -> Column:
    """Surrogate key: SHA-256 hex of the parts joined by '-'."""
    return F.sha2(F.concat_ws("-", *[_c(c).cast("string") for c in cols]), 256)


def text_key(cols, sep: str = "") -> Column:
    """Composite text key; null parts are skipped."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def time_bin(ts, minutes: int) -> Column:
    """Floor a timestamp to a bin of ``minutes``; null stays null."""
    secs = minutes * 60
    t = _c(ts).cast("timestamp")
    return F.timestamp_seconds(F.floor(F.unix_timestamp(t) / secs) * secs)


def sum_bracket_list(text) -> Column:
    """Sum of the comma-separated numbers between the first '[' and ']'."""
    inner = F.regexp_extract(_c(text), r"\[([^\]]*)\]", 1)
    parts = F.filter(F.split(inner, ","), lambda x: F.trim(x) != "")
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + F.trim(x).cast("double"))


def between(text, left: str, right: str, from_end: bool = False) -> Column:
    """Text between the first (or last) ``left`` and the next ``right``;
    empty text when the delimiters are absent."""
    t = _c(text)
    if from_end:
        start = F.length(t) - F.locate(left[::-1], F.reverse(t)) + 2
        found = F.locate(left[::-1], F.reverse(t)) > 0
    else:
        start = F.locate(left, t) + len(left)
        found = F.locate(left, t) > 0
    tail = F.substr(t, start)
    stop = F.locate(right, tail)
    return F.when(found & (stop > 0), F.substr(tail, F.lit(1), stop - 1)).otherwise(F.lit(""))


def first_nonempty(*cols) -> Column:
    """First argument that is neither null nor empty text."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def decode_b64_text(col) -> Column:
    """Base64 text decoded as Windows-1252, line breaks replaced by a space."""
    latin = F.decode(F.unbase64(_c(col)), "ISO-8859-1")
    cp = F.translate(latin, "".join(chr(b) for b in range(0x80, 0xA0)), CP1252_HIGH)
    return F.regexp_replace(cp, r"\r\n|\r|\n", " ")


def io_rate(nbytes, ms) -> Column:
    """Bytes per second; null when the duration is 0 or null."""
    return F.try_divide(_c(nbytes).cast("double"), F.when(_c(ms) != 0, _c(ms) / 1000.0))


def to_unit(col, unit: str, kind: str = "size") -> Column:
    """Scale a byte or millisecond value to ``unit`` (see SIZE_UNITS/TIME_UNITS)."""
    table = SIZE_UNITS if kind == "size" else TIME_UNITS
    return _c(col).cast("double") / F.lit(float(table[unit]))


def item_url(workspace_id, item_id, item_type) -> Column:
    """Item page URL: known types map to a path segment, others fall back to
    the workspace page; semantic models get '/details'."""
    ws, it, ty = _c(workspace_id), _c(item_id), _c(item_type)
    seg = F.lit(None).cast("string")
    for k, v in ITEM_URL_PATHS.items():
        seg = F.when(ty == k, F.lit(v)).otherwise(seg)
    known = F.concat(F.lit(ITEM_URL_BASE), F.lower(ws), F.lit("/"), seg, F.lit("/"), F.lower(it))
    fallback = F.concat(F.lit(ITEM_URL_BASE), ws)
    url = F.coalesce(known, fallback)
    return F.when(ty == "SemanticModel", F.concat(url, F.lit("/details"))).otherwise(url)


def extract(pattern: str, group: int, col) -> Column:
    """One regex group; null when the pattern does not match (KQL ``extract``)."""
    v = F.regexp_extract(_c(col), pattern, group)
    return F.when(_c(col).rlike(pattern), v)


def extract_all(pattern: str, col, group: int = 1) -> Column:
    """All matches of one group, as an array (KQL ``extract_all``)."""
    return F.regexp_extract_all(_c(col), F.lit(pattern), group)


def xml_fields(col, names: list[str]) -> Column:
    """Child-element texts of an XML document as a struct, parsed once per
    row (``from_xml``) - for several fields this is far cheaper than one
    ``xpath_string`` per field.  Absent elements are null."""
    schema = ", ".join(f"`{n}` string" for n in names)
    return F.from_xml(_c(col), schema)


def xml_field(col, path: str) -> Column:
    """Text of an XML element, e.g. ``Object/Database``; null when absent."""
    return F.nullif(F.xpath_string(_c(col), F.lit(path if path.startswith("/") else "/" + path)), F.lit(""))


def json_text_field(col, outer: str, inner: str, index: int = 0) -> Column:
    """``parse(parse(col).outer)[index].inner`` where ``outer`` is itself JSON text."""
    nested = F.get_json_object(_c(col), f"$.{outer}")
    return F.get_json_object(nested, f"$[{index}].{inner}")


def anonymise_when(col, condition: Column) -> Column:
    """md5 of the value where ``condition`` holds, the value otherwise."""
    return F.when(condition, F.md5(_c(col).cast("string"))).otherwise(_c(col))


def decode_flag(col, true_label: str, false_label: str) -> Column:
    """Boolean/0-1 flag to one of two labels."""
    c = _c(col)
    return F.when(c.cast("boolean"), F.lit(true_label)).when(c.isNotNull(), F.lit(false_label))


def encoding_verdict(hint, actual) -> Column:
    """Encoding hint check: null when the hint is Default, Accepted when the
    hint equals the actual encoding, otherwise Not Accepted."""
    h, a = _c(hint), _c(actual)
    return (F.when(h.isNull() | (h == "Default"), F.lit(None).cast("string"))
            .when(h == a, "Accepted").otherwise("Not Accepted"))


def coalesce_blank(*cols) -> Column:
    return reduce(lambda a, b: F.coalesce(a, b), [_c(c) for c in cols])


def coalesce_name(explicit="ExplicitName", inferred="InferredName") -> Column:
    """The explicit name, else the inferred one."""
    return F.coalesce(F.nullif(_c(explicit), F.lit("")), _c(inferred))


def replace_null(col, value) -> Column:
    """A null replaced by a constant or by another column expression
    (e.g. ``when(expr.contains(...), 'x').otherwise('0')``)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.coalesce(_c(col), v)


def label_flags(spec: dict[str, tuple]) -> dict[str, Column]:
    """Flag-to-label columns; ``spec`` maps an output name to
    ``(flag column, true label, false label)``."""
    return {name: decode_flag(c, t, f) for name, (c, t, f) in spec.items()}
