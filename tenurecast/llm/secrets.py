"""Secret scans with multipart credential linking, in Spark expressions only.

Base findings stand by themselves. Weak candidates (short access identifiers, named
identifiers, bare 40-character values, endpoints) are reported only where a complementary
part lies within ``REACH`` code points: an identifier beside a secret, a secret beside an
identifier, an endpoint beside a base finding or a weak part that is itself linked. The parts of a text are
joined as intervals by two running windows over their places, the nearest before and the
nearest after, so a text with many parts lists no pairs.

Spans are code points, ends exclusive. Null and empty texts have none. Rows are told apart
by their place in the scan, so repeated rows and repeated ids are scanned one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenurecast.llm.common import table
from tenurecast.llm.quality import let

#: Code points between two parts that belong together, at most.
REACH = 200
_BLOCK = 64

# The base patterns. A longer hex or access run is matched whole, so the
# least length can stand in the pattern; the value of an assignment is measured afterwards.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE = 8
# Weak candidates.
SHORT_ACCESS = r"\bAKIA[A-Z0-9]{4,11}(?![A-Z0-9])"
NAMED_ID = r"""\b(?i:access|client|account)[_-]?(?i:key[_-]?)?(?i:id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_-]{4,}"""
BARE_VALUE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""https?://[^\x00-\x20"'<>]+"""

KINDS = ("assign", "access", "hex", "access_id", "named_id", "value", "endpoint")
BASE = KINDS[:3]
_ROLE = {"assign": "secret", "hex": "secret", "value": "secret", "access": "id", "access_id": "id", "named_id": "id", "endpoint": "endpoint"}


def running_total(lengths: Column) -> Column:
    """Inclusive running sums of an array, block by block so that the work stays near linear."""

    def sums(values: Column, start: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            return F.concat(acc, F.array(F.element_at(acc, -1) + x))

        return F.aggregate(values, F.array(start), add)

    def over(x: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / _BLOCK).cast("int"))
        part = lambda b: F.slice(x, b * _BLOCK + 1, _BLOCK)
        whole = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0).cast("long"), lambda s, v: s + v))
        return let(
            sums(whole, F.lit(0).cast("long")),
            lambda begin: F.flatten(F.transform(blocks, lambda b: F.slice(sums(part(b), F.get(begin, b)), 2, _BLOCK))),
        )

    return F.when(F.size(lengths) > 0, let(lengths, over)).otherwise(F.array().cast("array<bigint>"))


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))


_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def found(text: Column, kind: str, pattern: str, least_value: int = 0) -> Column:
    """All leftmost matches as spans: their lengths and those of the gaps give the places."""
    regex = F.lit(pattern)

    def places(m: Column) -> Column:
        def from_gaps(gaps: Column) -> Column:
            lengths = F.transform(m, lambda x, i: (F.length(F.get(gaps, i)) + F.length(x)).cast("long"))
            return let(
                running_total(lengths),
                lambda ends: F.transform(m, lambda x, i: _span(kind, F.get(ends, i) - F.length(x), F.get(ends, i))),
            )

        return let(F.split(text, pattern, -1), from_gaps)

    spans = let(F.regexp_extract_all(text, regex, 0), places)
    if least_value:
        values = F.regexp_extract_all(text, regex, 2)
        spans = let(values, lambda v: F.filter(spans, lambda s, i: F.length(F.get(v, i)) >= least_value))
    return F.when(text.rlike(pattern), spans.cast(_SPANS)).otherwise(F.array().cast(_SPANS))


def candidates(text: Column) -> Column:
    """Base and weak spans of one text, in one array."""
    none = F.array().cast(_SPANS)
    base = F.concat(found(text, "assign", ASSIGN, ASSIGN_VALUE), found(text, "access", ACCESS), found(text, "hex", HEX))
    ids = F.concat(found(text, "access_id", SHORT_ACCESS), found(text, "named_id", NAMED_ID))

    def with_weak(parts: Column) -> Column:
        any_id = F.exists(parts, lambda s: s["kind"].isin(*[KINDS.index(k) for k in KINDS if _ROLE[k] == "id"]))
        value = F.when(any_id, found(text, "value", BARE_VALUE)).otherwise(none)
        endpoint = F.when(F.size(parts) > 0, found(text, "endpoint", ENDPOINT)).otherwise(none)
        return F.concat(parts, value, endpoint)

    return let(F.concat(base, ids), with_weak)


def scan(docs: DataFrame, text: str = "text", kept: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: the struct ``row`` (all columns, or those of ``kept``) and
    the reported ``spans`` in order.

    The row travels with the first of its parts, so it is shuffled once at most.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in kept or docs.columns]).alias("row")
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), whole, candidates(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("parts"))
    parts = rows.select("uid", "row", F.posexplode_outer("parts").alias("at", "part"))
    parts = parts.select(
        "uid",
        F.when(F.coalesce("at", F.lit(0)) == 0, F.col("row")).alias("row"),
        "part",
        F.col("part.start").alias("start"),
        F.col("part.end").alias("end"),
        F.col("part.kind").alias("kind"),
    )
    before = Window.partitionBy("uid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("uid").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)

    is_kind = lambda *ks: F.col("kind").isin(*[KINDS.index(k) for k in ks])

    def near(mine: Column) -> Column:
        last = F.max(F.when(mine, F.col("end"))).over(before)
        following = F.min(F.when(mine, F.col("start"))).over(after)
        return F.coalesce(F.col("start") - last <= REACH, F.lit(False)) | F.coalesce(following - F.col("end") <= REACH, F.lit(False))

    role = lambda r: is_kind(*[k for k in KINDS if _ROLE[k] == r])
    linked = parts.withColumns({"by_id": near(role("id")), "by_secret": near(role("secret"))})
    sure = is_kind(*BASE) | (is_kind("access_id", "named_id") & F.col("by_secret")) | (is_kind("value") & F.col("by_id"))
    linked = linked.withColumn("sure", sure)
    linked = linked.withColumn("by_sure", near(F.col("sure")))
    reported = F.col("sure") | (is_kind("endpoint") & F.col("by_sure"))
    spans = F.sort_array(F.collect_list(F.when(reported, F.col("part"))))
    return linked.groupBy("uid").agg(F.max_by("row", F.col("row").isNotNull()).alias("row"), spans.alias("spans")).drop("uid")


def written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    each = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(each, ",")


def _merged(spans: Column) -> Column:
    """Spans in order with overlapping ones joined."""

    def add(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        longer = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        size = F.size(acc)
        return F.when((size > 0) & (s["start"] < last["end"]), F.concat(F.slice(acc, 1, size - 1), F.array(longer))).otherwise(
            F.concat(acc, F.array(s))
        )

    # element_at fails on an empty array, so the first span starts the fold.
    folded = F.aggregate(F.slice(spans, 2, F.size(spans)), F.slice(spans, 1, 1).cast(_SPANS), lambda acc, s: add(acc, s).cast(_SPANS))
    return F.when(F.size(spans) > 0, folded).otherwise(spans)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every reported span replaced by its kind in square brackets."""
    names = F.array(*[F.lit(k.upper()) for k in KINDS])
    body = F.col("row")[text]

    def cleaned(spans: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            begin = F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(F.lit(0)).cast("int")
            kept = F.substring(body, begin + 1, s["start"].cast("int") - begin)
            return F.concat(kept, F.lit("["), F.get(names, s["kind"]), F.lit("]"))

        tail = F.substring(body, F.element_at(spans, -1)["end"].cast("int") + 1, F.length(body))
        return F.concat(F.array_join(F.transform(spans, piece), ""), tail)

    done = F.when(F.size("spans") > 0, let(_merged(F.col("spans")), cleaned)).otherwise(body)
    marked = scan(docs, text)
    return marked.select(*[(done if c == text else F.col("row")[c]).alias(c) for c in docs.columns])


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan(table(spark, sf_dir, "documents"), kept=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return scanned.select(
        F.col("row.doc_id").alias("doc_id"),
        *[count(k) for k in BASE],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
