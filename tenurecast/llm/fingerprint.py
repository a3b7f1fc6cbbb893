"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line) is hashed to a wide vector: ``LANES`` signed counts of its three-word
shingles modulo 2**32 (no text has so many words that they wrap), and ``CHECKS`` hashes of the whole line modulo 2**64. A text's
fingerprint is the sum over its paragraphs, so their order does not matter, and paragraphs
are inserted or deleted by adding or subtracting their vectors. Two texts of equal
paragraphs have equal fingerprints; the likeness of two fingerprints is the cosine of the
counts (1 for equal fingerprints, about 0 for unrelated texts).

Null text counts as empty (one empty paragraph). Rows with the same id are neighbours in
the order of their texts' hashes. A single document is its own next document. A null id
comes after all others. An empty table gives no rows. Very long texts are taken whole, in
batches by their bytes. Other columns of the input are not read, so their names are free.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurecast.llm.common import CHUNK_BYTES, mix, shingles, span_hashes, table, text_buffer, words

LANES, CHECKS = 256, 4


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts modulo 2**32, line hashes modulo 2**64) of each text, one row each."""
    data, offsets = text_buffer(pa.array(texts, pa.large_string()))
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    # Every text has one paragraph more than line breaks.
    per_text = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    owner = np.repeat(np.arange(len(texts)), per_text)
    lines = span_hashes(data, starts, ends)
    checks = np.zeros((CHECKS, len(texts)), np.uint64)
    for k in range(CHECKS):
        np.add.at(checks[k], owner, mix(lines + np.uint64(k + 1)))
    doc, _, _, hashes = words(data, np.append(starts, len(data)), lower=False)
    line, found = shingles(doc, hashes, len(starts), 3)
    place = owner[line] * LANES + (found % np.uint64(LANES)).astype(np.int64)
    sign = np.where((found >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    counts = np.bincount(place, weights=sign, minlength=len(texts) * LANES).reshape(-1, LANES)
    return counts.astype(np.int64).astype(np.uint32), checks.T.copy()


def add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint of both texts' paragraphs together."""
    return a[0] + b[0], a[1] + b[1]


def remove(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint of ``a`` without the paragraphs of ``b``."""
    return a[0] - b[0], a[1] - b[1]


def written(counts: np.ndarray, checks: np.ndarray) -> str:
    return counts.astype("<u4").tobytes().hex() + checks.astype("<u8").tobytes().hex()


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]):
        return 1.0
    x, y = (v[0].astype(np.int32).astype(float) for v in (a, b))
    size = np.sqrt((x @ x) * (y @ y))
    return float(min(max(x @ y / size, 0.0), 1.0)) if size else 0.0


def edited(text: str, following: str) -> str:
    """The last half replaced by as many code points of the next text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come bucket by bucket, residents in order, then the first of the next bucket."""
    rows: list[tuple] = []  # (bucket, guest, doc_id, text)

    def done(group: list[tuple]) -> pa.RecordBatch:
        texts = [r[3] for r in group]
        pairs = [i for i in range(len(group) - 1) if not group[i][1] and group[i][0] == group[i + 1][0]]
        new = [edited(texts[i], texts[i + 1]) for i in pairs]
        counts, checks = vectors(texts)
        new_counts, new_checks = vectors(new) if new else (counts[:0], checks[:0])
        own = [(counts[i], checks[i]) for i in range(len(group))]
        out = [
            (
                group[i][2],
                len(texts[i]),
                hashlib.sha256(new[k].encode()).hexdigest(),
                written(*own[i]),
                written(new_counts[k], new_checks[k]),
                likeness(own[i], (new_counts[k], new_checks[k])),
                likeness(own[i], own[i + 1]),
            )
            for k, i in enumerate(pairs)
        ]
        return pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r, strict=True)) for r in out], schema=_SCHEMA)

    size = 0
    for batch in batches:
        columns = [batch.column(c) for c in ("bucket", "guest", "doc_id", "text")]
        for at in range(batch.num_rows):
            row = tuple(c[at].as_py() for c in columns)
            rows.append(row)
            size += len(row[3])
            if size > CHUNK_BYTES // 4 and len(rows) > 1:
                yield done(rows)
                rows, size = rows[-1:], len(row[3])
    if len(rows) > 1:
        yield done(rows)


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, with both likenesses.

    Ids are cut into ranges, one per task; the texts are shuffled once. Only the first text
    of a range is sent twice: also to the range before, where it is the last one's next. The
    driver holds one cut and one first id per shuffle partition, nothing per document.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    docs = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(key).cast("long"), F.lit(least)).alias("place"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    cuts = np.array(sorted({int(x) for x in docs.approxQuantile("place", [k / parts for k in range(1, parts)], 0.2 / parts)}), np.int64)

    @F.pandas_udf("int")
    def bucket_of(place: pd.Series) -> pd.Series:
        # Bucket 0 has the largest ids.
        return pd.Series((len(cuts) - np.searchsorted(cuts, place.to_numpy())).astype(np.int32))

    found = docs.select("place").withColumn("bucket", bucket_of("place")).groupBy("bucket").agg(F.max("place").alias("head"))
    heads = sorted((r["bucket"], r["head"]) for r in found.collect())
    # The first id of each range that holds a row, from the least, and the range before it (the first follows the last).
    firsts = np.array([h for _, h in heads][::-1], np.int64)
    before = np.array([heads[k - 1][0] for k in range(len(heads))][::-1], np.int32)

    @F.pandas_udf("array<int>")
    def homes_of(place: pd.Series) -> pd.Series:
        """The row's own range, then the one where it is only the last one's next."""
        values = place.to_numpy()
        own = len(cuts) - np.searchsorted(cuts, values)
        at = np.minimum(np.searchsorted(firsts, values), max(len(firsts) - 1, 0))
        return pd.Series([[int(o), int(before[i])] if firsts[i] == v else [int(o)] for o, i, v in zip(own, at, values, strict=True)])

    sent = docs.select("doc_id", "place", "text", F.posexplode(homes_of("place")).alias("guest", "bucket"))
    placed = sent.withColumn("guest", F.col("guest") > 0).repartitionById(len(cuts) + 1, F.col("bucket"))
    ordered = placed.sortWithinPartitions("bucket", "guest", F.desc("place"), F.xxhash64("text"))
    return ordered.select("bucket", "guest", "doc_id", "text").mapInArrow(
        _compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
