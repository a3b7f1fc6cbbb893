"""Shared pieces: tables, Arrow text buffers, word hashes, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurecast.session import staged

#: Bytes of text that a task turns into arrays at once (a longer text is handled alone).
CHUNK_BYTES = 2 << 20

# The white space of the word pattern [^\x20\x09-\x0D]+.
SPACES = b" \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, parts: int) -> Column:
    """crc32 of the key written as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts))


# ---- Arrow text ------------------------------------------------------------


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offsets between them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with up to ``limit`` bytes of text, one row at least."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(text))
        start, rows = 0, len(offsets) - 1
        while start < rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), rows)
            part = offsets[start : end + 1]
            yield batch.slice(start, end - start), data[part[0] : part[-1]], part - part[0]
            start = end


# ---- hashes ----------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257))


def _power(which: int, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), (_BASE, _INVERSE)[which], np.uint64)
        steps[0] = 1
        np.multiply.accumulate(steps, out=steps)
        if n > 4 * CHUNK_BYTES:  # a very long text: not kept
            return steps
        _powers[which] = steps
    return _powers[which]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """(document, start byte, end byte, hash) of every word, in order.

    The hash is a polynomial in the word's bytes, from differences of one running sum.
    """
    if lower:
        data = _LOWER[data]
    solid = ~_SPACE[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = solid[edges]
    closes[edges - 1] = solid[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    return doc, starts, ends, span_hashes(data, starts, ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span, whatever its place."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _power(0, len(data))[: len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * _power(1, len(data) + 1)[starts]
    return mix(value ^ (ends - starts).astype(np.uint64))


def shingles(doc: np.ndarray, hashes: np.ndarray, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every window of ``width`` words; fewer words count as one window."""
    n = len(doc)
    count = np.bincount(doc, minlength=rows) if n else np.zeros(rows, np.int64)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    value = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        value = mix(value ^ hashes[k : k + len(value)])
    whole = np.flatnonzero(doc[: len(value)] == doc[width - 1 :]) if len(value) else np.empty(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < width))
    small = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        has = count[short] > k
        small[has] = mix(small[has] ^ hashes[first[short[has]] + k])
    small = mix(small ^ count[short].astype(np.uint64))
    docs = np.concatenate([doc[whole], short])
    values = np.concatenate([value[whole], small])
    if len(short):
        order = np.argsort(docs, kind="stable")
        docs, values = docs[order], values[order]
    return docs, values


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())


# ---- graphs ----------------------------------------------------------------


class Forest:
    """Union-find over small integers."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of each batch by one edge from every node to the least it reaches there."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        forest = Forest(len(nodes))
        for x, y in zip(place[: len(a)].tolist(), place[len(a) :].tolist(), strict=True):
            forest.join(x, y)
        root = np.array([forest.find(i) for i in range(len(nodes))], np.int64)
        keep = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[keep]), pa.array(nodes[root[keep]])], names=["a", "b"]
        )


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component): the least node reachable, for every node that has an edge.

    ``edges`` has two long columns. Alternating stars: every node is linked to the least
    neighbour, first from its larger neighbours, then from itself, until nothing moves.
    Each round is stored, so lost executors repeat one round at most.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = staged(edges.mapInArrow(_local_stars, "a long, b long").distinct(), f"{label}-edges")
    before = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        before = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Every edge now runs from a larger to a smaller node.
        large = staged(large.distinct(), f"{label}-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(*[F.struct(F.col(x).alias("a"), F.col("m").alias("b")) for x in ("a", "b")])
        small = large.join(low, "a").select(F.inline(ends)).filter("a <> b").distinct()
        edges = staged(small, f"{label}-small")
