"""Packing of token sequences by minimum bin slack.

Every window is filled with the multiset of remaining lengths whose sum is closest to its
capacity: a subset-sum dynamic program over bits (bit s: sum s is reachable), lengths from
long to short in bundles of one, two, four and so on, ends as soon as the window is full,
and the counts of each length are found by going back through the bundles. The same fill is
used for as many windows as there are pieces for. If no multiset fills the window, the
longest piece left is cut at what is missing and its rest goes back to the lengths. The last
tokens fill windows of powers of two. So no sequence is padded, and few pieces are cut.

Texts longer than a window are cut into whole windows, and only what is left of them is
packed. The driver sees one number per length, so the plan costs the same for any number of
documents; its fills are bounded by the number of lengths. Pieces are ranked within their
length, bucket by bucket, and a rank tells sequence, offset and cuts by arithmetic.

Null and empty texts are the end id alone. Rows with equal or null ids are packed each. A
table without rows gives none. Other columns are ignored, also if their names are those of
the result. Pieces of equal length are interchangeable; ties go by the order of rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenurecast.llm.common import table
from tenurecast.llm.packing import _Recent
from tenurecast.session import staged

CAPACITY, END_ID = 1024, 0
#: Rows of one length that one task ranks, about, and texts encoded together.
RANKED_ROWS, TEXTS = 5_000, 1_024
#: Longer units go through the tokenizer itself, whose merges do not slow down with length.
LONGEST = 200
#: Units of characters that all Unicode versions know, without odd white space.
_PLAIN = re.compile(r"[!-~¡-ɏ][\n\t\r -~¡-ɏ]*")
_START = re.compile(r"[\n\t\r!-~¡-ɏ]*")

_encoders: dict = {}


# ---- tokens ----------------------------------------------------------------


class Encoder:
    """Ids of texts by a byte-level tokenizer file.

    No token reaches across a space before a solid character, so a text falls apart there,
    and units seen before are looked up. Texts with special tokens, runs of white space or
    rare characters go through the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown}
        byte |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        own = {t: i for t, i in self.whole.get_vocab().items() if t not in self.special}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in own.items()}
        self.sizes = np.zeros(self.whole.get_vocab_size(), np.int64)
        for raw, i in ranks.items():
            self.sizes[i] = len(raw)
        self.ranked = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.units = _Recent()

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        # Units are told apart by Arrow: only distinct ones become Python strings.
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        cuts = split.offsets.to_numpy().astype(np.int64)
        distinct = split.flatten().dictionary_encode()
        names, place = distinct.dictionary.to_pylist(), distinct.indices.to_numpy()
        table = self.units.look_up(set(names), self._encode)
        known = [table[n] for n in names]
        odd = np.array([k is None for k in known], bool)
        ids = np.frombuffer(b"".join([k or b"" for k in known]), "<u4")
        sizes = np.array([len(k or b"") // 4 for k in known], np.int64)
        begins = np.cumsum(sizes) - sizes
        size = sizes[place]
        size[cuts[:-1]] = 0  # the first unit of a text has no space before it
        stops = np.cumsum(size)
        raw = ids[np.arange(int(stops[-1]) if len(stops) else 0) + np.repeat(begins[place] - stops + size, size)].tobytes()
        bounds = np.concatenate([[0], 4 * stops])[cuts].tolist()
        strange = odd[place]
        strange[cuts[:-1]] = False
        whole = np.concatenate([[0], np.cumsum(strange)])[cuts]
        whole = (whole[1:] > whole[:-1]).tolist()
        out = []
        for k, text in enumerate(texts):
            start = text.partition(" ")[0]
            if whole[k] or len(start) > LONGEST or not _START.fullmatch(start) or any(s in start for s in self.special):
                out.append(_raw(self.whole.encode(text, add_special_tokens=False).ids))
            else:
                first = _raw(self.ranked.encode_to_numpy(start, disallowed_special=())) if start else b""
                out.append(first + raw[bounds[k] : bounds[k + 1]])
        return out

    def _encode(self, units: list[str]) -> dict[str, bytes | None]:
        """Ids of units after a space, None for those that must not be cut out."""
        found: dict[str, bytes | None] = dict.fromkeys(units)
        plain = [u for u in units if len(u) <= LONGEST and _PLAIN.fullmatch(u)]
        text = " " + " ".join(plain)
        if any(s in text for s in self.special):
            plain = [u for u in plain if not any(s in u for s in self.special)]
            text = " " + " ".join(plain)
        if plain:
            ids = self.ranked.encode_to_numpy(text, disallowed_special=())
            ends = np.cumsum(self.sizes[ids])
            bounds = np.cumsum(np.fromiter(map(len, plain if text.isascii() else map(str.encode, plain)), np.int64, len(plain)) + 1)
            stops = np.searchsorted(ends, bounds)
            if not np.array_equal(ends[stops], bounds):
                raise ValueError("a token reaches across units")
            raw, cuts = _raw(ids), (4 * stops + 4).tolist()
            found.update(zip(plain, [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True))
        return found


def _raw(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def encode(texts: list[str], path: str) -> list[bytes]:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path](texts)


_PIECE = "doc_id long, doc_tokens long, start long, length long, ids_crc32 long, ids binary"


def _pieces(path: str, capacity: int, end_id: int):
    end = _raw([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                rows = []
                for doc, found in zip(part.column("doc_id").to_pylist(), encode([t or "" for t in part.column("text").to_pylist()], path), strict=True):
                    found += end
                    for start in range(0, len(found), 4 * capacity):
                        piece = found[start : start + 4 * capacity]
                        # Whole windows are never cut, so only shorter pieces keep their ids.
                        ids = piece if len(piece) < 4 * capacity else None
                        rows.append((doc, len(found) // 4, start // 4, len(piece) // 4, zlib.crc32(piece), ids))
                kinds = (*[pa.int64()] * 5, pa.binary())
                names = ["doc_id", "doc_tokens", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    return run


# ---- plan ------------------------------------------------------------------


def closest(left: dict[int, int], capacity: int) -> dict[int, int]:
    """How many pieces of each length come closest to the capacity, long ones first."""
    within = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for n in sorted(left, reverse=True):
        most, k = min(left[n], capacity // n), 1
        while most > 0:
            k = min(k, most)
            steps.append((n, k, reach))
            reach |= (reach << (n * k)) & within
            most -= k
            k *= 2
        if reach >> capacity:
            break
    at = reach.bit_length() - 1
    fill: dict[int, int] = {}
    for n, k, before in reversed(steps):
        if not before >> at & 1:
            fill[n] = fill.get(n, 0) + k
            at -= n * k
    return fill


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where pieces go, by length and rank within the length.

    A row says for ranks from ``rank`` on: ``many`` of them lie one after another from
    ``offset`` in ``sequence``, the next in the next sequence. ``take`` of their tokens lie
    there; the rest of a cut piece goes on as the piece of the rest's length and rank ``rest``.
    """
    left = {n: c for n, c in counts.items() if c}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("pieces must be cut to the capacity first")
    used, size = dict.fromkeys(left, 0), dict(left)
    tokens = sum(n * c for n, c in left.items())
    rows, sequence = [], 0
    while tokens:
        room = capacity if tokens >= capacity else 1 << (tokens.bit_length() - 1)
        fill = closest(left, room)
        missing = room - sum(n * m for n, m in fill.items())
        cut = max(n for n, c in left.items() if c > fill.get(n, 0)) if missing else 0
        copies = min(left[n] // (m + (n == cut)) for n, m in (fill | {cut: fill.get(cut, 0)} if cut else fill).items())
        if room < capacity:
            copies = min(copies, tokens // room)
        offset = 0
        for n, m in sorted(fill.items(), reverse=True):
            rows.append((n, used[n], m, sequence, offset, n, 0))
            used[n] += m * copies
            left[n] -= m * copies
            offset += n * m
        if cut:
            rest = cut - missing
            rows.append((cut, used[cut], 1, sequence, offset, missing, size.get(rest, 0)))
            used[cut] += copies
            left[cut] -= copies
            size[rest] = size.get(rest, 0) + copies
            left[rest] = left.get(rest, 0) + copies
            used.setdefault(rest, 0)
        left = {n: c for n, c in left.items() if c}
        tokens -= room * copies
        sequence += copies
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 7).T
    return dict(zip(("length", "rank", "many", "sequence", "offset", "take", "rest"), columns, strict=True))


# ---- Spark -----------------------------------------------------------------


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        keys = (s["length"] << 48) + s["rank"]
        for batch in batches:
            length, rank, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank", "start"))
            row, start, found = np.arange(len(length)), first, []
            while len(row):
                at = np.searchsorted(keys, (length << 48) + rank, "right") - 1
                copy, k = np.divmod(rank - s["rank"][at], s["many"][at])
                take = s["take"][at]
                found.append((row, start, take, s["sequence"][at] + copy, s["offset"][at] + k * length))
                more = np.flatnonzero(take < length)
                row, start, length, rank = row[more], (start + take)[more], (length - take)[more], (s["rest"][at] + copy)[more]
            row, start, take, sequence, offset = (np.concatenate(c) for c in zip(*found, strict=True))
            whole = batch.column("ids_crc32").to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(take < batch.column("length").to_numpy(zero_copy_only=False)[row])
            crc = whole[row]
            ids, begin = batch.column("ids"), start - first[row]
            for i in cut.tolist():
                raw = ids[int(row[i])].as_py()
                crc[i] = zlib.crc32(raw[4 * begin[i] : 4 * (begin[i] + take[i])])
            pick = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pick), batch.column("doc_tokens").take(pick), *map(pa.array, (start, take, crc, sequence, offset))],
                names=["doc_id", "doc_tokens", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """One row per piece with its sequence and offset; whole windows have negative ids."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = docs.mapInArrow(_pieces(tokenizer, capacity, end_id), _PIECE).withColumn("row", F.monotonically_increasing_id())
    pieces = staged(pieces, "slack-pieces")
    short = pieces.filter(F.col("length") < capacity)
    counts = {r["length"]: r["n"] for r in short.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(plan(counts, capacity))

    buckets = F.lit([max(1, counts.get(n, 0) // ranked_rows) for n in range(capacity)])
    dealt = short.withColumn("bucket", F.pmod(F.xxhash64("row"), F.get(buckets, F.col("length").cast("int"))))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = dealt.withColumn("at", F.row_number().over(within)).join(sizes, ["length", "bucket"])
    ranked = ranked.select("doc_id", "doc_tokens", "start", "length", "ids_crc32", "ids", (F.col("at") - 1 + F.col("before")).alias("rank"))
    schema = "doc_id long, doc_tokens long, start long, length long, ids_crc32 long, sequence_id long, offset long"
    full = pieces.filter(F.col("length") == capacity)
    full = full.select("doc_id", "doc_tokens", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(ranked.mapInArrow(_place(shared), schema))


def op12_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
