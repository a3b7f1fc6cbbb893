"""Best-fit packing of token sequences by a configuration linear program.

The program's columns are ways to fill one sequence (how many pieces of each length), its
rows the length histogram. Multiplicative weights solve it: every length has a price that
falls by a small factor with each share of its demand that is covered, and each round a
knapsack over the capacity, by dynamic programming, finds the fill worth most at these
prices. Lengths are covered many times over; the sum of the steps, scaled back, is the
fractional solution, and prices over the best fill's worth bound the program from below.
The solution is rounded to whole copies; what is left is packed by best fit, decreasing, or
by fullest fills first. Of several roundings of the solution the fewest sequences win; no plan
is made without it. The driver sees the histogram only (one number per length), so the plan
costs the same for any number of documents.

Pieces are then ranked within their length, bucket by bucket so that a common length is
spread over many tasks, and a rank tells sequence and offset by arithmetic.

Null or empty texts are one piece with the end id alone. Repeated rows are packed each.
An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenurecast.llm.common import table
from tenurecast.session import staged

CAPACITY, END_ID = 4096, 1
#: Rounds of multiplicative weights, how far a price falls in one (as an exponent), and the
#: gap between solution and bound at which they end. A round that prices many lengths counts
#: as several, one for each ``DENSE`` of them.
ROUNDS, FALL, GAP, DENSE = 3000, 0.1, 0.0005, 192
#: Lengths priced in a round, by tokens and by pieces or price, while a fill of them is worth
#: nearly as much as any fill can be.
PRICED = 24
#: Rounds of fullest fills, and the share of the tokens that these leave to best fit.
FULLEST_ROUNDS, UNCOVERED = 3000, 0.05
#: Shares of the solution's full fills that are tried.
SHARES = (1.0, 0.5, 0.25, 0.125)
#: Rows of one length that one task ranks, about.
RANKED_ROWS = 50_000
#: Words whose ids a worker remembers (only speed depends on it), and their length at most.
_REMEMBERED, _LONGEST = 450_000, 48
#: Longer words go through the tokenizer, whose merges do not slow down with length.
_MERGED = 256

# The vocabulary's pattern for pre-tokens, on lower-case ASCII and Latin-1
# letters, and the characters that stand for bytes outside of printable Latin-1.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+")
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_BYTE = {256 + k: b for k, b in enumerate(_HIDDEN)}

_encoders: dict = {}


# ---- tokens ----------------------------------------------------------------


class Encoder:
    """Ids of texts by a tokenizer file, with what was seen before looked up.

    The vocabulary drops white space and no token reaches across it, so a text is the join
    of its words. New words are merged together by the file's own ranks, without the offsets
    that its model keeps. Two generations of the table are kept, so memory is bounded and
    frequent words stay.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.ranked = _ranked(json.load(file)["model"])
        self.line = self.ranked.encode_single_token(b"\n")
        self.words = _Recent()

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        needed = set().union(*split) if split else set()
        table = self.words.look_up(needed, self._encode)
        return [b"".join(map(table.__getitem__, words)) for words in split]

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words without white space.

        Words of ASCII and the composed letters of Latin-1 are lower-cased and cut here, as
        the file's own normalizer and pattern do; all others go through the tokenizer.
        """
        plain = [w for w in words if len(w) <= _MERGED and _PLAIN.fullmatch(w) and "<|" not in w]
        found = {}
        if plain:
            cut = _CUT.sub(r"\g<0> ", "\n".join(plain).lower()) + "\n"
            ids = self.ranked.encode_to_numpy(cut)
            ends = np.flatnonzero(ids == self.line)
            if len(ends) != len(plain):
                raise ValueError("the vocabulary does not keep words apart")
            raw = ids.astype("<u4").tobytes()
            stops = (4 * ends).tolist()
            found = {w: raw[a:b] for w, a, b in zip(plain, [0, *[x + 4 for x in stops]], stops, strict=False)}
        for w in words:
            if w not in found:
                found[w] = np.array(self.whole.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
        return found


def _ranked(model: dict):
    """The merges of a tokenizer file over bytes, a space standing for the end of a word.

    The ids of such a file are its ranks: bytes, bytes that end a word, then the merges.
    """
    import tiktoken

    vocabulary, pairs = model["vocab"], [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
    first = len(vocabulary) - len(pairs)
    if any(vocabulary["".join(p)] != first + k for k, p in enumerate(pairs)):
        raise ValueError("the vocabulary is not numbered by its merges")
    ranks = {b" ": len(vocabulary)}  # never alone: it is merged with the byte before it
    for token, rank in vocabulary.items():
        body = token.removesuffix("</w>")
        raw = bytes(_BYTE.get(ord(c), ord(c)) for c in body)
        ranks[raw if body == token else raw + b" "] = rank
    return tiktoken.Encoding("ranked", pat_str=r"[^ \n]+ |\n", mergeable_ranks=ranks, special_tokens={})


class _Recent:
    """A table of the last ``_REMEMBERED`` to twice as many short words."""

    def __init__(self) -> None:
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def look_up(self, needed: set[str], make) -> dict[str, bytes]:
        """A table that holds at least all of ``needed``."""
        missing = needed.difference(self.new)
        kept = {w: self.old[w] for w in missing if w in self.old}
        missing.difference_update(kept)
        long = {w for w in missing if len(w) > _LONGEST}
        made = make(list(missing)) if missing else {}
        if len(self.new) + len(kept) + len(made) > _REMEMBERED:
            self.old, self.new = self.new, {w: self.new[w] for w in needed if w in self.new}
        self.new.update(kept)
        self.new.update(made)
        if not long:
            return self.new
        table = {w: self.new[w] for w in needed}
        for w in long:
            del self.new[w]
        return table


def encode(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian 32-bit numbers."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path](texts)


def _pieces(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = encode([t or "" for t in part.column("text").to_pylist()], path)
                rows = []
                for doc, found in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    found += end
                    for k, start in enumerate(range(0, len(found), 4 * capacity)):
                        piece = found[start : start + 4 * capacity]
                        rows.append((doc, k, start // 4, len(piece) // 4, zlib.crc32(piece)))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


# ---- plan ------------------------------------------------------------------

Fill = tuple[tuple[int, int], ...]  # (length, how many), longest first


def _bundles(most: int) -> Iterator[int]:
    """Sizes whose partial sums are all numbers up to ``most``."""
    k = 1
    while most > 0:
        yield min(k, most)
        most -= k
        k *= 2


def price(lengths: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int) -> Fill:
    """The fill of one sequence worth most: knapsack by dynamic programming.

    Pieces of a length come in bundles of one, two, four and so on, ``most`` of them together.
    """
    bundles = [(int(n) * k, float(v) * k, int(n), k) for n, v, m in zip(lengths, values, most, strict=True) for k in _bundles(int(min(m, capacity // n)))]
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(bundles), capacity + 1), bool)
    for row, (weight, value, _, _) in zip(taken, bundles, strict=True):
        option = best[: capacity + 1 - weight] + value
        np.greater(option, best[weight:], out=row[weight:])
        np.maximum(best[weight:], option, out=best[weight:])
    fill: dict[int, int] = {}
    c = capacity
    for row, (weight, _, n, k) in zip(taken[::-1], bundles[::-1], strict=True):
        if row[c]:
            fill[n] = fill.get(n, 0) + k
            c -= weight
    return tuple(sorted(fill.items(), reverse=True))


def configuration(counts: dict[int, int], capacity: int, rounds: int = ROUNDS) -> tuple[dict[Fill, float], float]:
    """Fractional numbers of each fill, by multiplicative weights, and a bound from below.

    The step of a round covers all of the demand of one length in the fill. A length is
    covered once for every demand's worth, so many times in all, and the sum is scaled back.
    """
    lengths = np.array(sorted(counts), np.int64)
    demand = np.array([counts[n] for n in lengths.tolist()], float)
    place = {n: i for i, n in enumerate(lengths.tolist())}
    most = np.minimum(demand, capacity // lengths)
    worth = lengths / capacity
    covered = np.zeros(len(lengths))  # as a multiple of the demand
    prices = worth.copy()
    top, bound, total = 1.0, float(worth @ demand), 0.0
    used: dict[Fill, float] = {}
    whole = np.arange(len(lengths))
    spent = 0.0
    while spent < rounds:
        dear = whole
        if len(lengths) > 2 * PRICED:
            dear = np.union1d(np.argsort(-prices * demand, kind="stable")[:PRICED], np.argsort(-prices / worth, kind="stable")[:PRICED])
        fill = price(lengths[dear], prices[dear], most[dear], capacity)
        value = sum(prices[place[n]] * m for n, m in fill)
        # Prices only fall, so the worth of the best fill at any time bounds it later on.
        if value < (1 - FALL) * top and len(dear) < len(lengths):
            dear = whole
            fill = price(lengths, prices, most, capacity)
            value = sum(prices[place[n]] * m for n, m in fill)
        spent += max(1.0, len(dear) / DENSE)
        if len(dear) == len(lengths):
            top = value
            bound = max(bound, float(prices @ demand) / top)
        at = np.array([place[n] for n, _ in fill])
        many = np.array([m for _, m in fill], float)
        step = float((demand[at] / many).min())
        used[fill] = used.get(fill, 0.0) + step
        total += step
        covered[at] += many * step / demand[at]
        prices[at] = worth[at] * np.exp(-FALL * covered[at])
        least = covered.min()
        if least > 0 and total <= (1 + GAP) * least * bound:
            break
    # Without a full cover yet, the mean over the tokens stands for it; rounding mends the rest.
    scale = max(covered.min(), float((covered * demand) @ lengths) / float(demand @ lengths))
    return {fill: x / scale for fill, x in used.items()}, bound


def fullest(counts: dict[int, int], capacity: int) -> dict[Fill, int]:
    """Numbers of fills, each the fullest of the lengths with the most left, half by tokens,
    half by pieces; a length is covered once at most, and some of the tokens are left."""
    lengths = np.array(sorted(counts), np.int64)
    left = np.array([counts[n] for n in lengths.tolist()], np.int64)
    place = {n: i for i, n in enumerate(lengths.tolist())}
    tokens = int(left @ lengths)
    used: dict[Fill, int] = {}
    for _ in range(FULLEST_ROUNDS):
        if left @ lengths <= UNCOVERED * tokens:
            break
        dear = np.union1d(np.argsort(-left * lengths, kind="stable")[:PRICED], np.argsort(-left, kind="stable")[:PRICED])
        dear = dear[left[dear] > 0]
        fill = price(lengths[dear], lengths[dear] / capacity, np.minimum(left[dear], 7), capacity)
        at = np.array([place[n] for n, _ in fill])
        many = np.array([m for _, m in fill])
        step = int((left[at] // many).min())
        used[fill] = used.get(fill, 0) + step
        left[at] -= many * step
    return used


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Fill, int]]:
    """Best fit decreasing on a histogram; equal bins are filled at once."""
    bins: dict[int, list[list]] = {}  # free -> [fill, copies]
    some = np.zeros(capacity + 1, bool)  # whether bins have so much free
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            free = length + int(some[length:capacity].argmax()) if some[length:capacity].any() else None
            group = bins[free].pop() if free is not None else [(), -(-left // (capacity // length))]
            free = capacity if free is None else free
            fill, copies = group
            each = min(free // length, left)
            full = min(copies, left // each)
            if full < copies and free < capacity:
                bins[free].append([fill, copies - full])
            some[free] = free < capacity and bool(bins[free])
            bins.setdefault(free - each * length, []).append([(*fill, (length, each)), full])
            some[free - each * length] = True
            left -= each * full
    return [(tuple(fill), copies) for groups in bins.values() for fill, copies in groups]


def _rounded(solution: dict[Fill, float], left: dict[int, int], up: bool = False) -> list[tuple[Fill, int]]:
    """Whole copies of the fills, as many as there are pieces for; these leave ``left``."""
    chosen = []
    for fill, x in sorted(solution.items(), key=lambda f: (-f[1], f[0])):
        copies = min(int(np.ceil(x - 1e-9) if up else x + 1e-9), *(left.get(n, 0) // m for n, m in fill))
        if copies:
            chosen.append((fill, copies))
            for n, m in fill:
                left[n] -= m * copies
    return chosen


def _greedy(counts: dict[int, int], capacity: int) -> list[tuple[Fill, int]]:
    """Fullest fills, as far as they leave next to nothing free, then best fit."""
    left = {n: c for n, c in counts.items() if c}
    full = {f: x for f, x in fullest(left, capacity).items() if sum(n * m for n, m in f) >= 0.999 * capacity} if left else {}
    chosen = _rounded(full, left)
    return chosen + best_fit({n: c for n, c in left.items() if c}, capacity)


def _sequences(chosen: list[tuple[Fill, int]]) -> int:
    return sum(copies for _, copies in chosen)


def _packed(solution: dict[Fill, float], counts: dict[int, int], capacity: int) -> list[tuple[Fill, int]]:
    """The solution in whole copies, and fullest fills and best fit for what it leaves.

    Roundings of the fills without free tokens come first, whose rest packs tightly, by smaller
    and smaller shares, then those of all fills; the fewest sequences win.
    """
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    full = {f: x for f, x in solution.items() if sum(n * m for n, m in f) == capacity}
    best: list[tuple[Fill, int]] | None = None
    for fills, share, ends in [*((full, share, [best_fit]) for share in SHARES if full), (solution, 1.0, [best_fit, _greedy])]:
        part = {f: x * share for f, x in fills.items()}
        for up in (True, False):
            rest = dict(counts)
            some = _rounded(part, rest, up)
            rest = {n: c for n, c in rest.items() if c}
            for end in ends:
                found = some + end(rest, capacity)
                if best is None or _sequences(found) < _sequences(best):
                    best = found
                if _sequences(best) <= least:
                    return best
    return best


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Fill, int]]:
    """(fill, copies) that hold every piece of the histogram exactly once.

    The program is solved for every histogram, also where a plainer plan would do as well.
    """
    left = {n: c for n, c in counts.items() if c and n < capacity}
    chosen = [(((capacity, 1),), counts[capacity])] if counts.get(capacity) else []
    if not left:
        return chosen
    solution, _ = configuration(left, capacity)
    return chosen + _packed(solution, left, capacity)


def slots(chosen: list[tuple[Fill, int]]) -> dict[str, np.ndarray]:
    """For each length, in order of rank: first rank, pieces a copy, first sequence, offset."""
    rows, taken, sequence = [], {}, 0
    for fill, copies in chosen:
        offset = 0
        for n, m in fill:
            rows.append((n, taken.get(n, 0), m, sequence, offset))
            taken[n] = taken.get(n, 0) + m * copies
            offset += n * m
        sequence += copies
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "many", "sequence", "offset"), columns, strict=True))


# ---- Spark -----------------------------------------------------------------


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        keys = (s["length"] << 48) + s["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            copy, k = np.divmod(rank - s["rank"][at], s["many"][at])
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(s["sequence"][at] + copy), pa.array(s["offset"][at] + k * length)],
                names=[*names, "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece with its sequence and offset."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = staged(docs.mapInArrow(_pieces(tokenizer, capacity, end_id), schema), "packing-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(slots(plan(counts, capacity)))

    buckets = max(1, sum(counts.values()) // RANKED_ROWS)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = dealt.withColumn("at", F.row_number().over(within)).join(sizes, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("at") - 1 + F.col("before")).alias("rank"))
    return ranked.mapInArrow(_place(shared), f"{schema}, sequence_id long, offset long")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
