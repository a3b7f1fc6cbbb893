"""Alignment of two tokenizers' ids by the byte ends that they share.

Both tokenizers spell the same bytes. The ends of the tokens of each side are cumulated and
kept as a dictionary from end to index; the intersection of the two key sets, sorted, cuts
both id lists into groups, and every pair of tokens of a group is linked. How many documents
hold an id pair linked is counted over all documents; a document is then scored by its links.

Neither vocabulary joins bytes across a space before a solid character, so a text falls
apart there into units, and a block of texts aligns every distinct unit once. Texts that
need more care (runs of white space, marks, very long or rare characters) are one unit.

Documents are handled in blocks of ``BLOCK_BYTES`` of text. A block gives one row per
document with its units, and one row with the distinct pairs of the block and how many of
its documents hold each, so what is shuffled by pair is one row per pair and block, however
many documents share a pair. Counts come back to the block by its number.

Null and empty texts, and texts whose joined bytes on either side differ from space + text,
have no tokens: zeros and an empty hash. Null ids and repeated rows give a row each; every
copy counts as a document. Ties for the highest count of an id are all best. Very long texts
fill a block of their own. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenurecast.llm.common import table
from tenurecast.session import staged

#: Bytes of text in a block, about; texts looked at together; longest unit that is cut out.
BLOCK_BYTES, TEXTS, LONGEST = 16 << 20, 256, 200
#: Links of a group listed one by one; beyond, its distinct ids are paired first.
LISTED = 4096
#: Units of characters that all Unicode versions know, without marks and odd white space.
_PLAIN = re.compile(r"[!-~¡-ɏ][\n\t\r -~¡-ɏ]*")
_MARK = "▁"


class Pair:
    """Two tokenizers, the bytes of their ids, and texts encoded by both."""

    def __init__(self, first: str, second: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        unhide = _byte_letters()
        self.bytes_a = [bytes(unhide.get(c, 63) for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        special = set(self.a.get_added_tokens_decoder())
        ranks = {raw: i for i, raw in enumerate(self.bytes_a) if i not in special}
        self.ranked = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode()
            for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        if any(b" " in raw.lstrip(b" ") or b"\n" in raw[1:] for raw in self.bytes_b):
            raise ValueError("pieces reach across spaces or lines")
        # How an id is written before "," or "|", and before "," or ";".
        self.text_a = [f"{i}{c}" for i in range(len(self.bytes_a)) for c in ",|"]
        self.text = self.text_a + [f"{i}{c}" for i in range(len(self.bytes_b)) for c in ",;"]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)

    def ids(self, units: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides of " " + each unit, joined; None if bytes differ."""
        text = " ".join(units)
        raw = (" " + text).encode()
        if plain:
            a = self.ranked.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)
        else:
            a = np.array(self.a.encode(" " + text, add_special_tokens=False).ids, np.int64)
        b = np.array(self.b.encode(text), np.int64)
        same = all(b"".join(map(t.__getitem__, i.tolist())) == raw for t, i in ((self.bytes_a, a), (self.bytes_b, b)))
        return (a, b) if same else None


def _byte_letters() -> dict[str, int]:
    """The letters in which a byte-level vocabulary writes bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    return letters | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted ends that both sides have, and the tokens of each side up to them."""
    at_a = dict(zip(a.tolist(), range(1, len(a) + 1), strict=True))
    at_b = dict(zip(b.tolist(), range(1, len(b) + 1), strict=True))
    ends = sorted(at_a.keys() & at_b.keys())
    return tuple(np.array(x, np.int64) for x in (ends, list(map(at_a.__getitem__, ends)), list(map(at_b.__getitem__, ends))))


def _runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. up to each count, one after another."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def expand(a: np.ndarray, b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of all groups: (group, id pair, times), a pair of a small group once a link."""
    start_a, start_b = (np.concatenate([[0], s[:-1]]) for s in (stop_a, stop_b))
    m, n = stop_a - start_a, stop_b - start_b
    small = np.flatnonzero(m * n <= LISTED)
    group = np.repeat(small, (m * n)[small])
    k = _runs((m * n)[small])
    row, column = np.divmod(k, n[group]) if len(group) else (k, k)
    found = [(group, (a[start_a[group] + row] << 32) | b[start_b[group] + column], np.ones(len(group), np.int64))]
    for g in np.flatnonzero(m * n > LISTED).tolist():
        (x, i), (y, j) = (np.unique(t, return_counts=True) for t in (a[start_a[g] : stop_a[g]], b[start_b[g] : stop_b[g]]))
        pairs, times = ((x[:, None] << 32) | y[None, :]).ravel(), (i[:, None] * j[None, :]).ravel()
        found.append((np.full(len(pairs), g), pairs, times))
    group, pairs, times = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(group, kind="stable")
    return group[order], pairs[order], times[order]


class Block:
    """Distinct units of a block of texts with what their alignment gives."""

    def __init__(self, tokenizers: Pair) -> None:
        self.by = tokenizers
        self.unit: dict[str, int] = {}  # -1: not plain
        self.written: list[str] = []  # groups of a unit, as hashed
        self.pair: dict[int, int] = {}
        self.sums: list[np.ndarray] = [np.zeros((4, 0), np.int64)]  # n_a, n_b, n_groups, n_links
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # links a unit, pair numbers, times
        self.bytes = 0
        self.held = np.zeros(0, np.int64)

    def add(self, units: list[str], ids: tuple[np.ndarray, np.ndarray]) -> None:
        """Align units that are encoded together; each ends at an end of both sides."""
        by, (a, b) = self.by, ids
        ends, stop_a, stop_b = common_ends(np.cumsum(by.size_a[a]), np.cumsum(by.size_b[b]))
        bounds = np.cumsum([len(u.encode()) + 1 for u in units])
        last = np.searchsorted(ends, bounds)
        if not np.array_equal(ends[last], bounds):
            raise ValueError("a token reaches across units")
        group, pairs, times = expand(a, b, stop_a, stop_b)
        m, n = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        totals = [stop_a[last], stop_b[last], last + 1, np.cumsum(m * n)[last]]
        self.sums.append(np.diff(np.array(totals), prepend=0, axis=1))
        links = np.diff(np.searchsorted(group, last, "right"), prepend=0)
        distinct, at = np.unique(pairs, return_inverse=True)
        number = np.fromiter((self.pair.setdefault(p, len(self.pair)) for p in distinct.tolist()), np.int64, len(distinct))
        self.pairs.append((links, number[at].astype(np.int32), times.astype(np.int32)))
        # Written tokens: all of a group's first side, then its second.
        code_a, code_b = 2 * a, 2 * b
        code_a[stop_a - 1] += 1
        code_b[stop_b - 1] += 1
        shown = np.empty(len(a) + len(b), np.int64)
        shown[np.arange(len(a)) + np.repeat(stop_b - n, m)] = code_a
        shown[np.arange(len(b)) + np.repeat(stop_a, n)] = code_b + len(by.text_a)
        text = list(map(by.text.__getitem__, shown.tolist()))
        cuts = (stop_a[last] + stop_b[last]).tolist()
        self.unit.update(zip(units, range(len(self.written), len(self.written) + len(units)), strict=True))
        self.written += ["".join(text[x:y]) for x, y in zip([0, *cuts[:-1]], cuts, strict=True)]

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Units of every text, and how many; none for a text without tokens."""
        cut = [t.split(" ") if t else [] for t in texts]
        new = list(set().union(*cut).difference(self.unit))
        plain = [u for u in new if len(u) <= LONGEST and _PLAIN.fullmatch(u)]
        self.unit.update(dict.fromkeys(new, -1))
        ids = self.by.ids(plain, True) if plain else None
        if ids is not None:
            self.add(plain, ids)
        counts = np.array([len(u) for u in cut], np.int64)
        units = np.fromiter(map(self.unit.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        row = np.repeat(np.arange(len(cut)), counts)
        odd = set(row[units < 0].tolist())
        if odd:
            split = np.split(units, np.cumsum(counts)[:-1])
            for k in odd:
                split[k] = self._whole(texts[k])
            counts, units = np.array([len(u) for u in split], np.int64), np.concatenate(split)
        self.bytes += sum(len(t) for t in texts if t)
        return units, counts

    def _whole(self, text: str) -> np.ndarray:
        """A text as a unit of its own, nameless, or nothing if its bytes differ."""
        ids = self.by.ids([text], False)
        if ids is None:
            return np.zeros(0, np.int64)
        before = self.unit.get(text)
        self.add([text], ids)
        found = self.unit.pop(text)
        if before is not None:
            self.unit[text] = before
        return np.array([found])

    def rows(self, docs: pa.Array, texts: list[str | None], number: int) -> pa.RecordBatch:
        units, counts = self.texts(texts)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        written = list(map(self.written.__getitem__, units.tolist()))
        cuts = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        hashes = [hashlib.sha256("".join(written[x:y])[:-1].encode()).hexdigest() if y > x else "" for x, y in cuts]
        self.sums = [np.concatenate(self.sums, axis=1)]
        sums = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(self.sums[0][:, units], axis=1)], axis=1)[:, offsets]
        self._hold(np.repeat(np.arange(len(counts)), counts), units)
        return _batch(
            len(counts), block=pa.array(np.full(len(counts), number)), doc_id=docs, groups_sha256=pa.array(hashes, pa.string()),
            units=pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(units.astype(np.int32))),
            **{name: pa.array(row) for name, row in zip(("n_a", "n_b", "n_groups", "n_links"), np.diff(sums, axis=1), strict=True)},
        )

    def _hold(self, doc: np.ndarray, units: np.ndarray) -> None:
        """Count each document once for every pair that it holds."""
        links, numbers, _ = self._linked()
        start = np.cumsum(links) - links
        own = np.unique((doc << 32) | units)
        doc, units = own >> 32, own & 0xFFFFFFFF
        count = links[units]
        pairs = numbers[np.repeat(start[units], count) + _runs(count)]
        held = np.unique((np.repeat(doc, count) << 32) | pairs) & 0xFFFFFFFF
        counted = np.bincount(held, minlength=len(self.pair))
        counted[: len(self.held)] += self.held
        self.held = counted

    def _linked(self) -> tuple[np.ndarray, ...]:
        if len(self.pairs) != 1:
            none = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))
            self.pairs = [tuple(np.concatenate(c) for c in zip(none, *self.pairs, strict=True))]
        return self.pairs[0]

    def summary(self, number: int) -> pa.RecordBatch:
        links, numbers, times = self._linked()
        lists = {
            "pairs": np.fromiter(self.pair, np.int64, len(self.pair)),
            "held": self.held.astype(np.int32),
            "links": links.astype(np.int32),
            "numbers": numbers,
            "times": times,
        }
        one = {k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for k, v in lists.items()}
        return _batch(1, block=pa.array([number]), **one)


_SCHEMA = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, units array<int>, "
    "pairs array<long>, held array<int>, links array<int>, numbers array<int>, times array<int>"
)
_KINDS = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
_COLUMNS = {name: _KINDS[kind] for name, kind in (c.split(" ") for c in _SCHEMA.split(", "))}


def _batch(rows: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[c].cast(k) if c in columns else pa.nulls(rows, k) for c, k in _COLUMNS.items()], names=list(_COLUMNS))


_loaded: dict = {}


def _blocks(first: str, second: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (first, second) not in _loaded:
            _loaded[first, second] = Pair(first, second)
        number = TaskContext.get().partitionId() << 32
        block = Block(_loaded[first, second])
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                yield block.rows(part.column("doc_id"), part.column("text").to_pylist(), number)
                if block.bytes >= size:
                    yield block.summary(number)
                    block, number = Block(block.by), number + 1
        if block.bytes:
            yield block.summary(number)

    return run


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each document of a block."""
    held = docs.column("pairs").is_valid()
    one = docs.filter(held)
    docs = docs.filter(pa.compute.invert(held))
    n = len(docs)
    value = best = np.zeros(0, np.int64)
    if len(one):
        size = len(one.column("pairs")[0].values)
        count, top = np.zeros(size, np.int64), np.zeros(size, np.int64)
        place = counts.column("number").to_numpy()
        count[place], top[place] = counts.column("docs").to_numpy(), counts.column("best").to_numpy()
        links, numbers, times = (one.column(c)[0].values.to_numpy() for c in ("links", "numbers", "times"))
        cuts = np.concatenate([[0], np.cumsum(links, dtype=np.int64)])
        value, best = (np.diff(np.concatenate([[0], np.cumsum(x[numbers] * times)])[cuts]) for x in (count, top))
    lists = docs.column("units").combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    units, cuts = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy())])
    score, best = (np.diff(np.concatenate([[0], np.cumsum(x[units])])[cuts]) if n else np.zeros(0, np.int64) for x in (value, best))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    return pa.table({**{c: docs.column(c) for c in kept}, "n_best": best, "count_sum": score})


def align(docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", block: int = BLOCK_BYTES) -> DataFrame:
    """One row per document with its tokens, groups, links, and links scored by all documents.

    ``first`` is a byte-level vocabulary of ``tokenizers``, ``second`` a model of
    ``sentencepiece`` that adds a space before the text.
    """
    return _aligned(docs, first, second, key, text, block)[0]


def pair_counts(docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", block: int = BLOCK_BYTES) -> DataFrame:
    """(a, b, docs, best): the documents that hold an id pair linked, and whether it is the
    highest of its first id."""
    counts = _aligned(docs, first, second, key, text, block)[1]
    return counts.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "docs", F.col("best") == 1)


def _aligned(docs: DataFrame, first: str, second: str, key: str, text: str, block: int) -> tuple[DataFrame, DataFrame]:
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = staged(docs.mapInArrow(_blocks(first, second, block), _SCHEMA), "alignment-blocks")
    held = rows.filter("pairs is not null").select("block", F.inline(F.arrays_zip("pairs", "held")).alias("pair", "held"))
    counts = held.groupBy("pair").agg(F.sum("held").alias("docs"))
    side = Window.partitionBy(F.shiftright("pair", 32))
    counts = counts.withColumn("best", (F.col("docs") == F.max("docs").over(side)).cast("int"))
    counts = staged(counts, "alignment-counts")
    numbered = rows.filter("pairs is not null").select("block", F.posexplode("pairs").alias("number", "pair"))
    back = numbered.join(counts, "pair").select(F.col("block").alias("of"), "number", "docs", "best")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return rows.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_scored, schema), counts


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = align(table(spark, sf_dir, "documents"), *paths)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
