"""SentencePiece encoding by sampling the piece lattice, and decoding.

A text's lattice has an edge for every piece of the vocabulary that matches at a place.
Forward filtering sums the weights of all paths to each place; backward sampling then walks
from the end and draws edges in proportion to the paths through them, so a segmentation is
drawn exactly in proportion to the product of its pieces' weights. Draws are hashes of the
row's key, the word's number and the step: a row is cut alike wherever and whenever it runs.

No piece holds a space after another character, or a line break, so the lattice falls apart
at these places; a word's filtered lattice is computed once per worker and reused. A piece
of rank r in the model weighs (r + 1) ** -sharpness; characters outside of the vocabulary
are written as byte pieces.

Decoding joins pieces and bytes and gives back exactly the text: the mark that stands for
a space is itself written in bytes where a text has it. Null and empty texts have no pieces;
a null key counts as 0; rows of equal key and text are cut alike.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurecast.llm.common import mix, table

SHARPNESS, SEED = 1.0, 0
#: Lattice edges that a worker remembers (only speed depends on it).
_REMEMBERED = 8_000_000
_MARK = "▁"
_BASE = 0x9E3779B97F4A7C15
_CHUNK = re.compile(f"\n||{_MARK}+[^{_MARK}\n]*|[^{_MARK}\n]+")
# A mark in the text itself, or the character used to hide it, is cut out beforehand.
_OWN = re.compile(f"([{_MARK}])")


class Lattice:
    """Filtered lattices of words over one vocabulary."""

    def __init__(self, path: str, sharpness: float) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.ids = {model.id_to_piece(i): i for i in range(size) if i not in special}
        if any(_MARK in p.lstrip(_MARK) or "\n" in p for p in self.ids):
            raise ValueError("pieces reach across spaces or lines")
        rank = np.array([-model.get_score(i) for i in range(size)])
        self.weight = (-sharpness * np.log(np.maximum(rank, 0) + 1))
        self.byte_weight = -sharpness * math.log(2 * size)
        # By length, the hashes of all beginnings of pieces; the id of those that are pieces, or -1.
        self.by_length = []
        for n in range(1, max(map(len, self.ids)) + 1):
            heads = {p[:n] for p in self.ids if len(p) >= n}
            found = sorted((self._hash(p), self.ids.get(p, -1)) for p in heads)
            self.by_length.append((np.array([h for h, _ in found], np.uint64), np.array([i for _, i in found], np.int64)))
        self.raw = [b""] * size
        for p, i in self.ids.items():
            self.raw[i] = p.replace(_MARK, " ").encode()
        for b, i in enumerate(self.byte):
            self.raw[i] = bytes([b])
        self.clear()

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * _BASE + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def clear(self) -> None:
        self.last: dict[str, int] = {}  # word -> number of its last state
        self.draw = np.empty(0)  # state + cumulated probability of its edges
        self.piece = np.empty(0, np.int32)  # id, or -1 - code point for a character in bytes
        self.source = np.empty(0, np.int32)  # state the edge comes from, -1 at the word's start
        self.head = np.empty(0, np.int32)  # a state's first edge
        self.edges = self.states = 0

    def add(self, words: list[str]) -> None:
        """Filter new words forward, all at once.

        A state is a place of a word after one of its characters; its edges are the pieces
        that end there. Places are filtered in order, each for all words that reach it.
        """
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(sizes) - sizes
        n = len(points)
        place = np.arange(n) - np.repeat(starts, sizes)
        left = np.repeat(sizes, sizes) - place
        hidden = np.repeat(np.array([isinstance(w, _Own) for w in words], bool), sizes)
        value = np.zeros(n, np.uint64)
        begins, ends, ids = [], [], []
        at = np.flatnonzero(~hidden)
        single = np.zeros(n, bool)
        for size, (hashes, own) in enumerate(self.by_length, 1):
            at = at[left[at] >= size]
            if not len(at):
                break
            value[at] = value[at] * np.uint64(_BASE) + (points[at + size - 1] + 1).astype(np.uint64)
            k = np.minimum(np.searchsorted(hashes, value[at]), len(hashes) - 1)
            hit = hashes[k] == value[at]
            at, k = at[hit], own[k[hit]]  # where no piece begins alike, no longer one does
            hit = k >= 0
            begins.append(at[hit])
            ends.append(at[hit] + size - 1)
            ids.append(k[hit])
            if size == 1:
                single[at[hit]] = True
        spelled = np.flatnonzero(~single)
        begins.append(spelled)
        ends.append(spelled)
        ids.append(-1 - points[spelled])
        begin, end, piece = (np.concatenate(x) for x in (begins, ends, ids))
        code = -1 - piece
        width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        weight = np.where(piece >= 0, self.weight[np.maximum(piece, 0)], self.byte_weight * width)
        order = np.argsort(end, kind="stable")
        order = order[_by_place(place[end[order]])]
        begin, end, piece, weight = begin[order], end[order], piece[order], weight[order]
        total = np.zeros(n + 1)  # the last entry is the start of every word
        source = np.where(place[begin] > 0, begin - 1, n)
        cuts = np.searchsorted(place[end], np.arange(int(sizes.max(initial=0)) + 1))
        fresh = np.ones(len(end), bool)
        fresh[1:] = end[1:] != end[:-1]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            paths = total[source[a:b]] + weight[a:b]
            heads = np.flatnonzero(fresh[a:b])
            total[end[a:b][heads]] = np.logaddexp.reduceat(paths, heads)
        order = np.argsort(end, kind="stable")
        begin, end, piece, weight, source = (x[order] for x in (begin, end, piece, weight, source))
        heads = np.searchsorted(end, np.arange(n))
        share = np.cumsum(np.exp(total[source] + weight - total[end]))
        before = np.concatenate([[0.0], share])[heads]
        last = np.append(heads[1:], len(end)) - 1
        drawn = (share - before[end]) / (share[last] - before)[end]
        drawn[last] = 1.0
        self.draw = _appended(self.draw, self.edges, self.states + end + np.minimum(drawn, 1.0))
        self.piece = _appended(self.piece, self.edges, piece)
        self.source = _appended(self.source, self.edges, np.where(place[begin] > 0, self.states + begin - 1, -1))
        self.head = _appended(self.head, self.states, self.edges + heads)
        self.last.update(zip(words, (self.states + starts + sizes - 1).tolist(), strict=True))
        self.edges += len(end)
        self.states += n

    def sample(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        """Piece ids of each text."""
        words = [self._words(t) for t in texts]
        if self.edges > _REMEMBERED:
            self.clear()
        new = set().union(*words).difference(self.last) if words else set()
        if new:
            self.add(sorted(new))
        counts = [len(w) for w in words]
        n = sum(counts)
        if not n:
            return [np.empty(0, np.int32)] * len(texts)
        flat = [w for ws in words for w in ws]
        state = np.array(list(map(self.last.__getitem__, flat)), np.int64)
        row = np.repeat(np.arange(len(texts)), counts)
        number = np.arange(n) - np.repeat(np.cumsum([0, *counts[:-1]]), counts)
        key = mix(keys.astype(np.int64).view(np.uint64))[row] + mix(number.astype(np.uint64))
        active, step, found = np.arange(n), 0, []
        while len(active):
            u = (mix(key + np.uint64(step)) >> np.uint64(11)).astype(float) / (1 << 53)
            edge = self._drawn(state, u)
            found.append((active, self.piece[edge]))
            state = self.source[edge].astype(np.int64)
            more = np.flatnonzero(state >= 0)
            active, state, key, step = active[more], state[more], key[more], step + 1
        sizes = np.bincount(np.concatenate([a for a, _ in found]), minlength=n)
        word, stops = np.repeat(np.arange(n), sizes), np.cumsum(sizes)
        ids = np.empty(len(word), np.int64)
        for step, (active, piece) in enumerate(found, 1):  # drawn from a word's end
            ids[stops[active] - step] = piece
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            spelled = {c: [self.byte[b] for b in chr(-1 - c).encode()] for c in set(ids[odd].tolist())}
            sizes = np.ones(len(ids), np.int64)
            sizes[odd] = [len(spelled[c]) for c in ids[odd].tolist()]
            places = np.cumsum(sizes) - sizes
            expanded = np.repeat(ids, sizes)
            for k in odd.tolist():
                expanded[places[k] : places[k] + sizes[k]] = spelled[int(ids[k])]
            ids, word = expanded, np.repeat(word, sizes)
        return np.split(ids.astype(np.int32), np.searchsorted(row[word], np.arange(1, len(texts))))

    def _drawn(self, state: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge that a number from 0 to 1 draws in each state: the first above it."""
        at = np.minimum(state + u, np.nextafter(state + 1.0, 0.0))
        edge = self.head[state].astype(np.int64)
        below = np.flatnonzero(self.draw[edge] <= at)
        while len(below):
            edge[below] += 1
            below = below[self.draw[edge[below]] <= at[below]]
        return edge

    def _words(self, text: str) -> list[str]:
        if not text:
            return []
        if _OWN.search(text):
            # Own marks stand alone, hidden as a character that has no piece.
            parts = _OWN.split(text)
            cut = [p if k % 2 else p.replace(" ", _MARK) for k, p in enumerate(parts)]
            out = [_MARK]
            for k, p in enumerate(cut):
                out += [_Own(p)] if k % 2 else _CHUNK.findall(p)
            return out
        return _CHUNK.findall(_MARK + text.replace(" ", _MARK))

    def decode(self, ids) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode()[1:]


def _appended(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``more`` after the first ``used`` values, in place as long as there is room."""
    if used + len(more) > len(array):
        grown = np.empty(max(used + len(more), 3 * len(array) // 2), array.dtype)
        grown[:used] = array[:used]
        array = grown
    array[used : used + len(more)] = more
    return array


def _by_place(place: np.ndarray) -> np.ndarray:
    """Stable order by place; words are short, and small numbers sort by their bytes."""
    small = place.max(initial=0) < 1 << 16
    return np.argsort(place.astype(np.uint16) if small else place, kind="stable")


class _Own(str):
    """A character of the text that must be spelled in bytes; differs from an equal word."""

    def __hash__(self) -> int:
        return hash(("own", str(self)))

    def __eq__(self, other) -> bool:
        return isinstance(other, _Own) and str.__eq__(self, other)


_lattices: dict = {}


def lattice(path: str, sharpness: float = SHARPNESS) -> Lattice:
    if (path, sharpness) not in _lattices:
        _lattices[path, sharpness] = Lattice(path, sharpness)
    return _lattices[path, sharpness]


def _sample(path: str, sharpness: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(path, sharpness)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = [t or "" for t in part.column("text").to_pylist()]
                keys = np.array([k or 0 for k in part.column("doc_id").to_pylist()], np.int64) ^ np.int64(seed)
                ids = own.sample(texts, keys)
                cuts = np.cumsum([0, *map(len, ids)])
                same = [own.decode(i.tolist()) == t for i, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(ids))), pa.array(same)],
                    names=["doc_id", "ids", "lossless"],
                )

    return run


def sample_pieces(docs: DataFrame, path: str, sharpness: float = SHARPNESS, seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, lossless): sampled piece ids, and whether they decode to the text."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(_sample(path, sharpness, seed), "doc_id long, ids array<int>, lossless boolean")


def decode_pieces(encoded: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """All rows with their text joined from pieces."""
    kept = [c for c in encoded.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(path)
        for batch in batches:
            texts = [own.decode(i) if i else "" for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], names=[*kept, out])

    return encoded.mapInArrow(run, encoded.select(*kept).schema.add(out, "string"))


def op5_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sample_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "lossless")
