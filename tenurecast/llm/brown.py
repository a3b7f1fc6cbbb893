"""LM scoring with Brown class-based n-grams.

P(word | word before) = P(class | class before) * P(word | class). Words are known by a
64-bit hash. All that occur ``LEAST`` times in training get classes by exchange clustering,
in turns until the likelihood of the class bigrams settles: those with at least a share
``FREQUENT`` of the tokens (a bounded number) move one after the other on the driver, all
others in Spark, each to the class that is best for the matrix of class bigrams. Contexts,
counts and classes of the latter are Spark tables that grow with the corpus. Words below
``LEAST`` and unseen ones are put in one of ``RARE_CLASSES`` by their hash. Only matrices of
bounded size reach the driver.

Texts are read once, into blocks: the distinct words of some texts, and all tokens as numbers of
these. What follows is shuffled once for each word of a block, not for each token.

Neighbours are counted once: pairs of frequent words, and for every other word the frequent
words beside it; there, a neighbour that is not frequent stands as its hash class, so while
classes are searched, two such words side by side count once for each. A turn only maps these
counts to classes. Blocks meet the final classes in one join, from which the transitions of
the model are counted anew. Tables that nothing reads any more are deleted on the way.

Both factors are smoothed: transitions by a share of the class's own frequency, emissions
by one count for every word of the class and one for an unseen word.

Every text ends in an end token, a class by itself, and starts after one; a null or empty
text is the end token alone. Rows are scored one by one, so repeated rows score alike.
Without training rows every count is zero and all words are unknown.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurecast.llm.common import chunks, fold, longs, table, text_buffer, words
from tenurecast.session import delete_folder, new_path, shuffles_removed

#: Occurrences from which a word is clustered, the share of the tokens from which it is so on
#: the driver, and the numbers of classes.
LEAST, FREQUENT, CLASSES, RARE_CLASSES = 5, 1 / 16384, 32, 8
#: Relative gain of likelihood under which it has settled; half sweeps over the frequent words
#: in a turn, and turns, at most.
SETTLED, SWEEPS, TURNS = 0.001, 12, 6
#: Share of a transition that comes from the class's own frequency.
BACKOFF = 0.05
#: Stands for the end of a text.
END = np.uint64(0x5EED0F7E47E0D000)
#: Bytes of text that are tokenised at once and in a block, contexts in a block of words, entries
#: of a slice of sums; words whose contexts are counted at once, words that move at once, and the
#: largest count of a pair of 16-bit numbers.
CHUNK, BLOCK, ENTRIES, SLICE = 1 << 20, 8 << 20, 1 << 18, 1 << 14
WORDS, MOVED, MOST = 1 << 16, 1 << 12, (1 << 16) - 1
BLOCKS = "doc_ids array<long>, held array<boolean>, sizes binary, words binary, ns binary, codes binary"
CLASSED = "kind int, words binary, c binary, cls binary, sizes binary, contexts binary, ns binary"
DONE = "doc_ids array<long>, held array<boolean>, sizes binary, ids binary, more_known binary, gain binary"
SLICES = "slot int, at binary, n binary"


def _tokens(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a chunk in order, each row closed by the end token, and their number in every row."""
    doc, _, _, hashes = words(data, offsets)
    size = np.bincount(doc, minlength=part.num_rows) + 1
    out = np.full(len(hashes) + part.num_rows, END)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(size) - 1] = False
    out[inside] = hashes
    return out, size


def _binary(cuts: np.ndarray, values: np.ndarray) -> pa.Array:
    """Slices of an array as bytes, one for each pair of cuts."""
    offsets = pa.py_buffer(np.ascontiguousarray(cuts * values.dtype.itemsize, np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _row(**columns) -> pa.RecordBatch:
    """One row; arrays as bytes, others as they are."""
    whole = [x if isinstance(x, pa.Array) else _binary(np.array([0, len(x)]), x) for x in columns.values()]
    return pa.RecordBatch.from_arrays(whole, names=list(columns))


def _array(batch, column: str, row: int, dtype) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), dtype)


def _planes(codes: np.ndarray) -> np.ndarray:
    """Numbers with their high bytes apart, which are nearly all zero and so take no room on disk."""
    parts = codes.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.concatenate([parts[:, :2].reshape(-1), parts[:, 2], parts[:, 3]])


def _codes(batch, row: int) -> np.ndarray:
    raw = _array(batch, "codes", row, np.uint8)
    n = len(raw) // 4
    codes = raw[: 2 * n].view("<u2").astype(np.int32)
    codes += raw[2 * n : 3 * n].astype(np.int32) << 16
    return codes + (raw[3 * n :].astype(np.int32) << 24)


def _listed(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a block of texts: its distinct words with their counts in training, and all
    tokens in order as numbers of these words."""

    def block(parts: list) -> pa.RecordBatch:
        ids, held = (pa.concat_arrays([p[i] for p in parts]) for i in (0, 1))
        tokens, size = (np.concatenate([p[i] for p in parts]) for i in (2, 3))
        known = pa.array(tokens).dictionary_encode()
        code = known.indices.to_numpy(zero_copy_only=False)
        taught = ~held.fill_null(False).to_numpy(zero_copy_only=False)
        word = known.dictionary.to_numpy(zero_copy_only=False)
        n = np.bincount(code[np.repeat(taught, size)], minlength=len(word))
        return _row(doc_ids=_listed(ids), held=_listed(held), sizes=size.astype("<i8"), words=word, ns=n.astype("<i8"), codes=_planes(code))

    parts, read = [], 0
    for part, data, offsets in chunks(batches, "text", CHUNK):
        parts.append((part.column("doc_id"), part.column("held_out"), *_tokens(part, data, offsets)))
        read += len(data)
        if read >= BLOCK:
            yield block(parts)
            parts, read = [], 0
    if parts:
        yield block(parts)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            word, n = _array(batch, "words", i, np.uint64), _array(batch, "ns", i, "<i8")
            yield pa.RecordBatch.from_arrays([longs(word[n > 0]), pa.array(n[n > 0], pa.int64())], names=["word", "n"])


def _numbers(known: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The number of each frequent word, -1 for others."""
    at = np.minimum(np.searchsorted(known, word), len(known) - 1)
    return np.where(known[at] == word, at, -1)


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct words, numbers of the training tokens in order) of every block."""
    for batch in batches:
        for i in range(batch.num_rows):
            held = batch.column("held")[i].values.fill_null(False).to_numpy(zero_copy_only=False)
            taught = np.repeat(~held, _array(batch, "sizes", i, "<i8"))
            yield _array(batch, "words", i, np.uint64), _codes(batch, i)[taught]


def _before(ids: np.ndarray, end: int) -> np.ndarray:
    """The id before each; every row ends in the end token and starts after one."""
    return np.concatenate([np.array([end], ids.dtype), ids[:-1]])[: len(ids)]


def _pairs(known, end: int):
    """(a, b, n) of every block: how often frequent word ``b`` follows frequent word ``a``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = len(known.value)
        for word, codes in _training(batches):
            ids = _numbers(known.value, word)[codes]
            before = _before(ids, end)
            both = (ids >= 0) & (before >= 0)
            code, n = np.unique(before[both] * f + ids[both], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(code // f, pa.int32()), pa.array(code % f, pa.int32()), pa.array(n, pa.int64())], names=["a", "b", "n"]
            )

    return run


def _packed(names: list[str]):
    """Rows of whole numbers as one row of bytes a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _row(**{c: batch.column(c).to_numpy(zero_copy_only=False) for c in names})

    return run


def _contexts(classes, width: int, total: int):
    """Class contexts, right and left, of the ids in one task's pairs; a context from ``width`` on stands before the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = classes.value
        side = np.concatenate([kind, total + kind])
        sums, same = np.zeros(width * 2 * total), np.zeros(width)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, context, n = _array(batch, "id", i, "<i4"), _array(batch, "context", i, "<i4"), _array(batch, "n", i, "<i8")
                sums += np.bincount(ids.astype(np.int64) * (2 * total) + side[context], weights=n, minlength=len(sums))
                itself = ids == context
                same += np.bincount(ids[itself], weights=n[itself], minlength=width)
        sums = sums.reshape(width, 2 * total).astype(np.int64)
        at = np.flatnonzero(sums.any(axis=1))
        yield _row(at=at.astype("<i8"), same=same[at].astype("<i8"), sums=sums[at].reshape(-1))

    return run


def _sliced(sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The entries of one task's sums that are not zero, in slices that are added up apart."""
    at = np.flatnonzero(sums)
    slot = at // SLICE
    for k in np.unique(slot):
        mine = at[slot == k]
        yield _row(slot=pa.array([k], pa.int32()), at=(mine - k * SLICE).astype("<i8"), n=sums[mine].astype("<i8"))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, k in enumerate(batch.column("slot").to_pylist()):
            mine = sums.setdefault(k, np.zeros(SLICE, np.int64))
            mine[_array(batch, "at", i, "<i8")] += _array(batch, "n", i, "<i8")
    for k, mine in sums.items():
        at = np.flatnonzero(mine)
        yield _row(slot=pa.array([k], pa.int32()), at=at.astype("<i8"), n=mine[at])


def _summed(slices: DataFrame, size: int) -> np.ndarray:
    """The sums of all tasks, of a bounded number of entries."""
    out = np.zeros(size, np.int64)
    for r in slices.repartition("slot").mapInArrow(_added, SLICES).collect():
        out[r["slot"] * SLICE + np.frombuffer(r["at"], "<i8")] = np.frombuffer(r["n"], "<i8")
    return out


def _transitions(kind: np.ndarray, end: np.ndarray, total: int):
    """(before, after, n) of one task: its class bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(total * total, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column("held")[i].values.fill_null(False).to_numpy(zero_copy_only=False)
                ids = _array(batch, "ids", i, "<u2")[np.repeat(~held, _array(batch, "sizes", i, "<i8"))].astype(np.int64)
                sums += np.bincount(kind[_before(ids, end)] * total + kind[ids], minlength=total * total)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at // total, pa.int32()), pa.array(at % total, pa.int32()), pa.array(sums[at])], names=["a", "b", "n"]
        )

    return run


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(right: np.ndarray, left: np.ndarray, same: np.ndarray, kind: np.ndarray, fixed: np.ndarray, classes: int, parity: int) -> np.ndarray:
    """One sweep over the free ids of one parity: each moves to the class that is best for
    the likelihood of the class bigrams, which are kept up to date from word to word."""
    total = right.shape[1]
    kind = kind.copy()
    m = np.zeros((total, total))
    np.add.at(m, kind, right)
    order = np.argsort(-right.sum(axis=1), kind="stable")
    for w in order.tolist():
        if fixed[w] or w % 2 != parity:
            continue
        old, s = int(kind[w]), float(same[w])
        r, c = right[w].astype(float), left[w].astype(float)
        if not r.sum() + c.sum():
            continue
        r[old] -= s
        c[old] -= s
        m[old, :] -= r
        m[:, old] -= c
        m[old, old] -= s
        rows, cols = m[:classes], m[:, :classes]
        gain = (_f(rows + r) - _f(rows)).sum(axis=1) + (_f(cols + c[:, None]) - _f(cols)).sum(axis=0)
        k = np.arange(classes)
        d = m[k, k]
        gain += _f(d + r[k] + c[k] + s) - _f(d) - (_f(d + r[k]) - _f(d)) - (_f(d + c[k]) - _f(d))
        out, into = rows.sum(axis=1), cols.sum(axis=0)
        gain -= _f(out + r.sum() + s) - _f(out) + _f(into + c.sum() + s) - _f(into)
        best = int(gain.argmax())
        if gain[best] <= gain[old] + 1e-9:
            best = old
        kind[w] = best
        m[best, :] += r
        m[:, best] += c
        m[best, best] += s
    return kind


def likelihood(m: np.ndarray) -> float:
    """Of the class bigrams, but for a part that no move changes."""
    return float(_f(m).sum() - _f(m.sum(axis=1)).sum() - _f(m.sum(axis=0)).sum())


def _neighbours(known, total: int, end: int):
    """(word, near) of every block for all words that are not frequent: pairs of a context and its count, as bytes.

    A word is one row of a block, so it is shuffled once for all its contexts. A context is the
    id after the word, or ``width`` and the id before it: that of a frequent word, or one that
    stands for the hash class of any other. Both numbers take 16 bits: a larger count is told in
    several pairs, and contexts are at most twice 1 / FREQUENT and the classes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = len(known.value)
        width = f + total
        for word, codes in _training(batches):
            number = _numbers(known.value, word)
            seldom = number < 0
            ids = np.where(seldom, f + CLASSES + (word % np.uint64(RARE_CLASSES)).astype(np.int64), number).astype("<u2")
            context = ids[codes]
            before = _before(context, end)
            for first in range(0, len(word), WORDS):
                at = np.flatnonzero(seldom[codes] & (codes >= first) & (codes < first + WORDS))
                mine = codes[at].astype(np.int64) * (2 * width)
                # A row ends in the end token, so every other token has one after it.
                pair, n = np.unique(np.concatenate([mine + context[at + 1], mine + width + before[at]]), return_counts=True)
                if len(n) and n.max() > MOST:
                    times = -(-n // MOST)
                    last = np.cumsum(times) - 1
                    pair, rest = np.repeat(pair, times), n - (times - 1) * MOST
                    n = np.full(len(pair), MOST)
                    n[last] = rest
                owner = pair // (2 * width)
                new = np.flatnonzero(np.diff(owner, prepend=-1))
                near = np.stack([pair % (2 * width), n], axis=1).astype("<u2").reshape(-1)
                cuts = 2 * np.append(new, len(pair))
                yield pa.RecordBatch.from_arrays([longs(word[owner[new]]), _binary(cuts, near)], names=["word", "near"])

    return run


def _merged(f: int, total: int):
    """All counts of a word together, from rows sorted by word.

    Gives blocks of words that get a class (kind 1), blocks of seldomer ones (kind 0) and the
    contexts of the latter, summed up by hash class (kind 2, ``c`` holding the slice and ``words``
    the sums).
    """
    width = f + total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone = np.zeros(total * 2 * width, np.int64)
        parts: dict[int, list] = {0: [], 1: []}
        held = np.zeros(2, np.int64)

        def merge(word: np.ndarray, size: np.ndarray, near: np.ndarray) -> None:
            first = np.ones(len(word), bool)
            first[1:] = word[1:] != word[:-1]
            key = np.repeat(np.cumsum(first) - 1, size) * (2 * width) + near[:, 0].astype(np.int64)
            order = np.argsort(key, kind="stable")
            key, n = key[order], near[order, 1].astype(np.int64)
            heads = np.flatnonzero(np.diff(key, prepend=-1))
            key, n = key[heads], np.add.reduceat(n, heads)
            owner, context, word = key // (2 * width), key % (2 * width), word[first]
            # Every occurrence has one token after it.
            after = context < width
            c = np.bincount(owner[after], weights=n[after], minlength=len(word)).astype(np.int64)
            grows = c >= LEAST
            cls = np.where(grows, word % np.uint64(CLASSES), CLASSES + word % np.uint64(RARE_CLASSES)).astype(np.int64)
            lone = ~grows[owner]
            np.add.at(alone, cls[owner[lone]] * (2 * width) + context[lone], n[lone])
            sizes = np.bincount(owner, minlength=len(word))
            parts[0].append((word[~grows], c[~grows], cls[~grows]))
            parts[1].append((word[grows], c[grows], cls[grows], sizes[grows], context[~lone], n[~lone]))
            held[0] += np.count_nonzero(~grows)
            held[1] += np.count_nonzero(~lone)

        def block(kind: int) -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*parts[kind], strict=True)]
            parts[kind], held[kind] = [], 0
            columns += [np.zeros(0, np.int64)] * (6 - len(columns))
            return _classed(kind, *columns)

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = text_buffer(batch.column("near"))
            part = [batch.column("word").to_numpy(zero_copy_only=False).view(np.uint64), np.diff(offsets) // 4, data.view("<u2").reshape(-1, 2)]
            if rest is not None:
                part = [np.concatenate(x) for x in zip(rest, part, strict=True)]
            word, size, near = part
            cut = int(np.flatnonzero(word == word[-1])[0])
            at = int(size[:cut].sum())
            rest = [word[cut:], size[cut:], near[at:]]
            if cut:
                merge(word[:cut], size[:cut], near[:at])
            for kind in (0, 1):
                if held[kind] >= ENTRIES:
                    yield block(kind)
        if rest is not None:
            merge(*rest)
            for kind in (0, 1):
                yield block(kind)
        for part in _sliced(alone):
            nothing = np.zeros(0, np.int64)
            yield _classed(2, _array(part, "n", 0, "<i8"), part.column("slot").to_numpy(), nothing, nothing, _array(part, "at", 0, "<i8"), nothing)

    return run


def _classed(kind: int, word, c, cls, sizes, context, n) -> pa.RecordBatch:
    """A block; a word with less than the share FREQUENT of 7e13 tokens has counts of 32 bits."""
    return _row(
        kind=pa.array([kind], pa.int32()), words=word, c=c.astype("<i8"), cls=cls.astype("u1"), sizes=sizes.astype("<i4"), contexts=context.astype("<u2"), ns=n.astype("<u4")
    )


def _seldom_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _row(slot=pa.array(_array(batch, "c", i, "<i8"), pa.int32()), at=_array(batch, "contexts", i, "<u2").astype("<i8"), n=_array(batch, "words", i, "<i8"))


def _beside(width: int, total: int):
    """Contexts of one task's words, summed up by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(total * 2 * width)
        for batch in batches:
            for i in range(batch.num_rows):
                cls = np.repeat(_array(batch, "cls", i, "u1").astype(np.int64), _array(batch, "sizes", i, "<i4"))
                sums += np.bincount(cls * (2 * width) + _array(batch, "contexts", i, "<u2"), weights=_array(batch, "ns", i, "<u4"), minlength=len(sums))
        yield from _sliced(sums)

    return run


def _gains(m: np.ndarray, part: np.ndarray, old: np.ndarray, classes: int, across: bool) -> np.ndarray:
    """What the bigrams of each class gain by each word, over the classes beside it on one side.

    Words with equally many classes beside them are taken together. ``across``: the class
    stands second in ``m``.
    """
    table = m[:, :classes] if across else np.ascontiguousarray(m[:classes].T)
    plain = _f(np.maximum(table, 0))
    gain = np.zeros((len(part), classes))
    many = np.count_nonzero(part, axis=1)
    for size in np.unique(many[many > 0]).tolist():
        some = np.flatnonzero(many == size)
        step = max(1, (1 << 18) // (size * classes))
        for start in range(0, len(some), step):
            at = some[start : start + step]
            mine = part[at]
            near = np.nonzero(mine)[1].reshape(len(at), size)
            n = np.take_along_axis(mine, near, 1)
            now, was = table[near], plain[near]
            own = np.flatnonzero(old[at] < classes)
            cls = old[at[own]]
            less = np.maximum(now[own, :, cls] - n[own], 0)
            now[own, :, cls], was[own, :, cls] = less, _f(less)
            np.maximum(now, 0, out=now)
            now += n[:, :, None]
            change = _f(now) - was
            gain[at] = change.sum(axis=1) if across else np.ascontiguousarray(change.transpose(0, 2, 1)).sum(axis=2)
    return gain


def best_classes(m: np.ndarray, right: np.ndarray, left: np.ndarray, old: np.ndarray, classes: int) -> np.ndarray:
    """The class of each word that is best for the class bigrams, all other words unmoved.

    ``old`` is the class whose counts in ``m`` hold the word now.
    """
    words_, own = np.arange(len(right)), np.flatnonzero(old < classes)
    gain = _gains(m, right, old, classes, False) + _gains(m, left, old, classes, True)
    r, c = right.sum(axis=1), left.sum(axis=1)
    out = np.tile(m[:classes].sum(axis=1), (len(right), 1))
    into = np.tile(m[:, :classes].sum(axis=0), (len(right), 1))
    out[own, old[own]] -= r[own]
    into[own, old[own]] -= c[own]
    out, into = np.maximum(out, 0), np.maximum(into, 0)
    gain -= _f(out + r[:, None]) - _f(out) + _f(into + c[:, None]) - _f(into)
    best = gain.argmax(axis=1)
    stays = own[gain[own, best[own]] <= gain[own, old[own]] + 1e-9]
    best[stays] = old[stays]
    return best


def _move(shared, total: int, turn: int):
    """All words move in the first turn, half of them, by hash, in each later one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, kind = shared.value
        side = np.concatenate([kind, total + kind])
        for batch in batches:
            for i in range(batch.num_rows):
                word, cls = _array(batch, "words", i, np.uint64), _array(batch, "cls", i, "u1").astype(np.int64)
                sizes, context, n = _array(batch, "sizes", i, "<i4"), _array(batch, "contexts", i, "<u2"), _array(batch, "ns", i, "<u4")
                moving = np.ones(len(word), bool) if turn == 0 else (word.view(np.int64) >> 20) % 2 == turn % 2
                cuts = np.append(0, np.cumsum(sizes))
                for a in range(0, len(word), MOVED):
                    mine = slice(cuts[a], cuts[min(a + MOVED, len(word))])
                    some = a + np.flatnonzero(moving[a : a + MOVED])
                    owner = np.repeat(np.arange(len(sizes[a : a + MOVED])), sizes[a : a + MOVED])
                    sums = np.bincount(owner * (2 * total) + side[context[mine]], weights=n[mine], minlength=len(sizes[a : a + MOVED]) * 2 * total)
                    sums = sums.reshape(-1, 2 * total)[some - a]
                    cls[some] = best_classes(m, sums[:, :total], sums[:, total:], cls[some], CLASSES)
                yield _classed(1, word, _array(batch, "c", i, "<i8"), cls, sizes, context, n)

    return run


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            columns = [longs(_array(batch, "words", i, np.uint64)), pa.array(_array(batch, "cls", i, "u1"), pa.int32()), pa.array(_array(batch, "c", i, "<i8"), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "cls", "c"])


def _sought(known):
    """(block, place among its words, word) of all words that are not frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                word = _array(batch, "words", i, np.uint64)
                at = np.flatnonzero(_numbers(known.value, word) < 0)
                columns = [pa.array(np.full(len(at), block), pa.int64()), pa.array(at, pa.int32()), longs(word[at])]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "place", "word"])

    return run


def _numbered(known):
    """Blocks with the id of each distinct word: its number if it is frequent, or one for its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = len(known.value)
        for batch in batches:
            for i in range(batch.num_rows):
                word = _array(batch, "words", i, np.uint64)
                number = _numbers(known.value, word)
                ids = np.where(number >= 0, number, f + (word % np.uint64(CLASSES)).astype(np.int64)).astype("<u2")
                block = batch.slice(i, 1)
                whole = {c: block.column(c) for c in ("block", "doc_ids", "held", "sizes", "codes")}
                yield _row(**whole, ids=ids)

    return run


def _settled(f: int):
    """A block's tokens as ids of the model, with what the words that are not frequent add to each row.

    Ids: frequent words, hashes of rare and unseen words, and one for all other words of each class.
    """

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        ids = _array(block, "ids", 0, "<u2").copy()
        at, c = (found.column(x).to_numpy() for x in ("place", "classed"))
        cls, c = c % 64, c // 64
        ids[at[cls < CLASSES]] = f + CLASSES + cls[cls < CLASSES]
        met, gain = np.zeros(len(ids), np.int8), np.zeros(len(ids))
        met[at], gain[at] = 1, np.log10(c + 1.0)
        codes, sizes = _codes(block, 0), _array(block, "sizes", 0, "<i8")
        starts = np.cumsum(sizes) - sizes
        doc_ids, held = (block.column(x)[0].values for x in ("doc_ids", "held"))
        out = _row(
            doc_ids=_listed(doc_ids), held=_listed(held), sizes=sizes, ids=ids[codes],
            more_known=np.add.reduceat(met[codes], starts, dtype=np.int64), gain=np.add.reduceat(gain[codes], starts),
        )
        return pa.Table.from_batches([out])

    return run


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        kind, step, emit, base = own["class"], own["step"], own["emit"], own["base"]
        for batch in batches:
            for i in range(batch.num_rows):
                n, ids = _array(batch, "sizes", i, "<i8"), _array(batch, "ids", i, "<u2").astype(np.int64)
                starts, c = np.cumsum(n) - n, kind[ids]
                total = lambda x: np.add.reduceat(x, starts)  # noqa: B023, E731
                known = total(own["common"][ids]) + _array(batch, "more_known", i, "<i8")
                gain = _array(batch, "gain", i, "<f8")
                score, plain = total(step[kind[_before(ids, own["end"])], c] + emit[ids]) + gain, total(base[ids]) + gain
                names = ["doc_id", "held_out", "n_tokens", "n_known", "score", "base"]
                columns = [batch.column(x)[i].values for x in ("doc_ids", "held")]
                columns += [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(score, pa.float64()), pa.array(plain, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def score_texts(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, base score and class-based score of every row; rows held out teach nothing."""
    spark = docs.sparkSession
    context = spark.sparkContext

    def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = new_path(spark, label)
        with shuffles_removed(spark):
            df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    docs = docs.select(F.col(key).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    blocks = docs.mapInArrow(_blocks, BLOCKS)
    blocks, blocks_path = stored(blocks.select(F.monotonically_increasing_id().alias("block"), "*"), "brown-blocks")
    counts = blocks.select("words", "ns").mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts, counts_path = stored(counts, "brown-counts")
    n, v = (int(x or 0) for x in counts.agg(F.sum("n"), F.count("*")).first())
    end = int(END.astype(np.int64))
    # At most 1 / FREQUENT words have such a share.
    common = counts.filter((F.col("n") >= max(LEAST, n * FREQUENT)) | (F.col("word") == end)).collect()
    delete_folder(spark, counts_path)
    number = dict(sorted((int(np.int64(r["word"]).astype(np.uint64)), r["n"]) for r in common))
    number.setdefault(int(END), 0)
    known = np.array(sorted(number), np.uint64)
    shared_known = context.broadcast(known)

    # Classes: 0 .. CLASSES - 1 by exchange, then the rare ones, then the end. While classes are
    # searched, ids are those of frequent words, then one for all other words of each class.
    f, total = len(known), CLASSES + RARE_CLASSES + 1
    width = f + total
    end_id = int(np.searchsorted(known, END))
    often = np.array([number[int(w)] for w in known], float)
    kind = np.empty(width, np.int64)
    kind[np.argsort(-often, kind="stable")] = np.arange(f) % CLASSES
    kind[f:] = np.arange(total)
    kind[end_id] = total - 1
    fixed = np.zeros(width, bool)
    fixed[f:] = fixed[end_id] = True

    taught = blocks.select("held", "sizes", "words", "codes")
    pairs = taught.mapInArrow(_pairs(shared_known, end_id), "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    # Both directions of a pair; an id's pairs lie together, so a task gives one sum for each of its ids.
    both = F.inline(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("context"), "n"), F.struct(F.col("b").alias("id"), (F.col("a") + width).alias("context"), "n")))
    pairs = pairs.select(both).repartition("id").mapInArrow(_packed(["id", "context", "n"]), "id binary, context binary, n binary")
    pairs, _ = stored(pairs, "brown-pairs")

    # All other words, in the class that their hash gives until they have one of their own.
    # Counted per block already; no word here has more than the share FREQUENT of the tokens.
    near = taught.mapInArrow(_neighbours(shared_known, total, end_id), "word long, near binary")
    near = near.repartition("word").sortWithinPartitions("word").mapInArrow(_merged(f, total), CLASSED)
    near, near_path = stored(near, "brown-contexts")
    growing, growing_path = near.filter("kind = 1"), None

    def contexts(beside: np.ndarray, kind: np.ndarray):
        """Right and left class contexts of every id: pairs of frequent words, then ``beside``."""
        right, left, same = np.zeros((width, total), np.int64), np.zeros((width, total), np.int64), np.zeros(width, np.int64)
        for r in pairs.mapInArrow(_contexts(context.broadcast(kind), width, total), "at binary, same binary, sums binary").collect():
            at, sums = np.frombuffer(r["at"], "<i8"), np.frombuffer(r["sums"], "<i8").reshape(-1, 2 * total)
            right[at] += sums[:, :total]
            left[at] += sums[:, total:]
            same[at] += np.frombuffer(r["same"], "<i8")
        after, before = beside[:, :width], beside[:, width:]
        for k in range(total):
            of = kind == k
            right[f:, k] += after[:, of].sum(axis=1)
            left[f:, k] += before[:, of].sum(axis=1)
        right += before.T
        left += after.T
        return right, left, same

    def bigrams(right: np.ndarray, kind: np.ndarray) -> np.ndarray:
        m = np.zeros((total, total))
        np.add.at(m, kind, right)
        return m

    def exchanged(beside: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes of the frequent words after sweeps until settled, and their class bigrams."""
        right, left, same = contexts(beside, kind)
        best, m = kind, bigrams(right, kind)
        start = likelihood(m)
        for sweep in range(SWEEPS):
            kind = exchange(right, left, same, kind, fixed, CLASSES, sweep % 2)
            right, left, same = contexts(beside, kind)
            now = bigrams(right, kind)
            if likelihood(now) > likelihood(m):
                best, m = kind, now
            if sweep % 2:
                if likelihood(m) - start <= SETTLED * abs(start):
                    break
                start = likelihood(m)
        return best, m

    alone = _summed(near.filter("kind = 2").mapInArrow(_seldom_slices, SLICES), total * 2 * width)
    best = None
    for turn in range(TURNS):
        beside = _summed(growing.mapInArrow(_beside(width, total), SLICES), total * 2 * width)
        some = beside.any()
        kind, m = exchanged((alone + beside).reshape(total, 2 * width), kind)
        value = likelihood(m)
        if turn and value <= best[0]:
            break
        settled = turn and value - best[0] <= SETTLED * abs(best[0])
        if best and best[3]:
            delete_folder(spark, best[3])
        best = (value, kind, growing, growing_path)
        if settled or not some or turn == TURNS - 1:
            break
        growing, growing_path = stored(growing.mapInArrow(_move(context.broadcast((m, kind)), total, turn), CLASSED), "brown-contexts")
    _, kind, growing, _ = best
    own = ["words", "cls", "c"]
    others = growing.select(own).unionByName(near.filter("kind = 0").select(own)).mapInArrow(_word_rows, "word long, cls int, c long")
    others, _ = stored(others, "brown-words")
    for path in {near_path, best[3], growing_path} - {None}:
        delete_folder(spark, path)

    # Texts with the classes of all words: a word is looked up once for every block that has it.
    kinds = f + 2 * CLASSES
    kind = np.concatenate([kind[:f], CLASSES + np.arange(CLASSES) % RARE_CLASSES, np.arange(CLASSES)])
    sought = blocks.select("block", "words").mapInArrow(_sought(shared_known), "block long, place int, word long")
    # Class and count in one number: classes are fewer than 64.
    found = sought.join(others, "word").select("block", "place", (F.col("c") * 64 + F.col("cls")).alias("classed"))
    numbered = blocks.drop("ns").mapInArrow(_numbered(shared_known), "block long, doc_ids array<long>, held array<boolean>, sizes binary, codes binary, ids binary")
    done = numbered.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_settled(f), DONE)
    done, _ = stored(done, "brown-done")
    delete_folder(spark, blocks_path)
    m = np.zeros((total, total))
    steps = done.select("held", "sizes", "ids").mapInArrow(_transitions(kind, end_id, total), "a int, b int, n long")
    for r in steps.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        m[r["a"], r["b"]] = r["n"]
    into = m.sum(axis=0) + 1
    share = into / into.sum()
    step = np.log10((1 - BACKOFF) * (m + share) / (m.sum(axis=1, keepdims=True) + 1) + BACKOFF * share)
    # Words and tokens of each class; a rare class also has room for an unseen word.
    in_class = np.bincount(kind[:f], weights=often, minlength=total)
    size = np.bincount(kind[:f], minlength=total).astype(float)
    for r in others.groupBy("cls").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        in_class[r["cls"]] += r["n"]
        size[r["cls"]] += r["v"]
    emit = np.zeros(kinds)
    emit[:f] = np.log10((often + 1) / (in_class + size + 1)[kind[:f]])
    emit[f:] = -np.log10((in_class + size + 1)[kind[f:]])  # the word's own count is added below
    base = np.zeros(kinds)
    base[:f] = np.log10(often + 1)
    is_common = np.zeros(kinds, np.int64)
    is_common[:f] = often > 0
    shared = context.broadcast({"class": kind, "step": step, "emit": emit, "base": base, "common": is_common, "end": end_id})
    scored = done.mapInArrow(_score(shared), "doc_id long, held_out boolean, n_tokens long, n_known long, score double, base double")
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"),
        "score",
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op9_class_ngram_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, fold("doc_id", 7) == 2)
