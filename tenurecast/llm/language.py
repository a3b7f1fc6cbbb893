"""Language ID: averaged hashed subword embeddings under a linear softmax.

Every run of one to three letters or word boundaries is hashed to one of ``BUCKETS``
rows of an embedding table; the mean row of a text goes through a linear softmax. Both
are trained together by stochastic gradient descent. As the mean is linear, scoring adds
up one row of ``embeddings @ weights`` per subword, for whole texts of any length.

Confidence is calibrated on rows held back from the fit: a temperature by likelihood,
then the score below which a text is rejected.

Null text, or one without a letter: language ``und``, score 0, rejected. No labelled row
at all: every text is ``und``. Repeated rows are scored alike; other columns are untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurecast.llm.common import fold, mix, table

#: Rows of the embedding table, its width, and the labelled rows per language used to fit.
BUCKETS, WIDTH, ROWS_PER_LANGUAGE = 4096, 16, 600
#: Share of rightly named held-back rows that rejection may cost.
REJECTED_SHARE = 0.002
UNKNOWN = "und"
#: Subwords that halve the doubt about a text.
EVIDENCE = 20
#: Code points handled at once.
PIECE = 1 << 19
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def subwords(text: str) -> Iterator[np.ndarray]:
    """Buckets of all subwords of a text, in pieces; neighbouring pieces share two places."""
    for start in range(0, max(len(text), 1), PIECE):
        points = np.frombuffer(
            (" " + text[max(start - 2, 0) : start + PIECE].lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32
        ).astype(np.uint64)
        letter = (points >= 0xC0) | ((points >= 97) & (points <= 122))
        points = np.where(letter, points, 0)
        one, two = points, points[:-1] * np.uint64(0x110001) + points[1:]
        three = two[:-1] * np.uint64(0x110003) + points[2:]
        found = [one[letter], two[letter[:-1] | letter[1:]] ^ np.uint64(1 << 60), three[letter[1:-1]] ^ np.uint64(1 << 61)]
        yield (mix(np.concatenate(found)) % np.uint64(BUCKETS)).astype(np.int64)


def histogram(text: str) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(BUCKETS, np.int64)
    for piece in subwords(text):
        total += np.bincount(piece, minlength=BUCKETS)
    places = np.flatnonzero(total)
    return places, total[places] / max(total.sum(), 1)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # bucket -> logits, before the temperature
    bias: np.ndarray
    temperature: float
    threshold: float

    def score(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        total, n = np.zeros(len(self.languages)), 0
        for piece in subwords(text):
            total += np.bincount(piece, minlength=BUCKETS) @ self.table
            n += len(piece)
        # Few subwords are little evidence: the score moves towards an even guess.
        logits = (total / max(n, 1) + self.bias) / self.temperature * (n / (n + EVIDENCE))
        p = softmax(logits[None, :])[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(lang, *histogram(text)) for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True) if has_letter(text)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1].tolist() for r in rows], pa.list_(pa.int64())),
                pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64())),
            ],
            names=["lang", "places", "shares"],
        )


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = ROWS_PER_LANGUAGE) -> Model:
    """Train on up to ``rows`` labelled texts per language, those whose key hashes lowest.

    Tasks turn texts into subword shares; the driver gets ``rows`` sparse rows per language.
    """
    known = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("h"), F.col(key).alias("key")
    )
    # The hash below which a language has enough rows, so that no text is sorted.
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = tuple(sorted(counts))
    if not names:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    share = F.lit(0.0)
    for name in names:
        share = F.when(F.col(lang) == name, F.lit(min(1.0, rows / counts[name]))).otherwise(share)
    unit = F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (unit < share))
    sample = chosen.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    got = sample.mapInArrow(_features, "lang string, places array<long>, shares array<double>").collect()
    got.sort(key=lambda r: (r["lang"], r["places"], r["shares"]))
    if not got:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    x = np.zeros((len(got), BUCKETS), np.float32)
    y = np.array([names.index(r["lang"]) for r in got])
    for i, r in enumerate(got):
        x[i, r["places"]] = r["shares"]
    return _train(x, y, names)


def _train(x: np.ndarray, y: np.ndarray, names: tuple[str, ...], epochs: int = 30, rate: float = 0.5, batch: int = 32) -> Model:
    random = np.random.default_rng(7)
    order = random.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    scale = np.sqrt(BUCKETS)  # shares are small: a larger input unit lets one rate serve both layers
    embed = random.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weight = random.normal(0, 0.1, (WIDTH, len(names))).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    balance = len(y) / (len(names) * np.maximum(np.bincount(y, minlength=len(names)), 1))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for rows in np.array_split(random.permutation(used), max(1, len(used) // batch)):
            if not len(rows):
                continue
            xs = x[rows] * scale
            hidden = xs @ embed
            p = softmax(hidden @ weight + bias)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= balance[y[rows], None] / len(rows)
            back = p @ weight.T
            weight -= step * (hidden.T @ p)
            bias -= step * p.sum(axis=0)
            embed -= step * (xs.T @ back)
    rows = (embed * scale).astype(np.float64) @ weight.astype(np.float64)
    held = held if len(held) else order
    logits = x[held].astype(np.float64) @ rows + bias
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.2, 20, 61):
        loss = -np.log(softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12).mean()
        if loss < best - 1e-9:
            best, temperature = loss, float(t)
    p = softmax(logits / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y[held]])
    threshold = float(right[int(REJECTED_SHARE * len(right))]) if len(right) else 0.0
    return Model(names, rows, bias.astype(np.float64), temperature, min(threshold, 0.5))


def identify(df: DataFrame, model: Model, text: str = "text", out: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """All rows with language, score and rejection; existing columns of these names are replaced."""
    kept = [c for c in df.columns if c not in out]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.score(t.as_py()) for t in batch.column(text)]
            extra = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *extra], names=[*kept, *out])

    schema = df.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name, kind in zip(out, ("string", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)
    return df.mapInArrow(run, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", fold("doc_id", 5) == 0)
    model = fit(docs.filter(~F.col("held_out")))
    found = identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")
