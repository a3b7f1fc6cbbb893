"""Source divergence audit with in-mapper stripes.

Every task folds whole documents into hash stripes: a term of a language holds the number of
its documents and its occurrences by source. When the stripes of a task hold ``SPILL``
entries they are spilled as rows and begun anew; Spark merges them by language and term, so
a term that all documents share is one row per task and spill, not one per document. The
empty term, which no text has, counts the documents of every group.

A merged stripe is whole, so it emits its divergences by itself: for each source of its
language against each other, and against the language. Stripes meet the totals of their
language bucket by bucket (``BUCKET`` terms at most, about), so a hot language is many
groups. A stripe's sources with occurrences are compared with all others; what two sources
without the term give is a constant per pair of sources, added once per term kept.

p = 1 + floor(10**9 (count + 1) / (N + V)) and floor((p - q)**2 / q) are computed in whole
numbers, by long division.

Null text, language and source are read as ''. Texts without terms still make their group
occur. Ties of a value rank by the item's UTF-8 bytes. Repeated rows count each; very long
texts are folded part by part. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenurecast.llm.common import table
from tenurecast.session import staged

#: Documents that a kept term is in, ranks of terms, and the scale of p.
LEAST, RANKS, SCALE = 3, 200, 10**9
#: Entries of a task's stripes before they spill, terms in a bucket, and bytes folded at once.
SPILL, BUCKET, PART = 400_000, 20_000, 1 << 20

# Bytes of terms (letters of ASCII and all of other characters) with A-Z in
# lower case; all others part them.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


# ---- stripes ---------------------------------------------------------------


def terms(text: str) -> Iterator[list[bytes]]:
    """Terms of a text, part by part, cut between terms."""
    data = text.encode().translate(_LETTERS)
    at = 0
    while len(data) - at > PART:
        cut = data.find(b" ", at + PART)
        if cut < 0:
            break
        yield data[at:cut].split()
        at = cut
    yield data[at:].split()


def _fold(spill: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[tuple[str, bytes], list] = {}  # (language, term) -> [documents, {source: count}]
        entries = 0
        for batch in batches:
            for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source")), strict=True):
                found: Counter[bytes] = Counter()
                for some in terms(text):
                    found.update(some)
                found[b""] = 1
                for term, n in found.items():
                    stripe = stripes.get((lang, term))
                    if stripe is None:
                        stripes[lang, term] = [1, {source: n}]
                        entries += 1
                        continue
                    stripe[0] += 1
                    counts = stripe[1]
                    if source in counts:
                        counts[source] += n
                    else:
                        counts[source] = n
                        entries += 1
                if entries >= spill:
                    yield from _spilled(stripes)
                    stripes, entries = {}, 0
        yield from _spilled(stripes)

    return run


_STRIPE = "lang string, term string, docs long, sources array<string>, counts array<long>"


def _spilled(stripes: dict, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    keys, values = list(stripes), list(stripes.values())
    for at in range(0, len(keys), rows):
        some, stripe = keys[at : at + rows], values[at : at + rows]
        cuts = pa.array(np.cumsum([0, *(len(s[1]) for s in stripe)]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in some], pa.string()),
                pa.array([k[1] for k in some], pa.binary()).cast(pa.string()),
                pa.array([s[0] for s in stripe], pa.int64()),
                pa.ListArray.from_arrays(cuts, pa.array([x for s in stripe for x in s[1]], pa.string())),
                pa.ListArray.from_arrays(cuts, pa.array([n for s in stripe for n in s[1].values()], pa.int64())),
            ],
            names=["lang", "term", "docs", "sources", "counts"],
        )


def stripes(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", spill: int = SPILL) -> DataFrame:
    """(lang, term, docs, stripe): merged stripes; the empty term stands for the documents."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    spilled = plain.mapInArrow(_fold(spill), _STRIPE).repartition("lang", "term")
    counts = F.arrays_zip("sources", "counts")
    flat = spilled.select("lang", "term", "docs", F.posexplode(counts).alias("k", "c"))
    # All of a term's rows are in one partition by now: no more exchange for either sum.
    flat = flat.select("lang", "term", F.when(F.col("k") == 0, F.col("docs")).otherwise(0).alias("docs"), F.col("c.sources").alias("source"), F.col("c.counts").alias("n"))
    merged = flat.groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    return merged.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("stripe"))


# ---- divergences -----------------------------------------------------------


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 (count + 1) / total), digits in groups of three."""
    rest, whole = count + 1, np.zeros(np.broadcast(count, total).shape, np.int64)
    for _ in range(4):
        digit, rest = np.divmod(rest, total)
        whole = 1000 * whole + digit
        rest = rest * 1000
    return whole + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / q); p and q are at most 10**9 + 1."""
    return (p - q) ** 2 // q


#: Compared at once: entries of stripes times sources.
_CELLS = 4_000_000


def _emit(ranks: int):
    def run(rows: pa.Table, totals: pa.Table) -> pa.Table:
        """Sums for every pair of sources, and the dearest terms of each, in one bucket."""
        lang = totals.column("of")[0].as_py()
        order = pa.compute.sort_indices(totals.column("source"))
        totals = totals.take(order)
        names = totals.column("source").to_pylist()
        place = {s: i for i, s in enumerate(names)}
        size = totals.column("n").to_numpy()
        kept = totals.column("kept")[0].as_py()
        out: list[tuple[str, str, str, int]] = []
        width = len(names)
        if not len(rows):
            return _table(lang, out)
        under = size + kept
        absent = share(np.zeros(width, np.int64), under)
        ground = gap(absent[:, None], absent[None, :])
        sums = np.zeros((width, width), np.int64)
        term = rows.column("term").to_pylist()
        stripe = rows.column("stripe").combine_chunks()
        stripe = stripe if isinstance(stripe, pa.Array) else pa.concat_arrays(stripe.chunks)
        lengths = pa.compute.list_value_length(stripe).to_numpy().astype(np.int64)
        flat = stripe.flatten()
        who = np.fromiter(map(place.__getitem__, flat.field("source").to_pylist()), np.int64, len(flat))
        many = flat.field("n").to_numpy()
        row = np.repeat(np.arange(len(term)), lengths)
        p = share(many, under[who])
        whole = np.add.reduceat(many, np.cumsum(lengths) - lengths)
        q = share(whole, np.int64(size.sum() + kept))
        # Terms: only a bucket's dearest can rank.
        value, spelled = gap(p, q[row]), np.empty(len(term), np.int64)
        spelled[sorted(range(len(term)), key=[t.encode() for t in term].__getitem__)] = np.arange(len(term))
        above = np.flatnonzero(p > q[row])
        above = above[np.lexsort((spelled[row[above]], -value[above], who[above]))]
        first = np.searchsorted(who[above], who[above])
        above = above[np.arange(len(above)) - first < ranks]
        out += [(names[who[i]], "term", term[row[i]], int(value[i])) for i in above.tolist()]
        # Pairs: stripes as dense rows, some at a time; every entry against all other sources.
        step = max(1, _CELLS // (width * max(1, int(lengths.max()))))
        for a in range(0, len(term), step):
            here = slice(int(np.searchsorted(row, a)), int(np.searchsorted(row, a + step)))
            at, s, mine = row[here] - a, who[here], p[here]
            dense = np.tile(absent, (min(step, len(term) - a), 1))
            has = np.zeros(dense.shape, bool)
            dense[at, s], has[at, s] = mine, True
            np.add.at(sums, s, gap(mine[:, None], dense[at]) - ground[s])
            # The other way round where the term is missing in the first source.
            back = np.where(has[at], 0, gap(absent[None, :], mine[:, None]) - ground[:, s].T)
            np.add.at(sums.T, s, back)
        sums += ground * len(term)
        out += [(names[i], "pair", names[j], int(sums[i, j])) for i in range(width) for j in range(width) if i != j]
        return _table(lang, out)

    return run


def _table(lang: str, rows: list[tuple[str, str, str, int]]) -> pa.Table:
    source, part, item, value = zip(*rows, strict=True) if rows else ((), (), (), ())
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table([pa.array(c, k) for c, k in zip(([lang] * len(rows), source, part, item, value), kinds, strict=True)], names=["lang", "source", "part", "item", "value"])


def audit(
    docs: DataFrame,
    least: int = LEAST,
    ranks: int = RANKS,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    spill: int = SPILL,
    bucket: int = BUCKET,
) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence of every source from the others of
    its language, and the terms in which it is above its language the most."""
    merged = stripes(docs, text, lang, source, spill)
    merged = staged(merged.filter((F.col("term") == "") | (F.col("docs") >= least)), "divergence-stripes")
    kept = merged.filter("term <> ''")
    groups = merged.filter("term = ''").select(F.col("lang").alias("of"), F.inline("stripe").alias("source", "documents"))
    sizes = kept.select(F.col("lang").alias("of"), F.inline("stripe").alias("source", "n")).groupBy("of", "source").agg(F.sum("n").alias("n"))
    terms_ = kept.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("kept"))
    totals = groups.join(sizes, ["of", "source"], "left").join(terms_, "of", "left")
    totals = totals.select("of", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("kept", F.lit(0)).alias("kept"))
    totals = totals.withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("kept") / bucket)).cast("int"))
    totals = staged(totals, "divergence-totals")
    deal = F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int")
    dealt = kept.join(totals.select(F.col("of").alias("lang"), "buckets").distinct(), "lang").select("lang", "term", "stripe", deal.alias("bucket"))
    spread = totals.select("of", "source", "n", "kept", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("slot"))
    pieces = dealt.groupBy("lang", "bucket").cogroup(spread.groupBy("of", "slot")).applyInArrow(
        _emit(ranks), "lang string, source string, part string, item string, value long"
    )
    # A language without kept terms has no stripe to emit from: its pairs are 0.
    empty = totals.filter("kept = 0").select(F.col("of").alias("lang"), "source")
    others = empty.select(F.col("lang").alias("own"), F.col("source").alias("item"))
    zeros = empty.join(others, (F.col("lang") == F.col("own")) & (F.col("source") != F.col("item")))
    found = pieces.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    found = found.unionByName(zeros.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value")))
    place = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    found = found.withColumn("rank", F.row_number().over(place))
    return found.filter((F.col("part") == "pair") | (F.col("rank") <= ranks))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with docs as (
  select row_number() over () as row, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source
  from documents
), words as (
  select row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
  from docs
), kept as (
  select lang, term from words group by lang, term having count(distinct row) >= 3
), held as (
  select lang, source, term, count(*) as n from words join kept using (lang, term) group by all
), groups as (select distinct lang, source from docs
), sizes as (
  select g.lang, g.source, coalesce(sum(h.n), 0)::hugeint as total,
    (select count(*) from kept k where k.lang = g.lang)::hugeint as v
  from groups g left join held h on h.lang = g.lang and h.source = g.source group by g.lang, g.source
), grid as (
  select s.lang, s.source, k.term, coalesce(h.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(h.n, 0) + 1)) // (s.total + s.v) as p
  from sizes s join kept k on k.lang = s.lang
  left join held h on h.lang = s.lang and h.source = s.source and h.term = k.term
), langs as (
  select lang, term, 1 + (1000000000::hugeint * (sum(n) + 1)) // any_value(total + v) as q
  from grid join (select lang, sum(total) as total, any_value(v) as v from sizes group by lang) using (lang)
  group by lang, term
), pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from grid a join grid b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, (p - q) * (p - q) // q from grid join langs using (lang, term) where n > 0 and p > q
)
select * from (
  select lang, source, part, item, value::bigint as value,
    row_number() over (partition by lang, source, part order by value desc, item)::int as rank
  from found
) where part = 'pair' or rank <= 200
"""
