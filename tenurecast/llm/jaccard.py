"""N-gram Jaccard join by count vectors in an R-tree.

The word shingles of a text are hashed into ``GROUPS`` groups; their counts are a point.
Two sets share at most the sum of the coordinate minima of their points, and no more than
that of the upper corners of the boxes they lie in. Points are packed into leaves of a
distributed tree; pairs of nodes, then of points, are pruned by that bound against the
overlap the similarity asks for, and what survives is verified on the exact sets.

The upper level of the tree must be an equality, or every leaf would be probed by every
text of about its size (counts of unrelated long texts lie close in every single
coordinate). Two sets within the similarity differ in at most ``d`` shingles, so if both
are dealt by hash into more than ``d`` parts, one part at least is the same in both. Parts are made
so many that a set fills more than ``d`` of them, so the part in common is not an empty one,
which unrelated texts would share, too; only the few sets that fill fewer are also routed by
their empty parts. What a set fills beyond ``d + 1`` it may leave out, as long as all sets
leave out by the same order: the parts that most sets share go, so a passage or line that
very many texts contain routes none of them.
Texts that share a part are routed to one subtree; each subtree is packed into leaves of
bounded size in order of set size and first coordinates. Leaves are joined in themselves,
then with the first text of the subtree, then leaf with leaf where groups are still apart:
a group of copies costs links in proportion to its texts and no pair within it is listed
twice. Equal sets are one point from the start.

Texts without words have no shingles and link with nothing; fewer words than a shingle's
width count as one shingle. Null text counts as empty. Rows with the same id are one
document: all texts of an id are in one group, with all that any of them links with. Rows
with a null id are counted but never linked. Copies get the least id of their group. Very
long texts are a leaf of their own. An empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenurecast.llm.common import Forest, chunks, components, longs, mix, shingles, table, words
from tenurecast.session import staged

GROUPS = 32
#: Texts and shingles in a leaf at most (one longer text is a leaf by itself).
LEAF_TEXTS, LEAF_SHINGLES = 256, 200_000
#: Leaves of a subtree in a block, about; one join key holds the pairs of two blocks.
LEAF_BLOCK = 256
#: Least ratio of the largest to the least set size of a band; never below that of two near sets.
BAND = 1.25
_FANOUT = 8


def _lower_edges(largest: int, num: int, den: int) -> list[int]:
    ratio = max(BAND, den / num)
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(np.ceil(edges[-1] * ratio))))
    return edges


@lru_cache(maxsize=4096)
def _parts(lower: int, upper: int, num: int, den: int) -> tuple[int, int]:
    """(shingles by which two sets up to ``upper`` may differ, parts to deal them into).

    A set of ``lower`` shingles is expected to fill a quarter more than ``d`` parts, three
    standard deviations included; the smallest sets, which no number suits, get twice ``d``.
    """
    d = (den - num) * 2 * upper // (den + num)
    parts = d + 1
    while parts < 2 * d + 2:
        empty = math.exp(-lower / parts)
        spread = math.sqrt(parts * empty * max(1 - (1 + lower / parts) * empty, 0))
        if parts * (1 - empty) - 3 * spread > d + d // 4:
            break
        parts += max(1, parts // 64)
    return d, parts


def text_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, in order of both."""
    rows = len(offsets) - 1
    doc, _, _, hashes = words(data, offsets)
    doc, values = shingles(doc, hashes, rows, width)
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    return doc[first], values[first]


def _routes(n: int, values: np.ndarray, edges: list[int], num: int, den: int) -> tuple[np.ndarray, list[int]]:
    """Keys of the parts of one set, under its band and, near the edge, the next, and how
    many of each band's it may leave out. The lowest bit of a key is that of its band."""
    band = int(np.searchsorted(edges, n, "right")) - 1
    found, spare = [], [0, 0]
    for b in (band, band + 1):
        if b > band and num * edges[b] > den * n:
            continue
        d, parts = _parts(-(-num * edges[b] // den), edges[b + 1] - 1, num, den)
        if not d:  # only equal sets are within the similarity
            continue
        place = ((values >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
        total = np.zeros(parts, np.uint64)
        np.add.at(total, place, values * np.uint64(0xD6E8FEB86659FD93))
        keep = np.flatnonzero(np.bincount(place, minlength=parts))
        if len(keep) > d:
            spare[b % 2] = len(keep) - d - 1
        else:  # an empty part may be the only one in common
            keep = np.arange(parts)
        keys = mix(total[keep] ^ mix(np.uint64(b << 40) + keep.astype(np.uint64)))
        found.append(keys & ~np.uint64(1) | np.uint64(b % 2))
    return np.concatenate(found) if found else np.empty(0, np.uint64), spare


def _points(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches, "text"):
            rows = part.num_rows
            doc, values = text_sets(data, offsets, width)
            n = np.bincount(doc, minlength=rows)
            at = np.concatenate([[0], np.cumsum(n)])
            sums = [np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)]
            for k, s in enumerate(sums):
                np.add.at(s, doc, mix(values + np.uint64(k + 1)))
            vector = np.bincount(doc * GROUPS + (values >> np.uint64(59)).astype(np.int64), minlength=rows * GROUPS)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("version"),
                    pa.array(n, pa.int64()),
                    longs(sums[0]),
                    longs(sums[1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * GROUPS, pa.int32()), pa.array(vector, pa.int32())),
                ],
                names=["doc_id", "version", "n", "f1", "f2", "point"],
            )

    return run


def _routing(width: int, num: int, den: int):
    """Routes of every text. They are many times a text's point, so they are made again
    where they are shuffled and are never stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches, "text"):
            rows = part.num_rows
            doc, values = text_sets(data, offsets, width)
            n = np.bincount(doc, minlength=rows)
            at = np.concatenate([[0], np.cumsum(n)])
            edges = _lower_edges(2 * int(n.max(initial=1)) * den // num, num, den)
            routed = [_routes(int(n[i]), values[at[i] : at[i + 1]], edges, num, den) if n[i] else (np.empty(0, np.uint64), [0, 0]) for i in range(rows)]
            routes = [r[0] for r in routed]
            spare = np.array([r[1] for r in routed], np.int32).reshape(-1)
            cuts = np.concatenate([[0], np.cumsum([len(r) for r in routes])])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), longs(np.concatenate(routes) if routes else np.empty(0, np.uint64))),
                    pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * 2, pa.int32()), pa.array(spare, pa.int32())),
                ],
                names=["doc_id", "routes", "spare"],
            )

    return run


# ---- a leaf, or two, in one task -------------------------------------------


def _boxes(n: np.ndarray, point: np.ndarray) -> list[tuple[int, int, int, np.ndarray]]:
    """Nodes of an R-tree over rows in packing order: (start, end, least size, upper corner)."""
    nodes = []
    for start in range(0, len(n), _FANOUT):
        end = min(start + _FANOUT, len(n))
        nodes.append((start, end, int(n[start:end].min()), point[start:end].max(axis=0)))
    return nodes


def link_sets(sets: list[np.ndarray], label: np.ndarray, num: int, den: int) -> np.ndarray:
    """Least place each set is linked with, given sets that start with equal labels as linked."""
    count = len(sets)
    forest = Forest(count)
    _, first, place = np.unique(label, return_index=True, return_inverse=True)
    for i in range(count):
        forest.join(i, int(first[place[i]]))
    n = np.array([len(s) for s in sets], np.int64)
    point = np.zeros((count, GROUPS), np.int64)
    for i, s in enumerate(sets):
        point[i] = np.bincount((s >> np.uint64(59)).astype(np.int64), minlength=GROUPS)
    order = np.lexsort((*point.T[::-1], n))
    n, point = n[order], point[order]
    root = np.array([forest.find(int(i)) for i in order], np.int64)
    nodes = _boxes(n, point)
    corner = np.array([x[3] for x in nodes])
    least = np.array([x[2] for x in nodes], np.int64)
    for a, (start, end, low, high) in enumerate(nodes):
        # overlap * (num + den) >= num * (size + size) is the same as the similarity
        bound = np.minimum(corner[a:], high).sum(axis=1)
        for b in (np.flatnonzero((num + den) * bound >= num * (least[a:] + low)) + a).tolist():
            to, until = nodes[b][0], nodes[b][1]
            for i in range(start, end):
                begin = max(i + 1, to)
                if begin >= until or not n[i]:
                    continue
                shared = np.minimum(point[begin:until], point[i]).sum(axis=1)
                near = (num + den) * shared >= num * (n[begin:until] + n[i])
                for j in (np.flatnonzero(near & (root[begin:until] != root[i])) + begin).tolist():
                    if root[i] == root[j] or not n[j]:
                        continue
                    x, y = sets[order[i]], sets[order[j]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if den * both >= num * (len(x) + len(y) - both):
                        new, old = min(root[i], root[j]), max(root[i], root[j])
                        root[root == old] = new
    out = np.empty(count, np.int64)
    out[order] = root
    return out


def _join_leaf(width: int, num: int, den: int):
    def run(key, rows):
        rows = rows.sort_by("node")
        node = rows.column("node").to_numpy()
        sets = []
        for part, data, offsets in chunks(iter(rows.combine_chunks().to_batches()), "text"):
            doc, values = text_sets(data, offsets, width)
            sets += np.split(values, np.searchsorted(doc, np.arange(1, part.num_rows)))
        root = link_sets(sets, rows.column("label").to_numpy(), num, den)
        return pa.table({"leaf": rows.column("leaf"), "node": rows.column("node"), "root": pa.array(node[root])})

    return run


def _leaves(nodes: DataFrame) -> DataFrame:
    """Pack (subtree, node, n, point, ..) into leaves of bounded size: adds ``leaf``.

    A range partitioning by subtree, size and first coordinates splits subtrees of any
    size; within a partition a running weight cuts the leaves.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = nodes.withColumns({"c0": F.col("point")[0], "c1": F.col("point")[1]})
    by = ["subtree", "n", "c0", "c1", "node"]
    spread = nodes.repartitionByRange(parts, *by).withColumn("part", F.spark_partition_id())
    running = Window.partitionBy("part", "subtree").orderBy("n", "c0", "c1", "node")
    weight = F.lit(1.0 / LEAF_TEXTS) + F.col("n") / LEAF_SHINGLES
    cut = F.floor(F.sum(weight).over(running.rowsBetween(Window.unboundedPreceding, 0)))
    return spread.withColumn("leaf", F.xxhash64("subtree", "part", cut)).drop("part", "c0", "c1")


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 4, den: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row, linked where Jaccard >= ``num / den``."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("version", F.xxhash64("text"))
    schema = "doc_id long, version long, n long, f1 long, f2 long, point array<int>"
    points = staged(docs.mapInArrow(_points(width, num, den), schema), "jaccard-points")
    same = ["n", "f1", "f2"]
    known = points.filter("n > 0 and doc_id is not null")
    # A class of equal sets stands for its texts; the first of its least id is read again.
    classes = known.groupBy(*same).agg(F.min(F.struct("doc_id", "version")).alias("first"), F.count("*").alias("copies"))
    classes = staged(classes.select(*same, "first.*", "copies").withColumn("node", F.monotonically_increasing_id()), "jaccard-classes")
    members = known.select("doc_id", *same).distinct().join(classes.select(*same, "node").hint("merge"), same)
    members = staged(members.select("doc_id", "node"), "jaccard-members")

    band = F.col("route").bitwiseAND(F.lit(1))
    routes = docs.filter("doc_id is not null").select("doc_id", "text")
    routes = routes.mapInArrow(_routing(width, num, den), "doc_id long, routes array<long>, spare array<int>")
    routed = routes.select("doc_id", "spare", F.explode("routes").alias("route"))
    routed = routed.select("doc_id", "route", F.get("spare", band.cast("int")).alias("spare"))
    routed = routed.withColumn("sharers", F.count("*").over(Window.partitionBy("route"))).filter("sharers > 1")
    # The parts that most rows share are left out, as many as a set can spare.
    commonest = Window.partitionBy("doc_id", band).orderBy(F.desc("sharers"), F.desc("route"))
    routed = routed.withColumn("rank", F.row_number().over(commonest)).filter("rank > spare")
    leader = F.first("doc_id").over(Window.partitionBy("route").orderBy("doc_id"))
    shared = routed.withColumn("leader", leader).filter("leader <> doc_id").select("doc_id", "leader")
    subtrees = components(shared, "jaccard-subtrees").select(F.col("node").alias("doc_id"), F.col("component").alias("subtree"))
    nodes = members.join(subtrees, "doc_id").groupBy("node").agg(F.min("subtree").alias("subtree"))
    first = nodes.join(classes.select("node", "doc_id", "version"), "node")
    sized = points.select("doc_id", "version", "n", "point").join(first.hint("merge"), ["doc_id", "version"]).dropDuplicates(["node"])
    nodes = _leaves(sized.select("node", "subtree", "doc_id", "version", "n", "point"))
    nodes = staged(nodes.withColumn("label", F.col("node")), "jaccard-leaves")
    # The same join at every size: the plan must not turn when the candidates outgrow a broadcast.
    wanted = nodes.select("node", "doc_id", "version").hint("merge")
    texts = docs.join(wanted, ["doc_id", "version"]).select("node", "text")
    texts = staged(texts.dropDuplicates(["node"]), "jaccard-texts")
    nodes = nodes.drop("doc_id", "version")

    def joined(assigned: DataFrame, label: str) -> DataFrame:
        rows = assigned.select("leaf", "node", "label").join(texts, "node")
        out = rows.groupBy("leaf").applyInArrow(_join_leaf(width, num, den), "leaf long, node long, root long")
        return staged(out, label)

    inner = joined(nodes, "jaccard-inner")
    label = _between_leaves(nodes, inner, joined, num, den)
    # Texts of one id belong together.
    versions = members.withColumn("least", F.min("node").over(Window.partitionBy("doc_id"))).filter("node <> least").select("node", "least")
    if not versions.isEmpty():
        label = components(label.union(versions), "jaccard-versions")
    found = classes.select(*same, "doc_id", "copies", "node").join(label, "node", "left").filter("copies > 1 or component is not null")
    found = staged(found.withColumn("component", F.coalesce("component", "node")), "jaccard-found")
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = found.join(least, "component").select(*same, "component_id")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return points.select("doc_id", *same).join(found.hint("merge"), same, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def _between_leaves(nodes: DataFrame, inner: DataFrame, joined, num: int, den: int) -> DataFrame:
    """(node, component) over all leaves, given the groups found within each."""
    links = inner.select("node", "root").filter("node <> root")
    roots = inner.filter("node = root").select("node").join(nodes.drop("leaf"), "node")
    apart = roots.groupBy("subtree").agg(F.min("node").alias("head"), F.count("*").alias("k")).filter("k > 1")
    many = nodes.groupBy("subtree").agg(F.countDistinct("leaf").alias("leaves")).filter("leaves > 1")
    apart = staged(apart.join(many, "subtree").select("subtree", "head"), "jaccard-apart")
    if apart.isEmpty():
        return components(links, "jaccard-linked")

    # The first text of each group found so far, with the first of its subtree.
    again = staged(_leaves(roots.join(apart, "subtree", "left_semi")), "jaccard-roots")
    heads = again.select("leaf", "subtree").distinct().join(apart, "subtree")
    heads = heads.select("leaf", F.col("head").alias("node"), F.col("head").alias("label"))
    stars = joined(again.select("leaf", "node", "label").union(heads).distinct(), "jaccard-stars")
    links = links.union(stars.select("node", "root").filter("node <> root"))
    label = components(links, "jaccard-linked")

    # Leaf with leaf, where their boxes allow a link and their texts are not all one group yet.
    marked = nodes.join(apart, "subtree", "left_semi").drop("label").join(label, "node", "left")
    marked = marked.withColumn("label", F.coalesce("component", "node")).drop("component")
    open_still = marked.groupBy("subtree").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).filter("l0 <> l1")
    marked = staged(marked.join(open_still.select("subtree"), "subtree", "left_semi"), "jaccard-marked")
    corner = F.array(*[F.max(F.col("point")[g]) for g in range(GROUPS)])
    boxes = marked.groupBy("subtree", "leaf").agg(
        F.min("n").alias("n0"),
        F.max("n").alias("n1"),
        corner.alias("corner"),
        F.min("label").alias("l0"),
        F.max("label").alias("l1"),
    )
    boxes = staged(boxes, "jaccard-boxes")
    blocks = boxes.groupBy("subtree").agg(F.ceil(F.count("*") / LEAF_BLOCK).cast("int").alias("blocks"))
    dealt = boxes.join(blocks, "subtree").withColumn("block", F.pmod(F.xxhash64("leaf"), F.col("blocks")).cast("int"))
    one = dealt.withColumn("i", F.col("block")).withColumn("j", F.explode(F.sequence("block", F.col("blocks") - 1)))
    other = dealt.withColumn("i", F.explode(F.sequence(F.lit(0), "block"))).withColumn("j", F.col("block"))
    other = other.select("subtree", "i", "j", *[F.col(c).alias(f"o_{c}") for c in ("leaf", "n0", "n1", "corner", "l0", "l1")])
    minima = F.zip_with("corner", "o_corner", lambda x, y: F.least(x, y))
    least_sum = F.aggregate(minima, F.lit(0), lambda s, x: s + x)
    pairs = one.join(other, ["subtree", "i", "j"]).filter(
        "(i < j or leaf < o_leaf) and not (l0 = l1 and l0 = o_l0 and l0 = o_l1)"
        f" and {den} * n1 >= {num} * o_n0 and {den} * o_n1 >= {num} * n0"
    )
    pairs = pairs.filter(least_sum * (num + den) >= (F.col("n0") + F.col("o_n0")) * num)
    pairs = pairs.select(F.xxhash64("leaf", "o_leaf").alias("pair"), F.explode(F.array("leaf", "o_leaf")).alias("leaf"))
    crossed = pairs.join(marked, "leaf").select(F.col("pair").alias("leaf"), "node", "label")
    late = joined(crossed, "jaccard-crossed").select("node", "root").filter("node <> root")
    if late.isEmpty():
        return label
    return components(label.union(late), "jaccard-final")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, num=9, den=10)


OP8_SQL = r"""
with recursive tokens as (
    select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
    from documents
), windows as (
    select doc_id, case when len(w) = 0 then []::varchar[]
        when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end as s
    from tokens
), sets as (
    select doc_id, list_distinct(s) as s, len(list_distinct(s)) as n from windows
), classes as (
    select min(doc_id) as rep, any_value(s) as s, any_value(n) as n from sets where n > 0 group by list_sort(s)
), items as (
    select rep, n, unnest(s) as x from classes
), pairs as (
    select a.rep as a, b.rep as b from items a join items b on a.x = b.x and a.rep < b.rep
    where 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
    group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))
), edges as (
    select a, b from pairs union all select b, a from pairs
), reach as (
    select rep as a, rep as b from classes union select r.a, e.b from reach r join edges e on r.b = e.a
), least_rep as (
    select a as rep, min(b) as component from reach group by a
)
select t.doc_id, t.n as n_shingles, coalesce(l.component, t.doc_id) as component_id
from sets t left join classes c on t.n > 0 and list_sort(c.s) = list_sort(t.s) left join least_rep l on l.rep = c.rep
"""
