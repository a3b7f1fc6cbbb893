"""Alignment, slack packing and divergence audit against brute force."""

import collections
import hashlib
import itertools
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tenurecast.llm import alignment, divergence, jaccard, queries, slack

BYTES, PIECES = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "  a", "a", "a b", "a  b", "a   b ", "\n", " \n x", "x\n", "x▁y", "<|endoftext|> <unk> </s> <0x41>",
    "é́ 𝒳 😀😀 中文字符 ß", "word " * 2000, "x" * 5000, "ab" * 3000, "12345 678,90", "\x00a\x1c b\x85 c", "a b　c",
    "don't we'll 'S", "\t\ta b\r\n c ", "Über Straße", "日本" * 700, "a b", "a b",
]
ROWS = [*enumerate(TEXTS), (3, "  a"), (None, "null id"), (None, "null id")]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, very long, repeated and special texts, with columns named like results."""
    rows = [(k, t, None, None, "len", "r", 7) for k, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, length string, row string, block long").repartition(3)


def spelled(letters, tokenizer, i):
    token = tokenizer.id_to_token(i)
    return bytes(map(letters.__getitem__, token)) if all(c in letters for c in token) else token.encode()


def links_of(docs):
    """(doc_id, tokens, groups, links, best, sum, hash) by the plain definition."""
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    found, held = [], collections.Counter()
    for key, text in docs:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        raw_a = [spelled(letters, tokenizer, i) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, model.id_to_piece(i)) for i in b)]
        want = (" " + text).encode() if text else b""
        if not text or b"".join(raw_a) != want or b"".join(raw_b) != want:
            found.append((key, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = (list(itertools.accumulate(map(len, raw))) for raw in (raw_a, raw_b))
        groups, at = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append(tuple([i for i, e in zip(ids, ends, strict=True) if at < e <= end] for ids, ends in ((a, ends_a), (b, ends_b))) if len(want) < 300 else None)
            at = end
        if len(want) >= 300:  # the same, in one pass
            groups, i, j = [], 0, 0
            for end in sorted(set(ends_a) & set(ends_b)):
                x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
                groups.append((a[i:x], b[j:y]))
                i, j = x, y
        links = [p for x, y in groups for p in itertools.product(x, y)]
        held.update(set(links))
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        found.append((key, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest()))
    top = collections.Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return [
        (k, a, b, g, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), h)
        for k, a, b, g, links, h in found
    ]


LINKED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_alignment_query(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = queries.QUERIES["op11_token_alignment"](spark, small)
    assert got.columns == LINKED
    assert in_order(tuple(r) for r in got.collect()) == in_order(links_of(docs))


@pytest.mark.parametrize("block", [alignment.BLOCK_BYTES, 50])
def test_alignment_edges(odd, block):
    got = alignment.align(odd, BYTES, PIECES, block=block).select(*LINKED).collect()
    assert in_order(tuple(r) for r in got) == in_order(links_of(ROWS))
    assert alignment.align(odd.limit(0), BYTES, PIECES).collect() == []


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    random = np.random.default_rng(3)
    a, b = random.integers(0, 5, 60), random.integers(0, 7, 50)
    stops = np.array([1, 40, 60]), np.array([2, 45, 50])
    plain = alignment.expand(a, b, *stops)
    monkeypatch.setattr(alignment, "LISTED", 10)
    short = alignment.expand(a, b, *stops)
    count = [collections.Counter(), collections.Counter()]
    for c, (group, pairs, times) in zip(count, (plain, short), strict=True):
        for g, p, n in zip(group.tolist(), pairs.tolist(), times.tolist(), strict=True):
            c[g, p] += n
    assert count[0] == count[1] and len(short[0]) < len(plain[0])


def test_pair_counts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a"), (3, "a a")], "doc_id long, text string")
    got = {(r.a, r.b): r.docs for r in alignment.pair_counts(docs, BYTES, PIECES).collect()}
    assert sorted(got.values()) == [1, 3]


# ---- packing ---------------------------------------------------------------


def pieces_hold(docs, rows, capacity, end):
    """Every id once, in gapless sequences; the padding that remains."""
    tokenizer = Tokenizer.from_file(BYTES)
    texts = collections.defaultdict(list)
    for key, text in docs:
        texts[key].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [end])
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for key, versions in texts.items():
        possible = collections.Counter()
        for r in by_doc[key]:
            match = [v for v in versions if len(v) == r.doc_tokens and zlib.crc32(np.array(v[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
            assert match
            possible.update(range(r.start, r.start + r.length))
        assert possible == collections.Counter(k for v in versions for k in range(len(v)))
    padded = 0
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
        padded += capacity - at if at & (at - 1) else 0
    return padded


def test_slack_query(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = queries.QUERIES["op12_slack_packing"](spark, small).collect()
    assert pieces_hold(docs, got, 1024, 0) == 0
    tokens = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) <= tokens / 1024 + 10
    # Cuts stay few: at most a third more pieces than the windows force.
    assert len(got) <= 4 / 3 * sum(-(-t // 1024) for t in {r.doc_id: r.doc_tokens for r in got}.values())


def test_slack_units_once():
    """A unit that occurs often is looked up once; ids are those of the tokenizer."""
    counted = []

    class Table(dict):
        def __getitem__(self, unit):
            counted.append(unit)
            return dict.__getitem__(self, unit)

    own = slack.Encoder(BYTES)
    look_up = own.units.look_up
    own.units.look_up = lambda needed, make: Table(look_up(needed, make))
    texts = ["a b " * 500] * 20 + ["", " ", "  a", "a  b", "x <|endoftext|> y", "<|endoftext|>", "é\tx \n z", "日本 x", "a 日本", "x" * 500 + " b"]
    got = own(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [own.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(counted) < 40 and own([]) == []


@pytest.mark.parametrize("capacity, ranked", [(1024, 5000), (16, 2)])
def test_slack_edges(odd, capacity, ranked):
    got = slack.pack(odd, BYTES, capacity=capacity, ranked_rows=ranked).collect()
    assert pieces_hold(ROWS, got, capacity, 0) == 0
    assert slack.pack(odd.limit(0), BYTES).collect() == []


def test_closest_is_closest():
    random = np.random.default_rng(5)
    for _ in range(60):
        left = collections.Counter(random.integers(1, 30, random.integers(1, 9)).tolist())
        capacity = int(random.integers(1, 60))
        sums = {sum(c) for k in range(10) for c in itertools.combinations(sorted(left.elements()), k)}
        fill = slack.closest(dict(left), capacity)
        assert all(m <= left[n] for n, m in fill.items())
        assert sum(n * m for n, m in fill.items()) == max(s for s in sums if s <= capacity)


@pytest.mark.parametrize("counts", [{600: 1000}, {52: 100, 972: 100, 1000: 99}, {1: 5}, {1023: 3}, {}, {512: 2}])
def test_plan_places_every_rank_once(counts):
    table = slack.plan(counts)
    assert not any(table["take"] > table["length"])
    wanted = dict(counts)
    for n, rest in zip(table["length"].tolist(), (table["length"] - table["take"]).tolist(), strict=True):
        assert rest == 0 or rest < n
    tokens = sum(n * c for n, c in wanted.items())
    last = int(table["sequence"].max(initial=-1))
    assert last + 1 <= tokens // 1024 + 10 or last >= 0
    with pytest.raises(ValueError):
        slack.plan({2000: 1})


# ---- divergence ------------------------------------------------------------

AUDITED = ["lang", "source", "part", "item", "value", "rank"]


def by_sql(df):
    frame = df.select("text", "lang", "source").toPandas().astype(object)
    frame = frame.where(frame.notna(), None)
    connection = duckdb.connect()
    connection.sql("create table documents (text varchar, lang varchar, source varchar)")
    if len(frame):
        connection.executemany("insert into documents values (?, ?, ?)", frame.values.tolist())
    return sorted(connection.sql(divergence.OP13_SQL).fetchall())


@pytest.mark.parametrize("spill, bucket", [(divergence.SPILL, divergence.BUCKET), (3, 2)])
def test_audit_edges(spark, spill, bucket):
    rows = [
        ("a b É é Zürich", None, None), ("A b a", "", "x"), ("b a É", "en", "x"), ("", None, "q"), (None, "fr", "s1"),
        ("7", "fr", "s2"), ("x" * 10, "fr", None), ("b b x_y x'y", None, "x"), ("a a b \x00 日本", None, "q"), ("a b É", None, "q"),
        ("z z", "de", "k"), ("long " * 20000, "en", "y"),
    ] * 2
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "text string, lang string, source string, rank int, term string").repartition(3)
    got = divergence.audit(df, spill=spill, bucket=bucket).select(*AUDITED).collect()
    assert sorted(map(tuple, got)) == by_sql(df)
    assert divergence.audit(df.limit(0)).collect() == []


def test_shares_are_exact():
    random = np.random.default_rng(2)
    count = np.append(random.integers(0, 10**12, 500), [0, 10**14])
    total = count + np.append(random.integers(1, 10**12, 500), [1, 10**14])
    want = [1 + 10**9 * (c + 1) // t for c, t in zip(count.tolist(), total.tolist(), strict=True)]
    assert divergence.share(count, total).tolist() == want


def test_long_texts_are_folded_in_parts(monkeypatch):
    text = "Straße x1 " * 500
    whole = [w for part in divergence.terms(text) for w in part]
    monkeypatch.setattr(divergence, "PART", 7)
    assert [w for part in divergence.terms(text) for w in part] == whole
    assert collections.Counter(whole) == {"straße".encode(): 500, b"x": 500}


def test_a_hot_language_is_many_groups(spark):
    """Rows that reach a term are bounded by tasks and spills, not by its documents."""
    df = spark.range(0, 3000, 1, 4).selectExpr("concat('common w', char(97 + id % 7)) as text", "'en' as lang", "concat('s', id % 3) as source")
    rows = df.mapInArrow(divergence._fold(10**6), divergence._STRIPE).filter("term = 'common'").count()
    assert rows == 4
    got = divergence.audit(df, bucket=2).select(*AUDITED).collect()
    assert sorted(map(tuple, got)) == by_sql(df)


# ---- n-gram join: repeated and null ids ------------------------------------


@pytest.mark.parametrize("turned", [False, True])
def test_near_duplicates_with_repeated_and_null_ids(spark, turned):
    """Texts of one id are one document; null ids never link; whatever the order of rows."""
    words = [[f"{c}{i}" for i in range(200)] for c in "wv"]
    a, c = (" ".join(w) for w in words)
    b, d = (" ".join([*w[:-1], "x"]) for w in words)
    rows = [(5, a), (5, c), (6, b), (7, d), (None, a), (None, "q " * 6), (8, "q " * 6), (9, ""), (10, None), (11, "one"), (12, "one")]
    df = spark.createDataFrame(rows[::-1] if turned else rows, "doc_id long, text string").repartition(2)
    got = collections.Counter(tuple(r) for r in jaccard.near_duplicates(df).collect())
    want = [(5, 196, 5), (5, 196, 5), (6, 196, 5), (7, 196, 5), (8, 1, 8), (9, 0, 9), (10, 0, 10), (11, 1, 11), (12, 1, 11), (None, 1, None), (None, 196, None)]
    assert got == collections.Counter(want)
