"""Whitening, ranked search and token files: awkward rows, brute force, round trips."""

import itertools
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import reference_text as R
from hypothesis import given, settings, strategies as st

from sluice.llm import queries as Q, search, tokenfile, whitening

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
CLASHING = "vec_id long, embedding array<double>, component int, whitened string, n int, place int, doc string, vector int, a int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(R.awkward_rows(), R.COLUMNS).repartition(3).persist()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], R.COLUMNS)


# whitening

def whitened_by_hand(rows):
    """Covariances by multiplying centred entries, in whole numbers; rows of (id, entries)."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(v[i] for v in x) for i in range(d)]
    y = [[n * v[i] - s[i] for i in range(d)] for v in x]
    cov = np.array([[sum(v[i] * v[j] for v in y) / n ** 3 for j in range(d)] for i in range(d)])
    return [sum(e * e for e in v) for v in y], cov, np.array(y, float) / n


@needs_data
def test_whitening_query(spark):
    given_rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    deviation, cov, centred = whitened_by_hand(given_rows)
    values, basis = np.linalg.eigh(cov)
    found = Q.op11_whitening(spark, SMALL).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in found] == [(i, c) for i, _ in given_rows for c in range(1, 9)]
    assert {r.n for r in found} == {len(given_rows)} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error < 1e-9
    assert [r.deviation for r in found[::8]] == deviation
    for c in range(8):
        own = np.array([r.whitened for r in found[c::8]])
        expected = centred @ basis[:, -1 - c] / math.sqrt(values[-1 - c])
        assert min(np.abs(own - expected).max(), np.abs(own + expected).max()) < 1e-6
        assert found[c].explained == pytest.approx(values[-1 - c] / values.sum(), rel=1e-9)


def test_whitening_leaves_out_unusable_vectors(spark):
    r = random.Random(3)
    good = [(i, [r.uniform(-2, 2) for _ in range(3)]) for i in range(40)]
    good += [(None, [0.5, 0.25, -0.125]), (7, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0])]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, math.nan, 2.0]), (54, [math.inf, 0.0, 0.0]), (55, [1.0]), (56, [1.0] * 4)]
    rows = [(i, v, 1, "w", 2, 3, "d", 4, 5) for i, v in good + bad]
    found = whitening.whiten(spark.createDataFrame(rows, CLASHING).repartition(4)).collect()
    assert Counter(x.doc.vec_id for x in found) == {i: 3 * c for i, c in Counter(i for i, _ in good).items()}
    assert {x.component for x in found} == {1, 2, 3} and found[0].n == len(good)
    deviation, cov, _ = whitened_by_hand(good)
    assert Counter(x.deviation for x in found if x.component == 1) == Counter(deviation)
    model = whitening.fit(spark.createDataFrame(rows, CLASHING))
    assert model.values == pytest.approx(np.linalg.eigvalsh(cov)[::-1], rel=1e-12)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [math.nan])]])
def test_whitening_of_nothing(spark, rows):
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.count() == 0
    assert found.columns == ["doc", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_without_variance(spark):
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>"))
    assert {(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in same.collect()} == {
        (1, 0, None, None, None), (2, 0, None, None, None)
    }
    line = whitening.whiten(spark.createDataFrame([(i, [i / 1024, 2 * i / 1024]) for i in range(9)], "vec_id long, embedding array<double>"))
    by_component = {c: [r for r in line.collect() if r.component == c] for c in (1, 2)}
    assert by_component[1][0].explained == pytest.approx(1) and all(r.whitened is None for r in by_component[2])
    assert by_component[1][0].identity_error < 1e-9


@pytest.mark.parametrize("size", [1, 1 << 12, 1 << 24, 1 << 30, 1 << 40])
def test_pair_sums_are_exact(size):
    r = random.Random(size)
    z = [[r.randint(-size, size) for _ in range(5)] for _ in range(300)]
    sums = whitening.PairSums(5)
    for first in range(0, 300, 70):
        sums.add(np.array(z[first:first + 70], np.int64))
    assert {(i, j): t for i, j, t in sums.rows()} == {
        (i, j): sum((v[i] if i == j else v[i] + v[j]) ** 2 for v in z) for i in range(5) for j in range(i, 5)
    }


def test_deviations_at_the_edge_of_a_bigint():
    z = np.array([[3037000499, 0], [3037000500, 0], [2147483648, 2147483648], [2147483647, 2147483648], [1, 2]])
    model = whitening.Whitening(1, (0, 0), (0, 0), np.zeros(2), np.eye(2), 0.0)
    exact = [sum(int(v) ** 2 for v in row) for row in z]
    assert model.deviations(z).tolist() == [e if e < 1 << 63 else None for e in exact]


# search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked_by_hand(docs, items, k=50):
    """rows of (id, text) and (item, text); all scores of all documents."""
    counts = [(i, Counter(TERM.findall((t or "").translate(R.LOWER)))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    documents, words = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counts:
            m = 50 + 50 * n * documents // words
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(TERM.findall((text or "").translate(R.LOWER))) if t in c
            )
            if score:
                scored.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def as_tuples(found, name):
    return [(r.item[name], r.rank, r.doc.doc_id, r.score) for r in found.collect()]


def test_search_awkward_rows(spark, docs):
    items = [(1, "quick brown fox"), (2, None), (None, "été 中文"), (4, ""), (1, "quick brown fox"), (5, "THE the The dog-river"), (6, "!?"), (7, "w3x4 w3x4 zzz")]
    found = search.rank_documents(
        docs, spark.createDataFrame(items, "item_id long, text string"), carry=("item_id",)
    )
    assert R.count(as_tuples(found, "item_id")) == R.count(ranked_by_hand([r[:2] for r in R.awkward_rows()], items))


def test_search_of_nothing(spark, docs, nothing):
    items = spark.createDataFrame([(1, "quick")], "item_id long, text string")
    assert search.rank_documents(nothing, items).count() == 0
    assert search.rank_documents(docs, items.limit(0)).count() == 0
    clashing = spark.createDataFrame([(1, "fox", 2, 3, "s")], "item_id long, text string, rank int, number int, doc string")
    assert search.rank_documents(docs, clashing).first().item.rank == 2


@pytest.mark.parametrize("k, block, read", [(3, 40, 1), (10, 1 << 21, 4), (50, 300, 32)])
def test_search_equals_scoring_everything(spark, monkeypatch, k, block, read):
    """Many ties, small blocks and reads; queries in several parts."""
    r = random.Random(k)
    vocabulary = [f"t{i}" for i in range(30)]
    docs = [(i, " ".join(r.choices(vocabulary, range(1, 31), k=r.choice([1, 2, 2, 3, 9, 40])))) for i in range(400)] + [(7, "t1 t2"), (None, "t1 t2")]
    items = [(i, " ".join(r.sample(vocabulary, 1 + i % 6))) for i in range(20)]
    monkeypatch.setattr(search, "FIRST_READ", read)
    monkeypatch.setattr(search, "BLOCK_POSTINGS", block)
    queries = search.Queries.of(pa.array([{"item_id": i} for i, _ in items]), [t for _, t in items])
    # in this process, so that the small blocks count
    counted = []
    for first in range(0, len(docs), 50):
        part = docs[first:first + 50]
        length, terms, counts = search.count_terms(pa.array([t for _, t in part]), queries)
        ids = pa.StructArray.from_arrays([pa.array([i for i, _ in part], pa.int64())], ["doc_id"])
        counted.append(pa.RecordBatch.from_arrays([ids, pa.array(length), terms, counts], names=["doc", "length", "terms", "counts"]))
    holding = np.bincount(np.concatenate([b.column(2).flatten().to_numpy() for b in counted]), minlength=queries.size)
    size = sum(int(b.column(1).to_numpy().sum()) for b in counted)
    rows = [x for b in search._search(iter(counted), queries, search.Collection.of(len(docs), size, holding), k) for x in b.to_pylist()]
    best = {}
    for x in rows:
        best.setdefault(x["item"]["item_id"], []).append((-x["score"], x["doc"]["doc_id"] is None, x["doc"]["doc_id"] or 0, x["doc"]["doc_id"]))
    merged = [(i, n, d, -s) for i, own in best.items() for n, (s, _, _, d) in enumerate(sorted(own, key=lambda y: y[:3])[:k], 1)]
    assert R.count(merged) == R.count(ranked_by_hand(docs, items, k))
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    found = search.rank_documents(*frames, k=k, query_bytes=500)
    assert R.count(as_tuples(found, "item_id")) == R.count(ranked_by_hand(docs, items, k))


def test_search_stops_early():
    """With one rare strong term the lists are not read to their ends."""
    length, rows = np.full(5000, 3), 5000
    collection = search.Collection(rows, 3 * rows, np.array([1000, 1]))
    count = np.ones(2 * rows, np.int64)
    count[:40:2] = 50
    block = search.Block(length, np.full(rows, 2), np.tile([0, 1], rows), count, collection)
    docs, scores = block.best(np.array([0, 1]), np.zeros(0, np.int64), 5)
    assert len(docs) < 200 and sorted(scores)[-5:] == [scores.max()] * 5


def test_terms_that_share_a_hash(monkeypatch):
    monkeypatch.setattr(search.N.Rolling, "of", lambda self, starts, ends: (ends - starts).astype(np.uint64))
    queries = search.Queries.of(pa.array([{"i": 1}]), ["ab cd ef xyz"])
    length, terms, counts = search.count_terms(pa.array(["cd gh ab cd", "xyz efg", ""]), queries)
    found = [{queries.data[queries.starts[t]:queries.ends[t]].tobytes(): c for t, c in zip(*row)} for row in zip(terms.to_pylist(), counts.to_pylist())]
    assert found == [{b"ab": 1, b"cd": 2}, {b"xyz": 1}, {}] and length.tolist() == [4, 2, 0]


# token files

PIECES = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\u00a0", "\u2003", "\u3000", "\u0301", "\u0327", "e", "A", "'s", "'", "Σ", "ς", "İ", "ß", "1", "²", "한", "ᄒ", "ᅡ", "\u200d", "🙂", "-", "<|endoftext|>", "\u0340", "Å", "W", "\u030a", ".", "?!", "é", "ſ", "ŉ", "İ.", "Stäver", "ÀÉ.", "x's.", "'.", "a_b", "|>", "ÿ", "Ÿ"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=20) | st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=4), st.booleans())
def test_words_encode_as_whole_texts(texts, as_text):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    whole = tokenfile.encoder(marks_are_text=as_text)
    for _ in range(2):
        found = [ids.tolist() for ids in tokenfile.Encoder(marks_are_text=as_text)([t.encode() for t in [*texts, *texts]])]
        assert found == 2 * [whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("text", ["", "ab  cd\nef " * 9, "x" * 50, " " * 50, "a b" + "c" * 40 + " d"])
def test_long_texts_are_cut_at_blanks(text):
    for size in (1, 5, 1000):
        pieces = list(tokenfile._pieces(text.encode(), size))
        assert b"".join(pieces).decode() == text and [w for p in pieces for w in p.split()] == text.encode().split()


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tokenfile, "KEPT_WORDS", 3)
    encode = tokenfile.Encoder()
    for texts in (["a b"], ["c d a"], ["a b c d e f", "f e"], ["w" * 300]):
        assert [i.tolist() for i in encode(t.encode() for t in texts)] == [tokenfile.encoder().encode(t, add_special_tokens=False).ids for t in texts]
    assert len(encode.known) <= 10 and not any(len(w) > tokenfile.KEPT_BYTES for w in encode.known)


class Counted:
    def __init__(self, model):
        self.model, self.words = model, []

    def tokenize(self, word):
        self.words.append(word)
        return self.model.tokenize(word)


def test_words_that_come_again_are_encoded_once(monkeypatch):
    monkeypatch.setattr(tokenfile, "KEPT_WORDS", 40)
    encode = tokenfile.Encoder()
    encode.known.model = counted = Counted(encode.known.model)
    rare = ["".join(p) for p in itertools.product("abcde", repeat=4)]
    for first in range(0, len(rare), 10):
        list(encode([" ".join(["often", *rare[first:first + 10], "often"]).encode()]))
    assert counted.words.count("often") == 1 and len(counted.words) == len(rare) + 1
    assert len(encode.known) + len(encode.known.old) <= 40 + 2 * 11


def test_latin_letters_need_the_merges_alone():
    encode, words = tokenfile.Encoder(), "Élève, ÀÉ ÿ ß zx été. ÞÝÖØ øæå"
    expected = tokenfile.encoder().encode(words, add_special_tokens=False).ids
    list(encode([b", ."]))
    encode.known.tokenizer = None
    assert next(encode([words.encode()])).tolist() == expected


@pytest.mark.parametrize("size", [1, 7, 30, 1 << 20])
def test_texts_encode_together(monkeypatch, size):
    monkeypatch.setattr(tokenfile, "PIECE", size)
    texts = ["", "a", " a b\tA,", "", "x" * 40, "Été 3 a " * 9, "\n\x0b \x1c", "\u3000", "b a", ""]
    found = [ids.tolist() for ids in tokenfile.Encoder()(t.encode() for t in texts)]
    assert found == [tokenfile.encoder().encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(100, 300), min_size=7, max_size=7), min_size=1, max_size=5), st.integers(1, 100))
def test_blocks_round_trip(rows, percentile):
    blocks = tokenfile.pack_blocks(np.array(rows, np.uint32), percentile)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert tokenfile.unpack_blocks(b"".join(blocks), starts).tolist() == [i for row in rows for i in row]


def test_blocks_patch_outliers():
    ids = np.arange(1024, dtype=np.uint32)[None] % 16 + 1000
    plain = len(tokenfile.pack_blocks(ids)[0])
    ids[0, ::100] = 49_000
    [block] = tokenfile.pack_blocks(ids)
    assert plain == 12 + 512 and len(block) == plain + 11 * 6


def expected_documents(rows, **settings):
    tokenizer, at, out = tokenfile.encoder(**settings), 0, []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, tokenfile.END]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


@pytest.mark.parametrize("file_ids, group", [(1 << 24, 256), (50, 1)])
def test_files_round_trip(spark, docs, tmp_path, file_ids, group):
    folder = str(tmp_path / "ids")
    files = tokenfile.write_files(docs, folder, file_ids=file_ids).collect()
    assert sum(f.documents for f in files) == len(R.awkward_rows()) and (file_ids > 50 or len(files) > 5)
    found = [tuple(r) for r in tokenfile.read_files(spark, folder, with_ids=True).orderBy("start").collect()]
    rows = sorted((r[:2] for r in R.awkward_rows()), key=lambda r: (r[0] is not None, r[0]))
    assert found == expected_documents(rows)
    assert [tuple(r) for r in tokenfile.read_files(spark, folder).orderBy("start").collect()] == [r[:4] for r in found]
    everything = [i for r in found for i in r[4]]
    for f in files:
        reader = tokenfile.Reader(pa.OSFile(f"{folder}/{f.name}"))
        for first, count in ((0, 3), (f.ids // 2, 2000), (max(f.ids - 5, 0), 5), (1020, 10)):
            assert reader.read(first, min(count, max(f.ids - first, 0))).tolist() == everything[f.start:][:f.ids][first:first + count]


def test_files_of_nothing(spark, nothing, tmp_path):
    assert tokenfile.write_files(nothing, str(tmp_path / "none")).count() == 0
    assert tokenfile.read_files(spark, str(tmp_path / "none")).count() == 0


def test_marks_in_a_text(spark, tmp_path):
    rows = [(1, "a <|endoftext|> b")]
    for as_text in (True, False):
        folder = str(tmp_path / f"marks-{as_text}")
        tokenfile.write_files(spark.createDataFrame(rows, "doc_id long, text string"), folder, marks_are_text=as_text)
        ids = tokenfile.read_files(spark, folder, with_ids=True).first().ids
        assert (49407 in ids) != as_text


def test_broken_files_are_noticed(tmp_path):
    path = str(tmp_path / "one.pfr")
    writer = tokenfile.Writer(pa.OSFile(path, "wb"))
    writer.add(1, np.arange(5000, dtype=np.uint32))
    size = writer.close()
    data = bytearray(open(path, "rb").read())
    data[-60] ^= 1
    open(path, "wb").write(data)
    assert size == len(data)
    with pytest.raises(ValueError):
        tokenfile.Reader(pa.OSFile(path))


@needs_data
def test_token_file_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    found = sorted(tuple(r) for r in Q.op13_tokenfile(spark, SMALL).collect())
    assert found == [r[:4] for r in expected_documents(rows)]
