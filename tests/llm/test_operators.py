"""The operators on awkward rows and against brute force."""

import hashlib
import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
import reference_text as R
from pyspark.sql import functions as F

from sluice.llm import (
    chat, curriculum, exact_dedup, fingerprints, language, minhash, packing, pii, quality, toxicity, tokens,
)
from sluice.llm import words as N


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(R.awkward_rows(), R.COLUMNS).repartition(3).persist()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], R.COLUMNS)


def prose(random, kind, n):
    syllables = {"en": "th er an ing on".split(), "de": "sch ein ung ver ach".split(), "fr": "eau ou les ai tion".split()}[kind]
    return " ".join("".join(random.choices(syllables, k=random.randint(1, 3))) for _ in range(n))


# exact dedup

def test_exact_classes(docs):
    found = exact_dedup.duplicate_classes(docs, carry=("doc_id", "text")).collect()
    groups = {}
    for row in R.awkward_rows():
        groups.setdefault(row[1] or "", []).append(row[0])
    assert len(found) == len(R.awkward_rows())
    for r in found:
        ids = groups[r.doc.text or ""]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = [r for r in found if r.kept]
    assert R.count(r.doc.text or "" for r in kept) == R.count(groups)
    assert all(r.doc.doc_id == r.keep_id for r in kept)


def test_exact_keeps_all_columns(docs, nothing):
    assert exact_dedup.deduplicate(docs).schema == docs.schema
    assert exact_dedup.deduplicate(nothing).count() == 0


def test_exact_long_common_prefixes(spark):
    rows = [(i, "p" * 5000 + str(i % 7) * (i % 3)) for i in range(200)]
    found = exact_dedup.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, []).append(i)
    assert {(r.doc.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()} == {
        (i, max(by_text[t]), len(by_text[t]), i == max(by_text[t])) for i, t in rows
    }


def test_exact_when_the_scan_is_split_anew(spark, tmp_path, monkeypatch):
    """Each job reads the files in other partitions, as when an executor is lost between them."""
    rows = [(i, ["same", "", None, "t" * 64, f"own {i}"][i % 5]) for i in range(80)] + [(7, "twice"), (7, "twice")]
    for k in range(8):
        spark.createDataFrame(rows[k::8], "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    write, splits = exact_dedup.Stage.write, [1, 64, 1, 64, 1, 64, 1, 64]

    def write_split_anew(self, df, narrow=False):
        spark.conf.set("spark.sql.files.minPartitionNum", splits.pop())
        return write(self, df, narrow)

    monkeypatch.setattr(exact_dedup.Stage, "write", write_split_anew)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        found = exact_dedup.duplicate_classes(spark.read.schema("doc_id long, text string").parquet(str(tmp_path / "docs"))).collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    ids = {}
    for i, t in rows:
        ids.setdefault(t or "", []).append(i)
    assert sorted((r.doc.doc_id, r.keep_id, r.group_size) for r in found) == sorted(
        (i, max(ids[t or ""]), len(ids[t or ""])) for i, t in rows
    )
    kept = [(r.doc.doc_id, r.doc.text or "") for r in found if r.kept]
    assert sorted(kept) == sorted((max(v), t) for t, v in ids.items())


# near dedup

def copies(seed):
    rnd, rows = random.Random(seed), []
    for group in range(12):
        base = [f"g{group}w{rnd.randint(0, 400)}" for _ in range(rnd.choice([1, 3, 5, 6, 40, 200]))]
        for _ in range(rnd.choice([1, 2, 9])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 9)}"
            rows.append(" ".join(w))
    rnd.shuffle(rows)
    return list(enumerate(rows + ["", None]))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_components(spark, seed):
    rows = copies(seed)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == R.near_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_group_without_central_text(spark):
    """A chain of copies in which far members share too little, and stragglers linked to one member."""
    w = [f"c{i}" for i in range(120)]
    rows = [(i, " ".join(w[2 * i:2 * i + 60])) for i in range(30)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == R.near_components(rows)


def test_near_group_of_many_degrees(spark):
    """One large group whose members lie at any distance from the base; some edits occur twice."""
    rnd, rows = random.Random(11), []
    base = [f"b{i}" for i in range(100)]
    for n in range(160):
        w = list(base)
        for _ in range(rnd.randint(0, 14)):
            w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 60)}"
        rows.append(" ".join(w))
        if n % 10 == 0:
            rows.append(" ".join(w[:-1]))
    rows = list(enumerate(rows))
    expected = R.near_components(rows)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == expected
    assert 20 < len({c for _, c in expected.values()}) < 160


def test_near_awkward(docs, nothing):
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    expected = R.near_components([(r[0], r[1]) for r in R.awkward_rows() if r[0] is not None])
    assert {x for x in found if x[0] is not None} == {(i, n, c, i == c) for i, (n, c) in expected.items()}
    kept = minhash.keep_one(docs)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect() if r.doc_id} == {i for i, (_, c) in expected.items() if i == c}
    assert minhash.near_duplicates(nothing).count() == 0 and minhash.keep_one(nothing).count() == 0


def test_superminhash_estimates_similarity():
    rnd = np.random.default_rng(3)
    for size in (3, 40, 2000):
        shared = rnd.integers(0, 2**63, size, dtype=np.uint64)
        sets = [np.concatenate([shared, rnd.integers(0, 2**63, size // 3, dtype=np.uint64)]) for _ in range(2)]
        text = np.repeat([0, 1], [len(s) for s in sets])
        a, b = minhash.signatures(text, np.concatenate(sets), 2, 1024 if size < 100 else 256)
        exact = size / (size + 2 * (size // 3))
        assert abs((a == b).mean() - exact) < 0.12
        places = minhash.signatures(text[text == 0], sets[0], 1, 8)[0]
        assert (places < 2**62).all()


def test_superminhash_is_a_permutation():
    """One shingle alone puts each round's rank in a place of its own."""
    for value in range(20):
        signature = minhash.signatures(np.zeros(1, int), np.array([value], np.uint64), 1, 64)[0]
        assert sorted(signature >> 32) == list(range(64))


# fingerprints

def test_fingerprints(docs, nothing):
    rows = fingerprints.with_next(docs).withColumn("edited", fingerprints.edited(F.col("text"), F.col("next_text"))).collect()
    order = sorted(((-1 if r[0] is None else r[0]), r[1] or "") for r in R.awkward_rows())
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.text, r.next_text, r.edited) for r in rows)
    expected = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        expected.append((i, t, following, t[:len(t) - half] + following[:half]))
    assert found == sorted(expected)
    packed = {}
    for r in rows:
        assert packed.setdefault(r.text, r.packed) == r.packed and len(r.packed) == 8
    assert fingerprints.with_next(nothing).count() == 0


def test_fingerprint_likeness(spark):
    rnd, rows = random.Random(5), []
    for size in (5, 8, 30, 150, 900):
        for share in (0.0, 0.5, 1.0):
            w = [f"w{rnd.random()}" for _ in range(size)]
            other = w[:int(size * share)] + [f"v{rnd.random()}" for _ in range(size - int(size * share))]
            rows.append((" ".join(w), " ".join(other)))
    df = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", fingerprints.likeness(
            fingerprints.packed_fingerprint(F.col("a")), fingerprints.packed_fingerprint(F.col("b"))
        ).alias("likeness"),
    )
    for r in df.collect():
        a, b = R.shingle_set(r.a), R.shingle_set(r.b)
        assert abs(r.likeness - len(a & b) / len(a | b)) < 0.17, (r.likeness, len(a))


def test_fingerprint_neighbours_across_blocks(spark):
    rows = [(i * i * 37, f"text {i}") for i in range(3000)]
    found = fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    following = {a[0]: b[1] for a, b in zip(rows, rows[1:] + rows[:1])}
    assert {r.doc_id: r.next_text for r in found} == following


# mixing

def test_mix(spark):
    rnd = random.Random(9)
    sources = ["a"] * 300 + ["b"] * 40 + ["B"] * 60 + [None] * 30 + ["ü"] * 10 + [""] * 5
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 30])), s) for i, s in enumerate(sources)]
    plan = curriculum.plan_mix(
        spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3),
        curriculum.word_count(), carry=("doc_id", "source"),
    ).collect()
    sizes, taken = {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    targets = R.mix_targets(sizes)
    for r in plan:
        s = r.doc.source
        assert r.source_size == sizes[s] and abs(r.target - targets[s]) < 1e-6
        assert len(r.due) <= 3 and all(0 <= t <= 1 for t in r.due) and r.due == sorted(r.due)
        taken[s] = taken.get(s, 0) + r.size * len(r.due)
    assert all(abs(taken[s] - targets[s]) <= 15 for s in sizes)


def test_due_time_inverts_the_schedule(spark):
    for knots in curriculum.SCHEDULES + ((0.0, 2.0, 1.0, 0.5),):
        shares = [i / 50 for i in range(51)]
        df = spark.createDataFrame([(x,) for x in shares], "x double")
        times = [r.t for r in df.select("x", curriculum.due_time(F.col("x"), knots).alias("t")).orderBy("x").collect()]
        grid = np.linspace(0, 1, 20_001)
        weight = np.interp(grid, np.linspace(0, 1, len(knots)), knots)
        spent = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2)])
        assert np.allclose(np.interp(times, grid, spent / spent[-1]), shares, atol=1e-3)


def test_mix_awkward(docs, nothing):
    plan = curriculum.plan_mix(docs, curriculum.word_count())
    assert plan.count() == len(R.awkward_rows())
    assert curriculum.in_training_order(plan).select("doc.*").schema == docs.schema
    due = [r.due for r in curriculum.in_training_order(plan).collect()]
    assert due == sorted(due) and due
    assert curriculum.plan_mix(nothing, curriculum.word_count()).count() == 0


# packing and tokens

def test_tokens_equal_the_tokenizer_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rnd = random.Random(4)
    texts = ["<|endoftext|> a  b\n\n c d", "don't  I'll\t\t x1²", ""]
    texts += ["".join(map(chr, (rnd.choice([rnd.randrange(32, 127), rnd.randrange(160, 0x2FFF), rnd.randrange(0x1F300, 0x1F700)])
              for _ in range(60)))) for _ in range(300)]
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [tokens.encoder().encode_ordinary(t) for t in texts] == expected


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_long_blanks(spark, blank):
    """Longer than the pattern of the fast encoder can follow."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["word" + blank * n + "x" for n in (2_000_000, tokens.LONGEST_BLANK, tokens.LONGEST_BLANK + 1)] + ["short"]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [tokens.encode(t) for t in texts] == expected
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = packing.pack(rows, with_ids=False).groupBy("doc.doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens"))
    assert {tuple(r) for r in pieces.collect()} == {(i, len(e) + 1, len(e) + 1) for i, e in enumerate(expected)}
    turns = chat.format_turns(rows.selectExpr("doc_id AS conv_id", "0 AS turn", "'assistant' AS role", "text"))
    read = {r.conv_id: r.loss_sha256 for r in chat.read_back(turns).collect()}
    assert read == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts)}


def test_piece_lengths():
    for n in [*range(1, 5000), 123_457]:
        lengths = packing.piece_lengths(n)
        assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
        assert all(x <= 2048 and x & (x - 1) == 0 for x in lengths)


def test_pack(docs, nothing, tmp_path):
    found = packing.pack(docs, carry=("doc_id", "text")).collect()
    assert len({r.sequence_id for r in found}) == len(found) and all(r.offset == 0 for r in found)
    pieces = {}
    for r in found:
        pieces.setdefault((r.doc.doc_id, r.doc.text), {}).setdefault(r.start, []).append(r)
    for (_, text), by_start in pieces.items():
        copies = {len(x) for x in by_start.values()}
        assert len(copies) == 1
        ids, at = [], 0
        for start in sorted(by_start):
            assert start == at
            at += by_start[start][0].length
            ids += by_start[start][0].ids
        assert ids == tokens.encoder().encode_ordinary(text or "") + [1]
    assert packing.pack(nothing).count() == 0
    packing.write_buckets(packing.pack(docs), str(tmp_path / "buckets"))
    back = docs.sparkSession.read.parquet(str(tmp_path / "buckets"))
    assert back.count() == len(found) and back.filter("length != shiftleft(1, bucket)").count() == 0


# chat

def test_chat_round_trip(spark):
    marks = [*chat.CONTROL, "\\", "\\\\<turn>", "#### User:", "<turn></turn>", "\n", "plain", "é\U0001F642", ""]
    rnd = random.Random(2)
    for _ in range(300):
        text = "".join(rnd.choices(marks, k=6))
        written = chat.escape(text)
        assert chat.unescape(written) == text and not any(c in written for c in chat.CONTROL)
        assert "\n" not in chat.escape_role(text).replace("\\\n", "")


def test_chat(spark):
    rows = [
        (1, 0, "user", "hi </turn>"), (1, 1, "assistant", "yes\\"), (1, 2, "assistant", "### User: no"), (2, 0, "user", None),
        (2, 1, None, "x"), (3, 5, "assistant", ""), (None, 1, "assistant", "lost"), (4, None, "assistant", "first"),
        (4, 0, "assistant", "second"), (5, 0, "user", "same"), (5, 0, "user", "same"), (6, 0, "assistant", R.LONG), (7, 0, "a\nb", "c"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit("clash"))
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(df.repartition(4))).collect()}
    expected = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1])):
        expected.setdefault(c, []).append((role or "", text or ""))
    assert set(found) == set(expected)
    for c, turns in expected.items():
        learned = "".join(t for role, t in turns if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for role, t in turns)
        written = sum(len(chat.escape_role(role)) + len(chat.escape(t)) + 15 for role, t in turns)
        r = found[c]
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(turns), len(learned), written)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_chat_masks_by_token(spark):
    df = spark.createDataFrame([(1, 0, "user", "a b"), (1, 1, "assistant", "c d e")], "conv_id long, turn long, role string, text string")
    first, second = sorted(chat.format_turns(df).collect(), key=lambda r: r.turn)
    assert not any(first.loss) and first.start == 0 and second.start == len(first.ids)
    learned = [i for i, on in zip(second.ids, second.loss) if on]
    assert tokens.encoder().decode(learned) == "c d e"
    assert second.ids[0] == chat.BEGIN and second.ids[-1] == chat.END
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


# personal data

def naive_spans(text):
    import re

    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )
    out = []
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans():
    rnd = random.Random(8)
    for _ in range(20_000):
        text = "".join(rnd.choices("ab.@-+ 0019()%\né", k=rnd.randint(0, 40)))
        assert pii.base_spans(text) == naive_spans(text), text
    card = "4111111111111111"
    for text in (f"x {card} y", f"{card[:4]} {card[4:8]}-{card[8:]}", "1.2.3.4.5.6.7.8", "0000255.1.1.1", "a@b.c@d.e", "+1 (555) 010-1234."):
        assert pii.base_spans(text) == naive_spans(text)


def test_base_spans_are_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "@" * 100_000, "+1" + " " * 200_000, "1." * 100_000):
        pii.base_spans(text)


def test_field_learns_and_generalises(spark, docs, nothing):
    model = pii.train()
    right = total = 0
    for text, spans, states in pii.labelled_table():
        marked = {a for (a, _), s in zip(spans, states) if s % 2}
        found = {a for a, _, _ in pii.added_spans([text], model)[0]}
        right, total = right + len(marked & found), total + len(marked)
    assert right >= 0.95 * total
    new = "Ask (646) 555-0133 or write to ann.lee [at] mail9.example.com, card 4111.1111.1111.1111 and " + "word " * 50 + "é in 1987"
    rows = spark.createDataFrame([(1, new), (2, "mail x.y@z.example.org now"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(rows, model).collect()}
    assert {new[s.start:s.end] for s in found[1].added} >= {"(646) 555-0133", "4111.1111.1111.1111"}
    assert [(s.kind, s.start, s.end) for s in found[2].base] == [("email", 5, 22)] and not found[2].added
    assert not found[3].base and not found[3].added
    assert pii.find(docs, model).count() == docs.count() and pii.find(nothing, model).count() == 0


def test_viterbi_equals_brute_force():
    from itertools import product

    rnd = np.random.default_rng(1)
    states = len(pii._STATES)
    change = rnd.normal(size=(states, states))
    n = np.array([3, 1, 4])
    emit = rnd.normal(size=(n.sum(), states))
    first = np.cumsum(n) - n
    label = pii.viterbi(emit, first, n, change)
    begins = [0, *range(1, states, 2)]
    for at, size in zip(first, n):
        best = max(
            (p for p in product(range(states), repeat=int(size)) if p[0] in begins),
            key=lambda p: sum(emit[at + i, s] for i, s in enumerate(p)) + sum(change[a, b] for a, b in zip(p, p[1:])),
        )
        assert tuple(label[at:at + size]) == best


# classifiers and language

def labelled(spark, toxic_words):
    rnd = random.Random(6)
    rows, marks = [], []
    for i in range(400):
        text = prose(rnd, "en", rnd.randint(20, 80)).split()
        toxic = i % 5 == 0
        good = i % 3 != 0
        if toxic:
            for _ in range(3):
                text.insert(rnd.randrange(len(text)), rnd.choice(toxic_words))
        if not good:
            text = [w.upper() + "!!" for w in text]
        rows.append((i, " ".join(text)))
        marks.append((i, int(good), int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
        spark.createDataFrame(marks, "doc_id long, quality int, toxic int"),
    )


def right(scored, labels, column):
    both = scored.select("doc.doc_id", "score").join(labels, "doc_id").filter("doc_id >= 300").collect()
    return sum((r.score >= 0.5) == (r[column] == 1) for r in both) / len(both)


@pytest.mark.parametrize("operator, column", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_unseen_rows(spark, docs, nothing, operator, column):
    texts, labels = labelled(spark, ["zork", "blam", "krull"])
    model = operator.fit(texts, labels.filter("doc_id < 300"), column)
    assert right(operator.predict(texts, model), labels, column) >= 0.93
    scores = operator.predict(docs, model, carry=("*",)).collect()
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    by_text = {}
    for r in scores:
        assert by_text.setdefault(r.doc.text or "", r.score) == r.score
    assert operator.predict(nothing, model).count() == 0
    for none in (operator.fit(texts, labels.limit(0), column), operator.fit(nothing, labels, column)):
        assert all(0 <= r.score <= 1 for r in operator.predict(docs, none).collect())


def test_nothing_confirmed_rejects_nothing(spark, docs):
    texts, labels = labelled(spark, ["zork"])
    for marks in (labels.limit(0), labels.withColumn("toxic", F.lit(0))):
        model = toxicity.fit(texts, marks, "toxic")
        assert toxicity.predict(docs, model).filter("score >= 0.5").count() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(60, 4))
    sign = np.where(x @ [1, -2, 0.5, 0] + 0.1 * rnd.normal(size=60) > 0, 1.0, -1.0)
    cost = np.full(60, 0.5)
    w, bias = quality.dual_coordinate_descent([(np.arange(4), row) for row in x], sign, 4, cost, 400)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - sign * (x @ w + b))).sum()

    for _ in range(200):
        step = rnd.normal(size=5) * 0.01
        assert loss(w, bias) <= loss(w + step[:4], bias + step[4]) + 1e-4


def test_languages(spark, docs, nothing):
    rnd = random.Random(7)
    rows = [(i, prose(rnd, k, 30), k) for i, k in enumerate(["en", "de", "fr"] * 30)]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(known.filter("doc_id < 60"))
    found = language.predict(known, model, carry=("doc_id", "lang")).collect()
    assert sum(r.lang_pred == r.doc.lang for r in found) >= 89
    mixed = prose(rnd, "en", 40) + " " + prose(rnd, "fr", 25) + " " + prose(rnd, "en", 5)
    [r] = language.predict(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).collect()
    assert r.lang_pred == "en" and [s.lang for s in r.spans][:2] == ["en", "fr"] and abs(r.spans[0].words - 40) <= 2
    awkward = {(r.doc.doc_id, r.doc.text): r for r in language.predict(docs, model, carry=("doc_id", "text")).collect()}
    for (i, text), r in awkward.items():
        letters = any(c.isalpha() for c in text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1, (i, r.lang_pred)
    assert language.predict(nothing, model).count() == 0
    none = language.fit(nothing)
    assert {r.lang_pred for r in language.predict(docs, none).collect()} == {"und"}


def test_scripts_narrow_candidates(spark):
    known = spark.createDataFrame(
        [(1, "abc dab cab " * 20, "xx"), (2, "абв даб " * 20, "yy")], "doc_id long, text string, lang string"
    )
    model = language.fit(known)
    texts = spark.createDataFrame([(1, "qqq zzz"), (2, "жжж щщ")], "doc_id long, text string")
    assert {r.doc.doc_id: r.lang_pred for r in language.predict(texts, model).collect()} == {1: "xx", 2: "yy"}


def test_language_viterbi_equals_brute_force():
    from itertools import product

    rnd = np.random.default_rng(4)
    n = np.array([4, 1, 6])
    scores = rnd.normal(scale=15, size=(n.sum(), 3)).astype(np.float32)
    first = np.cumsum(n) - n
    label = language._viterbi(scores, first, n)
    for at, size in zip(first, n):
        best = max(product(range(3), repeat=int(size)), key=lambda p: sum(
            float(scores[at + i, s]) for i, s in enumerate(p)) - language.SWITCH * sum(a != b for a, b in zip(p, p[1:])))
        assert tuple(label[at:at + size]) == best


def test_word_hashes_follow_words():
    column = pa.array(["a bc", "", "bc  a\ta", "a" * 3000])
    data, offsets = N.text_bytes(column)
    starts, ends, text = N.spans(~N.SEPARATOR[data], offsets)
    h = N.Rolling(data).of(starts, ends)
    assert text.tolist() == [0, 0, 2, 2, 2, 3]
    assert h[0] == h[3] == h[4] and h[1] == h[2] and len(set(h.tolist())) == 3
    [again] = N.slices([pa.RecordBatch.from_arrays([column], ["t"])], 0)
    assert again.num_rows == 4
    assert [b.num_rows for b in N.slices([pa.RecordBatch.from_arrays([column], ["t"])], 0, 5)] == [2, 1, 1]


# awkward sizes: ids far apart, long texts, few labels

@pytest.mark.parametrize("name, ids", [
    ("both ends", [-2**63, -2**63 + 1, -2**62, -5, 0, 5, 2**62, 2**63 - 1, None]),
    ("a dense cluster", [*range(10**15, 10**15 + 700), *(k * 10**16 + 3 for k in range(-300, 300))]),
    ("one id", [7] * 5), ("one row", [-9]), ("null", [None, None]),
])
def test_following_documents_of_any_ids(spark, monkeypatch, name, ids):
    monkeypatch.setattr(fingerprints, "_BLOCK_ROWS", 16)
    monkeypatch.setattr(fingerprints, "_QUANTILES", 8)
    rows = [(i, f"text {n:04d}") for n, i in enumerate(ids)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.text: r.next_text for r in fingerprints.with_next(docs).collect()}
    order = [t for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
    assert found == dict(zip(order, order[1:] + order[:1]))
    blocks = docs.select(fingerprints._block(docs.withColumn("key", F.col("doc_id")), F.col("doc_id")).alias("b")).groupBy("b").count().collect()
    assert len(blocks) <= len(rows) / 8 + 2 * 8 + 2


def test_pii_spans_apart():
    rnd = random.Random(8)
    for _ in range(300):
        others = sorted((a, 0, a + rnd.randint(1, 9)) for a in rnd.choices(range(60), k=rnd.randint(0, 8)))
        spans = sorted((a, 1, a + rnd.randint(1, 6)) for a in rnd.choices(range(60), k=8))
        assert list(pii._apart(spans, others)) == [
            (a, k, b) for a, k, b in spans if not any(a < end and start < b for start, _, end in others)
        ]


def test_pii_of_a_long_contact_list(spark):
    line = "reach (212) 555-0187 or 10 . 20 . 30 . 40, +1 212 555 0199 and a.b@example.org\n"
    text = line * (5_000_000 // len(line))
    docs = spark.createDataFrame([(1, text), (2, line)], "doc_id long, text string")
    start = time.perf_counter()
    found = {r.doc_id: r for r in pii.find(docs, pii.train()).collect()}
    assert time.perf_counter() - start < 240
    assert len(found[1].base) == len(text) // len(line) * len(found[2].base)


def test_language_of_long_texts_by_pieces():
    rnd = np.random.default_rng(9)
    n = np.array([40, 3, 0, 17, 16, 33, 1])
    scores = rnd.normal(scale=9, size=(n.sum(), 3)).astype(np.float32)
    first = np.cumsum(n) - n

    def worth(path, own):
        return sum(float(own[i, s]) for i, s in enumerate(path)) - language.SWITCH * sum(a != b for a, b in zip(path, path[1:]))

    whole = language._viterbi(scores, first, n)
    for piece in (1, 2, 5, 16):
        label = language._viterbi(scores, first, n, piece)
        for a, size in zip(first, n):
            own = scores[a:a + size]
            assert worth(label[a:a + size], own) == pytest.approx(worth(whole[a:a + size], own), abs=1e-3)


def test_language_of_one_very_long_text(spark):
    rnd = random.Random(2)
    rows = [(i, prose(rnd, lang, 60), lang) for i, lang in enumerate(["en", "de", "fr"] * 40)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    parts = [(lang, prose(rnd, lang, 4000)) for lang in ["en", "de", "fr"] * 30]
    text = " ".join(t for _, t in parts)
    start = time.perf_counter()
    [found] = language.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert time.perf_counter() - start < 2 * len(text) / 1e6 + 20
    assert [s.lang for s in found.spans if s.words > 1000] == [lang for lang, _ in parts]


def test_toxicity_with_confirmed_texts_alone(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FEW", 50)  # as with many confirmed texts, other labels are not read
    texts, marks = labelled(spark, ["scum", "vermin", "wretch"])
    both = toxicity.fit(texts, marks, "toxic")
    alone = toxicity.fit(texts, marks.filter("toxic = 1"), "toxic")
    assert np.array_equal(both.weight, alone.weight) and both.bias == alone.bias
    truth = {r.doc_id: r.toxic for r in marks.collect()}
    found = {r.doc.doc_id: r.score >= 0.5 for r in toxicity.predict(texts, alone).collect()}
    assert sum(found[i] == bool(t) for i, t in truth.items()) >= 0.97 * len(truth)


def test_toxicity_samples_stay_bounded(spark, monkeypatch):
    """One document and one label repeated without end take one place in a sample."""
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda p, u, prior, *a: (seen.append((len(p), len(u))), toxicity.Model(np.zeros(toxicity.BUCKETS), 1.0))[1])
    texts = [(i, f"text {i}") for i in range(60)] + [(7, "text 7")] * 5000
    marks = [(i, 1) for i in range(0, 60, 2)] + [(7, 1)] * 5000
    toxicity.fit(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int"), "toxic", prior=0.1)
    assert seen == [(31, 60)]


def sparse_lists(rows):
    return pa.array(rows, pa.list_(pa.int32()))


def test_non_negative_risk_equals_plain_loop(monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_TEXTS", 1)
    monkeypatch.setattr(toxicity, "STEPS", 40)
    rnd = random.Random(3)
    positive = [sorted(rnd.sample(range(6), 3)) for _ in range(7)]
    unlabelled = [sorted(rnd.sample(range(2, 9), 3)) for _ in range(15)]
    for prior in (0.1, 0.6):  # the second one makes the difference negative on the way
        model = toxicity.train(sparse_lists(positive), sparse_lists(unlabelled), prior, 9)
        w, pace = [0.0] * 9 + [math.log(prior / (1 - prior))], [0.0] * 10

        def slopes(rows, slope):
            out = [0.0] * 10
            for row in rows:
                z = sum(w[f] for f in row) + w[9]
                for f in [*row, 9]:
                    out[f] += slope(1 / (1 + math.exp(-z))) / len(rows)
            return out

        for _ in range(40):
            def loss(rows):
                return sum(math.log1p(math.exp(sum(w[f] for f in row) + w[9])) for row in rows) / len(rows)

            rest = loss(unlabelled) - prior * loss(positive)
            clean = [u - prior * p for u, p in zip(slopes(unlabelled, lambda s: s), slopes(positive, lambda s: s))]
            toxic = [prior * x for x in slopes(positive, lambda s: s - 1)]
            step = [t + c for t, c in zip(toxic, clean)] if rest >= 0 else [-c for c in clean]
            pace = [toxicity.MOMENTUM * a + b for a, b in zip(pace, step)]
            for f in range(10):
                w[f] -= toxicity.RATE * pace[f] * (1 if f < 9 else 0.3)
            shrink = toxicity.RATE / (1 - toxicity.MOMENTUM) * toxicity.SPARSITY
            w[:9] = [math.copysign(max(abs(x) - shrink, 0), x) for x in w[:9]]
        assert model.weight == pytest.approx(w[:9], abs=1e-9) and model.bias == pytest.approx(w[9], abs=1e-9)


@pytest.mark.parametrize("share", [0.05, 0.3])
def test_prior_is_estimated_from_scores(share):
    rnd = random.Random(5)

    def text(toxic):
        return sorted({rnd.randrange(40) for _ in range(12)} | ({40 + rnd.randrange(4) for _ in range(2)} if toxic else set()))

    positive = sparse_lists([text(True) for _ in range(300)])
    unlabelled = sparse_lists([text(rnd.random() < share) for _ in range(900)])
    assert abs(toxicity.estimate_prior(positive, unlabelled, (np.arange(300), np.arange(900)), 64) - share) < 0.04
