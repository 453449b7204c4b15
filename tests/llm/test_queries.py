"""The registered queries on whole small tables, against SQL, brute force or held-out labels."""

import hashlib
import os
import zlib

import duckdb
import pytest
import reference_text as R
from oracle_check import compare
from test_operators import naive_spans

import corpus_pipeline
from sluice.llm import pii, queries as Q, tokens

SMALL, MEDIUM = (os.environ.get(k, f"/root/testdata/{d}") for k, d in (("TEST_SF_DIR", "sf0.001"), ("TEST_SF_DIR_2", "sf0.01")))
pytestmark = pytest.mark.skipif(not (os.path.isdir(SMALL) and os.path.isdir(MEDIUM)), reason="no test tables")


def run(spark, name, sf_dir=SMALL):
    return Q.queries()[name](spark, sf_dir).collect()


def documents(spark, sf_dir=SMALL):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    assert compare(spark, con, SMALL, name) is None


def test_all_operators_are_registered():
    assert [int(name[2:].split("_")[0]) for name in Q.queries()] == list(range(1, 14))


def test_pii(spark):
    found = {r.doc_id: r for r in run(spark, "op4_pii")}
    docs = documents(spark)
    assert len(found) == len(docs)
    for d in docs:
        spans = naive_spans(d.text or "")
        base = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        r = found[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert set(base) <= set(r.spans.split(",") if r.spans else [])


def test_packing(spark):
    pieces = {}
    for r in run(spark, "op6_packing"):
        pieces.setdefault(r.doc_id, {})[r.start] = r
    for d in documents(spark):
        ids, at = [*tokens.encoder().encode_ordinary(d.text or ""), 1], 0
        for start in sorted(pieces[d.doc_id]):
            r = pieces[d.doc_id][start]
            cut = b"".join(i.to_bytes(4, "little") for i in ids[start:start + r.length])
            assert start == at and zlib.crc32(cut) == r.ids_crc32 and r.doc_tokens == len(ids)
            at += r.length
        assert at == len(ids)


def test_near_duplicates(spark):
    rows = [(d.doc_id, d.text) for d in documents(spark)]
    found = run(spark, "op8_minhash")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == R.near_components(rows)


def test_fingerprints(spark):
    docs, found = documents(spark), {r.doc_id: r for r in run(spark, "op9_fingerprints")}
    wrong = 0
    for d, following in zip(docs, docs[1:] + docs[:1]):
        half = len(d.text) // 2
        edited = d.text[:len(d.text) - half] + following.text[:half]
        r = found[d.doc_id]
        assert r.n_chars == len(d.text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((r.near_edited, edited), (r.near_next, following.text)):
            a, b = (frozenset(zip(*[t.split()[k:] for k in range(5)])) for t in (d.text, other))
            wrong += len(a) > 5 and abs(near - len(a & b) / max(1, len(a | b))) > 0.15
    assert wrong <= 0.01 * len(docs)


@pytest.mark.parametrize("name, column, least", [("op3_quality", "quality", 0.97), ("op5_toxicity", "toxic", 0.95)])
def test_held_out_labels(spark, name, column, least):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    folds, held = (3, 1) if column == "quality" else (5, 0)
    rows = run(spark, name, MEDIUM)
    assert len(rows) == len(documents(spark, MEDIUM))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    unseen = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert sum(unseen) / len(unseen) >= least


def test_languages(spark):
    rows = {r.doc_id: r for r in run(spark, "op10_language", MEDIUM)}
    unseen = [rows[d.doc_id].lang_pred == d.lang for d in documents(spark, MEDIUM) if rows[d.doc_id].held_out]
    assert sum(unseen) / len(unseen) >= 0.98


# The pipeline, stage by stage

def test_pipeline_stages(spark, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "minhash_near_dedup", "mixing", "packing"]
    before = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = before.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SMALL).write.parquet(f"{tmp_path}/{i}")
        before = spark.read.parquet(f"{tmp_path}/{i}")
        assert name == "packing" or before.columns == columns
        kept[name] = before.collect()

    docs = documents(spark)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    clean = {d.doc_id for d in kept["toxicity"]}
    assert all(d.doc_id in clean for d in docs if labels.get(d.doc_id) == 0)
    assert not any(labels.get(i) == 1 for i in clean)

    largest = {}
    for d in kept["toxicity"]:
        largest[d.text] = max(d.doc_id, largest.get(d.text, -1))
    assert R.count(kept["exact_dedup"]) == R.count(d for d in kept["toxicity"] if largest[d.text] == d.doc_id)

    groups = R.near_components([(d.doc_id, d.text) for d in kept["exact_dedup"]])
    assert R.count(kept["minhash_near_dedup"]) == R.count(d for d in kept["exact_dedup"] if groups[d.doc_id][1] == d.doc_id)

    mixed = mixed_by_brute_force(kept["minhash_near_dedup"])
    assert R.count(kept["mixing"]) == R.count(mixed)

    ids = {}
    for r in kept["packing"]:
        assert r.length == len(r.ids) and r.length & (r.length - 1) == 0
        ids.setdefault(r.doc_id, []).append((r.start, tuple(r.ids)))
    times = {}
    for d in kept["mixing"]:
        times.setdefault(d.doc_id, []).append(d.text)
    for i, texts in times.items():
        whole = [*tokens.encoder().encode_ordinary(texts[0]), 1]
        assert sorted(ids[i]) == sorted(p for p in set(ids[i]) for _ in texts)
        assert [t for _, part in sorted(set(ids[i])) for t in part] == whole


def mixed_by_brute_force(docs):
    sizes = {}
    for d in docs:
        sizes[d.source] = sizes.get(d.source, 0) + len(R.words(d.text))
    targets, out = R.mix_targets(sizes), []
    for source, total in sizes.items():
        start = 0
        own = sorted((d for d in docs if d.source == source), key=lambda d: hashlib.md5(str(d.doc_id).encode()).hexdigest())
        for d in own:
            n = len(R.words(d.text))
            out += [d] * sum(2 * (start + k * total) + n <= 2 * targets[source] + 1e-6 for k in range(3))
            start += n
    return out


def test_pipeline_runs_whole(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
