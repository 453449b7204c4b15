"""One query for each operator, over its whole table, and SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.llm import (
    chat, curriculum, exact_dedup, fingerprints, language, minhash, packing, pii, quality, search, tokenfile, toxicity,
    whitening,
)
from sluice.llm.common import fold, sha256_hex, table, whole_text
from sluice.session import new_folder


#: A conversation whose texts look like the template's own marks and escapes.
TRICKY = r"\### Assistant: </turn> ok"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], rows.schema)
    return chat.read_back(chat.format_turns(rows.unionByName(tricky)))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", sha256_hex(whole_text(F.col("text"))).alias("text_sha256")
    )
    classes = exact_dedup.duplicate_classes(docs, carry=("doc_id", "text_sha256"))
    return classes.select("doc.doc_id", "keep_id", "group_size", "kept", "doc.text_sha256")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), pii.train())

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def rank(span: Column) -> Column:
        return F.struct(span["start"], F.array_position(F.array(*map(F.lit, pii.KINDS)), span["kind"]), span["end"])

    def by_place(a: Column, b: Column) -> Column:
        return F.when(rank(a) < rank(b), -1).when(rank(a) > rank(b), 1).otherwise(0)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), sha256_hex(listed(F.col("base"))).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"), by_place)).alias("spans"),
    )


def _held_out(folds: int, held: int) -> Column:
    return fold(F.col("doc_id"), folds) == held


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), _held_out(3, 1)
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(~held), "quality")
    return _scored(quality.predict(docs, model), held)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), _held_out(5, 0)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held), "toxic")
    return _scored(toxicity.predict(docs, model), held)


def _scored(scores: DataFrame, held: Column) -> DataFrame:
    return scores.select("doc.doc_id", "score").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), with_ids=False)
    return pieces.select(
        "doc.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op7_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = curriculum.plan_mix(
        table(spark, sf_dir, "documents"), curriculum.word_count(), carry=("doc_id",)
    )
    # In training order, by the first time a document is due; those not taken follow.
    return plan.orderBy(F.coalesce(F.get("due", 0), 1 + F.col("place"))).select(
        "doc.doc_id", "size", "source_size", "target", (F.col("size") * F.size("due")).alias("taken")
    )


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fingerprints.with_next(table(spark, sf_dir, "documents"))
    pairs = pairs.withColumn("edited", fingerprints.edited(F.col("text"), F.col("next_text")))
    pairs = pairs.withColumn("edited_packed", fingerprints.packed_fingerprint(F.col("edited")))
    return pairs.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), sha256_hex(F.col("edited")).alias("edited_sha256"),
        fingerprints.as_text(F.col("packed")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_packed")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"),
        fingerprints.likeness(F.col("packed"), F.col("next_packed")).alias("near_next"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), _held_out(3, 1)
    model = language.fit(docs.filter(~held))
    return language.predict(docs, model).select(
        "doc.doc_id", "lang_pred", "score", F.size("spans").alias("n_spans")
    ).select("doc_id", held.alias("held_out"), "lang_pred", "score", "n_spans")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"), carry=("vec_id",))
    return whitened.select("doc.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.rank_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=("item_id",)
    )
    return found.select("item.item_id", "rank", "doc.doc_id", "score")


def op13_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "ids")
    tokenfile.write_files(table(spark, sf_dir, "documents"), folder)
    return tokenfile.read_files(spark, folder)


_TRICKY_SQL = TRICKY.replace("'", "''")
_TERM_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER_SQL = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op1_chat": rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '{_TRICKY_SQL}'), (-7, 1, 'assistant', '{_TRICKY_SQL}')
        ), escaped AS (
            SELECT *, regexp_replace(regexp_replace(text, '\\', '\\\\', 'g'),
                '(<)(turn>|/turn>|\|endoftext\|>|\|im_start\|>|\|im_end\|>)|(#)(## (?:System|User|Assistant):)',
                '\1\3\\\2\4', 'g') AS written
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(role) + length(written) + 15)::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id
    """,
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op7_curriculum": """
        WITH docs AS (
            SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                   md5(doc_id::VARCHAR) AS digest
            FROM documents
        ), sources AS (
            SELECT no_source, source, sum(size)::BIGINT AS words,
                   [5, 2, 1][((row_number() OVER (ORDER BY no_source, source) - 1) % 3 + 1)::INT] AS weight
            FROM docs GROUP BY no_source, source
        ), levels AS (
            SELECT *, 3 * words AS cap, 3 * words / weight AS ratio,
                   ((sum(words) OVER ()) - coalesce(sum(3 * words) OVER earlier, 0))::DOUBLE
                   / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER earlier, 0))::DOUBLE AS level
            FROM sources
            WINDOW earlier AS (ORDER BY 3 * words / weight, no_source, source
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), targets AS (
            SELECT no_source, source, words AS source_size,
                   least(cap::DOUBLE, arg_min(level, (ratio, no_source, source)) FILTER (level <= ratio) OVER () * weight)
                   AS target
            FROM levels
        ), placed AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY no_source, source ORDER BY digest, size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM docs JOIN targets USING (no_source, source)
        )
        SELECT doc_id, size, source_size, target,
               (size * ((2 * start + size <= 2 * target)::BIGINT
                        + (2 * (start + source_size) + size <= 2 * target)::BIGINT
                        + (2 * (start + 2 * source_size) + size <= 2 * target)::BIGINT))::BIGINT AS taken
        FROM placed
    """,
    "op12_search": rf"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all({_LOWER_SQL.format('text')}, '{_TERM_SQL}')) AS term FROM documents
        ), counts AS (
            SELECT doc_id, term, count(*) AS tf, sum(count(*)) OVER (PARTITION BY doc_id)::BIGINT AS n
            FROM words GROUP BY doc_id, term
        ), collection AS (
            SELECT count(DISTINCT doc_id) AS documents, sum(tf)::BIGINT AS words FROM counts
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM counts, collection GROUP BY term, documents
        ), wanted AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER_SQL.format('text')}, '{_TERM_SQL}')) AS term FROM benchmark
        ), scores AS (
            SELECT item_id, doc_id, sum(w * (1000000000 * tf // (1000 * tf + 20 * (50 + 50 * n * documents // words))))::BIGINT AS score
            FROM wanted JOIN counts USING (term) JOIN weights USING (term), collection GROUP BY item_id, doc_id
        )
        SELECT item_id, row_number() OVER best AS rank, doc_id, score FROM scores WHERE score > 0
        WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 50
    """,
}

_QUERIES = [
    op1_chat, op2_exact_dedup, op3_quality, op4_pii, op5_toxicity, op6_packing, op7_curriculum, op8_minhash,
    op9_fingerprints, op10_language, op11_whitening, op12_search, op13_tokenfile,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
