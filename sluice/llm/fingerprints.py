"""Document fingerprints by one-permutation MinHash with optimal densification.

Each five-word shingle is hashed once: the upper bits choose one of 128 bins, the smallest hash of
a bin is its value. An empty bin copies the value of another one, found by a probe sequence that
depends on the empty bin alone, so texts with the same shingles fill it alike and every full bin
is as likely. Four low bits of each value are kept. Two unrelated values agree in them by chance
once in 16 times, which the likeness corrects for.

All of it is column expressions: hashes of a text stay in one array, sorted once, so no shingle
becomes a row and only fingerprints are shuffled with the texts they belong to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sluice.llm.common import Stage, sha256_hex, whole_text

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 4
#: Probes made one by one; if all hit empty bins, the full bin of least rank is taken.
PROBES = 12
_PER_LONG = 64 // LOW_BITS
_LONGS = BINS // _PER_LONG
_BLOCK_ROWS = 256
_QUANTILES = 1024


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _bin(h: Column) -> Column:
    return F.shiftright(h, 64 - BIN_BITS).cast("int") + BINS // 2


def shingle_hashes(text: Column) -> Column:
    """Hashes of all five-word shingles; with fewer words, of the whole sequence; else none."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return _let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(hashes) - (SHINGLE - 1), F.lit(1))),
                lambda i: F.xxhash64(F.slice(hashes, i, SHINGLE)),
            )
        ),
    )


def _smallest_by_bin(ordered: Column) -> Column:
    return F.filter(ordered, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(ordered, i - 1))))


def _with_gaps(full: Column) -> Column:
    """The values of all bins in order, null where a bin is empty."""
    def gap(n: Column) -> Column:
        return F.array_repeat(F.lit(None).cast("bigint"), n)

    def value_and_gap(h: Column, i: Column) -> Column:
        following = F.coalesce(_bin(F.get(full, i + 1)), F.lit(BINS))
        return F.concat(F.array(h), gap(following - _bin(h) - 1))

    return F.concat(gap(_bin(F.get(full, 0))), F.flatten(F.transform(full, value_and_gap)))


def _densified(full: Column) -> Column:
    def fill(values: Column) -> Column:
        def filled(value: Column, i: Column) -> Column:
            probes = [F.get(values, F.pmod(F.xxhash64(i, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(PROBES)]
            ranked = F.transform(full, lambda h: F.struct(F.xxhash64(i, _bin(h)).alias("rank"), h.alias("h")))
            return F.coalesce(value, *probes, F.array_min(ranked)["h"])

        return F.transform(values, filled)

    return F.when(F.size(full) == BINS, full).otherwise(_let(_with_gaps(full), fill))


def packed_fingerprint(text: Column) -> Column:
    """The low bits of all bins, 16 bins to a long. Texts without words have zeros."""
    def pack(values: Column) -> Column:
        low = F.lit((1 << LOW_BITS) - 1).cast("bigint")
        return F.transform(
            F.sequence(F.lit(0), F.lit(_LONGS - 1)),
            lambda k: F.aggregate(
                F.slice(values, k * _PER_LONG + 1, _PER_LONG), F.lit(0).cast("bigint"),
                lambda acc, h: F.shiftleft(acc, LOW_BITS).bitwiseOR(h.bitwiseAND(low)),
            ),
        )

    return _let(
        F.sort_array(shingle_hashes(text)),
        lambda ordered: F.when(F.size(ordered) == 0, F.array_repeat(F.lit(0).cast("bigint"), _LONGS)).otherwise(
            _let(_smallest_by_bin(ordered), lambda full: _let(_densified(full), pack))
        ),
    )


def as_text(packed: Column) -> Column:
    """One hexadecimal digit for each bin."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1, corrected for agreement by chance."""
    def different(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    differing = F.aggregate(F.zip_with(a, b, different), F.lit(0), lambda acc, n: acc + n)
    chance = 1 / (1 << LOW_BITS)
    return F.greatest(F.lit(0.0), (1 - differing / F.lit(float(BINS)) - F.lit(chance)) / F.lit(1 - chance))


def _block(rows: DataFrame, key: Column) -> Column:
    """The block of neighbouring ids a row is in: blocks rise with the id and hold some 128 to 256 rows.

    Quantiles of the ids cut the table into intervals of about as many rows, and each interval is cut
    into equal widths, powers of two. However ids are spread, there are not many more blocks than
    one in 128 rows, and none has more rows than an interval. Null ids come before all others.
    """
    shares = F.array(*[F.lit(i / _QUANTILES) for i in range(1, _QUANTILES)])
    n, first, last, inner = rows.agg(
        F.count("*"), F.min(key), F.max(key), F.percentile_approx(key, shares, 10_000)
    ).first()
    if first is None:
        return F.lit(-1).cast("long")
    bounds = sorted({first, *(inner or [])})
    wanted = -(-n // (_BLOCK_ROWS * len(bounds)))
    spans = [b - a for a, b in zip(bounds, [*bounds[1:], last + 1])]
    bits = [max((span // wanted).bit_length() - 1, 0) if span > wanted else 0 for span in spans]
    rule = F.array(*[
        F.struct(F.lit(b).cast("long").alias("from"), F.lit(k).alias("bits"), F.lit(b >> k).cast("long").alias("zero"))
        for b, k in zip(bounds, bits)
    ])
    def further(place: Column, step: Column) -> Column:
        probe = place + step
        return F.when((probe < len(bounds)) & (F.get(rule, probe)["from"] <= key), probe).otherwise(place)

    # The last interval that begins at or below the key, found by halving.
    steps = [1 << i for i in range((len(bounds) - 1).bit_length())]
    place = F.aggregate(F.array(*map(F.lit, reversed(steps))).cast("array<int>"), F.lit(0), further)
    return F.when(key.isNull(), F.lit(-1).cast("long")).otherwise(_let(
        F.struct(place.alias("place"), key.alias("key")),
        lambda x: _let(
            F.get(rule, x["place"]),
            lambda r: F.shiftleft(x["place"].cast("long"), 40) + F.call_function("shiftright", x["key"], r["bits"]) - r["zero"],
        ),
    ))


def _following(blocks: DataFrame) -> DataFrame:
    """For each block the next one that has rows, or null: windows over 1024 blocks at a time."""
    coarse = blocks.select("block", F.floor(F.col("block") / 1024).alias("range"))
    heads = coarse.groupBy("range").agg(F.min("block").alias("head"))
    heads = heads.select("range", F.lead("head").over(W.orderBy("range")).alias("next_head"))
    inside = F.lead("block").over(W.partitionBy("range").orderBy("block"))
    return coarse.withColumn("inside", inside).join(heads, "range").select(
        "block", F.coalesce("inside", "next_head").alias("next_block")
    )


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, packed, next_text, next_packed: each text with the next document's, by id.

    The last document is followed by the first. Rows with one id follow each other by text; null
    ids come first. Rows are dealt in blocks of neighbouring ids. Only the first text of each block is needed
    elsewhere: it goes to the block before.
    """
    stage = Stage(docs.sparkSession, "neighbours")
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(F.col(text_col)).alias("text"))
    rows = rows.withColumn("key", F.col("doc_id").cast("long"))
    rows = rows.withColumn("block", _block(rows, F.col("key")))
    firsts = stage.write(
        rows.groupBy("block").agg(F.min_by("text", F.struct("key", "text")).alias("first_text"))
        .withColumn("first_packed", packed_fingerprint(F.col("first_text")))
    )
    first_block = F.lit(firsts.agg(F.min("block")).first()[0])
    order = _following(firsts).select(F.col("block").alias("at"), F.coalesce("next_block", first_block).alias("block"))
    border = order.join(firsts.hint("merge"), "block").select(F.col("at").alias("block"), "first_text", "first_packed")
    border = stage.write(border)
    stage.clear(border)
    near = W.partitionBy("block").orderBy("key", "text")
    return (
        rows.withColumn("packed", packed_fingerprint(F.col("text")))
        .join(border.hint("merge"), "block")
        .withColumn("next", F.lead(F.struct("text", "packed")).over(near))
        .select(
            "doc_id", "text", "packed",
            F.coalesce("next.text", "first_text").alias("next_text"),
            F.coalesce("next.packed", "first_packed").alias("next_packed"),
        )
    )


def edited(text: Column, following: Column) -> Column:
    """The text with its second half replaced by as much of the following text's beginning."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))
