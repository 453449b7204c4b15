"""Ranked lexical search by the Best Position Algorithm.

Texts are read once: each document's length and its counts of the query set's terms are written to
the shared folder, and the collection's figures (documents, words, documents holding a term) are
sums over those rows. The rows are then dealt out in blocks of documents, and in each block a term
has an impact list, its documents by falling contribution to a score.

For an item the lists of its terms are read side by side from the top. A document met for the first
time is looked up in all of the item's lists at once (direct access), which gives its whole score
and its position in every list. Positions seen either way are marked; as long as they have no gap
from the top, everything up to there is known. A document not met yet lies below that place in
every list, so the contributions there add up to a bound on its score. Reading ends when the bound
is strictly below the k-th best score, so equal scores are all met. A task keeps each item's best
scores from block to block; the best rows of all blocks are merged by windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from sluice.llm import words as N
from sluice.llm.common import Stage, whole_text

#: Bytes of terms: digits, letters and every byte of a character beyond ASCII.
TERM = N.LETTER.copy()
TERM[48:58] = True
BEST = 50
#: Scoring, in whole numbers: weight of the document's length in percent, saturation and scales.
LENGTH_SHARE, SATURATION = 50, 20
#: Bytes of query text that are looked for in one pass over the documents.
QUERY_BYTES = 16 << 20
#: Postings of a block of documents, which one task holds at a time.
BLOCK_POSTINGS = 1 << 21
#: Words of the documents that one task searches, in one or more blocks.
TASK_WORDS = 1 << 22
#: Positions of each list that are read at once, first; doubled as long as that does not suffice.
FIRST_READ = 32
#: An item's candidates are cut to the best in so many parts before one task sees them all.
MERGE_PARTS = 64


def term_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts with A-Z in lower case, and starts, ends and text numbers of their terms."""
    data, offsets = N.text_bytes(column)
    return (N.LOWER[data], *N.spans(TERM[data], offsets))


@dataclass(frozen=True)
class Queries:
    """A bounded set of items and the terms that occur in them, each term once."""

    items: pa.Array
    #: Term numbers of each item.
    terms: list[np.ndarray]
    #: Sorted hashes of the terms, and their bytes one after the other.
    hashes: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def size(self) -> int:
        return len(self.hashes)

    @classmethod
    def of(cls, items: pa.Array, texts: Sequence[str | None]) -> Queries:
        data, starts, ends, text = term_spans(pa.array([t or "" for t in texts], pa.string()))
        found = [data[a:b].tobytes() for a, b in zip(starts, ends)]
        distinct = sorted(set(found))
        sizes = np.array([len(t) for t in distinct], np.int64)
        data, ends = np.frombuffer(b"".join(distinct), np.uint8), np.cumsum(sizes)
        hashes = N.Rolling(data).of(ends - sizes, ends)
        order = np.argsort(hashes, kind="stable")
        number = {distinct[k]: i for i, k in enumerate(order)}
        own: list[set[int]] = [set() for _ in texts]
        for t, term in zip(text, found):
            own[t].add(number[term])
        terms = [np.array(sorted(s), np.int64) for s in own]
        return cls(items, terms, hashes[order], data, (ends - sizes)[order], ends[order])

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each span's term, -1 if no item has it. Bytes decide, hashes only narrow."""
        out = np.full(len(starts), -1, np.int64)
        if not self.size or not len(starts):
            return out
        h = N.Rolling(data).of(starts, ends)
        place = np.searchsorted(self.hashes, h)
        left = np.flatnonzero(self.hashes[np.minimum(place, self.size - 1)] == h)
        while len(left):  # once, unless terms share a hash
            term = place[left]
            same = (self.ends - self.starts)[term] == (ends - starts)[left]
            spans, term = left[same], term[same]
            sizes = (ends - starts)[spans]
            begins = np.cumsum(sizes) - sizes
            inner = np.arange(sizes.sum()) - np.repeat(begins, sizes)
            differs = data[np.repeat(starts[spans], sizes) + inner] != self.data[np.repeat(self.starts[term], sizes) + inner]
            equal = np.add.reduceat(differs, begins) == 0 if len(spans) else np.zeros(0, bool)
            out[spans[equal]] = term[equal]
            place[left] += 1
            left = left[(out[left] < 0) & (place[left] < self.size)]
            left = left[self.hashes[place[left]] == h[left]]
        return out


def count_terms(column: pa.Array, queries: Queries) -> tuple[np.ndarray, pa.ListArray, pa.ListArray]:
    """Of each text: number of terms with repeats, its terms that items have, and how often each occurs."""
    data, starts, ends, text = term_spans(column)
    rows = len(column)
    number = queries.numbers(data, starts, ends)
    hit = number >= 0
    keys, counts = np.unique(text[hit] * max(queries.size, 1) + number[hit], return_counts=True)
    in_text, term = np.divmod(keys, max(queries.size, 1))
    lists = [N.rows_of(in_text, values, rows) for values in (term.astype(np.int32), counts.astype(np.int32))]
    return np.bincount(text, minlength=rows).astype(np.int64), *lists


@dataclass(frozen=True)
class Collection:
    """Documents with a term, all their terms, and the weight of each query term."""

    documents: int
    words: int
    weights: np.ndarray

    @classmethod
    def of(cls, documents: int, words: int, holding: np.ndarray) -> Collection:
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding]
        return cls(documents, words, np.array(weights, np.int64))

    def impacts(self, term: np.ndarray, count: np.ndarray, length: np.ndarray) -> np.ndarray:
        """What a term that occurs so often in a document of that length adds to a score."""
        if len(length) and LENGTH_SHARE * int(length.max()) * self.documents >= 1 << 63:
            length = length.astype(object)
        m = (100 - LENGTH_SHARE + LENGTH_SHARE * length * self.documents // self.words).astype(np.int64)
        return self.weights[term] * (1_000_000_000 * count // (1000 * count + SATURATION * m))


class Block:
    """Impact lists of some documents, with direct access to a document's place in a list."""

    def __init__(self, length: np.ndarray, sizes: np.ndarray, term: np.ndarray, count: np.ndarray, collection: Collection):
        self.rows, self.terms = len(length), max(len(collection.weights), 1)
        self.doc = np.repeat(np.arange(self.rows), sizes)
        impact = collection.impacts(term, count, length[self.doc])
        used = impact > 0
        self.doc, term, self.impact = self.doc[used], term[used].astype(np.int64), impact[used]
        self.key = self.doc * self.terms + term  # rising: documents in order, their terms in order
        self.list = np.lexsort((self.doc, -self.impact, term))  # postings list by list, best first
        self.list_start = np.searchsorted(term[self.list], np.arange(self.terms + 1))
        self.place = np.empty(len(term), np.int64)
        self.place[self.list] = np.arange(len(term)) - self.list_start[term[self.list]]

    def best(self, terms: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents met and their scores: all that can be among the k best beside the ``known`` scores."""
        start = self.list_start[terms]
        sizes = self.list_start[terms + 1] - start
        terms, start, sizes = (a[sizes > 0] for a in (terms, start, sizes))
        lists = len(terms)
        offset = np.cumsum(sizes + 1) - sizes - 1
        seen = np.zeros(int((sizes + 1).sum()), bool)  # one place more than a list has, never seen
        contiguous = np.zeros(lists, np.int64)
        met = np.zeros(self.rows, bool)
        docs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        read, step = 0, FIRST_READ
        while lists:
            left = np.minimum(sizes, read + step) - np.minimum(sizes, read)
            inner = np.arange(left.sum()) - np.repeat(np.cumsum(left) - left, left)
            new = np.unique(self.doc[self.list[np.repeat(start + read, left) + inner]])
            new = new[~met[new]]
            met[new] = True
            wanted = (new[:, None] * self.terms + terms).ravel()
            at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            held = self.key[at] == wanted
            scores.append(np.where(held, self.impact[at], 0).reshape(len(new), lists).sum(axis=1))
            docs.append(new)
            which = np.flatnonzero(held)
            seen[offset[which % lists] + self.place[at[which]]] = True
            read, step = read + step, 2 * step
            for i in range(lists):
                contiguous[i] += np.argmin(seen[offset[i] + contiguous[i]:offset[i] + sizes[i] + 1])
            open_lists = contiguous < sizes
            if not open_lists.any():
                break
            bound = self.impact[self.list[(start + contiguous)[open_lists]]].sum()
            reached = np.concatenate([known, *scores])
            if len(reached) >= k and bound < np.partition(reached, len(reached) - k)[len(reached) - k]:
                break
        return np.concatenate(docs), np.concatenate(scores)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows put together to blocks of about ``BLOCK_POSTINGS``."""
    parts, postings = [], 0
    for batch in batches:
        parts.append(batch)
        postings += len(batch.column(2).flatten()) + batch.num_rows
        if postings >= BLOCK_POSTINGS:
            yield pa.Table.from_batches(parts)
            parts, postings = [], 0
    if parts:
        yield pa.Table.from_batches(parts)


def _search(batches: Iterator[pa.RecordBatch], queries: Queries, collection: Collection, k: int) -> Iterator[pa.RecordBatch]:
    known = [np.zeros(0, np.int64) for _ in queries.terms]
    for table in _blocks(batches):
        docs = table.column(0).combine_chunks()
        ids = docs.field(0) if len(docs) else docs
        rank = np.empty(len(docs), np.int64)
        rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(docs))
        length, term, count = (table.column(c).combine_chunks() for c in (1, 2, 3))
        block = Block(
            length.to_numpy(), term.value_lengths().to_numpy().astype(np.int64), term.flatten().to_numpy(),
            count.flatten().to_numpy().astype(np.int64), collection,
        )
        for first in range(0, len(queries.terms), 256):
            number, row, score = [], [], []
            for item in range(first, min(first + 256, len(queries.terms))):
                found, scores = block.best(queries.terms[item], known[item], k)
                if len(known[item]) == k:
                    found, scores = found[scores >= known[item].min()], scores[scores >= known[item].min()]
                top = np.lexsort((rank[found], -scores))[:k]
                known[item] = np.sort(np.concatenate([known[item], scores[top]]))[::-1][:k]
                number.append(np.full(len(top), item))
                row.append(found[top])
                score.append(scores[top])
            number, row, score = map(np.concatenate, (number, row, score))
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()), queries.items.take(pa.array(number, pa.int64())), docs.take(pa.array(row, pa.int64())),
                 pa.array(score)],
                names=["number", "item", "doc", "score"],
            )


def _top(found: DataFrame, within: Sequence[str], id_col: str, k: int) -> DataFrame:
    order = W.partitionBy(*within).orderBy(F.desc("score"), F.col(f"doc.`{id_col}`").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: DataFrame, queries: Queries, id_col: str, text_col: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    stage = Stage(spark, "search")
    shared = spark.sparkContext.broadcast(queries)  # bounded by QUERY_BYTES
    source = docs.select(F.struct(F.col(id_col)).alias("doc"), whole_text(F.col(text_col)).alias("text"))
    schema = T.StructType([
        source.schema["doc"], T.StructField("length", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.IntegerType())),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in N.slices(batches, 1):
            length, terms, counts = count_terms(batch.column(1), shared.value)
            rows = pa.RecordBatch.from_arrays([batch.column(0), pa.array(length), terms, counts], names=schema.names)
            yield rows.filter(pa.array(length > 0))

    counted = stage.write(source.mapInArrow(count, schema))
    size = counted.agg(F.count(F.lit(1)).alias("documents"), F.sum("length").alias("words")).head()
    holding = np.zeros(queries.size, np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a query term
        holding[r["term"]] = r["count"]
    collection = Collection.of(size["documents"], size["words"] or 1, holding)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _search(batches, shared.value, collection, k)

    out = T.StructType([
        T.StructField("number", T.IntegerType()), items.schema["item"], source.schema["doc"], T.StructField("score", T.LongType()),
    ])
    # Counts are far smaller than texts, so files would put too many documents into one task.
    dealt = counted.repartition(-(-collection.words // TASK_WORDS))
    found = stage.write(dealt.mapInArrow(search, out).withColumn("part", F.spark_partition_id() % MERGE_PARTS))
    stage.clear(found)
    return _top(_top(found, ["number", "part"], id_col, k).drop("part"), ["number"], id_col, k)


def rank_documents(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_col: str = "text",
    carry: Sequence[str] = ("*",), k: int = BEST, query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """The k best documents of each row of ``items``: item (struct of ``carry``), rank, doc (struct of the id), score.

    Equal scores rank by ascending id, null ids last. Documents scoring 0 are not returned; null or empty
    texts, on either side, have no terms and match nothing. Repeated documents and repeated items count
    each for themselves. Extra columns are not read unless carried. ``items`` reach the tasks in parts of
    ``query_bytes``, so any number of them is served, with one pass over the documents for each part.
    """
    items = items.select(F.struct(*carry).alias("item"), F.col(query_col).alias("query"))
    kind = items.limit(0).select("item").toArrow().schema.field("item").type
    parts, rows, size = [], [], 0

    def flush() -> None:
        queries = Queries.of(pa.array([r["item"].asDict() for r in rows], kind), [r["query"] for r in rows])
        parts.append(_search_block(docs, items, queries, id_col, text_col, k))
        rows.clear()

    for row in items.toLocalIterator():
        rows.append(row)
        size += len(row["query"] or "") + 64
        if size >= query_bytes:
            flush()
            size = 0
    if rows or not parts:
        flush()
    return reduce(DataFrame.unionByName, parts).select("item", "rank", "doc", "score")
