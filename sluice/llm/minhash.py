"""Near-duplicate groups: SuperMinHash signatures, banding, verification, union-find.

A document's set holds its distinct five-word shingles (64-bit hashes). Documents with one and
the same set form a node. SuperMinHash gives each shingle a pseudo-random permutation of the
signature's places, dealt out in rounds; a shingle's rank in round j lies between j and j + 1, so a
text is done as soon as all places are filled with ranks of earlier rounds.

36 bands of five places make a pair at similarity 0.75 share a bucket in 99.994 % of cases. A bucket does not
give all its pairs: its first node, the pivot, is compared with the others on full sets. Nodes
that then are in different components are compared further, a few pivots of each bucket a round,
until every bucket holds one component or has no untested pair across components; nodes that
have too few shingles outside their component to be linked are left out of that. So no link
between nodes of a bucket is lost, and a large group of copies costs about one comparison per member.

Signatures, buckets, pairs and components stay in tables; nothing of them reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sluice.llm import words as N
from sluice.llm.common import Stage, whole_text

SHINGLE = 5
BANDS, ROWS = 36, 5
PLACES = BANDS * ROWS
#: Link two sets if 100 * |intersection| >= PERCENT * |union|.
PERCENT = 75
#: Pivots of a bucket in each later round.
PIVOTS = 64
#: Longs of a set's bitmap, in which each shingle flips one bit.
BITMAP = 16
#: Rounds before permutations are kept in full.
_TRACED = 6


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each shingle of each text, repeated ones too.

    A text of one to four words has its whole sequence, one without words has none.
    """
    data, offsets = N.text_bytes(column)
    data = N.LOWER[data]
    starts, ends, text = N.spans(~N.SEPARATOR[data], offsets)
    h = N.Rolling(data).of(starts, ends)
    n = np.bincount(text, minlength=len(column))
    size = np.minimum(n, SHINGLE)
    place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    begins = np.flatnonzero(place <= np.repeat(n - size, n))
    out = np.zeros(len(begins), np.uint64)
    width = size[text[begins]]
    for k in range(SHINGLE):
        more = k < width
        at = np.where(more, begins + k, begins)
        out = np.where(more, out * np.uint64(0x100000001B3) + h[at], out)
    return text[begins], N.mix(out + width.astype(np.uint64))


def distinct_sets(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (text, hash) once, in order of text."""
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    if len(h):
        first = np.concatenate([[True], (text[1:] != text[:-1]) | (h[1:] != h[:-1])])
        text, h = text[first], h[first]
    return text, h


def signatures(text: np.ndarray, h: np.ndarray, rows: int, places: int = PLACES) -> np.ndarray:
    """SuperMinHash: for each text and place the least (round, rank) of its shingles in one integer.

    A shingle's permutation is drawn by swaps: round j swaps place j with a later or equal place.
    For the first rounds the place is found by tracing the swaps back; the few short texts that
    go on keep permutations in full.
    """
    out = np.full(rows * places, np.iinfo(np.int64).max, np.int64)
    swaps: list[np.ndarray] = []
    state: np.ndarray | None = None
    for j in range(places):
        draw = N.mix(h + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        to = (j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(places - j)) >> np.uint64(32))).astype(np.int64)
        rank = (np.int64(j) << 32) | (draw >> np.uint64(32)).astype(np.int64)
        if j < _TRACED:
            place = to
            for i in range(j - 1, -1, -1):
                place = np.where(swaps[i] == place, i, place)
            swaps.append(to)
        else:
            if state is None:
                state = np.tile(np.arange(places, dtype=np.int16), (len(h), 1))
                all_rows = np.arange(len(h))
                for i, other in enumerate(swaps):
                    state[all_rows, i], state[all_rows, other] = state[all_rows, other], state[all_rows, i].copy()
            all_rows = np.arange(len(h))
            state[all_rows, j], state[all_rows, to] = state[all_rows, to], state[all_rows, j].copy()
            place = state[:, j].astype(np.int64)
        np.minimum.at(out, text * places + place, rank)
        unfinished = out.reshape(rows, places).max(1) >= (np.int64(j + 1) << 32)
        go_on = unfinished[text]
        if not go_on.any():
            break
        if not go_on.all():
            text, h = text[go_on], h[go_on]
            swaps = [s[go_on] for s in swaps] if state is None else swaps
            state = state[go_on] if state is not None else None
    return out.reshape(rows, places)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One key per band; the band's number is part of it."""
    values = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), values.shape[:2]).copy()
    for k in range(ROWS):
        key = N.mix(key * np.uint64(0x100000001B3) + values[:, :, k])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in N.slices(batches, 1, 1 << 19):
        rows = batch.num_rows
        text, h = distinct_sets(*shingles(batch.column(1)))
        n = np.bincount(text, minlength=rows)
        digests = []
        for salt in (1, 2):  # sums do not depend on order; two of 64 bits tell sets apart
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(N.mix(h * np.uint64(2) + np.uint64(salt)))])
            edge = np.concatenate([[0], np.cumsum(n)])
            digests.append(pa.array((sums[edge[1:]] - sums[edge[:-1]]).view(np.int64)))
        bits = np.bincount(text * (64 * BITMAP) + (h >> np.uint64(54)).astype(np.int64), minlength=rows * 64 * BITMAP) & 1
        bitmaps = np.packbits(bits.astype(np.uint8)).view(np.int64)
        bitmap_offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * BITMAP)
        keys = band_keys(signatures(text, h, rows))
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32))
        bands = pa.ListArray.from_arrays(offsets, pa.array(keys[n > 0].ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n.astype(np.int64)), *digests, bands,
             pa.ListArray.from_arrays(bitmap_offsets, pa.array(bitmaps))],
            names=["doc_id", "n", "d1", "d2", "bands", "bits"],
        )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both texts, those whose full sets are similar enough."""
    for batch in N.slices(batches, 2, 1 << 19):
        sides = []
        for column in (batch.column(2), batch.column(3)):
            pair, h = shingles(column)
            key, first = np.unique(N.mix(h + N.mix(pair.astype(np.uint64) + np.uint64(1))), return_index=True)
            sides.append((key, pair[first]))
        (ka, pa_), (kb, pb) = sides
        at = np.searchsorted(kb, ka)
        common = np.bincount(pa_[(at < len(kb)) & (kb[np.minimum(at, len(kb) - 1)] == ka)], minlength=batch.num_rows)
        union = np.bincount(pa_, minlength=batch.num_rows) + np.bincount(pb, minlength=batch.num_rows) - common
        keep = pa.array(100 * common >= PERCENT * union)
        yield batch.select([0, 1]).filter(keep)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one task: each node with the least node of its tree."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in parent]
    pairs = [(x, root) for x, root in pairs if x != root]
    for at in range(0, len(pairs), 10_000):
        some = pairs[at:at + 10_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in some], pa.int64()), pa.array([r for _, r in some], pa.int64())], names=["a", "b"]
        )


class Components:
    """Components of links that come round by round, as a table of node and root.

    Union-find runs inside tasks; its trees' edges are then joined across tasks: every node takes
    its least neighbour as parent, parents are followed to the root by doubling, and edges between
    roots go round again until none is left.
    """

    def __init__(self, stage: Stage):
        self.stage, self.roots = stage, None

    def of(self, nodes: DataFrame, column: str, name: str) -> DataFrame:
        """``nodes`` with the root of the node in ``column``; a node without links is its own."""
        if self.roots is None:
            return nodes.withColumn(name, F.col(column))
        roots = self.roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
        return nodes.join(roots.hint("merge"), column, "left").withColumn(name, F.coalesce("_root", column)).drop("_root")

    def add(self, links: DataFrame) -> None:
        write = self.stage.write
        edges = links
        while True:
            for column in ("a", "b"):
                edges = self.of(edges, column, column + "_root")
            edges = edges.filter("a_root != b_root").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
            edges = write(edges.mapInArrow(_forest, "a long, b long").distinct(), narrow=True)
            if edges.isEmpty():
                return
            parents = write(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), narrow=True)
            while True:
                above = parents.select(F.col("node").alias("root"), F.col("root").alias("up"))
                jumped = write(parents.join(above, "root", "left").select(
                    "node", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")
                ), narrow=True)
                parents = jumped.select("node", "root")
                if jumped.filter("moved").isEmpty():
                    break
            if self.roots is None:
                self.roots = parents
            else:
                older = self.roots.join(parents.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left")
                older = older.select("node", F.coalesce("up", "root").alias("root"))
                self.roots = write(older.unionByName(parents.join(self.roots, "node", "left_anti")), narrow=True)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row.

    ``component_id`` is the smallest id reachable over links, the row's own included; ``kept`` says
    that it is the row's own. A text without words, null ones too, has no shingles and no links.
    Rows that repeat an id share its fate if their texts are similar, else each is in its own
    text's component. Other columns are not read. No rows give no rows.
    """
    stage = Stage(docs.sparkSession, "minhash")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(F.col(text_col)).alias("text"))
    signed = stage.write(source.mapInArrow(_sign, "doc_id long, n long, d1 long, d2 long, bands array<long>, bits array<long>"))
    full = signed.filter("n > 0")
    same_set = ["d1", "d2", "n"]
    nodes = stage.write(
        full.groupBy(*same_set).agg(F.min(F.struct("doc_id", "bands", "bits")).alias("least"))
        .select("*", F.monotonically_increasing_id().alias("node"))
    )
    components = Components(stage)
    _link(stage, source, nodes, components)
    classes = components.of(nodes.select(*same_set, "node", F.col("least.doc_id").alias("least")), "node", "root")
    classes = stage.write(classes.select(*same_set, "root", "least"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stage.write(classes.join(least.hint("merge"), "root").select(*same_set, "component_id"))
    stage.clear(signed, classes)
    grouped = full.drop("bands", "bits").join(classes.hint("merge"), same_set).select("doc_id", "n", "component_id")
    alone = signed.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _link(stage: Stage, source: DataFrame, nodes: DataFrame, components: Components) -> None:
    """Compare nodes that share a bucket until all links between them are in ``components``."""
    entries = nodes.select("node", F.explode("least.bands").alias("key"))
    shared = stage.write(
        entries.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("size")).filter("size > 1")
    )
    buckets = stage.write(entries.join(shared.hint("merge"), "key").select("key", "node", "pivot"))
    wanted = buckets.select("node").distinct().join(nodes.select("node", "d1", "d2", "least.doc_id").hint("merge"), "node")
    texts = stage.write(
        source.join(wanted.hint("merge"), source["doc_id"].eqNullSafe(wanted["doc_id"])).select("node", "d1", "d2", "text")
        .mapInArrow(_of_node, "node long, text string").dropDuplicates(["node"])
    )
    pairs = stage.write(
        buckets.filter("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    )
    tested = pairs
    open_entries = buckets.filter("node != pivot").select("key", "node")
    sizes = nodes.select("node", "n", "least.bits")
    while True:
        components.add(stage.write(_verified(pairs, texts)))
        open_entries = _unresolved(stage, components.of(open_entries, "node", "root"))
        if open_entries.isEmpty():
            return
        open_entries = _linkable(stage, open_entries, sizes, texts)
        open_entries = _unresolved(stage, open_entries)
        # One pivot of each component first: a straggler is compared with all others at once.
        turn = F.row_number().over(W.partitionBy("key", "root").orderBy("node"))
        place = F.row_number().over(W.partitionBy("key").orderBy("turn", "root"))
        pivots = stage.write(
            open_entries.withColumn("turn", turn).filter(F.col("turn") <= PIVOTS)
            .withColumn("place", place).filter(F.col("place") <= PIVOTS)
            .select("key", *[F.col(c).alias(f"pivot_{c}") for c in ("node", "root", "n", "shared", "bits")])
        )
        total = F.col("n") + F.col("pivot_n")
        # Shingles of one set alone flip the bits that differ, so there are as many at least.
        enough = (175 * F.least("shared", "pivot_shared") >= 75 * total) & (7 * _differing("bits", "pivot_bits") <= total)
        across = open_entries.join(
            pivots.hint("merge"),
            (open_entries["key"] == pivots["key"]) & (F.col("root") != F.col("pivot_root")) & enough,
        )
        pairs = across.select(F.least("node", "pivot_node").alias("a"), F.greatest("node", "pivot_node").alias("b")).distinct()
        pairs = stage.write(pairs.join(tested.hint("merge"), ["a", "b"], "left_anti"), narrow=True)
        tested = tested.unionByName(pairs)
        gone = pivots.select("key", F.col("pivot_node").alias("node"))
        open_entries = open_entries.join(gone.hint("merge"), ["key", "node"], "left_anti").select("key", "node")


def _differing(a: str, b: str) -> Column:
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda acc, n: acc + n)


def _unresolved(stage: Stage, rooted: DataFrame) -> DataFrame:
    """Entries of buckets that hold more than one component."""
    rooted = stage.write(rooted, narrow=True)
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return stage.write(rooted.join(mixed.filter("low != high").select("key").hint("merge"), "key"), narrow=True)


def _linkable(stage: Stage, entries: DataFrame, sizes: DataFrame, texts: DataFrame) -> DataFrame:
    """Entries that can still be linked across components, with n, bits and ``shared``.

    A shingle that occurs in one component only takes no part in a link to another one. Two sets
    of n and m shingles are linked if they have 75 / 175 of n + m in common, so a node with fewer
    other shingles than that, given the smallest set of its bucket, is done without comparing it.
    This tells the members of a large group that differ too much, exactly and in linear work.
    """
    nodes = stage.write(entries.select("node", "root").distinct(), narrow=True)
    found = nodes.join(texts.hint("merge"), "node").select("node", "root", "text")
    found = stage.write(found.mapInArrow(_exploded, "node long, root long, shingle long"))
    private = found.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low = high")
    private = stage.write(private.select("shingle"), narrow=True)
    alone = found.join(private.hint("merge"), "shingle", "left_semi").groupBy("node").agg(F.count("*").alias("alone"))
    facts = nodes.select("node").join(sizes.hint("merge"), "node").join(alone.hint("merge"), "node", "left")
    facts = facts.select("node", "n", "bits", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))
    known = stage.write(entries.join(facts.hint("merge"), "node").select("key", "node", "root", "n", "shared", "bits"))
    smallest = known.groupBy("key").agg(F.min("n").alias("least_n"))
    able = 175 * F.col("shared") >= 75 * (F.col("n") + F.col("least_n"))
    return known.join(smallest.hint("merge"), "key").filter(able).drop("least_n")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in N.slices(batches, 2, 1 << 19):
        text, h = distinct_sets(*shingles(batch.column(2)))
        at = pa.array(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(h.view(np.int64))], names=["node", "root", "shingle"]
        )


def _of_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts whose set is the node's: an id may be repeated with another text."""
    for batch in N.slices(batches, 3, 1 << 19):
        text, h = distinct_sets(*shingles(batch.column(3)))
        n = np.bincount(text, minlength=batch.num_rows)
        edge = np.concatenate([[0], np.cumsum(n)])
        right = np.ones(batch.num_rows, bool)
        for salt in (1, 2):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(N.mix(h * np.uint64(2) + np.uint64(salt)))])
            right &= (sums[edge[1:]] - sums[edge[:-1]]).view(np.int64) == batch.column(salt).to_numpy()
        yield batch.select([0, 3]).filter(pa.array(right))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_linked, "a long, b long")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is its component's smallest, columns unchanged."""
    kept = near_duplicates(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept.hint("merge"), docs[id_col].cast("long").eqNullSafe(kept["_kept"]), "left_semi")
