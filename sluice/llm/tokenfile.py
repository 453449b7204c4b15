"""Token ids in binary files of patched frame-of-reference blocks.

Documents are range-sorted by id, and every task writes files of its own stretch:

    magic
    blocks of BLOCK ids, the last one may be shorter:
        count u16, width u8, 0, exceptions u16, 0 u16, minimum u32
        (id - minimum) modulo 2**width, ``width`` bits each
        exceptions: positions u16, then the bits above ``width`` as u32
    footer: document ids i64, their null marks u8, ids per document u64, block starts u64
    documents u64, ids u64, blocks u64, footer start u64, crc32 of the footer u32, magic

A block's width fits the given percentile of its ids, so a few large ones do not widen all others;
they are patched from the exception lists. All blocks but the last hold as many ids, so the id at
any place is found through the list of block starts without reading what lies before.

A file counts once the manifest, a table Spark commits, names it: what lost or repeated tasks leave
behind is never read. A file's place in the whole is the sum of the ids of the files before it.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from sluice.llm import words as N
from sluice.llm.common import whole_text

VOCABULARY = "word_bpe_49k"
END = 1
BLOCK = 1024
#: Share of a block's ids that its width must hold.
PERCENTILE = 90
#: A file is closed at the first document end after so many ids.
FILE_IDS = 1 << 24
#: Blocks written or read at once.
GROUP = 256
#: Words whose ids a Python worker keeps, and the longest of them in bytes.
KEPT_WORDS, KEPT_BYTES = 1 << 20, 64
#: Bytes of text encoded at once.
PIECE = 1 << 22

MAGIC = b"PFR1"
_HEAD = np.dtype([("count", "<u2"), ("width", "u1"), ("", "u1"), ("exceptions", "<u2"), ("", "<u2"), ("minimum", "<u4")])
_TAIL = struct.Struct("<QQQQI4s")
_BLANK = re.compile(rb"\s")
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# Marks that may follow a word; those of reserved strings are not among them.
_MARKS = b"!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"
_MARK, _ASCII_LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(_MARKS)] = _ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_MANIFEST = "partition int, file int, name string, documents long, ids long, bytes long"


@lru_cache(maxsize=2)
def encoder(path: str | None = None, marks_are_text: bool = True):
    """The tokenizer, once per Python worker.

    With ``marks_are_text`` strings like ``<|endoftext|>`` in a text are ordinary text, as the vocabulary's
    own README sets it; else they become the reserved ids they name.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path or public_tokenizers.path(f"{VOCABULARY}.json"))
    tokenizer.encode_special_tokens = marks_are_text
    return tokenizer


class _Words(dict):
    """Ids of words, as little-endian bytes; a word that is not there is encoded when it is asked for.

    Half of those that may be kept are new; when there are more, they become the old half. So words that
    come again and again stay, and are not encoded anew whenever a long tail of rare ones has filled the table.
    """

    def __init__(self, tokenizer):
        from tokenizers import pre_tokenizers

        self.tokenizer, self.model, self.old = tokenizer, tokenizer.model, {}
        # letters beyond ASCII as the vocabulary spells them, byte by byte
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelt = {code: "".join(piece for piece, _ in spell(chr(code))) for code in range(0xC0, 0x100)}

    def __missing__(self, word: bytes) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self._found(word)
        if len(word) <= KEPT_BYTES:
            self[word] = found
        return found

    def age(self) -> None:
        if len(self) > KEPT_WORDS // 2:
            self.old = self.copy()
            self.clear()

    def _found(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # ASCII alone
            return self._merged(word.decode())
        core = word.rstrip(_MARKS)
        if core.isalpha():
            lower = core.lower()
        elif _PLAIN.fullmatch(text := core.decode()):
            lower = text.lower().encode()
            if lower == word:
                return self._merged(text)
        else:
            return self._encoded(word.decode())
        return self[lower] + (self[word[len(core):]] if len(core) < len(word) else b"")

    def _merged(self, text: str) -> bytes:
        """The ids of lower letters: one piece, and nothing to normalise."""
        if len(text) > KEPT_BYTES:
            return self._encoded(text)
        spelt = text if text.isascii() else text.translate(self.spelt)
        return array("I", [token.id for token in self.model.tokenize(spelt)]).tobytes()

    def _encoded(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class Encoder:
    """Ids of texts, word by word.

    The vocabulary's tokenizer drops white space and never joins what stands on its two sides: it composes
    and lowers characters one by one, and its pattern looks no further than a run of one kind. So the ids of
    a text are those of its words, parted at ASCII white space, and a word that was met before needs no second
    encoding. For the same reasons plain words, of Latin letters alone, are encoded in lower case and apart from
    the marks that follow them, by the vocabulary's merges alone; one mark after a letter of ASCII ends any word,
    and counts as a word of its own. Texts go through together: each of their
    distinct words is looked up once, and the ids are laid out in the order of the words.
    """

    def __init__(self, path: str | None = None, marks_are_text: bool = True):
        self.known = _Words(encoder(path, marks_are_text))

    def __call__(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """One array per UTF-8 text; a long text goes through in pieces."""
        together, size = [], 0
        for text in texts:
            if size + len(text) > PIECE:
                yield from self._encode(together)
                together, size = [], 0
            if len(text) > PIECE:
                yield np.concatenate([ids for piece in _pieces(text, PIECE) for ids in self._encode([piece])])
            else:
                together.append(text)
                size += len(text)
        yield from self._encode(together)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        self.known.age()
        ends = np.cumsum([len(text) + 1 for text in texts])
        data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
        inside = ~N.SEPARATOR[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        places = np.concatenate([[0], np.cumsum(edges[1::2] - edges[::2])])
        bounds = places[np.searchsorted(edges[::2], ends)]
        marked = _MARK[data[edges[1::2] - 1]] & _ASCII_LETTER[data[edges[1::2] - 2]]
        places = np.sort(np.concatenate([places, places[1:][marked] - 1]), kind="stable")
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data[inside])]
        ).dictionary_encode()
        found = list(map(self.known.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)))
        ids, counts = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64) // 4
        word = words.indices.to_numpy()
        counts, first = counts[word], (np.cumsum(counts) - counts)[word]
        before = np.concatenate([[0], np.cumsum(counts)])
        out = ids[np.repeat(first - before[:-1], counts) + np.arange(before[-1])]
        return np.split(out, before[np.searchsorted(places, bounds)])[:-1]


@lru_cache(maxsize=2)
def kept_encoder(path: str | None, marks_are_text: bool) -> Encoder:
    """One per Python worker, so that later tasks find the words of earlier ones."""
    return Encoder(path, marks_are_text)


def _pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text cut at white space about every ``size`` bytes."""
    at = 0
    while (blank := _BLANK.search(text, at + size)) and len(text) > at + size:
        yield text[at:blank.start()]
        at = blank.start()
    yield text[at:]


# Blocks --------------------------------------------------------------------------------------

def _bits(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> list[bytes]:
    """Blocks of one row of ids each."""
    count = ids.shape[1]
    minimum = ids.min(axis=1)
    delta = (ids - minimum[:, None]).astype(np.uint32)
    place = max(-(-count * percentile // 100) - 1, 0)
    width = _bits(np.partition(delta, place, axis=1)[:, place])
    above = (delta.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    head = np.zeros(len(ids), _HEAD)
    head["count"], head["width"], head["minimum"] = count, width, minimum
    head["exceptions"] = (above > 0).sum(axis=1)
    out: list[bytes] = [b""] * len(ids)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        data = delta[rows].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :-(-w // 8)]
        bits = np.unpackbits(data.ravel(), bitorder="little").reshape(len(data), -(-w // 8) * 8)[:, :w]
        packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
        for row, body in zip(rows, packed):
            at = np.flatnonzero(above[row])
            out[row] = b"".join([
                head[row].tobytes(), body.tobytes(), at.astype("<u2").tobytes(), above[row, at].astype("<u4").tobytes()
            ])
    return out


def unpack_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts``, one after the other."""
    raw = np.frombuffer(data + bytes(8), np.uint8)
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))  # the eight bytes from any place on hold an id's bits
    head = raw[starts[:, None] + np.arange(_HEAD.itemsize)].copy().view(_HEAD).ravel()
    counts, widths = head["count"].astype(np.int64), head["width"].astype(np.int64)
    out = np.zeros(counts.sum(), np.uint32)
    first = np.cumsum(counts) - counts
    sizes = -(-counts * widths // 8)
    for w, count in set(zip(widths.tolist(), counts.tolist())):
        rows = np.flatnonzero((widths == w) & (counts == count))
        at = np.arange(count) * w
        values = eight[(starts[rows] + _HEAD.itemsize)[:, None] + at // 8] >> (at % 8).astype(np.uint64)
        values = (values & np.uint64((1 << w) - 1)).astype(np.uint32)
        out[first[rows][:, None] + np.arange(count)] = values + head["minimum"][rows][:, None]
    for row in np.flatnonzero(head["exceptions"]):
        n, at = int(head["exceptions"][row]), int(starts[row] + _HEAD.itemsize + sizes[row])
        places = np.frombuffer(data, "<u2", n, at)
        above = np.frombuffer(data, "<u4", n, at + 2 * n)
        out[first[row] + places] += above << np.uint32(widths[row])
    return out


# Files ---------------------------------------------------------------------------------------

class Writer:
    """Writes one file; ids are buffered up to ``GROUP`` blocks."""

    def __init__(self, stream):
        self.stream, self.at, self.ids = stream, 0, 0
        self.pending: list[np.ndarray] = []
        self.waiting = 0
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.starts: list[int] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def _blocks(self, ids: np.ndarray) -> None:
        blocks = pack_blocks(ids)
        sizes = np.cumsum([0, *map(len, blocks)])
        self.starts.extend((self.at + sizes[:-1]).tolist())
        self._put(b"".join(blocks))

    def _drain(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint32)
        whole = len(ids) // BLOCK * BLOCK
        for first in range(0, whole, GROUP * BLOCK):
            self._blocks(ids[first:min(first + GROUP * BLOCK, whole)].reshape(-1, BLOCK))
        rest = ids[whole:]
        if last and len(rest):
            self._blocks(rest.reshape(1, -1))
            rest = rest[:0]
        self.pending, self.waiting = [rest], len(rest)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids))
        self.ids += len(ids)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= GROUP * BLOCK:
            self._drain(False)

    def close(self) -> int:
        """Finish the file; gives its size."""
        self._drain(True)
        footer = b"".join([
            np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes(),
            np.array([d is None for d in self.doc_ids], "u1").tobytes(),
            np.array(self.sizes, "<u8").tobytes(), np.array(self.starts, "<u8").tobytes(),
        ])
        start = self.at
        self._put(footer)
        self._put(_TAIL.pack(len(self.sizes), self.ids, len(self.starts), start, zlib.crc32(footer), MAGIC))
        self.stream.close()
        return self.at


class Reader:
    """Reads one file: its documents, and any stretch of its ids."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        documents, self.ids, blocks, start, crc, magic = _TAIL.unpack(source.read_at(_TAIL.size, size - _TAIL.size))
        footer = source.read_at(size - _TAIL.size - start, start)
        if magic != MAGIC or zlib.crc32(footer) != crc:
            raise ValueError("not a whole file of token ids")
        ids, null, counts, starts = np.split(
            np.frombuffer(footer, np.uint8), np.cumsum([8 * documents, documents, 8 * documents])
        )
        self.doc_ids = pa.array(ids.copy().view("<i8"), mask=null.astype(bool))
        self.sizes = counts.copy().view("<u8").astype(np.int64)
        self.starts = np.append(starts.copy().view("<u8").astype(np.int64), start)

    def read(self, first: int, count: int) -> np.ndarray:
        """Ids ``first`` to ``first + count - 1`` of the file; only their blocks are read."""
        low, high = first // BLOCK, min(-(-(first + count) // BLOCK), len(self.starts) - 1)
        if low >= high:
            return np.zeros(0, np.uint32)
        begin = int(self.starts[low])
        data = self.source.read_at(int(self.starts[high]) - begin, begin)
        return unpack_blocks(data, self.starts[low:high] - begin)[first - low * BLOCK:][:count]

    def groups(self) -> Iterator[np.ndarray]:
        for first in range(0, self.ids, GROUP * BLOCK):
            yield self.read(first, min(GROUP * BLOCK, self.ids - first))


def _utf8(column: pa.Array) -> list[bytes]:
    data, offsets = N.text_bytes(column)
    return [data[a:b].tobytes() for a, b in itertools.pairwise(offsets.tolist())]


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


# Tables --------------------------------------------------------------------------------------

def write_files(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", end: int = END,
    vocabulary: str | None = None, marks_are_text: bool = True, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode all texts into files under ``folder``; gives the manifest, one row per file.

    Documents stand in ascending order of the id, a BIGINT, null first; rows that repeat an id in the
    order of a hash of their texts. A null or empty text is the end id alone. ``folder`` must be a path
    or URI all nodes can write to. Extra columns are not read. No rows give no files.
    """
    text = whole_text(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).withColumns(
        {"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()}  # the row splits one hot id
    )
    ordered = rows.repartitionByRange("id", "hash", "row").sortWithinPartitions("id", "hash").select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        system.create_dir(path, recursive=True)
        encode = kept_encoder(vocabulary, marks_are_text)
        partition, done = TaskContext.get().partitionId(), []
        writer, name = None, ""

        def close() -> None:
            size = writer.close()
            done.append((partition, len(done), name, len(writer.sizes), writer.ids, size))

        for batch in N.slices(batches, 1, PIECE):
            for doc_id, found in zip(batch.column(0).to_pylist(), encode(_utf8(batch.column(1)))):
                if writer is None:
                    name = f"ids-{partition:06d}-{len(done):04d}-{uuid.uuid4().hex}.pfr"
                    writer = Writer(system.open_output_stream(f"{path}/{name}"))
                writer.add(doc_id, np.append(found, np.uint32(end)))
                if writer.ids >= file_ids:
                    close()
                    writer = None
        if writer is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done) if done else [()] * 6, kinds)], names=names
        )

    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in _MANIFEST.split(", ")]
    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(docs.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder, and where in the whole each one begins.

    One row stands for up to ``FILE_IDS`` ids, so the running sum passes one task.
    """
    before = W.orderBy("partition", "file").rowsBetween(W.unboundedPreceding, -1)
    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents from the files: doc_id, start (ids before it), n_tokens, ids_crc32, and ids if asked for.

    ``ids_crc32`` is over little-endian unsigned 32-bit ids. Files are dealt out to tasks; without ``ids``
    a task holds one group of blocks at a time, also within a very long document.
    """
    files = manifest(spark, folder)
    tasks = max(min(files.count(), 8 * spark.sparkContext.defaultParallelism), 1)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                with system.open_input_file(f"{path}/{name}") as source:
                    yield from _documents(Reader(source), start, with_ids)

    dealt = files.select("name", "start").repartitionByRange(tasks, "start")
    out = dealt.mapInArrow(read, schema)
    return out if with_ids else out.drop("ids")


def _documents(reader: Reader, start: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(reader.sizes)
    begins = ends - reader.sizes
    doc, crc, parts, at = 0, 0, [], 0
    for ids in reader.groups():
        first, crcs, whole = doc, [], []
        while doc < len(ends) and begins[doc] < at + len(ids):
            piece = ids[max(begins[doc] - at, 0):ends[doc] - at]
            crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
            if with_ids:
                parts.append(piece.astype(np.int32))
            if ends[doc] > at + len(ids):
                break  # the document goes on in the next group
            crcs.append(crc)
            whole.append(np.concatenate(parts) if with_ids else None)
            doc, crc, parts = doc + 1, 0, []
        at += len(ids)
        yield pa.RecordBatch.from_arrays(
            [
                reader.doc_ids.slice(first, doc - first), pa.array(start + begins[first:doc]), pa.array(reader.sizes[first:doc]),
                pa.array(crcs, pa.int64()), pa.array(whole, pa.list_(pa.int32())),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
        )
