"""Chat formatting on token level.

A turn is the begin id, the role's ids, the separator id, the text's ids and the end id. Role and
text are encoded each for itself, so no token straddles a mark, and marks are ids above the
vocabulary, which no text can yield. The loss mask follows from prefix sums over the segments'
lengths: it covers the text ids of assistant turns and nothing else.

Written out, a turn is ``<turn>role``, a line break, the text and ``</turn>`` with a line break.
Control strings inside a role or text are broken by a backslash after their first character and
backslashes are doubled, so dropping each backslash and keeping what follows it restores them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.tokens import encode, encoder

#: Ids above the vocabulary and how they are written out.
BEGIN, SEPARATOR, END = 50_257, 50_258, 50_259
WRITTEN = {BEGIN: "<turn>", SEPARATOR: "\n", END: "</turn>\n"}
#: Strings that mark turns here or in templates the output may meet.
CONTROL = (
    "<turn>", "</turn>", "<|endoftext|>", "<|im_start|>", "<|im_end|>", "### System:", "### User:", "### Assistant:",
)
_ESCAPE = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
LEARNED_ROLE = "assistant"
_BATCH = 512


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def escape_role(role: str) -> str:
    """A role also ends at a line break."""
    return escape(role).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks = [np.array([mark], np.int32) for mark in (BEGIN, SEPARATOR, END)]
    for whole in batches:
        for first in range(0, whole.num_rows, _BATCH):
            batch = whole.slice(first, _BATCH)
            ids, masks = [], []
            for role, text in zip(batch.column(2), batch.column(3)):
                role, text = role.as_py(), text.as_py()
                segments = [
                    marks[0], np.array(encode(escape_role(role)), np.int32),
                    marks[1], np.array(encode(escape(text)), np.int32), marks[2],
                ]
                ends = np.cumsum([len(s) for s in segments])
                mask = np.zeros(ends[-1], bool)
                if role == LEARNED_ROLE:
                    mask[ends[2]:ends[3]] = True
                ids.append(np.concatenate(segments))
                masks.append(mask)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(masks, pa.list_(pa.bool_()))],
                names=["conv_id", "turn", "role", "ids", "loss"],
            )


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of ids before each turn of its conversation; rows come in order."""
    before, current = 0, object()
    for batch in batches:
        starts = []
        for conv, ids in zip(batch.column(0).to_pylist(), batch.column(3)):
            if conv != current:
                before, current = 0, conv
            starts.append(before)
            before += len(ids)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(starts, pa.int64())], names=[*batch.schema.names, "start"]
        )


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, ids, loss and start of each turn.

    ``loss`` has a flag for each id; ``start`` is the number of ids before the turn. The rows of a
    conversation lie in one partition, in order of turn (null first), role and ids; read one after
    the other they are its training sequence. Encoding is done before they are dealt out, on all
    tasks alike, and a conversation is passed along turn by turn, so its length is not bounded by
    memory. Null roles and texts are empty; rows with a null conv_id form a conversation; repeated
    rows are turns of their own. Other columns are not read.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    schema = "conv_id long, turn long, role string, ids array<int>, loss array<boolean>"
    turns = rows.mapInArrow(_encode, schema).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")
    return turns.mapInArrow(_place, schema + ", start long")


class _ReadBack:
    """What one conversation's ids say, turn by turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, loss: np.ndarray) -> None:
        decode = encoder().decode_bytes
        begin, separator, end = (int(np.flatnonzero(ids == mark)[0]) for mark in (BEGIN, SEPARATOR, END))
        role = decode(ids[begin + 1:separator].tolist()).decode()
        text = decode(ids[separator + 1:end].tolist()).decode()
        learned = unescape(decode(ids[loss].tolist()).decode())
        self.turns += 1
        self.all.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        self.loss.update(learned.encode())
        self.loss_chars += len(learned)
        self.chars += len(role) + len(text) + sum(map(len, WRITTEN.values()))

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


_DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: _ReadBack | None = None
    done: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * len(_DIGESTS)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _DIGESTS.types)], schema=_DIGESTS)

    for batch in batches:
        for conv, ids, loss in zip(batch.column(0).to_pylist(), batch.column(3), batch.column(4)):
            if current is None or current.conv_id != conv:
                if current:
                    done.append(current.row())
                current = _ReadBack(conv)
            flags = loss.values.to_numpy(zero_copy_only=False)
            current.add(ids.values.to_numpy(), flags)
        if len(done) >= _BATCH:
            yield flush()
    if current:
        done.append(current.row())
    yield flush()


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of conversations, decoded from the ids and masks of ``format_turns``.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, the length of
    the conversation written out. Only two running digests are kept of a conversation.
    """
    return turns.mapInArrow(
        _digest,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
