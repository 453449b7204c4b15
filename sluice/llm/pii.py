"""Personal data by fixed patterns and a linear-chain conditional random field.

The patterns give the base spans. Around every digit, @ sign and bracketed at a stretch of text is cut into
tokens, and a conditional random field over word shapes labels them; it finds what patterns miss,
such as numbers grouped by dots or an address with [at]. It is trained here from a small labelled
table. Its spans are added where they touch no base span; base spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sluice.llm import words as N

KINDS = ("email", "ip", "card", "phone")
_STATES = ["O", *(f"{part}-{kind}" for kind in KINDS for part in "BI")]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NOT_DIGIT = re.compile(r"[^0-9]")

# The labelled table. {kind:text} is a span; all else is outside.
LABELLED = """
write to {email:anna.bell [at] mail.example.com} for details
contact {email:j.smith(at)example.org} or wait
send it to {email:info @ example.net} by noon
reach me under {email:kim22 [at] post.example.com}, thanks
mail {email:tom.99 (at) mail3.example.com} the new list
his address is {email:lee @ mail7.example.org} since May
please ask {email:box5[at]example.com} about it
the server {ip:10 . 20 . 30 . 40} is down
ping {ip:192-168-10-25} from there
host {ip:172 . 16 . 254 . 3} did not answer
login from {ip:81-2-69-142} was refused
we saw {ip:203 . 0 . 113 . 77} twice
address {ip:8-8-4-4} resolves names
paid with {card:4111.1111.1111.1111} last week
card {card:5500/0000/0000/0004} was charged
use {card:4012.8888.8888.1881} for this
number {card:4222/2222/2222/2220} is blocked
the card {card:6011.0009.9013.9424} has expired
call {phone:(555) 010-1234} after six
phone {phone:(212) 555-0187} or write
dial {phone:(743) 555-3824} and wait
my number is {phone:(310) 555 4510} today
ring {phone:(415) 555-0199} at once
he called {phone:(663) 555-6869} again
office {phone:(152) 555-8590} is closed
call {phone:+1 (269) 555-3296} {card:4524132264652876} and go
they rang. {phone:+1 (619) 555-0053} {phone:+1 (212) 555-0170} are the two
pay with {card:4111111111111111} {card:5500000000000004} or cash
card {card:4465758382889437} {phone:+1 (663) 555-6869} on file
see {ip:67.190.110.2} {card:4012888881881} there
9055890764913 went home. The rest of them, he said, stayed
29526289707589 was the sum. And so it was, in the end, and
of these. 5183462280 came in. The others, with few, were lost
number 4755575702902891 end. In the old days, one of ten
they left. In that year. 12 of them, and 7 more. The end
in 2019 there were 45 of them and 1200 more
pages 12-18 and 33 of chapter 4
the price is 3.50 or 12.99 with tax
version 2.4.1 came out on 2021-03-15
on 04.05.2020 at 10:30 they met
token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
key 1eb9c654e721b4f812088970e66a6345cee33dd6 is secret
license version 3, 29 June 2007
section 12.3.4 of part 2 says so
room 101 on floor 3 seats 40
about 1,200,000 people in 35 towns
ratio 3:4 at 16x9 and 100%
1. first 2. second 3. third
see (12) and (345) below
the score was 21-19 and 15-21
from 1914 to 1918 and 1939-1945
id 8834021 is in row 56
a 50/50 split of 1000/2000 parts
measured 12.5 x 7.25 x 3.0
at 9 or 10 @ the corner
chapter 7 (1999) has 250 pages
code A1-B22-C333 is not used
1 2 3 4 5 6 7 8 9 10
items 10, 20, 30, 40 and 50
(2001) 12-14 and (2003) 44-51
""".strip().split("\n")
_MARKED = re.compile(r"\{(\w+):([^}]*)\}")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\w\s]|_")
_TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]")
#: Characters on either side of a trigger that the field sees.
MARGIN = 24


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches that pass their checks, in order.

    Matches are the leftmost of each kind and do not overlap; a failing one is dropped and its
    text not tried again. Each search is linear in the text's length.
    """
    found = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            found.append((start, 0, domain.end()))
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-18:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * d, 10)) for d in values[1::2])) % 10 == 0


def _shape(token: str, apart: bool) -> str:
    if token[0].isdigit():
        size = len(token) if len(token) <= 5 else 6 if len(token) <= 7 else 8 if len(token) <= 13 else 14
        kind = f"9{size}" + ("b" if len(token) <= 3 and token.isascii() and int(token) <= 255 else "")
    elif token.isalpha():
        kind = ("X" if token.isupper() else "Xx" if token[0].isupper() else "x") + ("s" if len(token) <= 2 else "")
    else:
        kind = token
    return kind + ("_" if apart else "")


_TELLING = frozenset("at com org net example mail call phone dial ring ip server host card number paid".split())


def _tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, start, end)]


def _features(text: str, spans: list[tuple[int, int]]) -> list[list[str]]:
    """Word-shape features of each token of a stretch, neighbours included."""
    shapes = [_shape(text[a:b], i == 0 or spans[i - 1][1] < a) for i, (a, b) in enumerate(spans)]
    padded = ["^", "^", "^", *shapes, "$", "$", "$"]
    words = [text[a:b].lower() for a, b in spans]
    out = []
    for i in range(len(spans)):
        w = padded[i:i + 7]
        own = [f"{k}{w[3 + k]}" for k in range(-3, 4)]
        own += [f"p{w[2]}|{w[3]}", f"n{w[3]}|{w[4]}", f"t{w[2]}|{w[3]}|{w[4]}", f"r{w[3]}|{w[4]}|{w[5]}", f"l{w[1]}|{w[2]}|{w[3]}"]
        own += [f"w{k}{words[i + k]}" for k in (-1, 0, 1) if 0 <= i + k < len(words) and words[i + k] in _TELLING]
        out.append(own)
    return out


@dataclass
class Model:
    """Feature numbers, their weights by state, and weights of changes from state to state."""

    number: dict[str, int]
    emit: np.ndarray
    change: np.ndarray


def labelled_table() -> list[tuple[str, list[tuple[int, int]], list[int]]]:
    """Text, tokens and states of each labelled line."""
    rows = []
    for line in LABELLED:
        text, marks, at = "", [], 0
        for m in _MARKED.finditer(line):
            text += line[at:m.start()]
            marks.append((len(text), len(text) + len(m[2]), KINDS.index(m[1])))
            text += m[2]
            at = m.end()
        text += line[at:]
        spans = _tokens(text, 0, len(text))
        states = [0] * len(spans)
        for start, end, kind in marks:
            inside = [i for i, (a, b) in enumerate(spans) if start <= a and b <= end]
            for i in inside:
                states[i] = 1 + 2 * kind + (i != inside[0])
        rows.append((text, spans, states))
    return rows


def train(steps: int = 200, rate: float = 0.1, ridge: float = 0.01) -> Model:
    """Maximum likelihood with a ridge: forward and backward over all lines at once, Adam steps."""
    rows = labelled_table()
    features = [_features(text, spans) for text, spans, _ in rows]
    number: dict[str, int] = {}
    for line in features:
        for token in line:
            for f in token:
                number.setdefault(f, len(number))
    n, most, states = len(rows), max(len(s) for *_, s in rows), len(_STATES)
    on = np.zeros((n, most, len(number)), np.float32)
    gold, live = np.zeros((n, most), int), np.zeros((n, most), bool)
    for i, (line, (*_, labels)) in enumerate(zip(features, rows)):
        for t, token in enumerate(line):
            on[i, t, [number[f] for f in token]] = 1
        gold[i, :len(labels)], live[i, :len(labels)] = labels, True
    truth = np.eye(states)[gold] * live[..., None]
    truth_change = np.einsum("itj,itk->jk", truth[:, :-1], truth[:, 1:])
    theta = np.zeros((len(number) + states, states))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        change = theta[len(number):]
        score = (on @ theta[:len(number)].astype(np.float32)).astype(np.float64)
        ahead, back = np.zeros((n, most, states)), np.zeros((n, most, states))
        ahead[:, 0] = score[:, 0]
        for t in range(1, most):
            ahead[:, t] = np.where(live[:, t, None], _log_sum(ahead[:, t - 1, :, None] + change, 1) + score[:, t], ahead[:, t - 1])
        total = _log_sum(ahead[:, -1], 1)
        for t in range(most - 2, -1, -1):
            following = _log_sum(change + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(live[:, t + 1, None], following, 0)
        share = np.exp(ahead + back - total[:, None, None]) * live[..., None]
        pair = np.exp(
            ahead[:, :-1, :, None] + change + (score + back)[:, 1:, None, :] - total[:, None, None, None]
        ) * live[:, 1:, None, None]
        g = np.concatenate([np.tensordot(on, (share - truth).astype(np.float32), ((0, 1), (0, 1))), pair.sum((0, 1)) - truth_change]) + ridge * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    change = theta[len(number):].copy()
    for k in range(len(KINDS)):  # the inside of a span follows its beginning or inside
        wrong = [j for j in range(states) if j not in (1 + 2 * k, 2 + 2 * k)]
        change[wrong, 2 + 2 * k] = -1e4
    return Model(number, theta[:len(number)], change)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def viterbi(emit: np.ndarray, first: np.ndarray, n: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Best state of each token; sequence i has ``n[i]`` tokens from ``first[i]``.

    All sequences advance together, the longest first, so that those still running are a prefix.
    """
    order = np.argsort(-n, kind="stable")
    first, n = first[order], n[order]
    running = np.searchsorted(-n, -np.arange(n.max(initial=0)), "left")
    came = np.zeros(emit.shape, np.int8)
    now = np.zeros((len(n), emit.shape[1]))
    begin = np.zeros(emit.shape[1])
    begin[2::2] = -1e4
    for t, k in enumerate(running):
        at = first[:k] + t
        if t:
            paths = now[:k, :, None] + change
            came[at] = paths.argmax(1)
            now[:k] = paths.max(1) + emit[at]
        else:
            now[:k] = begin + emit[at]
    state, label = now.argmax(1), np.zeros(len(emit), np.int8)
    for t in range(len(running) - 1, -1, -1):
        at = first[:running[t]] + t
        label[at] = state[:len(at)]
        if t:
            state[:len(at)] = came[at, label[at]]
    return label


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    """Parts of a text that hold its triggers; near ones run together."""
    start = end = -1
    for m in _TRIGGER.finditer(text):
        if start >= 0 and m.start() - end <= 2 * MARGIN:
            end = m.end()
            continue
        if start >= 0:
            yield start, end
        start, end = m.start(), m.end()
    if start >= 0:
        yield start, end


def added_spans(texts: list[str], model: Model) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of what the field finds, for each text."""
    spans, owner, sizes, emit = [], [], [], []
    for i, text in enumerate(texts):
        for start, end in _stretches(text):
            start, end = max(0, start - MARGIN), min(len(text), end + MARGIN)
            tokens = _tokens(text, start, end)
            for token in _features(text, tokens):
                emit.append(model.emit[[model.number[f] for f in token if f in model.number]].sum(0))
            spans += tokens
            owner += [i] * len(tokens)
            sizes.append(len(tokens))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not spans:
        return found
    n = np.array(sizes)
    label = viterbi(np.array(emit), np.cumsum(n) - n, n, model.change)
    for at in np.flatnonzero(label % 2 == 1).tolist():
        last, kind = at, (int(label[at]) - 1) // 2
        while last + 1 < len(label) and label[last + 1] == label[at] + 1 and owner[last + 1] == owner[at]:
            last += 1
        found[owner[at]].append((spans[at][0], kind, spans[last][1]))
    return found


def _apart(spans: list[tuple[int, int, int]], others: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Spans that share no character with any of the others; both in order of start, one pass."""
    at, reached = 0, 0
    for start, kind, end in spans:
        while at < len(others) and others[at][0] <= start:
            reached = max(reached, others[at][2])
            at += 1
        if reached <= start and (at == len(others) or others[at][0] >= end):
            yield start, kind, end


def _plausible(text: str, kind: int, start: int, end: int) -> bool:
    """A span of the field must hold what its kind cannot do without."""
    part = text[start:end]
    digits = _NOT_DIGIT.sub("", part) if part.isascii() else ""
    if kind == 0:
        return "." in part and re.search(r"@|[\[(]at[\])]", part) is not None
    if kind == 1:
        numbers = re.findall("[0-9]+", part)
        return len(numbers) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in numbers)
    if kind == 2:
        return 14 <= len(digits) <= 19 and _luhn(digits)
    return 10 <= len(digits) <= 15


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and added: arrays of (kind, start, end) in code points, end exclusive.

    Spans are in order of start, then kind. A null or empty text has none. Repeated rows get equal
    results; other columns are not read.
    """
    spans = T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    ]))
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigger = np.zeros(256, bool)
        trigger[48:58] = trigger[[64, 40, 91]] = True  # digits, @, ( and [
        for batch in N.slices(batches, 1):
            data, offsets = N.text_bytes(batch.column(1))
            sums = np.concatenate([[0], np.cumsum(trigger[data], dtype=np.int64)])
            some = np.flatnonzero(sums[offsets[1:]] > sums[offsets[:-1]])  # others can't hold a span
            texts = batch.column(1).take(pa.array(some)).to_pylist()
            base: list[list] = [[] for _ in range(batch.num_rows)]
            added: list[list] = [[] for _ in range(batch.num_rows)]
            for i, text, more in zip(some.tolist(), texts, added_spans(texts, model)):
                own = base_spans(text)
                free = [(a, k, b) for a, k, b in _apart(sorted(more), own) if _plausible(text, k, a, b)]
                base[i], added[i] = (
                    [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in x] for x in (own, free)
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, arrow), pa.array(added, arrow)], names=["doc_id", "base", "added"]
            )

    schema = T.StructType([source.schema["doc_id"], T.StructField("base", spans), T.StructField("added", spans)])
    return source.mapInArrow(scan, schema)
