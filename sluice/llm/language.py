"""Language identification of texts that may mix languages.

A word's score for a language is the log-likelihood of its byte trigrams, counted over all
documents of known language. The scripts of its letters narrow the candidates: a language in
which a script hardly ever occurs is out for words in that script. Viterbi over a document's
words, with a penalty for changing language, labels spans; the language of most letters is the
document's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.llm import words as N

#: Trigrams are hashed to so many buckets, which bounds the model: buckets x languages.
BUCKETS = 1 << 16
#: Log-likelihood that a change of language must gain.
SWITCH = 12.0
#: Words of a text that are labelled one after the other; pieces of longer ones go side by side.
PIECE = 1024
#: A script is a candidate's if this share of the language's letters is written in it.
SCRIPT_SHARE = 0.001
UNKNOWN = "und"

# First code points of script ranges, ascending, and the script from there on.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"),
    (0xD7B0, "other"),
)
_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([start for start, _ in SCRIPTS])
_SCRIPT = np.array([_NAMES.index(name) for _, name in SCRIPTS])


@dataclass
class Model:
    """Languages, log-probabilities by bucket and language, and which scripts each may have."""

    languages: list[str]
    scores: np.ndarray
    allowed: np.ndarray


def _letters(data: np.ndarray) -> np.ndarray:
    """The script of the character that begins at each byte, -1 elsewhere and for ASCII non-letters."""
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    first = padded[:-3]
    code = np.where(first < 0x80, first, -1)
    two, three, four = (first >> 5) == 6, (first >> 4) == 14, (first >> 3) == 30
    code = np.where(two, (first & 31) << 6 | padded[1:-2] & 63, code)
    code = np.where(three, (first & 15) << 12 | (padded[1:-2] & 63) << 6 | padded[2:-1] & 63, code)
    code = np.where(four, 0x10000, code)
    script = _SCRIPT[np.searchsorted(_STARTS, np.maximum(code, 0), "right") - 1]
    return np.where((code < 0) | (first < 0x80) & ~N.LETTER[data], -1, script)


def _grams(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Words as runs of letters, with the bucket of the trigram that ends at each of their bytes.

    A word has one trigram for each byte; the first two reach into the gap before it.
    """
    data, offsets = N.text_bytes(column)
    data = N.LOWER[data]
    inside = N.LETTER[data]
    starts, ends, text = N.spans(inside, offsets)
    seen = np.where(inside, data, 32).astype(np.uint32)
    code = seen.copy()
    code[1:] |= seen[:-1] << 8
    if len(starts):  # the byte before a word is a gap, also where it ends another text
        code[starts] = code[starts] & 255 | 32 << 8
    code[2:] |= (code[1:-1] >> 8) << 16 if len(code) > 2 else 0
    bucket = N.mix(code.astype(np.uint64)) % np.uint64(BUCKETS)
    return data, inside, starts, ends, text, bucket.astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams and scripts by language of one task: rows lang, feature, n; scripts are negative."""
    counts: dict[str, np.ndarray] = {}
    for batch in N.slices(batches, 0):
        for lang in batch.column(1).unique().to_pylist():
            texts = batch.column(0).filter(pa.compute.equal(batch.column(1), lang))
            data, inside, *_, bucket = _grams(texts)
            own = counts.setdefault(lang, np.zeros(BUCKETS + len(_NAMES), np.int64))
            own[:BUCKETS] += np.bincount(bucket[inside], minlength=BUCKETS)
            script = _letters(data)
            own[BUCKETS:] += np.bincount(script[script >= 0], minlength=len(_NAMES))
    for lang, n in counts.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())],
            names=["lang", "feature", "n"],
        )


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all rows of ``docs`` with a language and a text.

    The driver gets the sums: at most BUCKETS + scripts numbers for each language.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    sums = known.mapInArrow(_count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n"))
    found = sums.toArrow()
    languages = sorted(pa.compute.unique(found.column(0)).to_pylist())
    counts = np.zeros((BUCKETS + len(_NAMES), len(languages)))
    if languages:
        row = pa.compute.index_in(found.column(0), pa.array(languages)).to_numpy()
        counts[found.column(1).to_numpy(), row] = found.column(2).to_numpy()
    grams, scripts = counts[:BUCKETS] + 0.5, counts[BUCKETS:]
    share = scripts / np.maximum(scripts.sum(0), 1)
    return Model(languages, np.log(grams / grams.sum(0)).astype(np.float32), share >= SCRIPT_SHARE)


def _viterbi(scores: np.ndarray, first: np.ndarray, n: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """Best language of each word; text i has the words from ``first[i]``, ``n[i]`` of them.

    Texts longer than ``piece`` words are cut into pieces of so many, after it is known in which
    language the best path enters and leaves each piece; then all pieces and texts are labelled together.
    """
    long = n > piece
    if not long.any():
        return _paths(scores, first, n)
    none = np.full((~long).sum(), -1)
    parts = zip((first[~long], n[~long], none, none), _pieces(scores, first[long], n[long], piece))
    return _paths(scores, *map(np.concatenate, parts))


def _pieces(scores: np.ndarray, first: np.ndarray, n: np.ndarray, piece: int) -> tuple[np.ndarray, ...]:
    """First words and sizes of all texts' pieces, the language before each (-1: none) and at its end.

    The best score from every language before a piece to every one at its end is found for all
    pieces at once, word by word; along a text only these small tables are put together.
    """
    count = -(-n // piece)
    head = np.cumsum(count) - count  # each text's first piece
    place = np.arange(count.sum()) - np.repeat(head, count)
    starts = np.repeat(first, count) + place * piece
    sizes = np.minimum(np.repeat(n, count) - place * piece, piece)
    order = np.argsort(-sizes, kind="stable")
    begin, running = starts[order], np.searchsorted(-sizes[order], -np.arange(piece), "left")
    languages = scores.shape[1]
    table = np.where(np.eye(languages, dtype=bool), 0.0, -float(SWITCH)) + scores[begin][:, None, :].astype(np.float64)
    for t in range(1, piece):
        k = running[t]
        now = table[:k]
        table[:k] = np.maximum(now, now.max(2, keepdims=True) - SWITCH) + scores[begin[:k] + t][:, None, :]
    table[order] = table.copy()
    ends = np.empty(len(starts), np.int64)
    for text in range(len(n)):
        a, b = head[text], head[text] + count[text]
        state = table[a].max(0)  # before the first word no language is better than another
        came = np.zeros((b - a, languages), np.int64)
        for c in range(a + 1, b):
            reach = state[:, None] + table[c]
            came[c - a] = reach.argmax(0)
            state = reach.max(0)
            state = state - state.max()
        ends[b - 1] = state.argmax()
        for c in range(b - 1, a, -1):
            ends[c - 1] = came[c - a, ends[c]]
    before = np.append(-1, ends[:-1])
    before[head] = -1
    return starts, sizes, before, ends


def _paths(
    scores: np.ndarray, first: np.ndarray, n: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None
) -> np.ndarray:
    """Best language of each word, with that before the first and that of the last word given where not -1.

    All texts advance together, one word a step, the longest first so that those still running
    are a prefix.
    """
    order = np.argsort(-n, kind="stable")
    first, n = first[order], n[order]
    running = np.searchsorted(-n, -np.arange(n.max(initial=0)), "left")
    best_before = np.zeros(len(scores), np.int16)
    stays = np.zeros(scores.shape, bool)
    state = np.zeros((len(n), scores.shape[1]), np.float32)
    if before is not None:
        given = before[order]
        state[(given >= 0)[:, None] & (np.arange(scores.shape[1]) != given[:, None])] = -SWITCH
    for t, k in enumerate(running):
        at, now = first[:k] + t, state[:k]
        if t:
            best = now.argmax(1)
            top = now[np.arange(k), best] - np.float32(SWITCH)
            stay = now >= top[:, None]
            best_before[at], stays[at] = best, stay
            now = np.where(stay, now, top[:, None])
            now -= now.max(1, keepdims=True)
        state[:k] = now + scores[at]
    label = np.zeros(len(scores), np.int16)
    now = state.argmax(1).astype(np.int16)
    if after is not None:
        now = np.where(after[order] >= 0, after[order], now).astype(np.int16)
    for t in range(len(running) - 1, -1, -1):
        at = first[:running[t]] + t
        label[at] = now[:len(at)]
        if t:
            now[:len(at)] = np.where(stays[at, label[at]], label[at], best_before[at])
    return label


def _label(column: pa.Array, model: Model) -> tuple[list, np.ndarray, list]:
    """Predicted language, score and spans (in words of letters) of each text."""
    rows = len(column)
    data, inside, starts, ends, text, bucket = _grams(column)
    languages = len(model.languages)
    if not languages or not len(starts):
        return [UNKNOWN] * rows, np.zeros(rows), [[] for _ in range(rows)]
    sums = np.add.reduceat(np.where(inside[:, None], model.scores[bucket], 0), starts, axis=0)
    script = _letters(data)
    of_word = np.repeat(np.arange(len(starts)), ends - starts)
    here = script[inside] >= 0
    has = np.zeros((len(starts), len(_NAMES)), bool)
    has[of_word[here], script[inside][here]] = True
    barred = (has.astype(np.float32) @ (~model.allowed).astype(np.float32)) > 0
    barred[barred.all(1)] = False  # a script no language has tells nothing
    scores = np.where(barred, sums - np.float32(1000), sums)
    n = np.bincount(text, minlength=rows)
    first = np.cumsum(n) - n
    label = _viterbi(scores, first, n)
    weight = np.bincount(of_word[here], minlength=len(starts))
    share = np.bincount(text * languages + label, weights=weight, minlength=rows * languages).reshape(rows, languages)
    letters = share.sum(1)
    best = share.argmax(1)
    score = share.max(1) / np.maximum(letters, 1)
    change = np.concatenate([[True], (label[1:] != label[:-1]) | (text[1:] != text[:-1])])
    at = np.flatnonzero(change)
    until = np.concatenate([at[1:], [len(label)]])
    found: list[list] = [[] for _ in range(rows)]
    for a, b in zip(at.tolist(), until.tolist()):
        i = text[a]
        found[i].append({"first_word": a - int(first[i]), "words": b - a, "lang": model.languages[label[a]]})
    names = [model.languages[b] if w else UNKNOWN for b, w in zip(best, letters)]
    return names, np.where(letters > 0, score, 0.0), found


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """doc (struct of ``carry``), lang_pred, score and spans of every text.

    ``score`` is the share of letters labelled with the predicted language. A null text and one
    without letters are ``und`` with score 0, as is everything if nothing could be learned. Ties
    go to the language first in code point order. Repeated rows get equal results.
    """
    span = T.ArrayType(T.StructType([
        T.StructField("first_word", T.LongType()), T.StructField("words", T.LongType()), T.StructField("lang", T.StringType()),
    ]))
    source = docs.select(F.struct(*carry).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    arrow_span = pa.list_(pa.struct([("first_word", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(1 << 18, (1 << 23) // max(1, len(model.languages)))
        for batch in N.slices(batches, 1, most):
            names, score, found = _label(batch.column(1), model)
            for i in [i for i, name in enumerate(names) if name != UNKNOWN]:
                if score[i] and not any(map(str.isalpha, batch.column(1)[i].as_py())):  # symbols beyond ASCII alone
                    names[i], score[i] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(found, arrow_span)],
                names=["doc", "lang_pred", "score", "spans"],
            )

    schema = T.StructType([
        source.schema["doc"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("spans", span),
    ])
    return source.mapInArrow(label, schema)
