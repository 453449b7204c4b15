"""Token ids of the public byte-level BPE vocabulary.

``tokenizers`` reads the vocabulary's JSON file, ``tiktoken`` the same vocabulary as ranks. Both
give the same ids (tested); encoding runs in ``tiktoken``, which is several times as fast, but
panics on a run of a million blanks: texts with a long run of them are encoded by ``tokenizers``.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import public_tokenizers

VOCABULARY = "byte_bpe_50k"
#: Blanks in a row that ``tiktoken`` is given at most; its pattern keeps a state for each of them.
LONGEST_BLANK = 65_536
_LONG_BLANK = re.compile(rf"(?<!\s)\s{{{LONGEST_BLANK + 1}}}")


@lru_cache(maxsize=1)
def encoder(path: str | None = None):
    """The encoder for a file of ranks, by default the public one; once per Python worker."""
    import tiktoken

    with open(path or public_tokenizers.path(f"{VOCABULARY}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return tiktoken.Encoding(VOCABULARY, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def whole_encoder():
    """The encoder for the JSON file; once per Python worker."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{VOCABULARY}.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def encode(text: str) -> list[int]:
    """The ids of any text, however long its runs of blanks."""
    if len(text) > LONGEST_BLANK and _LONG_BLANK.search(text):
        return whole_encoder().encode(text, add_special_tokens=False).ids
    return encoder().encode_ordinary(text)
