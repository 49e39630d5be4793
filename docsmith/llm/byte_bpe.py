"""Byte-level tokens of a public tokenizers file, for texts of any length."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

import numpy as np

from docsmith.llm.common import ship_by_value

#: Longest run of white space that goes through the byte-pair ranks: their pattern
#: search recurses in such runs and ends the process in runs of about a million.
MAX_SPACES = 100_000


def byte_ranks(tokenizer: str) -> dict[bytes, int]:
    """Bytes -> id of the vocabulary of a tokenizers file (name.json), from its
    file of ranks (name.tiktoken)."""
    import base64

    import public_tokenizers as public

    with open(public.path(tokenizer.replace(".json", ".tiktoken")), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_bpe_encoder(tokenizer: str, special: bool) -> Callable[[str], np.ndarray]:
    """text -> ids (uint32) as the tokenizers file gives them with
    add_special_tokens=False; ``special``: strings of special tokens inside a
    text become these tokens, else they are plain text.

    The same vocabulary and pattern as byte-pair ranks encodes several times
    faster.  Texts that the ranks cannot encode alike (special strings that
    count, very long white space) go through the file itself."""
    import json

    import public_tokenizers as public
    import tiktoken

    fast = tiktoken.Encoding(tokenizer, pat_str=public.PATTERN, mergeable_ranks=byte_ranks(tokenizer), special_tokens={})
    with open(public.path(tokenizer), encoding="utf-8") as f:
        strings = [t["content"] for t in json.load(f)["added_tokens"]] if special else []
    spaces = re.compile(r"\s{%d}" % MAX_SPACES)

    @cache
    def exact():  # few texts need it, and it is large
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(public.path(tokenizer))
        own.encode_special_tokens = not special
        return own

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in strings) or (len(text) > MAX_SPACES and spaces.search(text)):
            return np.array(exact().encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode


ship_by_value(__name__)
