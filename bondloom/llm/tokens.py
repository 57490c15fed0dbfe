"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

import numpy as np
import tiktoken

#: Folder and file of the vocabulary; parameters of every operator that counts tokens.
FOLDER, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"

# Fixed value: the public pattern that cuts a text before pairs are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoder(folder: str = FOLDER, vocabulary: str = VOCABULARY) -> tiktoken.Encoding:
    """The tokenizer, read once per worker. Special strings are ordinary text."""
    with Path(folder, vocabulary).open("rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str | None, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Ids of a whole text; none for null and the empty text."""
    if not text:
        return np.empty(0, dtype=np.int64)
    return np.asarray(encoder(folder, vocabulary).encode_ordinary(text), dtype=np.int64)
