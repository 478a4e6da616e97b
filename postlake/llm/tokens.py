"""Token counts and offsets with a public byte-level BPE vocabulary, read from a path."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the vocabulary lies on driver and executors; every operator takes it as a parameter.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-tokenisation pattern published with this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(maxsize=4)
def encoder(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def token_lengths(path: str = VOCABULARY) -> np.ndarray:
    """Bytes of each token."""
    e = encoder(path)
    out = np.zeros(e.n_vocab, np.int64)
    for i in range(e.n_vocab):
        try:
            out[i] = len(e.decode_single_token_bytes(i))
        except KeyError:
            pass
    return out


def clean(text: str) -> str:
    """Lone surrogates, which no encoder takes, become question marks."""
    return text.encode("utf-8", "replace").decode("utf-8")


def count_tokens(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of a text: 0 for NULL and empty texts, whole texts however long."""

    @F.pandas_udf("int")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for s in parts:
            yield pd.Series([len(e.encode_ordinary(t)) if t else 0 for t in s], dtype="int32")

    return count(text)
