"""Encoding of a whole corpus with a public byte-level tokenizer.

Each executor builds the encoding once from a local rank file.  Texts longer
than ``chunk`` characters are split first at places where the tokenizer's own
pattern always ends a piece, so the chunks' ids joined are the whole text's.

Defined results: null and empty texts give an empty list; strings that look
like special tokens are ordinary text; unpaired surrogates become U+FFFD.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.session import tokenizer_path

# Fixed value: the pre-splitting pattern of the public byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Between a visible character and a single space before a letter, a piece always ends.
_SAFE = regex.compile(r"(?<=[\p{L}\p{N}])(?= \p{L})")
#: Where no such place comes: any border between two pieces of the pattern.
_PIECE = regex.compile(PATTERN)


@lru_cache(4)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def chunks(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters whose ids, joined, are those of the text."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None or cut.start() - start > 4 * size:
            # pieces are found from the last safe start on, so their borders are the whole text's
            end = start
            for m in _PIECE.finditer(text, start):
                end = m.end()
                if end - start >= size:
                    break
            # a run of white space may be split differently when its next character is missing
            while end < len(text) and text[end - 1].isspace():
                m = _PIECE.match(text, end)
                end = m.end() if m else len(text)
        else:
            end = cut.start()
        yield text[start:end]
        start = end
    yield text[start:]


def encode(text: str | None, enc: tiktoken.Encoding, chunk: int) -> list[int]:
    if not text:
        return []
    if len(text) <= chunk:
        return enc.encode_ordinary(text)
    return [i for part in chunks(text, chunk) for i in enc.encode_ordinary(part)]


def _udf(kind: str, path: str, chunk: int):
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for texts in batches:
            yield pd.Series([encode(t, enc, chunk) for t in texts], dtype=object)

    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for texts in batches:
            yield pd.Series([len(encode(t, enc, chunk)) for t in texts], dtype="int64")

    # types are set here, as the module's annotations are text
    for f in (ids, lengths):
        f.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(ids, "array<int>") if kind == "ids" else F.pandas_udf(lengths, "int")


def token_ids(text: Column, vocabulary: str | None = None, chunk: int = 100_000) -> Column:
    """Token ids of ``text``; ``vocabulary`` is the path of a rank file."""
    return _udf("ids", vocabulary or tokenizer_path("byte_bpe_50k.tiktoken"), chunk)(text)


def token_count(text: Column, vocabulary: str | None = None, chunk: int = 100_000) -> Column:
    """Number of token ids of ``text``."""
    return _udf("lengths", vocabulary or tokenizer_path("byte_bpe_50k.tiktoken"), chunk)(text)


@lru_cache(4)
def _bytes_of(path: str) -> dict[int, bytes]:
    enc = encoding(path)
    return {i: enc.decode_single_token_bytes(i) for i in range(enc.n_vocab)}


def decoded(ids: Column, vocabulary: str | None = None) -> Column:
    """Raw bytes of the ids, decoded as UTF-8 only after they are joined.

    Unknown ids give null; an empty list gives an empty text.
    """
    path = vocabulary or tokenizer_path("byte_bpe_50k.tiktoken")

    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = _bytes_of(path)
        for lists in batches:
            yield pd.Series([None if x is None or any(int(i) not in table for i in x) else b"".join(table[int(i)] for i in x).decode("utf-8", "replace") for x in lists], dtype=object)

    decode.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(decode, "string")(ids)


def encode_corpus(df: DataFrame, key: str, text: str, vocabulary: str | None = None, chunk: int = 100_000) -> DataFrame:
    """(key, ids) of every row."""
    return df.select(key, token_ids(F.col(text), vocabulary, chunk).alias("ids"))
