"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The vocabulary file, present on every machine; never copied into the repository.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published splitting pattern of this vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The encoder gets texts in pieces cut at line ends or blanks, so that one very long text needs no long buffer.
PIECE = 200_000


def encoder(path: str = VOCABULARY) -> object:
    """The encoder of a vocabulary file, read once in a worker, however often its functions are sent to it."""
    import tiktoken

    held = tiktoken.__dict__.setdefault("_encoders_by_path", {})
    if path not in held:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        held[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return held[path]


def count_tokens(text: str | None, path: str = VOCABULARY) -> int:
    if not text:
        return 0
    encode = encoder(path).encode_ordinary
    total = start = 0
    while start < len(text):
        end = min(len(text), start + PIECE)
        if end < len(text):
            # One blank between two letters always begins a token of its own.
            while end > start + 1 and not (text[end] == " " and text[end - 1].isalpha() and text[end + 1 : end + 2].isalpha()):
                end -= 1
            if end == start + 1:
                end = min(len(text), start + PIECE)
        total += len(encode(text[start:end]))
        start = end
    return total


def with_token_counts(df: DataFrame, keep: str, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The columns of the schema string ``keep`` and ``tokens``; a null text has none."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = [count_tokens(t, path) for t in batch["_text"]]
            yield batch.drop(columns="_text").assign(tokens=counts)

    names = [part.split()[0] for part in keep.split(",")]
    return df.select(*names, F.col(text).alias("_text")).mapInPandas(count, f"{keep}, tokens long")
