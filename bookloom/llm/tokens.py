"""Token counts by the files of public tokenizers."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabularies of public tokenizers lie; they are read there and never copied.
FOLDER = "/opt/tokenizers"
#: A byte-level BPE for many languages.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: How a text is parted before merging: contractions, letters, digits, other signs, white space.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=4)
def encoder(folder: str = FOLDER, vocabulary: str = VOCABULARY):
    """The tokenizer, read once per Python worker."""
    import tiktoken

    with open(f"{folder}/{vocabulary}", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bookloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: list[str], folder: str = FOLDER, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Tokens of each text."""
    encode = encoder(folder, vocabulary).encode_ordinary
    return np.fromiter((len(encode(t)) for t in texts), dtype=np.int64, count=len(texts))


def with_tokens(df: DataFrame, text: str = "text", out: str = "tokens", keep: list[str] | None = None, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` of ``df`` and the number of tokens of ``text`` (0 where it is null).

    The text itself is not carried on.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    fields = ", ".join(f"`{c}` {k}" for c, k in df.select(*keep).dtypes)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf.pop("_text")
            pdf[out] = count_tokens(texts.tolist(), folder, vocabulary)
            yield pdf

    return df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text")).mapInPandas(count, f"{fields}, `{out}` bigint")
