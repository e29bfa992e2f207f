"""Token counts by a public tokenizer; each Python worker loads it once."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
RANKS_FILE = "byte_bpe_50k.tiktoken"
#: Fixed value: the published split pattern of that vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@lru_cache(maxsize=2)
def encoder(tokenizer_dir: str, ranks_file: str):
    import tiktoken

    with open(f"{tokenizer_dir}/{ranks_file}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, tokenizer_dir: str = TOKENIZER_DIR, ranks_file: str = RANKS_FILE) -> Column:
    """Tokens of the whole text, 0 for NULL or empty."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(tokenizer_dir, ranks_file)
        for s in batches:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in s], dtype="int32")

    return count(text)
