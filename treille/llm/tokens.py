"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treille.plans.lineage import spread

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

# How the byte-level vocabulary cuts text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(df: DataFrame, key: str, text: str, *carried: str, path: str = TOKENIZER) -> DataFrame:
    """(key, carried..., tokens, loss_tokens) of every row.

    Loss-bearing are the tokens behind the first paragraph, the prompt of an example; a
    text of one paragraph bears loss throughout. Null and empty texts have no tokens. The
    file at ``path`` is sent to the workers where the driver has it, else read there.
    """
    shipped = os.path.exists(path)
    if shipped:
        df.sparkSession.sparkContext.addFile(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(SparkFiles.get(os.path.basename(path)) if shipped else path)
        for pdf in batches:
            total, loss = [], []
            for t in pdf["_text"]:
                if not t:
                    total.append(0)
                    loss.append(0)
                    continue
                n = len(enc.encode_ordinary(t))
                prompt, _, rest = t.partition("\n\n")
                total.append(n)
                loss.append(max(1, n - len(enc.encode_ordinary(prompt))) if rest.strip() else n)
            yield pdf.drop(columns="_text").assign(tokens=total, loss_tokens=loss)

    kinds = dict(df.dtypes)
    named = [key, *carried]
    rows = spread(df.select(*named, F.col(text).alias("_text")))
    return rows.mapInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in named) + ", tokens bigint, loss_tokens bigint")
