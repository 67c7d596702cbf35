"""Column expressions for text: whitespace words, word windows, token estimates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace class used for word splitting (same in the SQL oracles).
WS = "[ \\t\\n\\r]+"
EDGE_WS = "^[ \\t\\n\\r]+|[ \\t\\n\\r]+$"


EDGE_CHARS = " \t\n\r"


def words(text: Column) -> Column:
    """Whitespace-separated words of the whole text (an empty text gives [''])."""
    return F.split(F.btrim(text, F.lit(EDGE_CHARS)), WS)


def chunk_words(w: Column, words_per_chunk: int) -> Column:
    """Array of chunk texts from a words array (see `words`), each
    `words_per_chunk` words joined by one space.

    Pass a column that already holds the words: an expression would be
    re-evaluated inside the lambda once per chunk.
    """
    if words_per_chunk < 1:
        raise ValueError("words_per_chunk must be positive")
    n = F.lit(words_per_chunk)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(w) / n) - 1, F.lit(0)))
    return F.transform(starts, lambda i: F.array_join(F.slice(w, i * n + 1, n), " "))


def estimate_tokens(text: Column, chars_per_token: int = 4) -> Column:
    """Native token estimate: ceil(characters / chars_per_token)."""
    return F.ceil(F.length(text) / F.lit(chars_per_token)).cast("long")


def bpe_token_counter(model: str):
    """Optional exact BPE counter as a pandas UDF, when a vocabulary is available.

    Returns None when the tokenizer files cannot be loaded offline; callers fall
    back to `estimate_tokens`.
    """
    try:
        import tiktoken
        try:
            enc = tiktoken.encoding_for_model(model)
        except KeyError:
            enc = tiktoken.get_encoding("cl100k_base")
        enc.encode("probe")
    except Exception:  # vocabulary not present offline
        return None
    import pandas as pd

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(x) for x in enc.encode_ordinary_batch(texts.fillna("").tolist())])

    return count
