"""Token counts with a shortcut for whole tokens.

Most pre-tokens of running text are entries of the vocabulary. Which entries the tokenizer gives
back as one token is proved once, by encoding every entry alone; a pre-token among them counts as
one and is never merged. Only the rest go through the merges, each distinct one once per worker.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from turnloom.llm.byte_bpe import Vocabulary, _cut

LIMIT = 1024


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def whole_tokens(tokenizer: Tokenizer) -> list[str]:
    """The vocabulary strings that are one pre-token and that encode alone as one token."""
    of = byte_characters()
    texts = []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(of[c] for c in entry).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if _cut.findall(text) == [text]:
            texts.append(text)
    found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return sorted(t for t, e in zip(texts, found) if len(e.ids) == 1)


class Counts(Vocabulary):
    """Numbers of tokens; ``single`` are the strings proved to be one token."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.single = frozenset(whole_tokens(self.tokenizer))

    def resolve(self, pieces: list[str]) -> list[int]:
        cuts = [_cut.findall(p) for p in pieces]
        rest = list({t for cut in cuts for t in cut if t not in self.single})
        merged = dict(zip(rest, map(len, self.encode(rest))))
        return [sum(merged.get(t, 1) for t in cut) for cut in cuts]

    def value(self, ids: list[int]) -> int:
        return len(ids)


@lru_cache(maxsize=4)
def counter(path: str) -> Counts:
    """One per worker, which keeps it between tasks."""
    return Counts(path)


def count_tokens(path: str, texts: list[str | None]) -> list[int]:
    """The number of tokens of each text; 0 for null."""
    return list(map(sum, counter(path).values(texts)))


def n_tokens(path: str, text: str | Column = "text") -> Column:
    """The token count of a text column as the library gives it for the file at ``path``.

    Nothing is added, cut or padded; the string of an added token counts as the library's
    default has it. A null text has no tokens. The file must be at ``path`` on every machine.
    """

    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        return pa.array(count_tokens(path, column.to_pylist()), pa.int64())

    return count(F.col(text) if isinstance(text, str) else text)


def token_counts(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    A null text counts as an empty one; a null id and repeated rows stay as they are; other
    columns are ignored.
    """
    return df.select(
        F.col(id_col),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        n_tokens(path, text_col).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
