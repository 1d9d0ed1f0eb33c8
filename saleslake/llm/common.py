"""Helpers shared by the text operators: clash-free names, tables in the shared folder, null handling."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable
from types import ModuleType

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.session import scratch_path

#: ASCII white space as the contracts define it: space and U+0009 to U+000D.
ASCII_SPACE = r"[ \t-\r]+"


def text_of(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (column names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again.

    Cuts lineage in a way that survives lost executors, and gives later joins a known size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % modulus, F.lit(-1))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


#: Words whose hashes a task remembers; beyond it starts anew.
WORDS_HELD = 500_000


class WordHashes(dict):
    """Word (str or bytes) -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        raw = word.encode("utf-8", "surrogatepass") if isinstance(word, str) else word
        self[word] = h = xxhash.xxh3_64_intdigest(raw)
        return h


def per_process(key: str, make: Callable):
    """What a Python worker keeps from task to task: the value under ``key``, made on first use."""
    kept = sys.modules.setdefault("saleslake_llm_kept", ModuleType("saleslake_llm_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
