"""Operator 5: benchmark decontamination by pigeonhole edit matching.

Texts and items are lower-cased, each run of white space one space.  An item of m characters may
occur with up to k = m // ``chars_per_error`` edits.  It is split into k + 1 pieces; an occurrence with k edits leaves at
least one piece untouched, so exact hits of the pieces (Aho-Corasick, one pass over the whole text) find every candidate
place, and Myers' bit-parallel distance verifies the window around each hit.

Windows that overlap are merged, so a text with many hits of an item is verified once over.

The items are a stated query set, not a growing side: they are taken in blocks of ``block_items`` (fewer of long ones), each
block one pass over all texts, so that what is sent to the tasks is bounded by the block.

Defined results: null text counts as empty and matches nothing; items without text are no queries; repeated items
count once; a text with several occurrences of an item reports the best (fewest edits, then the first); empty
tables give no matches; very long texts are read whole; other columns are ignored by ``contamination`` and returned unchanged by ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import fresh, text_of, union_all

CHARS_PER_ERROR = 16
BLOCK_ITEMS = 20_000
#: A block holds so many characters an item at most, on average.
CHARS_PER_ITEM = 1000


def canonical(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def myers_ends(pattern: str, text: str) -> Iterator[tuple[int, int]]:
    """(end, distance): the least edit distance of the pattern to any part of the text that ends before ``end``."""
    m, peq = len(pattern), {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    for end, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(diag | up) & full, up & diag
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        plus, minus = plus << 1, minus << 1                 # the text may begin anywhere: no carry in
        up, down = (minus | ~(diag | eq | down | plus)) & full, plus & diag & full
        yield end, score


def best_match(pattern: str, text: str) -> tuple[int, int, int]:
    """(distance, start, end) of the best occurrence of the pattern in the text, the first of equals."""
    distance, end = min((d, e) for e, d in myers_ends(pattern, text))
    back = min((d, e) for e, d in myers_ends(pattern[::-1], text[:end][::-1]))
    return distance, end - back[1], end


def windows(starts: Iterable[int], size: int, k: int) -> Iterator[tuple[int, int]]:
    """The parts of a text around candidate places, merged where they overlap: each character is verified once."""
    low = high = None
    for start in sorted(starts):
        a, b = max(0, start - k), start + size + k
        if high is not None and a <= high:
            high = max(high, b)
        else:
            if high is not None:
                yield low, high
            low, high = a, b
    if high is not None:
        yield low, high


class Matcher:
    """The items of one block, ready to be found in texts.  Pickles as its items; the automaton is built where it is used."""

    def __init__(self, items: list[tuple[int, str]], chars_per_error: int = CHARS_PER_ERROR):
        self.items, self.chars_per_error, self._automaton = items, chars_per_error, None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def budget(self, pattern: str) -> int:
        return len(pattern) // self.chars_per_error

    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            pieces: dict[str, list[tuple[int, int]]] = {}
            for n, (_, pattern) in enumerate(self.items):
                parts = self.budget(pattern) + 1
                edges = [len(pattern) * i // parts for i in range(parts + 1)]
                for a, b in zip(edges, edges[1:]):
                    pieces.setdefault(pattern[a:b], []).append((n, a))
            self._automaton = ahocorasick.Automaton()
            for piece, places in pieces.items():
                self._automaton.add_word(piece, (len(piece), places))
            self._automaton.make_automaton()
        return self._automaton

    def matches(self, raw: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of every item that occurs; places are those in the canonical text."""
        text = canonical(raw)
        if not text or not self.items:
            return []
        best: dict[int, tuple[int, int, int]] = {}
        starts: dict[int, set[int]] = {}
        for last, (size, places) in self.automaton().iter(text):
            for n, offset in places:
                if n in best:
                    continue
                pattern, start = self.items[n][1], last + 1 - size - offset
                if start in starts.setdefault(n, set()):
                    continue
                if start >= 0 and text.startswith(pattern, start):
                    best[n] = (0, start, start + len(pattern))
                else:
                    starts[n].add(start)
        for n, places in starts.items():
            if n in best:
                continue
            pattern, k = self.items[n][1], self.budget(self.items[n][1])
            for low, high in windows(places, len(pattern), k):
                distance, a, b = best_match(pattern, text[low:high])
                found = (distance, low + a, low + b)
                if distance <= k:
                    best[n] = min(best.get(n, found), found)
        return [(self.items[n][0], *found) for n, found in best.items()]


def matchers(benchmark: DataFrame, id_col: str, text_col: str, chars_per_error: int, block_items: int) -> Iterator[Matcher]:
    """The items in blocks, read one after the other.  The number of blocks follows the number of items and of their
    characters, not that of the texts."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")).distinct()
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-chars // (block_items * CHARS_PER_ITEM)))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        pairs = sorted({(r["id"], canonical(r["text"])) for r in rows} - {(r["id"], "") for r in rows},
                       key=lambda p: (p[0] is None, p[0] or 0, p[1]))
        yield Matcher(pairs, chars_per_error)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", chars_per_error: int = CHARS_PER_ERROR,
                  block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per text and item that occurs in it: doc_id, item_id, distance, start, end."""
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"))
    kind = dict(benchmark.dtypes)[item_id]
    id_type = dict(texts.dtypes)["doc_id"]

    def found_by(matcher: Matcher) -> DataFrame:
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(doc, *m) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))
                        for m in matcher.matches(text.as_py())]
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1]) if rows else pa.array([], pa.int64()),
                     *(pa.array(c, pa.int32()) for c in cols[2:])], names=["doc_id", "item_id", "distance", "start", "end"])
        return texts.mapInArrow(find, f"doc_id {id_type}, item_id {kind}, distance int, start int, end int")

    return union_all(found_by(m) for m in matchers(benchmark, item_id, item_text, chars_per_error, block_items))


def is_contaminated(text: Column, matcher: Matcher) -> Column:
    @F.pandas_udf("boolean")
    def flag(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(matcher.matches(t)) for t in texts], dtype="bool")
    return flag(text)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", chars_per_error: int = CHARS_PER_ERROR,
                      block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` without the texts in which an item occurs, all columns unchanged."""
    flag = fresh(docs, "contaminated")
    for matcher in matchers(benchmark, item_id, item_text, chars_per_error, block_items):
        docs = docs.withColumn(flag, is_contaminated(text_of(text_col), matcher)).where(~F.col(f"`{flag}`")).drop(flag)
    return docs
