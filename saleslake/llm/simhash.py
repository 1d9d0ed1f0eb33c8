"""Operator 3: SimHash near-duplicates by pigeonhole blocks.

A fingerprint is 64 majority votes over the XXH64 hashes (seed 42) of a text's word shingles.  Fingerprints link
at ``max_bits`` differing bits or fewer.  The 64 bits are split into ``blocks`` blocks; a pair that
differs in at most ``max_bits`` bits agrees on at least ``blocks - max_bits`` of them, so every choice of that many blocks
is a join key and no link is missed.  The members of a key meet in one task, which verifies the Hamming
distances and returns a spanning forest of the links, never all pairs.  Equal fingerprints are one member, so copies don't
count.  A key with more than ``most`` different fingerprints is linked another exact way: two fingerprints lie
within ``max_bits`` bits if and only if some 64-bit value lies within half of that from each, so
all such values become grouping keys, combined on the map side.

Defined results: null text counts as empty; a text without words has fingerprint zero and links like any other; fewer
words than a shingle make one shingle; repeated rows share a fingerprint; an empty table gives no rows; other columns are
ignored by ``near_duplicates`` and returned unchanged by ``drop_near_copies``; component_id ignores null ids, and
is null only where every id of the component is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.llm.common import text_of, written
from saleslake.llm.components import connected_components

SEED = 42
#: One bit in each byte of a word, to count eight bit positions in one sum.
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words (A-Z lower-cased), repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1:] - 1).tolist())
    return np.fromiter((digest(line[i:j], SEED) for i, j in spans), np.uint64, len(words) - shingle + 1)


def fingerprint(text: str, shingle: int = 4) -> int:
    """The 64 majority votes; bit i is set if it is set in over half of the hashes."""
    hashes = shingle_hashes(text, shingle)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255):                       # a lane holds sums up to 255
        part = hashes[at: at + 255]
        for bit in range(8):
            lanes = ((part >> np.uint64(bit)) & LANES).sum(dtype=np.uint64)
            counts[bit::8] += np.frombuffer(lanes.tobytes(), np.uint8)
    votes = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(votes.view(np.uint64)[0])


def fingerprint_col(text: Column, shingle: int = 4) -> Column:
    """The fingerprint as a signed long."""
    @F.pandas_udf("long")
    def of_text(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))
    return of_text(text)


def block_masks(blocks: int, agree: int) -> list[int]:
    """Signed 64-bit masks of every choice of ``agree`` out of ``blocks`` blocks of bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [reduce(int.__or__, c) for c in combinations(block, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(members: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """(member, smallest of its component) for the links among different fingerprints of one key.

    Breadth first: each member reached is compared with those not reached yet, so a dense group costs about one
    comparison per member.
    """
    left = np.sort(members)
    while len(left) > 1:
        root, left, queue = left[0], left[1:], [left[0]]
        while queue and len(left):
            # as unsigned words: of a signed number, numpy counts the bits of the absolute value
            near = np.bitwise_count((left ^ queue.pop()).view(np.uint64)) <= max_bits
            for m in left[near]:
                yield int(m), int(root)
            queue.extend(left[near])
            left = left[~near]


LINK_SCHEMA = "mask long, u long, v long"


def _linker(max_bits: int, most: int):
    """Links of the keys in a partition sorted by (mask, key); rows of keys over ``most`` members go out as (mask, fp, null)."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, over = None, [], False                    # the key that the batch before ended in

        def close(out: list, mask: int, members) -> None:
            if len(members) > most:
                out.extend((mask, f, None) for f in members)
            else:
                out.extend((mask, u, v) for u, v in forest(np.array(members, np.int64), max_bits))

        for batch in batches:
            if not batch.num_rows:
                continue
            out: list = []
            mask, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
            ends = np.r_[starts[1:], len(fp)]
            if (mask[0], key[0]) != at:
                if at is not None and not over:
                    close(out, at[0], held)
                at, held, over = (mask[0], key[0]), [], False
            held.extend(fp[: ends[0]].tolist())
            if over or len(held) > most:                    # pass its members on instead of holding them
                out.extend((at[0], f, None) for f in held)
                held, over = [], True
            if len(starts) > 1:
                if not over:
                    close(out, at[0], held)
                for g in np.flatnonzero(ends[1:-1] - starts[1:-1] > 1) + 1:
                    close(out, mask[starts[g]], fp[starts[g]: ends[g]])
                at, held, over = (mask[starts[-1]], key[starts[-1]]), fp[starts[-1]:].tolist(), False
            yield _rows(out)
        out = []
        if at is not None and not over:
            close(out, at[0], held)
        yield _rows(out)
    return link


def _rows(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array([None if x is None else int(x) for x in c], pa.int64()) for c in cols],
                                      names=["mask", "u", "v"])


def _middle_links(hot: DataFrame, max_bits: int) -> DataFrame:
    """Links among the members (mask, fp) of large keys through the values in the middle of each pair.

    Members of a key agree on the mask's bits, so only the other bits are flipped.  Two members that
    share a value within max_bits // 2 of one and the rest of the other are within max_bits of each other.
    """
    near, far = max_bits // 2, max_bits - max_bits // 2
    flips = [reduce(int.__or__, (1 << b for b in c), 0) for n in range(far + 1) for c in combinations(range(64), n)]
    flips = [(m - (1 << 64) if m >> 63 else m, bin(m).count("1")) for m in flips]
    flip = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("bits"), F.lit(n).alias("n")) for m, n in flips]))
    probes = hot.select("mask", "fp", flip.alias("flip")).where("flip.bits & mask = 0").select(
        "mask", "fp", F.col("fp").bitwiseXOR(F.col("flip.bits")).alias("middle"), (F.col("flip.n") <= near).alias("near"))
    # a link needs one end within ``near``: all members within ``far`` of a middle that some member is near to join
    least = probes.where("near").groupBy("mask", "middle").agg(F.min("fp").alias("v"))
    return probes.join(least, ["mask", "middle"]).where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def links(fps: DataFrame, max_bits: int = 4, blocks: int = 7, most: int = 2048) -> DataFrame:
    """``fps``: different fingerprints (fp long).  Links u, v whose components are those of all pairs within max_bits."""
    if max_bits >= blocks:
        raise ValueError("more blocks than differing bits are needed")
    masks = F.explode(F.array(*[F.lit(m).cast("long") for m in block_masks(blocks, blocks - max_bits)]))
    keyed = (fps.select("fp", masks.alias("mask"))
             .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
             .repartition("mask", "key").sortWithinPartitions("mask", "key"))
    found = written(keyed.mapInArrow(_linker(max_bits, most), LINK_SCHEMA), "simhash-links")
    hot = found.where("v is null").select("mask", F.col("u").alias("fp"))
    near = found.where("v is not null").select("u", "v").distinct()
    return near if hot.isEmpty() else near.unionByName(_middle_links(hot, max_bits))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, blocks: int,
             most: int) -> tuple[DataFrame, DataFrame]:
    """Slim rows (id, content, fp) and per fingerprint its component's smallest (id, content)."""
    slim = written(docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text_of(text_col)).alias("content"),
                               fingerprint_col(text_of(text_col), shingle).alias("fp")), "simhash-fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "content"))
    fps = slim.groupBy("fp").agg(first.alias("first"))
    roots = written(connected_components(links(fps.select("fp"), max_bits, blocks, most)), "simhash-roots")
    member = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    least = member.groupBy("root").agg(F.min("first").alias("first"))
    return slim, member.drop("first").join(least, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, blocks: int = 7, most: int = 2048) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable over links, itself included)."""
    slim, groups = _grouped(docs, id_col, text_col, shingle, max_bits, blocks, most)
    return slim.join(groups, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                     max_bits: int = 4, blocks: int = 7, most: int = 2048) -> DataFrame:
    """``docs`` with one document of each component, all columns unchanged: the one with the smallest id
    (of several rows with that id the one with the smallest content hash, once)."""
    _, groups = _grouped(docs, id_col, text_col, shingle, max_bits, blocks, most)
    name = lambda c: F.coalesce(c.cast("string"), F.lit("null"))  # noqa: E731 - a join key that is never null
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
                       name(F.col(f"`{id_col}`")).alias("key"), F.xxhash64(text_of(text_col)).alias("content"))
    stay = groups.select(name(F.col("first.id")).alias("key"), F.col("first.content").alias("content")).distinct()
    once = Window.partitionBy("key", "content").orderBy("key")
    kept = rows.join(stay, ["key", "content"]).withColumn("nth", F.row_number().over(once))
    return kept.where("nth = 1").select("whole.*")
