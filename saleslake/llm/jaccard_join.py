"""Operator 13: similarity join on n-gram sets (Jaccard), size-aware: light sets by subsets, heavy sets by inverted lists.

A text's set holds the hashes of its distinct shingles.  All sets use one order of the hashes: rarer first, by a sketch of
counts (one byte for each of up to 2^24 cells), which only orders and decides nothing else.  Two sets that share at least
o elements share j of them among the first (size - o + j) of each.

* Light sets (up to ``boundary`` elements) enumerate all subsets of two among the first (size - least overlap + 2).
* Heavy sets go into inverted lists of their first (size - least overlap + 1) elements, together with light sets that are
  near enough to the boundary to match a heavy one.

``boundary`` is the one of least cost: subsets enumerated against elements listed and met in lists, summed over the sets of each size.

A list of up to ``most`` sets gives its pairs that size and position allow.  Longer ones give pairs in rounds: a growing share
of the members, chosen by hash, are pivots and are paired with the members outside their component, as far as found; the
last round takes all, so no pair between different components is left out, and a group of near copies costs about
one comparison per member and pivot.  Pairs whose sets differ in too many of 1,024 (512) parities can't be similar; the others are
verified on their whole sets, whose shingles are hashed again from the stored (compressed) texts.  Equal sets count once.
Components come from all verified links.

Defined results: null text counts as empty; a text without words has an empty set and no link; with fewer words than a shingle
the whole sequence is its one element; a null id is never the smallest of its component; repeated rows are texts of their own; an
empty table gives no rows; texts are read whole, whatever their length; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import per_process, text_of, union_all, written
from saleslake.llm.components import connected_components
from saleslake.operators.skew import heavy_hitter_join, heavy_hitters, heavy_keys

MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Cells of the sketch: one for so many elements, between these bounds; blocks of cells that are summed together.
PER_CELL, LEAST_LOG, MOST_LOG, BLOCK_LOG = 16, 16, 24, 14
#: Counts up to EXACT are levels themselves; above, levels are quarters of a power of two.
EXACT = 160
#: Largest size that may be light.
LIGHT_MOST = 64
#: Sets a task remembers while it verifies.
SETS_HELD = 2000
#: Row numbers of the sets and texts to verify that are sent to all tasks at most; more are joined by a shuffle.
ENDS_SENT = 1 << 21
#: Distinct texts a task remembers while it stores them.
KEYS_HELD = 1_000_000


#: White space as the contract has it, by byte.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
A_SPACE = re.compile(rb"[\x09-\x0d\x20]")
#: Bytes that are hashed together (a longer word is not cut).
PIECE = 1 << 21
BASE = 0x9E3779B97F4A7C15 | 1


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse modulo 2 ** 64, kept by the worker."""
    kept = per_process("jaccard-powers", dict)
    if len(kept.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            kept[name] = np.cumprod(steps)
    return kept["up"], kept["down"]


def hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word.  Sums of bytes times powers up to each place give every word's polynomial at once."""
    hashes, places, low = [], [], 0
    while low < len(raw):
        end = A_SPACE.search(raw, low + PIECE) if low + PIECE < len(raw) else None
        high = end.start() if end else len(raw)
        b = np.frombuffer(raw, np.uint8, high - low, low)
        edges = np.flatnonzero(np.diff(SPACE[b], prepend=True, append=True))
        starts, ends = edges[::2], edges[1::2]
        up, down = powers(len(b) + 1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
        hashes.append(scramble((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MULTIPLY))
        places.append(starts + low)
        low = high
    return (np.concatenate(hashes), np.concatenate(places)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _joined(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each ``n`` words that follow each other."""
    out = np.full(max(0, len(words) - n + 1), n, np.uint64)
    for i in range(n):
        out = out * MULTIPLY + words[i: len(out) + i]
    return scramble(out)


def shingle_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its shingles of ``n`` words; of fewer words, the one of the whole sequence."""
    words, places = hashed_words(b"\n".join(texts))
    cuts = np.searchsorted(places, np.cumsum([0, *(len(t) + 1 for t in texts)])).tolist()
    every = _joined(words, n)
    for a, b in zip(cuts, cuts[1:]):
        s = np.sort(every[a: b - n + 1] if b - a >= n else _joined(words[a:b], b - a) if b > a else words[a:b])
        yield s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s


#: Words of 64 bits of a set's parities; half of them for sets of up to so many elements.
PARITY_WORDS, HALF_PARITIES = 16, 400


def parities(s: np.ndarray) -> np.ndarray:
    """For each of 1,024 (or 512) parts of the hashes whether the set has an odd number there: two sets that differ in d elements differ in at most d bits."""
    bits = 64 * PARITY_WORDS // (2 if len(s) <= HALF_PARITIES else 1)
    counts = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").view(np.int64)


def _differing(a: str, b: str) -> Column:
    """Bits in which two sets' parities differ; of different lengths, the halves of the longer one are added up first."""
    words = F.least(F.size(a), F.size(b))
    folded = [F.when(F.size(c) > words, F.zip_with(F.slice(c, F.lit(1), words), F.slice(c, words + 1, words), lambda x, y: x.bitwiseXOR(y)))
              .otherwise(F.col(c)) for c in (a, b)]
    return F.aggregate(F.zip_with(*folded, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def least_overlap(a, b, part: int, whole: int):
    """The least intersection of linked sets of sizes a and b: whole * i >= part * (a + b - i)."""
    return -(-part * (a + b) // (whole + part))


class Order:
    """Elements by the level of their cell, then by hash."""

    def __init__(self, levels: bytes):
        self.levels = np.frombuffer(levels, np.uint8)
        self.shift = np.uint64(64 - (len(levels).bit_length() - 1))

    def level(self, elements: np.ndarray) -> np.ndarray:
        return self.levels[elements >> self.shift]

    def first(self, elements: np.ndarray, n: int) -> np.ndarray:
        return elements[np.argsort(self.level(elements), kind="stable")[:n]]        # the elements come sorted


def _stored(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """row, doc_id, n (size of the set), key (digest of the set; null without words), blob and bits (the text and the set's
    parities; once per task and key)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen = zstandard.ZstdCompressor(level=1).compress, set()
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
                sizes, keys, blobs, bits = [], [], [], []
                texts = [lowered(t) for t in batch.column(2).to_pylist()]
                for text, s in zip(texts, shingle_sets(texts, shingle)):
                    key = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                    fresh = key is not None and key not in seen
                    if fresh:
                        if len(seen) >= KEYS_HELD:
                            seen.clear()
                        seen.add(key)
                    sizes.append(len(s))
                    keys.append(key)
                    blobs.append(pack(text) if fresh else None)
                    bits.append(parities(s) if fresh else None)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                                                  pa.array(keys, pa.binary()), pa.array(blobs, pa.binary()),
                                                  pa.array(bits, pa.list_(pa.int64()))],
                                                 names=["row", "doc_id", "n", "key", "blob", "bits"])

    schema = f"row long, doc_id {dict(rows.dtypes)['doc_id']}, n long, key binary, blob binary, bits array<long>"
    return written(rows.mapInArrow(store, schema), "jaccard-texts")


def _sets(blobs: list, shingle: int) -> Iterator[np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    for low in range(0, len(blobs), 512):
        yield from shingle_sets([unpack(blob) for blob in blobs[low: low + 512]], shingle)


def cell_counts(sets: Iterable[np.ndarray], log: int) -> np.ndarray:
    """Elements by their first ``log`` bits.  Counted in place: a task holds the table and one set."""
    total = np.zeros(1 << log, np.uint32)
    for s in sets:
        np.add.at(total, (s >> np.uint64(64 - log)).astype(np.int64), np.uint32(1))
    return total


def planes_of(counts: np.ndarray) -> bytes:
    """Counts (uint32) by planes, the eight low bits, then the other bytes: most counts are 0 or 1, so that this compresses well."""
    by_byte = counts.view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(by_byte[:, :1], axis=1).T, axis=1).tobytes() + by_byte[:, 1:].T.tobytes()


def counts_of(planes: bytes) -> np.ndarray:
    """The counts (a multiple of eight) that ``planes_of`` took."""
    raw = np.frombuffer(planes, np.uint8).reshape(4, -1)
    low = np.packbits(np.unpackbits(raw[0].reshape(8, -1), axis=1).T, axis=1)
    return np.ascontiguousarray(np.concatenate([low, raw[1:].T], axis=1)).view(np.uint32)[:, 0]


def _order(sets: DataFrame, elements: int, shingle: int) -> Order:
    """The order from the counts of all elements of all stored sets."""
    log = min(MOST_LOG, max(LEAST_LOG, (elements // PER_CELL).bit_length()))
    size = 1 << BLOCK_LOG

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = cell_counts((s for batch in batches for s in _sets(batch.column(0).to_pylist(), shingle)), log)
        pack = zstandard.ZstdCompressor(level=1).compress
        for at, part in enumerate(total.reshape(-1, size)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([pack(planes_of(part))], pa.binary())],
                                                 names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, total = zstandard.ZstdDecompressor().decompress, {}
        for batch in batches:
            for at, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[at] = total.get(at, 0) + counts_of(unpack(raw)).astype(np.uint64)
        levels = [_levels(t).tobytes() for t in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(levels, pa.binary())], names=["block", "levels"])

    counts = sets.select("blob").mapInArrow(count, "block int, counts binary")
    levels = np.zeros((1 << (log - BLOCK_LOG), size), np.uint8)
    for r in counts.repartition("block").mapInArrow(add, "block int, levels binary").collect():       # 2^24 bytes at most
        levels[r["block"]] = np.frombuffer(r["levels"], np.uint8)
    return Order(levels.tobytes())


def _levels(counts: np.ndarray) -> np.ndarray:
    above = EXACT + np.floor(4 * np.log2(np.maximum(counts, 1) / EXACT))
    return np.where(counts <= EXACT, counts, np.minimum(above, 255)).astype(np.uint8)


def _boundary(sets: DataFrame, order, shingle: int, part: int, whole: int) -> int:
    """The size up to which enumerating subsets costs least in all; sizes up to LIGHT_MOST are looked at."""
    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_, out = Order(order.value), {}
        for batch in batches:
            for s in _sets(batch.column(0).to_pylist(), shingle):
                n = len(s)
                p = n - -(-part * n // whole) + 1
                subsets, scan = out.get(n, (0, 0))
                met = int(order_.level(order_.first(s, p)).astype(np.int64).sum())
                out[n] = (subsets + (p + 1) * p // 2, scan + p + met)
        sizes = list(out)
        yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array([out[n][0] for n in sizes], pa.int64()),
                                          pa.array([out[n][1] for n in sizes], pa.int64())], names=["n", "subsets", "scan"])

    light = sets.where(F.col("n") <= LIGHT_MOST).select("blob").mapInArrow(cost, "n long, subsets long, scan long")
    costs = {r["n"]: (int(r["a"]), int(r["b"])) for r in light.groupBy("n").agg(F.sum("subsets").alias("a"), F.sum("scan").alias("b")).collect()}

    def total(b: int) -> int:
        return sum((s if n <= b else 0) + (c if n * whole >= part * (b + 1) else 0) for n, (s, c) in costs.items())
    return min(range(LIGHT_MOST + 1), key=total)


ENTRY = "h long, row long, n int, pos int"


def _entries(sets: DataFrame, order, boundary: int, shingle: int, part: int, whole: int) -> DataFrame:
    """(h, row, n, pos): elements in inverted lists, at their place in the set's order; subsets of two, at place -1."""
    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_ = Order(order.value)
        for batch in batches:
            keys, rows, sizes, places = [], [], [], []

            def add(row: int, n: int, h: np.ndarray, place: np.ndarray) -> None:
                keys.append(h)
                rows.append(np.full(len(h), row, np.int64))
                sizes.append(np.full(len(h), n, np.int32))
                places.append(place)

            for row, s in zip(batch.column(0).to_pylist(), _sets(batch.column(1).to_pylist(), shingle)):
                n = len(s)
                p = n - -(-part * n // whole) + 1
                if n <= boundary and n > 1:
                    f = order_.first(s, p + 1)
                    i, j = np.triu_indices(len(f), 1)
                    low, high = np.minimum(f[i], f[j]), np.maximum(f[i], f[j])
                    add(row, n, scramble(low * MULTIPLY + high), np.full(len(i), -1, np.int32))
                if n * whole >= part * (boundary + 1):
                    f = order_.first(s, p)
                    add(row, n, f, np.arange(len(f), dtype=np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(rows)),
                                                  pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))],
                                                 names=["h", "row", "n", "pos"])
    return sets.select("row", "blob").mapInArrow(enter, ENTRY)


def _pairs_of(rows: np.ndarray, starts: np.ndarray, k: int, boundary: int, part: int, whole: int) -> np.ndarray:
    """Pairs (u, v) that size and position allow within the lists of ``k`` rows (h, row, n, pos) that begin at ``starts``."""
    i, j = np.triu_indices(k, 1)
    a, b = rows[(starts[:, None] + i).ravel()], rows[(starts[:, None] + j).ravel()]
    need = least_overlap(a[:, 2], b[:, 2], part, whole)
    small, large = np.minimum(a[:, 2], b[:, 2]), np.maximum(a[:, 2], b[:, 2])
    ok = (small >= need) & (a[:, 2] - a[:, 3] >= need) & (b[:, 2] - b[:, 3] >= need) & ((a[:, 3] < 0) | (large > boundary))
    u, v = a[ok, 1], b[ok, 1]
    return np.stack([np.minimum(u, v), np.maximum(u, v)], 1)


def _may_link(a: str, b: str, boundary: int, part: int, whole: int) -> Column:
    """The same as a condition over the columns of two entries."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    need = -F.floor(-(part * (n + m)) / F.lit(whole + part))
    return ((F.least(n, m) >= need) & (n - F.col(f"{a}pos") >= need) & (m - F.col(f"{b}pos") >= need)
            & ((F.col(f"{a}pos") < 0) | (F.greatest(n, m) > boundary)))


def _linker(most: int, boundary: int, part: int, whole: int):
    """Over entries sorted by h: pairs (u, v) of the lists up to ``most`` long; of longer ones the entries (h, row, n, pos)."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None                       # rows (h, row, n, pos) of the list that the batch before ended in
        over = False

        def out(pairs: list, long: list) -> Iterator[pa.RecordBatch]:
            names, kinds = ["u", "v", "h", "row", "n", "pos"], [pa.int64()] * 4 + [pa.int32()] * 2
            for some, first in ((pairs, 0), (long, 2)):
                table = np.concatenate(some) if some else np.zeros((0, 0), np.int64)
                if len(table):
                    cols = [pa.array(table[:, c - first]).cast(t) if first <= c < first + table.shape[1] else pa.nulls(len(table), t)
                            for c, t in enumerate(kinds)]
                    yield pa.RecordBatch.from_arrays(cols, names=names)

        def close(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, pairs: list, long: list) -> None:
            """The lists that lie between starts and ends; those of one length together."""
            size = ends - starts
            for k in range(2, most + 1):
                some = starts[size == k]
                if len(some):
                    pairs.append(_pairs_of(rows, some, k, boundary, part, whole))
            long.extend(rows[a:b] for a, b in zip(starts[size > most].tolist(), ends[size > most].tolist()))

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(4)], 1)
            pairs, long = [], []
            if held is not None and len(held):
                if over and rows[0, 0] == held[0, 0]:        # of a long list, members go out as they come
                    same = np.searchsorted(rows[:, 0] != held[0, 0], True) if rows[-1, 0] != held[0, 0] else len(rows)
                    long.append(rows[:same])
                    rows = rows[same:]
                elif not over:
                    rows = np.concatenate([held, rows])
            if len(rows):
                over = False
                starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
                close(rows, starts[:-1], starts[1:], pairs, long)
                held = rows[starts[-1]:]
                if len(held) > most:
                    long.append(held)
                    held, over = held[:1], True
            yield from out(pairs, long)
        pairs, long = [], []
        if held is not None and not over:
            close(held, np.array([0]), np.array([len(held)]), pairs, long)
        yield from out(pairs, long)
    return link


def _of_ends(rows: DataFrame, pairs: DataFrame, ends: str = "uv") -> DataFrame:
    """The rows that occur in a pair, at one of ``ends``."""
    ends = union_all([pairs.select(F.col(end).alias("row")).distinct() for end in ends]).distinct()
    return rows.join(F.broadcast(ends) if ends.count() <= ENDS_SENT else ends, "row", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, shingle: int, part: int, whole: int) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough: whole * intersection >= part * union.

    Pairs whose parities differ in more bits than linked sets may differ in elements are left out before texts are joined.
    """
    pairs = written(pairs.distinct(), "jaccard-met")
    bits, heavy_of = _of_ends(sets.select("row", "n", "bits"), pairs), dict(zip("uv", heavy_keys(pairs, ["u"], ["v"])))
    for end in ("u", "v"):
        pairs = heavy_hitter_join(pairs, bits.withColumnsRenamed(
            {"row": end, "n": f"n_{end}", "bits": f"bits_{end}"}), [end], spread=["u", "v"], heavy=heavy_of[end])
    both_sizes = F.col("n_u") + F.col("n_v")
    need = -F.floor(-(part * both_sizes) / F.lit(whole + part))
    pairs = written(pairs.where(_differing("bits_u", "bits_v") <= both_sizes - 2 * need).select("u", "v"), "jaccard-pairs")
    texts = written(_of_ends(sets.select("row", "blob"), pairs), "jaccard-candidates")
    both = heavy_hitter_join(pairs, _of_ends(texts, pairs, "v").select(F.col("row").alias("v"), F.col("blob").alias("second")), ["v"], spread=["u"])
    both = heavy_hitter_join(both, _of_ends(texts, pairs, "u").select(F.col("row").alias("u"), F.col("blob").alias("first")), ["u"], spread=["v"],
                             heavy=heavy_hitters(pairs, ["u"]))

    whole_ = whole

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, unpack = {}, zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
                if len(held) > SETS_HELD:
                    held.clear()
                u, v = batch.column("u").to_pylist(), batch.column("v").to_pylist()
                new = {row: blob for rows, blobs in ((u, batch.column("first")), (v, batch.column("second")))
                       for row, blob in zip(rows, blobs) if row not in held}
                held |= zip(new, shingle_sets([unpack(blob.as_py()) for blob in new.values()], shingle))
                ok = np.zeros(len(u), bool)
                for i, (a, b) in enumerate(zip(map(held.get, u), map(held.get, v))):
                    inter = len(np.intersect1d(a, b, assume_unique=True))
                    ok[i] = whole_ * inter >= part * (len(a) + len(b) - inter)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(u, np.int64)[ok]), pa.array(np.array(v, np.int64)[ok])], names=["u", "v"])

    return written(both.select("u", "v", "first", "second").mapInArrow(verify, "u long, v long"), "jaccard-links")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (row, label) after further links (u, v) of rows."""
    at = links.join(labels.withColumnsRenamed({"row": "u", "label": "a"}), "u").join(labels.withColumnsRenamed({"row": "v", "label": "b"}), "v")
    roots = connected_components(at.select(F.col("a").alias("u"), F.col("b").alias("v")))
    moved = heavy_hitter_join(labels, roots.withColumnRenamed("node", "label"), ["label"], "left", spread=["row"])
    return written(moved.select("row", F.coalesce("root", "label").alias("label")), "jaccard-labels")


def _long_lists(long: DataFrame, small: DataFrame, labels: DataFrame, sets: DataFrame, boundary: int, shingle: int, part: int, whole: int,
                first: int = 8, growth: int = 32) -> DataFrame:
    """Links of the long lists' pairs: in rounds, a growing share of members as pivots.  The first round verifies the
    pairs ``small`` of the short lists too.  Between rounds the components found become the labels."""
    every = []
    length = long.groupBy("h").count().agg(F.max("count")).first()[0]
    share, done = first / length, 0.0
    draw = (F.pmod(F.xxhash64("row"), F.lit(1 << 40)) / F.lit(float(1 << 40)))
    while done < 1:
        at = long.join(labels, "row").withColumn("draw", draw)
        kinds = at.groupBy("h", "label").count().groupBy("h").agg(F.max_by("label", "count").alias("main"), F.count("*").alias("kinds"))
        live = heavy_hitter_join(at, kinds.where("kinds > 1").select("h", "main"), ["h"], spread=["row"])
        live = written(live.where(F.col("draw") >= done).withColumn("other", F.col("label") != F.col("main")).drop("main"), "jaccard-lists")
        if done and live.isEmpty():
            break
        pivots = live.where(F.col("draw") < share).select("h", *[F.col(c).alias(f"p_{c}") for c in ("row", "n", "pos", "label", "draw", "other")])
        # members of the list's main component meet only pivots outside it
        met = union_all([heavy_hitter_join(live, pivots.where("p_other"), ["h"], spread=["row"]),
                         heavy_hitter_join(live.where("other"), pivots.where("not p_other"), ["h"], spread=["row"])])
        met = met.where((F.col("label") != F.col("p_label")) & ((F.col("draw") > F.col("p_draw")) | (F.col("draw") >= share))
                        & _may_link("", "p_", boundary, part, whole))
        pairs = met.select(F.least("row", "p_row").alias("u"), F.greatest("row", "p_row").alias("v"))
        pairs = pairs if done else pairs.unionByName(small)
        every.append(_verified(pairs, sets, shingle, part, whole))
        done, share = share, share * growth
        if done < 1:
            labels = _relabelled(labels, every[-1])
    return union_all(every)


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: tuple[int, int] = (80, 100),
                 most: int = 16) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, n, key) of every text, and (key, label) of every distinct set: sets of one label are connected by links.

    ``similarity``: part and whole; sets link when whole * intersection >= part * union.
    """
    part, whole = similarity
    if not whole < 2 * part <= 2 * whole:
        raise ValueError("similarity must be over a half and at most 1")
    spark = docs.sparkSession
    stored = _stored(docs, id_col, text_col, shingle)
    sets = stored.where("blob is not null")
    reps = sets.groupBy("key").agg(F.min("row").alias("label"))
    labels = written(heavy_hitter_join(sets.select("row", "key"), reps, ["key"], spread=["row"]).select("row", "label"), "jaccard-labels")
    elements = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if elements:
        order = spark.sparkContext.broadcast(_order(sets, elements, shingle).levels.tobytes())
        boundary = _boundary(sets, order, shingle, part, whole)
        entries = _entries(sets, order, boundary, shingle, part, whole).repartition("h").sortWithinPartitions("h")
        found = written(entries.mapInArrow(_linker(most, boundary, part, whole), "u long, v long, h long, row long, n int, pos int"),
                        "jaccard-found")
        small, long = found.where("u is not null").select("u", "v"), found.where("h is not null").select("h", "row", "n", "pos")
        links = (_verified(small, sets, shingle, part, whole) if long.isEmpty()
                 else _long_lists(long, small, labels, sets, boundary, shingle, part, whole))
        labels = _relabelled(labels, links)
    of_key = sets.select("row", "key").join(labels, "row").groupBy("key").agg(F.min("label").alias("label"))
    return stored.select("row", "doc_id", "n", "key"), written(of_key, "jaccard-components")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                       similarity: tuple[int, int] = (80, 100), most: int = 16) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself included)."""
    rows, sets = similar_sets(docs, id_col, text_col, shingle, similarity, most)
    of_key = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least")).join(sets, "key")
    of_label = of_key.groupBy("label").agg(F.min("least").alias("component_id"))
    component = heavy_hitter_join(of_key.select("key", "label"), of_label, ["label"], spread=["key"]).select("key", "component_id")
    out = heavy_hitter_join(rows, component, ["key"], "left", spread=["row"])
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
