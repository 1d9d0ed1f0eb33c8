"""Operator 10: language-model scoring from a log-frequency Bloom filter.

Tokens are a text's words (A-Z lower-cased) and one end.  Word and word-pair counts of all training rows are quantised
to q = 1 + floor(log2 count), and (n-gram, 1) .. (n-gram, q) are entered in a Bloom filter.  Scoring probes
(n-gram, 1), (n-gram, 2) ... until the first miss, at most up to the largest level that was entered; the last hit gives
the count back within a factor of two, and pairs are smoothed towards single words by a Dirichlet prior of weight ``mu``.
The filter is made in segments of 2^17 bits: an n-gram's bits all lie in the segment its hash names, so the task that
counts a segment's n-grams makes that segment whole.  The number of segments follows the number of entries (8 to 16 bits
each), so the false-hit rate does not grow with the corpus.  Segments are broadcast in blocks of at most ``block_bits``, and
each block is probed in one pass over the texts that notes the levels found; one block needs no notes.

The base score needs exact counts.  The most frequent words, at most ``heavy_words`` of them, are broadcast;
the occurrences of all others are joined with the table of counts.

Defined results: null text counts as empty; an empty text is one end token; a null id is never held out; repeated rows are
counted and scored each; very long texts are read whole; an empty table gives no rows, and without training rows all counts are zero; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import WordHashes, crc_mod, text_of, written

FOLDS, HELD_OUT = 7, 2
HEAVY_WORDS = 200_000
#: Bits of the filter that are broadcast at once.
BLOCK_BITS = 1 << 29
#: Least bits of the filter for each entry (n-gram, level).
BITS_PER_ENTRY = 8
PROBES = 3
SEG_LOG = 17
#: Rows that are scored together; tokens that are counted together.
ROWS = 512
TOKENS = 2_000_000
#: No word holds a line feed.
END = xxhash.xxh3_64_intdigest(b"\n")
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def token_hashes(texts, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, one after the other, and the number of each text's tokens."""
    out, sizes = [], []
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        out.extend(map(hashes.__getitem__, words))
        out.append(END)
        sizes.append(len(words) + 1)
    return np.array(out, np.uint64), np.array(sizes, np.int64)


def before(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The token before each; before a text's first stands an end."""
    prev = np.concatenate(([np.uint64(END)], tokens[:-1]))
    prev[np.concatenate(([0], np.cumsum(sizes)[:-1]))] = END
    return prev


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def pair_hashes(prev: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return scramble(prev * MIX_PAIR + tokens)


def level_of(count: np.ndarray) -> np.ndarray:
    return np.frexp(count.astype(np.float64))[1]             # 1 + floor(log2 count)


#: The middle of the counts that share a level; 0 for level 0, 1 for level 1.  Doubles: numpy's powers of the bytes that
#: levels come as are half floats, infinite from level 16 on.
MIDDLES = np.concatenate(([0.0, 1.0], 0.75 * np.exp2(np.arange(2.0, 256.0))))


def count_of(level: np.ndarray) -> np.ndarray:
    return MIDDLES[level]


class LogBloom:
    """Some consecutive segments of the filter as bytes; there are 2 ** log segments in all, ``first`` is the number of the first."""

    def __init__(self, bits, log: int, first: int, top: int):
        self.bits, self.log, self.top = bits, log, top
        self.first, self.size = first, len(bits) >> (SEG_LOG - 3)

    @staticmethod
    def places(grams: np.ndarray, level: np.ndarray) -> Iterator[np.ndarray]:
        """Bit numbers within the segment, one array per probe."""
        g = scramble(grams + level.astype(np.uint64) * MIX_PAIR)
        low = np.uint64((1 << SEG_LOG) - 1)
        step = (g >> np.uint64(32)) | np.uint64(1)
        for i in range(PROBES):
            yield (g + np.uint64(i) * step) & low

    def has(self, grams: np.ndarray, level: int, start: np.ndarray) -> np.ndarray:
        """Which n-grams are entered with ``level``; ``start``: the first bit of each one's segment.  A probe goes on with the hits of the one before."""
        g = scramble(grams + np.uint64(level * int(MIX_PAIR) & (1 << 64) - 1))
        low, left = np.uint64((1 << SEG_LOG) - 1), np.arange(len(grams))
        for i in range(PROBES):
            of = g[left]
            at = ((of + np.uint64(i) * ((of >> np.uint64(32)) | np.uint64(1))) & low) + start[left]
            left = left[(self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        return left

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The largest level up to which every probe hits, at most ``top``; 0 for n-grams of other segments."""
        out = np.zeros(len(grams), np.uint8)
        segment = (grams >> np.uint64(64 - self.log)).astype(np.int64) - self.first
        left = np.flatnonzero((segment >= 0) & (segment < self.size))
        grams, start = grams[left], segment[left].astype(np.uint64) << np.uint64(SEG_LOG)
        for level in range(1, self.top + 1):
            hit = self.has(grams, level, start)
            if not len(hit):
                break
            left, grams, start = left[hit], grams[hit], start[hit]
            out[left] = level
        return out


def _counted(train: DataFrame, grams_of) -> DataFrame:
    """(h, c) of the n-grams that ``grams_of`` makes of tokens, counted over some TOKENS at a time; to be summed."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, n = WordHashes(), [], 0

        def counts() -> pa.RecordBatch:
            of, h = pd.factorize(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.bincount(of), pa.int64())], names=["h", "c"])

        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                held.append(grams_of(*token_hashes(batch.column(0).slice(low, ROWS).to_pylist(), hashes)))
                n += len(held[-1])
                if n > TOKENS:
                    yield counts()
                    held, n = [], 0
        if held:
            yield counts()
    return train.mapInArrow(count, "h long, c long")


def _segments(counts: DataFrame, log: int) -> DataFrame:
    """counts: h, c, partitioned so that each segment's n-grams are together.  seg, bits."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, segs = np.full(1 << log, -1, np.int64), []      # where a segment's bits are held
        made = np.zeros((0, 1 << SEG_LOG), bool)
        for batch in batches:
            grams = batch.column(0).to_numpy().view(np.uint64)
            top = level_of(batch.column(1).to_numpy())
            seg = (grams >> np.uint64(64 - log)).astype(np.int64)
            new = np.unique(seg[row[seg] < 0])
            row[new] = np.arange(len(segs), len(segs) + len(new))
            segs += new.tolist()
            if len(segs) > len(made):
                made = np.concatenate((made, np.zeros((max(len(segs) // 4, len(segs) - len(made)), 1 << SEG_LOG), bool)))
            flat, start = made.reshape(-1), row[seg] << SEG_LOG
            for level in range(1, int(top.max(initial=0)) + 1):
                has = top >= level
                first = start[has]
                for at in LogBloom.places(grams[has], np.full(len(first), level)):
                    flat[at.astype(np.int64) + first] = True
        for s in sorted(segs):
            bits = np.packbits(made[row[s]], bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([bits], pa.binary())], names=["seg", "bits"])
    return counts.mapInArrow(fill, "seg long, bits binary")


class Model:
    """What the scoring tasks need beside the filter: the frequent words' exact counts, the smoothing."""

    def __init__(self, heavy: np.ndarray, heavy_counts: np.ndarray, tokens: int, words: int, mu: float):
        self.heavy, self.heavy_counts = heavy, heavy_counts
        self.tokens, self.words, self.mu = tokens, words, mu

    @staticmethod
    def probe(bloom: LogBloom, tokens: np.ndarray, sizes: np.ndarray, of: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The levels of all tokens and of all pairs as far as they lie in the block; ``of``, ``kinds``: the tokens, factorized."""
        return bloom.levels(scramble(kinds))[of], bloom.levels(pair_hashes(before(tokens, sizes), tokens))

    def score(self, tokens: np.ndarray, sizes: np.ndarray, of: np.ndarray, kinds: np.ndarray, single: np.ndarray, pair: np.ndarray) -> Iterator[tuple]:
        """For each text: tokens, frequent tokens, their sum of log10(count + 1), model's log10 probability, other tokens."""
        ends = np.cumsum(sizes)
        starts = np.concatenate(([0], ends[:-1]))
        at = np.minimum(np.searchsorted(self.heavy, kinds), max(0, len(self.heavy) - 1))
        is_heavy = self.heavy[at] == kinds if len(self.heavy) else np.zeros(len(kinds), bool)
        log_count = np.zeros(len(kinds))
        log_count[is_heavy] = np.log10(self.heavy_counts[at[is_heavy]] + 1.0)
        about = count_of(single)
        alone = (about + 1) / (self.tokens + self.words + 1)
        prev_about = np.concatenate(([0.0], about[:-1]))
        prev_about[starts] = about[ends - 1]                 # before a text's first token stands an end, as at its own end
        pair_about = np.minimum(count_of(pair), np.minimum(prev_about, about))
        log_p = np.log10((pair_about + self.mu * alone) / (prev_about + self.mu))
        heavy_of = is_heavy[of]
        sums = [np.add.reduceat(x, starts) for x in (heavy_of.astype(np.int64), log_count[of], log_p)]
        rest = np.split(tokens.view(np.int64), starts[1:])
        for n, known, base, score, own, frequent in zip(sizes.tolist(), *(s.tolist() for s in sums), rest, np.split(heavy_of, starts[1:])):
            yield n, known, base, score, own[~frequent]


def train(docs: DataFrame, heavy_words: int, mu: float) -> tuple[Model, DataFrame, DataFrame, int, int]:
    """The model, the table of rare words' counts (h, c), the table of filter segments (seg, bits), the logarithm of the
    number of segments and the largest level.  docs: text only, the training rows."""
    counts = written(_counted(docs, lambda tokens, sizes: tokens).groupBy("h").agg(F.sum("c").alias("c")), "lm-words")
    tokens, words, largest = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.max("c"), F.lit(0))).first()
    # counts in eighths of a power of two: a table of a few hundred rows whatever the corpus
    eighth = F.floor(8 * F.log2("c"))
    by_size = sorted(((r["e"], r["n"]) for r in counts.groupBy(eighth.alias("e")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, None
    for e, n in by_size:
        total += n
        if total > heavy_words:
            break
        least = e
    frequent = counts.where(eighth >= least).collect() if least is not None else []
    heavy = np.array([r["h"] for r in frequent], np.int64).view(np.uint64)
    order = np.argsort(heavy)
    heavy_counts = np.array([r["c"] for r in frequent], np.int64)[order]
    rare = counts.where(eighth < least) if least is not None else counts
    grams = _counted(docs, lambda tokens, sizes: pair_hashes(before(tokens, sizes), tokens))
    singles = counts.mapInArrow(_scrambled, "h long, c long")
    both = written(grams.unionByName(singles).groupBy("h").agg(F.sum("c").alias("c")), "lm-grams")
    entries = both.agg(F.coalesce(F.sum(F.floor(F.log2("c")) + 1), F.lit(0))).first()[0]
    log = max(2, (BITS_PER_ENTRY * entries - 1).bit_length() - SEG_LOG)
    by_segment = both.repartition(F.shiftrightunsigned("h", 64 - log))
    segments = written(_segments(by_segment, log), "lm-filter")
    return Model(heavy[order], heavy_counts, tokens, words, mu), rare, segments, log, largest.bit_length()


def _scrambled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = scramble(batch.column(0).to_numpy().view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h), batch.column(1)], names=["h", "c"])


def _block(segments: DataFrame, log: int, first: int, size: int) -> bytes:
    """The bits of ``size`` segments from ``first`` on, by one job; a segment without entries has no row."""
    bits = np.zeros((size, 1 << SEG_LOG >> 3), np.uint8)
    for r in segments.where((F.col("seg") >= first) & (F.col("seg") < first + size)).collect():
        bits[r["seg"] - first] = np.frombuffer(r["bits"], np.uint8)
    return bits.tobytes()


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT,
                heavy_words: int = HEAVY_WORDS, block_bits: int = BLOCK_BITS, mu: float = 1000.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    spark = docs.sparkSession
    out = crc_mod(id_col, folds) == held_out
    model, rare, segments, log, top = train(docs.where(~out).select(text_of(text_col).alias("text")), heavy_words, mu)
    none = F.lit(None).cast("binary")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                       out.alias("held_out"), text_of(text_col).alias("text"), none.alias("single"), none.alias("pair"))
    shared = spark.sparkContext.broadcast(vars(model))
    size = min(1 << log, max(1, block_bits >> SEG_LOG))
    kind = dict(rows.dtypes)["doc_id"]

    def probed(some: pa.RecordBatch, hashes: WordHashes, bloom: LogBloom) -> tuple:
        """Tokens, sizes, the tokens factorized and the levels found in this block or noted from those before."""
        tokens, sizes = token_hashes(some.column(3).to_pylist(), hashes)
        of, kinds = pd.factorize(tokens)
        levels = Model.probe(bloom, tokens, sizes, of, kinds)
        for found, notes in zip(levels, (some.column(4), some.column(5))):
            if notes.null_count == 0 and len(notes):
                found += np.frombuffer(b"".join(notes.to_pylist()), np.uint8)
        return tokens, sizes, of, kinds, *levels

    for first in range(0, 1 << log, size):
        block, last = spark.sparkContext.broadcast(_block(segments, log, first, size)), first + size >= 1 << log

        def note(batches: Iterator[pa.RecordBatch], block=block, first=first) -> Iterator[pa.RecordBatch]:
            hashes, bloom = WordHashes(), LogBloom(np.frombuffer(block.value, np.uint8), log, first, top)
            for batch in batches:
                for some in (batch.slice(low, ROWS) for low in range(0, batch.num_rows, ROWS)):
                    _, sizes, _, _, *levels = probed(some, hashes, bloom)
                    cuts = np.cumsum(sizes)[:-1]
                    notes = [pa.array([x.tobytes() for x in np.split(found, cuts)], pa.binary()) for found in levels]
                    yield pa.RecordBatch.from_arrays([*some.columns[:4], *notes], names=some.schema.names)

        def score(batches: Iterator[pa.RecordBatch], block=block, first=first) -> Iterator[pa.RecordBatch]:
            hashes, model = WordHashes(), Model(**shared.value)
            bloom = LogBloom(np.frombuffer(block.value, np.uint8), log, first, top)
            for batch in batches:
                for some in (batch.slice(low, ROWS) for low in range(0, batch.num_rows, ROWS)):
                    n, known, base, score, rest = zip(*model.score(*probed(some, hashes, bloom)))
                    yield pa.RecordBatch.from_arrays(
                        [*some.columns[:3], pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                         pa.array(score, pa.float64()), pa.array(rest, pa.list_(pa.int64()))],
                        names=["row", "doc_id", "held_out", "n_tokens", "frequent", "base", "score", "rest"])

        if not last:
            rows = written(rows.mapInArrow(note, f"row long, doc_id {kind}, held_out boolean, text string, single binary, pair binary"),
                           "lm-levels")
    scored = written(rows.mapInArrow(score, f"row long, doc_id {kind}, held_out boolean, n_tokens long, "
                                            "frequent long, base double, score double, rest array<long>"), "lm-scored")
    others = (scored.select("row", F.explode("rest").alias("h")).join(rare, "h").groupBy("row")
              .agg(F.count("*").alias("others"), F.sum(F.log10(F.col("c") + 1.0)).alias("more")))
    size = float(np.log10(model.tokens + model.words + 1))
    return scored.drop("rest").join(others, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("frequent") + F.coalesce("others", F.lit(0))).alias("n_known"),
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * size).alias("base_score"), "score")
