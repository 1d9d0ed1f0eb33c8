"""Operator 6: best-fit packing by minimum bin slack.

Each document becomes its token ids and one end id.  One longer than a sequence is cut into full sequences after a
first piece with what is left over; every other document is one piece.

The bins are planned from the histogram of the pieces' lengths (at most ``size`` numbers, whatever the data).  For each
bin, the longest length left is put in, and a subset-sum dynamic programme over the available lengths (the sums
that can be reached are the bits of one integer) finds the fullest combination around it.  The
combination is removed as often as the counts allow.  Then pieces get their places from their rank among the pieces of
their length; ranks come from counts per partition, so no task sees all pieces of a length.

Defined results: null text counts as empty (its one token is the end id); repeated rows are packed each; an empty
table gives no rows; ties go to combinations with the longer lengths; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from saleslake.llm.common import per_process, text_of, written

END_ID = 2
#: Words whose ids a Python worker remembers; rarer ones are encoded again with each group of texts.
WORDS_HELD = 300_000
#: Texts that are encoded together.
TEXTS = 256


#: A space between other white space, where the tokenizer's cuts depend on what stands around.
CROWDED = re.compile(r"  |\s \s| $")
#: What every crowded text has, and which is quick to look for.
MAYBE_CROWDED = re.compile(r" (?:\s|$)")


class WordTokenizer:
    """The ids that ``tokenizers`` gives with the file at ``path``, as little-endian 32-bit numbers, word by word.

    A byte-level tokenizer that cuts by the usual pattern never joins what stands before a single space with that space
    and what follows, so a text's ids are those of its parts cut there, and common parts are encoded once.  New
    parts are encoded by ``tiktoken`` from the same file's vocabulary, which is some times faster; should the two
    disagree on a probe (another kind of file), ``tokenizers`` encodes all.
    """

    PROBE = "It's a test, isn't it?  Ünïcödé 123 words\n\n and\tmore \u4f60\u597d we'll see -- (end) "

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark deals out the work
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.held: dict[str, bytes] = {}                    # word -> ids of a space and the word
        shown = {c: b for b, c in byte_characters().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        raw = {bytes(shown[c] for c in t): i for t, i in vocabulary.items() if all(c in shown for c in t) and t not in self.special}
        self.fast = None
        if sorted(raw.values()) == list(range(len(raw))) and len(raw) >= 256:
            fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=raw, special_tokens={})
            if fast.encode_ordinary(self.PROBE) == self.tokenizer.encode(self.PROBE, add_special_tokens=False).ids:
                self.fast = fast
                self.spaced = np.zeros(len(raw), bool)
                self.spaced[[i for t, i in raw.items() if t[:1] == b" "]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> dict[str, bytes]:
        """The ids of a space and the word."""
        out: dict[str, bytes] = {}
        plain = [w for w in words if w and not w[0].isspace() and not w[-1].isspace()] if self.fast else []
        if plain:                                           # one call: a token that begins with a space begins a word
            ids = np.array(self.fast.encode_ordinary(" " + " ".join(plain)), "<u4")
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) == len(plain):
                raw, ends = ids.tobytes(), [*(4 * starts[1:]).tolist(), 4 * len(ids)]
                out = {w: raw[a:b] for w, a, b in zip(plain, (4 * starts).tolist(), ends)}
        rest = [w for w in words if w not in out]
        return out | dict(zip(rest, self._ids([" " + w for w in rest])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text.  Crowded texts and those that hold a special token are encoded whole."""
        whole = [i for i, t in enumerate(texts) if MAYBE_CROWDED.search(t) and CROWDED.search(t) or any(s in t for s in self.special)]
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[i] = ids
        apart = set(whole)
        words = {i: t.split(" ") for i, t in enumerate(texts) if i not in apart}
        firsts = self._ids([w.pop(0) for w in words.values()])      # no space before it
        new = list(set().union(*words.values()).difference(self.held))
        self.held |= self._word_ids(new)
        for first, (i, w) in zip(firsts, words.items()):
            out[i] = first + b"".join(map(self.held.__getitem__, w))
        for w in new[: max(0, len(self.held) - WORDS_HELD)]:
            del self.held[w]
        return out


def byte_characters() -> dict[int, str]:
    """The character by which a byte-level vocabulary shows each byte: printable Latin-1 as it is, the others in
    order from U+0100."""
    as_is = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(as_is)]
    return {b: chr(b) for b in as_is} | {b: chr(0x100 + n) for n, b in enumerate(others)}


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones at the end, what is left over first."""
    first = n % size or size
    return [(0, min(first, n)), *((at, size) for at in range(first, n, size))]


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, longest preferred, of the combination of available pieces with the largest sum up to ``room``."""
    reach, steps = 1, []                                     # bit s: some pieces so far sum to s
    mask = (1 << (room + 1)) - 1
    for length in sorted(k for k in counts if k <= room):
        left, part = min(counts[length], room // length), 1
        while left:                                          # 1, 2, 4 ... copies reach every number of copies
            take = min(part, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left, part = left - take, part * 2
    total, out = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> total & 1 or (total >= length * take and before >> total - length * take & 1):
            out += [length] * take
            total -= length * take
    return out


def plan_bins(histogram: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """(lengths of one bin, number of such bins), every piece of the histogram in one bin."""
    left, bins = {k: n for k, n in histogram.items() if n}, []
    while left:
        lead = max(left)
        left[lead] -= 1
        lengths = [lead, *fullest({k: n for k, n in left.items() if n}, size - lead)]
        left[lead] += 1
        need = {k: lengths.count(k) for k in lengths}
        times = min(left[k] // n for k, n in need.items())
        for k, n in need.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        bins.append((lengths, times))
    return bins


def placements(bins: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each length rows (first rank, first bin, offset in the bin) in order of rank."""
    used: dict[int, int] = {}
    out: dict[int, list] = {}
    first = 0
    for lengths, times in bins:
        offset = 0
        for k in lengths:
            out.setdefault(k, []).append((used.get(k, 0), first, offset))
            used[k], offset = used.get(k, 0) + times, offset + k
        first += times
    return {k: np.array(rows, np.int64) for k, rows in out.items()}


PIECES = "piece int, start long, length long, ids binary, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024) -> DataFrame:
    """doc_id and PIECES: ids are little-endian 32-bit numbers, part is the task that made the piece, nth its number
    among that task's pieces of its length."""
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.spark_partition_id().alias("part"),
                        text_of(text_col).alias("text"))
    end = np.array([END_ID], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_process(f"tokenizer {tokenizer}", lambda: WordTokenizer(tokenizer))
        made = np.zeros(size + 1, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, TEXTS):
                some, rows = batch.slice(low, TEXTS), []
                for n, ids in enumerate(words.encode(some.column(2).to_pylist())):
                    ids += end
                    for i, (at, length) in enumerate(cut(len(ids) // 4, size)):
                        own = ids[4 * at: 4 * (at + length)]
                        rows.append((n, i, at, length, own, zlib.crc32(own), made[length]))
                        made[length] += 1
                of, piece, start, length, ids, crc, nth = zip(*rows)
                of = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(of), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(crc, pa.int64()),
                     some.column(1).take(of), pa.array(nth, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "part", "nth"])
    return texts.mapInArrow(encode, f"doc_id {dict(texts.dtypes)['doc_id']}, {PIECES}")


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset: every piece, its ids and its place.

    The ids lie in a table in the shared folder and are read from it only where a query selects them.
    """
    cuts = written(pieces(docs, tokenizer, id_col, text_col, size), "pack-pieces")
    full, rest = cuts.where(F.col("length") == size), cuts.where(F.col("length") < size)
    counts = written(rest.groupBy("length", "part").agg(F.count("*").alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    bins = plan_bins(histogram, size)
    places = placements(bins)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(rank), 2), np.int64)
        length, rank = length.to_numpy(), rank.to_numpy()
        for k in np.unique(length):
            of, rows = length == k, places[int(k)]
            at = np.searchsorted(rows[:, 0], rank[of], side="right") - 1
            out[of, 0], out[of, 1] = rows[at, 1] + rank[of] - rows[at, 0], rows[at, 2]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    own = ["doc_id", "piece", "start", "length", "ids", "ids_crc32"]
    placed = (rest.join(before, ["length", "part"])
              .select(*own, place("length", F.col("before") + F.col("nth")).alias("at")).select(*own, "at.*"))
    alone = full.select(*own, (F.lit(sum(n for _, n in bins)) + F.monotonically_increasing_id()).alias("sequence_id"),
                        F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(alone)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves, each at most one sequence's ids long."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"))
