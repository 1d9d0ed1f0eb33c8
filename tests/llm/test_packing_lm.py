"""Operators 6 and 10."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from saleslake.llm import lm, packing

DOCS = "doc_id long, text string"
PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
WORDS = packing.WordTokenizer(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é1.'\n\t  你<|endoftext|>"), max_size=12) | st.just("<|endoftext|>") | st.text(max_size=8), max_size=8))
def test_word_tokenizer_equals_tokenizers(parts):
    texts = [" ".join(parts), "".join(parts), *parts]
    got = [np.frombuffer(b, "<u4").tolist() for b in WORDS.encode(texts)]
    assert got == [e.ids for e in PLAIN.encode_batch(texts, add_special_tokens=False)]


def best_sum(counts, room):
    sums = {0}
    for k, n in counts.items():
        for _ in range(n):
            sums |= {s + k for s in sums if s + k <= room}
    return max(sums)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=7), st.integers(0, 40))
def test_fullest_is_the_best_subset_sum(counts, room):
    got = packing.fullest(counts, room)
    assert sum(got) == best_sum(counts, room) and not Counter(got) - Counter(counts)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 50), max_size=12))
def test_plan_places_every_piece_once(histogram):
    bins = packing.plan_bins(histogram, 64)
    used = Counter()
    for lengths, times in bins:
        assert sum(lengths) <= 64
        for k in lengths:
            used[k] += times
    assert used == Counter(histogram)


def best_fit_decreasing(lengths, size):
    free = []
    for k in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= k]
        if fits:
            free.remove(min(fits))
        free.append((min(fits) if fits else size) - k)
    return len(free)


def test_pack_is_whole_and_tight(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta,", "9"]) for _ in range(rng.choice([1, 5, 40, 90, 400])))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "x  y \n z "), (503, "word " * 9000), (5, rows[5][1]), (None, "null id")]
    df = spark.createDataFrame([(i, t, 1, "l") for i, t in rows], DOCS + ", part int, length string").repartition(5)
    got = packing.pack(df, PATH, 64).collect()
    expected = Counter()
    for i, t in rows:
        ids = PLAIN.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids), 64), len(ids)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            raw = np.array(ids[a:b], "<u4").tobytes()
            expected[i, n, a, b - a, raw, zlib.crc32(raw)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids), r.ids_crc32) for r in got) == expected
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    tokens = sum(r.length for r in got)
    assert len(places) <= 1.02 * best_fit_decreasing([r.length for r in got], 64) + 1
    whole = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(packing.pack(df, PATH, 64)).collect()}
    assert sum(whole.values()) == tokens and max(whole.values()) <= 64


def test_pack_empty(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).collect() == []


def lm_rows():
    rng = random.Random(8)
    words = [f"w{min(int(rng.paretovariate(0.7)), 500)}" for _ in range(4000)]
    rows = [(i, " ".join(words[i * 20: i * 20 + rng.randint(0, 40)]).upper() if i % 2 else " \t".join(words[i * 20: i * 20 + 20])) for i in range(150)]
    return rows + [(900, None), (901, ""), (None, "w1 w2"), (3, rows[3][1]), (902, "w1 unseenword " * 8000)]


def test_lm_scores_match_brute_force(spark):
    rows = lm_rows()
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], DOCS + ", score double").repartition(4)
    tok = lambda t: (t or "").encode().lower().split() + [b"\n"]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts, pairs = Counter(), Counter()
    for i, t in rows:
        if not out(i):
            counts.update(tok(t))
            pairs.update(zip([b"\n", *tok(t)], tok(t)))
    size = sum(counts.values()) + len(counts) + 1
    about = lambda n: n if n < 2 else 0.75 * 2 ** (1 + int(math.log2(n)))
    expected = Counter()
    for i, t in rows:
        words, score = tok(t), 0.0
        for v, w in zip([b"\n", *words], words):
            pair = min(about(pairs[v, w]), about(counts[v]), about(counts[w]))
            score += math.log10((pair + 1000 * (about(counts[w]) + 1) / size) / (about(counts[v]) + 1000))
        base = sum(math.log10((counts[w] + 1) / size) for w in words)
        expected[i, out(i), len(words), sum(counts[w] > 0 for w in words), round(base, 4), round(score, 1)] += 1
    for heavy, block in ((200_000, lm.BLOCK_BITS), (20, 1 << 18), (0, 1 << lm.SEG_LOG)):         # one block, two, four
        got = lm.score_texts(df, heavy_words=heavy, block_bits=block).collect()
        assert {r.train_tokens for r in got} == {sum(counts.values())}
        # the filter has no false hit at this size, so that the scores are those of the quantised counts
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 4), round(r.score, 1)) for r in got) == expected


def test_lm_scores_of_very_frequent_words_are_finite(spark):
    """Over 2^15 occurrences: the level is 16 or more."""
    rows = [(i, "the of " * 20_000 + f"w{i % 3}") for i in range(8)]
    got = lm.score_texts(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 8 and all(math.isfinite(r.score) and r.base_score < r.score < 0 for r in got)
    assert lm.count_of(np.arange(40, dtype=np.uint8))[-1] == 0.75 * 2.0 ** 39


def test_lm_empty_table_and_no_training_rows(spark):
    assert lm.score_texts(spark.createDataFrame([], DOCS)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.score_texts(spark.createDataFrame([(held, "a b")], DOCS)).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def _bits(grams, level, log):
    bits = np.zeros((1 << log, 1 << lm.SEG_LOG), bool)
    for j in range(1, int(level.max()) + 1):
        some = grams[level >= j]
        for at in lm.LogBloom.places(some, np.full(len(some), j)):
            bits[(some >> np.uint64(64 - log)).astype(int), at.astype(int)] = True
    return np.packbits(bits.ravel(), bitorder="little")


def test_bloom_levels_are_never_too_low():
    grams, level = lm.scramble(np.arange(1, 100_001, dtype=np.uint64)), np.arange(100_000) % 9 + 1
    found = lm.LogBloom(_bits(grams, level, 5), 5, 0, 9).levels(grams)
    assert (found >= level).all() and (found == level).mean() > 0.95


def test_a_full_filter_ends():
    grams = lm.scramble(np.arange(1, 1001, dtype=np.uint64))
    full = lm.LogBloom(np.full(4 << lm.SEG_LOG >> 3, 255, np.uint8), 2, 0, 12)
    assert (full.levels(grams) == 12).all()


@pytest.mark.parametrize("entries", [40_000, 400_000])
def test_false_hits_do_not_grow_with_the_corpus(entries):
    """Unseen n-grams that seem known: the filter has the same bits per entry at both sizes."""
    log = max(2, (lm.BITS_PER_ENTRY * entries - 1).bit_length() - lm.SEG_LOG)
    grams = lm.scramble(np.arange(1, entries + 1, dtype=np.uint64))
    bloom = lm.LogBloom(_bits(grams, np.ones(entries), log), log, 0, 9)
    unseen = lm.scramble(np.arange(1 << 40, (1 << 40) + 50_000, dtype=np.uint64))
    assert (bloom.levels(unseen) > 0).mean() < 0.04
