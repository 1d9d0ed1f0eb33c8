"""N-gram Jaccard join against brute force over all pairs of exact shingle sets."""

import random
import re
import tracemalloc

import numpy as np
import pytest
import zstandard

from saleslake.llm import jaccard_join
from saleslake.llm.jaccard_join import jaccard_components, least_overlap

SPACE = r"[\x20\x09-\x0D]+"


def _set(text, n=5):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w for w in re.split(SPACE, low) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def brute(rows):
    sets = [_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            inter = len(a & sets[j])
            if a and sets[j] and 100 * inter >= 80 * (len(a) + len(sets[j]) - inter):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), d) if x is not None]
        least[find(i)] = min(ids) if ids else None
    return sorted(((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(spark, rows, **kw):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, label string")
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(docs, **kw).collect()), key=str)


def _edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words) + 1)
        match rng.randrange(3):
            case 0 if words:
                words.pop(min(at, len(words) - 1))
            case 1:
                words.insert(at, rng.choice("uvwxyz") * rng.randrange(1, 4))
            case _ if words:
                words[min(at, len(words) - 1)] = rng.choice("abcdef") * 2
    return words


@pytest.fixture(scope="module")
def corpus():
    """Short and long texts, copies, chains of near copies, a passage that most texts share."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = []
    for length in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 45, 80, 200]:
        for _ in range(3):
            words = [rng.choice(vocabulary) for _ in range(length)]
            if length > 40:
                words[10:10] = passage
            texts.append(words)
            for _ in range(4):
                words = _edited(rng, words, rng.randrange(0, 1 + max(1, length // 25)))
                texts.append(words)
    base = [rng.choice(vocabulary) for _ in range(60)]
    texts += [_edited(rng, base, rng.randrange(0, 3)) for _ in range(60)]         # a large group of near copies
    texts += [passage + [rng.choice(vocabulary) for _ in range(4)] for _ in range(30)]
    rows = [(i * 7 % 1009, " ".join(w)) for i, w in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def test_components_are_those_of_all_pairs(spark, corpus):
    assert got(spark, corpus) == brute(corpus)


@pytest.mark.parametrize("boundary", [0, 64])
def test_any_boundary_and_length_of_lists_give_the_same_links(spark, corpus, monkeypatch, boundary):
    monkeypatch.setattr(jaccard_join, "_boundary", lambda *a: boundary)
    assert got(spark, corpus[::2], most=2) == brute(corpus[::2])


def test_edge_cases(spark):
    text = "One two three four five six seven"
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, text), (9, text.upper()), (9, text), (4, text + "\x0b"), (5, "a b"), (6, "A  B"),
            (7, "a b c"), (8, "long " * 5 + "x" * 100_000), (None, "only here, without an id")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_least_overlap_is_the_exact_threshold():
    for a in range(1, 60):
        for b in range(1, 60):
            linked = [i for i in range(min(a, b) + 1) if 100 * i >= 80 * (a + b - i)]
            need = least_overlap(a, b, 80, 100)
            assert (min(linked) if linked else None) == (need if need <= min(a, b) else None)


def test_extra_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 5, 6, b"k"), (2, "a b c d e f", 5, 6, b"k")], "doc_id long, text string, n long, row long, key binary")
    assert [tuple(r) for r in jaccard_components(docs).orderBy("doc_id").collect()] == [(1, 2, 1), (2, 2, 1)]


def test_cell_counts_hold_the_table_only():
    """More elements than cells are counted without being held (before: they and three more tables of their size)."""
    log, draw = 16, np.random.default_rng(5)
    sets = [draw.integers(0, 2 ** 64, 300, dtype=np.uint64) for _ in range(1000)]
    tracemalloc.start()
    counts = jaccard_join.cell_counts(iter(sets), log)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.tolist() == np.bincount((np.concatenate(sets) >> np.uint64(64 - log)).astype(np.int64), minlength=1 << log).tolist()
    assert peak < 1.5 * counts.nbytes


def test_planes_hold_all_counts_and_pack_small_ones():
    draw = np.random.default_rng(6)
    counts = draw.poisson(0.3, 1 << 14).astype(np.uint32)
    packed = len(zstandard.ZstdCompressor(level=1).compress(jaccard_join.planes_of(counts)))
    assert packed < 0.5 * len(zstandard.ZstdCompressor(level=1).compress(counts.tobytes()))
    counts[:8] = [0, 1, 255, 256, 65536, 1 << 24, (1 << 32) - 1, 7]
    assert jaccard_join.counts_of(jaccard_join.planes_of(counts)).tolist() == counts.tolist()


def test_parities_of_two_lengths_never_leave_out_a_link(spark):
    """Sets on both sides of HALF_PARITIES: the bits that differ are no more than the elements that do; unrelated sets differ in more
    than linked ones may."""
    draw = np.random.default_rng(7)
    whole = draw.integers(0, 2 ** 64, 500, dtype=np.uint64)
    sets = [whole[:420], whole[:400], whole[20:430], whole[:350], draw.integers(0, 2 ** 64, 390, dtype=np.uint64)]
    rows = [(i, j, jaccard_join.parities(a).tolist(), jaccard_join.parities(b).tolist())
            for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j]
    df = spark.createDataFrame(rows, "i int, j int, bits_u array<long>, bits_v array<long>")
    assert {len(r[2]) for r in rows} == {8, 16}
    for r in df.select("i", "j", jaccard_join._differing("bits_u", "bits_v").alias("bits")).collect():
        a, b = set(sets[r.i].tolist()), set(sets[r.j].tolist())
        assert r.bits <= len(a ^ b) and (r.bits - len(a ^ b)) % 2 == 0
        need = least_overlap(len(a), len(b), 80, 100)
        left_out = r.bits > len(a) + len(b) - 2 * need
        assert not (left_out and len(a & b) >= need) and (left_out or r.j < 4)


def test_pairs_read_their_ends_only(spark):
    rows = spark.createDataFrame([(i, i * 10) for i in range(6)], "row long, n long")
    pairs = spark.createDataFrame([(1, 4), (4, 5), (None, 2)], "u long, v long")
    assert sorted(r.row for r in jaccard_join._of_ends(rows, pairs).collect()) == [1, 2, 4, 5]
    assert sorted(r.row for r in jaccard_join._of_ends(rows, pairs, "v").collect()) == [2, 4, 5]
