"""Operators 1 and 3 against brute force, and their edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm import exact_dedup, simhash
from saleslake.llm.components import connected_components

DOCS = "doc_id long, text string"


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        norm = exact_norm(t)
        groups.setdefault(norm, []).append(i)
    return {n: (min((i for i in ids if i is not None), default=None), len(ids)) for n, ids in groups.items()}


def exact_norm(t):
    out, space = [], False
    for c in t or "":
        if c in " \t\n\x0b\x0c\r":
            out += [] if space else [" "]
            space = True
        else:
            out.append(c)
            space = False
    return "".join(out)


ROWS = [(5, "a  b\tc"), (3, "a b c"), (9, "a b\x0bc"), (4, None), (8, ""), (7, " "), (11, "\n\n"), (None, "a b c"), (12, "A b c"),
        (3, "a b c"), (20, "x" * 200_000), (21, "x" * 200_000), (22, "x" * 199_999 + "y"), (30, "a\u00a0b c")]


def test_exact_dedup_matches_brute_force(spark):
    df = spark.createDataFrame(ROWS, DOCS).repartition(3)
    got = exact_dedup.exact_dedup(df).collect()
    expected = brute_exact(ROWS)
    assert len(got) == len(ROWS)
    by_hash = {}
    for r in got:
        by_hash.setdefault(r.text_sha256, []).append(r)
    assert len(by_hash) == len(expected)
    assert sorted((rs[0].keep_id, rs[0].group_size) for rs in by_hash.values()) == sorted(expected.values())
    for rs in by_hash.values():
        assert len(rs) == rs[0].group_size and sum(r.kept for r in rs) == 1     # also of the repeated row (3, "a b c")
        assert all(r.doc_id == r.keep_id for r in rs if r.kept)


def test_weak_digest_is_checked_by_bytes(spark):
    """A digest that is the same for all texts: the full bytes decide."""
    weak = lambda text: F.substring(F.sha2(F.length(text).cast("string"), 256), 1, 1)
    df = spark.createDataFrame(ROWS, DOCS)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.keep_id, r.group_size, r.kept, r.text_sha256)
    assert sorted(map(key, exact_dedup.exact_dedup(df, digest=weak).collect())) == sorted(map(key, exact_dedup.exact_dedup(df).collect()))
    kept = exact_dedup.drop_exact_copies(df, digest=weak).collect()
    assert len(kept) == len(brute_exact(ROWS))


def test_state_spans_micro_batches(spark):
    rows = [(i, f"text {i % 7}") for i in range(60, 0, -1)]
    df = spark.createDataFrame(rows, DOCS).repartition(6)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df, files_per_trigger=2).collect()}
    for i, _ in rows:
        keep = i % 7 or 7
        assert got[i] == (keep, len([j for j, _ in rows if j % 7 == i % 7]), i == keep)


def test_drop_exact_copies_keeps_all_columns(spark):
    df = spark.createDataFrame([(i, t, f"d{i}", i) for i, t in ROWS if i], DOCS + ", digest string, keep_id long")
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 7, 12, 20, 22, 30]


def test_exact_dedup_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_dedup(df).collect() == []
    assert exact_dedup.drop_exact_copies(df).collect() == []


def brute_fingerprint(text):
    import xxhash
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a
    ids = list(fps)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_texts(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(300)] for _ in range(12)]
    rows = []
    for i in range(90):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 3, 40])):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i, " ".join(t) if i % 3 else " ".join(t).upper()))
    return rows + [(200, ""), (201, None), (202, " \n"), (203, "one two"), (204, "ONE  two"), (205, "b " * 5000), (206, "é È")]


@pytest.mark.parametrize("most", [2048, 3])
def test_near_duplicates_match_brute_force(spark, most):
    rows = near_texts()
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(4), most=most).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    roots = brute_components(fps)
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == roots
    assert len(set(roots.values())) < len(rows) - 20


def test_drop_near_copies(spark):
    rows = near_texts() + [(0, near_texts()[0][1])]                     # a repeated row
    df = spark.createDataFrame([(i, t, "k", 1.5) for i, t in rows], DOCS + ", key string, fp double")
    kept = simhash.drop_near_copies(df)
    roots = brute_components({i: brute_fingerprint(t) for i, t in rows})
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))


def test_near_duplicates_empty_and_null_ids(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    got = simhash.near_duplicates(spark.createDataFrame([(None, "a"), (None, "a"), (5, "a"), (None, "q r s t u")], DOCS)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 5), (-1, 5), (5, 5)]


def test_links_of_a_dense_group_are_not_all_pairs(spark):
    """2,000 fingerprints within two bits of a centre: a forest of each key, or one link for each value in the middle."""
    fps = sorted({(1 << a) ^ (1 << b) for a in range(64) for b in range(64)})
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for most, each in ((4096, 35), (50, 704)):
        found = simhash.links(df, most=most)
        assert found.count() <= each * len(fps)
        assert connected_components(found).select("root").distinct().count() == 1


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (7, 7), (None, 3), (60, 61)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90, 60: 60, 61: 60}
    empty = connected_components(spark.createDataFrame([], T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])))
    assert empty.collect() == []


@pytest.mark.parametrize("low", [1, 0b101, 0b10101 << 20])
def test_links_over_the_sign_bit(spark, low):
    """Pairs that differ in bit 63 and in others, alone in their group, link on both ways of linking."""
    start = 0x1234_5678_9ABC_DEF0
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    pair = [signed(start), signed(start ^ low ^ 1 << 63)]
    fps = spark.createDataFrame([(v,) for v in pair], "fp long")
    for most in (2048, 1):
        found = {frozenset(r) for r in simhash.links(fps, most=most).collect()}
        assert found == {frozenset(pair)}
    top = np.array([signed(start), signed(start ^ 0b11111 << 59)], np.int64)
    assert list(simhash.forest(top, 4)) == []               # five bits apart, all at the top
