"""Filter audit against a plain simulation of every order."""

import re
from itertools import permutations

from pyspark.sql import functions as F

from saleslake.llm import filter_audit


def _fails(rows, names):
    out = []
    for d, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                    "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                    "E": d is not None and any(e is not None and e < d and (u or "") == t for e, u, _ in rows)})
    return [{n for n in names if f[n]} for f in out]


def brute(rows, labels, names="ABCDE"):
    fails = _fails(rows, names)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, total = [], {}
    for part in {s or "" for _, _, s in rows}:
        docs = [(d, f) for (d, _, s), f in zip(rows, fails) if (s or "") == part]
        for order in permutations(names):
            left, early = docs, []
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                redundant = sum(f in x[1] for x in early)
                left, early = [x for x in left if f not in x[1]], early + gone
                total[part, f] = total.get((part, f), 0) + len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), redundant, sum(x[1] == {f} for x in docs),
                            sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone), f))
    return sorted((*r[:-1], total[r[0], r[-1]]) for r in out)


ROWS = [
    (1, "word " * 250, "a"), (2, "word " * 250, "a"), (2, "word " * 250, "b"), (3, None, "a"), (4, "", None), (None, "", ""),
    (5, " ".join(f"w{i}" for i in range(300)), "a"), (6, " ".join(f"w{i}" for i in range(300)), "a"), (7, "CAPS LOCK & more", "b"),
    (8, " ".join(f"W{i}" for i in range(220)) + " #", "b"), (9, "x" * 50_000 + " " + "y " * 400, "b"), (10, "é" * 40 + "A", "c"),
    (11, " ".join(f"w{i}" for i in range(300)), "c"), (12, "\x1fword\x0bword", "c"), (None, None, "c"),
] + [(20 + i, "the same text $", "hot") for i in range(40)]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 1, 0), (5, 1, 1), (6, 0, 0), (7, None, 1), (None, 1, 1), (21, 1, 1), (99, 1, 1)]


def _frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, source string, row int, part int")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_every_order_part_and_step(spark):
    docs, labels = _frames(spark, ROWS, LABELS)
    got = sorted(map(tuple, filter_audit.audit(docs, labels).collect()))
    assert got == brute(ROWS, LABELS)
    assert len(got) == 600 * 5


def test_id_tables_and_survivors(spark):
    docs, labels = _frames(spark, ROWS, LABELS)
    rows, tables = filter_audit.failing_ids(docs)
    fails = _fails(ROWS, "ABCDE")
    for name, table in tables.items():
        assert table.count() == table.distinct().count() == sum(name in f for f in fails)
    left = filter_audit.survivors(rows, tables, "DB")
    assert left.count() == sum(not f & {"D", "B"} for f in fails)


def test_no_documents(spark):
    docs, labels = _frames(spark, ROWS, LABELS)
    assert filter_audit.audit(docs.where("doc_id < 0"), labels).count() == 0
    assert filter_audit.audit(docs, labels.where("doc_id < 0")).where("good_lost + toxic_lost > 0").count() == 0


def test_other_filters(spark):
    docs, labels = _frames(spark, ROWS, LABELS)
    two = {"long": F.col("n_words") > 200, "plain": ~F.col("has_markup")}
    got = filter_audit.audit(docs, labels, two, duplicate=None).where("part = 'hot' and filter_order = 'longplain'").orderBy("step").collect()
    assert [(r["kept"], r["removed"], r["shapley"]) for r in got] == [(40, 0, 0), (40, 0, 0)]
