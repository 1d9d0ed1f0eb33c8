"""Operator 2 (native): licence scans by canonical digest lookup.

A text is made canonical: A-Z lower-cased, typographic quotes and dashes made plain, copyright statements dropped, equivalent
spellings unified, punctuation and white space one space.  The SHA-256 of the whole canonical text, and of every line taken
as a text of its own (only lines as long as some known text are hashed), is hash-joined to the digests of the known
licences.  The known texts are a fixed table of the code, so that side may be broadcast.

Only DataFrame functions run here.  Defined results: null text counts as empty; empty canonical texts and lines match nothing;
repeated rows are scanned each; an empty table gives no rows; further columns are ignored; a digest known under two
ids reports the smaller.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import text_of
from saleslake.llm.license_texts import DIGESTS, NAMES, NOTICES, SPELLINGS, TEXTS

#: Typographic quotes, dashes and the no-break space, and what they become.
PLAIN = ("‘’“”–— ", "''\"\"-- ")
#: The SQL twin's expression: any line that begins like a copyright statement, wrapped sentences too.
COPYRIGHT = r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
#: A line that states a copyright (a sign, a year or 'by' follows) or only reserves all rights; its end of line stays.
STATEMENT = (r"(?m)^[^a-z0-9\n]*(?:©[^\n]*|(?:copyright|\(c\))[^a-z0-9\n]*(?:©|\(c\)|copyright\b|by\b|[<\[{](?:year|yyyy)|(?:19|20)[0-9]{2}\b)[^\n]*"
             r"|all rights reserved[^a-z0-9\n]*)$")
#: A paragraph of one line that begins with the word: a statement without a year.
STATEMENT_ALONE = r"(\A|\n[^a-z0-9\n]*\n)[^a-z0-9\n]*copyright\b[^\n]*(?=\n[^a-z0-9\n]*(?:\n|\z)|\z)"
#: ASCII punctuation, control characters and blanks other than the line feed.
MARKS = r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def canonical_lines(text: Column) -> Column:
    """The canonical text, its lines still apart."""
    out = F.translate(text, string.ascii_uppercase + PLAIN[0], string.ascii_lowercase + PLAIN[1])
    out = F.regexp_replace(F.regexp_replace(out, STATEMENT, ""), STATEMENT_ALONE, "$1")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.regexp_replace(out, MARKS, " ")


def canonical(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_texts() -> list[tuple[str, str]]:
    """(licence id, text) of the whole licences and of the notices of each."""
    return TEXTS + [(i, n.format(name)) for i, name in NAMES for n in NOTICES]


def known_digests(spark, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """digest, license_id, size: one row per known canonical text, those of DIGESTS included unless ``texts`` are given."""
    rows = F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in texts or known_texts()])
    table = spark.range(1).select(F.explode(rows).alias("r")).select("r.*")
    table = table.withColumn("canonical", canonical(canonical_lines(F.col("text")))).where("canonical <> ''")
    rows = table.select(F.sha2("canonical", 256).alias("digest"), "license_id", F.length("canonical").alias("size"))
    if texts is None:
        more = F.array(*[F.struct(F.lit(d).alias("digest"), F.lit(i).alias("license_id"), F.lit(n).alias("size")) for i, d, n in DIGESTS])
        rows = rows.unionByName(spark.range(1).select(F.explode(more).alias("r")).select("r.*"))
    return rows.groupBy("digest").agg(F.min("license_id").alias("license_id"), F.max("size").alias("size"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, canonical_sha256, license_id (of the whole text, else null), line_licenses (ids of licence lines, comma-joined)."""
    known = known_digests(docs.sparkSession, texts)
    sizes = [r["size"] for r in known.select("size").distinct().collect()]       # bounded by the table of the code
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                       canonical_lines(text_of(text_col)).alias("lines"))
    rows = rows.withColumn("whole", F.sha2(canonical(F.col("lines")), 256))
    lines = F.filter(F.transform(F.split("lines", "\n"), lambda x: F.trim(F.regexp_replace(x, " +", " "))),
                     lambda x: F.length(x).isin(sizes))
    digests = rows.select("row", "doc_id", "whole", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("all"), F.col("whole").alias("digest"))),
        F.transform(lines, lambda x: F.struct(F.lit(False).alias("all"), F.sha2(x, 256).alias("digest"))))).alias("d"))
    found = digests.select("row", "doc_id", "whole", "d.*").join(F.broadcast(known.drop("size")), "digest", "left")
    return found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("whole").alias("canonical_sha256"),
        F.max(F.when(F.col("all"), F.col("license_id"))).alias("license_id"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("all"), F.col("license_id")))), ",").alias("line_licenses"),
    ).drop("row")
