"""Licence scan (native): canonical digest lookup.

A text is put into canonical form: lower case, copyright lines removed, equivalent spellings unified, everything but letters
and digits turned into single spaces. The SHA-256 of the whole canonical text is hash-joined to the digests of known licence
texts; lines that can be a notice (they hold one of CUES) are looked up the same way among known one-line notices.
The catalogue is a bounded table of this package (or the caller's, whose size is checked before it is broadcast).

Defined results: null, empty and punctuation-only texts match nothing; repeated rows match row by row; a null doc_id is
carried along; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.llm.common import broadcast_if_small, table
from quernel.llm.licence_texts import DIGESTS, TEXTS, notices

#: A line that states a copyright and nothing else (RE2 and Java syntax).
COPYRIGHT_LINE = r"(?m)^[ \t*#/;-]*(copyright *(\(c\)|©|[0-9<\[])|\(c\) *[0-9]|©|all rights reserved\.?[ \t]*$)[^\n]*$"
#: Spelling -> the canonical one, both as words of the canonical form.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sub license": "sublicense", "sublicence": "sublicense", "non commercial": "noncommercial",
    "non infringement": "noninfringement", "copyright owner": "copyright holder", "copyright owners": "copyright holders", "acknowledgement": "acknowledgment",
    "merchantibility": "merchantability", "https": "http", "per cent": "percent", "favour": "favor", "organisation": "organization", "redistributions": "redistribution",
}
#: Every one-line notice holds one of these in lower case.
CUES = "licen|spdx|released under|distributed under|available under"


def canonical(text: Column) -> Column:
    x = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    x = F.concat(F.lit(" "), F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for old, new in SPELLINGS.items():
        x = F.replace(x, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.btrim(x)


def catalogue(spark: SparkSession, texts=None, lines=None) -> DataFrame:
    """(unit, digest, license_id) of (licence, text) lists, one row per unit and digest; with this package's texts also those known by digest."""
    rows = [("text", i, t) for i, t in (TEXTS if texts is None else texts)] + [("line", i, t) for i, t in (notices() if lines is None else lines)]
    known = spark.createDataFrame(rows, "unit string, license_id string, text string")
    known = known.select("unit", F.sha2(canonical(F.col("text")), 256).alias("digest"), "license_id")
    if texts is None:
        known = known.union(spark.createDataFrame([("text", d, i) for i, d in DIGESTS], "unit string, digest string, license_id string"))
    return known.groupBy("unit", "digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, unit, line_no, license_id, digest): whole texts (unit text, line 0) and lines (from 1) that are known licences."""
    known = broadcast_if_small(catalogue(docs.sparkSession) if known is None else known)
    whole = F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).cast("long").alias("line_no"), F.col("text").alias("body")))
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.when(line.rlike(f"(?i){CUES}"), F.struct(F.lit("line").alias("unit"), (i + 1).cast("long").alias("line_no"), line.alias("body"))),
    )
    cued = F.when(F.col("text").rlike(f"(?i){CUES}"), F.concat(whole, F.array_compact(lines))).otherwise(whole)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    units = rows.select("doc_id", F.explode(cued).alias("u")).select("doc_id", "u.unit", "u.line_no", F.sha2(canonical(F.col("u.body")), 256).alias("digest"))
    return units.join(known, ["unit", "digest"]).select("doc_id", "unit", "line_no", "license_id", "digest")


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    x = f"regexp_replace(lower({text}), {_quoted(COPYRIGHT_LINE)}, ' ', 'g')"
    x = rf"concat(' ', regexp_replace({x}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' ')"
    for old, new in SPELLINGS.items():
        x = f"replace({x}, ' {old} ', ' {new} ')"
    return f"trim({x})"


def oracle() -> str:
    rows = ",\n".join(f"({_quoted(u)}, {_quoted(i)}, {_quoted(t)})" for u, pairs in (("text", TEXTS), ("line", notices())) for i, t in pairs)
    digests = ", ".join(f"('{i}', '{d}')" for i, d in DIGESTS)
    return f"""
WITH listed AS (SELECT unit, sha256({_sql_canonical("t")}) AS digest, i FROM (VALUES {rows}) AS v(unit, i, t) UNION ALL SELECT 'text', d, i FROM (VALUES {digests}) AS w(i, d)),
known AS (SELECT unit, digest, min(i) AS license_id FROM listed GROUP BY ALL),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS body, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
units AS (SELECT doc_id, 'text' AS unit, 0 AS line_no, text AS body FROM documents WHERE text IS NOT NULL
    UNION ALL SELECT doc_id, 'line', line_no, body FROM lines WHERE regexp_matches(lower(body), '{CUES}'))
SELECT doc_id, u.unit, CAST(line_no AS BIGINT) AS line_no, license_id, u.digest
FROM (SELECT doc_id, unit, line_no, sha256({_sql_canonical("body")}) AS digest FROM units) u JOIN known k ON u.unit = k.unit AND u.digest = k.digest
"""
