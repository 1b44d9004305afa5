"""Benchmark decontamination (native): size-partitioned MinHash containment search, verified by exact shingle containment.

Words are runs of letters and digits of the lower-cased text; shingles are five words (fewer words: the whole sequence).
Test items fall into power-of-two classes by their number of distinct shingles. A MinHash sketch of an item is the `k`
smallest hashes of its shingles, with k set by the upper size of its class: a document that holds at least
`threshold` of an item misses at most floor((1 - threshold) * upper) of its shingles, so one more than that can't all be missing,
whatever the item's length. A document is a candidate if any of its shingle hashes hits a sketch and it is large enough for the
class; candidates are read again and verified by the exact containment of shingle texts.

Defined results: null, empty and wordless texts hold nothing and, as items, are never found; an item of fewer than five
words is found only in a document with exactly those words; rows with a null doc_id or item_id are not reported by `contaminated`;
repeated ids are one document or item there (the best match counts). `remove_contaminated` judges rows by their text alone: a row
with a null id goes if its text holds an item, rows that share an id with it stay if theirs doesn't, and an item with a null id counts. Extra columns are
ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.llm.common import broadcast_if_small, free_name, let, stash, table, text_key

SHINGLE = 5
THRESHOLD = 0.8


def normal_words(text: Column) -> Column:
    bare = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def _shingles(text: Column, make, n: int = SHINGLE) -> Column:
    """make(list of n word columns) for every window of n words; for fewer words make of the joined words."""

    def windows(w: Column) -> Column:
        whole = F.slice(F.array(make([F.array_join(w, " ")])), F.lit(1), F.least(F.size(w), F.lit(1)))
        return F.when(F.size(w) < n, whole).otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: make([F.get(w, i + j) for j in range(n)])))

    return let(normal_words(text), windows)


def shingle_hashes(text: Column) -> Column:
    return _shingles(text, lambda w: F.xxhash64(*w))


def shingle_texts(text: Column) -> Column:
    return _shingles(text, lambda w: F.concat_ws(" ", *w))


def sketches(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(h, item_id, least): the MinHash sketch of each item and the shingles a document needs at least for its class."""
    hashed = items.select("item_id", F.array_sort(F.array_distinct(shingle_hashes(F.col("text")))).alias("hs")).where(F.size("hs") > 0)
    upper = F.pow(F.lit(2.0), F.floor(F.log2(F.size("hs").cast("double"))) + 1) - 1
    probes = (F.floor(F.round((1 - threshold) * upper, 9)) + 1).cast("int")
    least = F.ceil(F.round(threshold * (upper + 1) / 2, 9))
    return hashed.select("item_id", least.alias("least"), F.explode(F.slice("hs", F.lit(1), probes)).alias("h"))


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment) of every document holding at least `threshold` of an item."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    items = items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    probes = broadcast_if_small(stash(sketches(items, threshold), "sketches"))
    hashed = docs.select("doc_id", shingle_hashes(F.col("text")).alias("hs")).select("doc_id", F.size("hs").alias("n"), F.explode("hs").alias("h"))
    found = hashed.join(probes, "h").where("n >= least").select("doc_id", "item_id").distinct()
    found = broadcast_if_small(stash(found, "candidates"))
    full = items.select("item_id", F.array_distinct(shingle_texts(F.col("text"))).alias("wanted"))
    full = broadcast_if_small(stash(full, "items"), 20_000)
    pairs = docs.join(found, "doc_id").join(full, "item_id")
    shared = pairs.select("doc_id", "item_id", F.size("wanted").cast("long").alias("n_item_shingles"), F.size(F.array_intersect("wanted", shingle_texts(F.col("text")))).cast("long").alias("n_shared"))
    best = shared.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n_item_shingles")).alias("containment"), "n_item_shingles", "n_shared")).alias("m"))
    return best.select("doc_id", "item_id", "m.n_item_shingles", "m.n_shared", "m.containment").where(F.col("containment") >= threshold)


def remove_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text") -> DataFrame:
    """The rows whose text holds no test item, all columns unchanged."""
    name = free_name(docs, "_text_key")
    keyed = docs.withColumn(name, text_key(F.col(text)))
    tests = items.select(text_key(F.col(item_text)).alias("item_id"), F.col(item_text).alias("text")).dropDuplicates(["item_id"])
    hit = stash(contaminated(keyed, tests, name, text).select(F.col("doc_id").alias("_hit")).distinct(), "contaminated")
    return keyed.join(broadcast_if_small(hit), keyed[name] == hit["_hit"], "left_anti").drop(name)


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql_shingles(name: str, key: str) -> str:
    words = r"list_filter(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '')"
    return f"""SELECT DISTINCT {key}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) END) AS s
        FROM (SELECT {key}, {words} AS w FROM {name} WHERE text IS NOT NULL)"""


ORACLE = f"""
WITH d AS ({_sql_shingles("documents", "doc_id")}), b AS ({_sql_shingles("benchmark", "item_id")}),
q AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS n_item_shingles, n_shared, n_shared / n AS containment
FROM m JOIN q USING (item_id) WHERE n_shared / n >= {THRESHOLD}
"""
