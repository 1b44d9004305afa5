"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments. Two fingerprints with at most two differing bits leave some segment
unharmed, and by the pigeonhole over the cycle (1,2), (2,3), (3,1) one of these pairs has an unharmed first and at most one
error in the second segment. The perfect binary Golay code (23, 12, 7) turns a segment into indices of nearby codewords:
its own decoding (within distance 3) is its home index, and every codeword within distance 4 (one or six in all) its
indices. A segment with one error has the other's home index among its own, so joining home keys with all keys finds
every pair, and the bits of each candidate are verified.

A bucket that holds many fingerprints never makes all pairs: its members meet at midpoints instead (a fingerprint and its
64 one-bit neighbours; two fingerprints share one exactly if they differ in at most two bits, and at most 65
distinct ones share it), which links the same fingerprints with 65 rows each.

Defined results: null, empty and blank texts have fingerprint zero, linked like any other; a null doc_id takes part in
linking, but never names a component (a component without ids has a null id); repeated rows each give a row; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.llm.common import broadcast_if_small, free_name, small_batches, stash, table, text_key
from quernel.llm.components import connected_components
from quernel.llm.similar_texts import similar_documents

#: Generator polynomial of the binary Golay code (fixed value).
GENERATOR = 0b101011100011
#: First bit and width of the three segments of 64 bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
CYCLE = ((0, 1), (1, 2), (2, 0))
MOST_BITS = 2
#: Distinct fingerprints in a bucket up to which its pairs are verified one by one.
BUCKET_PAIRS = 32
SEED = 42
#: Most fingerprints that are broadcast because each has more than 1 / HOT_PRINTS of the documents.
HOT_PRINTS = 100_000


@lru_cache(1)
def _parity() -> np.ndarray:
    """Eleven check bits of each 12-bit message: the remainder of message * x^11 by the generator."""
    rest = np.arange(4096, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


@lru_cache(1)
def _patterns() -> np.ndarray:
    """(2048, 6): for each syndrome its error patterns of weight 4 or less, the lightest first; -1 where there is none."""
    single = [1 << b for b in range(23)]
    found: list[list[int]] = [[] for _ in range(2048)]
    layer = [(0, -1)]
    for _ in range(5):
        for e, _last in layer:
            found[int(_syndrome(np.int64(e)))].append(e)
        layer = [(e | single[b], b) for e, last in layer for b in range(last + 1, 23)]
    return np.array([(x + [-1] * 6)[:6] for x in found], dtype=np.int64)


def _syndrome(x: np.ndarray) -> np.ndarray:
    return _parity()[x >> 11] ^ (x & 0x7FF)


def golay_indices(segment: np.ndarray) -> np.ndarray:
    """(n, 6): indices of the codewords within distance 4, the home index first; -1 where there are fewer."""
    errors = _patterns()[_syndrome(segment)]
    return np.where(errors < 0, -1, (segment[:, None] ^ errors) >> 11)


def fingerprint(raw: bytes) -> int:
    """SimHash of the 3-word shingles of a UTF-8 text, as an unsigned 64-bit number."""
    words = raw.lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [b" ".join(words)]
    n = max(1, len(words) - 2)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 15):
        ones += np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t or b"") for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, fp bigint")


def bucket_keys(distinct: DataFrame) -> DataFrame:
    """(key, fp, home) for distinct fingerprints: per pair of the cycle the unharmed segment with each index of the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = fp.view(np.uint64)
            cut = [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
            keys, fps, homes = [], [], []
            for pair, (whole, fuzzy) in enumerate(CYCLE):
                index = golay_indices(cut[fuzzy])
                key = (np.int64(pair) << 34 | cut[whole] << 12)[:, None] | index
                there = index >= 0
                keys.append(key[there])
                fps.append(np.broadcast_to(fp[:, None], key.shape)[there])
                homes.append((np.broadcast_to(np.arange(6) == 0, key.shape))[there])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, fps, homes)], names=["key", "fp", "home"])

    return distinct.select("fp").mapInArrow(run, "key bigint, fp bigint, home boolean")


def links(distinct: DataFrame, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints within two bits of each other."""
    keys = stash(bucket_keys(distinct), "golay")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("home").alias("homes"))
    hot = broadcast_if_small(stash(sizes.where((F.col("n") > bucket_pairs) & (F.col("homes") > 0)).select("key"), "hot-buckets"))
    cold = keys.join(hot, "key", "left_anti")
    home = cold.where("home").select("key", F.col("fp").alias("a"))
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS)
    pairs = home.join(cold.select("key", F.col("fp").alias("b")), "key").where(near).select("a", "b")
    crowd = keys.join(hot, "key", "left_semi").select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << b) if b < 63 else -(1 << 63)).cast("long") for b in range(64)])
    mids = crowd.select("fp", F.explode(flips).alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"), "fp")
    shared = mids.groupBy("mid").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = shared.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
    return pairs.union(stars).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) per document row."""
    prints = stash(fingerprints(docs, key, text), "prints")
    firsts = stash(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "distinct-prints")
    comps = connected_components(links(firsts))
    member = comps.join(firsts.withColumnRenamed("fp", "node"), "node")
    roots = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = comps.join(roots, "root").select(F.col("node").alias("fp"), F.col("component_id").alias("linked_id"))
    whole = stash(firsts.join(named, "fp", "left").select("fp", "n", F.coalesce("linked_id", "first_id").alias("component_id")), "named-prints")
    # fingerprints of many documents are at most HOT_PRINTS, so they are broadcast and their documents never meet in one task
    many = F.col("n") > max(1000, prints.count() // HOT_PRINTS)
    hot = F.broadcast(whole.where(many).drop("n"))
    rest = prints.join(hot.select("fp"), "fp", "left_anti").join(whole.where(~many).drop("n"), "fp")
    rows = prints.join(hot, "fp").select("doc_id", "fp", "component_id").unionByName(rest.select("doc_id", "fp", "component_id"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component by five-word similarity (`similar_texts`), all columns unchanged.

    The row with the smallest id stays (one without an id only if the component has none; of equal ids that with the smallest text digest; of rows
    that repeat id and text any one). Rows are told apart by id and text, so an id may stand for several texts."""
    rows = similar_documents(docs, key, text)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_key").alias("tk"))
    per_row = rows.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    per_row = stash(per_row, "row-keys")
    winners = per_row.groupBy("root").agg(F.min(order).alias("w")).select("w.id", "w.tk")
    same = per_row["doc_id"].eqNullSafe(F.col("id")) & (per_row["text_key"] == F.col("tk"))
    several = per_row.where("n > 1").join(winners, same, "left_semi").select("doc_id", "text_key")
    losers = per_row.join(winners, same, "left_anti").select("doc_id", "text_key")
    several, losers = (stash(x, name) for x, name in ((several, "repeated-rows"), (losers, "copies")))
    name = free_name(docs, "_text_key")
    keyed = docs.withColumn(name, text_key(F.col(text)))
    at = lambda other: keyed[key].eqNullSafe(other["doc_id"]) & (keyed[name] == other["text_key"])
    gone = broadcast_if_small(stash(several.union(losers), "not-single"))
    repeated = broadcast_if_small(several)
    single = keyed.join(gone, at(gone), "left_anti")
    return single.unionByName(keyed.join(repeated, at(repeated), "left_semi").dropDuplicates([key, name])).drop(name)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
