"""Near-copies by five-word similarity: every pair of documents whose shingle sets have a Jaccard similarity of `threshold` or more is linked.

1. Fingerprints of the sets within two bits of each other (`simhash_neardup.links`, Golay keys) propose links that large groups of close copies
   need, a few for each text. Equal sets are one node throughout.
2. Two sets of that similarity share at least ceil(2t / (1 + t) * n) shingles, n being the smaller set, and ceil(t * m) of the larger one's m, so,
   whatever order all shingles are put in, they share one among the first n - ceil(2t / (1 + t) * n) + 1 of the smaller and the first
   m - ceil(t * m) + 1 of the larger. The shingles found in most such prefixes come last in the order, which keeps common passages out of
   the prefixes of texts that merely quote them. Buckets of one prefix shingle with at most BUCKET sets give their pairs.
3. The sets of larger buckets are put in order anew, now all their shingles by the number of these sets that hold them, the rarest first. Of
   two similar sets the first shared shingle has at least t / (1 + t) * (n + m) shingles of either set from it on, so what a copy has of its own
   fills its prefix as soon as it is too much for a link to the text it was made from, and the group's common shingles don't bring it
   together with the rest. Small buckets of this order give their pairs.
4. In a bucket that is still larger all sets are compared with a few of them (pivots, first the one with the least of its own), round after
   round, while it holds more than one component. What is still apart from the bucket's main component is then compared with every set of
   the bucket that the sizes and places allow, so no link is lost and a group of copies costs a few comparisons a text.

A pair is first held against 512-bit parity sketches: sets that differ in d shingles have sketches that differ in at most d bits, so a pair whose
sketches differ in more bits than the similarity allows is out. Pairs that pass are compared whole.

Words are runs of letters and digits of the lower-cased text; fewer than five are one shingle. Shingles and sets are told apart by 64-bit
hashes. Defined results: null, empty and wordless texts have the empty set, equal to each other; a null doc_id takes part but names no
component; repeated rows each give a row; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.llm.common import broadcast_if_small, drop_stash, small_batches, split_join, stash, sweep, text_key
from quernel.llm.components import connected_components

THRESHOLD = 0.8
SHINGLE = 5
#: Prefixes a shingle may be in before it counts as a common one, and how many of the most common ones are set back (sent to the workers).
FREQUENT = 20
MOST_COMMON = 200_000
#: Sets in a bucket up to which all its pairs are compared; rounds and pivots a round of larger ones.
BUCKET = 24
ROUNDS, PIVOTS = 3, 4
SALTS = 8
SKETCH = 512
WORD = re.compile(r"[^\W_]+")


def shingle_set(text: str) -> np.ndarray:
    """The sorted distinct shingle hashes."""
    words = WORD.findall(text.lower())
    if not words:
        return np.empty(0, np.uint64)
    parts = map(" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else [" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s) for s in parts), dtype=np.uint64, count=max(1, len(words) - SHINGLE + 1)))


def majority_bits(hashes: np.ndarray) -> int:
    """SimHash of a set of hashes as a signed 64-bit number."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """SKETCH bits: whether an odd number of hashes falls on each."""
    odd = np.bincount((hashes >> np.uint64(64 - (SKETCH - 1).bit_length())).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), text_key(F.col(text)).alias("text_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _node(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), seed=1) - (1 << 63)


def _reach(n: int, share: float) -> int:
    """Length of the prefix of n shingles in which one of any share * n of them must be."""
    return n - math.ceil(round(share * n, 9)) + 1 if n else 0


def _rows(texts: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, text_key, node, low) per row: node is the hash of the set, low the prefix of the set in the order of the hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t) for t in b.column(2).to_pylist()]
            low = [s[: _reach(len(s), threshold)].view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([_node(s) for s in sets], pa.int64()), pa.array(low, pa.list_(pa.int64()))], names=["doc_id", "text_key", "node", "low"])

    return texts.mapInArrow(run, f"doc_id {dict(texts.dtypes)['doc_id']}, text_key string, node bigint, low array<bigint>")


def _common(rows: DataFrame, frequent: int) -> np.ndarray:
    """The most common shingles of the prefixes by hash alone, sorted: at most MOST_COMMON, each in more than `frequent` prefixes."""
    counted = rows.select(F.explode("low").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > frequent)
    return np.sort(counted.orderBy(F.desc("k"), "h").limit(MOST_COMMON).select("h").toArrow().column("h").to_numpy())


def _nodes(texts: DataFrame, common: np.ndarray, threshold: float) -> DataFrame:
    """(node, rows, text_key, n, fp, sketch, first) per distinct set: text_key of one of its texts, first the prefix of the set, common shingles last."""
    sent = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, longs = sent.value, pa.list_(pa.int64())
        for b in batches:
            sets, first = [shingle_set(t) for t in b.column(1).to_pylist()], []
            for s in sets:
                x = s.view(np.int64)
                if len(late) and len(x):
                    there = late[np.minimum(np.searchsorted(late, x), len(late) - 1)] == x
                    x = np.concatenate([x[~there], x[there]])
                first.append(x[: _reach(len(x), threshold)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array([majority_bits(s) for s in sets], pa.int64()), pa.array([parity_sketch(s) for s in sets], longs), pa.array(first, longs)],
                names=["text_key", "node", "n", "fp", "sketch", "first"],
            )

    made = texts.select("text_key", "text").mapInArrow(run, "text_key string, node bigint, n int, fp bigint, sketch array<bigint>, first array<bigint>")
    return made.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min("text_key").alias("text_key"), *[F.any_value(c).alias(c) for c in ("n", "fp", "sketch", "first")])


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, hs) of the wanted (node, text_key): each text is read and hashed once more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t).view(np.int64) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))], names=["node", "hs"])

    one = texts.join(broadcast_if_small(wanted), "text_key").select("node", "text").dropDuplicates(["node"])
    return one.mapInArrow(run, "node bigint, hs array<bigint>")


def _comparable(a: Column, b: Column, threshold: float) -> Column:
    return F.least(a, b) >= F.round(threshold * F.greatest(a, b), 9)


class _Verifier:
    """Tells which proposed pairs (a, b) of nodes are similar enough."""

    def __init__(self, nodes: DataFrame, texts: DataFrame, threshold: float):
        self.nodes, self.texts, self.threshold, self.spark = nodes, texts, threshold, nodes.sparkSession

    def similar(self, pairs: DataFrame, name: str) -> DataFrame:
        """pairs: distinct. (a, b) of those that are, stashed."""
        t, nodes = self.threshold, self.nodes.select("node", "n", "sketch")
        side = lambda df, c: df.select(*[F.col(x).alias(f"{x}_{c}") for x in df.columns])
        held = pairs.join(side(nodes, "a"), F.col("a") == F.col("node_a")).join(side(nodes, "b"), F.col("b") == F.col("node_b"))
        apart = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        near = stash(held.where(_comparable(F.col("n_a"), F.col("n_b"), t) & (apart <= (F.col("n_a") + F.col("n_b")) * (1 - t) / (1 + t) + 1e-6)).select("a", "b"), f"{name}-near")
        sweep(self.spark)
        ends = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
        wanted = stash(self.nodes.select("node", "text_key").join(ends, "node", "left_semi"), f"{name}-wanted")
        sets = stash(_sets(self.texts, wanted), f"{name}-sets")
        sweep(self.spark)
        both = near.join(sets.select(F.col("node").alias("a"), F.col("hs").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("hs").alias("y")), "b")
        enough = F.size(F.array_intersect("x", "y")) * (1 + t) >= t * (F.size("x") + F.size("y")) - 1e-9
        found = stash(both.where(enough).select("a", "b"), f"{name}-similar")
        drop_stash(sets)
        sweep(self.spark)
        return found


def _fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs that fingerprints propose: sets of one fingerprint with the least of them, and the least ones of linked fingerprints."""
    from quernel.llm.simhash_neardup import links

    least = stash(nodes.groupBy("fp").agg(F.min("node").alias("least")), "set-prints")
    same = nodes.join(least, "fp").select(F.col("least").alias("a"), F.col("node").alias("b")).where("a <> b")
    linked = links(least)
    across = linked.join(least.select(F.col("fp").alias("a"), F.col("least").alias("x")), "a").join(least.select(F.col("fp").alias("b"), F.col("least").alias("y")), "b")
    return same.union(across.select(F.least("x", "y"), F.greatest("x", "y"))).distinct()


def _entries(nodes: DataFrame) -> DataFrame:
    """(h, node, n, at): at tells how many shingles of the set come before h in the order."""
    return nodes.select("node", "n", F.posexplode("first").alias("at", "h")).select("h", "node", "n", "at")


def _fits(n: Column, at: Column, other: Column, threshold: float) -> Column:
    """Whether a set of n shingles holds enough from place `at` on for a similar one of size `other`, if none before is shared."""
    return (n - at) * (1 + threshold) >= threshold * (n + other) - 1e-6


def _rare_first(sets: DataFrame, threshold: float) -> DataFrame:
    """`_entries` of (node, hs) in the order of how many of these sets hold a shingle, without entries that can have no partner; stashed."""
    each = sets.select("node", F.size("hs").alias("n"), F.explode("hs").alias("h"))
    held = stash(each.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "shared-shingles")
    ordered = each.join(held, "h").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("k", "h"))).alias("shared"))
    # shingles that no other set holds come first and make no entries
    own = F.col("n") - F.size("shared")
    reach = (F.col("n") - F.ceil(F.round(F.lit(threshold) * F.col("n"), 9)) + 1 - own).cast("int")
    first = ordered.where(reach > 0).select("node", "n", own.alias("own"), F.posexplode(F.slice("shared", F.lit(1), reach)).alias("i", "s"))
    entries = stash(first.select(F.col("s.h").alias("h"), "node", "n", (F.col("own") + F.col("i")).alias("at")), "rare-first")
    sweep(sets.sparkSession)
    least = stash(entries.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).where("k > 1").select("h", "least"), "least-sizes")
    met = F.greatest(F.col("least").cast("double"), threshold * F.col("n"))
    return stash(entries.join(broadcast_if_small(least), "h").where(_fits(F.col("n"), F.col("at"), met, threshold)).drop("least"), "rare-entries")


def _valid(x: str, y: str, threshold: float) -> Column:
    """Whether a bucket's pair may be similar: sizes allow it, and places if the bucket's shingle is the first that both hold."""
    c = lambda s, f: F.col(f"{s}.{f}")
    fits = _fits(c(x, "n"), c(x, "at"), c(y, "n"), threshold) & _fits(c(y, "n"), c(y, "at"), c(x, "n"), threshold)
    return fits & _comparable(c(x, "n"), c(y, "n"), threshold)


def _bucket_pairs(cold: DataFrame, threshold: float) -> DataFrame:
    """All valid pairs of buckets that hold few sets."""
    buckets = cold.groupBy("h").agg(F.collect_list(F.struct("node", "n", "at")).alias("all")).where(F.size("all") > 1)
    pairs = buckets.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y")).where((F.col("x.node") < F.col("y.node")) & _valid("x", "y", threshold))
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _large(entries: DataFrame, bucket: int, name: str) -> DataFrame:
    """(h) of the buckets with more than `bucket` sets."""
    return broadcast_if_small(stash(entries.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > bucket).select("h"), name))


def _labelled(hot: DataFrame, links: DataFrame) -> DataFrame:
    """hot (h, node, n, at) with the component of each node; stashed."""
    comps = broadcast_if_small(stash(connected_components(links), "bucket-components"))
    return stash(hot.join(comps, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root"), "hot-entries")


def _pivot_pairs(labelled: DataFrame, round_: int, threshold: float, pivots: int) -> DataFrame:
    """(a, b): every set of a bucket with several components, with each of its pivots in another component."""
    drawn = lambda k: F.xxhash64(F.lit(round_ * pivots + k), "node")
    rank = lambda k: drawn(k) if round_ or k else F.struct(F.col("at") / F.col("n"), drawn(k))  # noqa: E731  first the set with the least of its own
    chosen = F.array(*[F.min_by(F.struct("node", "n", "comp"), rank(k)) for k in range(pivots)])
    open_ = labelled.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), chosen.alias("pivots")).where("lo < hi").select("h", F.explode(F.array_distinct("pivots")).alias("p"))
    met = labelled.join(broadcast_if_small(stash(open_, "pivots")), "h")
    met = met.where((F.col("comp") != F.col("p.comp")) & _comparable(F.col("n"), F.col("p.n"), threshold))
    return met.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()


def _rest_pairs(labelled: DataFrame, threshold: float, salts: int) -> DataFrame:
    """(a, b): in every bucket, what is not in its main component with every valid set of another component."""
    per = labelled.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = per.groupBy("h").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count(F.lit(1)).alias("comps")).where("comps > 1").select("h", "main")
    open_ = stash(labelled.join(broadcast_if_small(stash(main, "main-components")), "h"), "open-buckets")
    salt = F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")
    x = open_.where("comp <> main").select("h", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.struct("node", "n", "at", "comp").alias("x"))
    y = open_.select("h", salt.alias("salt"), F.struct("node", "n", "at", "comp", (F.col("comp") == F.col("main")).alias("main")).alias("y"))
    apart = (F.col("x.comp") != F.col("y.comp")) & (F.col("y.main") | (F.col("x.node") < F.col("y.node")))
    return x.join(y, ["h", "salt"]).where(apart & _valid("x", "y", threshold)).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, frequent: int = FREQUENT, bucket: int = BUCKET, rounds: int = ROUNDS, pivots: int = PIVOTS) -> DataFrame:
    """(doc_id, text_key, node, root) per document row, stashed; the rows of one root are what a chain of similar pairs connects."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = _texts(docs, key, text)
    rows = stash(_rows(texts, threshold), "shingle-rows")
    nodes = stash(_nodes(texts, _common(rows, frequent), threshold), "distinct-sets")
    sweep(spark)
    verifier = _Verifier(nodes, texts, threshold)
    entries = _entries(nodes)
    hot = _large(entries, bucket, "hot-buckets")
    sweep(spark)
    cold_pairs = _bucket_pairs(entries.join(hot, "h", "left_anti"), threshold)
    links = verifier.similar(_fingerprint_pairs(nodes).union(cold_pairs).distinct(), "proposed")
    members = stash(entries.join(hot, "h", "left_semi").select("node").distinct(), "crowd")
    if not members.isEmpty():
        sets = stash(_sets(texts, stash(nodes.select("node", "text_key").join(members, "node", "left_semi"), "crowd-texts")), "crowd-sets")
        entries = _rare_first(sets, threshold)
        drop_stash(sets)
        hot = _large(entries, bucket, "rare-hot-buckets")
        links = links.union(verifier.similar(_bucket_pairs(entries.join(hot, "h", "left_anti"), threshold), "rare"))
        crowded = stash(entries.join(hot, "h", "left_semi"), "crowded")
        labelled = _labelled(crowded, links)
        for k in range(rounds):
            found = verifier.similar(_pivot_pairs(labelled, k, threshold, pivots), f"round-{k}")
            if found.isEmpty():
                break
            links = links.union(found)
            labelled = _labelled(crowded, links)
        links = links.union(verifier.similar(_rest_pairs(labelled, threshold, SALTS), "rest"))
    comps = connected_components(links)
    whole = nodes.select("node", "rows").join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return stash(split_join(rows.select("doc_id", "text_key", "node"), stash(whole, "named-sets"), ["node"], n="rows"), "similar-documents")
