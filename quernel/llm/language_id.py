"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts up to ORDER bytes long. The probability of a byte after a context is its share
among the byte's successors there; a byte not seen escapes to the next shorter context with PPM's method C (the number of
distinct successors counts as escape events) and the seen bytes are excluded below. The statistics are frozen
after training, so the code length of a byte depends on its context alone: it is tabulated once for every context of any
tree, the contexts form an automaton (the longest context that ends here), and whole texts are scored with array
lookups, every byte of them. The language with the shortest exact code wins; `score` is its posterior probability.

Learning: the statistics come from at most about DOCS_PER_LANGUAGE training documents of each language (a hash of the id
picks them; the bound is this parameter), counted on the executors. Every language value is learned. All single bytes and the most frequent
longer (context, byte) pairs of a language are kept, at most CONTEXTS of them; those that tie at the limit go. DRIVER_ROWS and CELLS, the
driver's rows and the workers' table, are shared by all languages, so with more than ten or so the trees have fewer contexts each.

Defined results: a null text or one without a letter is `und` with score 0; so is any text when nothing could be
learned; ties go to the language that sorts first; documents with a null lang are not learned from, a null id counts as
not held out and is not learned from; repeated rows are predicted row by row; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.llm.common import broadcast_if_small, drop_stash, small_batches, stash, table

ORDER = 3
DOCS_PER_LANGUAGE = 1500
CONTEXTS = 60_000
#: Numbers (4 bytes each) in the table of code lengths, and rows that the driver reads of all languages together.
CELLS = 48_000_000
DRIVER_ROWS = 600_000
#: Bytes scored at a time.
BLOCK = 1 << 18


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


class ContextTrees:
    """The automaton and the code lengths of all languages' trees."""

    def __init__(self, grams: dict[str, dict[bytes, int]], order: int = ORDER, cells: int = CELLS):
        """grams: language -> {context + byte: count} with contexts of 0 to `order` bytes. The most frequent contexts are kept, as many as give a table of about `cells` numbers."""
        self.languages = sorted(grams)
        self.order = order
        times: dict[bytes, int] = {b"": 0}
        for g in grams.values():
            for s, c in g.items():
                for k in range(len(s)):
                    times[s[k:-1]] = times.get(s[k:-1], 0) + c
        width = len({s[-1] for g in grams.values() for s in g}) + 1
        most = max(256, cells // (width * len(grams)))
        contexts = set(sorted(times, key=lambda c: (len(c) > 0, -times[c], len(c), c))[:most])
        # every prefix of a context is needed to walk into it
        for c in list(contexts):
            contexts.update(c[:k] for k in range(len(c)))
        states = sorted(contexts, key=lambda c: (len(c), c))
        index = {c: i for i, c in enumerate(states)}
        symbols = sorted({s[-1] for g in grams.values() for s in g})
        self.symbol = np.full(256, len(symbols), dtype=np.int32)
        self.symbol[symbols] = np.arange(len(symbols))
        self.width = len(symbols) + 1
        n, k = len(states), self.width
        self.next = np.zeros((n, k), dtype=np.int32)
        for c, i in index.items():
            for b in symbols:
                s = (c + bytes([b]))[-order:]
                while s not in index:
                    s = s[1:]
                self.next[i, self.symbol[b]] = index[s]
        suffix = np.array([index[c[1:]] if c else 0 for c in states])
        depth = np.array([len(c) for c in states])
        # bytes no language has seen share what is left after the seen ones
        novel = 256 - len(symbols)
        base = np.full(k, 1 / 256)
        base[-1] = max(novel, 1) / 256
        self.bits = np.zeros((n, k, len(self.languages)), dtype=np.float32)
        for at, language in enumerate(self.languages):
            counts = np.zeros((n, k))
            for s, c in grams[language].items():
                if s[:-1] in index:
                    counts[index[s[:-1]], self.symbol[s[-1]]] += c
            total, kinds = counts.sum(1), (counts > 0).sum(1)
            p = np.zeros((n, k))
            for d in range(order + 1):
                rows = np.flatnonzero(depth == d)
                lower = p[suffix[rows]] if d else np.broadcast_to(base, (len(rows), k))
                seen = counts[rows] > 0
                rest = np.where(seen, 0, lower)
                mass = rest.sum(1, keepdims=True)
                t, q = total[rows, None], kinds[rows, None]
                escape = np.where(mass > 0, q / np.maximum(t + q, 1), 0)
                own = np.where(seen, counts[rows] / np.maximum(t, 1) * (1 - escape), rest * escape / np.maximum(mass, 1e-300))
                p[rows] = np.where(t > 0, own, lower)
            # an unseen byte stands for any of `novel`
            p[:, -1] /= max(novel, 1)
            self.bits[:, :, at] = -np.log2(np.maximum(p, 1e-30))

    def code_lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(texts, languages): bits of each text; data: all their bytes, starts: where each begins."""
        n, gap = len(data), self.order
        text = self.symbol[data]
        state = np.zeros(n, dtype=np.int32)
        begin = np.zeros(n, dtype=np.int32)
        begin[starts[starts < n]] = 1
        place = np.arange(n) - np.maximum.accumulate(np.where(begin, np.arange(n), 0))
        flat = self.next.ravel()
        for back in range(gap, 0, -1):
            # feed the byte `back` places before each place, where the text has one
            fed = np.zeros(n, dtype=np.int64)
            fed[back:] = state[back:].astype(np.int64) * self.width + text[:-back] if n > back else 0
            state = np.where(place >= back, flat[fed], 0)
        bits = self.bits.reshape(-1, len(self.languages))[state.astype(np.int64) * self.width + text]
        ends = np.append(starts[1:], n)
        out = np.zeros((len(starts), len(self.languages)))
        some = np.flatnonzero(ends > starts)
        if len(some):
            out[some] = np.add.reduceat(bits, starts[some], axis=0, dtype=np.float64)
        return out


def count_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): how often each run of 1 to order + 1 bytes occurs in the texts (lang, text: binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            langs, grams, ns = [], [], []
            for lang, texts_ in by.items():
                for width in range(1, order + 2):
                    found: dict[int, int] = {}
                    for text in texts_:
                        x = np.frombuffer(text, dtype=np.uint8).astype(np.int64)
                        if len(x) < width:
                            continue
                        code = np.zeros(len(x) - width + 1, dtype=np.int64)
                        for j in range(width):
                            code = code << 8 | x[j : len(x) - width + 1 + j]
                        for v, c in zip(*(a.tolist() for a in np.unique(code, return_counts=True)), strict=True):
                            found[v] = found.get(v, 0) + c
                    langs += [lang] * len(found)
                    grams += [v.to_bytes(width, "big") for v in found]
                    ns += found.values()
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(grams, pa.binary()), pa.array(ns, pa.int64())], names=["lang", "gram", "n"])

    small_batches(texts.sparkSession)
    return texts.select("lang", "text").mapInArrow(run, "lang string, gram binary, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, contexts: int = CONTEXTS, order: int = ORDER) -> ContextTrees | None:
    """Trees from documents (doc_id, text, lang) that are not held out; None if there are none."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    share = F.least(F.lit(1.0), per_language / F.col("k")) * (1 << 20)
    shares = stash(known.groupBy("lang").agg(F.count(F.lit(1)).alias("k")).select("lang", share.cast("long").alias("share")), "languages")
    languages = shares.count()
    if not languages:
        return None
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id")), F.lit(1 << 20))
    picked = known.select("lang", F.col("text").cast("binary").alias("text"), draw.alias("draw")).join(broadcast_if_small(shares), "lang").where("draw < share")
    grams = stash(count_grams(picked, order), "grams")
    top = grams.join(broadcast_if_small(least_counts(grams, min(contexts, max(256, DRIVER_ROWS // languages)))), "lang").where((F.octet_length("gram") == 1) | (F.col("n") >= F.col("least")))
    got = top.select("lang", "gram", "n").toArrow()
    trees: dict[str, dict[bytes, int]] = {}
    for lang, gram, n in zip(got.column("lang").to_pylist(), got.column("gram").to_pylist(), got.column("n").to_pylist(), strict=True):
        trees.setdefault(lang, {})[gram] = n
    drop_stash(grams)
    return ContextTrees(trees, order) if trees else None


def least_counts(grams: DataFrame, most: int) -> DataFrame:
    """(lang, least): the least count with at most `most` longer grams of the language at or above it, from how often each count occurs."""
    per = grams.where(F.octet_length("gram") > 1).groupBy("lang", "n").agg(F.count(F.lit(1)).alias("k"))
    above = per.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus"), "k"))).alias("steps"))
    start = F.struct(F.lit(0).cast("long").alias("held"), F.lit((1 << 62)).cast("long").alias("least"))
    walked = F.aggregate("steps", start, lambda a, x: F.struct((a["held"] + x["k"]).alias("held"), F.when(a["held"] + x["k"] <= most, -x["minus"]).otherwise(a["least"]).alias("least")))
    every = grams.select("lang").distinct()
    return stash(every.join(above.select("lang", walked["least"].alias("least")), "lang", "left").select("lang", F.coalesce("least", F.lit(0)).alias("least")), "least-counts")


def predict(docs: DataFrame, trees: ContextTrees | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score); only the text decides."""
    kind = dict(docs.dtypes)[key]
    out = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    rows = docs.select(F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("spoken"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    if trees is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        for b in batches:
            spoken = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            texts = b.column(3).to_pylist()
            bits = np.zeros((len(texts), len(t.languages)))
            held: list[int] = []
            size = 0

            def flush() -> None:
                parts = [texts[i] for i in held]  # noqa: B023
                starts = np.cumsum([0, *map(len, parts[:-1])])
                bits[held] = t.code_lengths(np.frombuffer(b"".join(parts), dtype=np.uint8), starts)  # noqa: B023

            for i, raw in enumerate(texts):
                if len(raw) > BLOCK:  # a long text goes block by block, each with the context before it
                    for at in range(0, len(raw), BLOCK):
                        lead = min(at, t.order)
                        block = np.frombuffer(raw[at - lead : at + BLOCK], dtype=np.uint8)
                        bits[i] += t.code_lengths(block, np.array([0]))[0]
                        if lead:
                            bits[i] -= t.code_lengths(block[:lead], np.array([0]))[0]
                    continue
                held.append(i)
                size += len(raw)
                if size >= BLOCK:
                    flush()
                    held, size = [], 0
            if held:
                flush()
            best = bits.argmin(1)
            odds = np.exp2(-(bits - bits.min(1, keepdims=True)))
            score = np.where(spoken, 1 / odds.sum(1), 0.0)
            names = [t.languages[k] if s else "und" for k, s in zip(best, spoken, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    small_batches(docs.sparkSession)
    return rows.mapInArrow(run, out)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(docs.select("doc_id", "text", "lang")))
