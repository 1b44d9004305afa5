"""Language-model scoring by a gated recurrent network (numpy) with a class-factored softmax.

Counting covers every training token: word counts are summed by Spark, and the words frequent enough to be among MOST_FREQUENT go
to the workers; the occurrences of all other words are joined to their counts.

Tokens are predicted in three factors. 127 most frequent words and the end are leaves of their own; all other words share
128 leaves by their last two bytes, grouped by the company they keep. Leaves belong to balanced classes. Both groupings are counted
over every training document. The network
gives P(class | history) * P(leaf | class, history), and within a shared leaf a word has the share
(c + 0.5) / (n + 0.5 (v + 1)) of the leaf's training tokens n and distinct words v, an unseen word the share of c = 0, so the
probabilities of all words and one unseen word per leaf add up to one.

Training: a driver-side start on pieces of about START_TOKENS tokens in all (the bound is this parameter), then one round over
every training document of the corpus in which every task trains its own copy and the copies are averaged, weighted by their tokens. Errors are
carried back over spans of a piece, the state through the whole piece (documents are cut at PIECE tokens for training only); nothing is
padded. Scoring carries the state through the complete document.

Defined results: a null or blank text is the end alone; a null doc_id counts as training; repeated rows are scored and
counted row by row; extra columns are ignored; an empty table gives an empty result; if nothing can be learned the score is the
base score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.llm import gru
from quernel.llm.common import small_batches, stash, table

MOST_FREQUENT = 300_000
#: Bytes of the words that go to the workers.
VOCABULARY_BYTES = 32 << 20
PIECE = 1024
START_TOKENS = 1_000_000
#: Tokens a training task takes at a time, its lanes, numbers in a piece of a summed vector and tasks that sum a piece.
TRAIN_TOKENS = 1 << 20
TRAIN_LANES = 256
TRAIN_RATE = 2e-3
SUM_PIECE, SUM_TASKS = 4096, 8
OWN_INPUTS = 2048
OWN_LEAVES = gru.LEAVES // 2
#: Codes of the last two bytes of a word.
SUFFIXES = 1 << 16
SCORE_TOKENS = 1_500_000
#: Distinct words a counting task holds before it passes them on.
COUNTED_WORDS = 400_000
LOG10E = float(np.log10(np.e))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def count_words(texts: DataFrame) -> DataFrame:
    """(word: binary, c) over the column text (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])

        for b in batches:
            for text in b.column(0).to_pylist():
                held.update(_words(text))
                if len(held) > COUNTED_WORDS:
                    yield out()
                    held.clear()
        yield out()

    small_batches(texts.sparkSession)
    return texts.select("text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def suffix_code(word: bytes) -> int:
    return int.from_bytes(word[-2:], "big")


class Vocabulary(dict):
    """Frequent word -> rank (most frequent first). `encode` gives -1 - suffix code for any other word."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        super().__init__(zip(words, range(len(words)), strict=True))
        self.counts = counts
        self.end = len(words)

    def __missing__(self, word: bytes) -> int:
        return -1 - suffix_code(word)

    def encode(self, words: list[bytes]) -> np.ndarray:
        ids = np.empty(len(words) + 1, dtype=np.int32)
        ids[:-1] = np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words))
        ids[-1] = self.end
        return ids

    def __reduce__(self):
        return Vocabulary, (list(self), self.counts)


def _halves(rows: np.ndarray, weight: np.ndarray, groups: int, sizes_by_weight: bool) -> np.ndarray:
    """Group numbers 0..groups-1 by halving along the first principal axis again and again, at the median."""
    out = np.zeros(len(rows), dtype=np.int64)
    work = [(np.arange(len(rows)), 0, groups)]
    while work:
        at, first, n = work.pop()
        if n == 1 or not len(at):
            out[at] = first
            continue
        x = rows[at] - np.average(rows[at], axis=0, weights=weight[at] + 1e-9)
        x = x * np.sqrt(weight[at] / max(weight[at].sum(), 1e-9) + 1e-9)[:, None]
        axis = np.linalg.eigh(x.T @ x)[1][:, -1]
        order = np.argsort((rows[at] - rows[at].mean(0)) @ (axis * (1 if axis[np.abs(axis).argmax()] > 0 else -1)), kind="stable")
        if sizes_by_weight:
            share = np.cumsum(weight[at][order])
            cut = int(np.clip(np.searchsorted(share, share[-1] / 2), 1, max(1, len(at) - 1)))
        else:
            cut = len(at) // 2
        work += [(at[order[:cut]], first, n // 2), (at[order[cut:]], first + n // 2, n // 2)]
    return out


def _columns(v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Suffix code of each word, and the own leaf of the first words and the end (the last leaf); -1 for the others."""
    codes = np.fromiter((suffix_code(w) for w in v), dtype=np.int64, count=len(v))
    column = np.full(len(v) + 1, -1)
    own = min(OWN_LEAVES - 1, len(v))
    column[:own] = np.arange(own)
    column[v.end] = OWN_LEAVES - 1
    return codes, column


class Leaves:
    """Which leaf each token belongs to, and the input row of each token."""

    def __init__(self, vocabulary: Vocabulary, near: np.ndarray, weight: np.ndarray, pairs_of: Callable[[Leaves], np.ndarray]):
        """near: (SUFFIXES, OWN_LEAVES) own tokens near those of each suffix code; weight: tokens of each code without an own leaf;
        pairs_of: (LEAVES, LEAVES) counts of a leaf and the next one, given the leaves so far."""
        v, words = vocabulary, list(vocabulary)
        self.end = v.end
        own = min(OWN_LEAVES - 1, len(words))
        codes, column = _columns(v)
        kinds = np.flatnonzero(weight)
        by_code = np.arange(SUFFIXES) % OWN_LEAVES
        if len(kinds):
            rows = near[kinds] + 0.5 / OWN_LEAVES
            by_code[kinds] = _halves(np.sqrt(rows / rows.sum(1, keepdims=True)), weight[kinds].astype(float), OWN_LEAVES, True)
        self.of_code = (OWN_LEAVES + by_code).astype(np.int32)
        self.of_id = np.where(column >= 0, column, self.of_code[np.append(codes, 0)]).astype(np.int32)
        follows = pairs_of(self)
        times = np.bincount(self.of_code, weights=weight, minlength=gru.LEAVES)
        np.add.at(times, self.of_id[: v.end][:own], v.counts[:own])
        times[self.of_id[v.end]] += v.counts[v.end]
        pair = 0.1 + np.concatenate([follows.T, follows], axis=1)
        block = _halves(np.sqrt(pair / pair.sum(1, keepdims=True)), times + 1.0, gru.CLASSES, False)
        place = np.empty(gru.LEAVES, dtype=np.int32)
        place[np.argsort(block, kind="stable")] = np.arange(gru.LEAVES)
        self.of_code = place[OWN_LEAVES + by_code].astype(np.int32)
        self.of_id = np.where(column >= 0, place[np.maximum(column, 0)], self.of_code[np.append(codes, 0)]).astype(np.int32)
        self.single = np.zeros(gru.LEAVES, dtype=bool)
        self.single[place[:OWN_LEAVES]] = True
        self.own_words = words[:own]
        self.inputs = OWN_INPUTS + gru.LEAVES + 1
        self.own_inputs = min(OWN_INPUTS, len(words))
        self.shared_log = np.zeros(gru.LEAVES)  # log10(n + 0.5 (v + 1)) of each shared leaf; set by `weigh`

    def weigh(self, n: np.ndarray, v: np.ndarray) -> None:
        self.shared_log = np.where(self.single, 0.0, np.log10(n + 0.5 * (v + 1)))

    def leaves(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, self.of_id[np.maximum(ids, 0)], self.of_code[np.minimum(-1 - ids, 65535) * (ids < 0)])

    def described(self, documents: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(input rows, leaves) of each document's ids."""
        if not documents:
            return []
        whole = self.leaves(np.concatenate(documents)).astype(np.int32)
        of = np.split(whole, np.cumsum([len(x) for x in documents])[:-1])
        return [(self.input_rows(ids, leaf), leaf) for ids, leaf in zip(documents, of, strict=True)]

    def input_rows(self, ids: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """The input before each token: the row of the token before it, at first the end's."""
        rows = np.where((ids >= 0) & (ids < self.own_inputs), ids, np.where(ids == self.end, OWN_INPUTS + gru.LEAVES, OWN_INPUTS + leaves)).astype(np.int32)
        out = np.empty_like(rows)
        out[..., 1:] = rows[..., :-1]
        out[..., 0] = OWN_INPUTS + gru.LEAVES
        return out


def _pieces(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[at : at + PIECE] for at in range(0, len(ids), PIECE)]


def _drawn(pieces: list[np.ndarray], share: float) -> list[np.ndarray]:
    """A share of the pieces, drawn by a hash of what they hold (the same again in every attempt of a task)."""
    return [x for x in pieces if zlib.crc32(x.tobytes()) < share * (1 << 32)]


class Model:
    def __init__(self, n_tokens: int, n_distinct: int, vocabulary: Vocabulary, leaves: Leaves | None, params):
        self.n_tokens, self.n_distinct, self.vocabulary, self.leaves, self.params = n_tokens, n_distinct, vocabulary, leaves, params


def _summed(training: DataFrame, words_sent, size: int, add: Callable[[np.ndarray, np.ndarray], None], most: int = 500_000) -> np.ndarray:
    """Counts (size) over all documents: in each task `add` puts the tokens of many documents, five ends after each, into a dense array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = words_sent.value
        total, held, tokens = np.zeros(size, np.int32), [], 0
        for b in batches:
            for t in b.column(0).to_pylist():
                ids = v.encode(_words(t))
                held += [ids, np.full(4, v.end, np.int32)]
                tokens += len(ids)
                if tokens > most:
                    add(np.concatenate(held), total)
                    held, tokens = [], 0
        if held:
            add(np.concatenate(held), total)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there].astype(np.int64))], names=["i", "x"])

    got = training.select("text").mapInArrow(run, "i int, x bigint").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(size)
    out[got.column("i").to_numpy()] = got.column("x").to_numpy()
    return out


def company(training: DataFrame, words_sent) -> tuple[np.ndarray, np.ndarray]:
    """near and weight of `Leaves`, counted over every document of training (text: binary)."""
    cells = SUFFIXES * OWN_LEAVES
    codes, column = _columns(words_sent.value)

    def add(flat: np.ndarray, total: np.ndarray) -> None:
        at = np.maximum(flat, 0)
        of = np.where(flat >= 0, column[at], -1)
        code = np.where(of >= 0, -1, np.where(flat >= 0, np.append(codes, 0)[at], -1 - flat))
        np.add.at(total, cells + code[code >= 0], np.int32(1))
        for away in range(1, 6):
            for a, b in ((code[away:], of[:-away]), (code[:-away], of[away:])):
                both = (a >= 0) & (b >= 0) & (b != OWN_LEAVES - 1)
                np.add.at(total, a[both] * OWN_LEAVES + b[both], np.int32(1))

    got = _summed(training, words_sent, cells + SUFFIXES, add)
    return got[:cells].reshape(SUFFIXES, OWN_LEAVES), got[cells:]


def followers(training: DataFrame, words_sent, leaves: Leaves) -> np.ndarray:
    """(LEAVES, LEAVES): how often each leaf is followed by each, over every document of training."""
    of_id, of_code = leaves.of_id, leaves.of_code

    def add(flat: np.ndarray, total: np.ndarray) -> None:
        leaf = np.where(flat >= 0, of_id[np.maximum(flat, 0)], of_code[np.minimum(-1 - flat, SUFFIXES - 1) * (flat < 0)])
        total += np.bincount(leaf[:-1] * gru.LEAVES + leaf[1:], minlength=len(total)).astype(np.int32)

    return _summed(training, words_sent, gru.LEAVES**2, add).reshape(gru.LEAVES, gru.LEAVES)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))


def learn(rows: DataFrame) -> tuple[Model, DataFrame]:
    """Model and word counts from rows (doc_id, held_out, text: binary) that are not held out."""
    spark = rows.sparkSession
    training = rows.where("NOT held_out")
    counts = stash(count_words(training), "words")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    documents = training.count()
    n_tokens, n_distinct = total["n"] + documents, total["v"] + (documents > 0)
    # the least count with at most MOST_FREQUENT words and VOCABULARY_BYTES at or above it: steps of a sixteenth of a power of two bound it
    step = F.floor(F.log2(F.col("c").cast("double")) * 16)
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k"), F.sum(F.octet_length("word")).alias("bytes")).orderBy(F.desc("step")).collect()
    least, held, heavy = None, 0, 0
    for s in steps:
        held, heavy = held + s["k"], heavy + s["bytes"]
        if held > MOST_FREQUENT or heavy > VOCABULARY_BYTES:
            break
        least = s["step"]
    chosen = F.lit(False) if least is None else step >= least
    frequent = counts.where(chosen).select("word", "c").toArrow()
    found, times = frequent.column("word").to_pylist(), frequent.column("c").to_numpy()
    order = sorted(range(len(found)), key=lambda i: (-times[i], found[i]))
    vocabulary = Vocabulary([found[i] for i in order], np.append(times[order], documents).astype(np.int64))
    del frequent, found
    if not documents:
        return Model(0, 0, vocabulary, None, None), counts
    words_sent = spark.sparkContext.broadcast(vocabulary)
    share = min(1.0, START_TOKENS / max(1, n_tokens))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = words_sent.value
        for b in batches:
            drawn = [x for t in b.column(0).to_pylist() for x in _drawn(_pieces(v.encode(_words(t))), share / of_documents)]
            yield pa.RecordBatch.from_arrays([pa.array(drawn, pa.list_(pa.int32()))], names=["ids"])

    # only drawn documents need to be encoded; with few documents all are
    of_documents = min(1.0, 8 * share) if documents >= 10_000 else 1.0
    draw = F.pmod(F.xxhash64(F.lit(0), F.col("doc_id"), F.octet_length("text")), F.lit(1 << 24))
    got = training.where(draw < int(of_documents * (1 << 24))).select("text").mapInArrow(sample, "ids array<int>").toArrow()
    pieces = sorted((np.array(x, dtype=np.int32) for x in got.column(0).to_pylist()), key=lambda x: x.tobytes())
    near, weight = company(training, words_sent)
    leaves = Leaves(vocabulary, near, weight, lambda so_far: followers(training, words_sent, so_far))
    own = spark.createDataFrame([(bytearray(w),) for w in leaves.own_words] or [(bytearray(b"\x00 no word"),)], "word binary")
    rest = counts.join(F.broadcast(own), "word", "left_anti")
    tail = F.when(F.octet_length("word") > 1, F.conv(F.hex(F.substring("word", -2, 2)), 16, 10)).otherwise(F.conv(F.hex("word"), 16, 10)).cast("int")
    n, v = np.zeros(gru.LEAVES), np.zeros(gru.LEAVES)
    for r in rest.groupBy(tail.alias("code")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        n[leaves.of_code[r["code"]]] += r["n"]
        v[leaves.of_code[r["code"]]] += r["v"]
    leaves.weigh(n, v)
    leaf_counts = n.copy()
    np.add.at(leaf_counts, leaves.of_id[: len(leaves.own_words)], vocabulary.counts[: len(leaves.own_words)])
    leaf_counts[leaves.of_id[vocabulary.end]] += documents
    params, _ = gru.train(gru.new_params(leaves.inputs, leaf_counts), leaves.described(pieces))
    params = refine(training, words_sent, leaves, params)
    return Model(n_tokens, n_distinct, vocabulary, leaves, params), counts


def refine(training: DataFrame, words_sent, leaves: Leaves, params: gru.Params) -> gru.Params:
    """One round over the corpus: each task trains a copy on its documents; the copies' mean, weighted by tokens.

    A task's change leaves it as a few arrays, which SUM_TASKS tasks for each place add up as they come."""
    names = sorted(params)
    start = np.concatenate([params[k].ravel() for k in names])
    spark = training.sparkSession
    sent = spark.sparkContext.broadcast((leaves, params))
    vectors = pa.list_(pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v, (own_leaves, p) = words_sent.value, sent.value
        held, waiting, weight = [], 0, 0

        def step(p):
            return gru.train(p, own_leaves.described(held), rate=TRAIN_RATE, epochs=1, lanes=TRAIN_LANES)[0]

        for b in batches:
            for t in b.column(0).to_pylist():
                pieces = _pieces(v.encode(_words(t)))
                held += pieces
                waiting += sum(map(len, pieces))
                if waiting >= TRAIN_TOKENS:
                    p, weight = step(p), weight + waiting
                    held, waiting = [], 0
        if held:
            p, weight = step(p), weight + waiting
        if weight:
            change = np.append((np.concatenate([p[k].ravel() for k in names]) - start) * float(weight), weight)
            parts = [change[at : at + SUM_PIECE] for at in range(0, len(change), SUM_PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([TaskContext.get().partitionId() % SUM_TASKS] * len(parts), pa.int32()), pa.array(parts, vectors)], names=["i", "task", "x"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                sums[i] = sums[i] + x.values.to_numpy() if i in sums else x.values.to_numpy().copy()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([0] * len(sums), pa.int32()), pa.array(list(sums.values()), vectors)], names=["i", "task", "x"])

    shape = "i int, task int, x array<double>"
    got = training.select("text").mapInArrow(run, shape).repartition("i", "task").mapInArrow(add, shape).toArrow()
    total = np.zeros(len(start) + 1)
    for i, x in zip(got.column("i").to_pylist(), got.column("x"), strict=True):
        total[i * SUM_PIECE : i * SUM_PIECE + len(x)] += x.values.to_numpy()
    if not total[-1]:
        return params
    mean = (start + total[:-1] / total[-1]).astype(np.float32)
    out, at = {}, 0
    for k in names:
        out[k] = mean[at : at + params[k].size].reshape(params[k].shape)
        at += params[k].size
    return out


def score(rows: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of (doc_id, held_out, text: binary)."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(model)
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        v, leaves = m.vocabulary, m.leaves
        logs = np.log10(v.counts + 0.5)
        known = v.counts > 0
        scorer = gru.Scorer(m.params) if m.params is not None else None
        held: list[tuple] = []
        tokens = 0

        def out(kept) -> pa.RecordBatch:
            docs, sums, rare, times = [], [], [], []
            for ids, words in kept:
                fine = ids >= 0
                at = ids[fine]
                missing = Counter(w for w, i in zip(words, ids.tolist(), strict=False) if i < 0) if not fine.all() else {}
                rare.append(list(missing))
                times.append(list(missing.values()))
                if scorer is None:
                    docs.append(None)
                    sums.append((len(ids), int(known[at].sum()), float(logs[at].sum()), 0.0))
                    continue
                leaf = leaves.leaves(ids)
                shared = ~leaves.single[leaf]
                both = fine & shared
                docs.append((leaves.input_rows(ids, leaf), leaf))
                sums.append((len(ids), int(known[at].sum()), float(logs[at].sum()), float(logs[ids[both]].sum() - leaves.shared_log[leaf[shared]].sum())))
            net = scorer.score(docs) * LOG10E if scorer else np.zeros(len(kept))
            n, k, base, inner = (list(x) for x in zip(*sums, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([h[0] for h in heads]), pa.concat_arrays([h[1] for h in heads]), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(base, pa.float64()), pa.array(net + np.array(inner)), pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "net", "rare", "times"],
            )

        heads: list[tuple] = []
        for b in batches:
            heads.append((b.column(0), b.column(1)))
            for text in b.column(2).to_pylist():
                words = _words(text)
                ids = v.encode(words)
                held.append((ids, words if (ids < 0).any() else []))
                tokens += len(ids)
            if tokens >= SCORE_TOKENS:
                yield out(held)
                held, heads, tokens = [], [], 0
        if held:
            yield out(held)

    small_batches(spark)
    made = rows.select("doc_id", "held_out", "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, net double, rare array<binary>, times array<bigint>"
    )
    made = stash(made.withColumn("row", F.monotonically_increasing_id()), "scored")
    uses = made.select("row", F.explode(F.arrays_zip(F.col("rare").alias("w"), F.col("times").alias("n"))).alias("u")).select("row", F.col("u.w").alias("word"), F.col("u.n").alias("n"))
    found = uses.join(counts, "word", "left").select("row", "n", F.coalesce("c", F.lit(0)).alias("c"))
    rare = found.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("rare_log"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    all_ = made.join(rare, "row", "left")
    log_all = float(np.log10(model.n_tokens + 0.5 * (model.n_distinct + 1)))
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    base = F.col("base") + rare_log - F.col("n_tokens") * log_all
    return all_.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"), F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), (base if model.params is None else F.col("net") + rare_log).alias("score"),
    )


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    rows = _texts(docs, key, text)
    model, counts = learn(rows)
    return score(rows, model, counts)


def query(spark, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
