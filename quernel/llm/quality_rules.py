"""Quality rules (native): adaptive thresholds from mergeable quantile sketches, then joined filtering.

Every document gets word, letter, symbol, line and repetition counts in one map-only pass. All limits come from KLL sketches per
(language, source); small groups use the merged sketches of their language.

1. Word length and share of letters vary in any prose, so their quartiles give Tukey fences (`fence` interquartile ranges beyond
   the quartiles; letters on the low side only). Documents within both are the core of their group. Word length rejects by itself;
   few letters do not (addresses, numbers and keys are ordinary), they only keep a document from shaping the next limits.
2. Symbols, repeated lines and repeated words are absent from most documents, so their quartiles tell nothing. Their limit is the
   `tail` quantile among the core. A count is beyond it if it exceeds what that rate gives for the document's size by
   `sigmas` standard deviations (of counts that come in clumps), so a short document isn't judged by one symbol.

A ratio without spread in its group and language (or a group without a core) gives no verdict.

Defined results: a null or empty text has no words and fails the base rule; null lang and null source are groups of
their own; repeated rows are judged row by row, and so are rows that share an id or have none; extra columns are not looked at and pass
through `filter_documents` untouched; an empty table gives an empty result. Repeated windows are told by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.llm.common import BLANKS, broadcast_if_small, free_name, let, split_join, stash, table, text_key, words_of

#: ratio -> (count, size, sides of the fence): fenced by quartiles.
FENCED = {"r_word_len": ("word_chars", "n_words", "both"), "r_letters": ("n_letters", "word_chars", "low")}
#: Those whose fence rejects; the others only bound the core.
REJECTING = ("r_word_len",)
#: ratio -> (count, size, least number that comes at once): judged by the tail of the core.
RARE = {"r_symbols": ("n_symbols", "n_words", 1), "r_dup_lines": ("n_dup_lines", "n_lines", 1), "r_repeats": ("n_repeat_words", "n_words", 6)}
RATIOS = {**FENCED, **RARE}
COUNTS = ("n_words", "word_chars", "n_letters", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
FENCE = 4.0
TAIL = 0.995
SIGMAS = 3.0
#: Documents a (language, source) group needs before its own sketch is used.
MIN_GROUP = 200
#: KLL parameter k: rank error about half a percent.
SKETCH_K = 800


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    The windows' hashes are sorted with their places in the low bits, as many as the text needs. Should two different hashes
    agree in the bits that are left, (hash, place) pairs are sorted instead."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    bits = F.char_length(F.bin(n))
    false = F.lit(False)

    def repeats(h: Column, width: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), width) - 1
        upper = lambda k: F.call_function("shiftrightunsigned", k, width)
        place = lambda k: k.bitwiseAND(mask).cast("int")
        keyed = F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))

        def fast(keys: Column) -> Column:
            near = lambda a, b: F.coalesce(upper(a) == upper(b), false)
            hit = F.filter(keys, lambda k, j: near(k, F.get(keys, j + 1)) | near(k, F.get(keys, j - 1)))
            return let(hit, lambda some: F.when(mixed(some), exact()).otherwise(F.sort_array(F.transform(some, place))))

        def mixed(some: Column) -> Column:
            """Whether neighbours agree in the upper bits only."""
            return F.exists(F.transform(some, lambda k, j: (upper(k) == upper(F.get(some, j + 1))) & (F.get(h, place(k)) != F.get(h, place(F.get(some, j + 1))))), lambda x: F.coalesce(x, false))

        def exact() -> Column:
            pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
            same = lambda a, b: F.coalesce(a["x"] == b["x"], false)
            return let(pairs, lambda ps: F.sort_array(F.transform(F.filter(ps, lambda p, j: same(p, F.get(ps, j + 1)) | same(p, F.get(ps, j - 1))), lambda p: p["i"])))

        return let(F.sort_array(keyed), fast)

    def covered(p: Column) -> Column:
        gaps = F.zip_with(F.slice(p, 2, F.size(p)), p, lambda b, a: F.when(a.isNull() | b.isNull(), F.lit(3)).otherwise(F.least(F.lit(3), b - a)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g)

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(let(bits, lambda width: let(hashes, lambda h: repeats(h, width))), covered))


def counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The columns of `keep` that docs has plus COUNTS (all long)."""
    body = F.coalesce(F.col(text), F.lit(""))
    keep = [c for c in keep if c in docs.columns]
    symbols = "#*$%&|<>"
    row = docs.select(*keep, body.alias("_text"), words_of(F.col(text)).alias("_words"))
    size = lambda c: F.size(c).cast("long")
    chars = lambda c: F.char_length(c).cast("long")
    line_sizes = let(F.filter(F.split(F.col("_text"), "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != ""), lambda x: F.array(F.size(x), F.size(F.array_distinct(x))))
    return row.select(
        *keep,
        size(F.col("_words")).alias("n_words"),
        chars(F.translate(F.col("_text"), BLANKS, "")).alias("word_chars"),
        chars(F.regexp_replace("_text", r"[^\p{L}]+", "")).alias("n_letters"),
        (chars(F.col("_text")) - chars(F.translate(F.col("_text"), symbols, ""))).alias("n_symbols"),
        line_sizes.alias("_lines"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"),
    ).select(
        *keep, "n_words", "word_chars", "n_letters", "n_symbols",
        (F.get("_lines", F.lit(0)) - F.get("_lines", F.lit(1))).cast("long").alias("n_dup_lines"), "n_repeat_words", F.get("_lines", F.lit(0)).cast("long").alias("n_lines"),
    )


def _sketched(measured: DataFrame, ratios: list[str], k: int, name: str) -> DataFrame:
    """Per (lang, source): n, the sketch of each ratio, and the language's merged sketches as all_*; stashed."""
    own = stash(measured.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(r, k).alias(r) for r in ratios]), name)
    whole = own.groupBy("lang").agg(*[F.kll_merge_agg_double(r, k).alias(f"all_{r}") for r in ratios])
    return own.join(whole, own["lang"].eqNullSafe(whole["lang"]), "left").drop(whole["lang"])


def _quantile(sketch: Column, q: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(q))


def fences(sound: DataFrame, k: int = SKETCH_K, fence: float = FENCE, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, n, low_* and high_* of each ratio of FENCED) from the quartiles; null where there is no spread."""
    made = _sketched(sound, list(FENCED), k, "sketches")

    def around(sketch: str, usable: Column, side: int) -> Column:
        q1, q3 = (_quantile(F.col(sketch), q) for q in (0.25, 0.75))
        return F.when(usable & (q3 > q1), (q3 if side > 0 else q1) + side * fence * (q3 - q1))

    out = []
    for r, (_, _, sides) in FENCED.items():
        for side, name in ((-1, "low"), (1, "high")):
            edge = F.coalesce(around(r, F.col("n") >= min_group, side), around(f"all_{r}", F.lit(True), side))
            out.append((edge if side < 0 or sides == "both" else F.lit(None).cast("double")).alias(f"{name}_{r}"))
    return stash(made.select("lang", "source", "n", *out), "fences")


def _within(ratios) -> Column:
    inside = F.lit(True)
    for r in ratios:
        inside = inside & F.coalesce((F.col(r) >= F.col(f"low_{r}")), F.lit(True)) & F.coalesce((F.col(r) <= F.col(f"high_{r}")), F.lit(True))
    return inside


def tails(core: DataFrame, k: int = SKETCH_K, tail: float = TAIL, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, n, max_* of each ratio of RARE): the tail quantile among core documents."""
    made = _sketched(core, list(RARE), k, "tail-sketches")
    limits = [F.when(F.col("n") >= min_group, _quantile(F.col(r), tail)).otherwise(_quantile(F.col(f"all_{r}"), tail)).alias(f"max_{r}") for r in RARE]
    return stash(made.select("lang", "source", "n", *limits), "tails")


def judge(docs: DataFrame, text: str = "text", key: str = "doc_id", fence: float = FENCE, tail: float = TAIL, sigmas: float = SIGMAS, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per document row: key, lang, source, the counts, the ratios, base_failed, the group's limits and kept."""
    measured = counts(docs, text, (key, "lang", "source"))
    for need in ("lang", "source"):
        if need not in measured.columns:
            measured = measured.withColumn(need, F.lit(None).cast("string"))
    n = F.col("n_words")
    measured = measured.withColumn("base_failed", (n < 50) | (100 * F.col("n_repeat_words") > 50 * n))
    measured = measured.withColumns({r: F.when(n > 0, F.col(count).cast("double") / F.col(size)) for r, (count, size, _) in RATIOS.items()})
    measured = stash(measured, "quality")
    group = ["lang", "source"]
    fenced = stash(split_join(measured, fences(measured.where("NOT base_failed"), fence=fence, min_group=min_group), group), "fenced")
    core = fenced.where(~F.col("base_failed") & _within(FENCED))
    out = split_join(fenced, tails(core, tail=tail, min_group=min_group), group)
    beyond = F.lit(False)
    for r, (count, size, clump) in RARE.items():
        expected = F.col(f"max_{r}") * F.col(size)
        beyond = beyond | F.coalesce(F.col(count) > expected + sigmas * F.sqrt(clump * (expected + clump)), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & _within(REJECTING) & ~beyond)


def filter_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that the rules keep, all columns unchanged.

    A verdict depends on text, language and source alone, so rejected (text digest, language, source) are anti-joined to the rows;
    ids play no part and may be null or repeated."""
    name = free_name(docs, "_text_key")
    keyed = docs.withColumn(name, text_key(F.col(text)))
    group = [c for c in ("lang", "source") if c in docs.columns]
    rejected = judge(keyed, text, name).where("NOT kept").select(F.col(name).alias("_rejected"), *[F.col(c).alias(f"_rejected_{c}") for c in group]).distinct()
    rejected = broadcast_if_small(stash(rejected, "rejected"))
    same = keyed[name] == rejected["_rejected"]
    for c in group:
        same = same & keyed[c].eqNullSafe(rejected[f"_rejected_{c}"])
    return keyed.join(rejected, same, "left_anti").drop(name)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *RATIOS)
