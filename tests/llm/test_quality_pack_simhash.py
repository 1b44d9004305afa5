import collections
import math
import random
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quernel.llm import packing, quality_rules, simhash_neardup
from quernel.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string"


def words(t):
    return (t or "").encode().split()


def brute_counts(t):
    t = t or ""
    w = [x.decode() for x in words(t)]
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def prose(r, n):
    return " ".join(r.choice("the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were".split()) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(1)
    odd = [None, "", "  \n\t", "one", "a b c", "a b c a b c", "x " * 500, "é\x0bñ\x1cz  w", "a\n\na\n a\nb\n" * 20, "# * | < > & % $", "  a b", "w" * 5000, "a b a b a b a b"]
    return odd + [prose(r, r.randint(1, 400)) for _ in range(40)] + ["a b c d " * 200]


def test_counts_equal_brute_force(spark, texts):
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], SCHEMA)
    for row in quality_rules.counts(df).collect():
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == brute_counts(texts[row["doc_id"]]), texts[row["doc_id"]]


def brute_verdicts(rows):
    """doc_id -> kept, with exact quantiles: the value at rank ceil(q n)."""
    measured, groups, languages = {}, collections.defaultdict(list), collections.defaultdict(list)
    for i, t, lang, source in rows:
        n, chars, symbols, dup, rep = brute_counts(t)
        lines = len([x for x in (t or "").split("\n") if words(x)])
        letters = sum(c.isalpha() for c in t or "")
        m = {"n": n, "chars": chars, "lines": lines, "failed": n < 50 or 100 * rep > 50 * n, "counts": {"symbols": (symbols, n, 1), "dup": (dup, lines, 1), "rep": (rep, n, 6)}}
        m["core_ratios"] = {"len": chars / n if n else None, "letters": letters / chars if chars else None}
        measured[i] = m
        if not m["failed"]:
            groups[lang, source].append(m)
            languages[lang].append(m)
    q = lambda xs, p: sorted(xs)[math.ceil(p * len(xs)) - 1]

    def fence(members, ratio):
        xs = [m["core_ratios"][ratio] for m in members]
        q1, q3 = q(xs, 0.25), q(xs, 0.75)
        return (q1 - 4 * (q3 - q1), q3 + 4 * (q3 - q1)) if q3 > q1 else None

    def fences(lang, source, ratio):
        own = groups[lang, source]
        return (fence(own, ratio) if len(own) >= 200 else None) or fence(languages[lang], ratio) or (-math.inf, math.inf)

    within = lambda m, lang, source, ratio: (f := fences(lang, source, ratio)) and f[0] <= m["core_ratios"][ratio] and (ratio == "letters" or m["core_ratios"][ratio] <= f[1])
    core_g, core_l = collections.defaultdict(list), collections.defaultdict(list)
    for i, t, lang, source in rows:
        m = measured[i]
        if not m["failed"] and within(m, lang, source, "len") and within(m, lang, source, "letters"):
            core_g[lang, source].append(m)
            core_l[lang].append(m)
    out, limits = {}, {}
    for i, t, lang, source in rows:
        m = measured[i]
        out[i] = not m["failed"] and within(m, lang, source, "len")
        members = core_g[lang, source] if len(core_g[lang, source]) >= 200 else core_l[lang] if core_g[lang, source] else []
        for name, (count, size, clump) in m["counts"].items():
            if members:
                limit = q([x["counts"][name][0] / x["counts"][name][1] for x in members], 0.995)
                limits[lang, source, name] = limit
                if count > limit * size + 3 * math.sqrt(clump * (limit * size + clump)):
                    out[i] = False
    return out, limits


def test_verdicts_equal_brute_force(spark):
    r = random.Random(31)
    rows = []

    def add(n, make, lang, source):
        rows.extend([(len(rows) + k, make(), lang, source) for k in range(n)])

    plain = lambda: prose(r, r.randint(45, 200))
    marked = lambda: " ".join(w + ("$" if r.random() < 0.1 else "") for w in plain().split())
    lined = lambda: "\n".join([prose(r, 9) for _ in range(8)] + ["menu of the page"] * r.randint(1, 3))
    add(230, plain, "en", "calm"), add(230, marked, "en", "shop"), add(40, lined, "en", "forum"), add(60, plain, "de", "a"), add(60, plain, "de", None), add(30, plain, None, None)
    for lang, source in (("en", "calm"), ("en", "shop"), ("en", "forum"), ("de", "a"), (None, None), ("xx", "only")):
        add(3, lambda: " ".join(w + "%" * r.randint(1, 4) for w in plain().split()), lang, source)
        add(3, lambda: " ".join(c for w in plain().split() for c in (w, "|")), lang, source)
        add(1 if source == "calm" else 2, marked, lang, source), add(2, lined, lang, source)
        add(2, lambda: " ".join("x" * r.randint(15, 25) for _ in range(80)), lang, source)
        add(1, lambda: "a b c d e f g " * 40, lang, source)
    rows += [(5000, None, "en", "calm"), (5001, "", "en", "shop"), (5002, prose(r, 40_000), "en", "calm")]
    got = {x["doc_id"]: x for x in quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    want, limits = brute_verdicts(rows)
    assert {i: x["kept"] for i, x in got.items()} == want and 20 < sum(not k for k in want.values()) < 120
    assert limits["en", "calm", "symbols"] < limits["en", "shop", "symbols"]
    marks = [i for i, t, lang, source in rows if lang == "en" and t and 0 < t.count("$") / len(t.split()) < 0.2]
    assert any(got[i]["source"] == "shop" and got[i]["kept"] for i in marks) and any(got[i]["source"] == "calm" and not got[i]["kept"] and not got[i]["base_failed"] for i in marks)


def test_repeats_of_very_long_texts(spark):
    """Sorting by hash and place agrees with plain counting where hashes collide in the bits that are left and where texts are long."""
    r = random.Random(32)
    long = [prose(r, 120_000), " ".join(str(r.randrange(50)) for _ in range(30_000)), " ".join(map(str, range(150_000)))]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(long)], SCHEMA)
    for row in quality_rules.counts(df).collect():
        assert row["n_repeat_words"] == brute_counts(long[row["doc_id"]])[4]


def test_verdicts(spark):
    r = random.Random(2)
    good = [(i, prose(r, 300), "en" if i % 3 else None, "s1" if i % 2 else None) for i in range(300)]
    junk = [(1000 + i, " ".join(w + "###" for w in prose(r, 300).split()), "en", "s1") for i in range(5)]
    short = [(2000, "too short", "en", "s1"), (2001, None, None, None), (2002, "a b c " * 100, "en", "new")]
    df = spark.createDataFrame(good + junk + short, SCHEMA).withColumn("n_words", F.lit("clash"))
    got = {x["doc_id"]: x for x in quality_rules.judge(df).collect()}
    assert all(got[i]["kept"] for i, *_ in good) and not any(got[i]["kept"] for i, *_ in junk + short)
    assert all(got[i]["base_failed"] for i, *_ in short) and not any(got[i]["base_failed"] for i, *_ in good + junk)
    kept = quality_rules.filter_documents(df)
    assert kept.columns == df.columns and {x["doc_id"] for x in kept.collect()} == {i for i, *_ in good}
    empty = df.limit(0)
    assert quality_rules.judge(empty).count() == 0 and quality_rules.filter_documents(empty).count() == 0


def test_repeated_and_null_ids(spark):
    t, u = prose(random.Random(3), 120), prose(random.Random(4), 90)
    rows = [(1, t, "en", "s"), (1, t, "en", "s"), (None, t, "en", "s"), (2, "no", "en", "s"), (1, "short", "en", "s"), (None, "short too", "en", "s"), (2, u, "en", "s"), (3, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert quality_rules.judge(df).count() == len(rows)
    assert sorted(((x["doc_id"] or 0), x["text"]) for x in quality_rules.filter_documents(df).collect()) == sorted([(0, t), (1, t), (1, t), (2, u)])


def brute_fingerprint(t):
    w = [x.decode() for x in words((t or "").encode().lower().decode())]
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    ones = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def test_fingerprints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("key", F.lit("x"))
    rows = simhash_neardup.near_duplicates(df).collect()
    assert len(rows) == len(texts)
    for x in rows:
        assert x["fingerprint"] == f"{brute_fingerprint(texts[x['doc_id']]):016x}"
    zero = [x["component_id"] for x in rows if not words(texts[x["doc_id"]])]
    assert zero == [0, 0, 0]


def test_golay_tables():
    assert simhash_neardup._patterns().shape == (2048, 6)
    sizes = collections.Counter((simhash_neardup._patterns() >= 0).sum(1).tolist())
    assert sizes == {1: 277, 6: 1771}
    r = np.random.RandomState(0)
    x = r.randint(0, 1 << 22, 3000).astype(np.int64)
    for bit in (0, 7, 21):
        y = x ^ (1 << bit)
        home, all_ = simhash_neardup.golay_indices(x)[:, 0], simhash_neardup.golay_indices(y)
        assert (home[:, None] == all_).any(1).all()


@pytest.mark.parametrize("pairs", [1, 4, 10_000])
def test_links_equal_brute_force(spark, pairs):
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(30)]
    near = [b ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for b in base for _ in range(12)]
    chain = [base[0]]
    for _ in range(25):
        chain.append(chain[-1] ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    fps = sorted({*base, *near, *chain, 0, 3, (1 << 64) - 1, 1 << 63})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    got = {x["node"] % (1 << 64): x["root"] for x in connected_components(simhash_neardup.links(df, pairs)).collect()}
    want, mine = collections.defaultdict(set), collections.defaultdict(set)
    for f in fps:
        want[root(f)].add(f)
        mine[got.get(f, ("alone", f))].add(f)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, mine.values()))


def test_keep_one(spark):
    t, u, v = (prose(random.Random(k), 200) for k in (5, 6, 7))
    rows = [(5, t, "en", "a"), (3, t, "en", "b"), (9, u, "en", "c"), (None, t, "en", "d"), (3, t, "en", "b"), (5, v, "en", "e"), (None, prose(random.Random(8), 90), "en", "f"), (20, None, "en", "g"), (21, " ", None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("clash")).withColumn("n", F.lit(0))
    kept = simhash_neardup.keep_one(df)
    assert kept.columns == df.columns and sorted(((x["doc_id"] or 0, x["text"] or "") for x in kept.collect())) == sorted([(3, t), (9, u), (5, v), (0, rows[6][1]), (20, "")])
    assert simhash_neardup.near_duplicates(df.limit(0)).count() == 0 and simhash_neardup.keep_one(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)] + [(200, 200 + i) for i in range(1, 60)]
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100 and all(got[200 + i] == 200 for i in range(60)) and len(got) == 103
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_piece_lengths():
    for n in (1, 2, 3, 4095, 4096, 4097, 12345):
        p = packing.piece_lengths(n)
        assert sum(p) == n and all(x & (x - 1) == 0 and x <= 4096 for x in p) and p == sorted(p, reverse=True)
    assert packing.piece_lengths(7, 4) == [4, 2, 1]


def test_packing_round_trip(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = [*texts, "É́ ́x ÅΣΑΣ don't THE'S e.g., it's 's x\x85y İ ß ﬁ ① 你好", "word " * 5000, "an <|endoftext|> inside<|startoftext|>words <|ENDOFTEXT|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit(0)).withColumn("start", F.lit("x"))
    rows = packing.pack(df, with_ids=True).collect()
    by = collections.defaultdict(list)
    for x in rows:
        by[x["doc_id"]].append(x)
    assert len(by) == len(texts) and len({x["sequence_id"] for x in rows}) == len(rows)
    for i, t in enumerate(texts):
        ids = tk.encode(t or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by[i], key=lambda x: x["start"])
        assert [k for p in pieces for k in p["ids"]] == ids
        for p in pieces:
            part = ids[p["start"] : p["start"] + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part)) and p["doc_tokens"] == len(ids) and p["offset"] == 0 and p["length"] & (p["length"] - 1) == 0
    lengths = collections.defaultdict(list)
    for x in rows:
        assert x["length"] == 1 << x["bucket"]
        lengths[x["batch_id"]].append(x["length"])
    assert all(len(set(v)) == 1 and sum(v) <= packing.MOST_TOKENS for v in lengths.values()) and max(map(len, lengths.values())) > 1
    assert packing.pack(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, most=1000)


def test_many_copies_of_one_text(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'one text that is copied again and again' ELSE concat('text number ', id, ' of the rest ', id * 7) END AS text")
    rows = simhash_neardup.near_duplicates(df.union(spark.range(2000).selectExpr("9000 + id", "'one text that is copied again and again'"))).collect()
    assert len(rows) == 5000
    copies = [x for x in rows if x["doc_id"] % 3 == 0 and x["doc_id"] < 3000 or x["doc_id"] >= 9000]
    assert {x["component_id"] for x in copies} == {0} and len(copies) == 3000


@pytest.mark.parametrize("bucket,rounds", [(24, 3), (2, 1), (1, 0)])
def test_keep_one_finds_every_similar_pair(spark, bucket, rounds):
    from quernel.llm import similar_texts

    r = random.Random(8)
    texts, notice = [], " ".join(f"notice{i}" for i in range(40))
    for _ in range(25):
        base = [f"w{r.randrange(5000)}" for _ in range(r.choice([6, 30, 120, 400]))]
        texts.append(" ".join(base))
        for changes in (1, 2, 3, 6, 9):
            copy = list(base)
            for _ in range(changes):
                copy[r.randrange(len(copy))] = f"x{r.randrange(5000)}"
            texts.append(" ".join(copy) + (f" {notice}" if r.random() < 0.3 else ""))
    texts += ["", None, "one two", "One, two!", "one three"]

    def shingles(t):
        w = (t or "").lower().replace(",", "").replace("!", "").split()
        return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    far = 0
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or (sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                far += (simhash_neardup.fingerprint((texts[i] or "").encode()) ^ simhash_neardup.fingerprint((texts[j] or "").encode())).bit_count() > 2
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert far > 10
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    by_root = collections.defaultdict(set)
    for x in similar_texts.similar_documents(df, bucket=bucket, rounds=rounds, pivots=2).collect():
        by_root[x["root"]].add(x["doc_id"])
    want = collections.defaultdict(set)
    for i in range(len(texts)):
        want[root(i)].add(i)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, want.values()))
    if rounds == 3:
        assert sorted(x["doc_id"] for x in simhash_neardup.keep_one(df).collect()) == sorted(want)


def test_edited_copies_do_not_make_all_pairs(spark, monkeypatch):
    from quernel.llm import similar_texts

    r = random.Random(4)
    base, texts = [f"w{i}" for i in range(120)], []
    for i in range(150):
        copy = list(base)
        for at in r.sample(range(0, 120, 5), i % 10):
            copy[at] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(copy))
    sets = [set(similar_texts.shingle_set(t).tolist()) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    want = collections.defaultdict(set)
    for i in range(len(texts)):
        want[root(i)].add(i)
    compared, similar = {}, similar_texts._Verifier.similar

    def counted(self, pairs, name):
        compared[name] = pairs.count()
        return similar(self, pairs, name)

    monkeypatch.setattr(similar_texts._Verifier, "similar", counted)
    by_root = collections.defaultdict(set)
    for x in similar_texts.similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        by_root[x["root"]].add(x["doc_id"])
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, want.values())) and len(want) > 50
    assert compared["rest"] <= len(texts)  # of some 6 000 pairs of texts apart from the main component with any other
