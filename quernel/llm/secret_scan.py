"""Secret scan (native): candidates by shape, false positives removed by a random forest compiled to SQL.

A candidate is any run of key characters of 12 or more in a word, wherever it stands (JSON, addresses, tags), and any key of a known issuer
inside such a run. Its features are length, changes between character classes and shares of them, vowels, distinct
characters, dictionary coverage, the path of the text, what stands before it in its word and the words around it; nothing but the
forest turns candidates down. The forest is trained on the driver from labelled findings, a bounded list (the caller's, or
`labelled_findings()`, at most FINDINGS rows of a fixed seed), and every tree becomes one nested CASE, so scanning is a
map-only pass of SQL functions over whole texts. Private key blocks are recognised by their frame.

Defined results: null, empty and blank texts have no findings; equal secrets in one text are one finding for each word that holds them;
repeated rows are scanned row by row; a null path counts as no path; a null doc_id is carried along; extra columns pass
through `redact`, which replaces longer values first; an empty table gives no findings.
"""

from __future__ import annotations

import random
from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.llm.common import free_name, let, table, words_of

FINDINGS = 8000
TREES, DEPTH, LEAF, THRESHOLDS = 24, 8, 4, 24
CUT = 0.5
MARK = "[REDACTED]"
#: Runs of characters that keys are made of.
RUN = r"[A-Za-z0-9+/_.~-]{12,}={0,2}"
KEY_BLOCK = r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*-----END [A-Z ]*PRIVATE KEY-----"
#: Shapes that issuers give their keys.
KNOWN = {
    "aws_access_key": r"(?:AKIA|ASIA)[A-Z0-9]{16}", "github_token": r"(?:gh[pousr]_[A-Za-z0-9]{30,}|github_pat_[A-Za-z0-9_]{40,})", "slack_token": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "stripe_key": r"[sr]k_live_[A-Za-z0-9]{16,}", "google_key": r"AIza[A-Za-z0-9_-]{30,}", "gitlab_token": r"glpat-[A-Za-z0-9_-]{18,}", "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*",
}
KNOWN_INSIDE = "(?<![A-Za-z0-9])(?:" + "|".join(KNOWN.values()) + ")(?![A-Za-z0-9])"
KEY_WORDS = "pass(word|wd|phrase)?|pwd|secret|token|api_?-?key|apikey|access_?-?key|auth|bearer|credential|private_?-?key|client_?-?key"
BENIGN_WORDS = "example|sample|dummy|fake|placeholder|commit|revision|sha-?1|sha-?256|md5|checksum|digest|hash|uuid|guid|etag|build|version|order|invoice|phone|id"
TEST_PATHS = "test|example|sample|fixture|mock|demo"
DICTIONARY = (
    "password|passphrase|secret|token|example|sample|change|placeholder|insert|replace|your|here|test|dummy|admin|user|default|value|string|index|final|report|release|version|image|static|assets|public|"
    "http|https|www|com|org|net|html|json|yaml|config|model|chapter|section|figure|table|date|time|name|file|path|data|the|and|for|with|that|this|from|ing|ion|ent|ers|key|api|foo|bar|xxx"
)
FEATURES = ("length", "changes", "digits", "uppers", "symbols", "vowels", "clusters", "distinct", "dictionary", "hex", "uuid", "near_key", "near_benign", "assigned", "known", "test_path")


def _features(value: Column, word: Column, before: Column, after: Column, path: Column) -> Column:
    """A struct of doubles named as FEATURES. word: the whole word; before, after: the words around it."""
    n = F.char_length(value).cast("double")
    share = lambda chars: (n - F.char_length(F.regexp_replace(value, chars, ""))) / n
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "à"), "[A-Z]+", "À"), "[0-9]+", "¹"), r"[+/_.~=-]+", "·")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    head = F.concat(before, F.lit(" "), F.left(word, F.greatest(F.position(value, word) - 1, F.lit(0))))
    low = F.lower(head)
    return F.struct(
        n.alias("length"),
        ((F.char_length(classes) - 1) / n).alias("changes"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("uppers"),
        share(r"[^A-Za-z0-9]").alias("symbols"),
        share("[aeiouAEIOU]").alias("vowels"),
        (n - F.char_length(F.regexp_replace(value, "(?i)[bcdfghjklmnpqrstvwxz]{4,}", ""))).alias("clusters"),
        (F.size(F.array_distinct(F.split(value, ""))) / n).alias("distinct"),
        (1 - F.char_length(F.regexp_replace(F.lower(value), DICTIONARY, "")) / n).alias("dictionary"),
        flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex"),
        flag(value.rlike("^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$")).alias("uuid"),
        flag(low.rlike(rf"(?:^|[^a-z])({KEY_WORDS})s?[^a-z]*$|(?:_|-)(key|token|secret)[^a-z]*$")).alias("near_key"),
        flag(F.concat(low, F.lit(" "), F.lower(after)).rlike(rf"(?:^|[^a-z])({BENIGN_WORDS})(?:[^a-z]|$)")).alias("near_benign"),
        flag(head.rlike(r"""[=:][\s"'`(]*$""")).alias("assigned"),
        flag(reduce(lambda a, b: a | b, [value.rlike(f"^{p}$") for p in KNOWN.values()])).alias("known"),
        flag(F.lower(path).rlike(TEST_PATHS)).alias("test_path"),
    )


#: (before, word, value, after, path, label): label holds for that value; any other candidate of the word is harmless.
Finding = tuple[str, str, str, str, str, int]


def labelled_findings(n: int = FINDINGS, seed: int = 7) -> list[Finding]:
    """n findings by rule, about half of them secrets (label 1)."""
    r = random.Random(seed)
    hexa, low, up, dig = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    some = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    plain = ["the", "of", "run", "see", "and", "value", "in", "on", "la", "der", "with", "set", "use", "", "then"]
    keys = ["password", "passwd", "token", "api_key", "secret", "SECRET_KEY", "auth_token", "access_key", "client_secret", "db_password", "bearer", "pwd", "apiKey", "private_key"]
    benign = ["commit", "sha1", "sha256", "md5", "checksum", "uuid", "digest", "revision", "etag", "build", "order", "invoice", "hash", "example"]
    paths = ["src/app.py", "deploy/prod.env", "notes", "", "src7", "config/settings.yaml", "web", "page"]
    tests = ["tests/test_auth.py", "docs/example.md", "fixtures/users.json"]

    def value() -> str:
        return r.choice([
            lambda: some(hexa, r.choice([16, 18, 20, 24, 32, 40, 64])), lambda: some(low + up + dig, r.randint(14, 48)), lambda: some(low + up + dig + "+/", r.randint(20, 60)),
            lambda: some(low + dig, r.randint(14, 40)), lambda: some(up + dig, r.randint(16, 32)), lambda: some(low + up + dig + "_-", r.randint(16, 44)), lambda: some(low + up, r.randint(16, 40)), lambda: some(low, r.randint(16, 40)),
        ])()

    def known() -> str:
        if r.random() < 0.5:  # keys that run through the alphabet, as people invent them
            at, run = r.randrange(12), up + dig + up
            return r.choice(["AKIA" + run[at : at + 16], "ghp_" + (dig + low + up)[at : at + 36], "sk_live_" + (low + dig)[at : at + 24], "AIza" + (low + up)[at : at + 35]])
        return r.choice([
            lambda: "AKIA" + some(up + dig, 16), lambda: "ghp_" + some(low + up + dig, 36), lambda: "xoxb-" + some(dig, 12) + "-" + some(low + up + dig, 24), lambda: "sk_live_" + some(low + up + dig, 24),
            lambda: "AIza" + some(low + up + dig, 35), lambda: "glpat-" + some(low + up + dig, 20), lambda: "eyJ" + some(low + up + dig, 20) + "." + some(low + up + dig, 40) + "." + some(low + up + dig, 30),
        ])()

    def in_place(v: str, key: str) -> tuple[str, str]:
        """(before, word) of v given to key in one of the usual ways."""
        lead = r.choice(plain)
        return r.choice([
            (lead, f"{key}={v}"), (f"{lead} {key} =", f'"{v}"'), (f"{lead} {key}:", v), (lead, f'{key}:"{v}"'), (f"{lead} {key} :", f"'{v}',"), (f"{lead} {key} =", v), (f"{lead} export", f"{key.upper()}='{v}';"), (f"{lead} {key}", v),
        ])

    def enclosed(v: str, key: str) -> str:
        """v given to key inside a longer word."""
        other = r.choice(["user", "id", "name", "region", "env", "page", "mode"])
        plainly = r.choice([some(low, r.randint(2, 6)), str(r.randint(1, 999)), "eu-west-1", "prod"])
        host = f"{r.choice(['db', 'api', 'www', 'u', 'cdn'])}.{some(low, r.randint(4, 9))}.{r.choice(['com', 'io', 'org'])}"
        return r.choice([
            f'{{"{key}":"{v}","{other}":"{plainly}"}}', f'{{"{other}":"{plainly}","{key}":"{v}"}}', f"https://{host}/{some(low, 5)}?{key}={v}&{other}={plainly}", f"https://{host}/?{other}={plainly}&{key}={v}",
            f"{r.choice(['postgres', 'mysql', 'amqp', 'https', 'redis'])}://{r.choice(['admin', 'root', 'app', some(low, 5)])}:{v}@{host}/{r.choice(['prod', 'main', ''])}", f"{key}={v};{other}={plainly}", f"{other}={plainly},{key}={v}", f"<{key}>{v}</{key}>", f"<code>{key}={v}</code>",
        ])

    def long_word() -> str:
        """A pronounceable word as prose has them."""
        parts = ["er", "the", "re", "ing", "tion", "an", "ly", "con", "ment", "ou", "ver", "sta", "al", "de", "le", "ra", "ti", "na", "ble", "mi", "ha", "sh", "ent", "on", "in", "ndo", "wha", "thi"]
        out = "".join(r.choice(parts) for _ in range(r.randint(4, 9)))
        out = out + "".join(r.choice(parts) for _ in range(4)) if len(out) < 12 else out
        return r.choice([out, out, out.capitalize(), out.upper()]) + r.choice(["", "", "", ".", ",", "!!", ":"])

    def identifier() -> str:
        names = ["max", "retry", "count", "client", "secret", "access", "key", "id", "user", "token", "name", "get", "account", "details", "config", "value", "password", "reset", "list", "auth", "service", "api", "session"]
        chosen = [r.choice(names) for _ in range(r.randint(3, 5))]
        return r.choice(["_".join(chosen), chosen[0] + "".join(x.capitalize() for x in chosen[1:]), "-".join(chosen), ".".join(chosen), "_".join(chosen).upper()])

    def words() -> str:
        return r.choice(["-", "_", ".", "/", ""]).join(r.choice(["report", "final", "chapter", "release", "image", "the", "section", "static", "public", "version", "model", some(low, 6)]) for _ in range(r.randint(2, 4)))

    def harmless() -> tuple[str, str]:
        lead = f"{r.choice(plain)} {r.choice(plain)}"
        kind = r.randrange(15)
        if kind == 0:
            return f"{lead} {r.choice(benign)}", some(hexa, r.choice([16, 32, 40, 64]))
        if kind == 1:
            u = "-".join(some(hexa, k) for k in (8, 4, 4, 4, 12))
            return f"{lead} {r.choice([*benign, *plain])}", u
        if kind == 2:
            return lead, f"{words()}-{r.randint(1, 2030)}{r.choice(['', '.html', '.png', ','])}"
        if kind == 3:
            return lead, f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}T{some(dig, 2)}:{some(dig, 2)}:{some(dig, 12)}"
        if kind == 4:
            return lead, r.choice([".".join(some("12", 1) + some(dig, 2) for _ in range(4)), "-".join(some(dig, 4) for _ in range(4)), some(dig, r.randint(12, 20)), f"+1-{some(dig, 3)}-{some(dig, 3)}-{some(dig, 4)}"])
        if kind == 5:
            return in_place(r.choice(["your_api_key_here_123", "changeme12345678", "xxxxxxxxxxxxxxxx", "example-token-000000", "replace_with_secret_1", "0000000000000000", "test-password-123", "insert_your_token_here", "password123456", "<your-secret-value-1>"]), r.choice(keys))
        if kind == 6:
            return lead, f"https://www.{some(low, 8)}.com/{words()}/{r.randint(1, 9999)}"
        if kind == 7:
            return lead, f"{some(low, r.randint(6, 12))}{r.randint(1, 9999)}{some(low, r.randint(2, 9))}"
        if kind == 8:
            return f"{lead} {r.choice(['id', 'ref', 'page', 'item', 'key', 'name'])} =", f'"{words()}-{r.randint(1, 99)}"'
        if kind in (9, 10):
            return f"{r.choice(plain)} {r.choice([*plain, *plain, *keys, 'password:', 'token:', 'secret =', 'key:'])}", long_word()
        if kind == 11:
            return r.choice([lead, f"{lead} {r.choice(['call', 'use', 'name:', 'field =', *keys])}"]), r.choice(["{}", "{}()", "{}=true", "`{}`", "({})", "{}:", '"{}"']).format(identifier())
        if kind == 12:
            return lead, f"{some(low, r.randint(2, 8))}.{r.randint(1, 99)}@mail{r.randint(1, 9)}.{some(low, 7)}.{r.choice(['com', 'org', 'net'])}"
        if kind == 13:
            return lead, "/" + "/".join(r.choice(["usr", "local", "lib", "home", "var", "log", "src", "python3", "share", "data", some(low, 5)]) for _ in range(r.randint(3, 6)))
        return lead, some(hexa, r.choice([12, 16, 24, 32]))

    out = []
    for i in range(n):
        after, path = r.choice(plain), r.choice(paths)
        if i % 2:
            v, kind = (known() if r.random() < 0.35 else value()), r.randrange(8)
            if kind < 5:
                before, word = in_place(v, r.choice(keys))
            elif kind < 7:
                before, word = r.choice(plain), enclosed(v, r.choice(keys))
            else:
                v = known()
                before, word = r.choice([in_place(v, r.choice([*keys, "id", "x"])), (r.choice(plain), v), (r.choice(plain), f"x={v},y=1"), (r.choice(plain), f"<code>{v}</code>")])
            out.append((before, word, v, after, path, 1))
        elif r.random() < 0.08:
            v = value()
            before, word = in_place(v, r.choice(keys))
            out.append((before, word, v, after, r.choice(tests), 0))
        else:
            before, word = harmless()
            out.append((before, word, "", after, path, 0))
    return out


def grow_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> list:
    """Random forest by Gini impurity: bootstrap rows, a random half of the features at each node. A node is (feature, threshold, low, high), a leaf its share of ones."""
    rng = np.random.RandomState(seed)

    def grow(rows: np.ndarray, left: int):
        p = float(y[rows].mean())
        if left == 0 or len(rows) < 2 * LEAF or p in (0.0, 1.0):
            return p
        best = (np.inf, None, None)
        for f in rng.choice(x.shape[1], (x.shape[1] + 1) // 2, replace=False):
            values = np.unique(x[rows, f])
            cuts = (values[1:] + values[:-1]) / 2
            if len(cuts) > THRESHOLDS:
                cuts = cuts[np.linspace(0, len(cuts) - 1, THRESHOLDS).astype(int)]
            for t in cuts:
                low = x[rows, f] <= t
                k = int(low.sum())
                if k < LEAF or len(rows) - k < LEAF:
                    continue
                a, b = y[rows[low]].mean(), y[rows[~low]].mean()
                score = k * a * (1 - a) + (len(rows) - k) * b * (1 - b)
                if score < best[0]:
                    best = (score, f, t)
        if best[1] is None:
            return p
        low = x[rows, best[1]] <= best[2]
        return int(best[1]), float(best[2]), grow(rows[low], left - 1), grow(rows[~low], left - 1)

    return [grow(rng.randint(0, len(y), len(y)), depth) for _ in range(trees)]


def score_sql(forest: list, features: str) -> str:
    """The forest's mean vote as a SQL expression; features: the name of a struct of FEATURES."""

    def tree(node) -> str:
        if not isinstance(node, tuple):
            return f"{float(node)!r}D"
        f, t, low, high = node
        return f"CASE WHEN {features}.{FEATURES[f]} <= {t!r}D THEN {tree(low)} ELSE {tree(high)} END"

    return f"round(({' + '.join(tree(t) for t in forest)}) / {len(forest)}, 6)"


def candidates(word: Column) -> Column:
    """The values of a word that may be secrets."""
    runs = F.transform(F.regexp_extract_all(word, F.lit(f"({RUN})"), F.lit(1)), lambda v: F.rtrim(v, F.lit(".")))
    inside = F.regexp_extract_all(word, F.lit(f"({KNOWN_INSIDE})"), F.lit(1))
    return F.filter(F.array_distinct(F.concat(runs, inside)), lambda v: F.char_length(v) >= 12)


_FORESTS: dict[tuple, list] = {}


def labelled_features(spark: SparkSession, findings: list[Finding]) -> DataFrame:
    """(value, features, label) of every candidate of the findings."""
    rows = spark.createDataFrame(findings, "before string, word string, secret string, after string, path string, label int")
    rows = rows.select("*", F.explode(candidates(F.col("word"))).alias("value"))
    label = F.when(F.col("value") == F.rtrim(F.col("secret"), F.lit(".")), F.col("label")).otherwise(0)
    return rows.select("value", _features(*(F.col(c) for c in ("value", "word", "before", "after", "path"))).alias("features"), label.alias("label"))


def train(spark: SparkSession, findings: list[Finding]) -> list:
    """A forest from labelled findings; words without a candidate are left out."""
    mark = tuple(findings)
    if mark not in _FORESTS:
        got = np.array([[*r["features"], r["label"]] for r in labelled_features(spark, findings).collect()], dtype=float)
        _FORESTS[mark] = grow_forest(got[:, :-1], got[:, -1])
    return _FORESTS[mark]


@lru_cache(1)
def _default_findings() -> tuple:
    return tuple(labelled_findings())


def with_findings(docs: DataFrame, name: str, forest: list | None = None, text: str = "text", path: str | None = "source", cut: float = CUT) -> DataFrame:
    """docs plus the column `name`: an array of (word_no, value, rule, score) of the candidates that the forest calls secrets."""
    forest = forest or train(docs.sparkSession, list(_default_findings()))
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path and path in docs.columns else F.lit("")

    def found(w: Column) -> Column:
        """(word_no, value, rule, features) of every candidate."""
        at = lambda i: F.coalesce(F.get(w, i), F.lit(""))
        long = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (F.octet_length(F.get(w, i)) >= 12) & F.get(w, i).rlike(RUN))
        cut_out = F.flatten(F.transform(long, lambda i: F.transform(candidates(F.get(w, i)), lambda v: F.struct(i.alias("i"), v.alias("value")))))

        def described(c: Column) -> Column:
            before = F.concat(at(c["i"] - 2), F.lit(" "), at(c["i"] - 1))
            kind = F.coalesce(*[F.when(c["value"].rlike(f"^{p}$"), F.lit(k)) for k, p in KNOWN.items()], F.lit("key"))
            return F.struct(c["i"].alias("word_no"), c["value"].alias("value"), kind.alias("rule"), _features(c["value"], at(c["i"]), before, at(c["i"] + 1), where).alias("f"))

        return F.transform(cut_out, described)

    shaped = F.coalesce(F.col(text).rlike(RUN), F.lit(False))
    raw = F.when(shaped, let(words_of(F.col(text)), lambda w: F.when(F.size(w) > 0, found(w))))
    out = docs.withColumn(name, raw)
    quoted = f"`{name}`"
    scored = f"transform({quoted}, c -> named_struct('word_no', c.word_no, 'value', c.value, 'rule', c.rule, 'score', {score_sql(forest, 'c.f')}))"
    none = F.array().cast("array<struct<word_no:int,value:string,rule:string,score:double>>")
    secrets = F.coalesce(F.expr(f"filter({scored}, s -> s.score >= {float(cut)!r}D)"), none)
    blocks = F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(KEY_BLOCK), F.lit(0)), lambda b: F.struct(F.lit(None).cast("int").alias("word_no"), b.alias("value"), F.lit("private_key").alias("rule"), F.lit(1.0).alias("score")))
    blocks = F.when(F.contains(F.col(text), F.lit("PRIVATE KEY-----")), blocks).otherwise(none)
    return out.withColumn(name, F.concat(secrets, blocks))


def scan(docs: DataFrame, forest: list | None = None, key: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """(doc_id, word_no, rule, n_chars, value_sha256, score) of every secret; the value itself is not shown."""
    name = free_name(docs, "_secrets")
    hits = with_findings(docs, name, forest, text, path).select(F.col(key).alias("doc_id"), F.explode(name).alias("s"))
    return hits.select("doc_id", "s.word_no", "s.rule", F.char_length("s.value").cast("long").alias("n_chars"), F.sha2("s.value", 256).alias("value_sha256"), "s.score")


def redact(docs: DataFrame, forest: list | None = None, text: str = "text", path: str | None = "source") -> DataFrame:
    """docs with every secret replaced by MARK, other columns unchanged but n_chars, which is counted anew."""
    name = free_name(docs, "_secrets")
    values = F.array_distinct(F.transform(F.col(name), lambda s: s["value"]))
    longest = F.array_sort(values, lambda a, b: F.char_length(b) - F.char_length(a))
    cleaned = F.aggregate(longest, F.col(text), lambda acc, v: F.replace(acc, v, F.lit(MARK)))
    out = with_findings(docs, name, forest, text, path).withColumn(text, F.when(F.size(name) > 0, cleaned).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(name) > 0, F.char_length(text).cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return out.drop(name)


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
