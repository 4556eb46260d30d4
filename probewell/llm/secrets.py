"""Secret scans: a random forest over candidates, applied inside each row. DataFrame functions only."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import save

#: What may be a secret: a long run of the letters that keys are written with, or a shorter value with a digit or a symbol that is
#: assigned to a password.
LONG = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
ASSIGNED = r"""(?<=[=:\s"'])(?<=(?i:password|passwd|passphrase|pwd)["']?\s{0,2}[=:]\s{0,2}["']?)(?=[^\s"'<>\\]{0,64}[0-9!@#$%^&*])[^\s"'<>\\]{5,63}[^\s"'<>\\.,;:)]"""
CANDIDATE = f"{LONG}|{ASSIGNED}"
#: Parts of the words that ``ASSIGNED`` asks for: a text without any of them is searched for long runs only.
PASSWORDS = ("passw", "passphrase", "pwd")
#: Characters from which a value is masked inside longer words, too.
UNMISTAKABLE = 16
TREES, DEPTH, FOREST_SEED = 24, 6, 7
#: Labelled findings that ``labelled_findings`` makes.
LABELLED = 6000
#: Share of trees from which a candidate counts as a secret.
THRESHOLD = 0.5
#: Characters of context on both sides.
CONTEXT = 32
MASK = "[SECRET]"
#: A name that no table has, for the numbers of the candidates.
_AROUND = "_around_2f6d1c"

# Frequent parts of words, words that stand by secrets, words that stand by harmless digests, key prefixes.
DICTIONARY = ("the", "and", "ing", "ion", "ent", "ati", "for", "her", "ter", "hat", "ere", "con", "res", "ver", "all", "ons", "nce", "men", "ith", "ted", "ers", "pro", "thi", "wit", "are", "ess", "not", "ive", "was", "ect", "rea", "com", "eve", "per", "int", "est", "sta", "cti", "ica", "ist", "ear", "ain", "one", "our", "iti", "rat", "ell", "ant", "que", "eau", "eux", "lle", "ich", "sch", "ung", "ein", "che", "keit", "heit", "cion", "ado", "mente", "dis", "un", "en", "on", "er", "in", "an", "re", "th", "es", "st", "nt", "ed", "or", "ou", "ha", "ti", "le", "de", "la", "is", "it")
SECRET_WORDS = "token|secret|passw|passphrase|pwd|credential|api.?key|access.?key|private.?key|auth|bearer|client.?key|signing"
HARMLESS_WORDS = "sha1|sha256|md5|commit|checksum|digest|uuid|guid|etag|hash|revision|build|version|example|sample|placeholder|card|phone|order|invoice|isbn|trace"
PREFIXES = "AKIA|ASIA|ghp_|gho_|ghs_|sk_live_|sk_test_|sk-|xoxb-|xoxp-|AIza|glpat-|npm_|rk_live_|eyJ"

NAMES = ("length", "transitions", "digits", "capitals", "dictionary", "paths", "secret_words", "assigned", "harmless_words", "variety", "prefix", "symbols")


def features(value: Column, left: Column, right: Column) -> list[Column]:
    """The numbers of a candidate and its neighbourhood, in the order of ``NAMES``."""
    n = F.length(value).cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "0"), "[a-z]+", "a"), "[A-Z]+", "A"), "[^0aA]+", "-")
    without = lambda pattern: n - F.length(F.regexp_replace(value, pattern, ""))
    known = n - F.length(F.regexp_replace(F.lower(value), "|".join(sorted(DICTIONARY, key=len, reverse=True)), ""))
    flag = lambda c: c.cast("double")
    return [
        n,
        (F.length(kinds) - 1) / n,
        without("[0-9]") / n,
        without("[A-Z]") / n,
        known / n,
        without("/") + flag(F.rlike(left, F.lit(r"(://|[\w.]/|\./|~/)\S*$"))) + flag(F.rlike(right, F.lit(r"^(/|\.\w{1,5}\b)"))),
        flag(F.rlike(left, F.lit(f"(?i)({SECRET_WORDS})"))),
        flag(F.rlike(left, F.lit("[=:]\\s*[\"']?$"))),
        flag(F.rlike(F.concat_ws(" ", left, right), F.lit(f"(?i)({HARMLESS_WORDS})"))),
        F.size(F.array_distinct(F.split(value, ""))) / F.sqrt(n),
        flag(F.rlike(value, F.lit(f"^({PREFIXES})"))),
        without(r"[+/_\-=]") / n,
    ]


def labelled_findings(spark: SparkSession, rows: int = LABELLED) -> DataFrame:
    """(before, value, after, label): findings of known kind, made from hashes. Half are secrets.

    Secrets are keys in the usual alphabets, most of them assigned to a telling name or with an issuer's prefix, and passwords. The
    others are what such scans wrongly report: long words, identifiers, paths, rules of dashes, card and phone
    numbers, commit ids, checksums, placeholders and masks, and paths and identifiers that stand behind a secret.
    """
    i = F.col("id")
    h = lambda k: F.md5(F.concat(i.cast("string"), F.lit(f"/{k}")).cast("binary"))
    number = lambda k, m: F.pmod(F.xxhash64(i, F.lit(k)), F.lit(m))
    pick = lambda k, *options: F.element_at(F.array(*[F.lit(o) if isinstance(o, str) else o for o in options]), (number(k, len(options)) + 1).cast("int"))
    hexes = F.concat(h(1), h(2))
    base64 = F.regexp_replace(F.base64(F.unhex(hexes)), "=", "")
    base32 = F.translate(F.upper(F.substring(F.concat(h(3), h(4)), 1, 40)), "0189", "KQWZ")
    mixed = F.translate(F.upper(base64), "+/", "47")
    size = lambda c, low, high: F.substring(c, F.lit(1), (number(5, high - low) + low).cast("int"))
    parts = lambda a, b: F.array_join(F.transform(F.sequence(F.lit(a), F.lit(b)), lambda j: F.element_at(F.array(*map(F.lit, DICTIONARY)), (F.pmod(F.xxhash64(i, j), F.lit(len(DICTIONARY))) + 1).cast("int"))), "")
    word = F.rpad(parts(1, 7), 16, "ationing")
    secret = pick(6, size(hexes, 16, 64), F.substring(hexes, 1, 40), size(hexes, 16, 24), size(base64, 20, 42), size(base64, 24, 42))
    issued = pick(7, F.concat(F.lit("AKIA"), F.substring(mixed, 1, 16)), F.concat(F.lit("AKIA"), F.substring(base32, 1, 16)), F.concat(pick(8, "ghp_", "sk_live_", "sk-", "xoxb-", "glpat-", "npm_"), size(base64, 24, 40)))
    named = F.concat(word.substr(1, 6), F.lit(" "), pick(9, "token", "password", "secret", "api_key", "apikey", "passwd", "access_key", "auth", "pwd", "client_secret"), pick(10, "=", " = ", ": ", ' = "', '="', ": '"))
    plain = F.concat(word.substr(1, 9), F.lit(" "), word.substr(5, 6), pick(11, " ", ". ", ", ", "\n"))
    digest = F.concat(word.substr(1, 5), F.lit(" "), pick(12, "commit ", "sha256:", "md5 = ", "checksum: ", "uuid ", "etag: ", "build ", "revision "))
    kind = F.pmod(i, F.lit(20))
    choose = lambda *cases: F.coalesce(*[F.when(kind == k, v) for k, v in enumerate(cases)])
    digits = F.translate(size(hexes, 16, 20), "abcdef", "123456")
    path = F.concat(word.substr(1, 7), F.lit("/"), word.substr(4, 8), F.lit("/"), word)
    rule = F.repeat(pick(13, "-", "=", "_", "+"), (number(14, 40) + 16).cast("int"))
    ident = F.concat(word.substr(1, 5), F.initcap(word.substr(3, 6)), F.initcap(word.substr(5, 8)))
    number_of = number(18, 100).cast("string")
    password = pick(19, F.concat(F.initcap(word.substr(1, 5)), number_of, F.lit("!")), F.concat(size(base64, 6, 14), F.lit("7")), F.concat(word.substr(2, 4), F.lit("#"), number_of, word.substr(7, 3)))
    called = F.concat(word.substr(1, 6), F.lit(" "), pick(20, "password", "passwd", "pwd", "passphrase", "Password"), pick(10, "=", " = ", ": ", ' = "', '="', ": '"))
    hidden = F.repeat(pick(21, "*", "x", "X", "0"), (number(22, 8) + 6).cast("int"))
    # what stands behind a secret is no secret for that
    folder = F.concat(pick(23, "/usr/", "/home/", "/var/", "src/", "C:/", "/"), F.lower(word.substr(1, 3)), pick(24, "", "3", "2.7"), F.lit("/"), word.substr(4, 6), pick(25, "/", "-", "_"), word.substr(2, 9), pick(26, "", "/main", "/index", "/foo"))
    beside = F.concat(pick(27, "token", "password", "secret", "api_key", "access_key", "auth"), pick(10, "=", " = ", ": ", ' = "', '="', ": '"), F.substring(base64, F.lit(1), (number(28, 14) + 3).cast("int")), pick(29, " and see ", " in ", ". ", ", ", '" from ', " at "))
    value = choose(secret, issued, secret, issued, secret, issued, secret, secret, password, password, word, digits, pick(17, F.substring(hexes, 1, 40), hexes, F.substring(hexes, 1, 32)), path, rule, ident, pick(16, F.initcap(word), F.upper(word)), F.lpad(F.lit(""), 20, "your_token_here_xxxx"), F.rpad(folder, 16, "ing/main"), pick(30, hidden, ident))
    before = choose(named, plain, named, plain, named, named, named, named, called, called, plain, plain, digest, F.concat(plain, F.lit("./")), plain, plain, plain, named, beside, F.when(number(30, 2) == 0, called).otherwise(beside))
    after = F.concat(pick(15, " ", '" ', ". ", "\n"), word.substr(2, 9))
    return spark.range(0, rows, 1, 4).select(before.alias("before"), value.alias("value"), after.alias("after"), (kind < 10).cast("double").alias("label"))


def train(findings: DataFrame) -> Callable[[list[Column]], Column]:
    """Fit the forest on (before, value, after, label) and return it as an expression: the share of trees that say secret."""
    table = findings.select("label", *[c.alias(n) for n, c in zip(NAMES, features(F.col("value"), F.col("before"), F.col("after")), strict=True)])
    table = save(table.coalesce(1), "findings")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=FOREST_SEED, labelCol="label", featuresCol="features", featureSubsetStrategy="sqrt")
    fitted = forest.fit(VectorAssembler(inputCols=list(NAMES), outputCol="features").transform(table).select("label", "features"))
    trees = [t.toDebugString.splitlines()[1:] for t in fitted.trees]

    def vote(lines: list[str], x: list[Column]) -> Column:
        line = lines.pop(0).strip()
        if line.startswith("Predict"):
            return F.lit(float(line.split(":")[1]))
        feature, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = vote(lines, x)
        lines.pop(0)
        return F.when(x[int(feature)] <= float(bound), low).otherwise(vote(lines, x))

    def share(x: list[Column]) -> Column:
        total = vote(list(trees[0]), x)
        for t in trees[1:]:
            total = total + vote(list(t), x)
        return total / len(trees)

    return share


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``findings``: array of (value, position, occurrences, score, is_secret), one for each candidate value.

    position is that of the first match (1-based, in characters). The forest sees the surroundings of every match, and
    score is the largest one: a value that is a secret in one place is one in all. occurrences counts all places of the value as
    redact masks them: those inside longer words too, but for values under 16 characters.
    ``findings`` are labelled ones to train from; without them those of ``labelled_findings`` are taken. Null and empty
    texts have no findings. A column findings is replaced, others stay; repeated rows get equal findings, in
    order of position. An empty table gives an empty result. Texts are scanned whole.
    """
    share = train(labelled_findings(docs.sparkSession) if findings is None else findings)
    text = F.coalesce(F.col("text"), F.lit(""))
    low = F.lower(text)
    assigned = F.contains(low, F.lit(PASSWORDS[0])) | F.contains(low, F.lit(PASSWORDS[1])) | F.contains(low, F.lit(PASSWORDS[2]))
    either = lambda search: F.when(assigned, search(CANDIDATE)).otherwise(search(LONG))
    values, gaps = either(lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0))), either(lambda p: F.split(text, p))

    def place(done: Column, f: Column) -> Column:
        start = done["next"] + F.length(f["gap"])
        return F.struct((start + F.length(f["value"])).alias("next"), F.concat(done["places"], F.array(start.cast("long"))).alias("places"))

    def located(found: Column) -> Column:
        """Candidates with their places and neighbourhoods, put together from what stands between the candidates."""
        v, g = found["values"], found["gaps"]
        pairs = F.zip_with(v, F.slice(g, F.lit(1), F.size(v)), lambda value, gap: F.struct(value.alias("value"), gap.alias("gap")))
        none = F.struct(F.lit(1).alias("next"), F.array().cast("array<bigint>").alias("places"))
        places = F.aggregate(pairs, none, place, lambda done: done["places"])

        def around(value: Column, k: Column) -> Column:
            # two candidates and the gaps between them: CONTEXT characters, but where short passwords stand close together
            at = lambda a, j: F.coalesce(F.get(a, k + j), F.lit(""))
            before = F.concat(F.right(at(g, -2), F.lit(CONTEXT)), at(v, -2), F.right(at(g, -1), F.lit(CONTEXT)), at(v, -1), F.right(at(g, 0), F.lit(CONTEXT)))
            after = F.concat(F.left(at(g, 1), F.lit(CONTEXT)), at(v, 1), F.left(at(g, 2), F.lit(CONTEXT)), at(v, 2), F.left(at(g, 3), F.lit(CONTEXT)))
            numbers = F.array(*features(value, F.right(before, F.lit(CONTEXT)), F.left(after, F.lit(CONTEXT))))
            return F.struct(value.alias("value"), F.lit(0).cast("long").alias("position"), numbers.alias("x"))

        return F.zip_with(F.transform(v, around), places, lambda f, p: F.struct(f["value"].alias("value"), p.alias("position"), f["x"].alias("x")))

    # an array of one binds what has been found, so that the text is searched once only, and only if it holds a candidate
    bound = F.transform(F.array(F.struct(values.alias("values"), gaps.alias("gaps"))), located)[0]
    around = F.when(either(lambda p: F.rlike(text, F.lit(p))), bound).otherwise(F.array())

    def judge(f: Column) -> Column:
        score = share([f["x"][k] for k in range(len(NAMES))])
        return F.struct(f["value"].alias("value"), f["position"].alias("position"), score.alias("score"))

    def merge(judged: Column) -> Column:
        def one(v: Column) -> Column:
            own = F.filter(judged, lambda f: f["value"] == v)
            inner = ((F.length(text) - F.length(F.replace(text, v, F.lit("")))) / F.length(v)).cast("long")
            occurrences = F.when(F.length(v) < UNMISTAKABLE, F.regexp_count(text, _alone(v)).cast("long")).otherwise(inner)
            score = F.array_max(F.transform(own, lambda f: f["score"]))
            return F.struct(v.alias("value"), own[0]["position"].alias("position"), occurrences.alias("occurrences"), score.alias("score"), (score >= THRESHOLD).alias("is_secret"))

        return F.transform(F.array_distinct(F.transform(judged, lambda f: f["value"])), one)

    findings = F.transform(F.array(F.transform(_AROUND, judge)), merge)[0]
    return docs.drop("findings").withColumn(_AROUND, around).withColumn("findings", findings).drop(_AROUND)


def redact(scanned: DataFrame) -> DataFrame:
    """``scanned`` with every occurrence of its secrets replaced by ``MASK`` in ``text``, longest values first; null texts stay.

    A value of less than 16 characters is only replaced where no letter or digit stands beside it.
    """
    secret = F.filter("findings", lambda f: f["is_secret"])
    longest = F.array_sort(F.transform(secret, lambda f: f["value"]), lambda a, b: F.length(b) - F.length(a))
    masked = lambda t, v: F.when(F.length(v) < UNMISTAKABLE, F.regexp_replace(t, _alone(v), F.lit(MASK))).otherwise(F.replace(t, v, F.lit(MASK)))
    return scanned.withColumn("text", F.aggregate(longest, F.col("text"), masked))


def _alone(value: Column) -> Column:
    """A pattern for the value without a letter or digit beside it; candidates hold no backslash."""
    return F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), value, F.lit(r"\E(?![A-Za-z0-9])"))


def op6_query(spark, sf_dir: str) -> DataFrame:
    """One row for each candidate value of a document; the value itself is given as its digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = scan(docs).select("doc_id", F.inline("findings"))
    return rows.select("doc_id", "position", F.length("value").cast("long").alias("n_chars"), "occurrences", F.sha2("value", 256).alias("value_sha256"), F.round("score", 6).alias("score"), "is_secret")
