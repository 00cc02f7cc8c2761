"""Secret scans: pattern candidates, then a random forest that removes false positives.

Candidates are runs of 16 or more key-like characters with a digit, of any
length, and after a credential word with its sign (``token = "..."``,
``password:``, ``DB_PASSWORD=``) runs of any length with or without digits. A
value ends at the first character that is none of ``A-Z a-z 0-9 _ + / = -``. Each gets features of its length, its character transitions,
how much of it dictionary words cover, its path and its neighbouring words. A
random forest, trained from labelled findings, decides which are secrets.

Only built-in functions run. The fitted trees are written out as one column
expression, so candidates are found, judged and masked inside the row: nothing
is joined or shuffled, and a text with many candidates stays one row.

Null and empty texts have no candidates. A null path counts as empty. Repeated
rows give repeated findings, and equal candidates of one text are separate
findings with the same features only if their neighbours are the same. An empty
table gives no rows. Extra columns are ignored by ``scan`` and kept by ``mask``,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.support import let, text_column, unused

TREES = 20
DEPTH = 6
SEED = 7
THRESHOLD = 0.5
# The forest is fitted on at most so many labelled findings, chosen by hash.
MAX_FINDINGS = 20_000
MASK = "[SECRET]"

# Words that name credentials, words that name harmless digests and ids, and
# pieces of ordinary identifiers.
KEY_WORDS = ("token", "password", "passwd", "pwd", "secret", "apikey", "api_key", "key", "auth", "bearer",
             "credential", "access")
HARMLESS_WORDS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "hash", "digest", "revision", "uuid",
                  "etag", "build", "version", "example")
DICTIONARY = ("test", "example", "sample", "dummy", "placeholder", "default", "change", "your", "name", "value",
              "file", "path", "http", "html", "index", "page", "user", "data", "item", "class", "function", "public",
              "static", "config", "server", "client", "license", "version", "number", "table", "column", "string")
# Words that follow a credential word and its sign without being its value.
PLAIN = ("the", "a", "of", "and", "is", "in", "see", "none", "null", "true", "false", "self", "required", "optional",
         "missing", "expired", "invalid", "hidden", "empty", "new", "this", "that", "what", "how", "Bearer", "Basic",
         "words", "people", "information", "access", "management", "important", "understanding", "communication")
TEST_PATHS = ("test", "example", "doc", "fixture", "sample")

# A candidate is a whole run of key characters: one of 16 or more with a digit, or any run that is the value
# of a credential word and its sign, before the run (token: "...") or at its head (token=...). The word
# before it (and what joins them) and the word after it come along. Every choice is made at the start of a
# run and looks at bounded text besides the run itself, which is matched without going back.
_KEY = r"[A-Za-z0-9_+/=\-]"
_CREDENTIAL = rf"(?i:{'|'.join(KEY_WORDS)})[A-Za-z0-9_\-]{{0,12}}"
_HEAD = rf"[A-Za-z0-9_\-]{{0,40}}{_CREDENTIAL}"
_SIGNED = (r"(?<=[=:]>?[ \t]{0,8}[\"']?)" rf"(?<={_CREDENTIAL}[\"']?[ \t]{{0,8}}[=:]>?[ \t]{{0,8}}[\"']?)"
           rf"|(?<={_CREDENTIAL}[\"']?[ \t]{{1,8}})(?==[A-Za-z0-9_+/\-])|(?={_HEAD}=+[A-Za-z0-9_+/\-])")
CANDIDATE = (rf"(?<!{_KEY})(?:(?=[A-Za-z_+/=\-]*+[0-9]){_KEY}{{16,}}+|(?:{_SIGNED})"
             rf"(?==*[A-Za-z0-9_+/\-]){_KEY}++)")
# What may stand before the value in the same run: a name and its sign, or the sign alone.
ASSIGNMENT = rf"^([A-Za-z_\-]{{2,40}}|{_HEAD}|)=(=*[^=].*)$"

FEATURES = ("length", "digit_share", "upper_share", "distinct_share", "switches", "letter_digit", "hex_only",
            "vowel_share", "longest_word", "coverage", "test_path", "key_before", "harmless_before", "sign_before",
            "known_prefix")


def _any(words: tuple[str, ...]) -> str:
    return "(?i)(?:^|[^a-z])(?:" + "|".join(words) + ")(?:[^a-z]|$)"


def _count(value: Column, pattern: str) -> Column:
    return F.call_function("regexp_count", value, F.lit(pattern)).cast("double")


def features(candidate: Column, before: Column, after: Column, path: Column) -> list[Column]:
    """The numbers a finding is judged by, in the order of ``FEATURES``."""
    size = F.greatest(F.length(candidate), F.lit(1)).cast("double")
    words = F.regexp_extract_all(candidate, F.lit("[A-Za-z]+"), 0)
    covered = F.lit(0)
    for word in DICTIONARY:
        covered = covered + len(word) * F.when(F.lower(candidate).contains(word), 1).otherwise(0)
    distinct = F.size(F.array_distinct(F.split(F.lower(candidate), "")))
    near = F.concat(before, F.lit(" "), after)
    return [c.cast("double") for c in (
        F.length(candidate),
        _count(candidate, "[0-9]") / size,
        _count(candidate, "[A-Z]") / size,
        distinct / size,
        _count(candidate, "[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])") / size,
        _count(candidate, "[A-Za-z](?=[0-9])") / size,
        candidate.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        _count(candidate, "[aeiouAEIOU]") / size,
        F.coalesce(F.array_max(F.transform(words, F.length)), F.lit(0)) / size,
        F.least(covered / size, F.lit(1.0)),
        F.coalesce(path, F.lit("")).rlike(_any(TEST_PATHS)),
        before.rlike(_any(KEY_WORDS)),
        near.rlike(_any(HARMLESS_WORDS)),
        before.rlike("[=:][\\s\"']*$"),
        candidate.rlike("^(?:AKIA|ASIA|ghp_|gho_|xox[bpas]-|sk_live_|AIza|glpat-)"),
    )]


def candidates(text: Column) -> Column:
    """``array<struct<pos, candidate, before, after>>``: every candidate of a text, in order.

    The text is cut before each candidate; ``pos`` counts characters from 1. A
    name and sign at the head of a run (``password=...``) belong to ``before``.
    """
    def zipped(gaps: Column) -> Column:
        n = F.size(gaps) - 1
        return F.arrays_zip(F.regexp_extract_all(text, F.lit(CANDIDATE), 0).alias("run"),
                            F.slice(gaps, F.lit(1), n).alias("gap"), F.slice(gaps, F.lit(2), n).alias("next"))

    def finding(x: Column) -> Column:
        run, gap = x["run"], x["gap"]
        # null unless the run is an assignment, so that coalesce picks the form
        value = F.when(run.rlike(ASSIGNMENT), F.regexp_extract(run, ASSIGNMENT, 2))
        named = F.regexp_extract(run, ASSIGNMENT, 1)
        name = F.when(run.rlike(ASSIGNMENT), F.concat(
            F.when(named == "", F.right(gap, F.lit(39))).otherwise(named), F.lit("=")))
        return F.struct(
            (F.length(run) - F.length(F.coalesce(value, run))).alias("skip"), F.coalesce(value, run).alias("candidate"),
            F.coalesce(name, F.right(gap, F.lit(40))).alias("before"), F.left(x["next"], F.lit(40)).alias("after"))

    def starts(cut: Column) -> Column:
        """Where each run begins: the lengths of all gaps and runs before it."""
        return F.aggregate(
            cut, F.struct(F.lit(0).alias("end"), F.expr("array()").cast("array<int>").alias("at")),
            lambda s, x: F.struct((s["end"] + F.length(x["gap"]) + F.length(x["run"])).alias("end"),
                                  F.array_append(s["at"], s["end"] + F.length(x["gap"]) + 1).alias("at")))["at"]

    def placed(cut: Column) -> Column:
        return F.zip_with(F.transform(cut, finding), starts(cut), lambda x, start: F.struct(
            (start + x["skip"]).alias("pos"), x["candidate"].alias("candidate"), x["before"].alias("before"),
            x["after"].alias("after")))

    # most texts have none: they skip the cutting
    return F.when(text.rlike(CANDIDATE), let(let(F.split(text, CANDIDATE), zipped), placed)).otherwise(
        F.expr("array()").cast("array<struct<pos:int,candidate:string,before:string,after:string>>"))


def labelled_findings(spark: SparkSession, n: int = 6_000) -> DataFrame:
    """A labelled table of findings: candidate, before, after, path, is_secret.

    Half are credentials in the forms they are seen in (random hex, base64 and
    prefixed keys after a credential word, short and digit-free values behind a sign,
    tokens of hundreds of characters), half are what scanners mistake for
    them: digests and revisions, UUIDs, identifiers made of words, long numbers,
    fill-in values and keys of test files, plain words behind a credential word and
    its sign, long paths. Values come from hashes of the row number.
    """
    row = spark.range(n).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(9)).alias("kind"), (F.col("id") % 2 == 0).alias("is_secret"),
        F.sha2(F.col("id").cast("string"), 256).alias("hex"),
        F.base64(F.sha2((F.col("id") + 7).cast("string"), 256).cast("binary")).alias("b64"))
    pick = lambda values, salt: F.element_at(F.array(*[F.lit(v) for v in values]), (1 + F.pmod(
        F.xxhash64("id", F.lit(salt)), F.lit(len(values)))).cast("int"))
    key = pick(("token = \"", "password=", "secret: ", "api_key = '", "auth: ", "access key ", "bearer ", ""), 1)
    calm = pick(("commit ", "sha256: ", "checksum = ", "uuid ", "revision ", "see ", "etag: ", "of the "), 2)
    word = lambda salt: pick(DICTIONARY, salt)
    base36 = F.upper(F.conv(F.substring("hex", 1, 14), 16, 36))
    signed = pick(("token = \"", "password=", "secret: ", "api_key = '", "auth: ", "DB_PASSWORD=", "pwd: ", "\"token\": \""), 13)
    digits = F.translate("b64", "0123456789", "QxWvZkJqGf")
    more = F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(3) + F.pmod("id", F.lit(9)).cast("int")), lambda k: F.rtrim(F.base64(
        F.sha2(F.concat("hex", k.cast("string")), 256).cast("binary")), F.lit("="))), F.lit(""), lambda a, x: F.concat(a, x))
    secret = (F.when(F.col("kind") == 0, F.left("hex", F.lit(40))).when(F.col("kind") == 1, F.left("hex", F.lit(18)))
              .when(F.col("kind") == 2, F.concat(F.lit("AKIA"), F.rpad(F.concat(base36, F.upper(F.conv(
                  F.substring("hex", 15, 10), 16, 36))), 16, "7")))
              .when(F.col("kind") == 3, F.substring("b64", 3, 32)).when(F.col("kind") == 4, F.left("hex", F.lit(32)))
              .when(F.col("kind") == 6, F.substring("b64", 9, F.lit(6) + F.pmod("id", F.lit(10)).cast("int")))
              .when(F.col("kind") == 7, F.substring(digits, 9, F.lit(8) + F.pmod("id", F.lit(25)).cast("int")))
              .when(F.col("kind") == 8, more)
              .otherwise(F.concat(F.lit("ghp_"), F.substring("b64", 5, 36))))
    plain = pick((*DICTIONARY, *PLAIN), 14)
    harmless = (F.when(F.col("kind") == 0, F.left("hex", F.lit(40))).when(F.col("kind") == 1, F.col("hex"))
                .when(F.col("kind") == 2, F.concat_ws("-", F.substring("hex", 1, 8), F.substring("hex", 9, 4),
                                                      F.substring("hex", 13, 4), F.substring("hex", 17, 4),
                                                      F.substring("hex", 21, 12)))
                .when(F.col("kind") == 3, F.concat_ws("_", word(3), word(4), word(5), F.pmod("id", F.lit(100)).cast("string")))
                .when(F.col("kind") == 4, F.lpad(F.conv(F.substring("hex", 1, 13), 16, 10), 16, "4"))
                .when(F.col("kind") == 6, plain)
                .when(F.col("kind") == 7, F.concat(word(15), F.initcap(word(16)), F.when(F.col("id") % 3 == 0, F.initcap(word(17))).otherwise("")))
                .when(F.col("kind") == 8, F.concat_ws("/", *[word(k) for k in range(20, 70)], F.pmod("id", F.lit(1000)).cast("string")))
                .otherwise(F.concat(word(6), F.lit("-"), word(7), F.lit("-"), word(8), F.lit("-000"))))
    before = F.when(F.col("is_secret"), F.when(F.col("kind").isin(2, 5), pick(("of ", "key: ", "in ", "id = \""), 9))
                    .when(F.col("kind").isin(6, 7), signed).otherwise(F.when(key == "", "token=").otherwise(key)))
    before = before.otherwise(F.when(F.col("kind").isin(3, 5), pick(("token = ", "password=", "in ", "see "), 10))
                              .when(F.col("kind").isin(6, 7), signed).otherwise(calm))
    return row.select(
        F.when(F.col("is_secret"), secret).otherwise(harmless).alias("candidate"), before.alias("before"),
        pick(("\"", " and", "\n", " the", "'"), 11).alias("after"),
        pick(("src0", "src/main", "web", "docs/example", "tests/fixtures"), 12).alias("path"), "is_secret")


def fit_forest(findings: DataFrame, trees: int = TREES, depth: int = DEPTH):
    """A random forest on the features of labelled findings (null labels are left out)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    bounded = (findings.where("is_secret IS NOT NULL AND candidate IS NOT NULL")
               .orderBy(F.xxhash64("candidate", "before", "after", "path")).limit(MAX_FINDINGS))
    rows = bounded.select(F.col("is_secret").cast("double").alias("label"), *[
        c.alias(name) for name, c in zip(FEATURES, features(
            F.col("candidate"), F.coalesce("before", F.lit("")), F.coalesce("after", F.lit("")), F.col("path")))])
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="sqrt",
                                  subsamplingRate=0.8).fit(vectors)


def forest_expression(model, values: list[Column]) -> Column:
    """The forest's probability of a secret as one column: nested conditions, averaged over the trees."""

    def node_of(node) -> Column:
        if node.numDescendants() == 0:
            counts = [node.impurityStats().stats()[k] for k in range(2)]
            return F.lit(float(counts[1] / max(sum(counts), 1e-9)))
        split = node.split()
        return F.when(values[split.featureIndex()] <= float(split.threshold()), node_of(node.leftChild())).otherwise(
            node_of(node.rightChild()))

    votes = [node_of(tree._call_java("rootNode")) for tree in model.trees]
    total = votes[0]
    for vote in votes[1:]:
        total = total + vote
    return total / len(votes)


def findings_of(text: Column, path: Column, model) -> Column:
    """``array<struct<pos, candidate, before, after, score>>`` of one row.

    The features of a candidate are computed once, as an array that the trees look into.
    """
    valued = F.transform(candidates(text), lambda c: F.struct(c.alias("c"), F.array(*features(
        c["candidate"], c["before"], c["after"], path)).alias("f")))
    return F.transform(valued, lambda v: F.struct(
        v["c"]["pos"].alias("pos"), v["c"]["candidate"].alias("candidate"), v["c"]["before"].alias("before"),
        v["c"]["after"].alias("after"),
        forest_expression(model, [v["f"][k] for k in range(len(FEATURES))]).alias("score")))


def scan(documents: DataFrame, findings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every candidate: doc_id, pos, length, candidate, neighbours, score, is_secret."""
    model = fit_forest(findings)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(documents).alias("text"),
                            F.col("source").cast("string").alias("path"))
    found = rows.select("doc_id", F.inline(findings_of(F.col("text"), F.col("path"), model)))
    return found.select("doc_id", "pos", F.length("candidate").alias("length"), "candidate", "before", "after",
                        F.round("score", 6).alias("score"), (F.col("score") >= threshold).alias("is_secret"))


def mask(documents: DataFrame, findings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` with every secret replaced by ``MASK``; rows and columns stay, ``n_chars`` follows."""
    model, name = fit_forest(findings), unused(documents, "__secrets")
    path, text = F.coalesce(F.col("source").cast("string"), F.lit("")), F.col("text").cast("string")
    secrets = F.filter(findings_of(text_column(documents), path, model), lambda x: x["score"] >= threshold)

    # where they stand: a short value may be part of other words, so it is masked in its places only
    def piece(s: Column, x: Column) -> Column:
        return F.struct(F.concat(s["done"], F.substring(text, s["at"], x["pos"] - s["at"]), F.lit(MASK)).alias("done"),
                        (x["pos"] + F.length(x["candidate"])).alias("at"))

    cut = F.aggregate(F.col(name), F.struct(F.lit("").alias("done"), F.lit(1).alias("at")), piece,
                      lambda s: F.concat(s["done"], F.substring(text, s["at"], F.length(text))))
    long = F.array_distinct(F.transform(F.filter(F.col(name), lambda x: (F.length(x["candidate"]) >= 16)
                                                 & x["candidate"].rlike("[0-9]")), lambda x: x["candidate"]))
    # the others also wherever else they are found; longer ones first, so that no secret is cut by another one inside it
    ordered = F.array_sort(long, lambda a, b: F.length(b) - F.length(a))
    masked = F.aggregate(ordered, cut, lambda t, s: F.replace(t, s, F.lit(MASK)))
    changed = (documents.withColumn(name, secrets)
               .withColumn("text", F.when(F.size(name) > 0, masked).otherwise(F.col("text"))))
    if "n_chars" in documents.columns:
        changed = changed.withColumn("n_chars", F.when(F.size(name) > 0, F.length("text")).otherwise(
            F.col("n_chars")).cast(documents.schema["n_chars"].dataType))
    return changed.select(documents.columns)
