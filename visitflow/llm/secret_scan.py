"""Secret scan: long runs of letters and digits, and values of telling names, judged by a random forest that
removes false positives.

A candidate is a run of at least LEAST characters that keys and tokens are made of, or the whole value, of any
length and alphabet, that is assigned to a telling name: what stands between quotes, or else up to white space
without closing marks. A value that is one run is that run's candidate only. The forest sees a candidate's
length, its character transitions (changes between lower case, capitals and digits, and how usual its letter
pairs and triples are), its dictionary coverage (triples that common words have), the path or
source of the document, and the neighbouring words. It is trained from labelled findings: rows of
candidates with a label. The registered query takes them from `known_findings`: 1 for what has the form of
a key by itself (`certain`) or is assigned to a name such as password, 0 for what is known to be harmless
(words that the corpus's common words cover, numbers with a Luhn digit, hashes in trial paths). All others, and
those with both signs, have no label: no fit sees them, and the forest decides. So that it does not only
repeat the rule, each labelled secret is also shown without its name and assignment. A candidate of a
certain form is a secret whatever its score. Users pass their own reviewed findings instead.

All statistics of the corpus come from all documents: words are counted by documents, and the counts of letter
triples (at most 26 ** 3 rows) follow from them. The fit uses at most MAX_LABELLED findings of each label,
those with the smallest hashes, and the copies just named. Everything runs as DataFrame operations.

Defined cases: null and empty texts have no candidates. Missing or null paths are empty. Repeated rows have their
own findings. If all reviewed labels are alike, the score is that label. Without both of `known_findings`'s labels
there is nothing to learn from: the score is a candidate's own label, or 0. An empty table gives no findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.llm import shared

LEAST = 16
RUN = f"[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}"
#: Documents that a word must be in to count as a dictionary word.
COMMON = 5
MAX_LABELLED = 20_000
MASK = "[SECRET]"
#: Values that are masked in all of a text: no words of prose.
TELLS = "^(?=.*[^A-Za-z])\\S{8,}$"
#: Names that secrets are assigned to, and formats of providers' keys.
NAMES = "(?i)(passw|passphrase|pwd|secret|token|api.?key|credential|private.?key)"
#: A telling name and its assignment, up to the value; then the value with its quotes.
HEAD = f"(?:{NAMES})[\\w.-]*+[\"'`\\]]{{0,2}}\\s*+(?-i:=>|:=|={{1,3}}|:)\\s*+"
VALUE = HEAD + (
    "(?:\"[^\\n]+?(?<!\\\\)\"|'[^\\n]+?(?<!\\\\)'|`[^\\n]+?`"
    "|[\"'`]?[^\\s\"'`]\\S*?(?=[\"'`,;.)}\\]>]{0,8}(?:\\s|\\z)))"
)
FORMATS = (
    "(?<![A-Za-z0-9])((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}"
    "|npm_[A-Za-z0-9]{36}|[sr]k_(live|test)_[A-Za-z0-9]{16,}|whsec_[A-Za-z0-9]{24,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    "|AIza[0-9A-Za-z_-]{35}|hf_[A-Za-z0-9]{34}|dop_v1_[0-9a-f]{64}|shp(at|ss|ca)_[0-9a-f]{32}|pypi-[A-Za-z0-9_-]{50,}"
    "|sk-(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{32,})(?![A-Za-z0-9])"
)
#: Web tokens are three parts with dots between; the first two are JSON in base64. Keys in PEM stand between two lines.
JWT_PART, JWT_LEAD = "^eyJ[A-Za-z0-9_-]+$", "eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.$"
INK = "[^\\x20\\x09-\\x0D]"
PEM = "(?s)-----BEGIN [A-Z ]*PRIVATE KEY[A-Z ]*-----(.*?)(?:-----END|\\z)"
HASH = "^([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{128})$"
#: Share of a word's triples that common words have, from which it counts as covered.
COVERED = 0.8
TRIAL_PATH = "(?i)(test|example|sample|mock|fixture|demo)"
FEATURES = (
    "length", "changes", "digits", "capitals", "distinct", "hex", "pair_log", "triple_log", "coverage", "letters",
    "path_depth", "path_trial", "named", "assigned", "quoted", "before_letters", "after_letters",
)


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """Rows (doc_id, path, word_index, part, candidate, lead, before2, before, after, in_key, text_key) of all texts.

    word_index is the place of the word in which the candidate begins. part numbers the runs of a word from 0 and
    the values of a text from -1 downwards.
    """
    return _runs(docs, path).unionByName(_values(docs, path))


def _row(docs: DataFrame, path: str) -> list[Column]:
    where = F.col(f"`{path}`").cast("string") if path in docs.columns else F.lit("")
    keys = F.when(F.contains("text", F.lit("PRIVATE KEY")), F.regexp_extract_all("text", F.lit(PEM), F.lit(1)))
    return [
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(where, F.lit("")).alias("path"), keys.alias("_keys"),
        F.xxhash64("text").alias("text_key"),
    ]


def _in_key(found: DataFrame) -> DataFrame:
    inside = F.exists("_keys", lambda k: F.contains(k, F.col("candidate")))
    return found.withColumn("in_key", F.coalesce(inside, F.lit(False))).drop("_keys")


def _runs(docs: DataFrame, path: str) -> DataFrame:
    words = shared.words_of(F.col("text"))

    def spots(w: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i).rlike(RUN))
        return F.transform(
            at,
            lambda i: F.struct(
                i.alias("word_index"), F.get(w, i).alias("word"), F.get(w, i - 2).alias("before2"),
                F.get(w, i - 1).alias("before"), F.get(w, i + 1).alias("after"),
            ),
        )

    hits = docs.where(F.col("text").rlike(RUN)).select(*_row(docs, path), F.inline(F.transform(F.array(words), spots)[0]))
    runs = hits.select("*", F.posexplode(F.regexp_extract_all("word", F.lit(f"({RUN})"), F.lit(1))).alias("part", "candidate"))
    lead = F.expr("substring(word, 1, locate(candidate, word) - 1)")
    return _in_key(runs.withColumn("lead", lead).drop("word"))


def _assignments(text: Column) -> tuple[Column, Column]:
    """The pieces of a text around its assignments to telling names, and the assignments (one fewer)."""
    return F.split(text, VALUE, -1), F.regexp_extract_all(text, F.lit(VALUE), F.lit(0))


def _head(assignment: Column) -> Column:
    """An assignment up to its value, with the opening quote."""
    return F.regexp_extract(assignment, f"^{HEAD}[\"'`]?", 0)


def _value(assignment: Column) -> Column:
    head = _head(assignment)
    rest = F.substring(assignment, F.length(head) + 1, F.length(assignment))
    closed = head.rlike("[\"'`]$") & (F.right(rest, F.lit(1)) == F.right(head, F.lit(1)))
    return F.when(closed, F.substring(rest, F.lit(1), F.length(rest) - 1)).otherwise(rest)


def _values(docs: DataFrame, path: str) -> DataFrame:
    assigns = (F.contains("text", F.lit("=")) | F.contains("text", F.lit(":"))) & F.col("text").rlike(VALUE)
    pieces, hits = _assignments(F.col("text"))
    rows = docs.where(assigns).select(
        *_row(docs, path), shared.words_of(F.col("text")).alias("_words"), pieces.alias("_pieces"), hits.alias("_hits")
    )
    # Segments in turn: text up to a value, the value with what closes it, and so on. A word begins where white space
    # or the text's begin is before it; a segment that goes on with a word has one begin fewer.
    segments = F.flatten(
        F.transform(
            "_hits",
            lambda h, k: F.array(
                F.concat(F.get("_pieces", k), _head(h)), F.substring(h, F.length(_head(h)) + 1, F.length(h))
            ),
        )
    )
    starts = F.transform("_segments", lambda s: F.regexp_count(s, F.lit(f"(?<!{INK}){INK}")))
    goes_on = F.transform(
        "_segments",
        lambda s, k: ((k > 0) & F.get("_segments", k - 1).rlike(f"{INK}\\z") & s.rlike(f"^{INK}")).cast("int"),
    )
    own = F.zip_with(starts, goes_on, lambda n, m: n - m)
    sums = F.aggregate(own, F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))
    rows = rows.withColumn("_segments", segments).withColumn("_sums", sums)
    spots = F.transform(
        "_hits",
        lambda h, k: F.struct(
            (F.get("_sums", 2 * k + 1) - F.get("_segments", 2 * k).rlike(f"{INK}\\z").cast("int")).alias("word_index"),
            (-1 - k).alias("part"), _value(h).alias("candidate"),
            F.regexp_extract(F.get("_segments", 2 * k), f"{INK}*\\z", 0).alias("lead"),
        ),
    )
    found = rows.select("doc_id", "path", "_keys", "text_key", "_words", F.inline(spots))
    i, last = F.col("word_index"), F.size(shared.words_of(F.concat("lead", "candidate")))
    near = {"before2": F.get("_words", i - 2), "before": F.get("_words", i - 1), "after": F.get("_words", i + last)}
    return _in_key(found.where(~F.col("candidate").rlike(f"^{RUN}\\z")).withColumns(near).drop("_words"))


def letter_statistics(docs: DataFrame) -> DataFrame:
    """Rows (triple, n, common): how often words have a triple, weighted by documents, and in common words."""
    own = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0)))
    words = docs.select(F.explode(own).alias("word")).groupBy("word").agg(F.count("*").alias("docs"))
    triples = F.transform(F.sequence(F.lit(1), F.length("word") - 2), lambda i: F.substring("word", i, F.lit(3)))
    return words.select("docs", F.explode(triples).alias("triple")).groupBy("triple").agg(
        F.sum("docs").alias("n"), F.max(F.col("docs") >= COMMON).cast("double").alias("common")
    )


def known_findings(rows: DataFrame) -> DataFrame:
    """Described candidates with a label: 1 for secrets, 0 for what is harmless, null where neither is known."""
    c = F.col("candidate")
    harmless = (
        (c.rlike("^[A-Za-z]+$") & (F.col("coverage") >= COVERED))
        | (c.rlike("^[0-9]{13,19}$") & F.expr("luhn_check(candidate)"))
        | (c.rlike(HASH) & (F.col("path_trial") == 1))
    )
    telling = _named() & _assigned()
    label = F.when(certain() | (telling & ~harmless), 1.0).when(harmless & ~telling, 0.0)
    return rows.withColumn("label", label)


def certain() -> Column:
    """Candidates that are secrets by their form: keys of providers and in PEM, web tokens, bearer tokens."""
    c = F.col("candidate")
    web = c.rlike(JWT_PART) | F.col("lead").rlike(JWT_LEAD)
    bearer = F.concat_ws(" ", "before", "lead").rlike("(^|[\\s\"'`:=])Bearer\\s*[\"'`]?$") & c.rlike("[0-9]")
    return c.rlike(FORMATS) | web | F.col("in_key") | bearer


def _near() -> Column:
    return F.concat_ws(" ", "before2", "before", "lead")


def _named() -> Column:
    return _near().rlike(NAMES)


def _assigned() -> Column:
    return F.concat_ws(" ", "before", "lead").rlike("([:=]|=>)\\s*[\"'`]?$")


def described(found: DataFrame, letters: DataFrame) -> DataFrame:
    """Candidates with FEATURES, all of them doubles."""
    c = F.col("candidate")
    size = F.length(c)

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / size

    plain = found.withColumns(
        {
            "_id": F.xxhash64("doc_id", "word_index", "part", "candidate", "path"),
            "length": size.cast("double"),
            "changes": share("(?<=[a-z])(?![a-z])|(?<=[A-Z])(?![A-Z])|(?<=[0-9])(?![0-9])"),
            "digits": share("[0-9]"),
            "capitals": share("[A-Z]"),
            "distinct": F.size(F.array_distinct(F.split(c, ""))) / size,
            "hex": share("[0-9a-f]"),
            "letters": share("[A-Za-z]"),
            "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
            "path_trial": F.col("path").rlike(TRIAL_PATH).cast("double"),
            "named": _named().cast("double"),
            "assigned": _assigned().cast("double"),
            "quoted": F.col("lead").rlike("[\"'`]$").cast("double"),
            "before_letters": F.coalesce(F.col("before").rlike("^\\p{L}+[.,;:]?$").cast("double"), F.lit(0.0)),
            "after_letters": F.coalesce(F.col("after").rlike("^\\p{L}+[.,;:]?$").cast("double"), F.lit(0.0)),
        }
    )
    triples = F.transform(F.sequence(F.lit(1), F.greatest(size - 2, F.lit(1))), lambda i: F.substring(F.lower(c), i, F.lit(3)))
    pairs = letters.groupBy(F.substring("triple", 1, 2).alias("pair")).agg(F.sum("n").alias("pair_n"))
    table = letters.withColumn("pair", F.substring("triple", 1, 2)).join(pairs, "pair")
    looked = (
        plain.select("_id", F.explode(triples).alias("triple")).distinct().join(table, "triple", "left")
        .groupBy("_id").agg(
            F.avg(F.log1p(F.coalesce("n", F.lit(0)))).alias("triple_log"),
            F.avg(F.log1p(F.coalesce("pair_n", F.lit(0)))).alias("pair_log"),
            F.avg(F.coalesce("common", F.lit(0.0))).alias("coverage"),
        )
    )
    return plain.join(looked, "_id")


def scan(docs: DataFrame, path: str = "source", findings: DataFrame | None = None, seed: int = 7) -> DataFrame:
    """Rows (doc_id, text_key, word_index, part, candidate, label, score, is_secret) of all candidates.

    findings: candidates with a label (null for none), by default `known_findings` of these documents.
    """
    letters = shared.stored(letter_statistics(docs), "letters")
    found = shared.stored(candidates(docs, path), "candidates")
    rows = shared.stored(known_findings(described(found, letters)), "described")
    known = rows if findings is None else described(findings, letters)
    order = [F.xxhash64("candidate", "_id"), "candidate", "_id"]
    columns = ["label", *FEATURES]
    sample = shared.stored(
        known.where("label = 1").orderBy(*order).limit(MAX_LABELLED).select(columns)
        .unionByName(known.where("label = 0").orderBy(*order).limit(MAX_LABELLED).select(columns)),
        "labelled",
    )
    if findings is None:
        bare = sample.where("label = 1").withColumns({"named": F.lit(0.0), "assigned": F.lit(0.0)})
        sample = sample.unionByName(bare)
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    seen = sorted(sizes)
    if len(seen) < 2:
        own = F.coalesce("label", F.lit(0.0)) if findings is None else F.lit(seen[0] if seen else 0.0)
        return _judged(rows.withColumn("score", own))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_prediction", weightCol="_weight", numTrees=30, maxDepth=6, featureSubsetStrategy="sqrt", seed=seed,
    )
    weight = F.when(F.col("label") == 1, 0.5 / sizes[1.0]).otherwise(0.5 / sizes[0.0])  # both labels weigh the same
    total = sum(sizes.values())
    model = forest.fit(vectors.transform(sample).withColumn("_weight", weight * total))
    return _judged(model.transform(vectors.transform(rows)).withColumn("score", vector_to_array("_probability")[1]))


def _judged(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", "text_key", "word_index", "part", "candidate", F.col("label").cast("int").alias("label"), "score",
        ((F.col("score") >= 0.5) | certain()).alias("is_secret"),
    )


def masked(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with each secret's characters replaced by MASK; other texts stay as they are.

    A row is met by its doc_id, null or not, and its text, so rows without or with the same id have their own secrets.
    Values are masked where they are assigned, and those that match TELLS in all of the text, as runs are.
    """
    anywhere = (F.col("part") >= 0) | F.col("candidate").rlike(TELLS)
    secrets = (
        found.where("is_secret").groupBy(F.col("doc_id").alias("_secret_doc"), F.col("text_key").alias("_secret_text"))
        .agg(
            F.array_sort(F.collect_set(F.when(anywhere, F.col("candidate"))), lambda a, b: F.length(b) - F.length(a)).alias("_secrets"),
            F.collect_set(F.when(F.col("part") < 0, F.col("candidate"))).alias("_values"),
        )
    )
    pieces, hits = _assignments(F.col("text"))
    hidden = F.transform(
        hits,
        lambda h: F.when(
            F.array_contains("_values", _value(h)),
            F.concat(
                _head(h), F.lit(MASK), F.substring(h, F.length(_head(h)) + F.length(_value(h)) + 1, F.length(h))
            ),
        ).otherwise(h),
    )
    parts = F.zip_with(pieces, hidden, lambda p, h: F.concat(p, F.coalesce(h, F.lit(""))))
    text = F.when(F.size("_values") > 0, F.array_join(parts, "")).otherwise(F.col("text"))
    clean = F.aggregate("_secrets", text, lambda t, s: F.replace(t, s, F.lit(MASK)))
    same = F.col("doc_id").eqNullSafe(F.col("_secret_doc")) & (F.xxhash64("text") == F.col("_secret_text"))
    joined = docs.join(secrets, same, "left")
    has = F.col("_secrets").isNotNull()
    out = joined.withColumn("text", F.when(has, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(has, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
