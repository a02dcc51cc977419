"""Secrets in texts: candidates by form, false findings removed by a random forest.

A candidate is a long run of key letters in a word.  The forest sees its length,
how often it changes between kinds of letters, how much of it dictionary words
cover, whether it stands in a path or address, and the words beside it.  The
dictionary is made of the corpus: the words that most documents hold.  Finding,
describing and scoring are column expressions on the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import table
from tidemark.llm.registry import query
from tidemark.plans.joins import join_checked
from tidemark.plans.storage import stage

#: Shortest candidate, and size of the dictionary (a documented bound; ties by the word).
MIN_LENGTH, DICTIONARY_WORDS = 16, 5_000
#: Trees, their depth and the seed of the forest.
TREES, DEPTH, SEED = 40, 6, 7

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
# Words that name a secret, and that name something else.
NAMES_SECRET = r"(?i)(secret|token|passw|pwd|api.?key|apikey|auth|bearer|credential|private|access.?key)"
NAMES_OTHER = r"(?i)(commit|sha\d*|md5|checksum|digest|uuid|card|isbn|phone|order|invoice|image|file|href|src)"


def find_candidates(docs: DataFrame) -> DataFrame:
    """Candidates with their context: doc_id, word_no, candidate, word, before2, before1, after1.

    Words are what white space separates, numbered from 0.  A candidate has a
    digit or both letter cases, so that plain long words are none.
    """
    texts = docs.where(F.col("text").rlike(CANDIDATE)).select(
        "doc_id", F.split(F.col("text"), r"[\x20\x09-\x0D]+").alias("words"))

    def around(words: Column) -> Column:
        long = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("no"))),
                        lambda x: (F.char_length(x["word"]) >= MIN_LENGTH) & x["word"].rlike(CANDIDATE))
        return F.transform(long, lambda x: F.struct(
            x["no"].alias("word_no"), x["word"].alias("word"), F.get(words, x["no"] - 2).alias("before2"),
            F.get(words, x["no"] - 1).alias("before1"), F.get(words, x["no"] + 1).alias("after1")))

    # The outer transform has one element: it splits the text once for all words.
    found = F.transform(F.array(F.col("words")), around)[0]
    rows = texts.select("doc_id", F.inline(found))
    each = F.explode(F.array_distinct(F.regexp_extract_all("word", F.lit(f"({CANDIDATE})"))))
    mixed = F.col("candidate").rlike(r"\d") | (F.col("candidate").rlike("[a-z]") & F.col("candidate").rlike("[A-Z]"))
    return rows.withColumn("candidate", each).where(mixed)


def dictionary(docs: DataFrame, size: int = DICTIONARY_WORDS) -> DataFrame:
    """The words of 3 to 15 ASCII letters that most documents hold, counted over all documents."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(r"(?<![a-z])([a-z]{3,15})(?![a-z])")))
    return (docs.select(F.explode(words).alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "part").limit(size).select("part"))


def _changes(c: Column) -> Column:
    """How often neighbouring letters are of different kinds, a share of all neighbours."""
    kinds = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        c, "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d"), "+/_=-", "sssss")
    runs = F.char_length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    return (runs - 1) / (F.char_length(c) - 1)


def describe(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with ``features``; equal candidates share one look into the dictionary."""
    parts = (found.select("candidate").distinct().select("candidate", F.explode(F.regexp_extract_all(
        F.lower("candidate"), F.lit("([a-z]{3,})"))).alias("part")))
    known = join_checked(parts, words, ["part"]).groupBy("candidate").agg(
        F.sum(F.char_length("part")).alias("_covered"))
    c = F.col("candidate")
    near = F.concat_ws(" ", "before2", "before1", "word")
    share = lambda kind: (F.char_length(c) - F.char_length(F.regexp_replace(c, kind, ""))) / F.char_length(c)
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    features = [
        F.char_length(c).cast("double"), _changes(c), F.coalesce(F.col("_covered"), F.lit(0)) / F.char_length(c),
        flag(F.col("word").rlike(r"://|/.*/|^/|\.[A-Za-z]{2,4}\W*$")), flag(F.col("word").contains("@")),
        flag(near.rlike(NAMES_SECRET)), flag(near.rlike(NAMES_OTHER)), flag(near.rlike("[=:]\\s*[\"']?")),
        flag(F.col("word").rlike("^[\"'].*[\"']\\W?$")), share("[0-9]"), share("[A-Z]"), share("[^A-Za-z0-9]"),
        flag(F.col("after1").rlike(NAMES_OTHER)),
    ]
    return (join_checked(found, known, ["candidate"], "left")
            .withColumn("features", array_to_vector(F.array(*features))).drop("_covered"))


def labelled_findings(spark: SparkSession, rows: int = 900) -> DataFrame:
    """Labelled findings made by a rule: secrets as they are assigned, and look-alikes in their usual places."""
    n = F.col("id").cast("string")
    sha, md5 = F.sha1(n.cast("binary")), F.md5(n.cast("binary"))
    b64 = F.regexp_replace(F.base64(F.unhex(F.sha2(n.cast("binary"), 256))), "=+$", "")
    upper = F.upper(F.substring(sha, 1, 20))
    uuid = F.concat_ws("-", *[F.substring(md5, a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    digits = F.substring(F.regexp_replace(F.sha2(n.cast("binary"), 512), "[^0-9]", ""), 1, 16)
    long_word = F.concat(F.initcap(F.substring(F.regexp_replace(b64, "[^a-z]", ""), 1, 8)), F.lit("ThisThatWithFromWhichThere"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    secrets = [("token", "=", quoted(sha)), ("secret", "=", quoted(b64)), ("api_key", ":", F.substring(b64, 1, 32)),
               ("password", "=", quoted(F.substring(b64, 1, 20))), ("Authorization:", "Bearer", b64),
               ("export", F.concat(F.lit("AWS_SECRET_ACCESS_KEY="), F.substring(b64, 1, 40))),
               ("access", "key", F.concat(F.lit("AKIA"), F.substring(upper, 1, 16))),
               ("token:", F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(b64, "[+/]", "x"), 1, 36))),
               ("TOKEN", "=", F.upper(quoted(sha)))]
    others = [("commit", sha), ("the", "file", F.concat(F.lit("/static/"), md5, F.lit(".js"))),
              ("see", F.concat(F.lit("https://cdn.example.org/"), sha, F.lit("/index.html"))),
              ("paid", "with", digits), ("id", uuid), ("checksum", "sha256:", sha), ("and", "the", long_word),
              ("mail", F.concat(F.lit("anna.first-name-"), digits, F.lit("@mail.example.com"))),
              ("|", F.concat_ws("/", F.lit("data"), F.lit("Raw_files"), md5))]
    kinds = [(w, 1.0) for w in secrets] + [(w, 0.0) for w in others]
    text = F.element_at(F.array(*[F.concat_ws(" ", *[F.lit(x) if isinstance(x, str) else x for x in w], F.lit("then on"))
                                  for w, _ in kinds]), (F.col("id") % len(kinds) + 1).cast("int"))
    label = F.element_at(F.array(*[F.lit(y) for _, y in kinds]), (F.col("id") % len(kinds) + 1).cast("int"))
    return spark.range(rows).select(F.col("id").alias("doc_id"), text.alias("text"), label.alias("label"))


def fit(labelled: DataFrame, words: DataFrame) -> RandomForestClassificationModel:
    """A forest from labelled texts (doc_id, text, label): every candidate in a text has its label."""
    labels = labelled.select("doc_id", "label")
    rows = describe(find_candidates(labelled), words).join(labels, "doc_id").select("label", "features")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(stage(
        rows.withColumn("features", vector_to_array("features")), "secrets-train")
        .withColumn("features", array_to_vector("features")))


def scan_secrets(docs: DataFrame, labelled: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Every candidate: doc_id, word_no, candidate, before1, ``score`` and ``secret`` (score at the threshold or above).

    A null or empty text has no candidates; neither has an empty table.  Repeated
    rows give repeated findings.  Other columns of ``docs`` are not read.
    """
    words = stage(dictionary(docs), "secrets-dictionary")
    model = fit(labelled, words)
    found = stage(find_candidates(docs), "secrets-candidates")
    score = vector_to_array("probability")[1]
    return (model.transform(describe(found, words)).withColumn("score", score)
            .select("doc_id", "word_no", "candidate", "before1", "score", (F.col("score") >= threshold).alias("secret")))


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate in all documents with the forest's judgement; the value itself as a digest."""
    out = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), labelled_findings(spark))
    return out.select("doc_id", "word_no", F.char_length("candidate").alias("length"),
                      F.sha2("candidate", 256).alias("candidate_sha256"), "score", "secret")
