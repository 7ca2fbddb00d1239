"""Secret scans: a random forest removes false positives from candidate strings.

DataFrame operations and Spark's own forest only. Candidates are long runs of
key-like characters, values of 8 characters or more assigned to a credential's
name, and passwords before the host of an address; the text between them gives
each its neighbouring words.
The dictionary and the letter transitions are counted over all documents. The
forest is trained from labelled findings, at most so many of each label.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almenara.llm.tables import row_key, stored

_NAMES = r"pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer"
#: the cheap look back at an assignment comes first, the names only behind it
_VALUE = rf"(?<=[=:]\s{{0,3}}[\"']?)(?<=(?i:{_NAMES})[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?)[^\s\"'`<>,;(){{}}\[\]]{{8,}}"
_LOGIN = r"(?<=[A-Za-z0-9._-]:)[^\s\"'`<>:@/]{8,64}(?=@[A-Za-z0-9])"
CANDIDATE = rf"{_VALUE}|{_LOGIN}|[A-Za-z0-9_+/-]{{16,}}"
_CONTEXT = 40
_CREDENTIAL = rf"(?i)(?:{_NAMES})\W{{0,8}}$"
_ASSIGNED = r"[=:]\s*[\"']?$"
_PLACEHOLDER = r"(?i)(example|sample|dummy|placeholder|changeme|xxxx|test|fake|redacted)"
_PATH = r"(?i)(test|spec|fixture|example|sample|mock|doc)"
#: shapes that providers give their keys
_PROVIDER = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^sk_live_[A-Za-z0-9]{16,}$|^xox[abpr]-[A-Za-z0-9-]{10,}$"

FEATURES = (
    "length", "digits", "upper", "lower", "distinct", "switches", "unlikely", "covered", "assigned", "credential", "quoted", "placeholder", "test_path", "plain_before", "plain_after",
)


def candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str) -> DataFrame:
    """``_id``, ``_key``, ``_nth``, ``_path``, ``_value``, ``_before``, ``_after``: every candidate of every text, in order."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    found = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        row_key(id_col, text_col).alias("_key"),
        F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")).alias("_path"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("_values"),
        text.alias("_text"),
    ).where(F.size("_values") > 0)
    # the text between candidates: one piece more than there are candidates
    pieces = F.split("_text", CANDIDATE, -1)
    ends = F.transform(pieces, lambda p: F.struct(F.right(p, F.lit(_CONTEXT)).alias("r"), F.left(p, F.lit(_CONTEXT)).alias("l")))
    cut = found.select("_id", "_key", "_path", "_values", ends.alias("_ends"))
    one = F.transform(F.col("_values"), lambda v, i: F.struct(i.alias("_nth"), v.alias("_value"), F.get("_ends", i).getField("r").alias("_before"), F.get("_ends", i + 1).getField("l").alias("_after")))
    return cut.select("_id", "_key", "_path", F.explode(one).alias("c")).select("_id", "_key", "_path", "c.*")


def dictionary(docs: DataFrame, text_col: str, min_docs: int = 3) -> DataFrame:
    """``_word``, ``_docs``: words of 3 to 14 Latin letters found in at least ``min_docs`` documents."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(f"`{text_col}`").cast("string")), F.lit(r"\b[a-z]{3,14}\b"), F.lit(0)))
    return docs.select(F.explode(words).alias("_word")).groupBy("_word").agg(F.count(F.lit(1)).alias("_docs")).where(F.col("_docs") >= min_docs)


def _grams(text: Column, n: int) -> Column:
    """All windows of n characters."""
    return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def _word_measures(values: DataFrame, words: DataFrame) -> DataFrame:
    """Per distinct value: share of its characters in dictionary beginnings, and how unlikely its letter pairs are."""
    quads = words.select(F.explode(_grams(F.col("_word"), 4)).alias("_gram")).distinct()
    pairs = words.select("_docs", F.explode(_grams(F.col("_word"), 2)).alias("_gram")).groupBy("_gram").agg(F.sum("_docs").alias("_n"))
    starts = pairs.groupBy(F.substring("_gram", 1, 1).alias("_first")).agg(F.sum("_n").alias("_all"))
    surprise = pairs.join(starts, F.substring("_gram", 1, 1) == F.col("_first")).select("_gram", (-F.log2(F.col("_n") / F.col("_all"))).alias("_bits"))
    low = values.select("_value", F.lower("_value").alias("_low"))
    four = low.select("_value", F.explode(_grams(F.col("_low"), 4)).alias("_gram")).join(quads.withColumn("_known", F.lit(1)), "_gram", "left")
    covered = four.groupBy("_value").agg(F.avg(F.coalesce("_known", F.lit(0))).alias("covered"))
    two = low.select("_value", F.explode(_grams(F.col("_low"), 2)).alias("_gram")).join(surprise, "_gram", "left")
    unlikely = two.groupBy("_value").agg(F.avg(F.coalesce("_bits", F.lit(16.0))).alias("unlikely"))
    return covered.join(unlikely, "_value")


def featured(found: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """Candidates with the columns of ``FEATURES``."""
    v, n = F.col("_value"), F.length("_value")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    flag = lambda column, pattern: F.col(column).rlike(pattern).cast("double")
    measures = stored(_word_measures(found.select("_value").distinct(), stored(dictionary(docs, text_col), "dictionary")), "word-measures")
    return found.join(measures, "_value").withColumns({
        "length": n.cast("double"),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "switches": share("[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])"),
        "assigned": flag("_before", _ASSIGNED),
        "credential": F.greatest(flag("_before", _CREDENTIAL), _login().cast("double")),
        "quoted": flag("_before", "[\"']$"),
        "placeholder": F.greatest(flag("_value", _PLACEHOLDER), flag("_before", _PLACEHOLDER)),
        "test_path": flag("_path", _PATH),
        "plain_before": flag("_before", r"[A-Za-z]{2,}[.,;]?\s+$"),
        "plain_after": flag("_after", r"^[.,;]?\s+[A-Za-z]{2,}"),
    })


def _login() -> Column:
    """Whether a candidate stands between a user's name and a host."""
    return F.col("_before").rlike("[A-Za-z0-9._-]:$") & F.col("_after").rlike("^@[A-Za-z0-9]")


def weak_labels(found: DataFrame) -> DataFrame:
    """Labelled findings (``_value``, ``_label``) where rules of high precision decide.

    1: a provider's key format, or a value with letters and digits assigned to
    a credential name or standing before an address's host, and no placeholder. 0: runs without digits, runs of
    digits only, placeholders. All others stay unlabelled. A value that rules
    label both ways is 1.
    """
    v = F.col("_value")
    placeholder = v.rlike(_PLACEHOLDER)
    mixed = v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    label = F.when(placeholder, 0).when(v.rlike(_PROVIDER) | (mixed & (F.col("_before").rlike(_CREDENTIAL) | _login())), 1).when(~mixed, 0)
    return found.select("_value", label.alias("_label")).where("_label IS NOT NULL").groupBy("_value").agg(F.max("_label").alias("_label"))


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", per_label: int = 5000, threshold: float = 0.5, trees: int = 20, depth: int = 6) -> DataFrame:
    """Every candidate of every text: ``_id``, ``_key``, ``_nth``, ``_path``, ``_value``, ``_before``, ``_after``, ``_score``, ``_secret``.

    ``findings``: labelled findings (``_value``, ``_label`` 0 or 1), by default
    ``weak_labels`` of the documents themselves. The forest sees at most
    ``per_label`` values of each label, the first by a fixed hash. Without
    values of both labels every score is the share of label 1. A null or
    empty text or path has no candidates or is an empty path; rows that repeat
    are scanned each; without candidates there are no rows.
    """
    found = stored(candidates(docs, id_col, text_col, path_col), "candidates")
    rows = stored(featured(found, docs, text_col), "secret-features")
    labelled = (weak_labels(found) if findings is None else findings).where(F.col("_label").isin(0, 1)).groupBy("_value").agg(F.max("_label").alias("_label"))
    sample = reduce(DataFrame.union, [labelled.where(F.col("_label") == k).orderBy(F.xxhash64("_value"), "_value").limit(per_label) for k in (0, 1)])
    one_each = rows.groupBy("_value").agg(*[F.max(c).alias(c) for c in FEATURES])
    train = stored(one_each.join(F.broadcast(sample), "_value").select(*FEATURES, F.col("_label").cast("double").alias("_label")), "secret-sample")
    counts = dict(train.groupBy("_label").count().collect())  # two rows at most
    columns = ["_id", "_key", "_nth", "_path", "_value", "_before", "_after", "_score"]
    if len(counts) < 2:
        share = (counts.get(1.0, 0) + 0.5) / (sum(counts.values()) + 1)
        scored = rows.withColumn("_score", F.lit(share))
    else:
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector")
        forest = RandomForestClassifier(featuresCol="_vector", labelCol="_label", probabilityCol="_probability", numTrees=trees, maxDepth=depth, seed=17)
        model = forest.fit(assembler.transform(train).orderBy(F.xxhash64(*FEATURES)))
        scored = model.transform(assembler.transform(rows)).withColumn("_score", F.get(vector_to_array("_probability"), F.lit(1)))
    return scored.select(*columns).withColumn("_secret", F.col("_score") >= threshold)


def redact(docs: DataFrame, scanned: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the secrets' values in ``text_col`` replaced by ``mark``; texts without any stay as they are."""
    bad = scanned.where("_secret").groupBy("_key").agg(F.collect_set("_value").alias("_bad"))
    joined = docs.withColumn("_row", row_key(id_col, text_col)).join(bad, F.col("_row") == F.col("_key"), "left")
    text = F.aggregate(F.coalesce("_bad", F.array().cast("array<string>")), F.col(f"`{text_col}`").cast("string"), lambda t, v: F.replace(t, v, F.lit(mark)))
    return joined.withColumn(text_col, text).select(docs.columns)
