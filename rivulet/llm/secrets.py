"""Secrets in texts: candidates filtered by a random forest, with DataFrame functions only.

Generators with high recall propose long tokens, assignments of secret names and known key forms. A random
forest on length, character transitions, dictionary coverage, path and neighbouring words, trained from
labelled findings, removes the false positives. Labels may be given; ``weak_labels`` derives them from
the way a candidate is written down, and the columns it reads are no features.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.pii import _threshold
from rivulet.llm.spans import Generator, beside, candidates, changes, ids, share, variety
from rivulet.runtime import fresh_path

#: What the labelled findings of a class may weigh together in the forest and the threshold (all of them take part; of more,
#: each weighs less), and the forest's size.
WEIGHT, TREES, DEPTH = 5_000, 20, 6
#: Share of right findings that the threshold must reach on those kept for calibration.
PRECISION = 0.98
_TOKEN = "[A-Za-z0-9_/+=-]"
_NAMES = "token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential"
# A secret name, and the sign of an assignment after it; a value ends where the next assignment begins.
_ASSIGNS = rf"(?:{_NAMES})[\"']?[\x20\t]*+[=:]++>?+[\x20\t]*+"
_VALUE = (
    rf"\"(?:(?!{_ASSIGNS}[\"'])(?:[^\"\\\n]|\\[^\n]))++\"|'(?:(?!{_ASSIGNS}[\"'])(?:[^'\\\n]|\\[^\n]))++'"
    rf"|(?!\"\"|'')(?:(?!{_ASSIGNS})[^\s])++"
)
_PEM = r"[A-Z\x20]{0,30}PRIVATE KEY-----"
_USER = r"[^\s:/?#@\"'<>]"
GENERATORS = [
    Generator(
        "token",
        rf"(?<!{_TOKEN})(?:(?=[A-Za-z_/+=-]*+[0-9])|(?={_TOKEN}{{16}})(?<=(?i:{_NAMES})[\"']?[\x20\t]{{0,8}}[=:]{{0,3}}>?[\x20\t]{{0,8}}[\"']?)){_TOKEN}{{16,}}+",
        f"[0-9]|(?i:{_NAMES})",
    ),
    Generator("assigned", rf"(?i){_ASSIGNS}(?:{_VALUE})", f"(?i){_NAMES}"),
    Generator("key_id", r"(?<![A-Za-z0-9])(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}+)", "A[KS]IA|gh[pousr]_|xox"),
    # to its END line; without one the BEGIN line alone
    Generator("block", rf"-----BEGIN {_PEM}(?:(?:[^-]++|-(?!----))*+-----END {_PEM})?+", "-----BEGIN"),
    Generator("url", rf"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://{_USER}*+:{_USER}++@(?=[A-Za-z0-9\[])", "://"),
]
KINDS = [g.kind for g in GENERATORS]
# Frequent pieces of words. Random tokens hardly contain them.
PIECES = (
    "the|and|ing|ion|ent|tion|for|that|with|this|from|ment|ness|able|ance|over|under|inter|ation|test|example|sample|dummy|"
    "der|die|das|und|ich|ein|sch|ung|heit|keit|les|des|que|eau|eux|aire|los|las|del|ado|cion|ente|mente"
)


def bare() -> Column:
    """The value of a candidate without the name, the sign and the quotes of its assignment; of a URL the password."""
    assigned = F.regexp_replace(F.regexp_replace("_value", rf"(?i)^{_ASSIGNS}[\"']?", ""), "[\"']$", "")
    password = F.regexp_extract("_value", ":([^:@]+)@$", 1)
    return F.when(F.col("_kind") == "assigned", assigned).when(F.col("_kind") == "url", password).otherwise(F.col("_value"))


def features(path: Column) -> dict[str, Column]:
    """What the forest sees of a candidate, as numbers; ``path`` says where the text is from."""
    value = bare()
    where = F.lower(F.coalesce(path.cast("string"), F.lit("")))
    before, after = F.lower("_before"), F.lower("_after")
    return {
        "length": F.length(value).cast("double"),
        "changes": changes(value),
        "variety": variety(value),
        "digit_share": share(value, "[0-9]"),
        "upper_share": share(value, "[A-Z]"),
        "hex": value.rlike("^[0-9a-fA-F]+$").cast("double"),
        "digits_only": value.rlike("^[0-9=_/+-]+$").cast("double"),
        "covered": share(F.lower(value), PIECES),
        "slashes": share(value, "/"),
        "path_test": where.rlike("test|example|sample|doc|readme").cast("double"),
        "path_config": where.rlike(r"conf|\.env|settings|\.ya?ml|\.ini|\.properties").cast("double"),
        "quoted": (before.rlike("[\"']$") | after.rlike("^[\"']")).cast("double"),
        "words_before": share(before, PIECES),
        "words_after": share(after, PIECES),
        "prose_before": before.rlike(r"[a-z]{2,}[.,]?\x20$").cast("double"),
        "prose_after": after.rlike(r"^[.,]?\x20[a-z]{2,}").cast("double"),
    }


def weak_labels(found: DataFrame) -> DataFrame:
    """``found`` with ``_label``: 1 where a secret name is assigned the value, its form is a known one or a URL carries
    it, 0 where it stands for a password (``{…}``, ``$…``, ``***``, the word itself), where
    nothing is assigned and no quote stands beside it or a word is followed by more words, null (no label) between them."""
    named = F.col("_before").rlike(rf"(?i){_ASSIGNS}[\"']?$") | F.col("_kind").isin("key_id", "block")
    value = bare()
    random = (variety(F.right(value, F.lit(32))) >= 0.25) & F.right(value, F.lit(32)).rlike("[0-9]")
    assigned = (F.col("_kind") == "assigned") & random
    plain = ~F.col("_before").rlike("[=:\"']\\x20?$") & ~F.col("_after").rlike("^[\"']") & (F.col("_kind") == "token")
    prose = (F.col("_kind") == "assigned") & value.rlike("^[A-Za-z]+[.,;]?$") & F.col("_after").rlike("^\\x20[a-z]+[\\x20.,]")
    stands_for = (F.col("_kind") == "url") & value.rlike("(?i)^(?:[$%{\\[*]|x+$|pass(?:word)?$|pwd$|secret$)")
    carried = (F.col("_kind") == "url") & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return found.withColumn("_label", F.when(stands_for, 0.0).when(named | assigned | carried, 1.0).when(plain | prose, 0.0))


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None,
                 labels: DataFrame | None = None, precision: float = PRECISION, weight: int = WEIGHT) -> DataFrame:
    """Rows ``_id, _hash, _kind, _start, _end, _value, _score, _secret`` for every candidate.

    ``labels`` (``_id, _start, _end, _label`` with 0 or 1) replaces the weak labels. Without findings of both
    classes there is no forest, and known forms and assignments count as secrets.
    """
    extra = docs.select(F.col(id).alias("_doc"), F.col(text).alias("_body"), (F.col(path) if path else F.lit(None).cast("string")).alias("_path"))
    folder = fresh_path(docs.sparkSession, "secret-candidates")
    candidates(extra, GENERATORS, "_doc", "_body", "_path").write.parquet(folder)
    found = docs.sparkSession.read.parquet(folder)
    table = weak_labels(found) if labels is None else found.join(labels.dropDuplicates(["_id", "_start", "_end"]), ["_id", "_start", "_end"], "left")
    columns = features(F.col("_path"))
    names = [f"f_{name}" for name in columns]
    table = table.withColumns({f"f_{name}": F.coalesce(c.cast("double"), F.lit(0.0)) for name, c in columns.items()})
    result = ["_id", "_hash", "_kind", "_start", "_end", "_value", "_score", "_secret"]
    order = F.xxhash64("_id", "_hash", "_kind", "_start")
    # copies of a text repeat its findings: each way of writing is taken once
    labelled = table.where(F.col("_label").isNotNull()).dropDuplicates(["_value", "_kind", "_label"]).select(
        *names, F.col("_label").cast("double").alias("label"), F.xxhash64("_value", "_kind").alias("_order")
    )
    labelled = labelled.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    pieces = -(-(sizes.agg(F.max("_n")).first()[0] or 1) // weight)
    # laid out by label and order, so that the forest draws the same rows in every run
    laid = labelled.repartitionById(2 * pieces, (F.col("label") * pieces + F.pmod("_order", F.lit(pieces))).cast("int")).sortWithinPartitions("label", "_order")
    weighed = laid.join(F.broadcast(sizes), "label").withColumn("weight", F.least(F.lit(1.0), F.lit(float(weight)) / F.col("_n")))
    assemble = VectorAssembler(inputCols=names, outputCol="features")
    known = assemble.transform(weighed).select("features", "label", "weight", "_order").persist(StorageLevel.MEMORY_AND_DISK)
    calibration = F.pmod("_order", F.lit(4)) == 0
    two = known.where(~calibration).select("label").distinct().count() == 2
    labelled.unpersist()
    if not two:
        known.unpersist()
        certain = F.coalesce(F.col("_label") == 1, F.lit(False))
        return table.withColumn("_score", certain.cast("double")).withColumn("_secret", certain).select(*result)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, weightCol="weight").fit(known.where(~calibration))

    def scored(df: DataFrame) -> DataFrame:
        return forest.transform(df).withColumn("_score", vector_to_array("probability")[1])

    threshold = _threshold(scored(known.where(calibration)), precision)
    known.unpersist()
    return scored(assemble.transform(table.withColumn("_order", order))).withColumn("_secret", F.col("_score") >= threshold).select(*result)


def secret_report(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``id, n_candidates, n_secrets, findings`` per row; findings are ``kind:start:end`` by start, joined by commas.

    Null and empty texts have none, repeated rows equal results.
    """
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("_kind")).cast("int")
    entry = F.struct(F.col("_start"), place.alias("place"), F.concat_ws(":", "_kind", "_start", "_end").alias("label"))
    per_doc = find_secrets(docs, id, text, path).groupBy("_id", "_hash").agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.count_if("_secret").alias("n_secrets"),
        F.sort_array(F.collect_list(F.when(F.col("_secret"), entry))).alias("_entries"),
    )
    return beside(ids(docs, id, text), per_doc).select(
        F.col("_id").alias(id),
        F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates"),
        F.coalesce("n_secrets", F.lit(0)).cast("long").alias("n_secrets"),
        F.coalesce(F.array_join(F.transform("_entries", lambda e: e["label"]), ","), F.lit("")).alias("findings"),
    )
