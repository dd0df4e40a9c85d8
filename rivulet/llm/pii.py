"""Personal data: candidate spans judged by boosted trees, with DataFrame functions only.

Generators with high recall propose spans that may overlap: four base kinds with a format check, and
looser ones. Some candidates of the looser kinds are certain, by check digits, by a word for calling before
them, or by being dates, prices or too short; these are labels, as the checks of the base kinds are.
Gradient-boosted trees are fitted on all labelled candidates but a fourth, over format and context
features other than those that the labels are made of, and judge the candidates that nothing is certain of;
the threshold is the lowest score from which the asked-for precision holds on labelled candidates that the
trees have not seen, the fourth. Base spans that pass their check always stay. Of the others, what is certain or
reaches the threshold is added, kind by kind in the order of ``LOOSE``, unless it touches a span that stays.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.spans import CONTEXT, Generator, beside, candidates, changes, ids, share, variety
from rivulet.runtime import fresh_path

#: What the labelled candidates of a class, of base kinds or of looser ones, may weigh together in the trees and the
#: threshold (all of them take part; of more, each weighs less), and the trees' number and depth.
WEIGHT, TREES, DEPTH = 5_000, 12, 3
#: Share of right spans that the threshold must reach on the candidates kept for calibration.
PRECISION = 0.995
BASE = ("email", "ip", "card", "phone")
#: The looser kinds, the most telling first; of two that overlap the first stays.
LOOSE = ("account", "written", "number")

# Fixed patterns, written without nested repetition of optional parts: each match of the plain forms
# begins where these do (a match may begin right after the one before, hence \G), and ends there too.
_LOCAL = "[A-Za-z0-9._%+-]"
_PART = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
# The lengths of account numbers (IBAN) by country.
_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV",
    29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(rf"(?:{lands})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{size - 4}}}" for size, lands in _LENGTHS.items())
GENERATORS = [
    Generator("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Generator("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    Generator("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9]++(?:[\x20-][0-9]++)*+", "[0-9]"),
    Generator("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    Generator("account", rf"(?<![A-Za-z0-9])(?:{_IBAN}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}\x20?[A-Z0-9]{{1,4}})(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}"),
    Generator("number", r"(?<![0-9A-Za-z])(?:\(?[0-9]{2,4}\)?[\x20./-]{1,2}[0-9]{2,4}[\x20./-][0-9]{2,6}(?:[\x20./-][0-9]{2,4})?|\(?0[0-9]{2,4}\)?[\x20/-]{1,3}[0-9]{5,9})(?![0-9A-Za-z])", r"[0-9]{2}\)?[\x20./-]"),
    Generator("written", rf"(?i)(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\x20?[\[(]\x20?at\x20?[\])]\x20?{_PART}(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?{_PART})+", r"(?i)[\[(]\x20?at\x20?[\])]"),
]
KINDS = [g.kind for g in GENERATORS]
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def passes(kind: Column, value: Column) -> Column:
    """Whether a match of a base kind passes the check of its kind; null for other kinds."""
    count = F.length(_digits(value))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"))
        .when(kind == "card", count.between(14, 19) & _luhn(_digits(value)))
        .when(kind == "phone", count.between(10, 15))
    )


def _iban(value: Column) -> Column:
    """Whether a value has the length of its country and the right check digits (97)."""
    compact = F.regexp_replace(value, "\\x20", "")
    turned = F.split(F.concat(F.substring(compact, 5, 40), F.left(compact, F.lit(4))), "")

    def step(rest: Column, sign: Column) -> Column:
        number = F.position(sign, F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")) - 1
        return (rest * F.when(number > 9, 100).otherwise(10) + number) % 97

    return compact.rlike(f"^(?:{_IBAN})$") & (F.aggregate(turned, F.lit(0), step) == 1)


def labels() -> Column:
    """What is certain of a candidate: the checks of the base kinds; of the looser ones, check digits, written
    addresses, numbers after a word for calling, and numbers too short or long, dates and prices. Else null."""
    value, before, after = F.col("_value"), F.lower("_before"), F.lower("_after")
    digits = F.length(_digits(value))
    date = value.rlike("^(?:19|20)[0-9]{2}[./-][0-9]{2}[./-][0-9]{2}$|^[0-3]?[0-9][./-][0-1]?[0-9][./-](?:[0-9]{2}|(?:19|20)[0-9]{2})$")
    price = before.rlike("[$€£#][^a-z]*$") | after.rlike("^[^a-z]{0,2}(?:%|€|usd|eur|km|kg)")
    calls = before.rlike("(?:tel|phone|fon|call|fax|mobil)[^a-z]*$")
    number = F.when(date | price | ~digits.between(8, 15), False).when(calls & (digits >= 10), True)
    account = F.when(F.col("_kind") == "account", _iban(value)).otherwise(False)  # only then is it worked out
    loose = F.when(F.col("_kind") == "account", account).when(F.col("_kind") == "written", True)
    return F.coalesce(passes(F.col("_kind"), F.col("_value")), loose.when(F.col("_kind") == "number", number))


def features() -> dict[str, Column]:
    """Format and context of a candidate, as numbers; none that ``labels`` is made of."""
    value, before, after = F.col("_value"), F.lower("_before"), F.lower("_after")
    return {
        "length": F.length(value).cast("double"),
        "digit_share": share(value, "[0-9]"),
        "letter_share": share(value, "[A-Za-z]"),
        "groups": F.regexp_count(value, F.lit("[0-9]+")).cast("double"),
        "longest_group": F.coalesce(F.array_max(F.transform(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)), F.length)), F.lit(0)).cast("double"),
        "signs": F.regexp_count(value, F.lit("[().\\x20/-]")).cast("double"),
        "plus": value.startswith("+").cast("double"),
        "at": F.regexp_count(value, F.lit("(?i)@|[\\[(]\\x20?at\\x20?[\\])]")).cast("double"),
        "dots": F.regexp_count(value, F.lit("\\.")).cast("double"),
        "brackets": F.regexp_count(value, F.lit("[()]")).cast("double"),
        "zero": value.rlike("^[(]?0").cast("double"),
        "variety": variety(value),
        "changes": changes(value),
        "touches_word": (before.rlike("[a-z0-9]$") | after.rlike("^[a-z0-9]")).cast("double"),
        "words_before": share(before, "[a-z]"),
        "words_after": share(after, "[a-z]"),
        "says_pay": before.rlike("(?:card|account|iban|pay|visa|bank|konto)[^.]{0,8}$").cast("double"),
        "says_mail": before.rlike("(?:mail|write|contact)[^.]{0,8}$").cast("double"),
        "says_item": before.rlike("(?:item|page|no|nr|ref|order|version|id|on|in|of)[^a-z]*$").cast("double"),
    }


def judged(found: DataFrame, precision: float = PRECISION, weight: int = WEIGHT) -> DataFrame:
    """``found`` with ``_passes``, ``_label``, ``_score`` and ``_chosen``: candidates of looser kinds that are certain, or
    that nothing is certain of and whose score reaches the threshold.

    With labelled candidates of one class only, or none, there is nothing to learn, and the certain ones are chosen.
    """
    columns = features()
    table = found.withColumns({"_passes": passes(F.col("_kind"), F.col("_value")), "_label": labels()}).withColumns(
        {f"f_{name}": F.coalesce(c.cast("double"), F.lit(0.0)) for name, c in columns.items()}
    )
    names = [f"f_{name}" for name in columns]
    certain = F.col("_passes").isNull() & F.coalesce("_label", F.lit(False))
    labelled = table.where(F.col("_label").isNotNull()).select(
        *names, F.col("_label").cast("double").alias("label"), F.col("_passes").isNotNull().alias("_base"), F.xxhash64("_id", "_hash", "_kind", "_start").alias("_order")
    )
    assemble = VectorAssembler(inputCols=names, outputCol="features")
    # candidates that look the same count as one with their number, and a frequent class does not outweigh the others
    alike = labelled.withColumn("_held", F.pmod("_order", F.lit(4)) == 0).groupBy(*names, "label", "_base", "_held").agg(F.count(F.lit(1)).alias("_k"))
    sizes = labelled.groupBy("label", "_base").agg(F.count(F.lit(1)).alias("_n"))
    weighed = alike.join(F.broadcast(sizes), ["label", "_base"]).withColumn("weight", F.col("_k") * F.least(F.lit(1.0), F.lit(float(weight)) / F.col("_n")))
    known = assemble.transform(weighed).select("features", "label", "weight", "_held").persist(StorageLevel.MEMORY_AND_DISK)
    if known.where("NOT _held").select("label").distinct().count() < 2:
        known.unpersist()
        return table.withColumn("_score", F.lit(0.0)).withColumn("_chosen", certain).drop(*names)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, cacheNodeIds=False, weightCol="weight").fit(known.where("NOT _held"))

    def scored(df: DataFrame) -> DataFrame:
        return trees.transform(df).withColumn("_score", vector_to_array("probability")[1])

    threshold = _threshold(scored(known.where("_held")), precision)
    known.unpersist()
    open_ = assemble.transform(table.where(F.col("_passes").isNull() & F.col("_label").isNull()))
    chosen = scored(open_).withColumn("_chosen", F.col("_score") >= threshold)
    rest = table.where(F.col("_passes").isNotNull() | F.col("_label").isNotNull())
    rest = rest.withColumn("_score", F.col("_label").cast("double")).withColumn("_chosen", certain)
    kept = [*table.drop(*names).columns, "_score", "_chosen"]
    return chosen.select(*kept).union(rest.select(*kept))


def _threshold(scored: DataFrame, precision: float) -> float:
    """The lowest of 1000 score steps from which on the labels, by ``weight``, are right often enough; above 1 if none is."""
    steps = scored.groupBy(F.floor(F.col("_score") * 1000).alias("step")).agg(F.sum(F.col("label") * F.col("weight")).alias("right"), F.sum("weight").alias("n"))
    above = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    good = steps.select("step", (F.sum("right").over(above) >= precision * F.sum("n").over(above)).alias("good"))
    # every higher step must be good as well
    still = good.withColumn("still", F.min(F.col("good").cast("int")).over(above)).where("still = 1")
    lowest = still.agg(F.min("step")).first()[0]
    return 1.01 if lowest is None else lowest / 1000


def find_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``_id, _hash, _kind, _start, _end, _value, _base``: the spans to redact, base ones and added ones."""
    spark = docs.sparkSession
    path = fresh_path(spark, "pii-candidates")
    candidates(docs, GENERATORS, id, text).write.parquet(path)
    table = judged(spark.read.parquet(path))
    wanted = table.where(F.col("_passes") | F.col("_chosen")).select(
        "_id", "_hash", "_kind", "_start", "_end", "_value", F.col("_passes").isNotNull().alias("_base")
    )
    return without_overlaps(wanted)


def without_overlaps(spans: DataFrame) -> DataFrame:
    """``spans`` without those of looser kinds that overlap a base span or one that stays of an earlier kind.

    Spans of one kind never overlap each other. A text's spans are sorted by place, once from each end, for
    each looser kind; so the work grows with their number times its logarithm.
    """
    text = Window.partitionBy("_id", "_hash")
    before = text.orderBy("_start", "_end", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = text.orderBy(F.desc("_start"), F.desc("_end"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, -1)
    kept = spans.withColumn("_kept", F.col("_base"))
    for kind in LOOSE:
        last = F.max(F.when(F.col("_kept"), F.col("_end"))).over(before)
        following = F.min(F.when(F.col("_kept"), F.col("_start"))).over(behind)
        kept = kept.withColumn("_last", last).withColumn("_next", following)
        touched = F.coalesce(F.col("_last") > F.col("_start"), F.lit(False)) | F.coalesce(F.col("_next") < F.col("_end"), F.lit(False))
        kept = kept.withColumn("_kept", F.col("_kept") | ((F.col("_kind") == kind) & ~touched))
    return kept.where("_kept").select(*spans.columns)


def span_digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: counts of the base kinds, ``base_sha256``, ``spans`` and ``n_added``.

    Spans are ``kind:start:end`` in the order of their starts, then of their kinds, joined by commas.
    Null and empty texts have none; repeated rows have equal results.
    """
    found = find_spans(docs, id, text)
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("_kind")).cast("int")
    label = F.concat_ws(":", "_kind", "_start", "_end")
    entry = F.struct(F.col("_start"), place.alias("place"), label.alias("label"))
    per_doc = found.groupBy("_id", "_hash").agg(
        *[F.count_if(F.col("_base") & (F.col("_kind") == kind)).alias(f"n_{kind}") for kind in BASE],
        F.sort_array(F.collect_list(F.when(F.col("_base"), entry))).alias("_base_entries"),
        F.sort_array(F.collect_list(entry)).alias("_entries"),
        F.count_if(~F.col("_base")).alias("n_added"),
    )

    def joined(entries: str) -> Column:
        return F.coalesce(F.array_join(F.transform(entries, lambda e: e["label"]), ","), F.lit(""))

    return beside(ids(docs, id, text), per_doc).select(
        F.col("_id").alias(id),
        *[F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(joined("_base_entries"), 256).alias("base_sha256"),
        joined("_entries").alias("spans"),
        F.coalesce("n_added", F.lit(0)).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, id: str = "doc_id", text: str = "text", name: str = "redacted") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets, as column ``name``."""
    found = find_spans(docs, id, text)
    earlier = Window.partitionBy("_id", "_hash").orderBy("_start", "_end", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    apart = found.withColumn("_from", F.coalesce(F.max("_end").over(earlier), F.lit(0))).where(F.col("_from") <= F.col("_start"))
    spans = apart.groupBy("_id", "_hash").agg(
        F.sort_array(F.collect_list(F.struct("_start", "_from", "_kind"))).alias("_spans"), F.max("_end").alias("_rest")
    )
    rows = docs.withColumn("_id", F.col(id)).withColumn("_hash", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    body = F.coalesce(F.col(text), F.lit(""))
    pieces = F.transform(
        F.coalesce("_spans", F.array().cast("array<struct<_start: int, _from: int, _kind: string>>")),
        lambda s: F.concat(F.substring(body, s["_from"] + 1, s["_start"] - s["_from"]), F.lit("["), s["_kind"], F.lit("]")),
    )
    tail = F.substring(body, F.coalesce("_rest", F.lit(0)) + 1, F.length(body))
    kept = [c for c in docs.columns if c != name]
    return beside(rows, spans).select(*kept, F.concat(F.array_join(pieces, ""), tail).alias(name))


__all__ = ["CONTEXT", "GENERATORS", "find_spans", "judged", "redact", "span_digests"]
