"""Secrets in texts: candidates by shape, judged by a random forest on built-in expressions alone.

Candidates are of two kinds. After a credential's name and an assignment (`password: `, `api_key = "`), or after
`Bearer`, the whole quoted value or, without quotes, all up to white space, of any characters from NAMED_SHORTEST on.
Elsewhere a run of at least SHORTEST value characters that has a digit or follows an assignment. One pass of one
pattern over the text cuts it into pieces that each end with a candidate, so starts are running sums of the
pieces' lengths and masking joins the pieces again: both linear in the text. Each candidate gets its length,
its character transitions, the share of it that dictionary words cover, what path it looks like (slashes,
dots, an address), and its neighbouring words (a credential's name, an assignment, quotes). Spark's random forest
learns from labelled findings to tell secrets from the false positives of the shape.

Labelled findings may be given (value features and `label`). Where there are none, `weak_labels`
marks those that clear rules decide: assigned to a credential's name and not a placeholder is a
secret; part of an e-mail or network address, a long number alone, or a host name is not; the rest
stays unlabelled and is judged by the forest alone. With labels of one kind only, every finding
gets that label; without any, probability 0.

Null and empty texts have no findings. Repeated rows give their findings again; an empty table
gives no rows; other columns are not looked at. Starts are in code points from 0. With fewer than
FEWEST_TEXTS different texts no word is in the dictionary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import text_or_empty
from almanac.sources.stage import stage

SHORTEST, NAMED_SHORTEST = 12, 6
#: Labelled findings that the forest is trained on, at most, of each label; chosen by a hash of the value.
TRAIN_FINDINGS = 10_000
#: Different texts, at least, that hold a word of the dictionary; told apart by the last six bits of a hash, so alike ones count once.
FEWEST_TEXTS = 5
TREES, DEPTH, SEED = 20, 5, 11
THRESHOLD = 0.5
MASK = "[SECRET]"

#: Names of credentials and usual placeholders. Fixed values.
NAMES = r"(?i:token|secret|passw(?:or)?d|passphrase|pwd|api[_\-]?key|access[_\-]?key|private[_\-]?key|credential|auth(?:orization)?|client[_\-]?secret)"
PLACEHOLDERS = r"(?i)example|sample|placeholder|changeme|your[_\-]|xxxx|\*\*\*\*|dummy|redacted|0000000000|1234567890"

_VALUE = r"A-Za-z0-9_+/.~\-"
_SHAPE = (rf"(?<![{_VALUE}])(?:(?=[A-Za-z_+/.~\-]*+[0-9])|(?<=[=:][>\s\"']{{0,4}}))[{_VALUE}]{{{SHORTEST},}}+={{0,2}}")
_SCHEME = r"(?i:bearer|basic)\s{1,4}"
_PREFIX = (rf"(?<![\w.\-])(?:[\w.\-]{{0,40}}?(?=[tspacTSPAC]){NAMES}[\w\-]{{0,20}}[\"'`]?\s{{0,4}}(?::=|=>|={{1,2}}|:|\s(?i:is)\s)\s{{0,4}}(?:{_SCHEME})?"
           rf"|{_SCHEME})[\"'`]?+")
_NAMED = "|".join([rf"(?<={q})[^{q}\n]{{{NAMED_SHORTEST},}}+(?={q})" for q in "\"'`"]
                  + [rf"(?<![\"'`])[^\s\"'`]{{{NAMED_SHORTEST - 1},}}[^\s\"'`.,;:)\]}}]"])
#: Ends with a candidate, its second group, and begins where the match before ended. The first group is set after a credential's name.
PIECE = rf"\G(?s:.*?)(?:{_PREFIX}()|)((?:\1(?:{_NAMED}))|(?:{_SHAPE}))"
#: Characters before a candidate that are looked at.
CONTEXT = 120

FEATURES = ["chars", "transitions", "distinct_share", "digit_share", "upper_share", "hex", "covered", "slashes", "dots", "address",
            "named", "assigned", "quoted", "digits_alone"]


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word): letter runs of four or more, lower-cased, that stand alone in FEWEST_TEXTS different texts or more; all documents are counted.

    Runs inside a longer value (keys, identifiers, paths) do not count. Copies of a text set the same bit, so they do not make a word.
    """
    alone = r"(?<![\p{L}\p{N}_/+=@.~\-])(\p{L}{4,})(?![\p{L}\p{N}_/+=@~\-])"
    texts = docs.select(F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(`{text}`), 64) AS INT))").alias("_bit"),
                        F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(alone), 1))).alias("word"))
    return texts.groupBy("word").agg(F.bit_or("_bit").alias("_bits")).where(F.bit_count("_bits") >= FEWEST_TEXTS).select("word")


def cover(found: DataFrame, words: DataFrame) -> DataFrame:
    """Written candidates with the share of each value that different words of the dictionary cover."""
    runs = F.array_distinct(F.regexp_extract_all(F.lower("value"), F.lit(r"(\p{L}{4,})"), 1))
    known = (
        found.select("value").distinct().select("value", F.explode(runs).alias("word"))
        .join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("_known"))
    )
    joined = found.join(stage(known, "covered"), "value", "left")
    return joined.withColumn("covered", F.coalesce("_known", F.lit(0)) / F.col("chars")).select(*found.columns)


def _pieces(text: str) -> Column:
    return F.when(F.col(text).rlike(r"[0-9=:]|(?i:bearer|basic|\sis\s)"), F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def _length(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0), lambda n, p: n + F.length(p))


def candidates(docs: DataFrame, words: Sequence[str] = (), text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row for each candidate: kept columns, _doc, at (its number in the text), _length (of its piece), value and features; `starts` reads it when written."""
    parts = (
        docs.select(*keep, text_or_empty(text).alias("_text")).withColumn("_pieces", _pieces("_text")).where(F.size("_pieces") > 0)
        .withColumns({"_doc": F.monotonically_increasing_id(), "_values": F.regexp_extract_all("_text", F.lit(PIECE), F.lit(2)),
                      "_rest": F.substring("_text", _length(F.col("_pieces")) + 1, F.lit(1))})
        .select(*keep, "_doc", "_pieces", "_rest", F.posexplode("_values").alias("at", "value"))
    )
    piece = F.get("_pieces", F.col("at"))
    own = F.substring(piece, F.lit(1), F.length(piece) - F.length("value"))
    left = F.concat(F.coalesce(F.right(F.get("_pieces", F.col("at") - 1), F.lit(CONTEXT)), F.lit("")), F.right(own, F.lit(CONTEXT)))
    rows = parts.select(*keep, "_doc", "at", "value", F.length(piece).alias("_length"), F.right(left, F.lit(CONTEXT)).alias("_before"),
                        F.coalesce(F.left(F.get("_pieces", F.col("at") + 1), F.lit(1)), F.col("_rest")).alias("_after"))
    value, before, after, chars = F.col("value"), F.col("_before"), F.col("_after"), F.length("value")
    known = F.array_intersect(F.regexp_extract_all(F.lower("value"), F.lit(r"(\p{L}{4,})"), 1), F.array(*map(F.lit, words)).cast("array<string>"))
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / chars
    flag = lambda condition: condition.cast("double")
    return rows.select(
        *keep, "_doc", "at", "_length", value,
        chars.cast("double").alias("chars"),
        (F.regexp_count(value, F.lit("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])")) / chars).alias("transitions"),
        (F.size(F.array_distinct(F.split(F.left(value, F.lit(64)), ""))) / F.least(chars, F.lit(64))).alias("distinct_share"),
        share("[0-9]").alias("digit_share"), share("[A-Z]").alias("upper_share"),
        flag(value.rlike("^[0-9a-fA-F]+$")).alias("hex"), (F.length(F.array_join(known, "")) / chars if words else F.lit(0.0)).alias("covered"),
        F.regexp_count(value, F.lit("/")).cast("double").alias("slashes"), F.regexp_count(value, F.lit(r"\.")).cast("double").alias("dots"),
        flag(before.rlike(r"@$|://\S*$") | after.rlike("^@")).alias("address"),
        flag(before.rlike(NAMES + rf"[\w\-]*[\"'`]?\s*(?:=|:|=>|is)?\s*(?:{_SCHEME})?[\s\"'`]*$") | before.rlike(rf"{_SCHEME}[\"'`]?$")).alias("named"),
        flag(before.rlike(rf"[=:]>?\s*(?:{_SCHEME})?[\s\"'`]*$") | before.rlike(rf"{_SCHEME}[\"'`]?$")).alias("assigned"),
        flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).alias("quoted"),
        flag(value.rlike(r"^[0-9.\-]+$")).alias("digits_alone"),
    )


def starts(written: DataFrame) -> DataFrame:
    """Adds `start` to written candidates: the lengths of the pieces up to a candidate, less its own."""
    so_far = Window.partitionBy("_doc").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return written.withColumn("start", (F.sum("_length").over(so_far) - F.col("chars")).cast("long"))


def weak_labels() -> Column:
    """1 secret, 0 none, null undecided."""
    placeholder = F.col("value").rlike(PLACEHOLDERS)
    return (
        F.when((F.col("address") > 0) | (F.col("digits_alone") > 0) | placeholder, F.lit(0))
        .when(F.col("value").rlike(r"^[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[a-z]{2,6}\.?$"), F.lit(0))
        .when((F.col("named") > 0) & (F.col("assigned") > 0) & (F.col("covered") < 0.5), F.lit(1))
        .when(F.col("covered") >= 0.5, F.lit(0))
    )


def judge(found: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Adds probability and accepted to written candidates; `labelled` has the features, value and label."""
    rows = found.withColumn("label", weak_labels()) if labelled is None else labelled
    rows = rows.where(F.col("label").isin(0, 1)).withColumn("label", F.col("label").cast("double"))
    train = [rows.where(F.col("label") == c).orderBy(F.xxhash64("value"), "value", *FEATURES).limit(TRAIN_FINDINGS) for c in (0.0, 1.0)]
    sample = stage(train[0].union(train[1]).select("label", *FEATURES), "findings")
    kinds = [row.label for row in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return found.withColumn("probability", F.lit(kinds[0] if kinds else 0.0)).withColumn("accepted", F.col("probability") >= threshold)
    gather = VectorAssembler(inputCols=FEATURES, outputCol="_features", handleInvalid="keep")
    forest = RandomForestClassifier(labelCol="label", featuresCol="_features", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                    probabilityCol="_shares", rawPredictionCol="_raw", predictionCol="_guess")
    model = forest.fit(gather.transform(sample))
    judged = model.transform(gather.transform(found)).withColumn("probability", F.get(vector_to_array("_shares"), F.lit(1)))
    return judged.withColumn("accepted", F.col("probability") >= threshold).drop("_features", "_raw", "_shares", "_guess")


def findings(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), labelled: DataFrame | None = None) -> DataFrame:
    """Kept columns, start, n_chars, value, probability, accepted and at (the candidate's number in its text), for every candidate."""
    found = starts(stage(candidates(docs, (), text, keep), "candidates"))
    found = stage(cover(found, dictionary(docs, text)), "covered-candidates")
    return judge(found, labelled).select(*keep, "start", F.col("chars").cast("int").alias("n_chars"), "value", "probability", "accepted", "at")


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of `docs`, with MASK in the place of accepted findings; `n_chars`, where there is such a column, follows."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = whole.select("_row", F.col(f"_row.`{key}`").alias("_id"), F.col(f"_row.`{text}`").alias("_text")).withColumn("_of", F.xxhash64("_text"))
    found = stage(findings(rows, "_text", ("_id", "_of")).select("_id", "_of", "at", F.when(F.col("accepted"), F.col("n_chars")).otherwise(0).alias("cut"))
                  .distinct(), "findings")  # rows alike have the same
    cuts = found.groupBy("_id", "_of").agg(F.sort_array(F.collect_list(F.struct("at", "cut"))).alias("_cuts"), F.max("cut").alias("_most")).where("_most > 0")
    cuts = cuts.select(F.col("_id").alias("_cut_id"), F.col("_of").alias("_cut_of"), "_cuts")
    joined = rows.join(cuts, F.col("_id").eqNullSafe(F.col("_cut_id")) & F.col("_of").eqNullSafe(F.col("_cut_of")), "left")
    pieces = _pieces("_text")  # as many as there are cuts
    masked = F.transform(pieces, lambda p, i: F.when(F.col("_cuts")[i]["cut"] > 0, F.concat(
        F.substring(p, F.lit(1), F.length(p) - F.col("_cuts")[i]["cut"]), F.lit(MASK))).otherwise(p))
    rest = F.substring("_text", _length(pieces) + 1, F.length("_text"))
    fresh = joined.withColumn("_new", F.when(F.col("_cuts").isNull(), F.col("_text")).otherwise(F.concat(F.array_join(masked, ""), rest)))
    columns = {text: F.col("_new")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("_cuts").isNull(), F.col("_row.n_chars")).otherwise(F.length("_new"))
    return fresh.select(*[columns.get(c, F.col(f"_row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
