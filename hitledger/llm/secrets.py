"""Secret scan: candidates by pattern, false ones removed by a random forest.

Candidates are values given to a name like password or token, and long strings of the
characters keys are made of. A forest of decision trees judges each by its length, its
character transitions, how much of it dictionary words cover, the path the text came from and
the words next to it. It is trained from labelled findings. The dictionary is learned from the
corpus: the words in most of its texts.

Only built-in column expressions and Spark's own forest touch the rows.

Edge cases: a very long text is searched whole, in time that grows with its length alone, and
its row holds all its findings; of labelled findings with equal hashes the sample takes those
whose value, neighbours, key and start sort first; null text counts as empty and has no
findings, a null path as empty; a value that both patterns find is one finding; findings of
repeated rows repeat; a null key is carried along; without both true and false labels nothing
is learned, scores are null and every finding is kept; an empty table gives an empty result;
columns other than key, text and path are not read.
"""

from __future__ import annotations

from functools import partial

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from hitledger.llm.matches import located
from hitledger.llm.tables import scratch_path, stored, text_or_empty

NAMES = "password|passwd|pwd|passphrase|secret|token|api_?key|access_?key|private_?key|credential"
_GIVEN = rf"(?i:{NAMES})[\"']? ?[=:] ?[\"']?"
_KEY_SIGN = "[A-Za-z0-9+/_-]"
PATTERNS = {
    "assigned": rf"{_GIVEN}[^\s\"']{{6,}}+",
    "key": rf"(?<!{_KEY_SIGN})(?={_KEY_SIGN}*?[0-9])(?<!{_GIVEN}){_KEY_SIGN}{{16,}}+={{0,2}}",
}
NEEDS = {"assigned": "[=:]", "key": "[0-9]"}
_VALUE = r"[=:] ?[\"']?([^\s\"']+)$"

#: Findings the forest is trained on at most, of each label those with the smallest hash.
MAX_LABELLED = 10_000
TREES, DEPTH, SEED = 30, 6, 17
#: Score from which a finding is kept.
KEEP = 0.5

# Prefixes and formats of well-known issuers, fixed by them.
_ISSUED = (
    r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abpr]-[A-Za-z0-9-]{10,}$"
    r"|^sk_live_[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_-]{35}$"
)
_UUID = r"(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
_STANDIN = r"(?i)example|changeme|placeholder|your|dummy|sample|redacted|(.)\1{5}|12345|abcdef|^<|^\$|\{\{"
_HASH_WORDS = r"(?i)\b(?:commit|sha-?[0-9]*|md5|checksum|digest|revision|blob|tree|integrity)\b[^a-z]*$"
_SECRET_WORDS = rf"(?i)(?:{NAMES}|auth|login|bearer|key)[^\n]{{0,16}}$"
_TEST_PATH = r"(?i)test|example|sample|fixture|mock|docs?\b|readme|spec"

#: Words of the corpus that count as its dictionary: of those in DICTIONARY_DOCUMENTS texts or
#: more the DICTIONARY_WORDS in most texts, those that sort first among equals.
DICTIONARY_WORDS, DICTIONARY_DOCUMENTS = 4096, 3
_WORD = "[a-z]{3,}"
_PART = "[A-Z]?[a-z]+|[A-Z]+"


def candidates(rows: DataFrame, key: str, text: str, path: str | None) -> DataFrame:
    """One row for each finding: key, path, kind, start, end, value, and its neighbours."""
    source = text_or_empty(F.col(path)) if path else F.lit("")
    keep = [F.col(key).alias("key"), source.alias("path")]
    spans = located(rows, text_or_empty(F.col(text)), keep, PATTERNS, NEEDS)
    each = F.concat(*[F.transform(F.col("found")[kind], partial(_finding, kind)) for kind in PATTERNS])
    return spans.select("key", "path", F.explode(each).alias("f")).select("key", "path", "f.*")


def _finding(kind: str, span: Column) -> Column:
    value = span["match"]
    if kind == "assigned":
        value = F.regexp_extract(value, _VALUE, 1)
    return F.struct(
        F.lit(kind).alias("kind"),
        (span["end"] - F.length(value)).alias("start"),
        span["end"].alias("end"),
        value.alias("value"),
        F.concat(span["tail"], F.substring(span["match"], F.lit(1), F.length(span["match"]) - F.length(value))).alias("before"),
        span["head"].alias("behind"),
    )


def dictionary(rows: DataFrame, text: str = "text") -> list[str]:
    """The commonest words of all texts, by the number of texts that have them; a bounded list."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty(F.col(text))), F.lit(_WORD), F.lit(0)))
    counted = rows.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("texts"))
    common = counted.where(F.col("texts") >= DICTIONARY_DOCUMENTS)
    return sorted(row["word"] for row in common.orderBy(F.desc("texts"), "word").limit(DICTIONARY_WORDS).collect())


def covered(value: Column, words: list[str]) -> Column:
    """Characters of a value in runs of letters that are words of the dictionary."""
    known = F.split(F.lit(" ".join(words)), " ")
    parts = F.regexp_extract_all(value, F.lit(_PART), F.lit(0))
    inside = F.filter(parts, lambda part: F.array_contains(known, F.lower(part)))
    return F.aggregate(inside, F.lit(0), lambda total, part: total + F.length(part))


def features(words: list[str]) -> dict[str, Column]:
    """What the forest sees of a finding, as numbers; words are the dictionary."""
    value, before, behind = F.col("value"), F.col("before"), F.col("behind")
    size = F.length(value)

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / size

    return {
        "size": size.cast("double"),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "signs": share("[^A-Za-z0-9]"),
        "kinds": F.size(F.array_distinct(F.split(value, ""))) / size,
        # character transitions, overlapping ones included
        "letter_digit": share("[A-Za-z](?=[0-9])"),
        "digit_letter": share("[0-9](?=[A-Za-z])"),
        "lower_upper": share("[a-z](?=[A-Z])"),
        "vowel_consonant": share("[aeiouAEIOU](?=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])"),
        "consonants": share("[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z](?=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])"),
        "repeats": share(r"(.)(?=\1)"),
        "steps": share("0(?=1)|1(?=2)|2(?=3)|3(?=4)|4(?=5)|5(?=6)|6(?=7)|7(?=8)|8(?=9)"),
        "hexadecimal": value.rlike("^[0-9a-fA-F]+$").cast("double"),
        "dictionary": covered(value, words) / size,
        "test_path": F.col("path").rlike(_TEST_PATH).cast("double"),
        "secret_word": before.rlike(_SECRET_WORDS).cast("double"),
        "hash_word": before.rlike(_HASH_WORDS).cast("double"),
        "given": before.rlike(r"[=:] ?[\"']?$").cast("double"),
        "quoted": (before.rlike("[\"']$") & behind.rlike("^[\"']")).cast("double"),
        "link": before.rlike(r"(?i)(?:https?:|www\.|href)\S*$").cast("double"),
    }


def certain_label() -> Column:
    """1 or 0 for findings whose truth their own form settles, else null.

    A stand-in for labels given by people, where there are none: formats of known issuers, and
    random values given to a secret's name, are secrets; numbers, identifiers, stand-ins and
    file hashes are not.
    """
    value, before = F.col("value"), F.col("before")
    random = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= 12)
    return (
        F.when(value.rlike(_STANDIN) | value.rlike(_UUID), 0)
        .when(value.rlike(r"^[0-9._/+-]+$") | before.rlike(_HASH_WORDS), 0)
        .when(value.rlike(_ISSUED), 1)
        .when((F.col("kind") == "assigned") & random, 1)
    )


def _vectors(described: DataFrame) -> DataFrame:
    names = list(features([]))
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    return assembler.transform(described)


def train(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """A forest from findings with their features and a column label, 1 or 0; null is left out.

    The sample has at most MAX_LABELLED findings of each label.
    """
    usable = labelled.where(F.col("label").isin(0, 1))
    order = [F.xxhash64("value", "before", "key", "start"), "value", "before", "key", "start"]
    parts = [usable.where(F.col("label") == k).orderBy(*order).limit(MAX_LABELLED) for k in (0, 1)]
    sample = stored(parts[0].unionByName(parts[1]), "labelled")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features"
    )
    fitted = forest.fit(_vectors(sample.withColumn("label", F.col("label").cast("double"))))
    # A fitted forest keeps its training summary, and with it the session, which no task can be
    # sent once the session has observed a query. A forest that was read back has none.
    path = scratch_path(labelled.sparkSession, "forest")
    fitted.write().save(path)
    return RandomForestClassificationModel.load(path)


def scan_secrets(
    rows: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = "source",
    labels: DataFrame | None = None,
) -> DataFrame:
    """Key, kind, start, end, value_sha256, score and kept of every finding.

    labels, if given, has key, start, end and label of findings judged by people; otherwise
    findings that settle themselves are trained on. Values leave as hashes only. Positions are
    code points from 0, ends exclusive.
    """
    found = candidates(rows, key, text, path)
    described = stored(found.withColumns(features(dictionary(rows, text))), "findings")
    if labels is None:
        labelled = described.withColumn("label", certain_label())
    else:
        judged = labels.select(F.col(key).alias("key"), "start", "end", "label").distinct()
        labelled = described.join(judged, ["key", "start", "end"])
    forest = train(labelled)
    if forest is None:
        scored = described.withColumn("score", F.lit(None).cast("double"))
    else:
        judged = forest.transform(_vectors(described))
        scored = judged.withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        F.col("key").alias(key),
        "kind",
        "start",
        "end",
        F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
        "score",
        F.coalesce(F.col("score") >= KEEP, F.lit(True)).alias("kept"),
    )
