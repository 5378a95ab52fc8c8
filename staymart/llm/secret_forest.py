"""Secret scan: candidates from texts, false positives removed by a random forest; no Python on
the executors.

A candidate is a run of 16 or more letters, digits, ``+``, ``/``, ``_`` or ``-`` (and closing
``=``) inside a word, that has a digit or, from 20 characters on, both cases; or a value of 6 or
more characters of any kind that is assigned to a name as of a secret, in quotes (then with
spaces too, within a line) or bare. A quoted value counts as one word. Features: its
length, the shares of character classes and of transitions between them, the share covered by
the corpus's frequent words, marks of test or settings files in the path, and what the word
itself and its neighbours say before and after the candidate.

The forest learns from labelled findings, ``BOUND`` at most, chosen by a hash. Without both
labels every score is the share of label 1 (0 without findings). Null and empty texts have no
candidates, a null path no marks. Repeated rows are scanned each.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import keep

BOUND, TREES, DEPTH = 20_000, 30, 6
#: Frequent words that make the dictionary.
DICTIONARY = 400
_RUN = r"[A-Za-z0-9+/_\-]{16,}={0,2}"

# Words that speak for or against a secret, in names and in paths.
_NAMES = r"(?i)(pass(word|wd|phrase)?|token|secret|api[_-]?key|access[_-]?key|auth|credential|private)"
# A secret's name at the end of a word, what assigns, and the value, in quotes or up to a space.
_NAME_END = _NAMES + r"[\w\-]*[\"'\])]*"
_ASSIGNS = r"(?::=|=>|==?|:)"
_VALUE = r"(\"[^\"\r\n]{6,}\"|'[^'\r\n]{6,}'|`[^`\r\n]{6,}`|[^\s\"'`]\S{5,})"
#: Stands for a space in a quoted value; no character of any text.
_SPACE = "\ufdd0"
_PLACEHOLDERS = r"(?i)(example|sample|dummy|fake|placeholder|changeme|xxxx|test)"
_TEST_PATHS = r"(?i)(test|spec|mock|fixture|example|sample|docs?/)"
_SETTING_PATHS = r"(?i)(\.env|\.ini|\.cfg|\.conf|\.ya?ml|\.json|\.properties|\.toml|config)"


def _joined(text: Column) -> Column:
    """``text`` with the spaces in quoted values of secrets' names replaced by _SPACE."""
    # Cut in front of such a value; every piece but the first begins with one.
    cut = F.split(text, rf"(?<={_NAMES}[\w\-]{{0,40}}[\"'\])]{{0,2}}\s{{0,8}}{_ASSIGNS}\s{{0,8}})(?=[\"'`])")
    quoted = r"^(\"[^\"\r\n]{6,}\"|'[^'\r\n]{6,}'|`[^`\r\n]{6,}`)"

    def whole(piece: Column, i: Column) -> Column:
        value = F.regexp_extract(piece, quoted, 1)
        rest = F.substring(piece, F.length(value) + 1, F.length(piece))
        return F.when(i == 0, piece).otherwise(F.concat(F.translate(value, " \t", _SPACE * 2), rest))

    return F.when(text.rlike(_NAMES), F.array_join(F.transform(cut, whole), "")).otherwise(text)


def _assigned(word: Column, before: Column) -> Column:
    """The values in ``word`` that are assigned to a secret's name there or in front of it."""
    inside = F.regexp_extract_all(word, F.lit(f"{_NAME_END}{_ASSIGNS}(?={_VALUE})"), F.lit(3))
    first = F.regexp_extract(word, f"^{_VALUE}", 1)
    after_sign = F.regexp_extract(word, f"^{_ASSIGNS}{_VALUE}", 1)
    found = F.concat(
        inside,
        F.when(before.rlike(rf"{_NAME_END}\s*{_ASSIGNS}$"), F.array(first)).otherwise(F.array().cast("array<string>")),
        F.when(before.rlike(f"{_NAME_END}$"), F.array(after_sign)).otherwise(F.array().cast("array<string>")),
    )
    # Without the quotes, and a bare one without what closes a list or a statement.
    bare = F.transform(found, lambda v: F.regexp_replace(v, r"^([\"'`])(.*)\1$", "$2"))
    bare = F.transform(bare, lambda v: F.regexp_replace(v, r"[\"'`]*[,;)\]}]*$", ""))
    return F.filter(F.array_distinct(bare), lambda v: F.length(v) >= 6)


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, path, word_no, candidate, lead, trail, before, after) per candidate.

    lead and trail are the rest of its word, before the two words in front.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.split(_joined(F.col(text)), r"\s+").alias("words"))
    at = F.explode(F.sequence(F.lit(1), F.size("words")))
    d = d.where(F.size("words") > 0).select("doc_id", "path", "words", at.alias("word_no"))
    word = F.element_at("words", F.col("word_no"))

    def near(step: int) -> Column:
        place = F.col("word_no") + step
        return F.when((place >= 1) & (place <= F.size("words")), F.element_at("words", F.greatest(F.lit(1), F.least(place, F.size("words"))))).otherwise("")

    before = F.trim(F.concat_ws(" ", near(-2), near(-1)))
    named = (F.length(word) >= 6) & F.concat_ws(" ", before, word).rlike(rf"{_NAME_END}\s*{_ASSIGNS}")
    rows = d.where(((F.length(word) >= 16) & word.rlike(_RUN)) | named).select(
        "doc_id", "path", "word_no", word.alias("word"), before.alias("before"), near(1).alias("after"),
    )
    runs = F.filter(
        F.regexp_extract_all("word", F.lit(f"({_RUN})"), F.lit(1)),
        lambda c: c.rlike("[0-9]") | ((F.length(c) >= 20) & c.rlike("[a-z]") & c.rlike("[A-Z]")),
    )
    values = _assigned(F.col("word"), F.col("before"))
    rows = rows.withColumn("candidate", F.explode(F.concat(runs, F.array_except(values, runs))))
    lead = F.call_function("substring_index", F.col("word"), F.col("candidate"), F.lit(1))
    rest = F.substring(F.col("word"), F.length(lead) + F.length("candidate") + 1, F.length("word"))
    spaced = {"candidate": F.col("candidate"), "lead": lead, "trail": rest, "before": F.col("before"), "after": F.col("after")}
    return rows.select("doc_id", "path", "word_no", *(F.translate(x, _SPACE, " ").alias(name) for name, x in spaced.items()))


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> list[str]:
    """The most frequent words of three to twelve letters over all texts; ``size`` at most."""
    word = F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}]+"))
    counts = docs.select(word.alias("word")).where(F.length("word").between(3, 12)).groupBy("word").count()
    top = counts.orderBy(F.desc("count"), "word").limit(size)
    return sorted((r[0] for r in top.collect()), key=lambda w: (-len(w), w))


def _features(words: list[str]) -> dict[str, Column]:
    c = F.col("candidate")
    n = F.length(c).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    covered = n - F.length(F.regexp_replace(F.lower(c), "(" + "|".join(words) + ")", "")) if words else F.lit(0.0)
    context = F.concat_ws(" ", "before", "lead")
    flag = lambda x, pattern: x.rlike(pattern).cast("double")
    return {
        "length": n,
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "signs": share(r"[+/_=\-]"),
        "other_signs": share(r"[^A-Za-z0-9+/_=\-]"),
        "beyond_hex": share("[g-zG-Z]"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "letter_to_digit": share("[A-Za-z][0-9]"),
        "digit_to_letter": share("[0-9][A-Za-z]"),
        "case_changes": share("[a-z][A-Z]"),
        "vowel_to_consonant": share("[aeiouAEIOU][b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z]"),
        "repeated": share(r"(.)\1"),
        "covered": covered / n,
        "test_path": flag(F.col("path"), _TEST_PATHS),
        "setting_path": flag(F.col("path"), _SETTING_PATHS),
        "named": flag(context, _NAMES),
        "assigned": flag(context, r"[=:]\s*[\"']?$"),
        "quoted": flag(F.col("lead"), "[\"'`]$"),
        "closed": flag(F.col("trail"), "^[\"'`]"),
        "placeholder": flag(F.concat_ws(" ", context, "candidate", "after"), _PLACEHOLDERS),
    }


def scored(found: DataFrame, findings: DataFrame, words: list[str], bound: int = BOUND) -> DataFrame:
    """``found`` with ``score`` and ``secret`` (score of 0.5 or more); ``findings`` are labelled
    rows of the same columns with ``label`` 0 or 1."""
    features = _features(words)
    train = findings.where(F.col("label").isNotNull())
    train = train.orderBy(F.xxhash64("candidate", "before", "lead"), "candidate", "doc_id", "word_no").limit(bound)
    train = keep(train.select(F.col("label").cast("double").alias("label"), *(x.alias(k) for k, x in features.items())))
    ones, every = train.agg(F.count(F.when(F.col("label") == 1, 1)), F.count("*")).first()
    if ones in (0, every):
        share = F.lit(ones / every if every else 0.0)
        return found.withColumns({"score": share, "secret": share >= 0.5})
    assembled = VectorAssembler(inputCols=list(features), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="sqrt")
    model = forest.fit(assembled.transform(train))
    columns = [F.struct(*found.columns).alias("found"), *(x.alias(k) for k, x in features.items())]
    out = model.transform(assembled.transform(found.select(*columns)))
    score = vector_to_array("probability").getItem(1)
    return out.select("found.*", score.alias("score"), (score >= 0.5).alias("secret"))


def rule_labels(found: DataFrame) -> DataFrame:
    """Labels for findings whose form or context leaves no doubt; null for the others.

    Stands in for reviewed findings where there are none: fixed key forms and quoted or bare
    values assigned to a secret's name are 1, plain numbers and placeholders 0. Assigned values
    of letters alone may be either and have no label.
    """
    c, context = F.col("candidate"), F.concat_ws(" ", "before", "lead")
    assigned = context.rlike(_NAMES + r"\W*[=:]\s*[\"']?$")
    sure = c.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$") | c.rlike("^gh[pousr]_[A-Za-z0-9]{36}$") | (
        assigned & c.rlike("[A-Za-z]") & (c.rlike("[0-9]") | (F.col("lead").rlike("[\"'`]$") & c.rlike(r"[^\p{L}]")))
    )
    not_one = c.rlike("^[0-9]+$") | F.concat_ws(" ", context, c).rlike(_PLACEHOLDERS) | (~c.rlike("[0-9]") & ~assigned)
    return found.withColumn("label", F.when(not_one, 0).when(sure, 1))
