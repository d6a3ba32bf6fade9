"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a learned lexicon (as written, and after undoing
obfuscation), the strongest word, lexicon words near a second person, capitals,
punctuation, obfuscation rates. The lexicon holds words that labelled toxic rows
favour. Trees learn from labelled rows whose crc32(doc_id) mod 5 is 2, 3 or 4, the
calibration from those with 1; rows with 0 are held out (a null doc_id too).

Lexicon, trees and calibration are fitted on at most ``LABELLED`` labelled rows, the
first in the order of a hash of their doc_id. Every row is scored.

Edge cases: null and empty texts get features of zero and a score like any; without
labelled rows of both kinds every score is the share of label 1 (0 without any);
null labels are no labels; a doc_id labelled twice counts twice; repeated rows are
scored one by one; only doc_id and text are read for a score.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from mentionwise.session import freeze

FOLDS = 5
# the bound of the sample of labelled rows the model is fitted on
LABELLED = 200_000
# the lexicon keeps at most so many words, each of at least so many toxic rows and so many times likelier there
LEXICON = 1000
LEXICON_ROWS = 3
LEXICON_ODDS = 8.0
TREES = 30
DEPTH = 3
# words this close to a second person count as near
NEAR = 5
# fixed values: second persons, and characters that stand for letters in obfuscated words
SECOND_PERSON = {"you", "your", "yours", "u", "ur", "tu", "te", "toi", "vous", "du", "dich", "dir", "ihr", "usted", "ti"}
STAND_INS = str.maketrans("013457@$!|", "oieastasii")
WORD = re.compile(r"[^\s.,;:?\"()\[\]]+")
SYMBOLS = re.compile(r"[^\w]+|_+")
FEATURES = [
    "density", "plain_density", "log_hits", "strongest", "near_you", "capitals", "shouted", "exclaimed", "symbols",
    "hidden", "log_words",
]


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def plain(word: str) -> str:
    """A word in lower case, obfuscation undone."""
    return SYMBOLS.sub("", word.lower().translate(STAND_INS)) or word


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    words = WORD.findall(text or "")
    n = max(len(words), 1)
    hits = as_written = near = shouted = hidden = 0
    strongest, you_at, last_hit = 0.0, -NEAR - 1, -NEAR - 1
    for at, word in enumerate(words):
        lower = word.lower()
        base = lower if lower.isalpha() else plain(word)
        if base != lower and lower.strip("!'*#$%&-_").isalpha() is False:
            hidden += 1
        if len(word) > 1 and word.isupper():
            shouted += 1
        weight = lexicon.get(base)
        if weight is not None:
            hits += 1
            as_written += base == lower
            strongest = max(strongest, weight)
            near += at - you_at <= NEAR
            last_hit = at
        if lower in SECOND_PERSON:
            near += at - last_hit <= NEAR
            you_at = at
    size = max(len(text or ""), 1)
    capitals = sum(map(str.isupper, text or ""))
    symbols = sum((text or "").count(c) for c in "#*$%&|<>@")
    return [
        hits / n, as_written / n, math.log1p(hits), strongest, near / n, capitals / size, shouted / n,
        (text or "").count("!") / n, symbols / size, hidden / n, math.log1p(len(words)),
    ]


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Words with the log odds by which toxic rows favour them; at most LEXICON."""

    @arrow_udf("array<string>")
    def base_words(texts: pa.Array) -> pa.Array:
        return pa.array([sorted({plain(w) for w in WORD.findall(t or "")}) for t in texts.to_pylist()], pa.list_(pa.string()))

    size = labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    total = {r["toxic"]: r["n"] for r in size}
    words = labelled.select("toxic", F.explode(base_words("text")).alias("word"))
    seen = words.groupBy("word").agg(
        F.sum(F.col("toxic").cast("long")).alias("bad"), F.sum((1 - F.col("toxic")).cast("long")).alias("good")
    )
    odds = ((F.col("bad") + 0.5) / (total.get(1, 0) + 1)) / ((F.col("good") + 0.5) / (total.get(0, 0) + 1))
    chosen = seen.where(F.col("bad") >= LEXICON_ROWS).withColumn("odds", odds).where(F.col("odds") >= LEXICON_ODDS)
    top = chosen.orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "word").limit(LEXICON)
    return {r["word"]: math.log(r["odds"]) for r in top.collect()}


def _vectors(lexicon: dict[str, float]):
    @arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py(), lexicon) for t in texts], pa.list_(pa.float64()))

    return run


def with_features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    return docs.withColumn("features", array_to_vector(_vectors(lexicon)(F.col("text"))))


class Model:
    def __init__(self, lexicon, trees, isotonic, share: float):
        self.lexicon, self.trees, self.isotonic, self.share = lexicon, trees, isotonic, share

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``score``."""
        if self.trees is None:
            return docs.withColumn("score", F.lit(self.share))
        scored = self.trees.transform(with_features(docs, self.lexicon))
        scored = scored.withColumn("raw", vector_to_array("probability")[1])
        if self.isotonic is None:
            return scored.withColumnRenamed("raw", "score")
        # a binary search over the steps, however many there are
        return self.isotonic.transform(scored).drop("raw")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of ``labels`` (``doc_id, toxic``) on ``docs`` (``doc_id, text``)."""
    marked = labels.select(F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("l_id").isNotNull() & (fold(F.col("l_id")) != 0)
    )
    marked = marked.orderBy(F.xxhash64("l_id"), "l_id", "toxic").limit(LABELLED)
    rows = docs.select("doc_id", "text").join(F.broadcast(marked), F.col("doc_id") == F.col("l_id"))
    rows = freeze(rows.select("doc_id", "text", "toxic", fold(F.col("doc_id")).alias("fold")), "labelled")
    grown, held = rows.where("fold <> 1"), rows.where("fold = 1")
    share = rows.agg(F.avg("toxic")).first()[0] or 0.0
    if grown.select("toxic").distinct().count() < 2:
        return Model({}, None, None, float(share))
    lexicon = learn_lexicon(grown)
    ready = freeze(
        with_features(grown, lexicon).select("features", F.col("toxic").cast("double").alias("label")), "features"
    )
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=42).fit(ready)
    raw = trees.transform(with_features(held, lexicon)).select(
        vector_to_array("probability")[1].alias("raw"), F.col("toxic").cast("double").alias("label")
    )
    raw = freeze(raw, "raw-scores")
    if raw.select("label").distinct().count() < 2:
        return Model(lexicon, trees, None, float(share))
    return Model(lexicon, trees, calibration(raw), float(share))


def calibration(raw: DataFrame) -> IsotonicRegressionModel:
    """Raw scores to calibrated ones, from rows of ``raw`` and ``label``."""
    return IsotonicRegression(featuresCol="raw", predictionCol="score").fit(raw)


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    scored = learn(docs, labels).score(docs.select("doc_id", "text"))
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
