"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: words, and openings of words, that mark toxic documents in the
labelled sample. Features of a text are densities of both, how near they stand to a second
person, capitals, punctuation, and rates of obfuscated and stretched words. Spark's boosted
trees learn from them, and an isotonic regression, fitted on labelled documents that neither
the lexicon nor the trees have seen, turns their scores into probabilities.

A null or empty text has features like any other (zeros). Labels that are null, or of
documents that are not there, teach nothing; a document labelled both ways is toxic. With
labels of one kind only, or none, every score is the share of toxic ones (0 for none). Rows
that repeat are each scored; other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import give_memory_back, packed, remainder, unpacked
from tidemark.sources.scratch import written

# About so many labelled documents are learned from, chosen by a hash of their id.
MOST_LABELLED = 20_000
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
# Defaults of ``fit``: most terms of either kind in the lexicon, and documents a term must mark.
LEXICON_SIZE, LEAST_DOCUMENTS = 2000, 5
LEAST_LOG_ODDS, OPENING = 2.0, 5
NEAR = 5
TREES, DEPTH, STEP, LEAF = 20, 3, 0.3, 5
# Second persons in the languages of the texts: fixed values.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer Sie Ihnen tu te toi ton ta "
    "tes vous votre vos tú ti tuyo usted ustedes vosotros su".lower().split()
)
_WORD = re.compile(r"[^\W\d_]+")
# A match starts where a run of letters does and no run is given back, so a text of one long run is read once.
_MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[0-9@$!*|]++[^\W\d_]++)++")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_PLAIN = str.maketrans("0134578@$!|", "oieastbasil")
FEATURES = (
    "word_density",
    "word_hits",
    "opening_density",
    "opening_hits",
    "weight_density",
    "near_you",
    "you_density",
    "capitals",
    "shouted_words",
    "exclamations",
    "questions",
    "punctuation",
    "masked_words",
    "masked_hits",
    "stretched_words",
    "length",
)


@dataclass(frozen=True)
class Lexicon:
    """Log odds of toxic words, and of the openings of words."""

    words: dict[str, float]
    openings: dict[str, float]


def terms(text: str | None) -> tuple[set[str], set[str]]:
    words = set(_WORD.findall((text or "").lower()))
    return words, {w[:OPENING] for w in words if len(w) > OPENING}


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The values of FEATURES for a text."""
    text = text or ""
    words = _WORD.findall(text.lower())
    n, chars = max(1, len(words)), max(1, len(text))
    known, openings = lexicon.words, lexicon.openings
    hits = [i for i, w in enumerate(words) if w in known]
    opened = [i for i, w in enumerate(words) if w[:OPENING] in openings and len(w) > OPENING]
    people = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    weight = sum(known[words[i]] for i in hits) + sum(openings[words[i][:OPENING]] for i in opened)
    beside = {i + d for i in people for d in range(-NEAR, NEAR + 1)} if hits or opened else set()
    masked = _MASKED.findall(text)
    plain = (m.lower().translate(_PLAIN).replace("*", "") for m in masked)
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper())
    marks, asks = text.count("!"), text.count("?")
    return [
        len(hits) / n,
        math.log1p(len(hits)),
        len(opened) / n,
        math.log1p(len(opened)),
        weight / n,
        float(len(beside.intersection(hits)) + len(beside.intersection(opened))),
        len(people) / n,
        capitals / chars,
        shouted / n,
        marks / chars,
        asks / chars,
        (marks + asks + sum(map(text.count, ".,;:*#@$"))) / chars,
        len(masked) / n,
        float(sum(1 for p in plain if p in known or p[:OPENING] in openings)),
        len(_STRETCHED.findall(text)) / n,
        math.log1p(len(words)),
    ]


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """doc_id, text, toxic and calibrates of about ``most`` labelled documents that are not
    held out. The labels are sent to every executor: ``most`` bounds them."""
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .where(remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    share = min(1.0, most / max(1, known.count()))
    draw = F.pmod(F.xxhash64(F.lit("labelled"), "doc_id"), F.lit(1 << 30))
    chosen = known.where(draw < int(share * (1 << 30)))
    fold = remainder(F.col("doc_id"), FOLDS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(chosen), "doc_id").withColumn("calibrates", fold == CALIBRATION)


def learn_lexicon(
    sample: DataFrame, size: int = LEXICON_SIZE, least: int = LEAST_DOCUMENTS
) -> Lexicon:
    """The ``size`` terms of either kind with the highest log odds, of those in ``least``
    toxic documents or more."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[bool, str, int]] = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                label = toxic.as_py()
                for opening, found in enumerate(terms(text.as_py())):
                    seen.update((bool(opening), term, label) for term in found)
        columns = list(zip(*((*k, n) for k, n in seen.items()), strict=True)) or [()] * 4
        kinds = [pa.bool_(), pa.string(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["opening", "term", "toxic", "n"],
        )

    learned = sample.where("not calibrates").select("text", "toxic")
    totals = dict(learned.groupBy("toxic").count().collect())
    bad, good = totals.get(1, 0), totals.get(0, 0)
    counts = (
        learned.mapInArrow(each, "opening boolean, term string, toxic int, n long")
        .groupBy("opening", "term")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
        )
        .where(F.col("bad") >= least)
    )
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    found = {}
    for opening in (False, True):
        best = counts.where(F.col("opening") == opening).select("term", odds.alias("odds"))
        best = best.where(F.col("odds") >= LEAST_LOG_ODDS)
        found[opening] = dict(best.orderBy(F.desc("odds"), "term").limit(size).collect())
    return Lexicon(found[False], found[True])


def with_features(docs: DataFrame, lexicon: Lexicon, out: str = "features") -> DataFrame:
    """Adds the values of FEATURES. Texts alone go to Python, a slice of rows at a time, and
    its memory is given back between them."""
    words, openings = lexicon.words, lexicon.openings

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Lexicon(words, openings)
        for texts in batches:
            yield pa.array([features(t.as_py(), known) for t in texts], pa.list_(pa.float64()))
            give_memory_back()

    return docs.withColumn(out, each("text"))


@dataclass(frozen=True)
class ToxicityModel:
    """``constant`` is the score where labels could not teach anything else."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float

    def score(self, docs: DataFrame, out: str = "score") -> DataFrame:
        """Adds a score from 0 to 1."""
        others = [c for c in docs.columns if c not in (out, "text")]
        # The other columns travel as one, so that none can clash with those made here.
        row = F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`") for c in others)).alias("_row")
        kept = [F.col("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns if c != out]
        rows = docs.select(row, "text")
        if self.trees is None:
            return rows.select(*kept, F.lit(self.constant).alias(out))
        raw = _raw(self.trees, with_features(rows, self.lexicon, "_features"))
        if self.calibration is not None:
            raw, score = self.calibration.transform(raw), F.col("_calibrated")
        else:
            score = F.col("_raw")
        return raw.select(*kept, F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias(out))


def _raw(trees: GBTClassificationModel, df: DataFrame) -> DataFrame:
    scored = trees.transform(df.withColumn("_vector", array_to_vector("_features")))
    return scored.withColumn("_raw", vector_to_array("_probability")[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most: int = MOST_LABELLED,
    lexicon_size: int = LEXICON_SIZE,
    least_documents: int = LEAST_DOCUMENTS,
) -> ToxicityModel:
    """Learns from the labels of documents that are not held out: of ``most`` at most, with
    a lexicon of ``lexicon_size`` terms of either kind."""
    sample = written(labelled_sample(docs, labels, most), "labelled")
    n, bad = sample.agg(F.count("*"), F.sum("toxic")).first()
    constant = (bad or 0) / n if n else 0.0
    taught = dict(sample.where("not calibrates").groupBy("toxic").count().collect())
    if len(taught) < 2:
        return ToxicityModel(Lexicon({}, {}), None, None, constant)
    lexicon = learn_lexicon(sample, lexicon_size, least_documents)
    rows = written(with_features(sample, lexicon, "_features").drop("text"), "features")
    rows = rows.withColumn("toxic", F.col("toxic").cast("double"))
    learner = GBTClassifier(
        featuresCol="_vector",
        labelCol="toxic",
        predictionCol="_prediction",
        maxIter=TREES,
        maxDepth=DEPTH,
        stepSize=STEP,
        minInstancesPerNode=LEAF,
        seed=7,
    )
    learner = learner.setRawPredictionCol("_margin").setProbabilityCol("_probability")
    trees = learner.fit(
        rows.where("not calibrates").withColumn("_vector", array_to_vector("_features"))
    )
    held = rows.where("calibrates")
    if held.select("toxic").distinct().count() < 2:
        return ToxicityModel(lexicon, trees, None, constant)
    calibration = IsotonicRegression(
        featuresCol="_raw", labelCol="toxic", predictionCol="_calibrated"
    ).fit(_raw(trees, held).select("_raw", "toxic"))
    return ToxicityModel(lexicon, trees, calibration, constant)


def toxicity_report(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    texts = docs.select("doc_id", "text")
    return fit(docs, labels, most).score(texts).select(
        "doc_id",
        (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """The documents that score below 0.5, with the columns they had."""
    scored = fit(docs, labels, most).score(packed(docs, "text"), "score")
    return unpacked(scored.where("score < 0.5"), docs.columns, "text")
