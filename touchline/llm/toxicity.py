"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Two lexicons, of words and of word beginnings, are learned from labelled documents by
log odds.  The dense features of a text are the densities and strengths of its lexicon hits,
second-person words near them, capitals, punctuation and obfuscation rates.  Boosted
trees score them; an isotonic fit on documents that the trees did not see turns the
margin into a probability.

Lexicons are cross-fitted: the training features of a document come from a lexicon learned
without its fold, else every rare word of a toxic document would look like a sure sign.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import crc_fold, materialise, texts_of, with_arrow_columns

#: Bound of the sample of labelled documents that anything is learned from.
SAMPLE_DOCS = 15_000
#: Bound of each lexicon; least number of toxic documents of an entry, and least log odds less two standard errors.
LEXICON, LEAST_DOCS, LEAST_ODDS = 4000, 3, 1.3
STEM = 4  # letters of a word beginning
FOLDS = 3
THRESHOLD = 0.7
YOU = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie tu te toi ton ta tes vous votre vos "
                "ti tus usted ustedes vosotros os".split())
NEAR = 6  # words
FEATURES = ("hits", "hit_rate", "strength", "top_odds", "distinct_hits", "stem_hits", "stem_rate", "stem_strength",
            "you_rate", "you_near", "caps", "caps_words", "exclaim", "punct", "obfuscated", "log_words")
_WORD = re.compile(r"[^\W_]+")
#: Letters parted by disguise characters, or single letters spelled apart; each run is tried at its start only.
_OBFUSCATED = re.compile(r"(?<=[A-Za-z])[@$!*#0134]++(?=[A-Za-z])|(?<!\w)(?<!\b[A-Za-z][.\-_* ])[A-Za-z](?:[.\-_* ][A-Za-z](?!\w)){3,}+")
_DISGUISE = str.maketrans("013457@$", "oieastas")


@dataclass
class Lexicon:
    """Log odds of words and of word beginnings."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)


def features_of(text: str, lexicon: Lexicon) -> tuple[float, ...]:
    """The dense features of a text, as named in FEATURES; all zero for a text without words."""
    raw = _WORD.findall(text)
    n = len(raw)
    if not n:
        return (0.0,) * len(FEATURES)
    words = [w.lower() for w in raw]
    odds, stem_odds = lexicon.words, lexicon.stems
    at, strength, top = [], 0.0, 0.0
    kinds: set[str] = set()
    obfuscated = 0
    for i, w in enumerate(words):
        if w not in odds and not w.isalpha():
            plain = w.translate(_DISGUISE)
            if plain in odds:
                obfuscated += 1
                w = plain
        if w in odds:
            at.append(i)
            kinds.add(w)
            strength += odds[w]
            top = max(top, odds[w])
    stems = [stem_odds[s] for w in words if len(w) > STEM and (s := w[:STEM]) in stem_odds]
    you = [i for i, w in enumerate(words) if w in YOU]
    near = sum(bisect_right(you, i + NEAR) > bisect_left(you, i - NEAR) for i in at) if you else 0
    letters = sum(map(str.isalpha, text)) if text.isupper() else None
    capitals = letters if letters is not None else sum(map(len, _CAPITALS.findall(text)))
    return (float(len(at)), 100.0 * len(at) / n, strength, top, float(len(kinds)), float(len(stems)), 100.0 * len(stems) / n,
            sum(stems), 100.0 * len(you) / n, near / max(1, len(at)), capitals / len(text),
            sum(len(w) > 1 and w.isupper() for w in raw) / n, 100.0 * text.count("!") / n,
            sum(map(text.count, ".,;:!?*#$%&|")) / n, (obfuscated + len(_OBFUSCATED.findall(text))) / n, math.log(n))


_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")


def _entries(texts: list[str]) -> list[list[str]]:
    """Distinct words of each text, and distinct word beginnings after a tab."""
    out = []
    for t in texts:
        words = {w.lower() for w in _WORD.findall(t)}
        out.append([*words, *{"\t" + w[:STEM] for w in words if len(w) > STEM}])
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int, text: str, key: str, label: str) -> DataFrame:
    """(key, text, toxic, fold): the labelled documents that may be learned from, ``bound`` at most.

    Taken by least hash of the key; a key labelled twice counts as toxic if either says so, and
    of several texts of one key the one of least hash is learned from, whatever their order.
    """
    rows = (labels.where(F.col(label).isNotNull() & (crc_fold(F.col(key), 3) != 1))
            .groupBy(key).agg(F.max(F.col(label).cast("int")).alias("toxic")))
    chosen = rows.orderBy(F.xxhash64(F.lit(5), key), key).limit(bound)
    fold = F.pmod(F.xxhash64(F.lit(6), key), F.lit(FOLDS)).cast("int")
    found = docs.select(key, text).join(F.broadcast(chosen), key)
    least = F.struct(F.xxhash64(text).alias("hash"), F.coalesce(text, F.lit("")).alias("text"))
    found = found.groupBy(key, "toxic").agg(F.min(least).alias("least"))
    return found.select(key, F.col("least.text").alias("text"), "toxic", fold.alias("fold"))


def learn_lexicons(sample: DataFrame) -> list[Lexicon]:
    """Lexicon k leaves fold k out; the last one leaves nothing out.

    Document frequencies are counted by Spark; what is gathered is bounded by LEXICON.
    """
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    entry = [T.StructField("entries", T.ArrayType(T.StringType()))]
    rows = with_arrow_columns(sample, entry, lambda b: [_entries(texts_of(b))], keep=["toxic", "fold"])
    rows = rows.select("toxic", "fold", F.explode("entries").alias("entry"))
    counts = rows.groupBy("entry").agg(*[F.count_if((F.col("fold") == k) & (F.col("toxic") == y)).alias(f"n{k}_{y}")
                                         for k in range(FOLDS) for y in (0, 1)])
    counts = materialise(counts.where(" + ".join(f"n{k}_1" for k in range(FOLDS)) + f" >= {LEAST_DOCS}"), "lexicon_counts")
    lexicons = []
    for left_out in [*range(FOLDS), None]:
        inside = [k for k in range(FOLDS) if k != left_out]
        bad, good = (sum(sizes.get((k, y), 0) for k in inside) for y in (1, 0))
        p, q = (sum(F.col(f"n{k}_{y}") for k in inside) for y in (1, 0))
        odds = F.log((p + 0.5) / (bad - p + 0.5)) - F.log((q + 0.5) / (good - q + 0.5))
        error = F.sqrt(sum(1 / (x + F.lit(0.5)) for x in (p, bad - p, q, good - q)))
        found = counts.select("entry", (odds - 2 * error).alias("odds"), p.alias("p")).where((F.col("p") >= LEAST_DOCS) & (F.col("odds") >= LEAST_ODDS))
        stem = F.col("entry").startswith("\t")
        kept = [found.where(rule).orderBy(F.desc("odds"), F.desc("p"), "entry").limit(LEXICON).collect() for rule in (~stem, stem)]
        lexicons.append(Lexicon({r["entry"]: r["odds"] for r in kept[0]}, {r["entry"][1:]: r["odds"] for r in kept[1]}))
    return lexicons


def with_features(docs: DataFrame, lexicons: list[Lexicon], fold: str | None = None, text: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """``docs`` with one double column tl_<feature> per feature, by the last lexicon or by that of a row's fold."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)  # bounded by LEXICON

    def compute(batch: pa.RecordBatch) -> list:
        texts = texts_of(batch, text)
        which = [-1] * len(texts) if fold is None else batch.column(batch.schema.get_field_index(fold)).to_pylist()
        return list(zip(*[features_of(t, shared.value[k]) for t, k in zip(texts, which)]))

    return with_arrow_columns(docs, [T.StructField(f"tl_{f}", T.DoubleType()) for f in FEATURES], compute, keep)


@dataclass
class ToxicityModel:
    """What ``fit`` learned; trees are None where the sample held one class only, and the score is then its rate."""

    lexicons: list[Lexicon]
    rate: float
    trees: GBTClassificationModel | None = None
    steps: tuple[list[float], list[float]] = ((), ())  # isotonic boundaries and values


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"tl_{f}" for f in FEATURES], outputCol="tl_vector").transform(rows)


def _margin(rows: DataFrame, trees: GBTClassificationModel):
    """Probability of the trees, before calibration."""
    scored = trees.transform(_assembled(rows))
    return scored.withColumn("tl_raw", vector_to_array("tl_probability")[1]).drop("tl_vector", "tl_margin", "tl_probability", "tl_label")


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS, text: str = "text", key: str = "doc_id",
        label: str = "toxic") -> ToxicityModel:
    """Learn from the labelled rows whose crc32(key as text) mod 3 is not 1."""
    sample = materialise(labelled_sample(docs, labels, bound, text, key, label), "toxicity_sample")
    n, bad = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < bad < n:
        return ToxicityModel([Lexicon()], float(bad) / n if n else 0.0)
    lexicons = learn_lexicons(sample)
    rows = with_features(sample, lexicons, "fold", keep=["toxic", "fold"]).repartition(4)
    rows = materialise(rows.withColumn("toxic", F.col("toxic").cast("double")), "toxicity_features")
    # trees learn from two folds, the calibration from the third; a tiny sample may lack a class in either
    calibrating = F.col("fold") == FOLDS - 1
    learn, judge = rows.where(~calibrating), rows.where(calibrating)
    if learn.select("toxic").distinct().count() < 2:
        return ToxicityModel(lexicons, float(bad) / n)
    if judge.select("toxic").distinct().count() < 2:
        judge = learn
    gbt = GBTClassifier(featuresCol="tl_vector", labelCol="toxic", maxIter=20, maxDepth=3, stepSize=0.3, seed=7,
                        minInstancesPerNode=2)
    trees = gbt.fit(_assembled(learn))  # output columns are named so that none of a table's own is hit
    trees.setPredictionCol("tl_label").setRawPredictionCol("tl_margin").setProbabilityCol("tl_probability")
    steps = IsotonicRegression(featuresCol="tl_raw", labelCol="toxic", predictionCol="tl_score").fit(_margin(judge, trees))
    return ToxicityModel(lexicons, float(bad) / n, trees, ([float(b) for b in steps.boundaries.toArray()],
                                                          [float(v) for v in steps.predictions.toArray()]))


def _calibrated(raw, steps: tuple[list[float], list[float]]):
    """Isotonic value by linear interpolation; a thousandth of the raw score keeps texts within a step in order."""
    bounds, values = steps
    at = F.when(raw <= bounds[0], F.lit(values[0]))
    for (b0, v0), (b1, v1) in zip(zip(bounds, values), zip(bounds[1:], values[1:])):
        if b1 > b0:
            at = at.when(raw <= b1, F.lit(v0) + (raw - b0) * ((v1 - v0) / (b1 - b0)))
    return F.lit(0.999) * at.otherwise(F.lit(values[-1])) + F.lit(0.001) * raw


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (the columns in ``keep``) with tl_score, 0 to 1, of each whole text; an empty text has the features of nothing."""
    kept = list(docs.columns if keep is None else keep)
    rows = with_features(docs, model.lexicons, text=text, keep=kept)
    if model.trees is None:
        return rows.select(*kept, F.lit(model.rate).alias("tl_score"))
    return _margin(rows, model.trees).select(*kept, _calibrated(F.col("tl_raw"), model.steps).alias("tl_score"))


def toxicity_table(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS, text: str = "text", key: str = "doc_id",
                   label: str = "toxic") -> DataFrame:
    """(key, held_out, score, predicted) of each document.

    Null and empty texts are scored by the features of nothing.  Null keys are neither learned
    from nor held out; null labels do not count.  Without labels of both classes the score
    is the toxic share of the labels, 0 without any.  Repeated rows give repeated rows, an
    empty table gives an empty result; columns besides key and text are not read.
    """
    model = fit(docs, labels, bound, text, key, label)
    held = F.coalesce(crc_fold(F.col(key), 3) == 1, F.lit(False))
    rows = score(docs.select(key, text, held.alias("held_out")), model, text, keep=[key, "held_out"])
    return rows.select(key, "held_out", F.col("tl_score").alias("score"),
                       F.when(F.col("tl_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS, text: str = "text", key: str = "doc_id",
               label: str = "toxic") -> DataFrame:
    """The rows of ``docs`` (same columns) whose score is under THRESHOLD; the text passes through once, unshuffled."""
    return score(docs, fit(docs, labels, bound, text, key, label), text).where(F.col("tl_score") < THRESHOLD).select(*docs.columns)
