"""A quality classifier by co-training two views of a document.

The content view has the words of the text and the shapes of its tokens; the metadata view has the language, the
source, the length and how the page is laid out. Both learn from labelled rows; then, in rounds, each view's
confident judgements of unlabelled documents become pseudo-labels of the other. Both are calibrated on labelled
rows that no classifier was fitted on, and a last small model combines them.

Fitting uses at most ``MOST_LABELLED`` labelled and ``MOST_POOL`` unlabelled documents, chosen by a hash of
doc_id, so it takes the same time at any size; every document is scored. The model fits in a few MB: the content
view keeps only words seen in ``MIN_DOCS`` fitted documents with a weight that isn't zero.

A document is bad if its quality is 0 or it is toxic. Defined results: a null or empty text has no words and is
scored by its metadata; null labels are ignored, and of several labels of a document a bad one holds; repeated
documents are each scored; without labels of both kinds every document is kept with null scores; columns beyond
those of documents are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from ensemblage.llm.common import plain_words
from ensemblage.session import cut_lineage

MOST_LABELLED = 20_000
MOST_POOL = 10_000
MIN_DOCS = 5
MOST_WORDS = 1 << 15
ROUNDS = 2
CONFIDENT = 0.98
LIMIT = 0.5
CALIBRATION_SHARE = 0.25
#: Weight of the L1 penalty of both views.
PENALTY = 5e-4
CALIBRATION_PENALTY = 1e-4
#: Partitions of the bounded rows that are fitted on; what Spark ML shuffles to add up gradients grows with their number.
FIT_PARTS = 4

_SHAPE = bytes(ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 0x80 else ord("0") if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)
SOURCES, LANGUAGES = 32, 8


class Features:
    """Turns a document into tokens of the content view and numbers of the metadata view."""

    def __init__(self) -> None:
        self.shapes: dict[bytes, str] = {}

    def shape(self, token: bytes) -> str:
        found = self.shapes.get(token)
        if found is None:
            if len(self.shapes) > 100_000:
                self.shapes.clear()
            found = self.shapes[token] = "=" + _RUN.sub(rb"\1", token.translate(_SHAPE)).decode("latin-1")[:8]
        return found

    def content(self, text: str | None) -> list[str]:
        """Distinct words, and distinct shapes of what stands between blanks."""
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = {w.decode("utf-8", "replace") for w in set(plain_words(text))}
        return [*words, *{self.shape(token) for token in set(raw.split())}]

    @staticmethod
    def metadata(text: str | None, lang: str | None, source: str | None) -> list[float]:
        text = text or ""
        raw = text.encode("utf-8", "surrogatepass")
        n = max(len(raw), 1)
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        tokens = raw.split()
        lines = [line for line in raw.split(b"\n") if line.strip()]
        threes = list(zip(tokens, tokens[1:], tokens[2:], strict=False))
        row = [
            math.log1p(len(text)), math.log1p(len(lines)), math.log1p(len(text) / max(len(lines), 1)),
            counts[65:91].sum() / n, counts[97:123].sum() / n, counts[48:58].sum() / n, counts[128:].sum() / n,
            sum(counts[list(b"#*$%&|<>")]) / n, counts[list(b"!?")].sum() / n, counts[list(b".,;:")].sum() / n,
            len(set(tokens)) / max(len(tokens), 1), len(set(threes)) / max(len(threes), 1),
            len(set(lines)) / max(len(lines), 1), float(len(tokens) < 50),
        ]
        for value, cells in ((source, SOURCES), (lang, LANGUAGES)):
            hot = [0.0] * cells
            hot[zlib.crc32((value or "").encode("utf-8", "surrogatepass")) % cells] = 1.0
            row += hot
        return [float(x) for x in row]


N_METADATA = 14 + SOURCES + LANGUAGES
INPUT = ("doc_id", "text", "lang", "source")


def _features(docs: DataFrame) -> DataFrame:
    """doc_id, label, words, metadata of documents with a column label."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            doc_id, text, lang, source, label = batch.columns
            rows = list(zip(text.to_pylist(), lang.to_pylist(), source.to_pylist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [doc_id, label, pa.array([features.content(t) for t, _, _ in rows], pa.list_(pa.string())),
                 pa.array([Features.metadata(*row) for row in rows], pa.list_(pa.float64()))],
                names=["doc_id", "label", "words", "metadata"],
            )

    return docs.select(*INPUT, "label").mapInArrow(extract, f"doc_id {kind}, label double, words array<string>, metadata array<double>")


@dataclass(frozen=True)
class Model:
    """What scoring needs: weights of words, of numbers, and of the combination."""

    words: dict[str, float]
    words_base: float
    numbers: np.ndarray
    numbers_base: float
    scales: tuple[tuple[float, float], tuple[float, float]]  # slope and base that calibrate each view
    combined: tuple[float, float, float, float]  # content, metadata, the larger, base

    def logits(self, words: list[str], numbers: list[float]) -> tuple[float, float, float]:
        weight = self.words.get
        views = (
            self.words_base + sum(weight(w, 0.0) for w in words),
            self.numbers_base + float(self.numbers @ np.array(numbers)),
        )
        content, metadata = (slope * view + base for view, (slope, base) in zip(views, self.scales, strict=True))
        a, b, c, base = self.combined
        return content, metadata, a * content + b * metadata + c * max(content, metadata) + base


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def _chosen(docs: DataFrame, labels: DataFrame, most_labelled: int, most_pool: int) -> DataFrame:
    """Labelled and unlabelled documents for fitting; label is null for the latter."""
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1.0).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0.0))
    known = labels.groupBy("doc_id").agg(bad.alias("label")).where(F.col("label").isNotNull())
    order = (F.xxhash64("doc_id", F.lit(3)), F.col("doc_id"))
    labelled = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(*order).limit(most_labelled)
    pool = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().join(known, "doc_id", "left_anti").orderBy(*order).limit(most_pool)
    wanted = cut_lineage(labelled.unionByName(pool.withColumn("label", F.lit(None).cast("double"))), "fitted_ids")
    # wanted has at most most_labelled + most_pool rows
    return docs.select(*INPUT).join(F.broadcast(wanted), "doc_id")


def _fit(rows: DataFrame, vector: str, penalty: float) -> LogisticRegressionModel:
    learner = LogisticRegression(featuresCol=vector, labelCol="label", regParam=penalty, elasticNetParam=1.0, maxIter=30, tol=1e-4)
    return learner.fit(rows.select(vector, "label").coalesce(FIT_PARTS))


def _with_logit(rows: DataFrame, model: LogisticRegressionModel, name: str) -> DataFrame:
    scored = model.transform(rows).withColumn(name, F.get(vector_to_array("rawPrediction"), F.lit(1)))
    return scored.drop("rawPrediction", "probability", "prediction")


def fit(
    docs: DataFrame, labels: DataFrame, *, most_labelled: int = MOST_LABELLED, most_pool: int = MOST_POOL, rounds: int = ROUNDS,
    confident: float = CONFIDENT, penalty: float = PENALTY,
) -> Model | None:
    """The fitted model, or None if there aren't labels of both kinds."""
    features = cut_lineage(_features(_chosen(docs, labels, most_labelled, most_pool)), "features")
    if features.select("label").where(F.col("label").isNotNull()).distinct().count() < 2:
        return None
    vectorizer = CountVectorizer(inputCol="words", outputCol="content", minDF=MIN_DOCS, vocabSize=MOST_WORDS, binary=True)
    words = vectorizer.fit(features)
    share = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1000)) / 1000.0
    rows = words.transform(features).withColumns({
        "numbers": array_to_vector("metadata"), "held": F.col("label").isNotNull() & (share < CALIBRATION_SHARE),
    }).select("doc_id", "label", "content", "numbers", "held").coalesce(FIT_PARTS).persist()
    try:
        return _co_train(rows, words.vocabulary, rounds, confident, penalty)
    finally:
        rows.unpersist()


def _co_train(rows: DataFrame, vocabulary: list[str], rounds: int, confident: float, penalty: float) -> Model | None:
    labelled = rows.where(F.col("label").isNotNull() & ~F.col("held"))
    if labelled.select("label").distinct().count() < 2:
        labelled = rows.where(F.col("label").isNotNull())  # too few labels to hold any back
    pool = rows.where(F.col("label").isNull())
    taught = {"content": labelled, "numbers": labelled}
    models = {view: _fit(taught[view], view, penalty) for view in taught}
    for _ in range(rounds):
        lessons = {}
        for view, other in (("content", "numbers"), ("numbers", "content")):
            chance = 1 / (1 + F.exp(-F.col("logit")))
            sure = F.when(chance >= confident, 1.0).when(chance <= 1 - confident, 0.0)
            judged = _with_logit(pool, models[view], "logit").withColumn("label", sure).drop("logit")
            lessons[other] = judged.where(F.col("label").isNotNull())
        taught = {view: labelled.unionByName(lessons[view]) for view in lessons}
        models = {view: _fit(taught[view], view, penalty) for view in taught}
    held = rows.where("held")
    if held.select("label").distinct().count() < 2:
        held = rows.where(F.col("label").isNotNull())
    views = _with_logit(_with_logit(held, models["content"], "a"), models["numbers"], "b")
    scored = cut_lineage(views.select("label", "a", "b"), "held_out")
    scales = []
    for view in ("a", "b"):
        line = _fit(scored.select(array_to_vector(F.array(view)).alias("x"), "label"), "x", CALIBRATION_PENALTY)
        scales.append((float(line.coefficients[0]), float(line.intercept)))
    calibrated = [F.col(v) * s + b for v, (s, b) in zip(("a", "b"), scales, strict=True)]
    joint = scored.select(array_to_vector(F.array(*calibrated, F.greatest(*calibrated))).alias("x"), "label")
    combined = _fit(joint, "x", CALIBRATION_PENALTY)
    weights = models["content"].coefficients.toArray()
    return Model(
        {vocabulary[i]: float(weights[i]) for i in np.flatnonzero(weights)}, float(models["content"].intercept),
        models["numbers"].coefficients.toArray(), float(models["numbers"].intercept), (scales[0], scales[1]),
        (*map(float, combined.coefficients), float(combined.intercept)),
    )


def score(docs: DataFrame, model: Model | None, limit: float = LIMIT) -> DataFrame:
    """doc_id, p_content, p_metadata, p_bad (chances of a bad document) and kept, for every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    if model is None:
        nothing = F.lit(None).cast("double")
        return docs.select("doc_id", nothing.alias("p_content"), nothing.alias("p_metadata"), nothing.alias("p_bad"), F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MOST_WORDS

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, known = Features(), shared.value
        for batch in batches:
            doc_id, *columns = batch.columns
            logits = [known.logits(features.content(t), Features.metadata(t, lang, s)) for t, lang, s in zip(*(c.to_pylist() for c in columns), strict=True)]
            chances = [[_sigmoid(x) for x in row] for row in logits]
            yield pa.RecordBatch.from_arrays(
                [doc_id, *(pa.array([row[i] for row in chances], pa.float64()) for i in range(3)), pa.array([row[2] <= limit for row in chances], pa.bool_())],
                names=["doc_id", "p_content", "p_metadata", "p_bad", "kept"],
            )

    return docs.select(*INPUT).mapInArrow(judge, f"doc_id {kind}, p_content double, p_metadata double, p_bad double, kept boolean")


def kept(docs: DataFrame, model: Model | None, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that aren't taken for bad."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MOST_WORDS
    places = [docs.columns.index(name) for name in INPUT[1:]]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, known = Features(), shared.value
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in places), strict=True)
            bad = [_sigmoid(known.logits(features.content(t), Features.metadata(t, lang, s))[2]) for t, lang, s in rows]
            yield batch.filter(pa.array([p <= limit for p in bad], pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
