"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Runs of one to three letters (a word's edge counts as a letter) are hashed. Document frequencies are counted over
all learning documents; the weights are learned from a bounded sample of them by follow-the-regularised-
leader with elastic-net penalties, one document at a time; a temperature fitted on a part of the sample
that the weights have not seen makes the scores probabilities.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from layerhouse.llm.common import text_column, whole_rows


DIMENSIONS = 1 << 15
SAMPLE = 4000
LEAST = 50  #: sampled texts of a language, if it has as many (fixed value)
MOST_CLASSES = 500
UNKNOWN = "und"
CHUNK = 1 << 20
_MULTIPLIERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once in a worker."""
    if not _LETTER:
        table = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
        _LETTER.append(table)
    return _LETTER[0]


def counts(text: str) -> np.ndarray | None:
    """How often each hashed n-gram occurs; None without a letter. Case and signs are folded."""
    total, held, any_letter = np.zeros(DIMENSIONS, np.int64), np.array([32], np.uint64), False
    for start in range(0, len(text), CHUNK):
        points = np.frombuffer(text[start:start + CHUNK].lower().encode("utf-32-le"), np.uint32)
        letter = _letters()[points]
        any_letter = any_letter or bool(letter.any())
        points = np.concatenate([held, np.where(letter, points, 32).astype(np.uint64)])
        points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
        mixed = np.full(len(points), 1, np.uint64)
        fresh = max(0, len(held) - 1)  # n-grams that end in what was held are counted already
        for n, multiplier in enumerate(_MULTIPLIERS, 1):
            mixed = mixed[:len(points) - n + 1] if n == 1 else mixed[:-1] if len(mixed) else mixed
            tail = points[n - 1:]
            mixed = (mixed[:len(tail)] ^ (tail + np.uint64(n))) * multiplier
            mixed = mixed ^ (mixed >> np.uint64(29))
            end = n - 1 + np.arange(len(mixed))
            total += np.bincount((mixed[end > fresh] >> np.uint64(5) & np.uint64(DIMENSIONS - 1)).astype(np.int64), minlength=DIMENSIONS)
        held = points[-2:]
    return total if any_letter else None


def weigh(index: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = np.log1p(count) * idf[index]
    return value / (np.linalg.norm(value) or 1.0)


class Leader:
    """Follow-the-regularised-leader (proximal, per coordinate) with a softmax over the classes."""

    def __init__(self, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((DIMENSIONS, classes))
        self.n = np.zeros((DIMENSIONS, classes))

    def weights(self, index=slice(None)) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, index: np.ndarray, value: np.ndarray, target: int) -> None:
        weights = self.weights(index)
        slope = softmax(value @ weights)
        slope[target] -= 1
        slope = value[:, None] * slope
        grown = self.n[index] + slope * slope
        self.z[index] += slope - (np.sqrt(grown) - np.sqrt(self.n[index])) / self.alpha * weights
        self.n[index] = grown


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(-1, keepdims=True))
    return raised / raised.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, targets: np.ndarray) -> float:
    """The divisor of the logits, from 1/32 to 32, under which the targets are most likely."""
    if not len(targets):
        return 1.0
    grid = 2.0 ** np.linspace(-5, 5, 201)
    loss = [-np.log(softmax(logits / t)[np.arange(len(targets)), targets] + 1e-300).sum() for t in grid]
    return float(grid[int(np.argmin(loss))])


class Model:
    def __init__(self, classes: list[str], idf: np.ndarray, weights: np.ndarray, heat: float):
        self.classes, self.idf, self.weights, self.heat = classes, idf, weights.astype(np.float32), heat

    def predict(self, text: str | None) -> tuple[str, float]:
        found = counts(text) if text and self.classes else None
        if found is None:
            return UNKNOWN, 0.0
        index = np.flatnonzero(found)
        chance = softmax(weigh(index, found[index], self.idf) @ self.weights[index].astype(float) / self.heat)
        best = int(chance.argmax())
        return self.classes[best], min(1.0, float(chance[best]))


def _frequencies(batches):
    total = np.zeros(DIMENSIONS, np.int64)
    for batch in batches:
        for text in batch.column(0):
            found = counts(text.as_py())
            if found is not None:
                total += found > 0
    index = np.flatnonzero(total)
    yield pa.record_batch([pa.array(index, pa.int64()), pa.array(total[index], pa.int64())], names=["index", "n"])


def _sampled(batches):
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            found = counts(text.as_py())
            index = np.flatnonzero(found) if found is not None else np.zeros(0, np.int64)
            rows.append((index, found[index] if found is not None else index))
        yield pa.record_batch([
            batch.column("mark"), batch.column("lang"), pa.array([i.astype("<u2").tobytes() for i, _ in rows], pa.binary()),
            pa.array([c.astype("<u4").tobytes() for _, c in rows], pa.binary())], names=["mark", "lang", "index", "count"])


def held_out(doc_id) -> object:
    """Documents that nothing is learned from; those without an id are among them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def _below(own: DataFrame, mark, bounds: dict[str, int]) -> DataFrame:
    """Rows with a letter whose mark is at most the bound of their language; others' rows go."""
    # An Arrow table is read by the JVM; a list would be an RDD of Python's, which starts workers of another kind beside the others.
    rows = own.sparkSession.createDataFrame(pa.table([pa.array(list(bounds), pa.string()), pa.array(list(bounds.values()), pa.int64())], ["lang", "bound"]))
    near = own.select("text", "lang", mark.alias("mark")).join(F.broadcast(rows), "lang").filter("mark <= bound")
    return near.filter(F.col("text").rlike(r"\p{L}"))


def fit(docs: DataFrame, learn, text: str = "text", lang: str = "lang", sample: int = SAMPLE, rounds: int = 3) -> Model:
    """Learns from the rows where the condition ``learn`` holds and text and language are not null.

    Document frequencies come from all of these, the weights from about ``sample`` distinct texts (twice that at most, but
    one of each language): in each language those of the smallest hashes, as many as its share, ``LEAST`` at least. Every
    language with a text that has a letter is a class; more than ``MOST_CLASSES`` are an error, as the weights of
    all of them lie in the driver's memory. Without such rows every prediction is ``und``.
    """
    own = docs.filter(learn).select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        "text is not null and lang is not null")
    mark = F.xxhash64(F.lit("sample"), "text", "lang")
    held = own.groupBy("lang").agg(F.count("*").alias("n"), F.count_distinct(F.when(F.col("text").rlike(r"\p{L}"), mark)).alias("texts")).collect()
    total = sum(r["n"] for r in held)
    seen = own.select("text").mapInArrow(_frequencies, "index long, n long").groupBy("index").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(DIMENSIONS)
    frequency[[r["index"] for r in seen]] = [r["n"] for r in seen]
    idf = np.log((1 + total) / (1 + frequency)) + 1
    held = [(r["lang"], r["texts"]) for r in held if r["texts"]]
    if len(held) > MOST_CLASSES:
        raise ValueError(f"{len(held)} different values of {lang}; at most {MOST_CLASSES} languages can be learned")
    if not held:
        return Model([], idf, np.zeros((DIMENSIONS, 0)), 1.0)
    least, texts = max(1, min(LEAST, sample // len(held))), sum(n for _, n in held)
    wanted = [(x, n, max(least, math.ceil(sample * n / texts))) for x, n in held]
    # Marks are spread evenly: below the bound lie about twice as many as wanted, of which the smallest are taken.
    bounds = {x: min((1 << 63) - 1, (1 << 64) * (2 * k + 20) // n - (1 << 63)) for x, n, k in wanted}
    lowest = {x: [] for x in bounds}
    for r in _below(own, mark, bounds).select("lang", "mark").distinct().collect():
        lowest[r["lang"]].append(r["mark"])
    bounds = {x: sorted(lowest[x])[:k][-1] for x, _, k in wanted if lowest[x]}
    chosen = _below(own, mark, bounds).groupBy("lang", "mark").agg(F.min("text").alias("text"))
    rows = chosen.select("text", "lang", "mark").mapInArrow(_sampled, "mark long, lang string, index binary, count binary").collect()
    rows = [(r["lang"], np.frombuffer(r["index"], "<u2").astype(np.int64), np.frombuffer(r["count"], "<u4"))
            for r in sorted(rows, key=lambda r: (r["mark"], r["lang"], r["index"])) if r["index"]]
    classes = sorted({x for x, _, _ in rows})
    if not classes:
        return Model([], idf, np.zeros((DIMENSIONS, 0)), 1.0)
    examples = [(index, weigh(index, count, idf), classes.index(x)) for x, index, count in rows]
    place = [0] * len(classes)  # every fifth text of a language is for the temperature; a language with fewer is learned whole
    tuning, training = [], []
    for example in examples:
        place[example[2]] += 1
        (training if place[example[2]] % 5 else tuning).append(example)
    tuning = tuning or training
    leader, draw = Leader(len(classes)), np.random.default_rng(11)
    for _ in range(rounds):
        for i in draw.permutation(len(training)).tolist():
            leader.learn(*training[i])
    weights = leader.weights()
    logits = np.array([value @ weights[index] for index, value, _ in tuning]).reshape(len(tuning), -1)
    return Model(classes, idf, weights, temperature(logits, np.array([t for _, _, t in tuning], np.int64)))


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str | None = "text") -> DataFrame:
    """Rows (doc_id, lang_pred, score), one for each row; doc_id may be of any type.

    Without ``text`` the text is a field of doc_id, which then holds the whole row.

    ``und`` with score 0 if the text is null or has no letter. Repeated rows stay, an empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [sent.value.predict(t.as_py()) for t in text_column(batch)]
            yield pa.record_batch([
                batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    source = docs.select(F.col(doc_id).alias("doc_id"), *([F.col(text).alias("text")] if text else []))
    fields = StructType([source.schema["doc_id"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return source.mapInArrow(run, fields)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score): learned outside the held-out quarter, predicted for all."""
    model = fit(docs, ~held_out(F.col("doc_id")), sample=sample)
    found = predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep(docs: DataFrame, least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows whose language is told with a score of at least ``least``, with all their columns."""
    model = fit(docs, ~held_out(F.col("doc_id")), sample=sample)
    rows = whole_rows(docs)
    found = predict(rows, model, doc_id="_row", text=None).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select("doc_id.*")
