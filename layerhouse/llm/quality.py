"""Quality classifier from weak labels.

Nine overlapping heuristics vote on each text: good, bad, or no opinion. Most look for one symptom and have no
opinion without it; three can also speak for a text. Expectation-maximisation over the counts of all vote
patterns (at most 3^9, whatever the corpus) estimates how each votes on good and on bad texts, and the
posterior of each pattern. The posteriors of a bounded sample train a linear scorer on
hashed features, which judges every text, those included on which the heuristics had no opinion.
No human label is read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from layerhouse.llm.common import string_bytes, text_column, whole_rows

HEURISTICS = ("symbols", "capitals", "shouts", "stutter", "phrases", "lines", "plain", "sentences", "tidy")
DIMENSIONS = 1 << 12
SAMPLE = 8000
CHUNK = 1 << 20

# Classes of bytes: letters and digits stand for themselves as one class, other signs stay apart.
_SHAPE = np.arange(256, dtype=np.uint64)
_SHAPE[97:123] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[128:] = 97
_SHAPE[[9, 11, 12, 13]] = 32
_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[[ord(c) for c in "#$%&*|<>{}[]=~^_\\/@+"]] = 1
_PLAIN = re.compile(rb"[A-Za-z\x80-\xff'-]+[.,;:!?]?")


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def measures(text: bytes) -> tuple[list[float], int]:
    """The measures of the heuristics in their order, and the number of words."""
    counts = np.zeros(256, np.int64)
    data = np.frombuffer(text, np.uint8)
    for start in range(0, len(data), CHUNK):
        counts += np.bincount(data[start:start + CHUNK], minlength=256)
    words = text.split()
    n = len(words)
    marks = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)  # only compared inside this text
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    phrases = n - 2
    if phrases > 0:
        triple = marks[:-2] * np.uint64(3) + marks[1:-1] * np.uint64(5) + marks[2:] * np.uint64(7)
        repeated = 1 - len(np.unique(triple)) / phrases
    else:
        repeated = 0.0
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = counts[[33, 46, 63]].sum()
    plain = sum(1 for _ in filter(_PLAIN.fullmatch, words))
    return [
        _share(counts @ _SYMBOLS, n), _share(upper, upper + lower), _share(counts[33], n),
        _share(np.count_nonzero(marks[1:] == marks[:-1]), n), repeated, _share(len(lines) - len(set(lines)), len(lines)),
        _share(plain, n), _share(n, ends) if ends else float(n)], n


#: (good up to, bad from) of each measure; between them the heuristic has no opinion. Plain words count downwards.
NEVER = -2.0
BOUNDS = ((NEVER, 0.25), (NEVER, 0.30), (NEVER, 0.20), (NEVER, 0.12), (NEVER, 0.55), (NEVER, 0.45), (-0.90, -0.60), (40.0, 120.0))
#: What a tidy text stays below: symbols, capitals, shouts, stutter, phrases.
TIDY = (0.06, 0.15, 0.03, 0.03, 0.25)


def votes(values: list[float], n: int) -> str:
    """One sign for each heuristic: + good, - bad, 0 no opinion. Wordless texts get no opinion at all."""
    if n == 0:
        return "0" * len(HEURISTICS)
    signed = [-v if name == "plain" else v for name, v in zip(HEURISTICS, values)]
    found = "".join("+" if v <= good else "-" if v >= bad else "0" for v, (good, bad) in zip(signed, BOUNDS))
    return found + ("+" if all(v <= most for v, most in zip(values, TIDY)) else "0")


def features(text: bytes, values: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed indices and weights: runs of byte classes taken three at a time, and the measures in steps."""
    total = np.zeros(DIMENSIONS, np.int64)
    held = np.zeros(0, np.uint64)
    data = np.frombuffer(text, np.uint8)
    for start in range(0, len(data), CHUNK):
        shape = np.concatenate([held, _SHAPE[data[start:start + CHUNK]]])
        runs = shape[np.flatnonzero(np.diff(shape.astype(np.int64), prepend=-1))]
        held = runs[-2:]
        if len(runs) > 2:
            mixed = runs[:-2] * np.uint64(0x9E3779B97F4A7C15) + runs[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + runs[2:] * np.uint64(
                0x165667B19E3779F9)
            total += np.bincount((mixed >> np.uint64(52)).astype(np.int64), minlength=DIMENSIONS)
    index = np.flatnonzero(total)
    weight = np.log1p(total[index])
    weight /= np.linalg.norm(weight) or 1.0
    steps = [hash((i, int(np.searchsorted((0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75), v)))) % DIMENSIONS for i, v in enumerate(values[:7])]
    return np.concatenate([index, steps]).astype(np.int64), np.concatenate([weight, np.full(7, 0.5)])


def expectation_maximisation(patterns: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray, float]:
    """(posterior of good for each pattern, chance of each vote, share of good texts).

    The chances are [class: bad, good][vote: -, 0, +][heuristic]; how often a heuristic that speaks is right follows
    from them. Starts from the majority of the votes; a prior holds the heuristics to better than chance, so
    that the classes can not change places.
    """
    names = sorted(patterns)
    vote = np.array([["-0+".index(c) for c in p] for p in names], int).reshape(-1, len(HEURISTICS))
    is_vote = np.stack([vote == v for v in range(3)]).astype(float)
    weight = np.array([patterns[p] for p in names], float)
    balance = (is_vote[2] - is_vote[0]).sum(1) / np.maximum(1, (is_vote[2] + is_vote[0]).sum(1))
    good = np.clip(0.5 + 0.5 * balance, 0.02, 0.98)
    prior = np.array([[4.0, 4.0, 0.5], [0.5, 4.0, 4.0]])[:, :, None]
    chance, share = np.full((2, 3, len(HEURISTICS)), 1 / 3), 0.5
    for _ in range(rounds):
        by_class = np.stack([weight * (1 - good), weight * good])
        seen = np.einsum("cp,vph->cvh", by_class, is_vote) + prior
        chance = seen / seen.sum(1, keepdims=True)
        share = (by_class[1].sum() + 1) / (weight.sum() + 2)
        fit_to = np.einsum("vph,cvh->cp", is_vote, np.log(chance))
        new = 1 / (1 + np.exp(np.clip(fit_to[0] - fit_to[1] + np.log((1 - share) / share), -50, 50)))
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return dict(zip(names, good.tolist())), chance, float(share)


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 12, rate: float = 0.5, keep: float = 1e-4) -> np.ndarray:
    """Weights (the last is the constant) of a logistic scorer on soft labels, by Adagrad in small batches."""
    weights, power = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-3)
    if not rows:
        return weights
    draw = np.random.default_rng(3)
    for _ in range(rounds):
        for batch in np.array_split(draw.permutation(len(rows)), max(1, len(rows) // 64)):
            slope = np.zeros(DIMENSIONS + 1)
            for i in batch.tolist():
                index, value, target = rows[i]
                error = 1 / (1 + np.exp(-np.clip(weights[index] @ value + weights[-1], -30, 30))) - target
                np.add.at(slope, index, error * value)
                slope[-1] += error
            slope = slope / max(1, len(batch)) + keep * weights
            power += slope * slope
            weights -= rate * slope / np.sqrt(power)
    return weights


def _texts(batch):
    data, ends = string_bytes(text_column(batch))
    raw = data.tobytes()
    return (raw[a:b] for a, b in zip(ends[:-1], ends[1:]))


def _vote(batches):
    for batch in batches:
        yield pa.record_batch([pa.array([votes(*measures(t)) for t in _texts(batch)], pa.string())], names=["votes"])


def _featured(batches):
    for batch in batches:
        rows = []
        for text in _texts(batch):
            values, n = measures(text)
            index, weight = features(text, values)
            rows.append((votes(values, n), index.tolist(), weight.tolist()))
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.record_batch([
            batch.column("mark"), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.list_(pa.int64())),
            pa.array(columns[2], pa.list_(pa.float64()))], names=["mark", "votes", "index", "weight"])


class Model:
    """What the fit leaves: posteriors by pattern, chances of votes, share of good texts, weights."""

    def __init__(self, posterior, chance, share, weights):
        self.posterior, self.chance, self.share, self.weights = posterior, chance, share, weights

    def judge(self, text: bytes) -> tuple[str, float, float]:
        values, n = measures(text)
        pattern = votes(values, n)
        if n == 0:
            return pattern, 0.0, 0.0
        index, weight = features(text, values)
        z = float(self.weights[index] @ weight + self.weights[-1])
        return pattern, self.posterior.get(pattern, self.share), float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """The votes of all documents are counted; the ``sample`` distinct texts of the smallest hashes train the
    scorer. Null and wordless texts have no vote and are left out."""
    texts = docs.select(F.col(text).alias("text")).filter("text is not null and trim(text) <> ''")
    patterns = {r["votes"]: r["count"] for r in texts.mapInArrow(_vote, "votes string").groupBy("votes").count().collect()}
    patterns.pop("0" * len(HEURISTICS), None)
    posterior, chance, share = expectation_maximisation(patterns)
    marked = texts.select("text", F.xxhash64(F.lit("sample"), "text").alias("mark"))
    bound = marked.select("mark").distinct().orderBy("mark").limit(sample).agg(F.max("mark")).first()[0]
    chosen = marked.filter(F.col("mark") <= F.lit(bound).cast("long")).groupBy("mark").agg(F.min("text").alias("text")).select("text", "mark")
    rows = chosen.mapInArrow(_featured, "mark long, votes string, index array<long>, weight array<double>").collect()
    rows = sorted(rows)
    weights = train([(np.array(r["index"]), np.array(r["weight"]), posterior.get(r["votes"], share)) for r in rows])
    return Model(posterior, chance, share, weights)


def judge(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str | None = "text", least: float = 0.4) -> DataFrame:
    """Rows (doc_id, votes, posterior, score, keep), one for each row; doc_id may be of any type.

    Without ``text`` the text is a field of doc_id, which then holds the whole row.

    A text without words, or null, scores 0 and is rejected. Repeated rows stay, an empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [sent.value.judge(t) for t in _texts(batch)]
            pattern, posterior, score = list(zip(*found)) or [(), (), ()]
            yield pa.record_batch([
                batch.column(0), pa.array(pattern, pa.string()), pa.array(posterior, pa.float64()), pa.array(score, pa.float64()),
                pa.array([s >= least for s in score], pa.bool_())], names=["doc_id", "votes", "posterior", "score", "keep"])

    source = docs.select(F.col(doc_id).alias("doc_id"), *([F.col(text).alias("text")] if text else []))
    fields = StructType([source.schema["doc_id"], *(StructField(c, kind) for c, kind in (
        ("votes", StringType()), ("posterior", DoubleType()), ("score", DoubleType()), ("keep", BooleanType())))])
    return source.mapInArrow(run, fields)


def keep(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that the classifier fitted on them does not reject, with all their columns."""
    rows = whole_rows(docs)
    return judge(rows, fit(docs, sample=sample), doc_id="_row", text=None).filter("keep").select("doc_id.*")
