"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is the root share of its hashed byte trigrams, and of the words that repeat the word
before them. One weight vector, shared by
all grades, gives a score s; ordered thresholds t_1 < t_2 < ... turn it into tail
probabilities P(grade >= k) = sigmoid(s - t_k), from which follow the expected grade and the
decision to keep. Thresholds stay ordered because each is the one before plus exp of a free
parameter. Training takes at most ``Ordinal.sample`` labelled rows, those of smallest hash;
scoring reads every whole text in bounded pieces and shuffles nothing.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.common import PIECE_BYTES, and_fields, as_bytes, keeps_columns, pieces, release_memory, tidy, word_hashes
from wellspring.workspace import stage

BITS = 15
#: Feature number of the share of repeated words, after those of the trigrams.
REPEATS = 1 << BITS
WIDTH = REPEATS + 1
#: Labelled texts whose features are multiplied at once.
BLOCK = 1024


@dataclass(frozen=True)
class Settings:
    """``sample``: bound on labelled rows used for fitting. ``tail``: the grade whose tail
    probability selects. ``keep``: least such probability of a kept document."""

    sample: int = 8_000
    rounds: int = 150
    rate: float = 0.3
    decay: float = 3e-6
    tail: int = 1
    keep: float = 0.5


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray


def trigrams(data: np.ndarray) -> np.ndarray:
    """The hashed trigram that begins at each byte but the last two."""
    wide = data.astype(np.uint32)
    code = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)
    return ((code ^ (code >> np.uint32(15))) * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS)


def plain(text: bytes) -> np.ndarray:
    """A space, the text, a space: a word's first and last letters are seen as such."""
    return np.frombuffer(b" " + text + b" ", np.uint8)


def profile(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, root of their share): of like length whatever the text's."""
    counts = np.zeros(1 << BITS, np.int64)
    data = plain(text)
    words = repeated = 0
    for piece in pieces(text):
        _, hashes = word_hashes(piece)
        words += len(hashes)
        repeated += int((hashes[1:] == hashes[:-1]).sum())
    for at in range(0, max(1, len(data) - 2), PIECE_BYTES):
        grams = trigrams(data[at : at + PIECE_BYTES + 2])
        counts += np.bincount(grams, minlength=1 << BITS)
    ids = np.flatnonzero(counts)
    shares = np.append(counts[ids] / max(1, counts.sum()), repeated / max(1, words))
    return np.append(ids, REPEATS).astype(np.int32), np.sqrt(shares).astype(np.float32)


def _thresholds(free: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))


def fit(profiles: list, grades: np.ndarray, top: int, settings: Settings) -> Model:
    """Full-batch Adam on the cumulative-link likelihood; same result for the same rows."""
    sizes = np.array([len(ids) for ids, _ in profiles])
    flat = np.concatenate([ids for ids, _ in profiles])
    values = np.concatenate([v for _, v in profiles])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # rows are taken block by block, so that products stay small
    blocks = [(int(at[0]), int(ends[i : i + BLOCK][-1]), at) for i in range(0, len(sizes), BLOCK) for at in [starts[i : i + BLOCK]]]
    above = np.stack([(grades >= k).mean() for k in range(1, top + 1)]).clip(1e-3, 1 - 1e-3)
    cuts = -np.log(above / (1 - above))
    free = np.concatenate((cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))))
    theta = np.concatenate((np.zeros(WIDTH), free))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    size, n = WIDTH, len(grades)
    for step in range(1, settings.rounds + 1):
        scores = np.concatenate([np.add.reduceat(theta[flat[a:b]] * values[a:b], at - a) for a, b, at in blocks])
        t = np.concatenate(([-np.inf], _thresholds(theta[size:]), [np.inf]))
        upper = 1 / (1 + np.exp(np.clip(t[grades] - scores, -40, 40)))
        lower = 1 / (1 + np.exp(np.clip(t[grades + 1] - scores, -40, 40)))
        upper, lower = np.where(grades == 0, 1.0, upper), np.where(grades == top, 0.0, lower)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        slope = -(du - dl) / n
        gradient = np.zeros_like(theta)
        pull = np.split(slope, np.cumsum([len(at) for _, _, at in blocks])[:-1])
        for (a, b, at), each in zip(blocks, pull):
            gradient[:size] += np.bincount(flat[a:b], np.repeat(each, np.diff(at, append=b)) * values[a:b], size)
        gradient[:size] += settings.decay * theta[:size]
        cut = np.array([(du[grades == k].sum() - dl[grades == k - 1].sum()) / n for k in range(1, top + 1)])
        chain = np.exp(theta[size + 1 :])
        tail_sum = np.cumsum(cut[::-1])[::-1]
        gradient[size] = tail_sum[0]
        gradient[size + 1 :] = tail_sum[1:] * chain
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(theta[:size].astype(np.float32), _thresholds(theta[size:]))


def ratings(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """At most ``settings.sample`` labelled texts (text, grade), of smallest hash of doc_id."""
    rated = labels.where("doc_id is not null and grade is not null and grade >= 0")
    rated = rated.groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    bounded = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(bounded), "doc_id")
    return texts.select("doc_id", "text", "grade")


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on (doc_id, grade) rows; grades are 0, 1, 2, ... Without any rating, or with one
    grade only, every text scores alike."""

    def profiled(batches):
        for batch in batches:
            found = [profile(t) for t in as_bytes(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([f[0].tobytes() for f in found], pa.binary()),
                    pa.array([f[1].tobytes() for f in found], pa.binary()),
                    batch["grade"],
                ],
                names=["doc_id", "ids", "shares", "grade"],
            )

    rated = ratings(docs, labels, settings)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, shares binary, grade int"
    found = stage(rated.mapInArrow(tidy(profiled), schema), "quality-sample")
    one_each = found.groupBy("doc_id").agg(F.max_by(F.struct("ids", "shares", "grade"), F.xxhash64("ids")).alias("r"))
    got = one_each.select("doc_id", "r.*").orderBy("doc_id").limit(settings.sample).toArrow()
    grades = np.array(got["grade"].to_pylist(), np.int64)
    top = max(1, int(grades.max())) if len(grades) else 1
    if len(set(grades.tolist())) < 2:
        return Model(np.zeros(WIDTH, np.float32), np.arange(top) - 1.0)
    profiles = [
        (np.frombuffer(i, np.int32), np.frombuffer(s, np.float32))
        for i, s in zip(got["ids"].to_pylist(), got["shares"].to_pylist())
    ]
    return fit(profiles, grades, top, settings)


def score(text: bytes, weights: np.ndarray) -> float:
    ids, shares = profile(text)
    return float(weights[ids] @ shares)


def with_quality(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with expected_grade and tail_probability of ``settings.tail`` for every row.

    Null and empty texts are scored as a text without words; repeated rows score alike; an
    empty table stays empty. Columns of the two names are replaced, others are kept.
    """
    weights, thresholds = model.weights, model.thresholds
    rank = min(max(settings.tail, 1), len(thresholds)) - 1

    def scored(batches):
        for batch in batches:
            s = np.array([score(t, weights) for t in as_bytes(batch["text"])])
            tails = 1 / (1 + np.exp(np.clip(thresholds[None, :] - s[:, None], -40, 40)))
            kept = [n for n in batch.schema.names if n not in ("expected_grade", "tail_probability")]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in kept), pa.array(tails.sum(axis=1)), pa.array(tails[:, rank])],
                names=[*kept, "expected_grade", "tail_probability"],
            )

    kept = docs.drop("expected_grade", "tail_probability")
    return kept.mapInArrow(tidy(scored), and_fields(kept, "expected_grade double, tail_probability double"))


@keeps_columns("doc_id", "text")
def select_quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents whose tail probability reaches ``settings.keep``, with their own columns."""
    model = train(docs, labels, settings)
    release_memory()  # the driver held the whole sample
    found = with_quality(docs, model, settings)
    return found.where(F.col("tail_probability") >= settings.keep).select(docs.columns)
