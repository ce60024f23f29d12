"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j) over the set of terms of a
text. Terms are its words and the first letters of its longer words, hashed; a term counts
once however often it occurs, so long texts are not diluted. The factors learn pairs of terms
that matter together though neither does alone. Only the text goes into a score.

Training takes at most ``Settings.sample`` labelled rows, those of smallest hash. Scoring
reads whole texts in bounded pieces and shuffles nothing.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.common import and_fields, as_bytes, letters, mixed, pieces, word_hashes
from wellspring.workspace import stage

BITS = 18
#: Letters of the stems that count as terms beside the words.
STEMS = (4, 5)
SIZE = 1 << BITS
TERMS = letters(b"'")


@dataclass(frozen=True)
class Settings:
    """``sample``: bound on labelled rows used for fitting; ``seen`` and
    ``chance``: documents and chi-square a term needs to be learnt, so that chance teaches
    nothing; ``together``: the likelihood ratio that a pair with such a term needs, higher for
    there are many pairs; ``pull``: step of the factors against that of the weights."""

    sample: int = 16_000
    factors: int = 4
    rounds: int = 25
    rate: float = 0.3
    pull: float = 0.2
    decay: float = 0.01
    seen: int = 4
    chance: float = 16.0
    together: float = 32.0
    batch: int = 256


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def stems(text: bytes, starts: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first bytes of the words, for each length in ``STEMS``, of those words that
    have as many."""
    longest = max(STEMS)
    plain = np.append(TERMS[np.frombuffer(text, np.uint8)], np.zeros(longest, np.uint8))
    code = np.zeros(len(starts), np.uint64)
    found = []
    for i in range(longest):
        letter = plain[starts + i]
        starts, code = starts[letter != 0], code[letter != 0] << np.uint64(8) | letter[letter != 0]
        if i + 1 in STEMS:
            found.append(mixed(code + np.uint64((i + 1) << 56)))
    return found


def terms(text: bytes, learnt: np.ndarray | None = None) -> np.ndarray:
    """The distinct hashed terms of a text, or those of them that ``learnt`` marks."""
    found = []
    for piece in pieces(text):
        starts, words = word_hashes(piece, TERMS)
        ids = np.concatenate((words, *stems(piece, starts))) >> np.uint64(64 - BITS)
        found.append(np.unique(ids if learnt is None else ids[learnt[ids]]))
    return np.unique(np.concatenate(found)).astype(np.int32)


def raw_scores(sets: list[np.ndarray], model: Model) -> np.ndarray:
    """Log odds of each set of terms."""
    out = np.empty(len(sets))
    for i, ids in enumerate(sets):
        v = model.factors[ids]
        pairs = 0.5 * float((v.sum(axis=0) ** 2).sum() - (v * v).sum())
        out[i] = model.bias + float(model.weights[ids].sum()) + pairs
    return out


def telling(sets: list[np.ndarray], toxic: np.ndarray, settings: Settings) -> np.ndarray:
    """Which terms are learnt: those whose documents' labels differ from the others' beyond
    chance, by the chi-square of the two-by-two table."""
    none = np.zeros(0, np.int32)
    all_of = np.bincount(np.concatenate([none, *sets]), minlength=SIZE).astype(float)
    marked = [ids for ids, bad in zip(sets, toxic) if bad]
    bad_of = np.bincount(np.concatenate([none, *marked]), minlength=SIZE).astype(float)
    n, bad = len(toxic), toxic.sum()
    gap = bad_of * (n - bad) - (all_of - bad_of) * bad
    spread = np.maximum(all_of * (n - all_of) * bad * (n - bad), 1e-9)
    return (all_of >= settings.seen) & (n * gap**2 / spread >= settings.chance)


def telling_beside(sets: list[np.ndarray], toxic: np.ndarray, learnt: np.ndarray, settings: Settings) -> np.ndarray:
    """``learnt`` and the terms that tell the labels apart among the documents of a learnt term,
    though perhaps not among all: a pair may matter though its second term alone does not. By
    the likelihood ratio, which holds for the small counts of pairs."""
    sizes = np.array([len(ids) for ids in sets])
    flat = np.concatenate([np.zeros(0, np.int32), *sets])
    ends = np.cumsum(sizes)
    hits = np.flatnonzero(learnt[flat])
    hits = hits[np.argsort(flat[hits], kind="stable")]
    owner, of = np.searchsorted(ends, hits, side="right"), flat[hits]
    edges = np.flatnonzero(np.diff(of, prepend=-1))
    found = learnt.copy()
    for a, b in zip(edges, [*edges[1:], len(of)]):
        rows = owner[a:b]
        n, bad = len(rows), toxic[rows].sum()
        if n < 2 * settings.seen or not 0 < bad < n:
            continue
        of_label = np.zeros((2, SIZE), np.int64)
        for at in range(0, n, 1024):
            for label in (0, 1):
                some = [sets[i] for i in rows[at : at + 1024] if toxic[i] == label]
                if some:
                    of_label[label] += np.bincount(np.concatenate(some), minlength=SIZE)
        held = np.flatnonzero(of_label.sum(axis=0) >= settings.seen)
        good_in, bad_in = of_label[:, held].astype(float)
        k = good_in + bad_in
        ratio = np.zeros(len(held))
        for seen, share in ((bad_in, k * bad), (good_in, k * (n - bad)), (bad - bad_in, (n - k) * bad), (n - bad - good_in, (n - k) * (n - bad))):
            ratio += 2 * seen * np.log(np.maximum(seen, 1e-9) * n / np.maximum(share, 1e-9))
        found[held[ratio >= settings.together]] = True
    return found


def fit(sets: list[np.ndarray], toxic: np.ndarray, settings: Settings) -> Model:
    """AdaGrad over small batches in a fixed order; same result for the same rows."""
    rng = np.random.default_rng(7)
    learnt = telling_beside(sets, toxic, telling(sets, toxic, settings), settings)
    sets = [ids[learnt[ids]] for ids in sets]
    share = float(np.clip(toxic.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(share / (1 - share)))
    w, v = np.zeros(SIZE), rng.normal(0, 0.003, (SIZE, settings.factors)) * learnt[:, None]
    seen_w, seen_v = np.full(SIZE, 1e-8), np.full((SIZE, settings.factors), 1e-8)
    for _ in range(settings.rounds):
        order = rng.permutation(len(sets))
        for at in range(0, len(order), settings.batch):
            chosen = order[at : at + settings.batch]
            sizes = np.array([len(sets[i]) for i in chosen])
            flat = np.concatenate([sets[i] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), sizes)
            used, place = np.unique(flat, return_inverse=True)
            vf = v[flat]
            total = np.stack([np.bincount(row, vf[:, f], len(chosen)) for f in range(vf.shape[1])], 1)
            square = np.bincount(row, (vf * vf).sum(axis=1), len(chosen))
            logit = bias + np.bincount(row, w[flat], len(chosen)) + 0.5 * ((total**2).sum(axis=1) - square)
            slope = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - toxic[chosen]
            slope /= len(chosen)
            each = slope[row]
            gw = np.bincount(place, each, len(used)) + settings.decay / len(order) * w[used]
            pull = each[:, None] * (total[row] - vf)
            gv = np.stack([np.bincount(place, pull[:, f], len(used)) for f in range(vf.shape[1])], 1).astype(float)
            gv += settings.decay / len(order) * v[used]
            seen_w[used] += gw**2
            seen_v[used] += gv**2
            w[used] -= settings.rate * gw / np.sqrt(seen_w[used])
            v[used] -= settings.rate * settings.pull * gv / np.sqrt(seen_v[used])
            bias -= settings.rate * float(slope.sum())
    v[~learnt] = 0
    model = Model(bias, w, v)
    return Model(bias - cut_between(raw_scores(sets, model), toxic), w, v)


def cut_between(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The log odds that part the two labels best, in the middle of the gap around them: what
    lies beyond it on the sample is predicted as the majority there."""
    order = np.argsort(scores, kind="stable")
    s, bad = scores[order], toxic[order]
    caught = 1 - np.cumsum(bad) / bad.sum()  # of label 1, above each score
    spared = np.cumsum(1 - bad) / (1 - bad).sum()  # of label 0, up to each score
    distinct = np.append(s[1:] > s[:-1], False)
    if not distinct.any():
        return 0.0
    worth = np.where(distinct, caught + spared, -np.inf)
    best = int(np.argmax(worth))
    return float((s[best] + s[best + 1]) / 2)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on (doc_id, toxic) rows. Rows without a label are ignored; where labels of a
    document differ the larger holds. Without two kinds of label the score is a constant."""

    def hashed(batches):
        for batch in batches:
            found = [terms(t).tobytes() for t in as_bytes(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["toxic"], pa.array(found, pa.binary())], names=["doc_id", "toxic", "terms"]
            )

    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
    marked = marked.agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    rated = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").select("doc_id", "text", "toxic")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = stage(rated.mapInArrow(hashed, f"doc_id {kind}, toxic int, terms binary"), "toxic-sample")
    got = found.orderBy("doc_id", "terms").limit(settings.sample).toArrow()
    toxic = np.array(got["toxic"].to_pylist(), np.float64)
    if len(set(toxic.tolist())) < 2:
        flat = -4.0 if not toxic.any() else 4.0
        return Model(flat, np.zeros(SIZE), np.zeros((SIZE, settings.factors)))
    return fit([np.frombuffer(t, np.int32) for t in got["terms"].to_pylist()], toxic, settings)


def with_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with toxicity, the probability of label 1, for every row.

    Null and empty texts have no terms and get the score of the bias; repeated rows score
    alike; an empty table stays empty. A column of that name is replaced, others are kept.
    """
    kept = docs.drop("toxicity")
    learnt = (model.weights != 0) | (model.factors != 0).any(axis=1)

    def scored(batches):
        for batch in batches:
            odds = raw_scores([terms(t, learnt) for t in as_bytes(batch["text"])], model)
            share = pa.array(1 / (1 + np.exp(-np.clip(odds, -40, 40))))
            yield pa.RecordBatch.from_arrays([*batch.columns, share], names=[*batch.schema.names, "toxicity"])

    return kept.mapInArrow(scored, and_fields(kept, "toxicity double"))
