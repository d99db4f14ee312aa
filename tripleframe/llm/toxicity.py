"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms: its words in lower case; the beginnings of words, which catch compounds; and the
beginnings that several of its words share and that make up a hundredth or a fiftieth of all of them. The score is
the logistic of a bias, the weights of the terms, and the inner products of the latent vectors of all pairs of terms, so a
word that is harmless alone can count next to another. The sum over pairs follows from the sum and the squares of the
vectors, in time linear in the number of terms. Terms whose share among toxic and other documents of the sample does not
differ significantly get no weight, so long documents do not gather noise; the rest is trained by stochastic gradients.

Learned from a bounded sample of labelled rows (``SAMPLE`` per class, those of the smallest hash). Every whole text is
scored; null and empty texts have no terms and score by the bias. Repeated rows score alike. Without labelled rows of both
classes nothing is known, and every text scores one half. Other columns are carried, but give way to a result of their name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleframe.llm.common import forget, map_text, sigmoid

#: Hashed terms.
TERMS = 1 << 20
#: Latent dimensions of a term.
LATENT = 4
#: Labelled rows of each class that are learned from, at most.
SAMPLE = 3000
#: Lengths of the beginnings of words that are terms.
BEGINNINGS = (4, 5, 6)
#: Standard errors by which the shares of a term must differ.
SIGNIFICANT = 5.0
EPOCHS = 20
#: Smallest hashed terms that stand for a document when copies are looked for.
SKETCH = 12
#: Score from which a document counts as toxic.
CUT = 0.7
#: Documents of a training step.
BATCH = 128
#: Words of which a task remembers the terms.
MEMO_WORDS = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def _dense(term: int, level: int) -> int:
    """The term for a beginning that is frequent in the document."""
    return (term * 2654435761 + level * 40503) % TERMS


class Terms:
    """Hashed terms of texts, with a bounded memo by word; only those that matter to ``keep``, if it is given."""

    def __init__(self, keep: np.ndarray | None = None):
        self.memo: dict[str, tuple[tuple[int, ...], tuple[int, ...]]] = {}
        self.keep = None if keep is None else set(keep.tolist())

    def _of(self, word: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """(terms of the word, those of them that are beginnings)."""
        own = zlib.crc32(("=" + word).encode()) % TERMS
        begins = [zlib.crc32(f"{n}{word[:n]}".encode()) % TERMS for n in BEGINNINGS if len(word) >= n]
        if self.keep is not None:
            begins = [b for b in begins if self.keep & {b, _dense(b, 1), _dense(b, 2)}]
        entry = (own, *begins) if self.keep is None or own in self.keep else tuple(begins), tuple(begins)
        if len(self.memo) >= MEMO_WORDS:
            self.memo.clear()
        if len(word) <= 64:
            self.memo[word] = entry
        return entry

    def __call__(self, text: str) -> np.ndarray:
        """Sorted distinct terms of a text."""
        known, of = self.memo.get, self._of
        found: set[int] = set()
        counts: dict[int, int] = {}
        words = _WORD.findall(text.lower())
        for word, n in Counter(words).items():
            terms, begins = known(word) or of(word)
            if terms:
                found.update(terms)
                for b in begins:
                    counts[b] = counts.get(b, 0) + n
        for b, n in counts.items():
            if n >= 2 and n * 100 >= len(words):
                found.add(_dense(b, 1))
                if n * 50 >= len(words):
                    found.add(_dense(b, 2))
        return np.array(sorted(found), dtype=np.int32)


@dataclass
class Machine:
    """Bias, and by sorted term its weight and latent vector; other terms weigh nothing."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    latent: np.ndarray

    def logits(self, docs: list[np.ndarray]) -> np.ndarray:
        """Score of each list of terms before the logistic."""
        sizes = np.array([len(d) for d in docs])
        flat = np.concatenate(docs) if len(docs) else np.empty(0, np.int32)
        owner = np.repeat(np.arange(len(docs)), sizes)
        if not len(self.terms):
            return np.full(len(docs), self.bias)
        at = np.searchsorted(self.terms, flat)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == flat
        at, owner = at[known], owner[known]
        linear = np.bincount(owner, self.weights[at], len(docs))
        pairs = np.zeros(len(docs))
        for f in range(self.latent.shape[1]):
            v = self.latent[at, f]
            pairs += np.bincount(owner, v, len(docs)) ** 2 - np.bincount(owner, v * v, len(docs))
        return self.bias + linear + pairs / 2


def train(docs: list[np.ndarray], toxic: np.ndarray, epochs: int = EPOCHS, rate: float = 0.2, decay: float = 1e-3, seed: int = 7) -> Machine:
    """Fit by AdaGrad on the logistic loss; classes weigh alike."""
    rng = np.random.default_rng(seed)
    support, in_toxic = np.zeros(TERMS, np.int32), np.zeros(TERMS, np.int32)
    for terms, label in zip(docs, toxic, strict=True):  # terms of a document are distinct
        support[terms] += 1
        if label:
            in_toxic[terms] += 1
    rate_1, rate_0 = in_toxic / toxic.sum(), (support - in_toxic) / (1 - toxic).sum()
    pooled = support / len(docs)
    error = np.sqrt(pooled * (1 - pooled) * (1 / toxic.sum() + 1 / (1 - toxic).sum()))
    kept = (support >= 4) & (np.abs(rate_1 - rate_0) >= SIGNIFICANT * error)
    renumber = np.cumsum(kept, dtype=np.int32) - 1
    used = [renumber[d[kept[d]]] for d in docs]
    flat, starts, terms = np.concatenate(used), np.cumsum([0, *map(len, used)]), np.flatnonzero(kept).astype(np.int32)
    n = len(terms)
    w, v, bias = np.zeros(n), rng.normal(0, 0.01, (n, LATENT)), 0.0
    gw, gv, gb = np.full(n, 1e-2), np.full((n, LATENT), 1e-2), 1e-2
    share = toxic.mean()
    weight = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(docs), BATCH):
            part = order[at : at + BATCH]
            idx = np.concatenate([flat[starts[d] : starts[d + 1]] for d in part])
            own = np.repeat(np.arange(len(part)), starts[part + 1] - starts[part])
            vx = v[idx]
            sums = np.stack([np.bincount(own, vx[:, f], len(part)) for f in range(LATENT)], 1)
            squares = np.stack([np.bincount(own, vx[:, f] ** 2, len(part)) for f in range(LATENT)], 1)
            logit = bias + np.bincount(own, w[idx], len(part)) + ((sums**2 - squares).sum(1)) / 2
            error = weight[part] * (sigmoid(logit) - toxic[part]) / len(part)
            gb += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(gb)
            active, where = np.unique(idx, return_inverse=True)
            e = error[own]
            slope = np.bincount(where, e, len(active))
            gw[active] += slope**2
            w[active] -= rate / np.sqrt(gw[active]) * slope
            inner = e[:, None] * (sums[own] - vx)
            slope_v = np.stack([np.bincount(where, inner[:, f], len(active)) for f in range(LATENT)], 1) + decay * v[active]
            gv[active] += slope_v**2
            v[active] -= rate / np.sqrt(gv[active]) * slope_v
    return Machine(float(bias), terms, w, v)


def distinct(docs: list[np.ndarray]) -> list[int]:
    """Numbers of the documents that share less than half of a sketch with every earlier one: copies would vote twice."""
    known: dict[int, set[int]] = {}
    kept = []
    for i, terms in enumerate(docs):
        sketch = np.sort((terms.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24))[:SKETCH].tolist()
        hits = Counter(d for s in sketch for d in known.get(s, ()))
        if not hits or hits.most_common(1)[0][1] * 2 < len(sketch):
            kept.append(i)
            for s in sketch:
                known.setdefault(s, set()).add(i)
    return kept


def calibrated(docs: list[np.ndarray], toxic: np.ndarray) -> Machine:
    """Train on four fifths, then move the bias so that ``CUT`` lies between the classes of the last fifth, nearer to clean ones."""
    kept = distinct(docs)
    docs, toxic = [docs[i] for i in kept], toxic[kept]
    turn = np.arange(len(docs)) % 5
    machine = train([d for d, t in zip(docs, turn, strict=True) if t], toxic[turn > 0])
    logits, y = machine.logits([d for d, t in zip(docs, turn, strict=True) if not t]), toxic[turn == 0]
    if 0 < y.sum() < len(y):
        high, low = np.quantile(logits[y == 0], 0.999), np.quantile(logits[y == 1], 0.01)
        machine.bias += np.log(CUT / (1 - CUT)) - (high + 0.05 + max(0.0, low - high) / 3)
    return machine


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Learn from ``labels`` (doc_id, toxic) and the texts of ``docs``.

    The ids of the sample are at most ``2 * sample`` rows and are broadcast; only the terms of those documents are gathered.
    """
    clean = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    hashed = clean.withColumn("_h", F.xxhash64("doc_id"))
    chosen = [hashed.where(F.col("toxic") == y).orderBy("_h", "doc_id").limit(sample) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1]).select(F.col("doc_id").alias("_id"), "toxic")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).select("doc_id", "toxic", "text")

    def make() -> Callable[[list[str]], dict[str, pa.Array]]:
        forget()
        terms = Terms()
        return lambda texts: {"terms": pa.array([terms(t).tobytes() for t in texts], pa.binary())}

    learned = map_text(rows, "text", "terms binary", make).orderBy("doc_id").toPandas()
    if learned["toxic"].nunique() < 2:
        return Machine(0.0, np.empty(0, np.int32), np.empty(0), np.empty((0, LATENT)))
    return calibrated([np.frombuffer(t, np.int32) for t in learned["terms"]], learned["toxic"].to_numpy())


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Replace the text by ``score``."""

    def make() -> Callable[[list[str]], dict[str, pa.Array]]:
        forget()
        terms = Terms(machine.terms)
        return lambda texts: {"score": pa.array(sigmoid(machine.logits([terms(t) for t in texts])))}

    return map_text(docs, text, "score double", make)
