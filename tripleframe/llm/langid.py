"""Language of documents by a bidirectional gated recurrent network over bytes.

A text is cut into windows of ``WINDOW`` bytes. Two gated recurrent layers read each window, one from either end; at every
byte both states together give probabilities of the languages. A document's probabilities are the mean over all of its
bytes. The network is plain numpy: trained on the driver by backpropagation through time from excerpts of a bounded sample
of labelled rows (``SAMPLE``), applied in Arrow batches to whole texts.

Texts that are null or hold no letter are ``und`` with score 0. Ties go to the language that sorts first. Rows are
independent, so repeated rows are labelled alike. Without labelled rows every text is ``und``. Other columns are carried, but
give way to a result of their name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleframe.llm.common import bounded_sample, map_text

#: States of a layer.
HIDDEN = 8
#: Bytes of a window.
WINDOW = 128
#: Excerpts that are learned from, at most, and their length in characters.
SAMPLE = 4096
EXCERPT = 160
STEPS = 500
BATCH = 256
#: Windows that run side by side.
LANES = 2048
UNKNOWN = "und"
#: The byte beyond the end of a text.
PAD = 256

_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Layer:
    """Weights of one direction, gates in order update, reset, new: input terms by byte (3n, 257), recurrent ones (3n, n).

    States and terms are held as (unit, lane), so every operation runs along contiguous lanes.
    """

    table: np.ndarray
    recurrent: np.ndarray

    def states(self, x: np.ndarray, keep: list | None = None):
        """State after each byte of x (time, lane), one at a time; ``keep`` gets what the backward pass needs."""
        n = self.recurrent.shape[1]
        # The logistic of a is (tanh(a / 2) + 1) / 2: the halves go into the weights.
        half = np.repeat(np.array([0.5, 1.0], np.float32), [2 * n, n])[:, None]
        table, recurrent = self.table * half, self.recurrent * half
        h = np.zeros((n, x.shape[1]), np.float32)
        given, back = np.empty((3 * n, x.shape[1]), np.float32), np.empty((3 * n, x.shape[1]), np.float32)
        for row in x:
            np.take(table, row, axis=1, out=given, mode="clip")
            np.matmul(recurrent, h, out=back)
            gates = given[: 2 * n]
            gates += back[: 2 * n]
            np.tanh(gates, out=gates)
            gates += np.float32(1)
            gates *= np.float32(0.5)
            inner = back[2 * n :].copy() if keep is not None else None
            new = back[2 * n :]
            new *= gates[n:]
            new += given[2 * n :]
            np.tanh(new, out=new)
            before = h
            h = before - new
            h *= gates[:n]
            h += new
            if keep is not None:
                keep.append((before, gates.copy(), new.copy(), inner))
            yield h

    def gradients(self, x: np.ndarray, kept: list, above: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of (table, recurrent), given those of the states: backpropagation through time."""
        n = self.recurrent.shape[1]
        d_recurrent, carry = np.zeros_like(self.recurrent), np.zeros_like(above[0])
        given = [np.empty(0)] * len(x)
        for t in reversed(range(len(x))):
            before, gates, new, inner = kept[t]
            d = carry + above[t]
            z, r = gates[:n], gates[n:]
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            given[t] = np.concatenate([d_z, d_r, d_new])
            d_back = np.concatenate([d_z, d_r, d_new * r])
            d_recurrent += d_back @ before.T
            carry = d * z + self.recurrent.T @ d_back
        flat, where = np.concatenate(given, axis=1), x.ravel()
        return np.stack([np.bincount(where, row, 257) for row in flat]).astype(np.float32), d_recurrent


@dataclass
class Network:
    """Languages, the two layers, and the output weights (language, units of both) with a bias."""

    languages: list[str]
    forward: Layer
    backward: Layer
    output: np.ndarray
    bias: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        """(time, language, lane)."""
        n = HIDDEN
        out = np.empty((len(x), len(self.languages), x.shape[1]), np.float32)
        for t, h in enumerate(self.forward.states(x)):
            np.matmul(self.output[:, :n], h, out=out[t])
        for t, h in enumerate(self.backward.states(x[::-1])):
            out[-1 - t] += self.output[:, n:] @ h
        out += self.bias[:, None]
        return out

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all bytes of each text; zeros for an empty text."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        counts = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(texts)), counts)
        total = np.zeros((len(texts), len(self.languages)))
        if not len(owner):
            return total
        room = np.full((len(owner), WINDOW), PAD, np.int16)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        filled = np.minimum(WINDOW, sizes[owner] - within * WINDOW)
        # The bytes of all texts end to end fill the windows' places row by row.
        room[np.arange(WINDOW) < filled[:, None]] = np.frombuffer(b"".join(texts), np.uint8)
        for at in range(0, len(owner), LANES):
            part = room[at : at + LANES]
            x = np.ascontiguousarray(part.T)
            e = self.logits(x)
            np.exp(np.clip(e, -40, 40, out=e), out=e)
            e *= ((x != PAD) / e.sum(axis=1))[:, None, :]
            for k, lane in enumerate(e.sum(axis=0)):
                total[:, k] += np.bincount(owner[at : at + LANES], lane, len(texts))
        return total / np.maximum(sizes, 1)[:, None]


def windows(texts: list[bytes], size: int) -> np.ndarray:
    """The first ``size`` bytes of excerpts as (time, lane), padded."""
    x = np.full((size, len(texts)), PAD, np.int16)
    for i, t in enumerate(texts):
        b = np.frombuffer(t[:size], np.uint8)
        x[: len(b), i] = b
    return x


def train(texts: list[bytes], labels: list[str], steps: int = STEPS, rate: float = 0.02, seed: int = 3) -> Network:
    """Fit by Adam on the mean cross-entropy of all bytes of excerpts; classes are drawn evenly."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    y = np.array([languages.index(v) for v in labels])
    by_class = [np.flatnonzero(y == k) for k in range(len(languages))]
    n, k = HIDDEN, len(languages)

    def layer() -> Layer:
        return Layer(rng.normal(0, 0.3, (3 * n, 257)).astype(np.float32), rng.normal(0, 0.3, (3 * n, n)).astype(np.float32))

    net = Network(languages, layer(), layer(), rng.normal(0, 0.3, (k, 2 * n)).astype(np.float32), np.zeros(k, np.float32))
    weights = [net.forward.table, net.forward.recurrent, net.backward.table, net.backward.recurrent, net.output, net.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    size = WINDOW // 2
    for step in range(1, steps + 1):
        drawn = np.concatenate([rng.choice(c, -(-BATCH // k)) for c in by_class])
        offsets = [int(rng.integers(0, max(1, len(texts[i]) - size))) for i in drawn]
        x = windows([texts[i][o:] for i, o in zip(drawn, offsets, strict=True)], size)
        kept_a: list = []
        kept_b: list = []
        ahead = np.stack(list(net.forward.states(x, kept_a)))
        behind = np.stack(list(net.backward.states(x[::-1], kept_b)))[::-1]
        states = np.concatenate([ahead, behind], 1)
        e = net.output @ states + net.bias[:, None]
        e = np.exp(e - e.max(1, keepdims=True))
        d = e / e.sum(1, keepdims=True)
        d[:, y[drawn], np.arange(len(drawn))] -= 1
        d *= ((x != PAD) / max(1, (x != PAD).sum()))[:, None, :].astype(np.float32)
        above = net.output.T @ d
        grads = [*net.forward.gradients(x, kept_a, list(above[:, :n])), *net.backward.gradients(x[::-1], kept_b, list(above[::-1, n:]))]
        grads += [np.einsum("tkb,tib->ki", d, states, optimize=True), d.sum((0, 2))]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        pace = rate * (1 - step / (steps + 1))
        for w, g, a, b in zip(weights, grads, first, second, strict=True):
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= (pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, sample: int = SAMPLE, key: str = "doc_id") -> Network | None:
    """Learn from rows (key, text, lang): an excerpt at a hashed place of each of at most ``sample`` rows. None without rows."""
    usable = docs.where("text IS NOT NULL AND lang IS NOT NULL AND text <> ''")
    place = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - EXCERPT, F.lit(0)) + 1).cast("int") + 1
    rows = bounded_sample(usable.select(F.col(key).alias("_key"), "lang", F.substring("text", place, F.lit(EXCERPT)).alias("excerpt")), sample, "_key", "excerpt", "lang")
    if rows.empty:
        return None
    return train([t.encode() for t in rows["excerpt"]], list(rows["lang"]))


def predict(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """Replace the text by ``lang_pred`` and ``score``, the language's mean probability."""

    def make():
        def work(texts: list[str]) -> dict[str, pa.Array]:
            if net is None:
                return {"lang_pred": pa.array([UNKNOWN] * len(texts), pa.string()), "score": pa.array([0.0] * len(texts), pa.float64())}
            p = net.documents([t.encode() for t in texts])
            best = p.argmax(axis=1)
            known = [bool(_LETTER.search(t)) for t in texts]
            names = [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)]
            return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(np.where(known, np.clip(p.max(axis=1), 0, 1), 0.0))}

        return work

    return map_text(docs, text, "lang_pred string, score double", make)
