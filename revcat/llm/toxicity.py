"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the embedding of the word, if enough training texts have it, next
to the mean embedding of its character trigrams. Both directions read windows of
WINDOW words that overlap by WINDOW - STRIDE; attention pools the states of a
window, and a text scores as its worst window, so every word of a whole text
counts. Training takes at most MAX_POSITIVE and MAX_NEGATIVE labelled rows, by a
hash of their identifier, of texts of at most LONGEST characters, until they have
MAX_CHARS. It learns from one window a text and pass: a random one at first, then the
worst of all windows of the whole text. The first number of a word's embedding starts as its
smoothed log-odds between toxic and other training texts, and embeddings move
slowly, so that few labels do not teach single words by heart.

Null and empty texts, and texts without a word, score as a window of padding does.
Repeated rows score alike. Without labels every text scores 0.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revcat.llm.common import small_batches, whole_text

WINDOW, STRIDE = 32, 24
MAX_POSITIVE, MAX_NEGATIVE = 1500, 2500
#: Bounds of the training sample in characters: of one text, and of all that are collected.
LONGEST, MAX_CHARS = 500_000, 40_000_000
WORD_DIM, CHAR_DIM, HIDDEN = 12, 12, 8
CHAR_ROWS = 1 << 13
MIN_TEXTS = 3
#: Passes with random windows, all passes, least steps of gradient descent, texts per step.
WARM, PASSES, STEPS, BATCH = 3, 8, 400, 32
RATE, EMBEDDING_RATE, DECAY = 0.01, 0.001, 1e-4
THRESHOLD = 0.3
#: Windows that are scored together, and words whose input a worker remembers.
SCORE_BATCH, CACHE_WORDS = 4096, 300_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def trigrams(word: str) -> list[int]:
    padded = f"^{word}$"
    return [zlib.crc32(padded[i : i + 3].encode()) % CHAR_ROWS for i in range(max(1, len(padded) - 2))]


@dataclass
class Model:
    vocabulary: dict[str, int]
    weights: dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(gates: np.ndarray, mask: np.ndarray, recurrent: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (time, windows, HIDDEN) of one direction; gates: input to update, reset and candidate."""
    steps, n, _ = gates.shape
    h = np.zeros((n, HIDDEN), np.float32)
    states = np.empty((steps, n, HIDDEN), np.float32)
    for t in range(steps):
        zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + h @ recurrent[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(gates[t, :, 2 * HIDDEN :] + (r * h) @ recurrent[:, 2 * HIDDEN :])
        after = np.where(mask[t][:, None], (1 - z) * h + z * c, h)
        if keep is not None:
            keep.append((h, z, r, c))
        h = states[t] = after
    return states


def _back(d_states: np.ndarray, mask: np.ndarray, recurrent: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates' input and of the recurrent weights."""
    steps, n, _ = d_states.shape
    d_gates = np.zeros((steps, n, 3 * HIDDEN), np.float32)
    d_recurrent, dh = np.zeros_like(recurrent), np.zeros((n, HIDDEN), np.float32)
    for t in reversed(range(steps)):
        h, z, r, c = kept[t]
        dh = dh + d_states[t]
        on = mask[t][:, None]
        d_after = np.where(on, dh, 0)
        dc = d_after * z * (1 - c * c)
        dz = d_after * (c - h) * z * (1 - z)
        d_rh = dc @ recurrent[:, 2 * HIDDEN :].T
        dr = d_rh * h * r * (1 - r)
        d_zr = np.concatenate([dz, dr], axis=1)
        d_recurrent[:, : 2 * HIDDEN] += h.T @ d_zr
        d_recurrent[:, 2 * HIDDEN :] += (r * h).T @ dc
        d_gates[t] = np.concatenate([d_zr, dc], axis=1)
        dh = np.where(on, d_after * (1 - z) + d_rh * r + d_zr @ recurrent[:, : 2 * HIDDEN].T, dh)
    return d_gates, d_recurrent


def _pool(states: np.ndarray, mask: np.ndarray, w: dict[str, np.ndarray]):
    hidden = np.tanh(states @ w["attend"] + w["attend_bias"])
    raw = np.where(mask, hidden @ w["query"], -1e9)
    raw = raw - raw.max(axis=0)
    share = np.exp(raw) * mask
    share /= np.maximum(share.sum(axis=0), 1e-9)
    return hidden, share, np.einsum("tn,tnh->nh", share, states)


def _both(gates: np.ndarray, mask: np.ndarray, w: dict[str, np.ndarray], keep: tuple[list, list] | None = None) -> np.ndarray:
    ahead, back = keep or (None, None)
    forward = _run(gates[:, :, : 3 * HIDDEN], mask, w["forward"], ahead)
    backward = _run(gates[::-1, :, 3 * HIDDEN :], mask[::-1], w["backward"], back)[::-1]
    return np.concatenate([forward, backward], axis=2)


def _logits(gates: np.ndarray, mask: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    _, _, context = _pool(_both(gates, mask, w), mask, w)
    return context @ w["out"] + w["out_bias"][0]


def _windows(n_words: int) -> np.ndarray:
    """Starts of all windows over a text; the last one ends at or after its end."""
    return np.arange(0, max(1, n_words - WINDOW + STRIDE), STRIDE) if n_words > WINDOW else np.zeros(1, np.int64)


class _Inputs:
    """Words as rows of a matrix: what each adds to the gates of both directions."""

    def __init__(self, model: Model):
        self.model, self.rows = model, {}
        self.table = np.zeros((1024, 6 * HIDDEN), np.float32)

    def look_up(self, words: list[str]) -> np.ndarray:
        rows, new = self.rows, set(words).difference(self.rows)
        if new:
            if len(rows) + len(new) > CACHE_WORDS:
                rows.clear()
                new = set(words)
            first = len(rows)
            names = sorted(new)
            rows.update(zip(names, range(first, first + len(names))))
            while len(self.table) < len(rows):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            w = self.model.weights
            grams = [trigrams(x) for x in names]
            sizes = np.array([len(g) for g in grams])
            flat = np.fromiter((g for x in grams for g in x), np.int64, int(sizes.sum()))
            chars = np.add.reduceat(w["chars"][flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
            known = np.array([self.model.vocabulary.get(x, 0) for x in names])
            x = np.concatenate([w["words"][known], chars], axis=1)
            self.table[first : first + len(names)] = x @ w["input"] + w["input_bias"]
        return np.fromiter(map(rows.__getitem__, words), np.int64, len(words))


def score_texts(texts: list[str], inputs: _Inputs) -> np.ndarray:
    """The score of each text: that of its worst window."""
    best = np.full(len(texts), -np.inf)
    rows, owner, pending = [], [], 0

    def flush() -> None:
        nonlocal rows, owner, pending
        if rows:
            # The remembered rows may have been renumbered by a later look-up, so words are looked up here.
            flat = inputs.look_up([w for window in rows for w in window])
            sizes = np.array([len(window) for window in rows])
            mask = np.arange(WINDOW)[:, None] < sizes
            index = np.zeros((WINDOW, len(rows)), np.int64)
            index.T[mask.T] = flat
            logits = _logits(inputs.table[index], mask, inputs.model.weights)
            np.maximum.at(best, np.array(owner), logits)
        rows, owner, pending = [], [], 0

    for i, text in enumerate(texts):
        words = words_of(text)
        for start in _windows(len(words)).tolist():
            rows.append(words[start : start + WINDOW])
            owner.append(i)
            if len(rows) == SCORE_BATCH:
                flush()
    flush()
    return _sigmoid(best)


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model | None:
    """A model of these texts; the same texts in the same order give the same model."""
    if not texts or len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    split = [words_of(t) for t in texts]
    seen = Counter(w for words in split for w in set(words))
    vocabulary = {w: i + 1 for i, w in enumerate(sorted(w for w, n in seen.items() if n >= MIN_TEXTS))}
    size = WORD_DIM + CHAR_DIM

    def normal(*shape: int, scale: float = 0.3) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    prior = np.clip(np.mean(labels), 0.01, 0.99)
    w = {
        "words": normal(len(vocabulary) + 1, WORD_DIM, scale=0.1), "chars": normal(CHAR_ROWS, CHAR_DIM, scale=0.1),
        "input": normal(size, 6 * HIDDEN), "input_bias": np.zeros(6 * HIDDEN, np.float32),
        "forward": normal(HIDDEN, 3 * HIDDEN), "backward": normal(HIDDEN, 3 * HIDDEN),
        "attend": normal(2 * HIDDEN, 8), "attend_bias": np.zeros(8, np.float32), "query": normal(8),
        "out": normal(2 * HIDDEN), "out_bias": np.array([np.log(prior / (1 - prior))], np.float32),
    }
    toxic = Counter(x for words, label in zip(split, labels) if label for x in set(words))
    n_toxic = sum(labels)
    odds = [(toxic[x] + 0.5) / (n_toxic + 1) / ((seen[x] - toxic[x] + 0.5) / (len(texts) - n_toxic + 1)) for x in vocabulary]
    w["words"][1:, 0] = np.clip(np.log(odds), -2, 6) / 2
    w["words"][0, 0] = 0
    model = Model(vocabulary, w)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    grams = {x: trigrams(x) for x in {x for words in split for x in words}}
    starts = [_windows(len(words)) for words in split]
    y = np.array(labels, np.float32)
    step, passes = 0, max(PASSES, -(-STEPS * BATCH // len(split)))
    for turn in range(passes):
        if turn < WARM * passes // PASSES:
            chosen = [int(rng.choice(at)) for at in starts]
        else:
            chosen = _worst(split, starts, _Inputs(model))
        order = rng.permutation(len(split))
        for k in range(0, len(order), BATCH):
            some = order[k : k + BATCH].tolist()
            step += 1
            _learn([split[i][chosen[i] : chosen[i] + WINDOW] for i in some], y[some], model, grams, moments, step)
    return model


def _worst(split: list[list[str]], starts: list[np.ndarray], inputs: _Inputs) -> list[int]:
    """The start of the window of each text that scores highest."""
    windows = [(i, int(a)) for i, at in enumerate(starts) for a in at]
    logits = []
    for k in range(0, len(windows), SCORE_BATCH):
        some = windows[k : k + SCORE_BATCH]
        texts = [split[i][a : a + WINDOW] for i, a in some]
        flat = inputs.look_up([x for t in texts for x in t])
        mask = np.arange(WINDOW)[:, None] < np.array([len(t) for t in texts])
        index = np.zeros((WINDOW, len(texts)), np.int64)
        index.T[mask.T] = flat
        logits.append(_logits(inputs.table[index], mask, inputs.model.weights))
    best: dict[int, tuple[float, int]] = {}
    for (i, a), logit in zip(windows, np.concatenate(logits).tolist()):
        if i not in best or logit > best[i][0]:
            best[i] = (logit, a)
    return [best[i][1] for i in range(len(split))]


def _learn(windows: list[list[str]], y: np.ndarray, model: Model, grams: dict, moments: dict, step: int) -> None:
    """One step of gradient descent (Adam) on the logistic loss."""
    w, n = model.weights, len(windows)
    mask = np.arange(WINDOW)[:, None] < np.array([len(x) for x in windows])
    flat = [x for words in windows for x in words]
    word = np.array([model.vocabulary.get(x, 0) for x in flat], np.int64)
    sizes = np.array([len(grams[x]) for x in flat], np.int64)
    chars = np.fromiter((g for x in flat for g in grams[x]), np.int64, int(sizes.sum()))
    x = np.zeros((len(flat), WORD_DIM + CHAR_DIM), np.float32)
    if flat:
        x[:, :WORD_DIM] = w["words"][word]
        x[:, WORD_DIM:] = np.add.reduceat(w["chars"][chars], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
    gates = np.zeros((n, WINDOW, 6 * HIDDEN), np.float32)
    gates[mask.T] = x @ w["input"] + w["input_bias"]
    gates = gates.transpose(1, 0, 2)
    kept: tuple[list, list] = ([], [])
    states = _both(gates, mask, w, kept)
    hidden, share, context = _pool(states, mask, w)
    error = (_sigmoid(context @ w["out"] + w["out_bias"][0]) - y) / n

    g = {"out": context.T @ error, "out_bias": np.array([error.sum()], np.float32)}
    d_context = error[:, None] * w["out"]
    d_share = np.einsum("nh,tnh->tn", d_context, states)
    d_raw = share * (d_share - (share * d_share).sum(axis=0))
    g["query"] = np.einsum("tn,tnk->k", d_raw, hidden)
    d_hidden = d_raw[:, :, None] * w["query"] * (1 - hidden * hidden)
    g["attend"] = np.einsum("tnh,tnk->hk", states, d_hidden)
    g["attend_bias"] = d_hidden.sum(axis=(0, 1))
    d_states = share[:, :, None] * d_context + d_hidden @ w["attend"].T
    d_forward, g["forward"] = _back(d_states[:, :, :HIDDEN], mask, w["forward"], kept[0])
    d_backward, g["backward"] = _back(d_states[::-1, :, HIDDEN:], mask[::-1], w["backward"], kept[1])
    d_gates = np.concatenate([d_forward, d_backward[::-1]], axis=2).transpose(1, 0, 2)[mask.T]
    g["input"], g["input_bias"] = x.T @ d_gates, d_gates.sum(axis=0)
    dx = d_gates @ w["input"].T
    g["words"], g["chars"] = np.zeros_like(w["words"]), np.zeros_like(w["chars"])
    np.add.at(g["words"], word, dx[:, :WORD_DIM])
    np.add.at(g["chars"], chars, np.repeat(dx[:, WORD_DIM:] / np.maximum(sizes, 1)[:, None], sizes, axis=0))
    for k, grad in g.items():
        m, v = moments[k]
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        rate = EMBEDDING_RATE if k in ("words", "chars") else RATE
        w[k] *= 1 - DECAY if w[k].ndim > 1 and rate == RATE else 1
        w[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)


def is_held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0)) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """A model of the labelled rows that are not held out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~is_held_out("doc_id")).withColumn("order_", F.xxhash64(F.lit("toxic"), F.col("doc_id")))
    some = [known.where(c).orderBy("order_", "doc_id").limit(n) for c, n in (("toxic = 1", MAX_POSITIVE), ("toxic = 0", MAX_NEGATIVE))]
    sample = some[0].union(some[1]).select(F.col("doc_id").alias("id_"), "toxic")
    one = docs.select(F.col(f"`{id_col}`").alias("id_"), whole_text(f"`{text_col}`").alias("text_")).where(F.length("text_") <= LONGEST)
    # At most MAX_POSITIVE + MAX_NEGATIVE rows are broadcast, and their texts trained on.
    rows = one.join(F.broadcast(sample), "id_").groupBy("id_").agg(F.max("toxic").alias("toxic"), F.min("text_").alias("text_"))
    in_turn = Window.orderBy(F.xxhash64("id_"), "id_").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("chars_", F.sum(F.length("text_")).over(in_turn)).where(F.col("chars_") <= MAX_CHARS)
    rows = rows.orderBy("id_").limit(MAX_POSITIVE + MAX_NEGATIVE).collect()
    return train([r["text_"] for r in rows], [r["toxic"] for r in rows])


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample it was trained on

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs = _Inputs(shared.value) if shared.value else None
        for batch in batches:
            scores = score_texts(batch.column(2).to_pylist(), inputs) if inputs else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores.astype(np.float64)), pa.array((scores >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out(id_col).alias("held_out"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
