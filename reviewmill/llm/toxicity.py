"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as the embedding of the word (rare ones share one) next to the embeddings of its
character n-grams, so that unseen inflections of a known stem still count. Two recurrent
passes read a window of words, attention pools the states, one output scores the window.
Training sees documents: a document is toxic unless all of its windows are clean (noisy or).
A document's score is the highest of all its windows, over the whole text. Each begins half a
window after the one before it, so a passage of up to 25 words stands whole in one of them, and
of a longer one at least 25 words and half the rest up to 48 do.

Training uses at most MOST_TOXIC and MOST_CLEAN labelled documents with a word, the first in
hash order, of any length and whole. The sample ends early with the document that brings it to
TOXIC_CHARS or CLEAN_CHARS characters, so one document of each kind is in whatever its length.
This sample alone is gathered in one task. Scoring has no shuffle: the model (fixed size) is
sent to the tasks.

Defined results: null and empty texts, and texts without a word, score 0; if of either kind no
labelled document outside the held-out quarter has a word, nothing can be learned: every score
is 0, with a warning; repeated rows score alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import io
import re
import warnings
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_TOXIC = 1_000
MOST_CLEAN = 2_000
TOXIC_CHARS = 10_000_000
CLEAN_CHARS = 20_000_000
WINDOW = 48
STRIDE = WINDOW // 2
HIDDEN = 8
WORD_DIM = 16
GRAM_DIM = 16
WORDS = 8_192
WORD_DOCS = 4
GRAMS = 1 << 14
GRAM_SIZES = (3, 4)
EPOCHS = 3
BATCH_DOCS = 48
RATE = 0.01
CACHED_WORDS = 100_000
LEARNED_WORDS = 10_000
CHUNK_CHARS = 1 << 19
WINDOW_BATCH = 2_048
THRESHOLD = 0.3
SHUT = -30.0  # keeps an update gate closed, so padding passes a state on unchanged

_WORD = re.compile(r"\w+")
A_WORD = r"[\p{L}\p{N}_]"  # what \w is to Python, for Spark
SCHEMA = "doc_id long, score double, windows long, top_window long"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of the words with marked ends, and the word of each."""
    sizes = np.array([len(w) + 2 for w in words])
    points = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(words)), sizes)
    grams, owners = [], []
    mixed = np.zeros(len(points), np.uint64)
    for n in range(1, max(GRAM_SIZES) + 1):
        last = len(points) - n + 1
        if last <= 0:
            break
        mixed = mixed[:last] * np.uint64(0x100000001B3) + points[n - 1 :].astype(np.uint64) + np.uint64(n)
        if n in GRAM_SIZES:
            inside = owner[:last] == owner[n - 1 :]
            spread = mixed[inside] * np.uint64(0x9E3779B97F4A7C15)
            grams.append((spread >> np.uint64(40)).astype(np.int64) % GRAMS)
            owners.append(owner[:last][inside])
    return np.concatenate(grams or [np.zeros(0, np.int64)]), np.concatenate(owners or [np.zeros(0, np.int64)])


def window_starts(count: int) -> range:
    """First words of the windows; the last window reaches the last word."""
    return range(0, max(1, count - WINDOW + STRIDE), STRIDE) if count else range(0)


def window_index(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the documents as rows of word numbers (-1 pads), and their documents."""
    lengths = [len(d) for d in documents]
    flat = np.concatenate([*documents, np.zeros(0, np.int64)]).astype(np.int64)
    ends = np.cumsum(lengths)
    starts, owner = [], []
    for i, n in enumerate(lengths):
        begin = ends[i] - n
        found = [begin + s for s in window_starts(n)]
        starts += found
        owner += [i] * len(found)
    starts, owner = np.array(starts, np.int64), np.array(owner, np.int64)
    at = starts[:, None] + np.arange(WINDOW)
    padded = at >= ends[owner][:, None] if len(owner) else np.zeros((0, WINDOW), bool)
    return np.where(padded, -1, flat[np.minimum(at, max(len(flat) - 1, 0))]) if len(flat) else at, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _summed(keys: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """values added up per key, as a table of ``rows`` rows."""
    total = np.zeros((rows, values.shape[1]), np.float32)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        total[keys[first]] = np.add.reduceat(values, first, axis=0)
    return total


class Network:
    """Parameters, the forward pass over windows, and its gradient."""

    def __init__(self, vocabulary: dict[str, int], parameters: dict[str, np.ndarray] | None = None) -> None:
        self.vocabulary = vocabulary
        self.p = parameters or self._initial(len(vocabulary) + 1)

    @staticmethod
    def _initial(words: int) -> dict[str, np.ndarray]:
        draw, h = np.random.default_rng(7), HIDDEN
        inputs = WORD_DIM + GRAM_DIM
        shapes = {
            "word": ((words, WORD_DIM), 0.1),
            "gram": ((GRAMS, GRAM_DIM), 0.1),
            "input": ((inputs, 6 * h), inputs**-0.5),
            "bias": ((6 * h,), 0),
            "forward": ((h, 3 * h), h**-0.5),
            "backward": ((h, 3 * h), h**-0.5),
            "attend": ((2 * h,), h**-0.5),
            "output": ((2 * h,), h**-0.5),
            "offset": ((1,), 0),
        }
        found = {k: (draw.standard_normal(s) * scale).astype(np.float32) for k, (s, scale) in shapes.items()}
        found["offset"][:] = -2
        return found

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, vocabulary=np.array(list(self.vocabulary), dtype=str), **self.p)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Network:
        found = dict(np.load(io.BytesIO(data)))
        words = found.pop("vocabulary").tolist()
        return Network({w: i + 1 for i, w in enumerate(words)}, found)

    def features(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Input of every word: its embedding and the scaled sum of its n-grams'."""
        ids = np.array([self.vocabulary.get(w, 0) for w in words])
        grams, owner = gram_rows(words)
        counts = np.bincount(owner, minlength=len(words)).astype(np.float32)
        scale = (1 / np.sqrt(np.maximum(counts, 1))).astype(np.float32)
        summed = _summed(owner, self.p["gram"][grams], len(words)) * scale[:, None]
        return np.hstack([self.p["word"][ids], summed]), (ids, grams, owner, scale)

    def gates(self, inputs: np.ndarray, room: int = 0) -> list[np.ndarray]:
        """What each word adds to the gates, one table per direction; the last row, after
        ``room`` free ones, is padding."""
        rows = inputs @ self.p["input"] + self.p["bias"]
        tables = []
        for way in range(2):
            table = np.zeros((len(rows) + room + 1, 3 * HIDDEN), np.float32)
            table[: len(rows)] = rows[:, 3 * HIDDEN * way : 3 * HIDDEN * (way + 1)]
            table[-1, :HIDDEN] = SHUT
            tables.append(table)
        return tables

    def run(self, gates: list[np.ndarray], windows: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """Logit of every window; with ``keep`` also what the gradient needs."""
        h, count = HIDDEN, len(windows)
        states = np.empty((WINDOW, count, 2 * h), np.float32)
        trace: list = [[], []]
        for way, (name, steps) in enumerate(
            (("forward", range(WINDOW)), ("backward", range(WINDOW - 1, -1, -1)))
        ):
            inner = self.p[name]
            state = np.zeros((count, h), np.float32)
            for t in steps:
                given = gates[way][windows[:, t]]
                mixed = state @ inner
                both = given[:, : 2 * h] + mixed[:, : 2 * h]
                np.negative(both, out=both)
                np.exp(both, out=both)
                both += 1
                np.reciprocal(both, out=both)
                new = both[:, h:] * mixed[:, 2 * h :]
                new += given[:, 2 * h :]
                np.tanh(new, out=new)
                if keep:
                    trace[way].append((t, state, both, mixed[:, 2 * h :], new))
                change = new - state
                change *= both[:, :h]
                state = state + change
                states[t, :, h * way : h * (way + 1)] = state
        score = states @ self.p["attend"]
        score[windows.T == -1] = -1e9
        score = np.exp(score - score.max(0))
        score /= score.sum(0)
        pooled = np.einsum("tn,tnh->nh", score, states)
        return pooled @ self.p["output"] + self.p["offset"], [states, score, pooled, trace]

    def gradient(self, windows: np.ndarray, rows: int, slope: np.ndarray, kept: list) -> tuple[np.ndarray, dict]:
        """Gradient by the gates of each word, and by the other parameters, from the slope of
        the loss by each window's logit."""
        h = HIDDEN
        states, score, pooled, trace = kept
        by = {"output": pooled.T @ slope, "offset": np.array([slope.sum()])}
        d_pooled = slope[:, None] * self.p["output"]
        d_score = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = score * (d_score - (score * d_score).sum(0))
        by["attend"] = np.einsum("tn,tnh->h", d_score, states)
        d_states = score[:, :, None] * d_pooled + d_score[:, :, None] * self.p["attend"]
        d_gates = np.zeros((WINDOW, len(windows), 6 * h), np.float32)
        for way, name in enumerate(("forward", "backward")):
            inner, first = self.p[name], 3 * h * way
            by[name] = np.zeros_like(inner)
            d_state = np.zeros((len(windows), h), np.float32)
            for t, state, both, mixed, new in reversed(trace[way]):
                d_state = d_state + d_states[t, :, first // 3 : first // 3 + h]
                update, reset = both[:, :h], both[:, h:]
                d_new = d_state * update * (1 - new**2)
                d_both = np.hstack([d_state * (new - state), d_new * mixed]) * both * (1 - both)
                d_mixed = np.hstack([d_both, d_new * reset])
                d_gates[t, :, first : first + 2 * h] = d_both
                d_gates[t, :, first + 2 * h : first + 3 * h] = d_new
                by[name] += state.T @ d_mixed
                d_state = d_state * (1 - update) + d_mixed @ inner.T
        flat = np.where(windows.T == -1, rows, windows.T).ravel()
        return _summed(flat, d_gates.reshape(-1, 6 * h), rows + 1)[:rows], by


def document_loss(logits: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean cross entropy of the documents under noisy or, and its slope by each logit."""
    chance = _sigmoid(logits.astype(np.float64))
    clean = np.bincount(owner, -np.logaddexp(0, logits.astype(np.float64)), len(toxic))
    hit = -np.expm1(np.minimum(clean, -1e-9))
    loss = -np.where(toxic == 1, np.log(hit), clean).mean()
    by_clean = np.where(toxic == 1, np.exp(clean) / hit, -1.0)
    return loss, (-by_clean[owner] * chance / len(toxic)).astype(np.float32)


def batch_gradient(
    network: Network, inputs: np.ndarray, windows: np.ndarray, owner: np.ndarray, toxic: np.ndarray
) -> tuple[np.ndarray, dict]:
    """Gradient of the documents' loss. What it needs is kept for WINDOW_BATCH windows at a time;
    when there are more, each part runs again once the slopes of all windows are known."""
    gates = network.gates(inputs)
    parts = [slice(i, i + WINDOW_BATCH) for i in range(0, len(windows), WINDOW_BATCH)]
    if len(parts) == 1:
        logits, kept = network.run(gates, windows, keep=True)
        return network.gradient(windows, len(inputs), document_loss(logits, owner, toxic)[1], kept)
    logits = np.concatenate([network.run(gates, windows[part])[0] for part in parts])
    slope = document_loss(logits, owner, toxic)[1]
    d_rows, by = np.zeros((len(inputs), 6 * HIDDEN), np.float32), {}
    for part in parts:
        kept = network.run(gates, windows[part], keep=True)[1]
        more, more_by = network.gradient(windows[part], len(inputs), slope[part], kept)
        d_rows += more
        by = {k: by.get(k, 0) + g for k, g in more_by.items()}
    return d_rows, by


def train(texts: list[str], toxic: list[int], epochs: int = EPOCHS) -> Network:
    documents = [words_of(t) for t in texts]
    some = [i for i, d in enumerate(documents) if d]
    documents, labels = [documents[i] for i in some], np.array([toxic[i] for i in some])
    spread = Counter(w for d in documents for w in set(d))
    common = sorted(((-n, w) for w, n in spread.items() if n >= WORD_DOCS))[:WORDS]
    network = Network({w: i + 1 for i, (_, w) in enumerate(common)})
    draw = np.random.default_rng(11)
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    step, steps = 0, max(1, epochs * -(-len(documents) // BATCH_DOCS))
    for _ in range(epochs):
        order = draw.permutation(len(documents))
        for begin in range(0, len(order), BATCH_DOCS):
            chosen = order[begin : begin + BATCH_DOCS]
            words = list(dict.fromkeys(w for i in chosen for w in documents[i]))
            number = {w: i for i, w in enumerate(words)}
            windows, owner = window_index([np.array([number[w] for w in documents[i]]) for i in chosen])
            inputs, (ids, grams, owners, scale) = network.features(words)
            unseen = draw.random(len(words)) < 0.3  # learn to do without the word itself
            ids = np.where(unseen, 0, ids)
            inputs[:, :WORD_DIM] = network.p["word"][ids]
            d_rows, by = batch_gradient(network, inputs, windows, owner, labels[chosen])
            by |= {"input": inputs.T @ d_rows, "bias": d_rows.sum(0)}
            d_inputs = d_rows @ network.p["input"].T
            by["word"] = _summed(ids, d_inputs[:, :WORD_DIM], len(network.p["word"]))
            d_grams = (d_inputs[:, WORD_DIM:] * scale[:, None])[owners]
            by["gram"] = _summed(grams, d_grams, GRAMS)
            step += 1
            rate = RATE * min(1, 1.1 - step / steps)
            for k, g in by.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.005 * (g * g - second[k])
                unbiased = first[k] / (1 - 0.9**step), second[k] / (1 - 0.995**step)
                network.p[k] -= (rate * unbiased[0] / (np.sqrt(unbiased[1]) + 1e-8)).astype(np.float32)
    return network


class Scorer:
    """Scores texts; the gates of words seen lately are kept, at most CACHED_WORDS of them."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.gates = self._table(0)

    def _table(self, room: int) -> list[np.ndarray]:
        return self.network.gates(np.zeros((0, WORD_DIM + GRAM_DIM), np.float32), room)

    def _learn(self, words: list[str]) -> None:
        count, more = len(self.number), len(words)
        if count + more >= len(self.gates[0]):
            old, self.gates = self.gates, self._table(2 * (count + more))
            for way in range(2):
                self.gates[way][:count] = old[way][:count]
        for a in range(0, more, LEARNED_WORDS):  # the n-grams of a slice are held at once
            some = words[a : a + LEARNED_WORDS]
            found = self.network.gates(self.network.features(some)[0])
            for way in range(2):
                self.gates[way][count + a : count + a + len(some)] = found[way][:-1]
        self.number.update(zip(words, range(count, count + more), strict=True))

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, number of windows and best window of each text."""
        documents = [words_of(t) for t in texts]
        if len(self.number) > CACHED_WORDS:
            self._forget()
        unknown = set().union(*documents).difference(self.number)
        if unknown:
            self._learn(list(unknown))
        number = self.number.__getitem__
        numbered = [np.fromiter(map(number, d), np.int64, len(d)) for d in documents]
        windows, owner = window_index(numbered)
        parts = [windows[i : i + WINDOW_BATCH] for i in range(0, len(windows), WINDOW_BATCH)]
        logits = np.concatenate([np.zeros(0), *(self.network.run(self.gates, part)[0] for part in parts)])
        chance = _sigmoid(logits)
        best, top = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        counts = np.bincount(owner, minlength=len(texts))
        begins = np.cumsum(counts) - counts
        for i in np.flatnonzero(counts):
            own = chance[begins[i] : begins[i] + counts[i]]
            top[i] = own.argmax()
            best[i] = own[top[i]]
        return best, counts, top


def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """The bounded sample: ``toxic, place, text``, the first documents of each label in hash
    order that have a word. A document with several labels counts as toxic if one of them says
    so; rows that repeat count once."""
    known = labels.filter(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max(label).alias("toxic"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    mark = F.xxhash64("text").alias("mark")
    worded = texts.filter(F.rlike("text", F.lit(A_WORD)))
    found = worded.select("doc_id", mark, F.length("text").cast("long").alias("chars")).join(known, "doc_id")
    found = found.distinct().withColumn("place", F.xxhash64("doc_id"))
    # the running length is taken over the first rows only, never over all labelled ones
    earlier = Window.partitionBy("toxic").orderBy("place", "doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1)
    chosen = None
    for value, most, chars in ((1, MOST_TOXIC, TOXIC_CHARS), (0, MOST_CLEAN, CLEAN_CHARS)):
        part = found.filter(F.col("toxic") == value).orderBy("place", "doc_id", "mark").limit(most)
        part = part.withColumn("before", F.coalesce(F.sum("chars").over(earlier), F.lit(0)))
        part = part.filter(F.col("before") < chars).select("doc_id", "mark", "toxic", "place")
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = texts.select("doc_id", "text", mark).join(F.broadcast(chosen), ["doc_id", "mark"])
    return sample.dropDuplicates(["doc_id", "mark"]).select("toxic", "place", "text")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> bytes | None:
    """A trained model, or None with a warning if no document of a kind can be learned from."""

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "text"])
        if rows["toxic"].nunique() < 2:
            return pd.DataFrame({"model": []})
        rows = rows.sort_values("toxic", ascending=False, kind="stable")
        network = train(rows["text"].tolist(), rows["toxic"].tolist())
        return pd.DataFrame({"model": [network.dump()]})

    sample = training_rows(docs, labels, doc_id, text, label)
    found = sample.groupBy().applyInPandas(learn, "model binary").collect()
    if not found:
        warnings.warn("toxicity: no labelled document with a word of one kind, every score is 0", stacklevel=2)
        return None
    return bytes(found[0].model)


def score_documents(docs: DataFrame, model: bytes | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id, score, windows, top_window`` (the number of the highest window)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if model is None:
        zero = F.lit(0).cast("long")
        return rows.select("doc_id", F.lit(0.0).alias("score"), zero.alias("windows"), zero.alias("top_window"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Network.load(sent.value))
        for batch in batches:
            for ids, texts in text_chunks(batch, CHUNK_CHARS):
                best, counts, top = scorer.score(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(best), pa.array(counts, pa.int64()), pa.array(top)],
                    ["doc_id", "score", "windows", "top_window"],
                )

    return rows.mapInArrow(score, SCHEMA)


def clean_documents(docs: DataFrame, model: bytes | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns, where they are read."""
    if model is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Network.load(sent.value))
        for batch in batches:
            numbered = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(at)], ["n", "t"])
            for rows, texts in text_chunks(numbered, CHUNK_CHARS):
                best = scorer.score(texts)[0]
                yield batch.take(rows.filter(pa.array(best < threshold)))

    return docs.mapInArrow(clean, docs.schema)


def text_chunks(batch: pa.RecordBatch, chars: int) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts of a batch, in slices of about ``chars`` characters."""
    texts, first, size = [], 0, 0
    for i, value in enumerate(batch.column(1)):
        texts.append(value.as_py())
        size += len(texts[-1] or "")
        if size >= chars:
            yield batch.column(0).slice(first, i + 1 - first), texts
            texts, first, size = [], i + 1, 0
    if texts:
        yield batch.column(0).slice(first), texts


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``doc_id, held_out, score, predicted, windows, top_window``."""
    scored = score_documents(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "windows",
        "top_window",
    )
