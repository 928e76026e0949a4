"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network reads windows of bytes from both sides, gives every position a probability for
each language, and a document pools those of its letters. It is trained in numpy by
backpropagation through time on a bounded sample of windows. All windows of a text are read,
many of them at once, so work is in proportion to the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from orderpulse.llm.common import may_train, share, slices, texts

HIDDEN = 8
#: Bytes of a window when labelling and when training.
WINDOW, TRAIN_WINDOW = 64, 32
#: Training texts of each language, about; characters that are taken from each.
SAMPLE, SAMPLE_CHARS = 500, 400
STEPS, BATCH, RATE, SEED = 150, 256, 0.02, 11
#: Windows that are read at once.
ROWS = 4096
LETTER = regex.compile(r"\p{L}")
#: Bytes that are part of a letter: ASCII letters and all of the multi-byte characters.
LETTER_BYTE = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])


def windows_of(texts_: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows, index of their text): all bytes of lower-cased texts, the last window of each
    filled up with zero bytes."""
    rows, owner = [], []
    for k, text in enumerate(texts_):
        raw = text.lower().encode("utf-8", "replace")
        count = -(-len(raw) // width)
        rows.append(raw.ljust(count * width, b"\0"))
        owner.append(np.full(count, k))
    flat = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, width)
    return flat, np.concatenate(owner) if owner else np.empty(0, np.int64)


class Network:
    """Two gated recurrent units, one for each direction, under one softmax layer.

    ``bytes_`` [d] holds what each byte adds to update gate, reset gate and candidate,
    ``past`` [d] what the last state adds. Gates are tanh of half their input, shifted.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN):
        rng = np.random.default_rng(SEED)
        self.languages, self.hidden = languages, hidden
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.bytes_ = draw(2, 256, 3 * hidden)
        self.past = draw(2, hidden, 3 * hidden)
        self.out = draw(2 * hidden, len(languages))
        self.bias = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.bytes_, self.past, self.out, self.bias]

    def states(self, columns: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """States after each byte, (time, window, hidden); ``way`` 1 reads from the end."""
        h, given = self.hidden, self.bytes_[way]
        gates, candidate = self.past[way][:, :2 * h], self.past[way][:, 2 * h:]
        state = np.zeros((columns.shape[1], h), np.float32)
        found = np.empty((*columns.shape, h), np.float32)
        for t in range(len(columns))[::-1] if way else range(len(columns)):
            add = given[columns[t]]
            gate = state @ gates
            gate += add[:, :2 * h]
            gate *= 0.5
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
            update, reset = gate[:, :h], gate[:, h:]
            fresh = (reset * state) @ candidate
            fresh += add[:, 2 * h:]
            np.tanh(fresh, out=fresh)
            if keep is not None:
                keep.append((t, state, update, reset, fresh))
            state = state + update * (fresh - state)
            found[t] = state
        return found

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(time, window, language) for windows of bytes."""
        columns = np.ascontiguousarray(windows.T)
        h = self.hidden
        score = self.states(columns, 0) @ self.out[:h]
        score += self.states(columns, 1) @ self.out[h:]
        score += self.bias
        score -= score.max(-1, keepdims=True)
        np.exp(score, out=score)
        score /= score.sum(-1, keepdims=True)
        return score

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy over all positions, back through time."""
        columns, h = np.ascontiguousarray(windows.T), self.hidden
        steps = [[], []]
        both = np.concatenate([self.states(columns, way, steps[way]) for way in (0, 1)], axis=2)
        score = both @ self.out + self.bias
        score = np.exp(score - score.max(-1, keepdims=True))
        error = score / score.sum(-1, keepdims=True)
        error[:, np.arange(windows.shape[0]), labels] -= 1
        error /= error.shape[0] * error.shape[1]
        of_out = np.einsum("tbh,tbl->hl", both, error)
        of_state = error @ self.out.T
        of_bytes, of_past = np.zeros_like(self.bytes_), np.zeros_like(self.past)
        for way in (0, 1):
            past, back = self.past[way], np.zeros((windows.shape[0], h), np.float32)
            for t, state, update, reset, fresh in reversed(steps[way]):
                back = back + of_state[t][:, way * h:(way + 1) * h]
                of_fresh = back * update * (1 - fresh ** 2)
                of_update = back * (fresh - state) * update * (1 - update)
                held = of_fresh @ past[:, 2 * h:].T
                of_reset = held * state * reset * (1 - reset)
                add = np.concatenate([of_update, of_reset, of_fresh], axis=1)
                np.add.at(of_bytes[way], columns[t], add)
                of_past[way][:, :2 * h] += state.T @ add[:, :2 * h]
                of_past[way][:, 2 * h:] += (reset * state).T @ of_fresh
                back = back * (1 - update) + held * reset + add[:, :2 * h] @ past[:, :2 * h].T
        return [of_bytes, of_past, of_out, error.sum((0, 1))]

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> None:
        """Adam over random batches that hold each language alike."""
        rng = np.random.default_rng(SEED)
        by_label = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        each = max(1, BATCH // len(by_label))
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        for step in range(1, steps + 1):
            rows = np.concatenate([rng.choice(own, each) for own in by_label])
            rate = RATE * min(1.0, 2 * (steps - step + 1) / steps)
            for p, g, m, v in zip(self.parameters(),
                                  self.gradients(windows[rows], labels[rows]), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)

    def pooled(self, texts_: list[str]) -> np.ndarray:
        """Mean probability of each language over the letters of each text, in whole."""
        total = np.zeros((len(texts_), len(self.languages)))
        count = np.zeros(len(texts_))
        windows, owner = windows_of(texts_, WINDOW)
        for at in range(0, len(windows), ROWS):
            part, whose = windows[at:at + ROWS], owner[at:at + ROWS]
            letters = LETTER_BYTE[part.T] & (part.T > 0)
            found = np.einsum("twl,tw->wl", self.probabilities(part), letters.astype(np.float32))
            np.add.at(total, whose, found)
            np.add.at(count, whose, letters.sum(0))
        return total / np.maximum(count, 1)[:, None]


def fit(docs: DataFrame) -> Network | None:
    """Train on texts with a language, without held-out ids; None if there is none.

    About SAMPLE texts of each language are taken by a hash of the id, and a part of
    SAMPLE_CHARS characters of each; the driver holds no more than that.
    """
    known = docs.select("doc_id", "text", "lang").filter(
        may_train(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    there = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not there:
        return None
    rate = F.create_map(*(F.lit(x) for lang, n in there.items()
                          for x in (lang, min(1.0, SAMPLE / n))))
    start = F.pmod(F.xxhash64(F.lit("part"), "doc_id"),
                   F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    rows = (known.filter(share(F.col("doc_id"), rate[F.col("lang")]))
            .select("doc_id", "lang", F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("part"))
            .collect())
    rows = sorted((r for r in rows if LETTER.search(r.part)), key=lambda r: (r.doc_id, r.part))
    languages = sorted({r.lang for r in rows})
    if not languages:
        return None
    windows, owner = windows_of([r.part for r in rows], TRAIN_WINDOW)
    whole = (windows > 0).mean(1) > 0.5
    labels = np.array([languages.index(r.lang) for r in rows])[owner]
    languages_there = np.unique(labels[whole])
    if len(languages_there) < len(languages):
        whole[:] = True
    network = Network(languages)
    if len(languages) > 1:
        network.train(windows[whole], labels[whole])
    return network


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its whole text alone.

    Null texts, texts without a letter and all texts if nothing was learnt are ``und`` with
    score 0. Repeated rows give repeated results; other columns are not looked at.
    """
    rows = docs.select("doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches):
            own = texts(batch.column(1))
            some = [k for k, t in enumerate(own) if model and LETTER.search(t)]
            names, scores = ["und"] * len(own), [0.0] * len(own)
            if some:
                shares = model.pooled([own[k] for k in some])
                for k, best, value in zip(some, shares.argmax(1).tolist(), shares.max(1).tolist()):
                    names[k], scores[k] = model.languages[best], min(1.0, value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
