"""Language identification by a bidirectional gated recurrent network over bytes.

The network is numpy throughout; gates and states use x / (1 + |x|) for tanh, which numpy
computes several times faster. A text's UTF-8 bytes are cut into segments of LENGTH;
one network reads each forwards, one backwards, and from both states every position gets
a probability for every language. A document's probabilities are the mean over all its
positions that hold a letter. Training is backpropagation through time with Adam, on a
bounded sample: up to DOCUMENTS documents of each language, the first in a given order, and
SEGMENTS segments of each, spread over the whole text; so that no language is lost, however
rare, and languages weigh alike. Prediction reads all bytes of all texts.

A null text, and one without a letter, is `und` with score 0. Texts without training
rows (an empty table, no labels) are all `und`. Repeated rows are predicted row by row;
columns other than id and text are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worksledger.llm.common import forget, give_back, joined_bytes, map_texts, pieces

LENGTH = 64
HIDDEN = 8
DOCUMENTS = 400
#: Groups in which the tasks' rows of a language are merged first.
GROUPS = 16
SEGMENTS = 8
ROUNDS = 300
BATCH = 256
ROWS = 1024
UNKNOWN = "und"

#: Bytes that are part of a letter: ASCII letters and all bytes of other characters.
LETTER = np.array([chr(b).isascii() and chr(b).isalpha() or b >= 128 for b in range(256)])


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place: stands for tanh, at a tenth of its cost in numpy."""
    x /= np.abs(x) + 1
    return x


def _slope(s: np.ndarray) -> np.ndarray:
    """The derivative of _squash, by its value."""
    s = 1 - np.abs(s)
    return s * s


@dataclass
class Network:
    """Weights by name: for each direction the inputs of a byte, the recurrent matrix and
    its bias (for update, reset and candidate, in this order), and the output layer."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 1) -> Network:
        r = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w[f"in_{d}"] = r.normal(0, 0.3, (3 * hidden, 256))
            w[f"rec_{d}"] = r.normal(0, hidden**-0.5, (3 * hidden, hidden))
            w[f"bias_{d}"] = np.zeros((3 * hidden, 1))
            w[f"out_{d}"] = r.normal(0, hidden**-0.5, (len(languages), hidden))
        w["out_bias"] = np.zeros((len(languages), 1))
        return cls(languages, {k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, d: str, data: np.ndarray, keep: bool) -> tuple[list[np.ndarray], list]:
        """States after each byte, in the order of the text; data is (time, rows)."""
        w, h3 = self.weights, self.weights[f"rec_{d}"].shape[0]
        n = h3 // 3
        inputs, rec, bias = w[f"in_{d}"], w[f"rec_{d}"], w[f"bias_{d}"]
        h = np.zeros((n, data.shape[1]), np.float32)
        states, tape = [h] * len(data), []
        for t in range(len(data)) if d == "f" else range(len(data) - 1, -1, -1):
            x = np.take(inputs, data[t], axis=1)
            u = rec @ h
            u += bias
            x[: 2 * n] += u[: 2 * n]
            gates = _squash(x[: 2 * n])
            gates *= 0.5
            gates += 0.5
            z, r = gates[:n], gates[n:]
            c = r * u[2 * n :]
            c += x[2 * n :]
            _squash(c)
            before, h = h, z * (h - c) + c
            states[t] = h
            if keep:
                tape.append((t, before, z, r, u[2 * n :], c))
        return states, tape

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Probabilities of each position: (time, languages, rows)."""
        w = self.weights
        forward, backward = self._run("f", data, False)[0], self._run("b", data, False)[0]
        out = np.empty((len(data), len(self.languages), data.shape[1]), np.float32)
        for t in range(len(data)):
            out[t] = self._softmax(w["out_f"] @ forward[t] + w["out_b"] @ backward[t] + w["out_bias"])
        return out

    @staticmethod
    def _softmax(x: np.ndarray) -> np.ndarray:
        x -= x.max(axis=0)
        np.exp(x, out=x)
        x /= x.sum(axis=0)
        return x

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the letter positions, and its gradient, by backpropagation through time."""
        w = self.weights
        mask = LETTER[data].astype(np.float32)
        share = 1.0 / max(1.0, float(mask.sum()))
        runs = {d: self._run(d, data, True) for d in "fb"}
        g = {k: np.zeros_like(v) for k, v in w.items()}
        loss, deltas, rows = 0.0, [None] * len(data), np.arange(data.shape[1])
        for t in range(len(data)):
            hf, hb = runs["f"][0][t], runs["b"][0][t]
            p = self._softmax(w["out_f"] @ hf + w["out_b"] @ hb + w["out_bias"])
            loss -= float((np.log(np.maximum(p[labels, rows], 1e-12)) * mask[t]).sum()) * share
            p[labels, rows] -= 1
            p *= mask[t] * share
            g["out_f"] += p @ hf.T
            g["out_b"] += p @ hb.T
            g["out_bias"] += p.sum(axis=1, keepdims=True)
            deltas[t] = p
        for d in "fb":
            rec, n = w[f"rec_{d}"], w[f"rec_{d}"].shape[1]
            dh = np.zeros((n, data.shape[1]), np.float32)
            by_time = np.empty((len(data), 3 * n, data.shape[1]), np.float32)
            for t, before, z, r, u, c in reversed(runs[d][1]):
                dh += w[f"out_{d}"].T @ deltas[t]
                dc = dh * (1 - z) * _slope(c)
                dz = dh * (before - c) * 0.5 * _slope(2 * z - 1)
                dr = dc * u * 0.5 * _slope(2 * r - 1)
                into = np.concatenate([dz, dr, dc])
                through = np.concatenate([dz, dr, dc * r])
                by_time[t] = into
                g[f"rec_{d}"] += through @ before.T
                g[f"bias_{d}"] += through.sum(axis=1, keepdims=True)
                dh = dh * z + rec.T @ through
            flat = data.ravel()
            for k in range(3 * n):
                g[f"in_{d}"][k] = np.bincount(flat, weights=by_time[:, k].ravel(), minlength=256)
        return loss, g


def train(segments: np.ndarray, labels: np.ndarray, languages: list[str], rounds: int = ROUNDS, seed: int = 1) -> Network:
    """segments: (rows, time) bytes; labels: numbers of languages. Every language counts alike."""
    net, r = Network.fresh(languages, seed=seed), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in net.weights.items()} for _ in "12")
    weight = 1.0 / np.bincount(labels, minlength=len(languages))[labels]
    weight /= weight.sum()
    for step in range(1, rounds + 1):
        some = r.choice(len(segments), BATCH, p=weight)
        _, g = net.gradients(np.ascontiguousarray(segments[some].T), labels[some])
        norm = float(np.sqrt(sum((x.astype(np.float64) ** 2).sum() for x in g.values())))
        rate = 0.02 * (1 - step / (rounds + 1)) / 1.0
        for k, v in net.weights.items():
            x = g[k] * min(1.0, 1.0 / max(norm, 1e-9))
            first[k] += 0.1 * (x - first[k])
            second[k] += 0.01 * (x * x - second[k])
            v -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def fit(labelled: DataFrame, text_col: str, lang_col: str, order: Column) -> Network | None:
    """Train on DOCUMENTS rows of each language in labelled; None if there is nothing to learn from."""
    text = F.col(text_col)
    last = F.greatest(F.length(text) - LENGTH, F.lit(0))
    spread = F.array(*(F.substring(text, F.lit(1) + F.floor(last * (k / (SEGMENTS - 1))).cast("int"), F.lit(LENGTH)) for k in range(SEGMENTS)))
    usable = labelled.where(F.col(lang_col).isNotNull() & (F.length(text) > 0))
    drawn = usable.select(F.col(lang_col).alias("lang"), spread.alias("segments"), order.alias("order"))
    drawn = drawn.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    for by in (["lang", "group"], ["lang"]):  # limits on the map side: a task hands on no more of a language
        first = F.row_number().over(Window.partitionBy(*by).orderBy("order", "segments"))
        drawn = drawn.withColumn("rank", first).where(F.col("rank") <= DOCUMENTS)
    rows = [(r.lang, x) for r in sorted(drawn.select("lang", "rank", "segments").collect(), key=lambda r: (r.lang, r.rank)) for x in r.segments]
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    raw = [x.encode()[:LENGTH].ljust(LENGTH, b"\0") for _, x in rows]
    segments = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, LENGTH)
    return train(segments, np.array([languages.index(lang) for lang, _ in rows]), languages)


def predict(net: Network, texts: pa.Array) -> np.ndarray:
    """Mean probabilities over the letter positions: (texts, languages); 0 where there are none."""
    data, offsets = joined_bytes(texts)
    lengths = np.diff(offsets)
    count = -(-lengths // LENGTH)
    doc = np.repeat(np.arange(len(lengths)), count)
    start = offsets[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * LENGTH
    sums, letters = np.zeros((len(lengths), len(net.languages))), np.zeros(len(lengths))
    data = np.concatenate([data, np.zeros(LENGTH, np.uint8)])
    for k in range(0, len(doc), ROWS):
        at, of = start[k : k + ROWS], doc[k : k + ROWS]
        place = at + np.arange(LENGTH)[:, None]
        inside = place < offsets[1:][of]
        block = np.where(inside, data[place], 0).astype(np.uint8)
        mask = LETTER[block]
        p = np.einsum("tlr,tr->lr", net.positions(block), mask.astype(np.float32))
        for j in range(len(net.languages)):
            sums[:, j] += np.bincount(of, weights=p[j], minlength=len(lengths))
        letters += np.bincount(of, weights=mask.sum(axis=0), minlength=len(lengths))
    return sums / np.maximum(letters, 1)[:, None]


def _told(net: Network | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and probability of each text."""
    some = [t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()]
    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if net is not None and any(some):
        p = predict(net, texts)
        best = p.argmax(axis=1)
        lang = [net.languages[b] if s else UNKNOWN for b, s in zip(best, some)]
        score = np.where(some, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
    return lang, score


def identify(df: DataFrame, net: Network | None, text_col: str = "text", lang_to: str = "lang_pred", score_to: str = "score") -> DataFrame:
    """df with the predicted language and its probability."""
    at = df.columns.index(text_col)
    names = [*df.columns, lang_to, score_to]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = _told(net, batch.column(at))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return map_texts(df, f"{schema}, `{lang_to}` string, `{score_to}` double", work, at)


def recognised(text: Column, net: Network | None, least_score: float = 0.0) -> Column:
    """The predicted language as a column; null where there is none, or with a lower probability.

    Only the text leaves the JVM, and only the answer comes back.
    """

    @F.arrow_udf("string")
    def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        for texts in batches:
            out: list[str | None] = []
            for piece in pieces(pa.RecordBatch.from_arrays([texts], names=["text"]), 0):
                out += [x if x != UNKNOWN and s >= least_score else None for x, s in zip(*_told(net, piece.column(0)))]
            yield pa.array(out, pa.string())
        give_back()

    return told(text)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
