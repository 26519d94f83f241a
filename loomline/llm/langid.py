"""Language ID (operator 9): a byte convolutional network trained in numpy.

Bytes fold to 64 classes (case folds, also that of two-byte Latin letters). A window of 256 bytes is embedded, passed
through filters of widths 2, 3 and 4, max-pooled and classified by softmax; a text's label comes from the mean of the
logits of all its windows. Training takes a bounded sample of labelled rows: LABELLED rows at most, shared out evenly
among the labels, DOCS_PER_LANG of each at most and WINDOWS_PER_DOC windows of a row. There is no bound on labels but
the sample's. Prediction covers every window of every whole text:
the first layers are folded into tables of class pairs, so a position costs a few row lookups.

Defined cases: null texts and texts without a letter (str.isalpha) are `und` with score 0; so is every text if there is
nothing to learn from; a text of any length is judged by all its windows; of equally likely labels the first by name is
taken; rows without an id are predicted, not learned from and not held out; rows that repeat an id are rows of their own;
an empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.text import chunks

WINDOW, CLASSES, DIMS, FILTERS, WIDTHS = 256, 64, 8, 16, (2, 3, 4)
DOCS_PER_LANG, LABELLED, WINDOWS_PER_DOC, EPOCHS, BATCH, RATE, SEED = 400, 100_000, 4, 6, 64, 0.01, 7
UNKNOWN = "und"
POSITIONS = WINDOW - max(WIDTHS) + 1


def byte_classes() -> np.ndarray:
    """0 pads; letters without case; white space, digits, other ASCII; lead bytes; tail bytes by their low 5 bits."""
    out = np.full(256, 29, np.uint8)
    for i in range(26):
        out[ord("a") + i] = out[ord("A") + i] = 1 + i
    out[[9, 10, 11, 12, 13, 32]] = 27
    out[ord("0") : ord("9") + 1] = 28
    out[0x80:0xC0] = 32 + (np.arange(0x80, 0xC0) & 31)
    out[0xC0:] = 31
    out[0xC3] = 30
    return out


_CLASS = byte_classes()


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def windows(text: str) -> np.ndarray:
    """All windows of a text, as classes; the last is padded."""
    raw = _CLASS[np.frombuffer(text.encode(), np.uint8)]
    out = np.zeros((max(1, -(-len(raw) // WINDOW)), WINDOW), np.uint8)
    out.reshape(-1)[: len(raw)] = raw
    return out


class Network:
    def __init__(self, labels: list[str], rng: np.random.Generator):
        self.labels = labels
        n = FILTERS * len(WIDTHS)
        self.p = {"embed": rng.normal(0, 0.3, (CLASSES, DIMS)).astype(np.float32), "bias": np.zeros(n, np.float32), "out": rng.normal(0, 0.1, (n, len(labels))).astype(np.float32), "end": np.zeros(len(labels), np.float32)}
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * DIMS), (w * DIMS, FILTERS)).astype(np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, epochs: int = EPOCHS) -> None:
        """Adam on the cross-entropy; the gradient goes through the pooled positions only."""
        m, v, t = {k: np.zeros_like(a) for k, a in self.p.items()}, {k: np.zeros_like(a) for k, a in self.p.items()}, 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for s in range(0, len(x), BATCH):
                grad = self._gradient(x[order[s : s + BATCH]], y[order[s : s + BATCH]])
                t += 1
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        e = p["embed"][x]
        pooled, where, rows = [], [], np.arange(n)
        for w in WIDTHS:
            cols = np.concatenate([e[:, i : i + POSITIONS] for i in range(w)], axis=2)
            r = cols @ p[f"w{w}"]
            at = r.argmax(axis=1)
            where.append(at)
            pooled.append(np.take_along_axis(r, at[:, None], 1)[:, 0])
        z = np.concatenate(pooled, axis=1) + p["bias"]
        a = np.maximum(z, 0)
        logit = a @ p["out"] + p["end"]
        q = np.exp(logit - logit.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        q[rows, y] -= 1
        q /= n
        grad = {"out": a.T @ q, "end": q.sum(axis=0), "embed": np.zeros_like(p["embed"])}
        dz = (q @ p["out"].T) * (z > 0)
        grad["bias"] = dz.sum(axis=0)
        for i, w in enumerate(WIDTHS):
            d, at = dz[:, i * FILTERS : (i + 1) * FILTERS], where[i]
            took = x[rows[:, None, None], at[:, :, None] + np.arange(w)]  # text, filter, place
            cols = p["embed"][took].reshape(n, FILTERS, w * DIMS)
            grad[f"w{w}"] = np.einsum("nf,nfc->cf", d, cols)
            back = (d[:, :, None] * p[f"w{w}"].T[None]).reshape(n, FILTERS, w, DIMS)
            np.add.at(grad["embed"], took, back)
        return grad

    def tables(self) -> Tables:
        return Tables(self)


class Tables:
    """The trained network with its first layers folded into lookups by class pair."""

    def __init__(self, net: Network):
        e, f = net.p["embed"], FILTERS
        w = {k: net.p[f"w{k}"].reshape(k, DIMS, f) for k in WIDTHS}

        def pair(first, second):
            return (e @ first)[:, None] + (e @ second)[None]

        self.head = np.concatenate([pair(w[k][0], w[k][1]) for k in WIDTHS], axis=2).reshape(CLASSES**2, 3 * f).astype(np.float32)
        self.third = (e @ w[3][2]).astype(np.float32)
        self.tail = pair(w[4][2], w[4][3]).reshape(CLASSES**2, f).astype(np.float32)
        self.labels, self.bias, self.out, self.end = net.labels, net.p["bias"], net.p["out"], net.p["end"]

    def logits(self, x: np.ndarray, at_once: int = 64) -> np.ndarray:
        out, f = np.empty((len(x), 3 * FILTERS), np.float32), FILTERS
        for s in range(0, len(x), at_once):
            part = x[s : s + at_once].astype(np.intp)
            pairs = part[:, :-1] * CLASSES + part[:, 1:]
            r = self.head[pairs[:, :POSITIONS]]
            r[:, :, f : 2 * f] += self.third[part[:, 2 : 2 + POSITIONS]]
            r[:, :, 2 * f :] += self.tail[pairs[:, 2 : 2 + POSITIONS]]
            out[s : s + at_once] = r.max(axis=1)
        return np.maximum(out + self.bias, 0) @ self.out + self.end

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.labels:
            return labels, scores
        which = [i for i, t in enumerate(texts) if has_letter(t)]
        if which:
            each = [windows(texts[i]) for i in which]
            n = np.asarray([len(w) for w in each])
            sums = np.add.reduceat(self.logits(np.concatenate(each)).astype(np.float64), np.cumsum(n) - n, axis=0)
            mean = sums / n[:, None]
            q = np.exp(mean - mean.max(axis=1, keepdims=True))
            q /= q.sum(axis=1, keepdims=True)
            for i, k, s in zip(which, q.argmax(axis=1).tolist(), q.max(axis=1).tolist(), strict=True):
                labels[i], scores[i] = self.labels[k], min(1.0, s)
        return labels, scores


def _sample_windows(per_doc: int):
    def run(batches):
        for b in batches:
            langs, out = [], []
            for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True):
                if has_letter(text):
                    w = windows(text)
                    for i in sorted({int(i) for i in np.linspace(0, len(w) - 1, per_doc)}):
                        langs.append(lang)
                        out.append(w[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["lang", "window"])

    return run


def train(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG) -> Tables:
    """A network learned from rows that meet learn_from. Labels are read for all; texts are shuffled of the sample only."""
    lang = F.col(lang_col).cast("string")
    rows = docs.where(learn_from).where(F.col(id_col).isNotNull() & lang.isNotNull()).select(F.col(id_col).alias("id"), lang.alias("lang"), F.col(text_col).alias("text"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LABELLED)
    share = max(1, min(docs_per_lang, LABELLED // max(1, counts.count())))
    rng = np.random.default_rng(SEED)
    # a few times the share of each label by a hash of the id, then its first rows: no label's rows all meet in one task
    part = (F.col("n") <= 4 * share) | (F.pmod(F.xxhash64("id", "lang"), F.lit(1 << 30)) / float(1 << 30) * F.col("n") < 4 * share)
    some = rows.join(F.broadcast(counts), "lang").where(part)  # LABELLED rows at most are broadcast
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", F.xxhash64("text"))
    picked = some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= share)
    got = picked.select("lang", "text").mapInArrow(_sample_windows(WINDOWS_PER_DOC), "lang string, window binary").toArrow()
    rows = sorted(zip(got["lang"].to_pylist(), got["window"].to_pylist(), strict=True))
    labels = sorted({r[0] for r in rows})
    net = Network(labels, rng)
    if rows:
        code = {k: i for i, k in enumerate(labels)}
        x = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
        net.fit(x, np.asarray([code[k] for k, _ in rows]), rng)
    return net.tables()


def _predict(model, text_col: str, keep: list[str]):
    def run(batches):
        for b in chunks(batches, text_col):
            labels, scores = model.value.predict(b.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(labels, pa.string()), pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Tables, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns keep, then lang_pred and score (which replace columns of these names)."""
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*dict.fromkeys([*keep, text_col]))
    schema = T.StructType([docs.schema[c] for c in keep]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(_predict(shared, text_col, keep), schema)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text has the remainder; rows without an id are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
