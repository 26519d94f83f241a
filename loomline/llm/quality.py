"""Quality classifier (operator 10): co-training of a text view and a metadata view.

The text view sees the whole text: shares of words by hash, byte classes, repetition; the metadata view sees what is
known about the page without reading it (language, source, declared length). Each view is a logistic regression. Over
ROUNDS rounds each view scores all unlabelled rows, and the GROWTH rows of which it is most sure become pseudo-labelled
rows of the other view; a row is given to a view once. Both views are calibrated on labelled rows that neither learned
from, and combined there by a further regression, which scores every row.

Features are worked out once for each row, over its whole text, and written (about 300 bytes a row); the rounds and the
scores read only them. Fitting takes LABELLED labelled rows at most, by hash order, and the rows of the rounds; there is
no other sample. A task hands on the rows that it is most sure of, no more than a round takes in all; they are ranked
by hash of the row first and then together.

Defined cases: a null text is empty, a text of any length is read whole; null metadata are values of their own; labels
other than 0 and 1 and rows without an id are not learned from; of several labels of an id the larger counts; with
labels of one kind only every score is that label; with none, 0.5; of rows that a view is equally sure of the one with the
least hash is taken; rows alike in all columns are pseudo-labelled once, and all repeated rows are scored each; an empty
table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm import text as tx
from loomline.session import cut

LABELLED, ROUNDS, SURE, GROWTH = 6000, 5, 0.95, 400
#: Parts in which the surest rows are ranked before they are ranked together.
PARTS = 64
#: Buckets of words, and figures beside them, of the text view.
WORDS, FIGURES = 128, 24
N_SOURCE, N_LANG, N_SIZE = 64, 16, 24
#: Byte classes: lower, upper, digit, space, newline, sentence marks, other ASCII marks, beyond ASCII.
_KINDS = 8


def _kind_table() -> np.ndarray:
    out = np.full(256, 6, np.uint8)
    out[ord("a") : ord("z") + 1] = 0
    out[ord("A") : ord("Z") + 1] = 1
    out[ord("0") : ord("9") + 1] = 2
    out[[9, 11, 12, 13, 32]] = 3
    out[10] = 4
    out[[ord(c) for c in ".,;:'\"-"]] = 5
    out[128:] = 7
    return out


_KIND = _kind_table()


def text_features(texts: list[str | None]) -> np.ndarray:
    """One row a text: shares of byte classes, word length, distinct words, the most frequent word, repeated pairs, lines;
    then root shares of its words by hash, in steps of 1/255."""
    raw = [t.encode() if t else b"" for t in texts]
    size = np.asarray([len(r) for r in raw], np.int64)
    n, of = len(raw), np.repeat(np.arange(len(raw)), size)
    kinds = np.bincount(of * _KINDS + _KIND[np.frombuffer(b"".join(raw), np.uint8)], minlength=n * _KINDS).reshape(n, _KINDS).astype(float)
    share = kinds / np.maximum(size, 1)[:, None]
    codes, ends, distinct = tx.encode(texts)
    words = np.diff(ends)
    text = np.repeat(np.arange(n), words)

    def repetition(code: np.ndarray, owner: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        key, count = np.unique(owner * base + code, return_counts=True)
        whose, kinds_, top = key // base, np.zeros(n), np.zeros(n)
        np.add.at(kinds_, whose, 1)
        np.maximum.at(top, whose, count)
        total = np.maximum(np.bincount(owner, minlength=n), 1)
        return kinds_ / total, top / total

    vocabulary = max(1, len(distinct))
    unique, top = repetition(codes.astype(np.int64), text, vocabulary)
    same = np.flatnonzero(text[1:] == text[:-1]) if len(text) else np.empty(0, np.int64)
    stay = np.bincount(text[same][codes[same] == codes[same + 1]], minlength=n) / np.maximum(words, 1)
    letters = np.fromiter(map(len, distinct), np.float64, len(distinct))[codes] if len(codes) else np.empty(0)
    mean = np.bincount(text, letters, n) / np.maximum(words, 1)
    lines = kinds[:, 4] + 1
    more = np.stack([unique, top, stay, mean / 10, np.log1p(words) / 10, np.log1p(words / lines) / 5, share[:, 1] / np.maximum(share[:, 0] + share[:, 1], 1e-9), unique * np.log1p(words) / 10], axis=1)
    bucket = (tx.hashes(distinct) % np.uint64(WORDS)).astype(np.int64)[codes] if len(codes) else codes
    bags = np.bincount(text * WORDS + bucket, minlength=n * WORDS).reshape(n, WORDS) / np.maximum(words, 1)[:, None]
    figures = np.concatenate([share, np.sqrt(share), more], axis=1).astype(np.float32)
    return np.concatenate([figures, np.rint(255 * np.sqrt(bags))], axis=1)


def meta_places(lang: list, source: list, size: list) -> np.ndarray:
    """Language and source by hash, declared length by powers of two, as places of a one-hot row; the last place of each
    is for nulls."""
    out = np.zeros((len(lang), 3), np.uint8)
    for i, (a, b, c) in enumerate(zip(lang, source, size, strict=True)):
        out[i, 0] = N_LANG - 1 if a is None else zlib.crc32(a.encode()) % (N_LANG - 1)
        out[i, 1] = N_LANG + (N_SOURCE - 1 if b is None else zlib.crc32(b.encode()) % (N_SOURCE - 1))
        out[i, 2] = N_LANG + N_SOURCE + (N_SIZE - 1 if c is None or c < 0 else min(N_SIZE - 2, int(c).bit_length()))
    return out


def meta_features(places: np.ndarray) -> np.ndarray:
    out = np.zeros((len(places), N_LANG + N_SOURCE + N_SIZE))
    np.put_along_axis(out, places.astype(np.int64), 1, axis=1)
    return out


def pack(text: np.ndarray, places: np.ndarray) -> list[bytes]:
    """Features of rows as bytes: figures, shares of words, places."""
    whole = np.concatenate([np.ascontiguousarray(text[:, :FIGURES], "<f4").view(np.uint8), text[:, FIGURES:].astype(np.uint8), places], axis=1)
    return [r.tobytes() for r in whole]


def unpack(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Both views of packed rows."""
    whole = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 4 * FIGURES + WORDS + 3)
    figures = np.ascontiguousarray(whole[:, : 4 * FIGURES]).view("<f4").astype(np.float64)
    return np.concatenate([figures, whole[:, 4 * FIGURES : -3] / 255.0], axis=1), meta_features(whole[:, -3:])


class Logistic:
    """Standardised logistic regression by Newton's method with an L2 penalty."""

    def __init__(self, x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 12):
        self.mean, spread = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0.0)
        z = self._design(x)
        self.w = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], penalty)
        ridge[-1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            hess = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge)
            self.w += np.linalg.solve(hess, z.T @ (y - p) - ridge * self.w)

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.c_[np.clip((x - self.mean) * self.scale, -8, 8), np.ones(len(x))]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._design(x) @ self.w, -30, 30)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


def surest(p: np.ndarray, keys: np.ndarray, share: float, taken: set[int]) -> list[tuple[float, np.ndarray]]:
    """For each label the places of the rows that a view is sure of, the surest first, then by key, one of each key."""
    out = []
    for label, quota in ((1.0, share), (0.0, 1 - share)):
        rows = np.flatnonzero(p >= SURE if label else p <= 1 - SURE)
        rows = rows[np.lexsort((keys[rows], -np.abs(p[rows] - 0.5)))]
        _, first = np.unique(keys[rows], return_index=True)
        rows = rows[np.sort(first)]
        rows = rows[~np.isin(keys[rows], list(taken))] if taken else rows
        out.append((label, rows[: max(1, int(GROWTH * quota))]))
    return out


class CoTrained:
    """Two views that taught each other, and their calibrated combination.

    pick(models, taken, share) gives (teacher, label, key, packed features) of the rows that each model is surest of among
    the unlabelled ones, without those whose keys the other view has taken.
    """

    def __init__(self, views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pick):
        self.constant = 0.5 if not len(y) else float(y[0]) if len(set(y.tolist())) == 1 else None
        if self.constant is not None:
            return
        held = np.arange(len(y)) % 4 == 3  # for calibration; rows come in hash order
        if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
            held = np.zeros(len(y), bool)
        x, labels = [v[~held] for v in views], [y[~held], y[~held]]
        taken: tuple[set, set] = (set(), set())
        share = float(y[~held].mean())
        for _ in range(ROUNDS):
            taught = pick([Logistic(a, b) for a, b in zip(x, labels, strict=True)], taken, share)
            if not taught:
                break
            for learner in (0, 1):
                mine = sorted((r for r in taught if r[0] != learner), key=lambda r: (-r[1], r[2]))
                if mine:
                    x[learner] = np.concatenate([x[learner], unpack([r[3] for r in mine])[learner]])
                    labels[learner] = np.r_[labels[learner], [r[1] for r in mine]]
                    taken[learner].update(r[2] for r in mine)
        self.models = [Logistic(a, b) for a, b in zip(x, labels, strict=True)]
        apart = held if held.any() else np.ones(len(y), bool)
        logits = [m.logit(v[apart]) for m, v in zip(self.models, views, strict=True)]
        self.calibrated = [Logistic(a[:, None], y[apart]) for a in logits]
        self.combined = Logistic(np.stack(logits, axis=1), y[apart])

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of good quality by text, by metadata and together."""
        if self.constant is not None:
            return (np.full(len(text), self.constant),) * 3
        logits = [m.logit(v) for m, v in zip(self.models, (text, meta), strict=True)]
        return self.calibrated[0](logits[0][:, None]), self.calibrated[1](logits[1][:, None]), self.combined(np.stack(logits, axis=1))


def _features(batches):
    for b in tx.chunks(batches, "text"):
        if b.num_rows:
            rows = pack(text_features(b["text"].to_pylist()), meta_places(b["lang"].to_pylist(), b["source"].to_pylist(), b["size"].to_pylist()))
            yield pa.RecordBatch.from_arrays([b["id"], b["key"], pa.array(rows, pa.binary())], ["id", "key", "x"])


def _surest(shared):
    def run(batches):
        models, taken, share = shared.value
        best: dict = {}
        for b in batches:
            if not b.num_rows:
                continue
            rows, keys = b["x"].to_pylist(), np.asarray(b["key"])
            for teacher, (model, view) in enumerate(zip(models, unpack(rows), strict=True)):
                p = model(view)
                for label, places in surest(p, keys, share, taken[1 - teacher]):
                    best[teacher, label] = _merged(best.get((teacher, label), []), [(-abs(float(p[i]) - 0.5), int(keys[i]), rows[i]) for i in places.tolist()], share if label else 1 - share)
        out = [(t, v, -a, k, x) for (t, v), found in best.items() for a, k, x in found]
        if out:
            kinds = [pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["teacher", "label", "sure", "key", "x"])

    return run


def _merged(a: list, b: list, quota: float) -> list:
    """The first rows of both by sureness and key, one of each key."""
    return list({r[1]: r for r in reversed(sorted([*a, *b]))}.values())[::-1][: max(1, int(GROWTH * quota))]


def _picker(pool: DataFrame):
    """Picks from a table of unlabelled rows (key, x): one pass a round."""

    def pick(models, taken, share):
        shared = pool.sparkSession.sparkContext.broadcast((models, taken, share))
        found = pool.mapInArrow(_surest(shared), "teacher int, label double, sure double, key long, x binary").dropDuplicates(["teacher", "label", "key"])
        quota = F.greatest(F.lit(1), F.floor(GROWTH * F.when(F.col("label") == 1, F.lit(share)).otherwise(1 - F.lit(share))))
        for part in ([F.pmod("key", F.lit(PARTS))], []):
            order = Window.partitionBy("teacher", "label", *part).orderBy(F.desc("sure"), "key")
            found = found.withColumn("place", F.row_number().over(order)).where((F.col("place") <= GROWTH) & (F.col("place") <= quota))
        return [(r.teacher, r.label, r.key, bytes(r.x)) for r in found.collect()]  # 2 * GROWTH and a few at most

    return pick


def _score(model):
    def run(batches):
        for b in tx.each(batches):
            if b.num_rows:
                t, m, both = model.value.score(*unpack(b["x"].to_pylist()))
                yield pa.RecordBatch.from_arrays([b["id"], pa.array(t), pa.array(m), pa.array(both), pa.array((both >= 0.5).astype(np.int32))], ["doc_id", "text_score", "meta_score", "score", "quality"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", labelled: int = LABELLED) -> DataFrame:
    """doc_id, text_score, meta_score, score, quality (score of a half or more) for each row of docs (text, lang, source, n_chars)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("size"))
    rows = rows.withColumn("key", F.xxhash64("id", "text", "lang", "source", "size"))
    seen = cut(rows.mapInArrow(_features, "id long, key long, x binary"))
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("quality"))
    known = known.groupBy("id").agg(F.max("quality").alias("quality"))
    first = known.join(seen.select("id").distinct(), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(labelled)
    marked = seen.join(F.broadcast(first), "id").orderBy(F.xxhash64("id"), "key").limit(labelled)  # as many ids, and as many rows
    got = marked.select("quality", "x").collect()
    y = np.asarray([r.quality for r in got], np.float64)
    pool = cut(seen.where("id is not null").join(known.select("id"), "id", "left_anti").select("key", "x"))
    model = CoTrained(unpack([bytes(r.x) for r in got]), y, _picker(pool))
    shared = spark.sparkContext.broadcast(model)
    return seen.mapInArrow(_score(shared), "doc_id long, text_score double, meta_score double, score double, quality int")
