"""Packing (operator 3).

Documents become token ids with one end id; overlong ones are first cut into full windows. The pieces are dealt at
random into bundles of a bounded number of pieces (as many bundles as the corpus needs), and each bundle is packed by
best-fit decreasing: a segment tree over remaining capacities finds the tightest open window.

Token ids are those of the `tokenizers` library for the given file. Where the file is a byte-level BPE whose merges are
ranked by id, plain texts (ASCII and Latin letters, on whose classes all Unicode versions agree) go through `tiktoken`
with the file's own vocabulary: the same algorithm at a third of the cost. All other texts, and all files of other
kinds, go through `tokenizers`: units between single spaces are encoded once and remembered in a bounded cache. The
pre-tokenizer always breaks before a single space that has a non-space on both sides, so this gives the same ids as
encoding the whole text. Texts that hold a token added to the vocabulary (such as the end of a text) are encoded whole.

Defined cases: a null or empty text is one piece with the end id; a text of any length is cut into full windows and a
rest; pieces of equal length go in order of id and start; rows without an id and repeated rows are packed each; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.text import chunks
from loomline.session import cut

CAPACITY, END_ID = 2048, 1
#: Pieces in a bundle, on average. One bundle is packed by one task.
BUNDLE = 1 << 15
#: Bounds of the unit cache of one worker.
CACHE_UNITS, CACHE_CHARS = 400_000, 16_000_000
_IRREGULAR = re.compile(r"^\s|\s | \s| $")
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ɏ]*")
#: Fixed value: the published pre-tokenizer pattern of byte-level BPE.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if printable, else 256 and on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranked(path: str):
    """A tiktoken encoding with the file's vocabulary, or None if the file is not a byte-level BPE ranked by id."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
    if not plain or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"].get("".join(m), -1) for m in merges]
    if ids != sorted(set(ids)) or -1 in ids[:1]:
        return None
    added, byte = {t["content"] for t in spec.get("added_tokens", [])}, _byte_alphabet()
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    return tiktoken.Encoding("file", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = ranked(path)
        #: Texts that hold a token added to the vocabulary go through `tokenizers` as a whole, and so do all with a normalizer.
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join(added) if added else "(?!)") if self.tokenizer.normalizer is None else re.compile("")
        self.forget()

    def forget(self) -> None:
        if hasattr(self, "known"):
            self.known.default_factory = None  # no cycle: the old cache goes at once
        self.known: defaultdict = defaultdict()
        self.known.default_factory = self.known.__len__
        self.flat, self.start, self.length, self.chars = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64), 0

    @staticmethod
    def units(text: str) -> list:
        """The text cut before safe spaces. A str stands for itself after one space; the first unit is a 1-tuple."""
        parts = text.split(" ")
        if not _IRREGULAR.search(text):
            parts[0] = (parts[0],)
            return parts
        out, now, first = [], parts[0], True
        for part in parts[1:]:
            if part and now and not now[-1].isspace() and not part[0].isspace():
                out.append((now,) if first else now)
                now, first = part, False
            else:
                now += " " + part
        out.append((now,) if first else now)
        return out

    def encode(self, texts: list[str | None], end: int = END_ID) -> list[np.ndarray]:
        """Little-endian 32-bit ids of each text, then the end id."""
        whole = [bool(self.whole.search(t or "")) for t in texts]
        plain = [bool(self.ranked and not w and _PLAIN.fullmatch(t or "")) for t, w in zip(texts, whole, strict=True)]
        units = iter(self._by_units([t for t, p, w in zip(texts, plain, whole, strict=True) if not p and not w]))

        def ids(t: str, p: bool, w: bool):
            if w:
                return self.tokenizer.encode(t, add_special_tokens=False).ids
            return self.ranked.encode_to_numpy(t, disallowed_special=()) if p else next(units)

        return [np.append(ids(t or "", p, w), end).astype("<u4") for t, p, w in zip(texts, plain, whole, strict=True)]

    def _by_units(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > CACHE_UNITS or self.chars > CACHE_CHARS:
            self.forget()
        code, old = self.known.__getitem__, len(self.known)
        codes = [np.fromiter(map(code, u), np.int64, len(u)) for u in ([] if not t else self.units(t) for t in texts)]
        if len(self.known) > old:
            fresh = list(self.known)[old:]
            fresh = [u[0] if type(u) is tuple else " " + u for u in fresh]
            self.chars += sum(map(len, fresh))
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
            self.length = np.concatenate([self.length, np.fromiter(map(len, ids), np.int64, len(ids))])
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.uint32)])
            self.start = np.cumsum(self.length) - self.length
        out = []
        for c in codes:
            n = self.length[c] if len(c) else c
            at = np.cumsum(n)
            total = int(at[-1]) if len(c) else 0
            out.append(self.flat[np.repeat(self.start[c] - at + n, n) + np.arange(total)])
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process, so that its cache lives through the worker's tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _pieces(path: str, capacity: int, end: int):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        enc = encoder(path)
        for b in chunks(batches, "_text"):
            out = ([], [], [], [], [])
            for doc, ids in zip(b["_doc"].to_pylist(), enc.encode(b["_text"].to_pylist(), end), strict=True):
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    for column, value in zip(out, (doc, start, len(piece), len(ids), piece.tobytes()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

    return run


def tokenize_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (little-endian 32-bit) of the pieces: full windows, then the rest."""
    texts = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_text"))
    return texts.mapInArrow(_pieces(tokenizer, capacity, end), "doc_id long, start long, length long, doc_tokens long, ids binary")


class Capacities:
    """Segment tree over remaining capacities 0..most: how many open windows have each; finds the tightest that fits."""

    def __init__(self, most: int):
        self.size = 1 << max(1, most.bit_length())
        self.tree = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def _add(self, capacity: int, by: int) -> None:
        i = capacity + self.size
        while i:
            self.tree[i] += by
            i >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """An open window of the smallest remaining capacity that is least or more."""
        i = least + self.size
        if not self.tree[i]:
            while i > 1 and (i & 1 or not self.tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        capacity = i - self.size
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    spaces, made = Capacities(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = spaces.take(n) if n < capacity else None
        if found is None:
            found, made = (capacity, made), made + 1
        left, w = found
        window[i], offset[i] = w, capacity - left
        if left > n:
            spaces.put(left - n, w)
    return window, offset


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        window, offset = best_fit_decreasing(table["length"].to_numpy(), capacity)
        first = table["_bundle"][0].as_py() << 32
        return table.drop_columns(["_bundle"]).append_column("sequence_id", pa.array(window + first)).append_column("offset", pa.array(offset))

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, bundle: int = BUNDLE) -> DataFrame:
    """Adds sequence_id (bundle * 2**32 + window) and offset to pieces (doc_id, start, length and whatever else)."""
    held = cut(pieces)  # the numbering of rows below must not change if a task is run again
    bundles = max(1, -(-held.count() // bundle))
    dealt = held.withColumn("_bundle", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(bundles)))
    schema = T.StructType([f for f in pieces.schema]).add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("_bundle").applyInArrow(_pack(capacity), schema)
