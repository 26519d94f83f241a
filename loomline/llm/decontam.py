"""Benchmark decontamination (operator 1): BM25 with a block-max WAND search over an inverted index of test items.

The items are the indexed collection and every training passage is a query: texts are cut into passages of two strides,
one stride apart, with a stride no shorter than the longest item of the index, so an item that stands in a text lies
whole in some passage. BM25 impacts are divided by the item's score against itself, so one threshold serves all items.
Bounds of a whole batch are worked out first: the sum of list maxima of a passage, then the sums of block maxima; only
passages with a block that can reach the threshold are searched document at a time with pivots and block skips. All
items above the threshold are then verified: enough of the word shingles of the question and of the answer, taken
together, must stand in the passage. An answer may be one shingle long, so it has no veto of its own; its share is
reported beside the question's.

Items go to the executors in groups of about GROUP_TOKENS tokens (more items: more passes), each cut into indexes by
item length and size. Statistics (document frequencies, number and mean length of items) are those of all items, so a
score does not depend on the groups; a group takes the frequencies of its own words along.

Defined cases: null or empty texts match nothing; very long texts are searched passage by passage; items without an id or
without words are not searched for; an item without an answer part is verified by its question alone, and the reverse (a
missing part's share is 1); items alike in id, question and answer count once, other items of one id each match;
repeated rows each match; rows without an id are searched and reported with a null id; of equal scores the passage with
the greater shares is reported, then the first; no items or an empty table: nothing is found; extra columns play no part.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left
from collections import Counter
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm import text as tx
from loomline.session import cut

K1, B, THRESHOLD, WIDTH, OVERLAP = 1.2, 0.75, 0.5, 5, 0.5
#: Bytes of the texts that are searched at once: arrays of a search are several times that.
CHUNK_BYTES = 1 << 20
BLOCK, INDEX_ITEMS, INDEX_TOKENS, GROUP_TOKENS = 4, 512, 100_000, 2_000_000
FOUND = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, word_offset long"


def grams(words: list[bytes], width: int = WIDTH) -> set[tuple]:
    """Distinct word shingles; fewer words than a shingle are one shingle; no words, none."""
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class Index:
    """Impact-ordered postings by item with list maxima and block maxima."""

    def __init__(self, items: list[tuple[int, list[bytes], list[bytes]]], df: Counter, total: int, mean: float):
        self.ids = [i for i, _, _ in items]
        self.split = [(grams(q), grams(a)) for _, q, a in items]
        #: What must be covered, each by itself: question and answer as one list, and nothing beside it.
        self.parts = [([*q, *a], []) for q, a in self.split]
        self.stride = max(len(q) + len(a) for _, q, a in items)
        self.widths = sorted({len(g) for p in self.split for s in p for g in s})
        self.terms: dict[bytes, int] = {}
        lists: list[list[tuple[int, float]]] = []
        for n, (_, q, a) in enumerate(items):
            words = Counter(q + a)
            length = len(q) + len(a)
            raw = {w: math.log(1 + (total - df[w] + 0.5) / (df[w] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * length / mean)) for w, f in words.items()}
            own = sum(raw.values())
            for w, x in raw.items():
                t = self.terms.setdefault(w, len(lists))
                if t == len(lists):
                    lists.append([])
                lists[t].append((n, x / own))
        self.items = [[n for n, _ in x] for x in lists]
        self.impacts = [[v for _, v in x] for x in lists]
        self.blocks = -(-len(items) // BLOCK)
        self.block_max = np.zeros((len(lists), self.blocks), np.float32)
        for t, x in enumerate(lists):
            for n, v in x:
                self.block_max[t, n // BLOCK] = max(self.block_max[t, n // BLOCK], v)
        self.block_max = np.nextafter(self.block_max, np.float32(2))  # rounded up: bounds stay bounds
        self.list_max = self.block_max.max(axis=1)

    def wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose score for the query terms is the threshold or more, by block-max WAND."""
        out, end = [], len(self.ids)
        block_max, list_max = self.block_max, self.list_max
        live = np.flatnonzero(block_max[terms].sum(axis=0, dtype=np.float64) >= threshold).tolist()
        if not live:
            return out
        at = [[self.items[t][0], 0, t] for t in terms]  # item under the cursor, its place, term

        def move(c, item):
            p = bisect_left(self.items[c[2]], item, c[1])
            c[1] = p
            c[0] = self.items[c[2]][p] if p < len(self.items[c[2]]) else end

        while True:
            at = sorted((c for c in at if c[0] < end), key=lambda c: c[0])
            bound, pivot = 0.0, None
            for i, c in enumerate(at):
                bound += list_max[c[2]]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot is None:
                return out
            item = at[pivot][0]
            while pivot + 1 < len(at) and at[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK
            ahead = bisect_left(live, block)
            if ahead == len(live):
                return out
            if live[ahead] > block:  # no item before the next live block can reach the threshold
                for c in at:
                    if c[0] < live[ahead] * BLOCK:
                        move(c, live[ahead] * BLOCK)
            elif sum(float(block_max[c[2], block]) for c in at[: pivot + 1]) < threshold:
                skip = min((block + 1) * BLOCK, at[pivot + 1][0] if pivot + 1 < len(at) else end)
                for c in at[: pivot + 1]:
                    move(c, skip)
            elif at[0][0] == item:
                score = sum(self.impacts[c[2]][c[1]] for c in at[: pivot + 1])
                if score >= threshold - 1e-9:
                    out.append((item, score))
                for c in at[: pivot + 1]:
                    move(c, item + 1)
            else:
                for c in at[:pivot]:
                    if c[0] < item:
                        move(c, item)

    def search(self, codes: np.ndarray, ends: np.ndarray, distinct: list[bytes], threshold: float, overlap: float):
        """(text, item, score, question overlap, answer overlap, word offset): the best passage for each text and item."""
        local = np.fromiter((self.terms.get(w, -1) for w in distinct), np.int64, len(distinct))
        term = local[codes] if len(codes) else np.empty(0, np.int64)
        length = np.diff(ends)
        strides = np.maximum(1, -(-length // self.stride))
        base = np.cumsum(strides) - strides
        known = np.flatnonzero(term >= 0)
        if not len(known):
            return []
        text = np.searchsorted(ends, known, side="right") - 1
        stride = base[text] + (known - ends[text]) // self.stride
        key = np.unique(stride * len(self.items) + term[known])
        stride, term = key // len(self.items), key % len(self.items)
        total = int(strides.sum())
        heads = np.flatnonzero(np.r_[True, stride[1:] != stride[:-1]])
        lists = np.zeros(total + 1)
        lists[stride[heads]] = np.add.reduceat(self.list_max[term].astype(np.float64), heads)
        last = np.zeros(total, bool)
        last[base + strides - 1] = True
        # a passage is a stride and the next one of the same text
        after = np.where(last, total, np.arange(total) + 1)
        able = np.flatnonzero(lists[:total] + lists[after] >= threshold)
        if not len(able):
            return []
        need = np.zeros(total + 1, bool)
        need[able] = need[after[able]] = True
        picked = need[stride]
        sub, sub_term = stride[picked], term[picked]
        heads = np.flatnonzero(np.r_[True, sub[1:] != sub[:-1]])
        where = np.full(total + 1, len(heads))
        where[sub[heads]] = np.arange(len(heads))
        sums = np.zeros((len(heads) + 1, self.blocks))
        for s in range(0, len(heads), 1024):  # rows of block maxima, some passages at a time
            z = min(s + 1024, len(heads))
            a, e = heads[s], heads[z] if z < len(heads) else len(sub)
            sums[s:z] = np.add.reduceat(self.block_max[sub_term[a:e]].astype(np.float64), heads[s:z] - a, axis=0)
        able = able[(sums[where[able]] + sums[where[after[able]]]).max(axis=1) >= threshold]
        best: dict[tuple[int, int], tuple] = {}
        for s in able.tolist():
            mine = set(term[np.searchsorted(stride, s) : np.searchsorted(stride, s + 1)].tolist())
            if not last[s]:
                mine.update(term[np.searchsorted(stride, s + 1) : np.searchsorted(stride, s + 2)].tolist())
            hits = self.wand(sorted(mine), threshold)
            if not hits:
                continue
            d = int(np.searchsorted(base, s, side="right")) - 1
            start = int(ends[d]) + (s - int(base[d])) * self.stride
            words = [distinct[c] for c in codes[start : min(start + 2 * self.stride, int(ends[d + 1]))].tolist()]
            have = {tuple(words[i : i + w]) for w in self.widths for i in range(len(words) - w + 1)}
            for item, score in hits:
                if all(sum(g in have for g in p) >= overlap * len(p) for p in self.parts[item]):
                    q, a = (len(p & have) / len(p) if p else 1.0 for p in self.split[item])
                    best[d, item] = max(best.get((d, item), (-1.0,)), (score, q, a, int(ends[d]) - start))
        return [(d, self.ids[i], score, q, a, -at) for (d, i), (score, q, a, at) in best.items()]


class Group(NamedTuple):
    """A group of items, the document frequencies of its words among all items, and all items' number and mean length."""

    name: str
    items: list[tuple[int, list[bytes], list[bytes]]]
    df: dict[bytes, int]
    total: int
    mean: float


def whole_group(items: list[tuple[int, list[bytes], list[bytes]]]) -> Group:
    """All items as one group."""
    items = [x for x in items if x[1] or x[2]]
    df = Counter(w for _, q, a in items for w in set(q + a))
    return Group(uuid.uuid4().hex, items, df, len(items), sum(len(q) + len(a) for _, q, a in items) / max(1, len(items)))


def indexes(group: Group) -> list[Index]:
    """Indexes over items of a group, by item length (powers of four times 64 words) and in bounded sizes."""
    _, items, df, total, mean = group
    out, now, tokens, level = [], [], 0, 0
    for x in sorted(items, key=lambda x: (len(x[1]) + len(x[2]), x[0])):
        n = len(x[1]) + len(x[2])
        mine = 0
        while n > 64 * 4**mine:
            mine += 1
        if now and (mine != level or len(now) >= INDEX_ITEMS or tokens + n > INDEX_TOKENS):
            out.append(Index(now, df, total, mean))
            now, tokens = [], 0
        level = mine
        now.append(x)
        tokens += n
    return [*out, Index(now, df, total, mean)] if now else out


_BUILT: dict[str, list[Index]] = {}


def _built(group: Group) -> list[Index]:
    """The indexes of a group, built once in a worker process; only the last group's are kept."""
    if group.name not in _BUILT:
        _BUILT.clear()
        _BUILT[group.name] = indexes(group)
    return _BUILT[group.name]


def _search(group, threshold: float, overlap: float):
    def run(batches):
        built = _built(group.value)
        for b in tx.chunks(batches, "text", CHUNK_BYTES):
            codes, ends, distinct = tx.encode(b["text"].to_pylist())
            ids = b["id"].to_pylist()
            rows = [(ids[d], *rest) for index in built for d, *rest in index.search(codes, ends, distinct, threshold, overlap)]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in FOUND.split(", ")])

    return run


def question_and_answer(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, question, answer out of one text: the answer is the last sentence; a single sentence is all question."""
    text = F.trim(F.coalesce(F.col(text_col), F.lit("")))
    return items.select(F.col(id_col).alias("item_id"), F.regexp_extract(text, r"(?s)^(.*[.!?])\s+\S.*$", 1).alias("head"), text.alias("whole")).select("item_id", F.when(F.col("head") != "", F.col("head")).otherwise(F.col("whole")).alias("question"), F.when(F.col("head") != "", F.expr("substring(whole, length(head) + 1)")).otherwise("").alias("answer"))


def _words(column: str):
    """The words of a text, as text.words has them."""
    lower = F.translate(F.coalesce(F.col(column), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _groups(items: DataFrame):
    """Items in groups of GROUP_TOKENS tokens, about, one broadcast at a time."""
    spark = items.sparkSession
    known = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "question", "answer").distinct()
    known = cut(known.withColumn("words", F.concat(_words("question"), _words("answer"))).where(F.size("words") > 0))
    sums = known.agg(F.sum(F.size("words")).alias("tokens"), F.count("*").alias("n")).first()
    groups = max(1, -(-(sums.tokens or 0) // GROUP_TOKENS))
    share = lambda df: df.withColumn("g", F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(groups)))
    of = lambda rows: [(r.item_id, tx.words(r.question), tx.words(r.answer)) for r in rows]
    if groups == 1:
        yield spark.sparkContext.broadcast(whole_group(of(known.collect())))
        return
    each = share(known).select("g", F.explode(F.array_distinct("words")).alias("word"))
    df = each.groupBy("word").agg(F.count("*").alias("n"))
    df = cut(each.distinct().join(df, "word"))  # g, word, n: each group's words with their frequencies among all items
    for g in range(groups):
        mine, often = share(known).where(F.col("g") == g).collect(), df.where(F.col("g") == g).select("word", "n").collect()
        yield spark.sparkContext.broadcast(Group(uuid.uuid4().hex, of(mine), {r.word.encode(): r.n for r in often}, sums.n, sums.tokens / sums.n))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """Pairs of a text and a test item (item_id, question, answer) found in it, with its best passage's figures."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = [texts.mapInArrow(_search(group, threshold, overlap), FOUND) for group in _groups(items)]
    return reduce(DataFrame.unionByName, found)


def _without(group, text_col: str, threshold: float, overlap: float):
    def run(batches):
        built = _built(group.value)
        for b in tx.chunks(batches, text_col, CHUNK_BYTES):
            encoded = tx.encode(b.column(text_col).to_pylist())
            keep = np.ones(b.num_rows, bool)
            keep[[row[0] for index in built for row in index.search(*encoded, threshold, overlap)]] = False
            yield b.filter(pa.array(keep))

    return run


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of docs whose text holds no test item, with all their columns."""
    for group in _groups(items):
        docs = docs.mapInArrow(_without(group, text_col, threshold, overlap), docs.schema)
    return docs
