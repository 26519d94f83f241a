"""LM scoring (operator 2): a probabilistic suffix tree over word tokens.

Symbols are lower-cased words and one end of text; a text follows a start mark, which is a context only. Grams of up to
DEPTH+1 symbols are counted over all learned texts and stored if they occur LEAST times or more (level by level: a gram
can be that frequent only if its prefix and suffix are), at every size of the corpus: the tree grows with it. A context is retained if its next-symbol distribution diverges from that of its longest retained suffix by more
than its size is worth (N * KL >= symbols * ln(N) / 2). Next-symbol distributions are discounted, and what is left goes
to the other symbols in proportion to the suffix's distribution; the root gives every word (count + 1) / (N + V + 1),
unknown ones too, from exact counts of all words. A token is scored in its longest suffix state.

The texts are encoded once into blocks (checkpointed). Counts of words of a block go out by hash bucket, are summed
there, and the sums come back to the block that asked, so no table of words is ever in one place; with them comes a
number for each word that is frequent enough for the tree (its rank in its bucket, and the bucket), so that grams travel
as short numbers. A block sends a row a bucket, and never more rows than it has words: as many records at most as a
plain count of words by block would shuffle. Words of a large share of some block are found first and summed by a plain
aggregate, which combines them before the shuffle; they, a bounded list, go to all. The tree is dealt in the same way,
length by length: grams go with their context to the context's bucket, which sums them, decides whether the context is
retained, and answers each block for the grams and contexts that it asked for. Only a context that occurs very often
(HOT) has its grams dealt to all buckets; one row of sums a bucket then decides on it.

Defined cases: null texts are empty (one end token); a text of any length is scored whole, and one beyond the size of a
block is a block of its own; rows without an id are learned from and not held out; repeated rows count each; with
nothing to learn from every token has probability 1 / (0 + 0 + 1); an empty table gives no rows; extra columns play no
part, whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm import text as tx
from loomline.llm.settings import CLEANUP, setting
from loomline.session import cut, spilled, sweep

DEPTH, LEAST, DISCOUNT = 3, 2, 0.5
#: Counts that one task sums, about.
BUCKET = 1_000_000
#: Bytes of text in a block, about: the larger, the fewer grams travel twice.
BLOCK_BYTES = 4 << 20
#: Blocks that one task reads, at most.
BLOCKS = 32
#: A context of so many occurrences, and of this share of all tokens, has its grams dealt to all buckets.
HOT, HOT_SHARE = 1 << 17, 1e-4
#: A word of this share of a block's tokens is summed apart if it has half of that share of all tokens.
COMMON_SHARE = 1e-3
_END = np.uint64(1)
#: Number of the start mark; words are numbered from 1.
_MARK = np.uint64(0)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_TEXTS = "block long, docs array<long>, held array<boolean>, sizes binary, codes binary"
_BLOCK = f"{_TEXTS}, words binary, common array<long>, n_words long, n_train long, d_train long"
_KINDS_OF = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "binary": pa.binary()}


def _press(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(a).tobytes())


def _open(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _press_numbers(a: np.ndarray) -> bytes:
    """Whole numbers, mostly small: byte by byte of them, the lowest first, as many as the largest takes."""
    a = np.ascontiguousarray(a, "<u8")
    width = max(1, -(-int(a.max(initial=0)).bit_length() // 8))
    return bytes([width]) + zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())


def _open_numbers(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(b[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : b[0]] = planes.T
    return out.view("<u8").ravel()


def _press_lefts(weight: np.ndarray, missed: np.ndarray) -> bytes:
    """Whether each weight is a number, and those that are and are needed."""
    kept = ~np.isnan(weight)
    head = _press(np.packbits(kept))
    return len(head).to_bytes(4, "little") + head + _press_numbers(weight[kept & missed].view(np.uint64))


def _open_lefts(b: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    at = 4 + int.from_bytes(b[:4], "little")
    return np.unpackbits(_open(b[4:at], np.uint8), count=n).astype(bool), _open_numbers(b[at:]).view(np.float64)


def _small(a: np.ndarray) -> np.ndarray:
    return a.astype(np.int32 if int(a.max(initial=0)) < 1 << 31 else np.int64)


def _longer(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Keys of grams one symbol longer."""
    with np.errstate(over="ignore"):
        return tx.mix(tx.mix(key) * _GOLD + symbol)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(of: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS_OF[c.split()[1]]) for c in of.split(", ")])


def _encode(batches):
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    for b in tx.chunks(batches, "text", BLOCK_BYTES):
        codes, ends, distinct = tx.encode(b["text"].to_pylist())
        size, held = np.diff(ends).astype(np.int32), np.asarray(b["held"].to_pylist(), bool)
        learned, words = ~held, np.r_[tx.hashes(distinct), _END]
        seen = np.r_[np.bincount(codes[np.repeat(learned, size)], minlength=len(distinct)), int(learned.sum())]
        n = int(seen.sum())
        common = words[seen >= max(1, COMMON_SHARE * n)].view(np.int64) if n else words[:0].view(np.int64)
        yield _batch([(block, b["id"].to_pylist(), held.tolist(), size.tobytes(), _press_numbers(codes), _press(words), common.tolist(), len(words), n, int(learned.sum()))], _arrow(_BLOCK))
        block += 1


class Block:
    """One block of texts: a stream of local word codes with a start mark before and an end after each text.

    n_words: distinct words, the end included; its code is the last.
    """

    def __init__(self, row: dict, n_words: int):
        codes, size = _small(_open_numbers(row["codes"])), np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        self.held = np.asarray(row["held"], bool)
        self.starts = np.cumsum(size + 2) - (size + 2)
        self.stream = np.empty(int((size + 2).sum()), codes.dtype)
        inside = np.ones(len(self.stream), bool)
        inside[self.starts] = inside[self.starts + size + 1] = False
        self.stream[inside] = codes
        self.stream[self.starts + size + 1] = n_words - 1
        self.stream[self.starts] = -1  # the mark
        self.learned = np.repeat(~self.held, size + 2)
        self.size = size


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((tx.mix(key.view(np.uint64)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


_DEALT = "bucket long, block long, keys binary, counts binary"
_ANSWERED = "bucket long, block long, counts binary, numbers binary, distinct long"
_NUMBERED = f"{_TEXTS}, counts binary, numbers binary"


def _parts(of: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The places of each bucket, in their order."""
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(of[order]) > 0, True]) if len(of) else np.zeros(1, np.int64)
    return [(int(of[order[a]]), order[a:z]) for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _seen(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """A block's words and how often they are learned from."""
    words = _open(row["words"], np.uint64)
    x = Block(row, len(words))
    return words, np.bincount(x.stream[x.learned & (x.stream >= 0)], minlength=len(words))


def _count_words(buckets: int, common):
    """Words and counts of a block as one row a bucket, in the order they have in the block; without the common ones."""

    def run(batches):
        for b in tx.each(batches):
            for row in b.to_pylist():
                words, counts = _seen(row)
                rare = _find(common.value, words) < 0
                words, counts = words[rare], counts[rare]
                yield _batch([(bucket, row["block"], _press(words[at]), _press_numbers(counts[at])) for bucket, at in _parts(_bucket(words, buckets))], _arrow(_DEALT))

    return run


def _count_common(common):
    def run(batches):
        for b in tx.each(batches):
            for row in b.to_pylist():
                words, counts = _seen(row)
                at = _find(common.value, words) >= 0
                yield pa.RecordBatch.from_arrays([pa.array(words[at].view(np.int64)), pa.array(counts[at], pa.int64())], ["word", "n"])

    return run


def _answer_words(least: int, buckets: int, first: int):
    """For each block that asked: its words' counts, and the numbers of those that are frequent enough (else 0). With
    the first row: distinct words of the bucket. Numbers go by count, so that frequent words have small ones."""

    def run(table: pa.Table) -> pa.Table:
        keys = [_open(k.as_py(), np.uint64) for k in table["keys"]]
        counts = np.concatenate([_open_numbers(c.as_py()) for c in table["counts"]])
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, counts, len(key)).astype(np.int64)
        order = np.argsort(-total, kind="stable")
        number = np.zeros(len(key), np.uint64)
        stored = order[: int((total >= least).sum())]
        number[stored] = np.arange(len(stored)) * buckets + table["bucket"][0].as_py() + first
        ends = np.cumsum([0, *map(len, keys)])
        mine = [back[a:z] for a, z in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table({
            "bucket": table["bucket"], "block": table["block"], "counts": pa.array([_press_numbers(total[m]) for m in mine], pa.binary()), "numbers": pa.array([_press_numbers(number[m]) for m in mine], pa.binary()),
            "distinct": pa.array([int((total > 0).sum())] + [0] * (table.num_rows - 1), pa.int64()),
        })

    return run


def _number(buckets: int, common, common_counts: np.ndarray, least: int):
    """Blocks with the counts and numbers of their words in place of the words."""

    def run(batches):
        for b in tx.each(batches):
            for row in b.to_pylist():
                words = _open(row["words"], np.uint64)
                place = _find(common.value, words)
                counts, numbers = np.zeros((2, len(words)), np.uint64)
                counts[place >= 0] = common_counts[place[place >= 0]]
                numbers[place >= 0] = np.where(common_counts >= least, np.arange(len(common_counts)) + 1, 0)[place[place >= 0]]
                rare = np.flatnonzero(place < 0)
                answers = {a["bucket"]: a for a in row["answers"] or []}
                for bucket, at in _parts(_bucket(words[rare], buckets)):
                    counts[rare[at]], numbers[rare[at]] = (_open_numbers(answers[bucket][k]) for k in ("counts", "numbers"))
                yield _batch([(*(row[c.split()[0]] for c in _TEXTS.split(", ")), _press_numbers(counts), _press_numbers(numbers))], _arrow(_NUMBERED))

    return run


def _retain(context: np.ndarray, own: np.ndarray, above: np.ndarray, size: int) -> np.ndarray:
    """By context, sums over its stored grams: how many, their probabilities, those in the suffix, and the divergence."""
    return np.stack([np.bincount(context, x, size) for x in (None, own, above, own * np.log(own / above))], axis=1)


def _left(n: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Weights of what is left beside the stored grams, NaN for contexts that aren't retained."""
    stored, own, above, gain = sums.T
    rest, rest_above = 1 - own, np.maximum(1 - above, 1e-12)
    gain = gain + rest * np.log(np.maximum(rest, 1e-12) / rest_above)
    keep = (stored > 0) & (rest > 1e-9) & (n * gain >= stored * np.log(np.maximum(n, 2)) / 2)
    return np.where(keep, np.maximum(rest, 1e-12) / rest_above, np.nan)


def _find(sorted_keys: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of keys in sorted_keys, -1 where absent."""
    if not len(sorted_keys):
        return np.full(len(key), -1, np.int64)
    at = np.searchsorted(sorted_keys, key)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == key, at, -1)


class Tree:
    """The same model in one place, for small corpora; tests hold the dealt one against it.

    Frequent words (sorted hashes; the start mark is one more id, the last) and frequent grams by length.

    grams[d]: sorted keys of grams of d+2 symbols: place of the prefix among those of d+1 symbols, times `base`, plus the last symbol.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, tokens: int, distinct: int, docs: int):
        self.words, self.mark, self.base = words, len(words), len(words) + 1
        self.tokens, self.distinct = tokens, distinct
        self.grams: list[np.ndarray] = []
        self.counts = [np.r_[counts, docs]]

    def root(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + self.distinct + 1)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(keys)
        self.grams.append(keys[order])
        self.counts.append(counts[order])

    def symbols(self, block: Block, words: np.ndarray) -> np.ndarray:
        local = np.r_[_find(self.words, words), self.mark]  # the mark is -1 in the stream
        return local[block.stream]

    def extend(self, state: np.ndarray, symbol: np.ndarray, keys: np.ndarray | None) -> np.ndarray:
        """Keys of the grams one longer that end at each place (-1: none), or their places among keys."""
        out = np.full(len(symbol), -1, np.int64)
        ok = np.flatnonzero((state[:-1] >= 0) & (state[1:] >= 0) & (symbol[1:] >= 0) & (symbol[1:] != self.mark)) + 1
        key = state[ok - 1] * self.base + symbol[ok]
        out[ok] = key if keys is None else _find(keys, key)
        return out

    def states(self, block: Block, words: np.ndarray) -> list[np.ndarray]:
        """By length, the places of the frequent grams that end at each place of the stream."""
        symbol = self.symbols(block, words)
        out = [symbol]
        for keys in self.grams:
            out.append(self.extend(out[-1], symbol, keys))
        return out

    def grow(self) -> None:
        """Retained contexts, probabilities of stored symbols, and weights of what is left, from counts by length."""
        word = self.root(self.counts[0])
        self.prob, self.left, self.kept = [word], [], []
        suffix = None
        for d, keys in enumerate(self.grams):
            context, symbol = keys // self.base, keys % self.base
            if d == 0:
                place = symbol
            else:
                place = _find(self.grams[d - 1], suffix[context] * self.base + symbol)
            above = self.prob[d][place]
            n = self.counts[d].astype(np.float64)
            c = self.counts[d + 1].astype(np.float64)
            own = (c - DISCOUNT) / n[context]
            left = _left(n, _retain(context, own, above, len(n)))
            keep = ~np.isnan(left)
            self.kept.append(keep)
            self.left.append(np.where(keep, np.log10(np.where(keep, left, 1)), 0.0))
            self.prob.append(np.where(keep[context], own, above))
            suffix = place
        self.log = [np.log10(p) for p in self.prob]

    def score(self, block: Block, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each text: tokens, known tokens, base score and score."""
        states = self.states(block, words)
        base = np.r_[np.log10(self.root(counts)), 0.0][block.stream]
        value, open_ = np.zeros(len(base)), block.stream >= 0
        for d in range(len(self.grams) - 1, -1, -1):
            context, gram = np.r_[-1, states[d][:-1]], states[d + 1]
            use = open_ & (context >= 0)
            use[use] = self.kept[d][context[use]]
            hit = use & (gram >= 0)
            value[hit] += self.log[d + 1][gram[hit]]
            miss = use & ~hit
            value[miss] += self.left[d][context[miss]]
            open_ &= ~hit
        value[open_] += base[open_]
        known = np.r_[counts > 0, False][block.stream]
        add = lambda x: np.add.reduceat(x, block.starts) if len(block.starts) else np.empty(0)
        return block.size + 1, add(known.astype(np.int64)), add(base), add(value)


#: What travels of a block's contexts and grams to a bucket, in order of the contexts' and grams' symbols: how often each
#: context occurs (doubled, plus one if a symbol follows it that can't be stored), how many of its grams follow, and of these the last symbol, count and probability in the suffix. The
#: suffix of such a gram is stored, so that is a ratio of two counts: that of the gram and of its context in the longest
#: retained suffix, or that of the word, and 0, where none is retained.
_KINDS = ("n", "sizes", "keys", "nums", "dens", "counts")
_ASKED = ", ".join(["bucket long, block long, contexts array<binary>", *(f"{k} binary" for k in _KINDS)])
_KINDS_OF["array<binary>"] = pa.list_(pa.binary())


def _ratio(num: np.ndarray, den: np.ndarray, size: dict) -> np.ndarray:
    num = num.astype(np.float64)
    return np.where(den > 0, (num - DISCOUNT) / np.maximum(den, 1), (num + 1) / (size["tokens"] + size["distinct"] + 1))


def _press_contexts(symbols: list[np.ndarray]) -> list[bytes]:
    """Symbols of sorted contexts, one list a place; the first as differences."""
    return [_press_numbers(np.diff(symbols[0], prepend=np.uint64(0))), *map(_press_numbers, symbols[1:])]


def _open_contexts(columns: list[bytes]) -> np.ndarray:
    """Keys of contexts."""
    key = np.cumsum(_open_numbers(columns[0]), dtype=np.uint64)
    for c in columns[1:]:
        key = _longer(key, _open_numbers(c))
    return key


_SETTLED = "bucket long, block long, grams binary, lefts binary, hot_key binary, hot_n binary, hot_sums binary"
#: What a block knows of the tree: the answers of each length so far, and the weights of the hot contexts of each.
_KNOWN = "array<struct<level int, bucket long, grams binary, lefts binary>>"


class Walk:
    """The places of a block's stream and, length by length, the stored gram that ends at each (its number in the block,
    count and key) and the probability of its last symbol in the longest retained context so far."""

    def __init__(self, row: dict, size: dict):
        self.counts, numbers = _open_numbers(row["counts"]).astype(np.int64), _open_numbers(row["numbers"])
        x = Block(row, len(self.counts))
        self.block, self.size = x, size
        order = np.argsort(numbers, kind="stable")
        rank = np.empty(len(order) + 1, np.int32)
        rank[order], rank[-1] = np.arange(len(order)), len(order)  # words by number, and the mark
        self.number = np.r_[numbers[order], _MARK]
        self.code = self.at = rank[x.stream]
        self.key_of, self.symbols_of = self.number, [self.number]
        self.n_of = np.r_[np.where(self.counts >= size["least"], self.counts, 0)[order], size["docs"]]
        self.num = _small(np.r_[self.counts, 0])[x.stream]
        self.den = np.zeros(len(x.stream), np.int64 if size["docs"] + size["tokens"] >> 31 else np.int32)
        self.base = self.prob = np.where(x.stream >= 0, _ratio(self.num, self.den, size), 1.0)

    def ask(self) -> None:
        """Contexts that occur in the block, and the grams one longer, by context."""
        x = self.block
        n = _small(np.r_[self.n_of, 0])[self.at]
        self.use = np.flatnonzero((x.stream[1:] >= 0) & (n[:-1] > 0)) + 1
        self.n = n[self.use - 1]
        before = self.at[self.use - 1]
        seen = np.zeros(len(self.key_of), bool)
        seen[before] = True
        which = np.flatnonzero(seen)
        self.context = (np.cumsum(seen, dtype=np.int32) - 1)[before]
        self.contexts, self.context_n, self.symbols = self.key_of[which], self.n_of[which], [s[which] for s in self.symbols_of]
        self.hot = self.context_n >= self.size["hot"]
        child = n[self.use] > 0
        self.child = np.flatnonzero(child)  # among the places used
        self.loose = np.zeros(len(which), bool)
        self.loose[self.context[~child]] = True
        at = self.use[self.child]
        pair = self.context[self.child].astype(np.int64) * len(self.number) + self.code[at]
        order = np.argsort(pair)
        head = np.diff(pair[order], prepend=-1) > 0
        self.gram = np.empty(len(pair), np.int32)
        self.gram[order] = np.cumsum(head, dtype=np.int32) - 1
        first = order[head]
        del order, head
        self.parent, self.last = np.divmod(pair[first], len(self.number))
        self.last = self.number[self.last]
        self.grams = _longer(self.contexts[self.parent], self.last)
        self.ratio = self.num[at[first]], self.den[at[first]]
        self.gram_counts = np.bincount(self.gram, x.learned[at], len(self.grams)).astype(np.int64)
        buckets = self.size["buckets"]
        self.context_of = _bucket(self.contexts, buckets)
        self.gram_of = np.where(self.hot[self.parent], _bucket(self.grams, buckets), self.context_of[self.parent])
        self.gram_order = np.argsort(self.gram_of.astype(np.min_scalar_type(buckets)), kind="stable")
        #: A hot context goes to the buckets of its grams, any other to its own, there in the order of its number.
        whole = np.flatnonzero(~self.hot)
        self.context_order = whole[np.argsort(self.context_of[whole].astype(np.min_scalar_type(buckets)), kind="stable")]

    def asked(self, number: int) -> pa.RecordBatch:
        buckets = np.arange(self.size["buckets"] + 1)
        g = np.searchsorted(self.gram_of[self.gram_order], buckets)
        c = np.searchsorted(self.context_of[self.context_order], buckets)
        rows = []
        for b in range(len(buckets) - 1):
            grams, whole = self.gram_order[g[b] : g[b + 1]], self.context_order[c[b] : c[b + 1]]
            if not len(grams) and not len(whole):
                continue
            parent = self.parent[grams]
            contexts = np.union1d(whole, parent) if self.hot[parent].any() else whole
            sizes = np.bincount(np.searchsorted(contexts, parent), minlength=len(contexts))
            values = 2 * self.context_n[contexts].astype(np.int64) + self.loose[contexts], sizes, self.last[grams], *(x[grams] for x in self.ratio), self.gram_counts[grams]
            rows.append((b, number, _press_contexts([s[contexts] for s in self.symbols]), *map(_press_numbers, values)))
        return _batch(rows, _arrow(_ASKED))

    def learn(self, answers: list[dict], hot: tuple[np.ndarray, np.ndarray]) -> None:
        """Go one symbol up with the answers to what was asked, and (key, weight left) of the hot contexts."""
        answers = sorted(answers, key=lambda a: a["bucket"])
        n, left = np.zeros(len(self.grams), np.int64), np.full(len(self.contexts), np.nan)
        n[self.gram_order] = np.concatenate([np.empty(0, np.int64), *(_open_numbers(a["grams"]).astype(np.int64) for a in answers)])
        # a weight comes for each retained context behind which some symbol of the block is not stored; no other is used
        missed = self.loose.copy()
        missed[self.parent[n == 0]] = True
        asked = np.bincount(self.context_of[self.context_order], minlength=self.size["buckets"])
        lefts = [_open_lefts(a["lefts"], int(asked[a["bucket"]])) for a in answers]
        kept = self.context_order[np.concatenate([np.empty(0, bool), *(k for k, _ in lefts)])]
        left[kept] = 1.0
        left[kept[missed[kept]]] = np.concatenate([np.empty(0), *(v for _, v in lefts)])
        found = _find(hot[0], self.contexts[self.hot])
        left[self.hot] = np.where(found >= 0, np.r_[hot[1], np.nan][found], np.nan)
        count, weight, above = np.zeros(len(self.use), np.int64), left[self.context], self.prob[self.use]
        count[self.child] = n[self.gram]
        retained, hit = ~np.isnan(weight), count > 0
        self.prob = self.prob.copy()
        self.prob[self.use] = np.where(retained, np.where(hit, (count - DISCOUNT) / self.n, weight * above), above)
        here = retained & hit
        self.num[self.use[here]], self.den[self.use[here]] = count[here], self.n[here]
        self.at = np.full(len(self.at), -1, np.int32)
        self.at[self.use[self.child]] = self.gram
        self.key_of, self.n_of, self.symbols_of = self.grams, n, [*(s[self.parent] for s in self.symbols), self.last]

    def score(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each text: tokens, known tokens, base score and score."""
        x = self.block
        known = np.r_[self.counts > 0, False][x.stream]
        add = lambda v: np.add.reduceat(v, x.starts) if len(x.starts) else np.empty(0)
        return x.size + 1, add(known.astype(np.int64)), add(np.log10(self.base)), add(np.log10(self.prob))


def _walked(row: dict, size: dict, hot: list) -> Walk:
    walk = Walk(row, size)
    for level, weights in enumerate(hot):
        walk.ask()
        walk.learn([a for a in row["known"] or [] if a["level"] == level], weights)
    return walk


def _ask(size: dict, hot):
    def run(batches):
        for b in tx.each(batches):
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                walk = _walked(row, size, hot.value)
                walk.ask()
                yield walk.asked(row["block"])

    return run


def _settle(size: dict):
    """Sums the grams of a bucket, decides on its contexts, and answers each block that asked."""

    def run(table: pa.Table) -> pa.Table:
        every = {k: _small(np.concatenate([_open_numbers(v.as_py()) for v in table[k]])) for k in _KINDS}
        contexts = [_open_contexts(v.as_py()) for v in table["contexts"]]
        c = np.cumsum([0, *map(len, contexts)])
        g = np.r_[0, np.cumsum(every["sizes"], dtype=np.int64)][c]
        every["contexts"] = np.concatenate(contexts)
        del contexts
        context, first, back = np.unique(every["contexts"], return_index=True, return_inverse=True)
        n, loose = every["n"][first].astype(np.int64) >> 1, every["n"] & 1 > 0
        owner = np.repeat(np.arange(len(back)), every["sizes"])
        parent = np.repeat(back, every["sizes"])
        _, first, gram = np.unique(_longer(np.repeat(every["contexts"], every["sizes"]), every.pop("keys").astype(np.uint64)), return_index=True, return_inverse=True)
        total = np.bincount(gram, every["counts"], len(first)).astype(np.int64)
        total[total < size["least"]] = 0
        stored = np.flatnonzero(total)
        of = parent[first][stored]
        above = _ratio(every["nums"][first[stored]], every["dens"][first[stored]], size)
        sums = _retain(of, (total[stored] - DISCOUNT) / n[of], above, len(n))
        hot = n >= size["hot"]
        left = _left(n, sums)
        loose[owner[total[gram] == 0]] = True
        cold, weight = ~hot[back], left[back]
        grams, lefts = [], []
        for i in range(table.num_rows):
            mine = slice(c[i], c[i + 1])
            grams.append(_press_numbers(total[gram[g[i] : g[i + 1]]]))
            lefts.append(_press_lefts(weight[mine][cold[mine]], loose[mine][cold[mine]]))
        none = [b""] * (table.num_rows - 1)
        hot &= sums[:, 0] > 0
        found = [pa.array([x.tobytes(), *none], pa.binary()) for x in (context[hot], n[hot], sums[hot])]
        return pa.table([table["bucket"], table["block"], pa.array(grams, pa.binary()), pa.array(lefts, pa.binary()), *found], names=[c.split()[0] for c in _SETTLED.split(", ")])

    return run


def _hot_rows(batches):
    """One row a hot context and bucket: key, occurrences, sums."""
    for b in batches:
        for row in b.to_pylist():
            key, n, sums = (np.frombuffer(row[k], kind) for k, kind in (("hot_key", np.int64), ("hot_n", np.int64), ("hot_sums", np.float64)))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), *map(pa.array, sums.reshape(-1, 4).T.copy())], ["key", "n", "s0", "s1", "s2", "s3"])


def _hot_weights(settled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and weights left of the hot contexts, 1/HOT_SHARE at most; the sums of all buckets decide."""
    rows = settled.where(F.length("hot_key") > 0).select("hot_key", "hot_n", "hot_sums").mapInArrow(_hot_rows, "key long, n long, s0 double, s1 double, s2 double, s3 double")
    found = rows.groupBy("key").agg(F.first("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(4)]).collect()
    key = np.asarray([r["key"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(key)
    return key[order], _left(np.asarray([r["n"] for r in found], np.int64), np.asarray([[r[f"s{i}"] for i in range(4)] for r in found]).reshape(-1, 4))[order]


def _score(size: dict, hot):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        for b in tx.each(batches):
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                n, known, base, score = _walked(row, size, hot.value).score()
                yield pa.RecordBatch.from_arrays([pa.array(row["docs"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(len(n), size["tokens"])), pa.array(base), pa.array(score)], names)

    return run


def _with(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    return blocks.join(answers.groupBy("block").agg(F.collect_list("a").alias("known")), "block", "left")


def _placed(blocks: DataFrame, n: int) -> DataFrame:
    """Blocks written once in partitions by block that Spark knows of, so that joins with answers move the answers alone."""
    spark = blocks.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCKS))
    with setting(spark, "spark.sql.adaptive.enabled", "false"):  # an adaptive plan doesn't tell its partitioning
        return cut(blocks.repartition(parts, "block"))


def _common(blocks: DataFrame, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of words that have a large share of some block and half of it of all tokens, those of the
    most blocks first, 2 / COMMON_SHARE at most. A word that is not among them is summed in its bucket instead."""
    often = blocks.select(F.explode("common").alias("word")).groupBy("word").agg(F.count("*").alias("blocks")).orderBy(F.desc("blocks"), "word")
    words = np.sort(np.asarray([r.word for r in often.limit(int(2 / COMMON_SHARE)).collect()], np.int64).view(np.uint64))
    shared = blocks.sparkSession.sparkContext.broadcast(words)
    rows = blocks.mapInArrow(_count_common(shared), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") * 2 >= COMMON_SHARE * tokens).collect()
    key = np.asarray([r.word for r in rows], np.int64).view(np.uint64)
    order = np.argsort(key)
    return key[order], np.asarray([r.n for r in rows], np.int64)[order]


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, p_min: float = 0.0, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row; learned from rows not held out.

    p_min raises the least count of a gram to that share of all tokens, for callers that want a smaller tree.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), held_out.alias("held"))
    with setting(spark, CLEANUP, "true"):
        with spilled(texts.mapInArrow(_encode, _BLOCK)) as raw:
            size, blocks = _numbered(raw, least, p_min, hot)
        sweep(spark)
        now, answers, weights = blocks.withColumn("known", F.lit(None).cast(_KNOWN)), None, []
        for level in range(depth):
            known = spark.sparkContext.broadcast(list(weights))
            settled = cut(now.mapInArrow(_ask(size, known), _ASKED).groupBy("bucket").applyInArrow(_settle(size), _SETTLED))
            del now
            weights.append(_hot_weights(settled))
            new = settled.select("block", F.struct(F.lit(level).alias("level"), "bucket", "grams", "lefts").alias("a"))
            answers = new if answers is None else answers.unionByName(new)
            now = _with(blocks, answers)
            sweep(spark)
    return now.mapInArrow(_score(size, spark.sparkContext.broadcast(weights)), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _numbered(raw: DataFrame, least: int, p_min: float, hot: int) -> tuple[dict, DataFrame]:
    """Figures of the corpus, and the blocks with counts and numbers of their words; nothing else of raw is needed on."""
    spark = raw.sparkSession
    sums = raw.agg(F.sum("n_train").alias("tokens"), F.sum("n_words").alias("asked"), F.sum("d_train").alias("docs"), F.count("*").alias("blocks")).first()
    tokens, asked = sums.tokens or 0, sums.asked or 0
    buckets = max(8, -(-asked // BUCKET))
    least = max(least, int(np.ceil(p_min * tokens)))
    common = _common(raw, tokens)
    shared = spark.sparkContext.broadcast(common[0])
    dealt = raw.mapInArrow(_count_words(buckets, shared), _DEALT)
    with spilled(dealt.groupBy("bucket").applyInArrow(_answer_words(least, buckets, len(common[0]) + 1), _ANSWERED)) as words:
        distinct = (words.agg(F.sum("distinct")).first()[0] or 0) + int((common[1] > 0).sum())
        mine = words.groupBy("block").agg(F.collect_list(F.struct("bucket", "counts", "numbers")).alias("answers"))  # as many as the block asked for
        blocks = _placed(raw.join(mine, "block", "left").mapInArrow(_number(buckets, shared, common[1], least), _NUMBERED), sums.blocks)
    size = {"tokens": tokens, "distinct": distinct, "docs": sums.docs or 0, "least": least, "hot": max(hot, int(HOT_SHARE * tokens)), "buckets": max(8, -(-tokens // (2 * BUCKET)))}
    return size, blocks
