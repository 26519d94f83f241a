"""Operators 2, 4, 5, 6, 9 and 10: against plain Python, by held-out accuracy, and on awkward rows."""

import collections
import functools
import itertools
import math
import random
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.llm import langid, licenses, quality, sharding, suffix_tree, topk_search
from loomline.llm import text as tx

DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, h int"


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", 1) for i, t, lang in rows], DOC).repartition(parts)


def babble(rng, lang, n):
    parts = {"en": ["the", "th", "ing", "ou", "wh"], "de": ["der", "ung", "sch", "ü", "ei"], "fr": ["é", "eau", "que", "le", "ç"]}[lang]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)).capitalize()


# --- language ID ---


def test_language_id_held_out(spark):
    rng = random.Random(1)
    rows = [(i, babble(rng, lang := rng.choice(["en", "de", "fr"]), rng.randint(20, 200)), lang) for i in range(400)]
    rows += [(900, None, "en"), (901, "", "en"), (902, "123 !! ²½", "de"), (903, babble(rng, "fr", 20_000), None), (None, babble(rng, "en", 50), "en")]
    df = docs(spark, rows).withColumn("held_out", langid.held_out("doc_id", 4, 2))
    model = langid.train(df, ~F.col("held_out"), docs_per_lang=60)
    got = langid.identify(df, model, ["doc_id", "held_out"]).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.held_out for r in got if r.doc_id is not None} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows if i is not None}
    held = [(by[i].lang_pred, lang) for i, _, lang in rows[:400] if by[i].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by[903].lang_pred == "fr"
    assert by[None].lang_pred == "en" and not by[None].held_out


def test_language_id_without_labels(spark):
    df = docs(spark, [(1, "some text", None)])
    model = langid.train(df, F.lit(True))
    assert [tuple(r) for r in langid.identify(df, model, ["doc_id"]).collect()] == [(1, "und", 0.0)]
    assert langid.identify(docs(spark, []), model, ["doc_id"]).count() == 0


def test_tables_equal_the_network():
    """The folded lookups give what the convolution gives."""
    rng = np.random.default_rng(3)
    net = langid.Network(["a", "b", "c"], rng)
    x = rng.integers(0, 64, (7, langid.WINDOW)).astype(np.uint8)
    pooled = []
    for w in langid.WIDTHS:
        e = net.p["embed"][x]
        cols = np.concatenate([e[:, i : i + langid.POSITIONS] for i in range(w)], axis=2)
        pooled.append((cols @ net.p[f"w{w}"]).max(axis=1))
    want = np.maximum(np.concatenate(pooled, axis=1) + net.p["bias"], 0) @ net.p["out"] + net.p["end"]
    assert np.allclose(net.tables().logits(x), want, atol=1e-4)


def test_network_gradient():
    rng = np.random.default_rng(4)
    net = langid.Network(["a", "b"], rng)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    x, y = rng.integers(0, 64, (5, langid.WINDOW)), rng.integers(0, 2, 5)

    def loss():
        pooled = []
        for w in langid.WIDTHS:
            e = net.p["embed"][x]
            pooled.append((np.concatenate([e[:, i : i + langid.POSITIONS] for i in range(w)], axis=2) @ net.p[f"w{w}"]).max(axis=1))
        z = np.maximum(np.concatenate(pooled, axis=1) + net.p["bias"], 0) @ net.p["out"] + net.p["end"]
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(5), y]))

    grad = net._gradient(x, y)
    for k, g in grad.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep = net.p[k][at]
        net.p[k][at] = keep + 1e-6
        up = loss()
        net.p[k][at] = keep - 1e-6
        down = loss()
        net.p[k][at] = keep
        assert g[at] == pytest.approx((up - down) / 2e-6, rel=1e-3)


# --- suffix tree ---


def test_suffix_tree_scoring(spark):
    rng = random.Random(5)
    phrases = [["we", "go", "to", "the", "shop"], ["the", "cat", "sat"], ["of", "the", "people"]]
    rows = [(i, " ".join(w for _ in range(rng.randint(0, 12)) for w in rng.choice(phrases) + rng.choices("abcdefgh", k=2)), "en") for i in range(300)]
    rows += [(900, None, "en"), (901, "  ", "en"), (902, "Zzz THE " * 3000, "en"), (5, "the cat sat", "en"), (None, "the cat", "en")]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    got = suffix_tree.score_documents(docs(spark, rows), langid.held_out("doc_id", 7, 2), p_min=1e-4).collect()
    count = collections.Counter(w for i, t, _ in rows if not held(i) for w in [*tx.words(t), None])
    n, v = sum(count.values()), len(count)
    want = []
    for i, t, _ in rows:
        w = [*tx.words(t), None]
        want.append((i, held(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)))
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.75 * sum(r.base_score for r in out) and all(r.score < 0 for r in got)


def test_suffix_tree_probabilities_sum_to_one():
    """In every state the probabilities of all words, the end and one unknown word sum to one."""
    rng = np.random.default_rng(6)
    texts = [rng.choice(6, p=[0.4, 0.3, 0.1, 0.1, 0.05, 0.05], size=30) for _ in range(60)]
    names = [f"w{i}".encode() for i in range(6)]
    words = np.sort(np.r_[tx.hashes(names), suffix_tree._END])
    place = {int(h): i for i, h in enumerate(words)}
    sym = [place[int(h)] for h in tx.hashes(names)]
    end, mark = place[int(suffix_tree._END)], len(words)
    seqs = []
    for t in texts:
        s = [mark]
        for x in t:
            s.append(sym[(x + (s[-1] == sym[0])) % 6])  # the next word depends on the one before
        seqs.append([*s, end])
    uni = collections.Counter(x for s in seqs for x in s[1:])
    tokens = sum(uni.values())
    tree = suffix_tree.Tree(words, np.asarray([uni[i] for i in range(len(words))]), tokens, len(words), len(seqs))
    known = {(x,): i for i, x in enumerate(range(len(words)))} | {(mark,): mark}
    for d in (2, 3, 4):
        grams = collections.Counter(tuple(s[i : i + d]) for s in seqs for i in range(len(s) - d + 1))
        keep = {g: c for g, c in grams.items() if c >= 3 and g[:-1] in known and (g[1:] in known)}
        keys = np.asarray([known[g[:-1]] * tree.base + g[-1] for g in keep], np.int64)
        tree.add(keys, np.asarray(list(keep.values())))
        known |= {g: int(np.searchsorted(tree.grams[-1], k)) for g, k in zip(keep, keys, strict=True)}
    tree.grow()
    assert any(k.any() for k in tree.kept[1:])

    class One(suffix_tree.Block):
        def __init__(self, stream):
            self.stream = np.asarray(stream)
            self.size, self.starts = np.asarray([len(stream) - 2]), np.asarray([0])

    counts, names = np.asarray([uni[i] for i in range(len(words))] + [0]), np.r_[words, np.uint64(12345)]
    for context in ([], [sym[0]], [sym[0], sym[1]], [sym[3], sym[0], sym[1], sym[0]], [sym[5], sym[5]], [len(words)]):
        total, prefix = 0.0, tree.score(One([-1, *context]), names, counts)[3][0] if context else 0.0
        for x in range(len(words) + 1):
            total += 10 ** (tree.score(One([-1, *context, x]), names, counts)[3][0] - prefix)
        assert total == pytest.approx(1, abs=1e-9)


def small_tree(learned, least):
    """The tree of some word lists, counted in plain Python."""
    end = int(suffix_tree._END)
    texts = [[int(h) for h in tx.hashes(t)] + [end] for t in learned]
    uni = collections.Counter(x for t in texts for x in t)
    words = np.sort(np.asarray([w for w, c in uni.items() if c >= least], np.uint64))
    tree = suffix_tree.Tree(words, np.asarray([uni[int(w)] for w in words]), sum(uni.values()), len(uni), len(texts))
    seqs = [[tree.mark, *(int(x) for x in suffix_tree._find(words, np.asarray(t, np.uint64)))] for t in texts]
    known = {(i,): i for i in range(len(words) + 1)}
    for d in (2, 3, 4):
        grams = collections.Counter(tuple(s[i : i + d]) for s in seqs for i in range(len(s) - d + 1))
        keep = {g: c for g, c in grams.items() if c >= least and g[:-1] in known and g[1:] in known}
        keys = np.asarray([known[g[:-1]] * tree.base + g[-1] for g in keep], np.int64)
        tree.add(keys, np.asarray(list(keep.values())))
        known |= {g: int(np.searchsorted(tree.grams[-1], k)) for g, k in zip(keep, keys, strict=True)}
    tree.grow()
    return tree, uni


def plain_model(learned, least=2, depth=3):
    """P(context, symbol) by recursion over counts in dictionaries; ^ opens a text, None ends it."""
    count = collections.Counter()
    for t in learned:
        s = ["^", *t, None]
        count.update(tuple(s[i : i + d]) for d in range(1, depth + 2) for i in range(len(s) - d + 1))
    uni = {g[0]: c for g, c in count.items() if len(g) == 1 and g != ("^",)}
    total = sum(uni.values()) + len(uni) + 1

    @functools.cache
    def stored(gram):
        return gram == ("^",) or count[gram] >= least and "^" not in gram[1:] and (len(gram) == 1 or stored(gram[:-1]) and stored(gram[1:]))

    follows = collections.defaultdict(list)
    for g in count:
        if len(g) > 1 and stored(g):
            follows[g[:-1]].append(g[-1])

    @functools.cache
    def left(context):
        """The weight of what is left beside the stored symbols, or None if the context is not retained."""
        if not follows[context]:
            return None
        n = count[context]
        own = [(count[*context, x] - 0.5) / n for x in follows[context]]
        above = [prob(context[1:], x) for x in follows[context]]
        rest, rest_above = 1 - sum(own), max(1 - sum(above), 1e-12)
        if rest <= 1e-9:
            return None
        gain = sum(a * math.log(a / b) for a, b in zip(own, above, strict=True)) + rest * math.log(rest / rest_above)
        return rest / rest_above if n * gain >= len(own) * math.log(max(n, 2)) / 2 else None

    def prob(context, x):
        if not context:
            return (uni.get(x, 0) + 1) / total
        weight = left(context)
        if weight is None:
            return prob(context[1:], x)
        return (count[*context, x] - 0.5) / count[context] if x in follows[context] else weight * prob(context[1:], x)

    return prob


@functools.cache
def _plain(learned):
    return plain_model(learned)


def plain_score(text, learned, depth=3):
    prob, s = _plain(tuple(map(tuple, learned))), ["^", *text, None]
    return sum(math.log10(prob(tuple(s[max(0, i - depth) : i]), s[i])) for i in range(1, len(s)))


@pytest.mark.parametrize("hot", [suffix_tree.HOT, 40])
def test_dealt_suffix_tree_is_the_tree_in_one_place(spark, hot):
    rng = random.Random(15)
    phrases = [["we", "go", "to", "the", "shop"], ["the", "cat", "sat"], ["of", "the", "people"], ["a", "b", "a", "b"]]
    rows = [(i, " ".join(w for _ in range(rng.randint(0, 12)) for w in rng.choice(phrases) + rng.choices("abcdefgh", k=2) + [f"r{rng.randint(0, 400)}"]), "en") for i in range(250)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    tree, uni = small_tree([tx.words(t) for i, t, _ in rows if not held(i)], 2)
    assert all(k.any() for k in tree.kept)
    got = {r.doc_id: r.score for r in suffix_tree.score_documents(docs(spark, rows), langid.held_out("doc_id", 7, 2), hot=hot).collect()}

    class One(suffix_tree.Block):
        def __init__(self, text):
            h = tx.hashes(text)
            self.words = np.r_[np.unique(h), suffix_tree._END]
            self.stream = np.r_[-1, np.searchsorted(self.words[:-1], h), len(self.words) - 1].astype(np.int64)
            self.size, self.starts = np.asarray([len(text)]), np.asarray([0])

    for i, t, _ in rows:
        block = One(tx.words(t))
        assert got[i] == pytest.approx(tree.score(block, block.words, np.asarray([uni[int(w)] for w in block.words]))[3][0], abs=1e-9)
        assert got[i] == pytest.approx(plain_score(tx.words(t), [tx.words(t) for i, t, _ in rows if not held(i)]), abs=1e-9)


def test_suffix_tree_keeps_rare_grams_of_a_large_corpus(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    learned = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = [(i, "zzz " * 150_000, "en") for i in learned[:20]] + [(i, "one rare old phrase", "en") for i in learned[20:22]]
    (r,) = [r for r in suffix_tree.score_documents(docs(spark, [*rows, (held, "one rare old phrase", "en")]), langid.held_out("doc_id", 7, 2)).collect() if r.held_out]
    assert r.train_tokens > 3_000_000 and r.score > r.base_score + 10


def test_suffix_tree_without_training(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = suffix_tree.score_documents(docs(spark, [(held, "a b", "en")]), langid.held_out("doc_id", 7, 2)).collect()
    assert [tuple(r) for r in got] == [(held, True, 3, 0, 0, 0.0, 0.0)]
    assert suffix_tree.score_documents(docs(spark, []), langid.held_out("doc_id", 7, 2)).count() == 0


# --- sharding ---


def shards(rows, limit):
    import hashlib

    h = [int(hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:15], 16) for i, _, _ in rows]
    n = [len((t or "").encode()) for _, t, _ in rows]
    out = []
    for x, (i, _, _), size in zip(h, rows, n, strict=True):
        for d in range(61):
            total = sum(b for y, b in zip(h, n, strict=True) if y >> (60 - d) == x >> (60 - d))
            if total <= limit or d == 60:
                out.append((i, size, d, x >> (60 - d), total))
                break
    return out


def test_sharding(spark):
    rng = random.Random(7)
    rows = [(i, "é" * rng.randint(0, 400), "en") for i in range(200)] + [(900, None, "en"), (901, "x" * 5000, "en")]
    got = sharding.shard(docs(spark, rows), limit=2000).collect()
    assert sorted((r.doc_id, r.n_bytes, r.depth, r.prefix, r.shard_bytes) for r in got) == sorted(shards(rows, 2000))
    assert [r.doc_id for r in got if r.oversize] == [901] and all(r.page == (1 if r.doc_id == 901 else 0) for r in got)
    assert sharding.shard(docs(spark, [])).count() == 0


def test_sharding_of_one_id(spark):
    """A third of all rows share an id: their shard is cut into pages."""
    rows = [(7, "x" * 90, "en")] * 100 + [(7, "y" * 900, "en")] * 3 + [(i, "z" * 50, "en") for i in range(200)]
    got = sharding.shard(docs(spark, rows, 5), limit=1000).collect()
    assert len(got) == len(rows) and not any(r.oversize for r in got)
    sums = collections.Counter()
    for r in got:
        sums[r.depth, r.prefix, r.page] += r.n_bytes
    assert max(sums.values()) <= 1000 and all(sums[r.depth, r.prefix, r.page] == r.shard_bytes for r in got)


# --- licences ---


def test_license_scan(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    bsd = "Copyright (c) 2020, Some One\n\n" + dict(licenses.TEMPLATES[::-1])["BSD-3-Clause"]
    files = [
        (0, "a/LICENSE", "The MIT notice\nReleased under the MIT License.\nmore words that are not a notice at all here"), (1, "a/b/c.txt", "text"), (2, "a/b/d.txt", f"\n{apache}\nwords"), (3, "a/b/x/y.txt", None), (4, "z/q.txt", "nothing mit in"),
        (5, None, ""), (6, "a/e.txt", f"some words\n{apache}\nwords"), (7, "top.txt", "x\nlicensed UNDER cc by-nc 4.0"), (8, "b/k.txt", "none"), (8, "b/k.txt", "none"), (9, "a/big.txt", "word " * 60_000),
        (10, "b/deep/down/COPYING", textwrap.fill(bsd, 60, replace_whitespace=False)), (11, "b/deep/down/er/f.c", "int x;"), (12, "b/deep/g.c", "int y;"), (13, "b/deep/down/LICENSE.md", "Released under the ISC License."),
        (14, "c.c", "/*\n" + "\n".join(" * " + x for x in textwrap.wrap(licenses.TEMPLATES[0][1].split("\n\n")[0], 50)) + "\n */\nint main;"),
    ]
    df = spark.createDataFrame([(i, p, t, 1, "c") for i, p, t in files], "id long, path string, text string, score int, dir string")
    got = sorted((r.id, r.license, r.origin, r.declared_by) for r in licenses.scan_licenses(df, "id", "path").collect())
    assert got == [
        (0, "MIT", "own", 0), (1, "MIT", "inherited", 0), (2, "Apache-2.0", "own", 2), (3, "MIT", "inherited", 0), (4, None, "none", None), (5, None, "none", None),
        (6, "Apache-2.0", "own", 6), (7, "CC-BY-NC-4.0", "own", 7), (8, None, "none", None), (8, None, "none", None), (9, "MIT", "inherited", 0),
        (10, "BSD-3-Clause", "own", 10), (11, "ISC", "inherited", 13), (12, None, "none", None), (13, "ISC", "own", 13), (14, "Apache-2.0", "own", 14),
    ]
    assert licenses.scan_licenses(df.limit(0), "id", "path").count() == 0


def plain_match(text, pieces, threshold):
    """Cosines of a text with all pieces, by dictionaries."""
    bags = [collections.Counter(licenses._words(t)) for _, t in pieces]
    idf = {w: math.log((1 + len(bags)) / (1 + sum(w in b for b in bags))) + 1 for b in bags for w in b}
    vector = lambda bag: {w: (1 + math.log(n)) * idf.get(w, math.log(1 + len(bags)) + 1) for w, n in bag.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    mine = vector(collections.Counter(licenses._words(text)))
    scores = [(-sum(x * v.get(w, 0) for w, x in mine.items()) / (norm(mine) * norm(v)), n) for (n, _), v in zip(pieces, map(vector, bags), strict=True)] if mine else []
    return min(((round(s, 9), n) for s, n in scores if -s >= threshold), default=None)


def test_license_scan_against_all_templates(spark):
    """Every line, paragraph and licence file against every template, and directories walked up one by one."""
    rng = random.Random(13)
    units = [t for _, t in licenses.pieces(licenses.TEMPLATES)]
    vocabulary = sorted({w for t in units for w in licenses._words(t)}) + ["other", "mitten", "house"]
    names = ["LICENSE", "COPYING.txt", "a.py", "b.c", "notes.md"]
    files = []
    for i in range(160):
        parts = []
        for _ in range(rng.randint(0, 4)):
            words = rng.choice(units).split() if rng.random() < 0.5 else rng.choices(vocabulary, k=rng.randint(1, 12))
            words = [w for w in words if rng.random() < 0.95]
            lead = rng.choice(["", "", "# ", "// ", " * "])
            parts.append("\n".join(lead + x for x in textwrap.wrap(" ".join(words), rng.choice([40, 10_000]))))
        files.append((i, "/".join(rng.choices("pqr", k=rng.randint(0, 3)) + [rng.choice(names)]), rng.choice(["\n", "\n\n"]).join(parts)))
    pieces, own = licenses.pieces(licenses.TEMPLATES), {}
    for i, path, text in files:
        lines = text.split("\n")
        whole = plain_match(licenses.joined(lines), pieces, licenses.THRESHOLD) if path.split("/")[-1] in names[:2] else None
        blocks = [list(b) for blank, b in itertools.groupby(lines, key=lambda x: not licenses._MARKS.sub("", x)) if not blank]
        found = [m for x in lines + [licenses.joined(b) for b in blocks] if (m := plain_match(x, pieces, licenses.THRESHOLD))]
        own[i] = whole or min(found, default=None)
    want = []
    for i, path, _ in files:
        best, parts = None, path.split("/")[:-1]
        for n in range(len(parts), -1, -1):
            here = [(own[k][0], k) for k, p, _ in files if p.split("/")[:-1] == parts[:n] and p.split("/")[-1] in names[:2] and own[k]]
            if here:
                best = min(here)[1]
                break
        want.append((i, own[i][1] if own[i] else own[best][1] if best is not None else None, round(-own[i][0], 6) if own[i] else 0.0, i if own[i] else best))
    df = spark.createDataFrame(files, "id long, path string, text string").repartition(5)
    got = sorted((r.id, r.license, round(r.score, 6), r.declared_by) for r in licenses.scan_licenses(df, "id", "path").collect())
    assert [(g[0], g[2], g[3]) for g in got] == [(w[0], w[2], w[3]) for w in want]
    assert got == want and len({w[1] for w in want}) > 6 and any(w[3] not in (None, w[0]) for w in want)


def test_license_lines_found_by_words_are_all_there_are():
    """Lines without an anchor of a template can't reach the threshold: the automaton misses nothing."""
    m, rng = licenses.Matcher(), random.Random(8)
    vocabulary = sorted(m.idf) + ["other", "word", "mitten"]
    for _ in range(3000):
        line = " ".join(rng.choices(vocabulary, k=rng.randint(1, 9)))
        best = m.match(line)
        assert (m.scan(line, False)[0] is not None) == (best is not None)
    for name, text in licenses.TEMPLATES:
        assert m.scan(text, True)[0] == name


# --- top-k ---


def nearest(rows, k):
    ok = [(i, [math.floor(float(x) * 1024) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(ok):
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, v, strict=True)), i) for n, (i, v) in enumerate(ok) if n != at and len(v) == len(a))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_exact_topk(spark):
    rng = np.random.default_rng(9)
    f = lambda x: [float(np.float32(y)) for y in x]
    rows = [(i, f(rng.normal(size=40) * (1 + i % 5))) for i in range(700)] + [(1000 + i, f(np.ones(40))) for i in range(15)]
    rows += [(2000, None), (2001, [1.0, None] * 20), (2002, f([np.nan] * 40)), (2003, f([np.inf] * 40)), (None, f(np.ones(40))), (2100, f(np.ones(3))), (2101, f(np.ones(3))), (2200, []), (100, f(np.ones(40))), (2300, f(np.zeros(40))), (200, None), (300, [None] * 40)]
    rows += [rows[500]] * 3 + [(2500, [])]  # rows alike, and another id
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, label int, score double").repartition(5)
    got = topk_search.exact_topk(df, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == nearest(rows, 10)
    blocks = topk_search.exact_topk(df, F.col("vec_id") % 100 == 0, query_block=3)
    assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, got.collect()))
    assert topk_search.exact_topk(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_exact_topk_of_huge_components(spark):
    rows = [(100, [1e30, -1e30]), (1, [1e30, 1e30]), (2, [-1e30, 3e30]), (3, [2e30, 0.0]), (4, [1.7e306, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.exact_topk(df, F.col("vec_id") % 100 == 0).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [3, 1, 2]


# --- quality ---


def test_cotraining_held_out(spark):
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(500):
        bad = rng.random() < 0.3
        text = " ".join(rng.choice(["###", "spam", "$$$"]) for _ in range(40)) if bad and i % 2 else ("SAME " * 40 if bad else babble(rng, "en", 60))
        rows.append((i, text, "en", "bad" if bad and rng.random() < 0.8 else "good", len(text)))
        labels.append((i, int(not bad)))
    rows += [(900, None, None, None, None), (901, "", "en", "good", 0), (902, "word " * 50_000, "en", "good", -5), (None, "text", "en", "good", 4), (3, "again", "en", "good", 5)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score int")
    known = spark.createDataFrame([*labels[:200], (900, 5), (None, 1)], "doc_id long, quality int")
    got = quality.score_quality(df, known).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    by = {r.doc_id: r.quality for r in got}
    assert np.mean([by[i] == q for i, q in labels[200:] if i != 3]) > 0.95


def test_cotraining_equals_a_plain_one_over_all_rows(spark):
    """The rounds over partitions pick the rows that one pass over all of them would."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(900):
        bad = rng.random() < 0.4
        text = " ".join(rng.choice(["buy", "now", "$$$", "the"] if bad else ["the", "house", "we", "saw", "now"]) for _ in range(rng.randint(1, 60)))
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice("xyz") if rng.random() < 0.3 else ("x" if bad else "y"), len(text)))
        labels.append((i, int(not bad)))
    rows += rows[500:520] + [(None, "the house", "en", "y", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    known = spark.createDataFrame(labels[:150], "doc_id long, quality int")
    got = sorted((r.doc_id, round(r.text_score, 9), round(r.meta_score, 9), round(r.score, 9)) for r in quality.score_quality(df, known).collect() if r.doc_id is not None)
    spot = [(r.doc_id, r.key, r.h) for r in df.select("doc_id", F.xxhash64("doc_id", "text", "lang", "source", "n_chars").alias("key"), F.xxhash64("doc_id").alias("h"), "text").collect()]
    at = {r: (k, h) for r, k, h in spot}
    features = lambda some: quality.pack(quality.text_features([r[1] for r in some]), quality.meta_places(*([r[c] for r in some] for c in (2, 3, 4))))
    marked = sorted(rows[:150], key=lambda r: at[r[0]][1])
    free = [r for r in rows if r[0] is not None and r[0] >= 150]
    packed, keys, rounds = features(free), np.asarray([at[r[0]][0] for r in free]), []

    def pick(models, taken, share):
        out = []
        for teacher, (model, view) in enumerate(zip(models, quality.unpack(packed), strict=True)):
            out += [(teacher, label, int(keys[i]), packed[i]) for label, found in quality.surest(model(view), keys, share, taken[1 - teacher]) for i in found]
        rounds.append(len(out))
        return out

    model = quality.CoTrained(quality.unpack(features(marked)), np.asarray([float(labels[r[0]][1]) for r in marked]), pick)
    scores = model.score(*quality.unpack(features(rows)))
    assert got == sorted((r[0], *(round(float(s[i]), 9) for s in scores)) for i, r in enumerate(rows) if r[0] is not None)
    assert len(rounds) > 1 and rounds[0] > 100


def test_cotraining_without_labels(spark):
    df = spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.score_quality(df, labels).collect()] == [0.5]
    assert [r.score for r in quality.score_quality(df, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).collect()] == [1.0]
    assert quality.score_quality(df.limit(0), labels).count() == 0
