"""Operators 1, 3, 7, 8 and the pipeline against plain Python, with awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomline.llm import decontam, line_dedup, packing, prefilter, queries, sketch_join
from loomline.llm import text as tx
from loomline.llm.components import components

DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, key int"


def docs(spark, texts, parts=3):
    """Rows with clashing extra columns; texts: list of texts or (id, text)."""
    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1) for i, t in rows], DOC).repartition(parts)


# --- line dedup ---


def drop_lines(rows, min_chars=20, min_docs=3):
    key = lambda x: x.strip(tx.SPACE).translate({c: c + 32 for c in range(65, 91)})
    where = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars and i is not None:
                where.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(where.get(key(x), ())) < min_docs or max(where[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def dedup(df):
    marked = line_dedup.dedup_lines(df, carry=["doc_id", "text"])
    got = line_dedup.apply_keep_bitmaps(marked).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256))
    return sorted(map(tuple, got.collect()), key=repr)


def test_line_dedup(spark):
    random.seed(1)
    common = ["A line that many documents hold", "  a LINE that many documents hold\t", "short", "ÄÖÜ line that is long enough é", "one more line of twenty+"]
    rows = [(i, "\n".join(random.choices([*common, f"line of its own, number {i}", "", " "], k=random.randint(0, 7)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (5, rows[5][1]), (7, common[0] + "\r\n" + common[0]), (None, common[0]), (103, "x" * 300_000 + "\n" + common[0]), (104, "\x1f" + common[0])]
    assert dedup(docs(spark, rows)) == drop_lines(rows)


def test_line_dedup_hot_line_spans_partitions(spark):
    rows = [(i, "the one line that all documents hold\nthe second such line of them all") for i in range(400)]
    assert dedup(docs(spark, rows, 16)) == drop_lines(rows)
    assert dedup(docs(spark, rows[:2])) == drop_lines(rows[:2])
    assert dedup(docs(spark, [])) == []


def test_line_stage_takes_one_worker_a_task(spark):
    import corpus_pipeline as cp

    rows = [(i, f"the one line that all documents hold\nline of its own, number {i}\nshort") for i in range(20)] + [(30, None), (31, "")]
    df = docs(spark, rows)
    whole = line_dedup.dedup_lines(df, carry=["doc_id", "text"], apply=True)
    apart = line_dedup.apply_keep_bitmaps(line_dedup.dedup_lines(df, carry=["doc_id", "text"]))
    assert whole.columns == apart.columns and sorted(whole.collect()) == sorted(apart.collect())
    plan = cp.lines(spark, df, "")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2  # drops by key, before the shuffle, and texts: no worker feeds another


def test_line_dedup_range_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, "the one line that all documents hold" + ("\nanother line that nine of them hold" if i % 40 == 0 else "")) for i in range(360)]
        assert dedup(docs(spark, rows, 4)) == drop_lines(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@given(st.lists(st.sampled_from(["a", "b\r", "", "ccc"]), min_size=1, max_size=30), st.data())
def test_bitmaps_round_trip(lines, data):
    keep = np.asarray(data.draw(st.lists(st.booleans(), min_size=len(lines), max_size=len(lines))))
    assert line_dedup.apply_bitmap("\n".join(lines), line_dedup.keep_bitmap(keep)) == "\n".join(x for x, k in zip(lines, keep, strict=True) if k)


# --- Jaccard join ---


def groups(rows, width, num, den):
    sets = []
    for _, t in rows:
        w = tx.words(t)
        n = min(width, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def near_texts(n, seed=2):
    """Clouds of edited copies around a few texts of several lengths, so that many pairs lie just below and above."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=3))
    bases = [[word() for _ in range(k)] for k in (4, 12, 30, 70, 150, 400)]
    out = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            at = rng.randrange(len(w))
            w[at : at + rng.choice([0, 1, 1])] = [word()] * rng.choice([0, 1, 1])
            w = w or [word()]
        out.append((i, rng.choice([" ", "\n", "\t"]).join(w)))
    return out


@pytest.mark.parametrize(("width", "num", "den"), [(3, 9, 10), (5, 4, 5), (1, 1, 2)])
def test_jaccard_groups(spark, width, num, den):
    rows = near_texts(260) + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "ab" * 90_000), (12, "other text for a known id"), (None, "one"), (None, "alone without id")]
    got = sketch_join.jaccard_components(docs(spark, rows), width=width, num=num, den=den)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == groups(rows, width, num, den)


@pytest.mark.parametrize(("hubs", "few"), [(1, 0), (4, 0), (1, 10**9)])
def test_jaccard_rounds_of_a_long_bucket(spark, monkeypatch, hubs, few):
    """A cloud of one text whose copies mostly don't link the first class of their buckets: rounds, or the last step alone."""
    monkeypatch.setattr(sketch_join, "HUBS", hubs)
    monkeypatch.setattr(sketch_join, "FEW", few)
    monkeypatch.setattr(sketch_join, "CROWD", 0.0 if hubs == 1 else sketch_join.CROWD)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(160):
        w = list(base)
        for at in rng.sample(range(90), rng.choice([0, 1, 2, 3, 4, 6])):
            w[at] = f"x{rng.randrange(10**6)}"
        rows.append((i if i % 11 else None, " ".join(w)))
    got = sketch_join.jaccard_components(docs(spark, rows), width=3, num=9, den=10)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == groups(rows, 3, 9, 10)


def test_jaccard_crowd_needs_no_rounds(spark, monkeypatch):
    """A crowd is compared with another class in each bucket; what is still apart, linked or not, takes one step more."""
    rng = random.Random(11)
    base, rows = [f"w{i}" for i in range(120)], []
    for i in range(300):
        w = list(base)
        for at in rng.sample(range(120), rng.choice([0, 1, 1, 2, 3, 8, 9])):  # the last ones link with nothing
            w[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    bands, calls, inner = sketch_join.Bands(9, 10), [], sketch_join.components
    parts = docs(spark, rows).selectExpr("doc_id AS _doc", "doc_id AS _k", "text AS _text")
    leads = [r.lead for r in sketch_join._runs(parts, 3, bands).where("rank = 50").select("key", "lead").distinct().collect()]
    assert len(leads) > 10 and len(set(leads)) > len(leads) / 2
    monkeypatch.setattr(sketch_join, "components", lambda links: calls.append(1) or inner(links))
    got = sketch_join.jaccard_components(docs(spark, rows), width=3, num=9, den=10)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == groups(rows, 3, 9, 10)
    assert len(calls) == 2


def test_jaccard_of_nothing_and_of_copies(spark):
    assert sketch_join.jaccard_components(docs(spark, [])).count() == 0
    rows = [(i, "the same text of a few words " * 5) for i in range(300)]
    assert {r.component_id for r in sketch_join.jaccard_components(docs(spark, rows)).collect()} == {0}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.sampled_from([(9, 10), (4, 5), (1, 2)]))
def test_linked_sets_share_a_key_and_pass_the_bound(n, seed, ratio):
    """Whatever the sets: if they are similar enough, they meet on some key and their sketches are near enough."""
    num, den = ratio
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    extra = rng.integers(0, 2**63, n).astype(np.uint64)
    cut = rng.integers(0, max(1, n * (den - num) // den) + 1)
    b = np.unique(np.r_[rng.permutation(a)[cut:], extra[: rng.integers(0, cut + 1)]])
    both = len(np.intersect1d(a, b))
    if not len(b) or den * both < num * (len(a) + len(b) - both):
        return
    bands = sketch_join.Bands(num, den)
    keys, bits, band = [], [], []
    for s in (a, b):
        own, further = sketch_join._schemes([s], bands)
        schemes = [int(own[0])] + ([int(own[0]) + 1] if len(further) else [])
        k = sketch_join.part_keys([s] * len(schemes), np.asarray(schemes), bands)
        x = sketch_join.bit_sketches([s] * len(schemes), np.asarray(schemes), bands)
        keys.append(set(np.concatenate(k).tolist()))
        bits.append(dict(zip(schemes, x, strict=True)))
        band.append(int(own[0]))
    assert keys[0] & keys[1]
    common = max(band)
    apart = sum(bin(int(p) & (2**64 - 1)).count("1") for p in np.bitwise_xor(bits[0][common], bits[1][common]).tolist())
    assert apart <= len(a) + len(b) - 2 * both
    assert apart * (den + num) <= (len(a) + len(b)) * (den - num)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 700)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_prefilter(spark):
    df = spark.range(1000).withColumn("key", F.col("id")).union(spark.sql("SELECT -1L, CAST(NULL AS LONG)"))
    left = prefilter.without(df, "key", spark.range(0, 1000, 3).toDF("k"))
    assert {r.id for r in left.collect()} == {i for i in range(1000) if i % 3} | {-1}
    names = ["key", "maybe", "maybe_word", "maybe_bit", "maybe_bits", "gone", "__maybe", "__gone"]
    odd = spark.createDataFrame([tuple(range(i, i + 8)) for i in range(9)], names)
    left = prefilter.without(odd, "key", spark.range(0, 9, 2).toDF("k"))
    assert left.columns == names and {tuple(r) for r in left.collect()} == {tuple(range(i, i + 8)) for i in range(1, 9, 2)}


# --- decontamination ---


def test_decontamination_against_all_items(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else "".join(rng.choices("abcdefghij", k=4))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    items = [(i, f"{sentence(rng.randint(8, 40))} {sentence(rng.randint(1, 12))}") for i in range(60)] + [(60, sentence(9)), (61, ""), (62, None), (63, sentence(400) + " " + sentence(20)), (None, sentence(30)), (64, "Of.")]
    rows = []
    for i in range(150):
        parts = [sentence(rng.randint(3, 200)) for _ in range(rng.randint(1, 3))]
        if i % 3 == 0:
            t = items[rng.randrange(60)][1] if i % 9 else items[63][1]
            w = t.split(" ")
            for _ in range(rng.choice([0, 0, 1, 2, 9])):
                w[rng.randrange(len(w))] = word()
            parts.insert(rng.randint(0, len(parts)), " ".join(w).upper() if i % 2 else " ".join(w))
        rows.append((i, "\n".join(parts)))
    rows += [(500, None), (501, ""), (None, items[0][1]), (502, (sentence(30_000) + " " + items[1][1]))]
    q = decontam.question_and_answer(spark.createDataFrame(items, "item_id long, text string"))
    split = {r.item_id: (tx.words(r.question), tx.words(r.answer)) for r in q.collect() if r.item_id is not None}
    got = {(r.doc_id, r.item_id): (r.question_overlap, r.answer_overlap) for r in decontam.contaminated(docs(spark, rows), q).collect()}
    index = decontam.indexes(decontam.whole_group([(i, *p) for i, p in split.items()]))
    want = set()
    for d, t in rows:
        w = tx.words(t)
        for ix in index:
            for s in range(0, max(1, len(w)), ix.stride):
                passage = w[s : s + 2 * ix.stride]
                terms = sorted({ix.terms[x] for x in passage if x in ix.terms})
                scores = {}
                for term in terms:
                    for n, v in zip(ix.items[term], ix.impacts[term], strict=True):
                        scores[n] = scores.get(n, 0) + v
                assert sorted((n, round(v, 9)) for n, v in ix.wand(terms, decontam.THRESHOLD)) == sorted((n, round(v, 9)) for n, v in scores.items() if v >= decontam.THRESHOLD - 1e-9)
                for n, v in scores.items():
                    if v >= decontam.THRESHOLD:
                        have = {k: decontam.grams(passage, k) for k in ix.widths}
                        q_, a_ = (len([g for g in p if g in have[len(g)]]) / len(p) if p else 1.0 for p in ix.parts[n])
                        if q_ >= decontam.OVERLAP and a_ >= decontam.OVERLAP:
                            want.add((d, ix.ids[n]))
    assert set(got) == want and len(want) > 30 and (502, 1) in want and (None, 0) in want
    kept = {(r.doc_id, r.text) for r in decontam.clean(docs(spark, rows), q).collect()}
    assert kept == {r for r in rows if not any(d == r[0] for d, _ in want)}
    assert decontam.contaminated(docs(spark, []), q).count() == 0
    none = spark.createDataFrame([], "item_id long, question string, answer string")
    assert decontam.contaminated(docs(spark, rows), none).count() == 0 and decontam.clean(docs(spark, rows), none).count() == len(rows)


def test_decontamination_scores_do_not_depend_on_groups(spark, monkeypatch):
    rng = random.Random(14)
    sentence = lambda n: " ".join("".join(rng.choices("abcde", k=2)) for _ in range(n)) + "."
    items = [(i, f"{sentence(rng.randint(6, 30))} {sentence(4)}") for i in range(40)] + [(3, sentence(12)), (5, "A B")]
    rows = [(i, sentence(20) + " " + " ".join(w for w in items[i][1].split() if rng.random() < 0.93) + " " + sentence(20)) for i in range(40)]
    q = decontam.question_and_answer(spark.createDataFrame([*items, items[7]], "item_id long, text string"))
    found = lambda: sorted((r.doc_id, r.item_id, round(r.score, 12)) for r in decontam.contaminated(docs(spark, rows), q).collect())
    whole = found()
    monkeypatch.setattr(decontam, "GROUP_TOKENS", 200)
    assert found() == whole and len(whole) > 20


def test_decontamination_of_items_with_short_answers(spark):
    """Text glued to an answer's end, or another answer word, doesn't hide a whole question; an answer alone is no leak."""
    rng = random.Random(12)
    question = lambda: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(30)) + "."
    items = [(i, f"{question()} {answer}") for i, answer in enumerate(["Forty.", "Two words.", "Here are five short words."])]
    rows = [(i, f"before {t}%%%after more") for i, t in items]
    rows += [(10 + i, f"before {t.rsplit(' ', 1)[0]} otherwise.") for i, t in items]
    rows += [(20 + i, "before " + t.split(". ")[1]) for i, t in items]
    q = decontam.question_and_answer(spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.question_overlap, r.answer_overlap) for r in decontam.contaminated(docs(spark, rows), q).collect()}
    assert got == {(10 * k + i, i): (1.0, 0.0) for k in (0, 1) for i in range(3)}
    assert {r.doc_id for r in decontam.clean(docs(spark, rows), q).collect()} == {20, 21, 22}


# --- packing ---

ALPHABET = list("ab Zé ñ\n\t  '.,!?5²½٣漢字🙂​́ \x00\x1c\x85ſß’") + ["'s", "'ll", " the", "<|endoftext|>", " \n"]


def test_ids_are_those_of_the_tokenizer():
    enc, rng = packing.Encoder(queries.tokenizer_path()), random.Random(6)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(3000)] + ["".join(rng.choices("ab Z\n'.,5 é|&$~`", k=50)) for _ in range(2000)] + [None, "", "a" * 50_000]
    plain = Tokenizer.from_file(queries.tokenizer_path())
    want = [e.ids + [1] for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert enc.encode(["a <|endoftext|> b"])[0].tolist() == [64, 220, 50256, 275, 1]
    assert enc.ranked is not None and [x.tolist() for x in enc.encode(texts)] == want
    enc.ranked = None
    assert [x.tolist() for x in enc.encode(texts)] == want


def test_other_tokenizers_go_without_ranks():
    import public_tokenizers

    assert packing.ranked(public_tokenizers.path("word_bpe_49k.json")) is None


@given(st.lists(st.integers(1, 64), max_size=120))
def test_best_fit_decreasing(lengths):
    window, offset = packing.best_fit_decreasing(np.asarray(lengths, np.int64), 64)
    left: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in left if r >= n]
        if fits:
            left.remove(min(fits))
            left.append(min(fits) - n)
        else:
            left.append(64 - n)
    used = {}
    for w, o, n in sorted(zip(window.tolist(), offset.tolist(), lengths, strict=True)):
        assert o == used.get(w, 0)
        used[w] = o + n
    assert sorted(64 - u for u in used.values()) == sorted(left)


def test_packing(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "été", "of"], k=rng.choice([0, 3, 50, 700])))) for i in range(120)] + [(200, None), (201, "word " * 9000), (3, "again the same id"), (None, "no id"), (202, "<|endoftext|>" * 3 + " x")]
    pieces = packing.tokenize_pieces(docs(spark, rows), queries.tokenizer_path())
    got = packing.pack(pieces.withColumn("crc", F.crc32("ids")), bundle=40).toPandas()
    plain = Tokenizer.from_file(queries.tokenizer_path())
    ids = [np.asarray([*e.ids, 1], "<u4") for e in plain.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    assert sorted(zip(got.doc_tokens, got.crc, got.length, strict=True)) == sorted((len(x), zlib.crc32(x[s : s + 2048].tobytes()), len(x[s : s + 2048])) for x in ids for s in range(0, len(x), 2048))
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.cumsum(g.length) - g.length).all() and g.length.sum() <= 2048
    assert got[got.doc_id == 201].start.tolist().count(0) == 1 and packing.pack(packing.tokenize_pieces(docs(spark, []), queries.tokenizer_path()).drop("ids")).count() == 0


# --- pipeline ---


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(9)
    speak = {"en": ["the", "thing", "house", "with", "where", "shore"], "fr": ["été", "où", "maison", "avec", "élève", "leçon"]}
    say = lambda lang, n: " ".join(rng.choice(speak[lang]) + rng.choice(["", "", "s", "er"]) for _ in range(n))
    rows = [(i, say(lang := rng.choice(["en", "fr"]), rng.randint(30, 90)), lang) for i in range(80)]
    leak = say("en", 30) + ". " + say("en", 9) + "."
    rows += [(100, "12345 678 !!", "en"), (101, None, None), (102, rows[3][1], "en"), (103, rows[4][1] + " end", "fr"), (104, say("en", 40) + "\n" + leak + "\n" + say("en", 40), "en")]
    rows = [(i, (t if i % 4 or t is None else t + "\nThis line stands in very many documents") if i < 100 else t, lang) for i, t, lang in rows]
    df = spark.createDataFrame([(i, t, lang, "s", len(t or ""), 5) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, score int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, leak), (1, say("en", 25))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, kept = df, {}
    for name, stage in cp.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path)).cache()
        assert now.columns == df.columns
        kept[name] = {r.doc_id: r.text for r in now.collect()}
    assert set(kept["language_id"]) == {i for i, _, _ in rows} - {100, 101}
    known = [(i, t) for i, t, _ in rows if i not in (100, 101)]
    assert {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in kept["line_dedup"].items()} == {(r[0], r[3]) for r in drop_lines(known)}
    least = {d: c for d, _, c in groups(sorted(kept["line_dedup"].items()), 5, 4, 5)}
    assert set(kept["near_duplicates"]) == {d for d, c in least.items() if d == c} and 102 not in kept["near_duplicates"]
    assert set(kept["decontamination"]) == set(kept["near_duplicates"]) - {104}
    out = cp.run(spark, str(tmp_path)).toPandas()
    assert set(out.doc_id) == set(kept["decontamination"]) and (out.groupby("doc_id").length.sum() == out.groupby("doc_id").doc_tokens.first()).all()


def test_pipeline_stages_of_odd_tables(spark, tmp_path):
    """Empty tables, a very long text, clashing names, repeated and null ids, no labels at all."""
    import corpus_pipeline as cp

    names = "doc_id long, text string, lang string, source string, n_chars long, maybe string, maybe_word int, __maybe string, __gone long, rowkey long, again boolean, c0 int, _doc string, score double"
    tail = ("m", 1, "x", 5, 6, True, 7, "d", 0.5)
    table = lambda rows: spark.createDataFrame([(i, t, lang, "s", len(t or ""), *tail) for i, t, lang in rows], names)
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = table([])
    for _, stage in cp.STAGES:
        assert stage(spark, now, str(tmp_path)).count() == 0
    rng = random.Random(3)
    say = lambda n: " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(n))
    one, two, three, four = say(30), say(30), say(30), say(40)
    rows = [(1, one, None), (1, one, None), (1, two, None), (2, two, None), (None, three, None), (None, three, None), (3, four, None), (None, four, None), (4, None, None), (5, "", None), (5, "", None), (6, "12 34", None), (7, say(100_000), None)]
    docs_ = table(rows)
    assert sorted(r.doc_id or 0 for r in cp.language(spark, docs_, "").collect()) == [0, 0, 0, 1, 1, 1, 2, 3, 7]
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs_, str(tmp_path))
        assert out.columns == docs_.columns and all(tuple(r)[5:] == tail for r in out.collect()), name
    kept = sorted(((r.doc_id, r.text) for r in cp.near_duplicates(spark, docs_, "").collect()), key=repr)
    assert kept == sorted([(1, one), (1, two), (None, three), (3, four), (4, None), (5, ""), (5, ""), (6, "12 34"), (7, rows[-1][1])], key=repr)
    packed = cp.pack(spark, docs_, "").toPandas()
    assert packed[packed.start == 0].shape[0] == len(rows)
