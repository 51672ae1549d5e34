"""Each operator against brute force, on small frames with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import os
import random
import re
import time
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from silverloom.llm import ann, bpe, common, components, host_quality, html, jaccard, mixing, quality, queries, secrets, sharding, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DATA = os.environ.get("TEST_LABELLED_DIR", "/root/testdata/sf0.01")
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, size string, key string, row_id string, taken string"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "x", "y", "z", "r", "t") for i, t, lang, s in rows], DDL)


def corpus(seed=0, n=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "and", "Été", "x\x1cy", "😀"]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(words) for _ in range(rnd.choice([3, 20, 60, 200])))
        rows.append((i, text, rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "c", "é", None])))
        if rnd.random() < 0.3:
            parts = text.split(" ")
            parts[rnd.randrange(len(parts))] = "changed"
            rows.append((1000 + i, rnd.choice([text, " ".join(parts), text.upper()]), "en", "a"))
    rows += [(2000, None, "en", "a"), (2001, "", "en", "b"), (2002, " \n\t ", "fr", "c"), (None, "no id here at all", "en", "a"), next(r for r in rows if r[0] == 5)]
    rows.append((3000, "long " * 30_000 + "end", "en", "a"))
    rows.append((3001, "nospace" * 5_000, "en", "a"))
    return rows


EMPTY = []


# sharding


@pytest.mark.parametrize("rows", [corpus(), EMPTY, [(1, "a", "en", "s")], [(i, "same", "en", "s") for i in range(9)]])
def test_sharding(spark, rows):
    out = sharding.shard_by_bytes(frame(spark, rows), 8).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    groups = defaultdict(int)
    for _, t, _, _ in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()] += len((t or "").encode()) + 1
    sizes = [groups[k] for k in sorted(groups)]

    def fits(capacity):
        shards, load = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if load + s > capacity:
                shards, load = shards + 1, 0
            load += s
        return shards <= 8

    if sizes:
        least = next(c for c in range(-(-sum(sizes) // 8), sum(sizes) + 1) if fits(c)) if sum(sizes) < 400_000 else None
        loads = Counter()
        for r in out:
            loads[r.shard] += r.size
        assert least is None or max(loads.values()) == least
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = dict((r[0], r[1]) for r in rows)
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in out)


def test_size_digest_is_exact():
    rnd = random.Random(4)
    for _ in range(30):
        n = rnd.choice([1, 5, 40])
        sizes = [rnd.choice([1, 5, 100, 3000]) for _ in range(n)]
        digest = sharding.SizeDigest([(f"{i:03d}", s, f"{i:03d}", True) for i, s in enumerate(sizes)])
        capacity, cuts = digest.cuts(4)
        best = min(max(sum(sizes[a:b]) for a, b in zip((0, *c), (*c, n), strict=True)) for c in ((i, j, k) for i in range(n + 1) for j in range(i, n + 1) for k in range(j, n + 1)))
        parts = [b - a for a, b in zip([0, *cuts], [*cuts, digest.total], strict=True)]
        assert capacity == best == max(max(parts), best) and sum(parts) == sum(sizes)


# quality


def base_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j + d for j in range(len(words) - 2) if windows[tuple(words[j : j + 3])] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_base_counts(spark):
    rows = corpus(1) + [(7000, "a b c a b c\n\nsame line\nsame line\n x \n # | <>", "en", "a"), (7001, "x x x x x", "en", "a")]
    out = quality.judge(frame(spark, rows)).collect()
    expected = Counter((i, *base_counts(t)) for i, t, _, _ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == expected
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert quality.judge(frame(spark, EMPTY)).count() == 0


def test_quality_divergence(spark):
    def jsd(p, q):
        p, q = np.array(p, float) / sum(p), np.array(q, float) / sum(q)
        m = (p + q) / 2
        kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x > 0)
        return np.sqrt(max(0, (kl(p) + kl(q)) / 2))

    rnd = random.Random(2)
    plain = [" ".join(rnd.choice(["the", "of", "and", "to", *(f"{a}{b}" for a in ("house", "river", "walk", "slow") for b in "abcdefghijklm")]) for _ in range(150)) for _ in range(150)]
    rows = [(i, t, "en", "a") for i, t in enumerate(plain)] + [(500, "A# B# " * 90 + "#### " * 60, "en", "a"), (501, " ".join(f"{w}{k}" for k in range(60) for w in ("QQ#", "ZZ%")), "en", "a")]
    out = {r.doc_id: r for r in quality.judge(frame(spark, rows)).collect()}
    assert all(out[i].kept for i in range(150)) and not out[501].kept and not out[500].kept
    words = Counter(w for _, t, _, _ in rows for w in t.lower().split())
    common = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:24]]
    hist = lambda t: [*(t.lower().split().count(w) for w in common), sum(w not in common for w in t.lower().split())]
    total = np.sum([hist(t) for _, t, _, _ in rows], axis=0)
    assert abs(out[3].word_distance - jsd(hist(plain[3]), total)) < 1e-9
    kept = quality.keep_good(frame(spark, rows + [rows[0]]))
    assert kept.columns == DDL.replace(" bigint", "").replace(" string", "").split(", ") and sorted(r.doc_id for r in kept.collect()) == sorted([*range(150), 0])


def test_short_junk_is_not_kept(spark):
    """Documents of 50 to 99 words are judged as well, and plain ones of that length stay."""
    rnd = random.Random(21)
    plain = lambda n: " ".join(rnd.choice(["the", "of", "and", "to", *(f"{a}{b}" for a in ("house", "river", "walk", "slow") for b in "abcdefghijklm")]) for _ in range(n))
    good = [(i, plain(55 + i % 45), "en", "a") for i in range(150)]
    junk = [(500 + n, " ".join(f"| {k}#" for k in range(n // 2)), "en", "a") for n in range(50, 100, 7)]
    assert sorted(r.doc_id for r in quality.keep_good(frame(spark, good + junk)).collect()) == list(range(150))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_short_documents_against_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    passed = quality.judge(docs).where("n_words < 100 and not base_failed").join(labels, "doc_id").select("doc_id", "quality").distinct().collect()
    kept = {r.doc_id for r in queries.op4_quality_rules(spark, DATA).where("kept").collect()}
    share = lambda q: np.mean([r.doc_id in kept for r in passed if r.quality == q])
    assert share(1) > 0.95 and share(0) < 0.05
    assert kept == {r.doc_id for r in quality.keep_good(docs).collect()}  # the query and the pipeline's stage give one verdict


# mixing


def test_mixing(spark):
    rows = corpus(3, 200)
    out = mixing.mix(frame(spark, rows)).collect()
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, capped, left = {}, {}, float(sum(sizes.values()))
    open_ = set(order)
    while True:  # share the rest again until none is above
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            capped[s] = 3.0 * sizes[s]
            left -= capped[s]
        open_ -= over
    target = capped | share
    taken = Counter()
    for r in out:
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source]) and r.source_size == sizes[r.source]
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 5 for s in order)
    again = mixing.mix(frame(spark, rows).repartition(3)).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in out) == Counter((r.doc_id, r.size, r.taken) for r in again)
    assert mixing.mix(frame(spark, EMPTY)).count() == 0
    assert [r.taken for r in mixing.mix(frame(spark, [(1, None, "en", None)])).collect()] == [0]


def test_schedule_prefixes_are_even(spark):
    rows = [(i, "a b c d e f g h", "en", "xyz"[i % 3]) for i in range(600)]
    sized = frame(spark, rows).select("doc_id", "source", F.lit(8).cast("long").alias("size"))
    blocked = mixing.with_blocks(mixing.source_targets(sized), 64, 1000)
    slots = mixing.schedule(blocked).orderBy("slot").collect()
    for upto in (50, 100, len(slots)):
        seen = Counter(s.idx for s in slots[:upto])
        assert all(abs(seen[i] - upto * (i + 1) / 6) < 4 for i in range(3))
    assert mixing.resample(frame(spark, rows)).count() == pytest.approx(600, rel=0.05)


# tokens

ODD_TEXTS = ["", " ", "It's Σας ΟΔΟΣ İstanbul", "a<|endoftext|>B <|startoftext|>", "\x00a\x00 b", "é" * 500 + "ab" * 1000, "日本語テキスト😀😀!!??", "x\x1cy\x85z\xa0w", "ſ K ǅ ﬁ", "1234 ½ ²", "don't we'll I'VE", "<|endoftext", "٣٤", "áé"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_equals_library(spark, library):
    rows = corpus(5) + [(9000 + i, t, "en", "a") for i, t in enumerate(ODD_TEXTS)]
    out = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_digests(frame(spark, rows), bpe.default_spec()).collect())
    expected = Counter()
    for i, t, _, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        expected[i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert out == expected
    assert bpe.encode_digests(frame(spark, EMPTY), bpe.default_spec()).count() == 0


def test_every_code_point_equals_the_library(library):
    """Letters, numbers, white space, lower case and normal form of every code point of the planes that are in use."""
    coder, all_points = bpe.coder(bpe.default_spec()), [chr(c) for c in [*range(0x34000), *range(0xE0000, 0xE0200)] if not 0xD800 <= c < 0xE000]
    letter_of = {b: c for c, b in bpe.byte_letters().items()}
    as_letters = lambda words: ["".join(letter_of[b] for b in w.encode()) for w in words]
    theirs = lambda text: [w for w, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))]
    shape = "a{0}a !{0}! 1{0} a{0}\u0334 a\u0345{0} e{0}\u0301"
    for at in range(0, len(all_points), 512):
        part = all_points[at : at + 512]
        text = "  ".join(shape.format(c) for c in part)
        if as_letters(coder.words_of(coder.normalize(text))) != theirs(text):
            raise AssertionError([hex(ord(c)) for c in part if as_letters(coder.words_of(coder.normalize(shape.format(c)))) != theirs(shape.format(c))])


def test_marks_equal_the_library(library):
    """20,000 strings of random code points with combining marks in every order."""
    coder, rnd = bpe.coder(bpe.default_spec()), random.Random(41)
    marks = [chr(c) for c in range(0x110000) if unicodedata.combining(chr(c))]
    bases = ["a", "e", "o", "\u0104", "\u1100", "\u1161", "\u11a8", "\uac00", "\u11935", "\U00011935", " ", "1", "\u0627", "\u0915", "K", "\u03a3", "/"]
    for _ in range(20):
        texts = ["".join(rnd.choice(bases) + "".join(rnd.choices(marks, k=rnd.randrange(5))) + (chr(rnd.randrange(0xE000, 0x20000)) if rnd.random() < 0.3 else "") for _ in range(6)) for _ in range(1000)]
        for text, got in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
            assert [int(i) for f in coder.encode(text) for i in f[0].split()] == got.ids, ascii(text)
            assert coder.count(text) == len(got.ids)


def test_boundaries_are_forced():
    coder = bpe.coder(bpe.default_spec())
    inside = {t[i : i + 2] for t in coder.ids for i in range(len(t) - 1)}
    for text in ("hello wörld 日本語", "qxzjv!!??;;"):
        parts = coder.fragments(text)
        assert all(a[-1:] + b[:1] not in inside for a, b in zip(parts, parts[1:], strict=False))
    long = "ab" * 300
    ids = [coder.of_byte[b] for b in long.encode()]
    assert coder.merge_short(list(ids)) == coder.merge_long(list(ids))


def test_edit_tree():
    coder, rnd = bpe.coder(bpe.default_spec()), random.Random(6)
    for _ in range(150):
        text = "".join(rnd.choice(["ab", "don't ", " ", "\n", "é", "e", "\u0301", "<|endoftext|>", "!!", "12", "word ", "x" * 50, "\x01"][: rnd.choice([13, 12])]) for _ in range(rnd.choice([0, 1, 5, 50, 200])))
        tree = token_counts.EditTree.of(text, coder)
        assert tree.n_tokens == coder.count(text) and sum(tree.leaves()[0]) == len(text)
        for _ in range(6):
            at, gone, new = rnd.randint(-1, len(text) + 3), rnd.choice([0, 1, 5, 90, 4000]), rnd.choice(["", " ", "a", "\u0301", "<|endo", "text|>", "q " * 300, "'s"])
            place = min(max(at, 0), len(text))
            text = text[:place] + new + text[place + gone :]
            tree.edit(at, gone, new)
            assert tree.text == text and tree.n_chars == len(text) and tree.n_tokens == coder.count(text)
            stored = token_counts.EditTree(text, *tree.leaves(), coder)
            assert stored.n_tokens == tree.n_tokens and stored.n_chars == len(text)


def test_edit_aware_counts(spark, library):
    rows = corpus(8)
    spec = bpe.default_spec()
    trees = token_counts.build_trees(frame(spark, rows), spec, extra=[token_counts.derived_edits().alias("edits")])
    trees = common.materialize(trees, "trees")
    out = token_counts.apply_edits(trees, F.col("edits"), spec)
    both = out.collect()
    assert len(both) == len(rows)
    texts = {i: t for i, t, _, _ in rows}
    counted = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    assert all(r.n_tokens == counted(texts[r.doc_id] or "") for r in both)
    edits = {r.doc_id: r.e for r in frame(spark, rows).select("doc_id", token_counts.derived_edits().alias("e")).collect()}
    long = 0
    for r in both:
        text = before = texts[r.doc_id] or ""
        for e in edits[r.doc_id]:
            text = text[: e.pos] + (e.ins or "") + text[e.pos + e["del"] :]
        assert (r.edited_chars, r.edited_tokens, r.edited_text) == (len(text), counted(text), text)
        if len(before.split()) > 200 and " " in before:
            # an edit re-encodes what it inserts and two leaves; a leaf is cut at the first gap after LEAF_CHARS
            longest = token_counts.LEAF_CHARS + max(len(w) for w in before.split(" ")) + 1
            assert r.chars_reencoded <= sum(len(e.ins or "") + 3 * longest for e in edits[r.doc_id])
            assert r.leaves_reencoded <= 3 and r.tokens_reencoded < r.edited_tokens / 2
            long += 1
    assert long > 5
    # a second round of edits goes on from the stored result of the first
    again = token_counts.apply_edits(common.materialize(token_counts.edited_trees(out), "trees"), F.array(F.struct(F.lit(1).alias("pos"), F.lit(2).alias("del"), F.lit("q q").alias("ins"))), spec)
    firsts = {r.doc_id: r for r in both}
    for r in again.collect():
        text = firsts[r.doc_id].edited_text
        text = text[:1] + "q q" + text[3:]
        assert r.n_tokens == firsts[r.doc_id].edited_tokens and (r.edited_text, r.edited_tokens) == (text, counted(text))
    # edits as a table; documents without any stay as they are
    table = spark.createDataFrame([(1, 2, 5, 0, "zz "), (1, 1, 0, 3, None), (5, 1, 3, 1, "é"), (None, 1, 0, 0, "n"), (77_777, 1, 0, 0, "n")], "doc_id bigint, seq int, pos bigint, del bigint, ins string")
    got = {r.doc_id: r for r in token_counts.apply_edits(token_counts.with_edit_table(trees.drop("edits"), table), F.col("edits"), spec).collect()}
    assert got[1].edited_text == (lambda t: t[:5] + "zz " + t[5:])(texts[1][3:]) and got[5].edited_text == texts[5][:3] + "é" + texts[5][4:]
    assert got[2].edited_text == texts[2] and got[2].leaves_reencoded == 0 and len(got) == len({r[0] for r in rows})
    none = token_counts.apply_edits(trees, F.lit(None), spec)
    assert all(r.n_tokens == r.edited_tokens for r in none.collect())
    assert token_counts.build_trees(frame(spark, EMPTY), spec).count() == 0


# nearest neighbours


def neighbours(spark, x, k=20, step=20, extra=()):
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)] + list(extra)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("s")).withColumn("dim", F.lit(1))
    got, share = defaultdict(list), []
    for r in sorted(ann.nearest(df, F.col("vec_id") % step == 0, k=k).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
        share.append(r.candidates / len(x))
    recall = []
    for q in range(0, len(x), step):
        s = (x * x[q]).sum(axis=1)
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -s))[:k]
        recall.append(len(set(best) & {v for v, _ in got[q]}) / k)
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0])) and len(got[q]) == k
        assert all(abs(score - s[v]) < 1e-9 for v, score in got[q])
    return got, np.mean(recall), np.mean(share)


def test_nearest(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 16)) * rng.uniform(0.5, 3, (3000, 1))
    x[100:140] = x[100]
    extra = [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] + [1.0] * 15), (5060, [float("inf")] * 16), (5080, []), (5100, [1.0, 2.0]), (5120, [2.0, 1.0]), (None, [1.0] * 16), (7, [float(v) for v in x[7]])]
    got, recall, share = neighbours(spark, x, extra=extra)
    assert set(got) == {*range(0, 3000, 20), 5100, 5120} and [v for v, _ in got[5100]] == [5120]
    assert recall >= 0.9
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<double>")
    assert ann.nearest(empty, F.col("vec_id") % 20 == 0).count() == 0


def test_clustered_vectors_need_few_candidates(spark, monkeypatch):
    """Several buckets, one of them of a hot group of equal vectors; a query meets a small part of the rows."""
    monkeypatch.setattr(ann, "BUCKET_ROWS", 512)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 64)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((100, 32))
    x = centres[rng.integers(0, 100, 4000)] + rng.standard_normal((4000, 32)) * 0.08
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[::3] = x[0]
    _, recall, share = neighbours(spark, x[1:], extra=())
    own = np.bincount(np.arange(1, 4000) % 3 == 0)[1] / 4000
    assert recall >= 0.9 and share < 0.1 + own * own


def test_trees_ascend_together_from_each_querys_longest_match():
    """Levels fall, each holds the rows of the level before, and are those that share the prefix in some tree."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 12))
    x[200:] = x[:100] + rng.standard_normal((100, 12)) * 0.05
    x[50:60] = x[50]
    norm = np.sqrt((x * x).sum(axis=1)).max()
    codes, asked = ann.hashes(x, norm), ann.hashes(x[::10], None)
    bits = lambda c: np.unpackbits(c, axis=2)
    shared = np.array([np.cumprod(bits(codes) == q, axis=2).sum(axis=2) for q in bits(asked)])  # (queries, rows, trees)
    forest = ann.Forest.planted(np.arange(300), x, norm, codes)
    again = ann.Forest.read(pd.Series({**forest.stored(), "norm": norm}))
    for trees in (forest, again):
        levels, met = defaultdict(list), defaultdict(set)
        for level, q, rows in trees.ascend(asked, np.zeros(30, dtype=np.int64)):
            assert not levels[q] or level < levels[q][-1]
            levels[q].append(level)
            assert not met[q] & set(rows.tolist())
            met[q] |= set(rows.tolist())
            assert met[q] == set(np.flatnonzero((shared[q] >= level).any(axis=1)).tolist())
        assert all(levels[q][0] == shared[q].max() and len(met[q]) == 300 for q in range(30))
    # within one level, trees hold matches of different lengths
    assert any(len(set(shared[q].max(axis=0).tolist())) > 5 for q in range(30))
    assert len({levels[q][0] for q in range(30)}) > 5


def test_ascent_stops_by_the_last_of_the_best():
    """Near neighbours stop a query at long prefixes; the level of a score is where its chance reaches the target."""
    scores, one = np.array([-np.inf, -0.5, 0.0, 0.5, 0.9, 0.999, 1.0]), np.ones(7)
    levels = ann.last_level(scores, one, 1.0)
    assert list(levels) == sorted(levels) and levels[0] == 0 and levels[-1] == ann.BITS
    for score, level in zip(scores[1:-1], levels[1:-1], strict=True):
        share = 1 - np.arccos(score) / np.pi
        chance = lambda bits: 1 - (1 - share**bits) ** ann.TREES  # noqa: B023, E731
        assert chance(level) >= ann.TARGET and (level == ann.BITS or chance(level + 1) < ann.TARGET)


def test_queries_of_a_block_ascend_together(monkeypatch):
    """Work in Python follows the levels, not the queries; every row is met that shares the level at which a query stops."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2000, 24))
    x[1000:1200] = x[:200] + rng.standard_normal((200, 24)) * 0.01
    x[1500:1600] = x[1500]
    norm, asked = np.sqrt((x * x).sum(axis=1)).max(), x[::5]
    norms = np.sqrt((asked * asked).sum(axis=1))
    codes, own = ann.hashes(x, norm), ann.hashes(asked, None)
    calls, level_of = [], ann.last_level
    monkeypatch.setattr(ann, "last_level", lambda *a: calls.append(1) or level_of(*a))
    found, bounds = ann.Forest.planted(np.arange(2000), x, norm, codes).search(np.arange(0, 2000, 5), asked, own, np.full(400, -np.inf), 10)
    assert len(calls) < 400
    found = {q: g for q, g in found.groupby("id")}
    for i, (q, bits) in enumerate(zip(range(0, 2000, 5), np.unpackbits(own, axis=2), strict=True)):
        got = found[q].sort_values(["score", "vec_id"], ascending=[False, True])
        shared = np.cumprod(np.unpackbits(codes, axis=2) == bits, axis=2).sum(axis=2).max(axis=1) if i % 40 == 0 else None
        scores = (x * x[q]).sum(axis=1)
        assert len(got) == 10 and got["score"].iloc[-1] == bounds[i] and np.array_equal(scores[got["vec_id"].astype(int)], got["score"])
        if shared is not None:
            met = np.setdiff1d(np.flatnonzero(shared >= level_of(bounds[i : i + 1], norms[i : i + 1], norm)[0]), [q])
            assert got["met"].sum() >= len(met) and set(met[np.lexsort((met, -scores[met]))][:10]) <= {*got["vec_id"]}


def join_rows(df):
    """Rows that the joins of a plan made, once it has run."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if "Join" in kind and "prefix" in node.toString().split("\n")[0]:
                rows += node.metrics().apply("numOutputRows").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows


def test_blocks_find_their_buckets_without_a_row_for_each_pair(spark, monkeypatch):
    """On independent directions every block meets every bucket; the joins make fewer rows than there are vectors, not a row for each pair and prefix."""
    monkeypatch.setattr(ann, "BUCKET_ROWS", 64)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 16)
    monkeypatch.setattr(ann, "TILE_BLOCKS", 3)
    made, sizes, write = [], defaultdict(int), ann.materialize

    def watched(df, label):
        if "tiles" in label:
            made.append(join_rows(df))
        out = write(df, label)
        sizes[label] += out.count() if "parts" in label else 0
        return out

    monkeypatch.setattr(ann, "materialize", watched)
    x = np.random.default_rng(6).standard_normal((2000, 16))
    _, recall, _ = neighbours(spark, x)
    assert recall >= 0.9 and 0 < sum(made) < len(x)
    assert sizes["parts"] / 3 <= sizes["bucket-parts"] < sizes["parts"] / 2  # a bucket's trees are sent once for three blocks


def test_tiles_are_all_that_share_a_prefix_of_the_route(spark):
    """Those that one tree finds and those that only others find; a route of no bits meets every bucket of its dimension."""
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 256, (12, ann.TREES, ann.BITS // 8), dtype=np.uint8)
    held, asked = [], []
    for i in range(300):
        codes = centres[i % 12].copy()
        other = rng.random(ann.TREES) < 0.9
        codes[other] = rng.integers(0, 256, (int(other.sum()), ann.BITS // 8), dtype=np.uint8)
        (held if i % 3 else asked).append((1 + i % 2, i // 12 % 10, codes, [48, 24, 12, 16][i // 12 % 4]))
    asked.append((1, 77, centres[0], 0))
    rows = spark.createDataFrame([(d, b, c.tobytes()) for d, b, c, _ in held], "dim int, bucket long, codes binary")
    queries = spark.createDataFrame([(d, b, c.tobytes(), r) for d, b, c, r in asked], "dim int, block long, codes binary, route int")
    prefix = lambda c, r: np.packbits(np.unpackbits(c, axis=1)[:, :r], axis=1)
    expected = {(d, b, k) for d, k, q, r in asked for e, b, c, _ in held if d == e and (r == 0 or (prefix(c, r) == prefix(q, r)).all(axis=1).any())}
    got = [tuple(t) for t in ann.meeting_tiles(rows, queries).select("dim", "bucket", "block").collect()]
    assert set(got) == expected and len(got) == len(expected)
    assert {t for t in expected if t[2] == 77} == {(d, b, 77) for d, b, _, _ in held if d == 1} and 20 < len(expected) < 180


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize(("sf", "bucket_rows"), [("sf0.01", 4096), ("sf0.1", 4096), ("sf0.1", 300)])
def test_recall_on_embeddings(spark, monkeypatch, sf, bucket_rows):
    monkeypatch.setattr(ann, "BUCKET_ROWS", bucket_rows)
    rows = spark.read.parquet(f"{os.path.dirname(DATA)}/{sf}/embeddings.parquet").where("embedding is not null").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], dtype=float)
    assert [r.vec_id for r in rows] == list(range(len(x)))
    _, recall, share = neighbours(spark, x)
    assert recall >= 0.9 and share < 0.9


# near copies


def sets(rows, n):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for _, t, _, _ in rows:
        w = WORD.findall((t or "").translate(lower))
        out.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    return out


def components_of(links, n):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components(spark, n, percent):
    rnd = random.Random(n)
    passage = " ".join(f"p{i}" for i in range(55))
    rows = corpus(9) + [(8000 + i, f"{passage} " + " ".join(f"q{rnd.randrange(300)}" for _ in range(30)), "en", "a") for i in range(30)]
    base = [f"z{i}" for i in range(120)]
    for i in range(60):
        copy = list(base)
        for _ in range(rnd.randrange(4)):
            copy[rnd.randrange(120)] = f"y{rnd.randrange(50)}"
        rows.append((8100 + i, " ".join(copy), "en", "a"))
    s = sets(rows, n)
    links = [(a, b) for a in range(len(rows)) for b in range(a) if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b])]
    root = components_of(links, len(rows))
    ids = defaultdict(list)
    for r, row in zip(root, rows, strict=True):
        ids[r].append(row[0])
    least = [min((i for i in ids[r] if i is not None), default=None) for r in root]
    out = jaccard.link_components(frame(spark, rows), n, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == Counter((row[0], len(x), c) for row, x, c in zip(rows, s, least, strict=True))
    kept = jaccard.keep_one(frame(spark, rows), n, percent)
    assert kept.columns == frame(spark, rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(min(v, key=lambda i: (i is None, i)) for v in ids.values())


def test_jaccard_edges(spark):
    assert jaccard.link_components(frame(spark, EMPTY)).count() == 0
    out = jaccard.link_components(frame(spark, [(3, "A b", "en", "a"), (2, "a  B", "en", "a"), (1, "", "en", "a"), (0, None, "en", "a")]), 3, 90).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == [(0, 0, 0), (1, 0, 1), (2, 1, 2), (3, 1, 2)]


def test_segment_keys_lose_no_link():
    rnd, words = random.Random(7), jaccard.Words()
    for percent, n in ((90, 3), (80, 5), (50, 2)):
        bands, texts = jaccard.Bands(percent), []
        for _ in range(50):
            base = [f"w{rnd.randrange(2000)}" for _ in range(rnd.choice([1, 2, 4, 9, 20, 60, 200]))]
            for _ in range(4):
                copy = list(base)
                for _ in range(int(len(copy) * rnd.choice([0, 0.01, 0.03, 0.08, 0.2]))):
                    copy[rnd.randrange(len(copy))] = f"v{rnd.randrange(500)}"
                texts.append(copy)
        hashed = [jaccard.shingle_set(" ".join(t), n, words) for t in texts]
        keys = [set(jaccard.segment_keys(h, bands).tolist()) for h in hashed]
        exact = [set(h.tolist()) for h in hashed]
        for i in range(len(texts)):
            for j in range(i):
                if 100 * len(exact[i] & exact[j]) >= percent * len(exact[i] | exact[j]):
                    assert keys[i] & keys[j]


@pytest.mark.parametrize(("sampled", "hot"), [(256, 64), (1, 3)])
def test_tiles_with_blocks(spark, monkeypatch, sampled, hot):
    """Groups and clusters of several blocks; with keys that count as hot as well."""
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 8)
    monkeypatch.setattr(jaccard, "SAMPLED", sampled)
    monkeypatch.setattr(jaccard, "HOT_IN_SAMPLE", hot)
    rnd = random.Random(11)
    base = [f"z{i}" for i in range(100)]
    rows = []
    for i in range(70):
        copy = list(base)
        for _ in range(rnd.randrange(7)):
            copy[rnd.randrange(100)] = f"y{rnd.randrange(9000)}"
        rows.append((i, " ".join(copy), "en", "a"))
    s = sets(rows, 3)
    root = components_of([(a, b) for a in range(70) for b in range(a) if 100 * len(s[a] & s[b]) >= 90 * len(s[a] | s[b])], 70)
    out = {r.doc_id: r.component_id for r in jaccard.link_components(frame(spark, rows), 3, 90).collect()}
    assert out == dict(enumerate(root))


def test_bitmaps_bound_from_above():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 1 << 12, rng.choice([1, 7, 90, 400]), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        maps = jaccard.stacked([jaccard.bitmap(a), jaccard.bitmap(b)])
        above = min(len(x) - int(np.bitwise_count(m & ~o).sum()) for x, m, o in ((a, maps[0], maps[1]), (b, maps[1], maps[0])))
        assert above >= len(np.intersect1d(a, b))


def test_a_shared_passage_makes_no_cluster(spark):
    """Documents that share half their words meet under common keys, but their bitmaps keep them out of one cluster."""
    passage = " ".join(f"p{i}" for i in range(100))
    rows = [(i, f"{passage} " + " ".join(f"d{i}x{k}" for k in range(100)), "en", "a") for i in range(40)]
    sets = jaccard.with_sets(frame(spark, rows), 5, 80, "doc_id")
    firsts = sets.drop("keys", "bits").withColumn("node", F.col("row_id"))
    assert jaccard.groups_of(sets, firsts).count() > 40 and jaccard.clusters_of(sets, firsts, 80).count() == 0


@pytest.mark.parametrize("nodes", [100_000, 4])
def test_connected_components(spark, monkeypatch, nodes):
    monkeypatch.setattr(components, "BROADCAST_NODES", nodes)
    rnd = random.Random(12)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    root = components_of(edges, 300)
    assert got == {n: root[n] for e in edges for n in e if e[0] != e[1]} | {n: 0 for n in range(41)}
    assert components.connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# secrets


def base_spans(text):
    out = []
    for m in re.finditer(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 8 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_secrets(spark):
    hexed, key = "0123456789abcdef" * 2, "AKIA" + "Q7" * 8
    texts = [
        f"é token = \"{hexed}\" x", "PassWord:abc", "passwd=abcdefgh api_key='ABCDEFGH1' APIKEY: zzzzzzzzz", f"{key} {key}Z AKIAABC", "ſecret=abcdefghij toKen=12345678", f"{hexed[:31]}g{hexed}",
        "live Zx9-aaaaBBBBccccDDDD1111 here", "shared tok Qq1111222233334444aaaa", "secret=secret=secret=aaaa", None, "", "x" * 50_000 + " token=deadbeef00",
    ]
    rows = [(i, t, "en", f"s{i % 5}") for i, t in enumerate(texts)] + [(100 + i, "shared tok Qq1111222233334444aaaa", "en", f"s{i}") for i in range(6)] + [(3, texts[3], "en", "s3")]
    out = secrets.find_secrets(frame(spark, rows)).collect()
    text_of = {i: t for i, t, _, _ in rows}
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    for r in out:
        assert [(f.start, f.kind, f.end) for f in r.found if f.kind < 3] == base_spans(text_of[r.doc_id] or "")
    found = {r.doc_id: r.found for r in out}
    assert [f.kind for f in found[6]] == [3] and found[7] == [] and found[100] == []
    assert secrets.find_secrets(frame(spark, EMPTY)).count() == 0
    clean = {r.doc_id: r for r in secrets.redact(frame(spark, rows)).collect()}
    assert clean[0].text == "é [SECRET]\" x" and clean[0].n_chars == len(clean[0].text) and clean[7].text == texts[7] and clean[9].text is None
    assert all(not base_spans(r.text or "") for r in clean.values())


def test_one_owner_may_repeat_a_secret(spark, tmp_path):
    """A token of one owner is live however many documents hold it; one that many owners hold is an example."""
    own, wide, key = "Zx9-aaaaBBBBccccDDDD1111", "Qq1111222233334444aaaa", "AKIA" + "Q7" * 8
    rows = [(i, f"foot {own} of {i}", "en", "a") for i in range(300)] + [(1000 + i, f"see {wide} or {key}", "en", f"s{i}") for i in range(4)] + [(2000, f"{key}Z", "en", "b")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in queries.op8_secret_scan(spark, str(tmp_path)).collect()}
    assert all(out[i].spans == "owned:5:29" and out[i].verdicts == "live" for i in range(300))
    assert all(out[1000 + i].spans.startswith("access:") and out[1000 + i].verdicts == "example" for i in range(4)) and out[2000].verdicts == "live"
    clean = {r.doc_id: r.text for r in secrets.redact(frame(spark, rows)).collect()}
    assert clean[7] == "foot [SECRET] of 7" and clean[1000] == f"see {wide} or [EXAMPLE-SECRET]" and clean[2000] == "[SECRET]"


def test_secret_counts_by_kind(spark, tmp_path):
    """The query counts the spans of each kind, wherever in a document's list they stand."""
    hexed, key = "0123456789abcdef" * 2, "AKIA" + "Q7" * 8
    rows = [(0, f"{hexed}g{hexed} {hexed}", "en", "a"), (1, f"token={hexed} {key} {key}", "en", "b"), (2, None, "en", "c"), (3, "passwd=abcdefgh secret=abcdefgi", "en", "d"), (4, "live Zx9-aaaaBBBBccccDDDD1111 here", "en", "e")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op8_secret_scan(spark, str(tmp_path)).collect()
    expected = {i: [(f"{secrets.KINDS[k]}:{s}:{e}", k) for s, k, e in base_spans(t or "")] for i, t, _, _ in rows}
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.n_owned) for r in out} == {i: (*(sum(k == kind for _, k in spans) for kind in range(3)), int(i == 4)) for i, spans in expected.items()}
    assert {r.doc_id: r.base_sha256 for r in out} == {i: hashlib.sha256(",".join(s for s, _ in spans).encode()).hexdigest() for i, spans in expected.items()}


def test_secret_scan_keeps_large_ids(spark, tmp_path):
    """Ids beyond 2^53 stay as they are beside a null one."""
    ids = [(1 << 53) + 1, -(1 << 62) - 1, None, (1 << 63) - 1, 7]
    frame(spark, [(i, f"token={'0123456789abcdef' * 2}", "en", "a") for i in ids]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert Counter(r.doc_id for r in queries.op8_secret_scan(spark, str(tmp_path)).collect()) == Counter(ids)


def test_ownership_against_brute_force(spark, tmp_path):
    rnd = random.Random(31)
    pool = [f"Zk{i}tokenvalue{i}abcdef" for i in range(12)] + ["ab01" * 8, "AKIA" + "R5" * 8]
    rows = []
    for i in range(150):
        chosen = rnd.choices(pool, weights=[1 + k % 5 for k in range(len(pool))], k=rnd.randrange(5))
        rows.append((rnd.randrange(120), " é ".join(["a b", *chosen]) + rnd.choice(["", " password = hunter2hunter2", " bearer: q1w2e3r4t5"]), "en", rnd.choice(["s1", "s2", "s3", "s4", None])))
    rows += [rows[0], rows[1], (5, None, "en", None), (None, f"x {pool[0]}", "en", "s9")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    holders = defaultdict(set)
    for i, t, _, s in rows:
        for _, _, _, v in secrets.scan(t or ""):
            holders[v].add((s or "", str(i if i is not None else "")))
    expected = Counter()
    for i, t, _, _ in rows:
        spans = []
        for k, s, e, v in secrets.scan(t or ""):
            owners = len({o for o, _ in holders[v]})
            if k < 3 or owners <= secrets.MAX_OWNERS:
                spans.append((f"{secrets.KINDS[k]}:{s}:{e}", str(owners), str(len(holders[v])), "live" if owners <= secrets.MAX_OWNERS else "example"))
        parts = [",".join(x) for x in zip(*spans, strict=True)] if spans else [""] * 4
        expected[(i, *parts, sum(x[3] == "live" for x in spans), sum(x[3] == "example" for x in spans))] += 1
    out = queries.op8_secret_scan(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.spans, r.owners, r.repositories, r.verdicts, r.n_live, r.n_example) for r in out) == expected
    assert {k[4] for k in expected} >= {"live", "example"}
    each = spark.createDataFrame([(v % 7, v) for v in range(400)], "value int, x int")
    counted = each.groupBy("value").agg(F.count("*").alias("n"), F.max("x").alias("top"))
    split = common.join_counted(each, counted.where("value < 6"), "value", "left", most=3)
    assert Counter((r.value, r.x, r.top) for r in split.collect()) == Counter((v % 7, v, None if v % 7 == 6 else max(x for x in range(400) if x % 7 == v % 7)) for v in range(400))


def test_secret_scan_is_linear():
    rnd = random.Random(8)
    text = " ".join("".join(rnd.choice("abcdefghijKLMN0123456789") for _ in range(20)) + rnd.choice(["", " token=abcdefgh12"]) for _ in range(40_000))
    began = time.time()
    found = secrets.scan(text)
    assert len(text) > 1_000_000 and time.time() - began < 3
    starts, ends = [x[1] for x in found], [x[2] for x in found]
    clean = secrets.redacted(text, starts, ends, ["[S]"] * len(found))
    assert time.time() - began < 5 and "token" not in clean
    base = [f for f in found if f[0] < 3]
    assert all(k < 3 or not any(s < f[2] and f[1] < e for f in base[:200]) for k, s, e, _ in found[:400])
    assert secrets.redacted("0123456789", [1, 2, 6], [5, 4, 7], ["a", "b", "c"]) == "0a5c789"


# quality classifier


def test_host_quality(spark):
    rnd = random.Random(13)
    plain = lambda k: " ".join(rnd.choice(["river", "house", "walks", "green", "slowly", "paper", f"n{rnd.randrange(300)}"]) for _ in range(k))
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, plain(60) + (" idiot moron scum " * 2 if bad else ""), rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", None])))
        if i < 300:
            labels.append((i, 1, int(bad)))
    rows += [(1000, None, "en", "a"), (1001, "", "en", "a"), (1002, rows[1][1], "en", "a"), (1003, "word " * 20_000, "en", "a")]
    tagged = spark.createDataFrame([*labels, (999_999, 1, 0), (5, None, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    out = {r.doc_id: r for r in host_quality.classify(frame(spark, rows), tagged).collect()}
    held_out = range(300, 400)
    assert np.mean([out[i].kept != (i % 4 == 0) for i in held_out]) > 0.95
    assert out[1000].kept and len(out) == len(rows)
    none = host_quality.classify(frame(spark, rows), tagged.limit(0)).collect()
    assert all(r.kept for r in none)
    assert host_quality.classify(frame(spark, EMPTY), tagged).count() == 0


def test_host_quality_against_brute_force(spark):
    """The posterior from the evidence, with a document's own probability left out of its host's and path's sums."""
    rnd = random.Random(17)
    plain = lambda k: " ".join(rnd.choice(["river", "house", "walks", "green", "slowly", "paper"]) for _ in range(k))
    rows, labels = [], []
    for i in range(240):
        bad = rnd.random() < {"a": 0.1, "b": 0.7, None: 0.4}[h := rnd.choice(["a", "a", "b", None])]
        rows.append((i, plain(40) + (" idiot scum " * 2 if bad else ""), rnd.choice(["en", "fr"]), h))
        labels.append((i, 1, int(bad)))
    rows += [(900, plain(20), "only", "single"), (901, None, "en", "a"), rows[3]]
    tagged = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = host_quality.classify(frame(spark, rows), tagged).collect()
    place = {i: (h or "", p or "") for i, _, p, h in rows}
    evidence = [(r.doc_id, r.evidence if r.doc_id != 901 else None) for r in out]
    known = [(place[i], e) for i, e in evidence if e is not None]
    mean = np.mean([e for _, e in known])
    hosts, paths = defaultdict(list), defaultdict(list)
    for (h, p), e in known:
        hosts[h].append(e)
        paths[h, p].append(e)

    def strength(groups):  # (values, parent's mean)
        n = sum(len(v) for v, _ in groups)
        between = sum(len(v) * (np.mean(v) - m) ** 2 for v, m in groups)
        within = sum(len(v) * m * (1 - m) for v, m in groups) / n
        spread = (between - len(groups) * within) / max(n - sum(len(v) ** 2 for v, _ in groups) / n, 1)
        return 10_000 if spread <= 0 else min(max(within / spread - 1, 5), 10_000)

    k = strength([(v, mean) for v in hosts.values()])
    host_mean = lambda h, minus: (sum(hosts[h]) - sum(minus) + k * mean) / (len(hosts[h]) - len(minus) + k)
    k_path = strength([(v, host_mean(h, [])) for (h, _), v in paths.items()])
    logit = lambda x: np.log(x / (1 - x))
    assert any(r.doc_id == 900 for r in out)
    for r in out:
        h, p = place[r.doc_id]
        minus = [] if r.doc_id == 901 else [r.evidence]
        of_host = host_mean(h, minus)
        of_path = (sum(paths[h, p]) - sum(minus) + k_path * of_host) / (len(paths[h, p]) - len(minus) + k_path)
        odds = logit(r.evidence) + logit(of_path) - logit(mean)
        assert np.allclose([r.host_mean, r.path_mean, r.posterior], [of_host, of_path, 1 / (1 + np.exp(-odds))], rtol=1e-6)
        if r.doc_id == 900:  # alone on its path and host: nothing but its own evidence
            assert abs(r.posterior - r.evidence) < 1e-6


def test_classifier_against_brute_force(spark):
    """Feature weights by counting on one half of the sample; the coefficients leave no gradient on the other."""
    rnd = random.Random(23)
    docs = [(i, " ".join(rnd.choice(["good", "fine", "plain", "bad", "awful"][: 5 if i % 3 == 0 else 4]) + rnd.choice(["", "!", "9"]) for _ in range(30)) + " w" * (i % 2) + "x" * 300, "en", "a") for i in range(300)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(300)]
    df = frame(spark, docs)
    weight, b = host_quality.train(df, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    half = {r.doc_id: r.h for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)).alias("h")).collect()}
    sums, seen = Counter(), defaultdict(Counter)
    for i, t, _, _ in docs:
        if half[i] == 0:
            good = int(i % 3 > 0)
            sums[good] += 1
            for f in set().union(*host_quality.features(t)):
                seen[f][good] += 1
    expected = {f: np.log((c[1] + 0.5) / (sums[1] + 1)) - np.log((c[0] + 0.5) / (sums[0] + 1)) for f, c in seen.items() if c[0] + c[1] >= host_quality.MIN_ROWS}
    assert weight.keys() == expected.keys() and all(abs(weight[f] - w) < 1e-9 for f, w in expected.items())
    x = np.array([host_quality.summaries(t, weight) for i, t, _, _ in docs if half[i] == 1])
    y = np.array([i % 3 > 0 for i, *_ in docs if half[i] == 1], dtype=float)
    p = 1 / (1 + np.exp(-x @ b))
    assert np.abs(x.T @ (y - p) - np.array([1.0] * 5 + [1e-6]) * b).max() < 1e-4


def test_shrinkage(spark):
    """Sparse groups fall back to their parents, large ones keep their own mean."""
    groups = spark.createDataFrame([("a", 900.0, 1000, 0.5), ("b", 100.0, 1000, 0.5), ("c", 1.0, 1, 0.5)], "host string, s double, n bigint, m double")
    assert host_quality.LEAST_STRENGTH <= host_quality.strength(groups, "m") < 50


# pages


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}<script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href='/a'>Menu</a></li><li><a href='/b'>More</a></li></ul></nav>{body}<footer>&copy; someone</footer></body></html>"


def test_html(spark):
    rnd = random.Random(14)
    say = lambda k: " ".join(rnd.choice(["river", "house,", "walks", "green.", "slowly", "paper"]) for _ in range(k)).capitalize()
    sources, expected = [], []
    for i in range(60):
        title, paragraphs = say(6), [say(rnd.choice([8, 30, 80])) for _ in range(rnd.choice([1, 3, 6]))]
        body = f"<!-- ad --><div class='ad'>{say(9)}</div><article><h1>{title}</h1>" + "".join(f"<p>{p} &amp; x<br>" if k % 3 == 1 else f"<p>{p} &amp; x</p>" for k, p in enumerate(paragraphs)) + "</article>"
        sources.append(page(body))
        expected.append("\n".join([title, *(f"{p} & x" for p in paragraphs)]))
    odd = [None, "", "<article><p>cut off in the mid", "<" * 500, "<article>" + "<div>" * 2000 + "deep" + "</div>" * 2000]
    rows = [(i, f"u{i}", s, "x") for i, s in enumerate([*sources, *odd, sources[0]])]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    model = html.train(df)
    out = {r.page_id: r for r in html.extract_text(df, model).collect()}
    assert [out[i].text for i in range(60)] == expected and out[65].text == expected[0]
    assert out[60].text == "" and out[61].text == "" and len(out) == len(rows)
    assert html.extract_text(df.limit(0), model).count() == 0
    unseen = page("<div class='wrap'><div class='entry'><h2>A heading</h2><p>" + say(40) + "</p><ul><li>one item of it</li></ul></div><aside class='sidebar'><p>Side</p></aside></div><section id='comments' class='comments'><div class='comment'><p>" + say(12) + "</p></div></section>")
    text = model.extract([unseen])[0]
    assert "A heading" in text and "Side" not in text and "Menu" not in text


@pytest.mark.parametrize("head", ["<header><h2>SITE NAME</h2></header>", "<header><h1>SITE NAME</h1></header>", "<header><a href='/'>SITE</a><p>what the site says of itself</p></header>", "<aside><h3>Also here</h3><ul><li><a href='/x'>One more</a></li></ul></aside>"])
@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_what_stands_before_an_article(spark, head):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    model = html.train(pages)
    sources = [r.html for r in pages.where("html is not null").limit(60).collect()]
    assert model.extract([s.replace("<article", f"{head}<article", 1) for s in sources]) == model.extract(sources)


def test_trees_are_built_in_linear_time():
    for piece in ("<div>", "<div></table>", "<p><li>", "<b class=x>x</i>", "<td><p></b>"):
        began = time.time()
        html.Tree(piece * (100_000 // piece.count("<")))
        assert time.time() - began < 8, piece


def test_a_page_states_no_label(spark):
    """What pages hold as attributes is not read as a label, neither the shown name nor the sign itself."""
    pages = [page(f"<article><h1>Head {i}</h1><p>Some text, of a kind. It goes on {i}.</p></article>") for i in range(9)]
    lying = [p.replace("<nav", f"<nav data-y='1' data-y=\"1\" {html.SIGN}=\"1\"") for p in pages]
    train = lambda sources: html.Model([(t, html.labels_of(t)) for t in map(html.Tree, html.variants(sources))])
    assert np.allclose(train(pages).pair, train(lying).pair) and train(lying).extract(lying[:1]) == train(pages).extract(pages[:1])


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<p>a<svg width='5'/>b</p><p>c</p>", "ab\nc"),
        ("<p>a<svg class=x><path d=M1/><svg><g/></svg><text>no</text></svg>b</p>", "ab"),
        ("<p>a<svg width=5/><text>no</text></svg>b</p>", "ab"),
        ("<p>a<svg><title>no</title><foreignObject><p>no</p></foreignObject></svg>b</p>", "ab"),
        ("<p>a<svg><path></p><p>b</p>", "a\nb"),
        ("<div>a<svg><path><p>b</p></div>", "a\nb"),
        ("<p>a<template><template>no</template>no<script>'</template>'</script></template>b</p>", "ab"),
        ("<p>x <math><mi>y</mi><mo>=</mo><mn>2</mn></math> z <math/>end</p>", "x y=2 z end"),
        ("<p>a <object data=f><param name=n>fallback</object> b</p>", "a fallback b"),
        ("<p>\u0130</p><SCRIPT>no</SCRIPT><p>b</p><Style>no</STYLE ><p>c</p>", "\u0130\nb\nc"),
        ("<p>a</p><script>'</scripting>' no</script><p>b</p><script>cut", "a\nb"),
        ("<p>a<svg>never ended", "a"),
    ],
)
def test_what_is_skipped_of_a_page(source, text):
    tree = html.Tree(source)
    assert tree.text([True] * len(tree.tag)) == text


def test_sum_product_is_exact():
    tree = html.Tree("<div><p>a</p><div><p>b</p></div></div>")
    model = html.Model([(t, html.labels_of(t)) for t in map(html.Tree, [page("<article><p>x y z</p></article>"), page("<article><h1>h</h1><p>q, r. s</p></article>")])])
    own = np.array([model.unary(f) for f in tree.features()])
    n = len(tree.tag)
    total = np.zeros((n, 3))
    for code in range(3**n):
        states = [code // 3**i % 3 for i in range(n)]
        weight = sum(own[i, states[i]] for i in range(n)) + sum(model.pair[states[tree.parent[i]], states[i]] for i in range(1, n))
        for i in range(n):
            total[i, states[i]] += np.exp(weight)
    assert np.allclose(model.marginals([tree])[0], total / total.sum(axis=1, keepdims=True))
