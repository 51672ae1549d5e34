"""Licence scans, tiled collocations and block whitening against brute force."""

import os
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverloom.llm import collocations, licenses, queries, whitening

DATA = os.environ.get("TEST_LABELLED_DIR", "/root/testdata/sf0.01")
DDL = "doc_id bigint, text string, lang string, source string, score string, words string, rank string, n string, phrase string"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, s, "x", "y", "z", "n", "p") for i, t, lang, s in rows], DDL)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# licences

LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    None, "", " \n\t", "All Rights Reserved.", "CC BY-NC 4.0, cc-by; cc by cc by", "the GNU General Public License, general public license",
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nmore", "license = 'MIT'", "license: see the file", "All\x1crights\x7freserved", "allé rights reserved",
    "all rights reserved all rights", "Licence: GPL-3.0+ and (", "SPDX-License-Identifier: Foo-1.0", "x" * 50_000 + " all rights reserved " + "cc by " * 20_000, "😀 cc by 😀", "SPDX-License-Identifier:\nMIT",
]


def base_places(text):
    words = LICENSE_WORD.findall(lowered(text))
    out = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        parts = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), out


def test_license_base_columns(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "en", "a"), (None, "cc by", None, None)]
    out = licenses.digests(licenses.find_licenses(frame(spark, rows))).collect()
    assert len(out) == len(rows)
    by_id = defaultdict(list)
    for r in out:
        by_id[r.doc_id].append(r)
    for i, text, *_ in rows:
        r = by_id[i].pop()
        n, places = base_places(text)
        starts = [p for p, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({b for _, b in places}))
        labels = [x for x in r.labels.split(",") if x]
        assert labels == sorted(set(labels)) and set(x for x in r.base_labels.split(",") if x) <= set(labels) and 0 <= r.score <= 1 and (r.score > 0) == bool(labels)
    assert licenses.digests(licenses.find_licenses(frame(spark, []))).count() == 0


def test_license_query_against_brute_force(spark):
    out = {r.doc_id: r for r in queries.op11_license_scan(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(out) == len(docs)
    for d in docs:
        n, places = base_places(d.text)
        r = out[d.doc_id]
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), ",".join(sorted({b for _, b in places})))
    assert "mit" in {x for r in out.values() for x in r.labels.split(",")}


def test_all_phrases_are_found_where_they_stand():
    """Every phrase of the automaton, also inside others, against a search of each on its own."""
    phrases = {**{p: ("base", b) for p, b in licenses.BASE.items()}, **{p: ("notice", b) for p, b in licenses.NOTICES.items()}}
    assert len(phrases) == len(licenses.BASE) + len(licenses.NOTICES)
    rnd = random.Random(3)
    for _ in range(30):
        text = " ".join(rnd.choice([*phrases, "the", "cc", "by", "gnu", "license"]) for _ in range(40)).replace(" ", rnd.choice([" ", "-", ", "]))
        words = LICENSE_WORD.findall(lowered(text))
        expected = sorted((i, i + p.count(" ") + 1, *kind) for p, kind in phrases.items() for i in range(len(words)) if words[i : i + p.count(" ") + 1] == p.split())
        assert licenses.scan(text)[1] == expected


@pytest.mark.parametrize(
    ("text", "value", "shown"),
    [
        ("mit", 1, "mit"), ("gpl-2.0-only or mit", 1, "gpl-2.0-only OR mit"), ("gpl-2.0-only and mit", 3, "gpl-2.0-only AND mit"),
        ("mit or gpl-3.0+ and agpl-3.0", 1, "mit OR gpl-3.0+ AND agpl-3.0"), ("(mit or gpl-3.0) and lgpl-2.1-or-later", 2, "(mit OR gpl-3.0) AND lgpl-2.1-or-later"),
        ("gpl-2.0 with classpath-exception-2.0", 2, "gpl-2.0 WITH classpath-exception-2.0"), ("gpl-2.0 with other-thing", 3, "gpl-2.0 WITH other-thing"),
        ("gpl-2.0 with classpath-exception-2.0 or cc-by-nc-4.0", 2, "gpl-2.0 WITH classpath-exception-2.0 OR cc-by-nc-4.0"), ("mit and", 1, "mit"), ("mit license text", 1, "mit"),
        ("(mit or apache-2.0", 5, "mit OR apache-2.0"), ("((mit))", 1, "mit"), ("foo and mit", 5, "foo AND mit"), ("cc0-1.0) and gpl", 0, "cc0-1.0"), ("mit or (bsd-3-clause and (isc or zlib))", 1, "mit OR bsd-3-clause AND (isc OR zlib)"),
    ],
)
def test_expressions(text, value, shown):
    got = licenses.expression(text.encode())
    assert (licenses.CLASSES[got[0]], got[1]) == (licenses.CLASSES[value], shown)


def test_expressions_against_recursion():
    """Random expressions: the shunting-yard's value is that of a recursive evaluation of the tree they were made from."""
    rnd = random.Random(7)
    ids = ["mit", "gpl-3.0-only", "lgpl-2.1", "cc0-1.0", "cc-by-nc-4.0", "other"]

    def tree(depth):
        kind = rnd.choice(["id", "or", "and", "with"]) if depth else "id"
        if kind in ("or", "and"):
            (a, x), (b, y) = tree(depth - 1), tree(depth - 1)
            return f"({a} {kind} {b})", (min if kind == "or" else max)(x, y)
        name = rnd.choice(ids)
        value = 5 if licenses.family(name) is None else licenses.FAMILIES[licenses.family(name)]
        return (f"{name} with gcc-exception-3.1", 2 if value == 3 else value) if kind == "with" else (name, value)

    for _ in range(300):
        text, value = tree(4)
        assert licenses.expression(text.encode())[0] == value
        assert licenses.expression(licenses.expression(text.encode())[1].lower().encode())[0] == value
    for junk in ("", "and mit", ")", "() mit", "or", "(((", "*"):
        licenses.expression(junk.encode())


def test_license_scan_is_linear():
    began = time.time()
    licenses.scan("cc by general public license all rights reserved license: mit\n" * 40_000)
    assert time.time() - began < 20


# collocations


def mined(rows, top=2000, least=10):
    """Counts of contiguous words, cuts and containment, as the contract states them."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in (1, 2, 3):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        rows_of = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and 100 * c >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in counts.items() if c >= least and len(q) > len(p)):
                continue
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows_of.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def prose(seed, n=80):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(4)] + ["Été", "été", "x\x1cy", "\x85", "😀", "İ", "don't", "a-b"]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "\x0b", ","]) for _ in range(rnd.choice([0, 3, 40, 600])))
        text += " ".join(["New York City"] * rnd.randrange(4)) + rnd.choice(["", " new york", "!"])
        rows.append((i, text, rnd.choice(["en", "en", "fr", None, "und", "e n"]), "a"))
    return [*rows, rows[3], (None, rows[5][1], "fr", None), (900, None, "xx", "a"), (901, "", "en", "a"), (902, "long " * 30_000, "en", "a")]


def got(frame_):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame_.collect())


@pytest.mark.parametrize("head", [(1 << 19, 1 << 21), (12, 1 << 21), (1 << 19, 40), (6, 5), (0, 0)])
def test_collocations(spark, head):
    """With ids for all frequent words and phrases, for some, and for none, the result is the same."""
    rows = prose(1)
    expected = mined(rows)
    assert len(expected) > 30 and any(len(r[2].split(" ")) == 3 for r in expected)
    assert got(collocations.mine(frame(spark, rows), head=head)) == expected


def test_collocation_cases(spark, monkeypatch):
    assert got(collocations.mine(frame(spark, []))) == [] and got(collocations.mine(frame(spark, [(1, "too few", "en", "a")]))) == []
    rows = prose(2, 120)
    assert got(collocations.mine(frame(spark, rows), top=7)) == mined(rows, top=7)
    monkeypatch.setattr(collocations, "HELD", 50)  # read by this process alone; tasks hold as many as before
    assert got(collocations.mine(frame(spark, rows), least=25)) == mined(rows, least=25)


@pytest.mark.parametrize("dense", [0, 1 / 16, 2])
def test_stripes_are_added_up(monkeypatch, dense):
    """Sorted rows in batches that cut through stripes: the dense array and sorted coordinates give what a counter gives."""
    import pyarrow as pa

    monkeypatch.setattr(collocations, "DENSE", dense)
    monkeypatch.setattr(collocations, "GATHERED", 300)
    rnd = np.random.default_rng(5)
    codes = rnd.integers(0, 40, 4_000) << 32 | rnd.integers(0, 3, 4_000)
    words = {"en": {f"w{i}".encode(): i for i in range(40)}}

    class Shared:
        value = [collocations.Level(True, words=words)]

    batches = list(collocations._handed_on([codes[:2_000]], {})) + list(collocations._handed_on([codes[2_000:]], {}))
    rows = pa.Table.from_batches(batches).sort_by("key").to_batches(max_chunksize=170)
    out = [r for b in collocations.stripe_adder(20, Shared)(iter(rows)) for r in b.to_pylist()]
    expected = {k: v for k, v in Counter(codes.tolist()).items() if v >= 20}
    assert {(r["left"] << 32 | r["right"]): r["f"] for r in out} == expected and len(out) == len(expected)
    assert all(r["phrase"] == f"w{r['left']} w{r['right']}" and r["lang"] == "en" for r in out)


def test_scores_beyond_64_bits(spark):
    big = 900_000_000_000_000
    row = spark.createDataFrame([(big, big + 7, big + 9)], "a bigint, l bigint, r bigint").select(collocations.score("a", "l", "r")).first()[0]
    assert row == 1_000_000 * big * big // ((big + 7) * (big + 9))


# whitening


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, index string, x string, n string")


def whitened(rows, components=8):
    """(vec_id, n, deviation) by row, and numpy's whitening."""
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[k] for r in x) for k in range(d)]
    deviation = [sum((n * r[k] - sums[k]) ** 2 for k in range(d)) for r in x]
    centred = np.array(x, dtype=np.float64) - np.array(sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return n, deviation, centred @ axes[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def check_whitening(out, rows, components=8):
    n, deviation, white, explained = whitened(rows, components)
    got_ = defaultdict(dict)
    for r in out:
        got_[r.component].setdefault(r.vec_id, []).append(r)
    assert sorted(got_) == list(range(1, white.shape[1] + 1)) and len(out) == n * white.shape[1]
    for k in range(white.shape[1]):
        mine = np.array([got_[k + 1][i][0].whitened for i, _ in rows])
        assert np.abs(mine * np.sign(mine @ white[:, k]) - white[:, k]).max() < 1e-6
        assert all(abs(r.explained / explained[k] - 1) < 1e-9 for rs in got_[k + 1].values() for r in rs)
    assert [got_[1][i][0].deviation for i, _ in rows] == deviation and {r.n for r in out} == {n}
    assert max(r.identity_error for r in out) < 1e-9 and len({r.identity_error for r in out}) == 1


def test_whitening(spark):
    rnd = np.random.default_rng(1)
    mix = rnd.standard_normal((10, 10))
    rows = [(i, (rnd.standard_normal(10) @ mix).astype(np.float32).tolist()) for i in range(1_200)]
    rows[7] = (7, rows[3][1])
    bad = [(5_000, None), (5_001, []), (5_002, [1.0] * 9 + [None]), (5_003, [float("nan")] * 10), (5_004, [float("inf")] + [0.0] * 9), (5_005, [1.0] * 4)]
    out = whitening.whiten(vectors_of(spark, [(i, v, 1, "a", "b", "c") for i, v in rows + bad]).repartition(7)).collect()
    check_whitening(out, rows)
    few = whitening.whiten(vectors_of(spark, [(i, v[:3], None, "a", "b", "c") for i, v in rows[:50]])).collect()
    check_whitening(few, [(i, v[:3]) for i, v in rows[:50]])


def test_whitening_cases(spark):
    assert whitening.whiten(vectors_of(spark, [])).collect() == []
    assert whitening.whiten(vectors_of(spark, [(1, None, 1, "a", "b", "c")])).collect() == []
    one = whitening.whiten(vectors_of(spark, [(None, [1.0, 2.0], 1, "a", "b", "c")])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [(None, 1, 1, 0, None, 0.0), (None, 2, 1, 0, None, 0.0)]
    flat = whitening.whiten(vectors_of(spark, [(i, [float(i), 1.0, 2.0 * i], 1, "a", "b", "c") for i in range(9)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in flat) and max(r.identity_error for r in flat) < 1e-9
    again = whitening.whiten(vectors_of(spark, [(4, [float(i % 3), 1.0 + i], 1, "a", "b", "c") for i in range(9)])).collect()
    assert len(again) == 18 and {r.vec_id for r in again} == {4}
    with pytest.raises(Exception, match="overflow|OVERFLOW"):
        whitening.whiten(vectors_of(spark, [(i, [float(i) * 1e8], 1, "a", "b", "c") for i in range(9)])).collect()


def test_whitening_query(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.orderBy("vec_id").collect() if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    check_whitening(queries.op13_block_whitening(spark, DATA).collect(), rows)


def test_no_task_meets_all_blocks(spark, monkeypatch):
    """The scatter is multiplied in splits: with more splits the same sums."""
    rnd = np.random.default_rng(2)
    rows = spark.createDataFrame([(i, rnd.standard_normal(4).tolist()) for i in range(2_000)], "index long, v array<double>")
    matrix = whitening.block_matrix(rows, F.col("v"), 2_000, 4)
    x = np.array([r.v for r in rows.orderBy("index").collect()])
    for split in (1, 3, 16):
        monkeypatch.setattr(whitening, "SPLIT", split)
        assert np.abs(whitening.scatter(matrix) - x.T @ x).max() < 1e-9
