"""The corpus pipeline: its stages in order, each held against brute force on what the one before has left."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from silverloom.llm import ann, bpe, jaccard, mixing, quality, secrets
from tests.llm.test_operators import base_spans, components_of, sets

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(n=120):
    rnd = random.Random(5)
    words = ["the", "of", "and", "to", *(f"{a}{b}" for a in ("house", "river", "walk", "slow") for b in "abcdefghijklm")]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(words) for _ in range(rnd.choice([20, 60, 120])))
        if i % 7 == 0:
            text += f" password = hunter{i:02d}xyz9"
        rows.append((i, text, "en", rnd.choice("abc")))
        if i % 5 == 0:
            rows.append((1000 + i, text, "en", "b"))
        if i % 9 == 0:
            rows.append((2000 + i, text + " changed", "en", "c"))
    rows += [(3000, "| # $ " * 60, "en", "a"), (3001, None, None, None), (3002, "", "en", None), (None, rows[1][1] + " and more of it", None, None), rows[2]]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def test_stages_in_order(spark, tmp_path):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "secrets", "mixture", "tokens"]
    docs = spark.createDataFrame(documents(), DDL)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frames = [[tuple(r) for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == DDL.replace(" bigint", "").replace(" string", "").split(", "), name
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        frames.append([tuple(r) for r in docs.collect()])
    source, good, single, clean, mixed = frames
    enough = [r for r in source if len((r[1] or "").split()) >= 50 and "|" not in r[1]]
    assert Counter(good) == Counter(enough)
    found = sets([r[:4] for r in good], 5)
    links = [(a, b) for a in range(len(good)) for b in range(a) if 100 * len(found[a] & found[b]) >= 80 * len(found[a] | found[b])]
    groups = defaultdict(list)
    for root, row in zip(components_of(links, len(good)), good, strict=True):
        groups[root].append(row[0])
    assert Counter(r[0] for r in single) == Counter(min(g, key=lambda i: (i is None, i)) for g in groups.values())
    text_of = {r[0]: r[1] for r in single}
    assert Counter(r[0] for r in clean) == Counter(r[0] for r in single)
    for i, text, *_, n in clean:
        assert not base_spans(text) and n == len(text) and ("[SECRET]" in text) == bool(base_spans(text_of[i]))
    assert {r[0] for r in mixed} <= {r[0] for r in clean} and max(Counter(r[0] for r in mixed).values()) <= 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = Counter()
    for i, text, *_ in mixed:
        ids = library.encode(text, add_special_tokens=False).ids
        expected[i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()) == expected


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], DDL)
    for step in (quality.keep_good, jaccard.keep_one, secrets.redact, mixing.resample):
        out = step(empty)
        assert out.columns == empty.columns and out.count() == 0
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_mixture_of_nulls_and_repeated_rows(spark):
    rows = [(i, "a b c d", "en", "s") for i in range(40)] + [(1, "a b c d", "en", "s")] * 2 + [(50, None, "en", "s"), (51, "", None, None), (None, "e f", None, None), (52, "e f", "en", None)]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DDL)
    out = mixing.resample(docs)
    assert out.columns == docs.columns
    got = Counter(r.doc_id for r in out.collect())
    assert 50 not in got and 51 not in got and sum(got.values()) > 35
    assert got == Counter(r.doc_id for r in mixing.resample(docs.repartition(3)).collect())


def test_one_of_repeated_rows_is_always_the_same(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(7, text, lang, s, n) for lang in ("de", "en", None) for s in ("x", "y", None) for n in (1, 2)], DDL)
    kept = [tuple(jaccard.keep_one(docs.repartition(n)).collect()) for n in (1, 3)]
    assert len(kept[0]) == 1 and kept[0] == kept[1]


@pytest.mark.parametrize("k", [3, 20])
def test_neighbours_at_the_edges(spark, k):
    """Ties at the last place go to the smaller ids; fewer candidates than k are all returned."""
    rows = [(i, [1.0, float(i // 4)]) for i in range(12)]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 0, k=k).orderBy("rank").collect()
    expected = sorted(((-(1.0 + 0.0 * (i // 4)), i) for i in range(1, 12)))[:k]
    assert [(r.vec_id, r.rank) for r in out] == [(i, n + 1) for n, (_, i) in enumerate(expected)]


def test_tokens_of_null_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 0), (1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (None, "", None, None, 0)], DDL)
    got = Counter((r.doc_id, r.n_tokens) for r in bpe.encode_digests(docs, bpe.default_spec()).collect())
    assert got == Counter([(1, 0), (1, 2), (1, 2), (None, 0)])
