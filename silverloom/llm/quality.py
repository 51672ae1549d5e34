"""Quality rules: base counts and distribution divergence, in DataFrame functions only.

Every document gets the base counts of the contract. The verdict is the divergence rule: the histogram of its character
classes and the histogram of its language's common words are compared with those of the whole language by the
Jensen-Shannon distance (base 2, 0 to 1). A document is rejected when a distance passes its limit, unless it is shorter
than the minimum length or its language has too little text for a reference; such documents pass this rule.

Common words of a language are its ``n_common`` most frequent lower-cased words (ties to the smaller word). Words are
counted in each task before the shuffle, which so has a row for each distinct word of a task and not for each word.
References are sums over all documents.

Cases: a null or empty text has no words, fails the base rule and is not kept. A null language is a language of its own
(the empty name). Repeated rows are judged alike. An empty table gives an empty result. Further columns are ignored by
:func:`judge`; :func:`keep_good` keeps them. Windows of three words are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.llm.common import KEY, SPACE_CLASS, WORD_CLASS, WS, broadcast_if_small, materialize, text_key, with_marks

SYMBOLS = "#*$%&|<>"
#: Limits of the Jensen-Shannon distance for character classes and for common words.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.45
#: Shorter documents fail the base rule.
BASE_WORDS = 50
#: Shorter documents are not judged by divergence, nor languages with fewer words in all.
MIN_WORDS, MIN_REFERENCE_WORDS = BASE_WORDS, 1_000
N_COMMON = 24
CLASSES = ["lower", "upper", "space", "digit", "symbol", "punct", "other"]


def words_of(text: Column) -> Column:
    """Words of a non-null text, in order."""
    return F.array_remove(F.split(F.btrim(text, F.lit(WS)), SPACE_CLASS + "+"), "")


def common_words(docs: DataFrame, n: int = N_COMMON) -> DataFrame:
    """(lang, common): the most frequent words of each language over all documents."""
    counted = docs.select("lang", F.explode(words_of(F.lower("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counted.withColumn("rank", rank).where(F.col("rank") <= n)
    listed = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("ranked"))
    return listed.select("lang", F.col("ranked.word").alias("common"))


def with_base_counts(docs: DataFrame) -> DataFrame:
    """Add words, the counts of the contract and the character classes to documents with a non-null text."""
    df = docs.withColumn("words", words_of(F.col("text")))
    df = df.withColumn("n_words", F.size("words").cast("long"))
    # character classes: each step works on what the last one left, which soon is a small part of the text
    df = df.withColumn("r1", F.regexp_replace("text", "[a-z]+", ""))
    df = df.withColumn("r2", F.regexp_replace("r1", "[A-Z]+", "")).withColumn("r3", F.translate("r2", WS, ""))
    df = df.withColumn("r4", F.regexp_replace("r3", "[0-9]+", "")).withColumn("r5", F.translate("r4", SYMBOLS, ""))
    df = df.withColumn("r6", F.regexp_replace("r5", "[!-~]+", ""))
    rests = [F.length(c).cast("long") for c in ("text", "r1", "r2", "r3", "r4", "r5", "r6")] + [F.lit(0).cast("long")]
    df = df.withColumns({f"c_{name}": a - b for name, a, b in zip(CLASSES, rests[:-1], rests[1:], strict=True)})
    df = df.withColumn("word_chars", F.length("text") - F.col("c_space")).withColumn("n_symbols", F.col("c_symbol"))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_CLASS)))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    # words in windows of three that occur again: sort the windows by hash, keep those equal to a neighbour, and add up
    # what each of them covers beyond the one before
    window = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    df = df.withColumn("windows", F.slice(window, F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("sorted", F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter(
        "sorted", lambda x, j: (x.h == F.get("sorted", j - 1).h) | (x.h == F.get("sorted", j + 1).h)
    )
    starts = F.sort_array(F.transform(again, lambda x: x.i))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a.n + F.least(F.lit(3), p - a.last)).alias("n"), p.alias("last")),
        lambda a: a.n,
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return df.drop("r1", "r2", "r3", "r4", "r5", "r6", "lines", "windows", "sorted")


def with_common_counts(df: DataFrame, common: DataFrame, n: int = N_COMMON) -> DataFrame:
    """Add ``hits``: how often each common word of the language occurs, the last entry being all other words."""
    df = df.join(broadcast_if_small(materialize(common, "common")), "lang", "left")
    at = F.transform(F.transform("words", F.lower), lambda w: F.array_position("common", w).cast("int"))
    df = df.withColumn("at", F.sort_array(at))
    # ends of the runs of equal positions, as (position, rows up to there)
    df = df.withColumn("runs", F.filter(F.transform("at", lambda p, j: F.struct(p.alias("p"), (j + 1).alias("upto"))), lambda r: ~F.coalesce(F.get("at", r.upto) == r.p, F.lit(False))))
    counts = F.map_from_arrays(F.col("runs.p"), F.transform("runs", lambda r, j: r.upto - F.coalesce(F.get("runs", j - 1).upto, F.lit(0))))
    df = df.withColumn("counts", counts)
    hits = F.array(*[F.coalesce(F.try_element_at("counts", F.lit(i)), F.lit(0)).cast("long") for i in [*range(1, n + 1), 0]])
    return df.withColumn("hits", hits).drop("at", "runs", "counts", "words", "common")


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of counts (doubles); null if either has no counts."""
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    shares = lambda xs: F.when(total(xs) > 0, F.transform(F.array(total(xs)), lambda n: F.transform(xs, lambda x: x / n))[0])
    term = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    both = F.zip_with(shares(p), shares(q), lambda a, b: term(a, b) + term(b, a))
    return F.sqrt(F.greatest(total(both) / 2, F.lit(0.0)))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    max_class: float = MAX_CLASS_DISTANCE,
    max_word: float = MAX_WORD_DISTANCE,
    min_words: int = MIN_WORDS,
    min_reference: int = MIN_REFERENCE_WORDS,
    extra: list[Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs`` with the base counts, both distances and the verdict ``kept``."""
    plain = docs.select(
        *(extra or []), F.col(id_col).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang")
    )
    names = [c for c in plain.columns if c not in ("text", "lang", "doc_id")]
    counted = with_common_counts(with_base_counts(plain), common_words(plain))
    classes = F.array(*[F.col(f"c_{c}").cast("double") for c in CLASSES]).alias("classes")
    counts = materialize(
        counted.select(*names, "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", classes, F.col("hits").cast("array<double>").alias("hits")),
        "quality-counts",
    )
    summed = lambda name, n: F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(n)])
    sums = counts.groupBy("lang").agg(
        F.sum("n_words").alias("r_words"), summed("classes", len(CLASSES)).alias("r_classes"), summed("hits", N_COMMON + 1).alias("r_hits")
    )
    judged = counts.join(broadcast_if_small(materialize(sums, "quality-sums")), "lang", "left")
    class_distance = js_distance(F.col("classes"), F.col("r_classes"))
    word_distance = js_distance(F.col("hits"), F.col("r_hits"))
    judged = judged.withColumn("class_distance", class_distance).withColumn("word_distance", word_distance)
    guarded = (F.col("n_words") < min_words) | (F.col("r_words") < min_reference)
    far = (F.coalesce("class_distance", F.lit(0.0)) > max_class) | (F.coalesce("word_distance", F.lit(0.0)) > max_word)
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).select(
        *names, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (guarded | ~far)).alias("kept"), "class_distance", "word_distance",
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Every document that the base rule lets pass is judged by divergence too, also those of 50 to 99 words. The verdict
    depends on text and language alone, so the rejected (text, language) pairs are taken out by an anti join.
    """
    lang = F.coalesce("lang", F.lit("")).alias("key_lang")
    gone = judge(docs, extra=[*text_key(), lang]).where(~F.col("kept")).select(*KEY, "key_lang").distinct()
    found = with_marks(docs.withColumn("__lang", lang), gone, "left_anti", {"__lang": "key_lang"})
    return found.drop("__lang")
