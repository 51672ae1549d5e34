"""Quality classifier: hierarchical empirical Bayes over hosts and paths.

A document's own evidence comes from a classifier trained on labelled rows; good means of good quality and not toxic.
Its host (here the source) and path within the host (here the language) add what their other documents say: sums of the
other documents' probabilities by host and by path (the document's own left out, so that it is not counted twice) are
shrunk, the path's towards the host's and the host's towards the whole corpus, with strengths estimated from the spread
between groups. Sparse groups so fall back to their parents. The posterior is the document's log-odds moved by the
log-odds of its path's mean against the corpus mean.

The classifier: on one half of the sample, log-odds of features (words, shapes of words, shares of repeated words and of
signs, in buckets) by counting; on the other half, a logistic regression over six summaries of a document's features.
Its sample is bounded: ``SAMPLE`` labelled rows, those of the smallest hash of the id, and the ``FEATURES`` strongest
features. Everything else covers all rows.

Cases: a null or empty text has no features and the corpus mean as evidence; a null host or path is a name of its own.
Labels that are null or of unknown documents are left out; without any labels of both kinds every document is kept.
Repeated rows are judged alike. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import operator
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from silverloom.llm.common import broadcast_if_small, hash_sample, materialize, whole_texts

SAMPLE, FEATURES, MIN_ROWS = 20_000, 50_000, 6
#: Code points of a word that are looked at.
LONGEST = 200
#: Strengths of shrinkage are kept between these numbers of documents.
LEAST_STRENGTH, MOST_STRENGTH = 5.0, 10_000.0
LETTERS, UPPERS, DIGITS = re.compile(r"[^\W\d_A-Z]+"), re.compile(r"[A-Z]+"), re.compile(r"\d+")
SIGN = re.compile(r"[^\w\s]")
AROUND = string.punctuation + "«»„“”‘’…–—¡¿"


def shape_of(word: str) -> str:
    """Runs of letters, capitals and digits as one letter each, signs as they are; marked so as to be no word."""
    if word.isalpha() and (word.islower() or word.isupper()):
        return "\0a" if word.islower() else "\0A"
    return "\0" + DIGITS.sub("9", LETTERS.sub("a", UPPERS.sub("A", word[:LONGEST])))[:12]


def features(text: str | None) -> tuple[set[str], set[str]]:
    """Distinct words (lower-cased, without signs around them), and shapes of words with names of the bucketed shares."""
    words = (text or "").split()
    if not words:
        return set(), set()
    distinct, n = set(words), len(words)
    bare = {w[:LONGEST].lower().strip(AROUND) for w in distinct}
    repeated = sum(map(operator.eq, words, words[1:])) / n
    signs, upper = len(SIGN.findall(text)) / n, sum(map(str.isupper, words)) / n
    shares = {f"\0r {int(20 * repeated)}", f"\0d {int(10 * len(distinct) / n)} {min(n // 100, 5)}", f"\0p {int(5 * min(signs, 4))}", f"\0u {int(10 * upper)}"}
    return bare, shares.union(map(shape_of, distinct))


def summaries(text: str | None, weight: dict[str, float]) -> list[float]:
    """The strongest three bad words, the means of words and of shapes and shares, the share of bad words, and one."""
    bare, others = features(text)
    known = sorted([weight[w] for w in bare if w in weight])
    other = [weight[w] for w in others if w in weight]
    shared = sum(other) / len(other) if other else 0.0
    if not known:
        return [min(other, default=0.0), 0.0, 0.0, shared, 0.0, 1.0]
    return [min(other, default=0.0), sum(min(w, 0.0) for w in known[:3]), sum(known) / len(known), shared, sum(w < -1 for w in known) / len(known), 1.0]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Newton's method with a ridge on all but the constant."""
    b = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> tuple[dict[str, float], np.ndarray] | None:
    """Feature weights and coefficients, or None where the labels are not of both kinds."""
    known = labels.where("quality is not null and doc_id is not null")
    known = known.select("doc_id", ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int").alias("good"))
    known = hash_sample(known, "doc_id", SAMPLE).groupBy("doc_id").agg(F.min("good").alias("good"))
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text")
    rows = materialize(plain.join(F.broadcast(known), "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2))), "labelled")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = [list(a | b) for a, b in map(features, batch["text"])]
            yield pd.DataFrame({"f": [f for x in seen for f in x], "good": np.repeat(batch["good"].to_numpy(), [len(x) for x in seen])})

    first = rows.where("half = 0")
    sums = {r.good: r.n for r in first.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if not sums.get(0) or not sums.get(1):
        return None
    counted = first.select("text", "good").mapInPandas(each, "f string, good int").groupBy("f").agg(F.sum("good").alias("g"), F.count("*").alias("n"))
    odds = F.log((F.col("g") + 0.5) / (sums[1] + 1)) - F.log((F.col("n") - F.col("g") + 0.5) / (sums[0] + 1))
    strongest = counted.where(F.col("n") >= MIN_ROWS).select("f", odds.alias("w")).orderBy(F.desc(F.abs("w")), "f").limit(FEATURES)
    weight = {r.f: r.w for r in strongest.collect()}

    def dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [summaries(t, weight) for t in batch["text"]], "good": batch["good"]})

    second = rows.where("half = 1").select("doc_id", "text", "good").mapInPandas(dense, "x array<double>, good int").collect()
    y = np.array([r.good for r in second], dtype=float)
    if not len(y) or y.min() == y.max():
        return None
    return weight, logistic(np.array([r.x for r in second]), y)


def strength(groups: DataFrame, mean: str) -> float:
    """How many documents a group's parent counts as, from the spread of group means (method of moments)."""
    got: Row = groups.agg(
        F.sum("n").alias("n"), F.count("*").alias("groups"), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col(mean), 2)).alias("between"),
        F.sum(F.col("n") * F.col(mean) * (1 - F.col(mean))).alias("within"), F.sum(F.col("n") * F.col("n")).alias("nn"),
    ).first()
    if not got.n or got.groups < 2:
        return MOST_STRENGTH
    within = got.within / got.n
    spread = (got.between - got.groups * within) / max(got.n - got.nn / got.n, 1.0)
    return MOST_STRENGTH if spread <= 0 else min(max(within / spread - 1, LEAST_STRENGTH), MOST_STRENGTH)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, evidence and posterior (probabilities of good), host and path means, kept."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight, b = model.value or ({}, None)
        for batch in batches:
            if b is None:
                logit = np.full(len(batch), np.nan)
            else:
                logit = np.array([float(np.dot(summaries(t, weight), b)) if t and not t.isspace() else np.nan for t in batch["text"]], dtype=float)
            yield batch.drop(columns="text").assign(logit=np.clip(logit, -12, 12))

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(host_col, F.lit("")).alias("host"), F.coalesce(path_col, F.lit("")).alias("path"), "text")
    scored = whole_texts(plain).mapInPandas(score, "doc_id long, host string, path string, logit double")
    scored = materialize(scored.withColumn("p", F.when(F.isnan("logit"), None).otherwise(1 / (1 + F.exp(-F.col("logit"))))), "scored")
    top = scored.agg(F.coalesce(F.avg("p"), F.lit(0.5))).first()[0]
    mean = min(max(top, 1e-6), 1 - 1e-6)
    paths = scored.where("p is not null").groupBy("host", "path").agg(F.sum("p").alias("s"), F.count("*").alias("n"))
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    k = strength(hosts.withColumn("m", F.lit(mean)), "m")
    shrunk = lambda total, n, towards, k: (total + F.lit(k) * towards) / (n + F.lit(k))
    paths = paths.join(broadcast_if_small(materialize(hosts.select("host", F.col("s").alias("host_s"), F.col("n").alias("host_n")), "hosts")), "host")
    paths = materialize(paths.withColumn("m", shrunk(F.col("host_s"), F.col("host_n"), F.lit(mean), k)), "paths")
    k_path = strength(paths, "m")
    out = scored.join(broadcast_if_small(paths.drop("m")), ["host", "path"], "left")
    own, one = F.coalesce("p", F.lit(0.0)), F.col("p").isNotNull().cast("int")  # left out of the sums of its groups
    out = out.withColumn("host_mean", shrunk(F.col("host_s") - own, F.col("host_n") - one, F.lit(mean), k))
    out = out.withColumn("path_mean", shrunk(F.col("s") - own, F.col("n") - one, F.col("host_mean"), k_path))
    safe = lambda c: F.least(F.greatest(F.coalesce(c, F.lit(mean)), F.lit(1e-6)), F.lit(1 - 1e-6))
    logit = lambda x: F.log(x / (1 - x))
    posterior = 1 / (1 + F.exp(-(logit(safe("p")) + logit(safe("path_mean")) - logit(F.lit(mean)))))
    out = out.withColumn("posterior", posterior)
    return out.select("doc_id", safe("p").alias("evidence"), safe("host_mean").alias("host_mean"), safe("path_mean").alias("path_mean"), "posterior", (F.lit(model.value is None) | F.col("p").isNull() | (F.col("posterior") >= 0.5)).alias("kept"))
