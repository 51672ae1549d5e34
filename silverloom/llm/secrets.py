"""Secret scans: corpus-wide ownership frequency.

A text is scanned for three base kinds (assign, access, hex), whose spans always stay, and for candidate tokens that mix
letters and digits: long runs of token characters anywhere, and shorter ones behind a word that announces a credential.
Hashes of all values, of base spans and candidates alike, are counted over the corpus by distinct owners and distinct
repositories. A value that many owners hold is a widely copied example; one that few owners hold looks like a live
credential of theirs, in however many repositories, and its candidate spans are added as ``owned``. Every span carries
its value's counts and verdict.

In ``documents`` the owner is the source, and a document is a repository of its owner.

Cases: null texts count as empty, null owners and null repositories as one name each. Repeated rows have equal spans and
count once. Offsets are code points, ends exclusive. An empty table gives an empty result. Further columns are ignored
by :func:`find_secrets`; :func:`redact` keeps all columns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import KEY, join_counted, materialize, text_key, whole_texts, with_marks

KINDS = ["assign", "access", "hex", "owned"]
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: A candidate: 16 or more token characters, or 8 or more behind a word that announces a credential.
CANDIDATE = re.compile(r"(?ai:\b(?:pwd|pass|passphrase|auth|bearer|credential|credentials|access_key|private_key)[\"']?\x20{0,4}[:=\x20]\x20{0,4}[\"']?)([A-Za-z0-9+/_=-]{8,})|([A-Za-z0-9+/_=-]{16,})")
HAS_DIGIT, HAS_LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
#: A live credential is held by at most so many owners.
MAX_OWNERS = 2
SPAN = "struct<kind:int,start:int,end:int,value:binary>"


def scan(text: str) -> list[tuple[int, int, int, bytes]]:
    """Base spans and candidates of a text: (index in KINDS, start, end, hash of the value)."""
    found = []
    folded = text.lower()
    if any(name in folded for name in NAMES):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                found.append((0, m.start(), m.end(), m[2]))
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    found.sort(key=lambda x: (x[1], x[0]))
    return [(k, s, e, digest(v)) for k, s, e, v in _with_candidates(text, found)]


def digest(value: str) -> bytes:
    return hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()[:16]


def _with_candidates(text: str, base: list[tuple]) -> list[tuple]:
    """Sorted base spans and the candidates that meet none of them, in one pass over both."""
    out, at, reach = [], 0, -1
    for m in CANDIDATE.finditer(text):
        start, end = m.span(m.lastindex)
        while at < len(base) and base[at][1] < end:
            reach = max(reach, base[at][2])
            out.append(base[at])
            at += 1
        value = m[m.lastindex]
        if reach <= start and HAS_DIGIT.search(value) and HAS_LETTER.search(value):
            out.append((3, start, end, value))
    return out + base[at:]


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow, as pandas would turn ids beside a null one into floats."""
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.binary())]))
    for batch in batches:
        spans = [[{"kind": k, "start": s, "end": e, "value": v} for k, s, e, v in scan(t or "")] for t in batch.column("text").to_pylist()]
        yield batch.drop_columns(["text"]).append_column("spans", pa.array(spans, kind))


def scanned(docs: DataFrame, id_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """One row per row of ``docs``: row_id (unique), doc_id, owner, repo, the text's name, spans; written to the shared folder."""
    plain = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"), *text_key(), "text",
    )
    schema = f"row_id long, doc_id long, owner string, repo string, key_h long, key_c long, key_n int, spans array<{SPAN}>"
    return materialize(whole_texts(plain).mapInArrow(_scan_batches, schema), "secret-spans")


def ownership(spans: DataFrame) -> DataFrame:
    """(value, owners, repositories, n): the distinct owners and repositories that hold each value, and its spans."""
    held = spans.select("owner", "repo", F.explode("spans.value").alias("value"))
    by_repo = held.groupBy("value", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return by_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("n"))


def classified(spans: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per span: row_id, kind, start, end, owners, repositories, live. Most values occur once and need no join."""
    shared = materialize(ownership(spans).where("n > 1"), "secret-values")
    each = join_counted(spans.select("row_id", F.inline("spans")), shared, "value", "left")
    owners, repositories = F.coalesce("owners", F.lit(1)), F.coalesce("repositories", F.lit(1))
    return each.select("row_id", "kind", "start", "end", owners.alias("owners"), repositories.alias("repositories"), (owners <= max_owners).alias("live"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", owner_col: str = "source", repo_col: str = "doc_id", max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, the text's name, found (array of start, kind, end, owners, repositories, live).

    ``found``, ordered by start and kind, holds every base span and the candidates that the corpus shows to be owner-specific.
    """
    spans = scanned(docs, id_col, owner_col, repo_col)
    chosen = classified(spans, max_owners).where((F.col("kind") < 3) | F.col("live"))
    each = F.struct("start", "kind", "end", "owners", "repositories", "live")
    listed = chosen.groupBy("row_id").agg(F.sort_array(F.collect_list(each)).alias("found"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,owners:bigint,repositories:bigint,live:boolean>>")
    return spans.select("row_id", "doc_id", *KEY).join(listed, "row_id", "left").select("doc_id", *KEY, F.coalesce("found", none).alias("found"))


def redacted(text: str, starts: list[int], ends: list[int], marks: list[str]) -> str:
    """``text`` with each span, ordered by start, replaced by its mark; one that starts within the last is part of it."""
    parts, at = [], 0
    for start, end, mark in zip(starts, ends, marks, strict=True):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, live: str = "[SECRET]", example: str = "[EXAMPLE-SECRET]") -> DataFrame:
    """``docs`` with every span replaced by a mark that says whether its value looks live; n_chars follows the text."""
    marks = find_secrets(docs).where(F.size("found") > 0).dropDuplicates(["doc_id", *KEY]).withColumnRenamed("found", "__found")
    joined = with_marks(docs, marks, "left", {"doc_id": "doc_id"})

    @F.pandas_udf("string")
    def replace(texts: pd.Series, starts: pd.Series, ends: pd.Series, lives: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redacted(t, s, e, [live if x else example for x in v]) for t, s, e, v in zip(texts, starts, ends, lives, strict=True)], dtype=object)

    touched = F.col("__found").isNotNull()  # only their texts go to Python
    out = whole_texts(joined).withColumn("__new", replace(F.when(touched, F.col("text")), F.col("__found.start"), F.col("__found.end"), F.col("__found.live")))
    out = out.withColumn("text", F.coalesce("__new", "text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(touched, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
