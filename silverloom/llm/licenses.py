"""Licence scans: Aho-Corasick over words, and licence expressions by a shunting-yard parser.

A text's words (runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased) are put in a row, one space
between, and one Aho-Corasick automaton finds every place of every phrase in one pass, overlapping places included: the
base phrases, the notice phrases and the tags that announce an expression (``SPDX-License-Identifier:``, ``license =``).
What follows a tag on its line is read as an expression: a shunting-yard parser orders ``and``, ``or``, ``with`` and
parentheses, and the evaluation gives the class of obligations. The licensee of ``A or B`` may choose (the lesser class),
``A and B`` binds by both (the greater), and a known exception behind ``with`` turns strong copyleft into weak.

Cases: a null text counts as empty. Phrases of base labels count at every place; the labels of notices and tags are added
and take nothing away. An expression ends with its line, or before the first token that cannot continue it; an operator
left without a right side is dropped, with parentheses opened behind it; one with an open parenthesis is of unknown class. Identifiers that are in no list
make a class unknown and give no label; behind tags other than SPDX's, expressions without a known identifier are prose
and ignored. Rows that repeat have equal results, an empty table gives an empty one, and further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import whole_texts

#: Classes of obligations by rising weight; an expression's value is an index.
CLASSES = ["public-domain", "permissive", "weak-copyleft", "strong-copyleft", "restricted", "unknown"]
# Phrases of the base labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices, in words, and the label that each adds.
NOTICES = {
    "mit license": "mit", "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license": "apache", "apache license version 2 0": "apache-2.0", "licensed under the apache license version 2 0": "apache-2.0",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd", "isc license": "isc", "zlib license": "zlib",
    "boost software license": "bsl", "python software foundation license": "psf", "artistic license": "artistic",
    "mozilla public license": "mpl", "eclipse public license": "epl", "common development and distribution license": "cddl",
    "gnu general public license": "gpl", "gnu general public license version 2": "gpl-2.0", "gnu general public license version 3": "gpl-3.0",
    "lesser general public license": "lgpl", "library general public license": "lgpl", "affero general public license": "agpl",
    "gnu free documentation license": "gfdl", "european union public licence": "eupl", "open database license": "odbl",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0", "cc0 1 0 universal": "cc0", "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "released into the public domain": "public-domain", "dedicated to the public domain": "public-domain", "no rights reserved": "public-domain",
    "the unlicense": "unlicense",
}
# Tags, in words.
SPDX = "spdx license identifier"
TAGS = [SPDX, "license", "licence", "license expression"]
# Families of identifiers (what stands before version and suffix) by class.
FAMILIES = {
    "cc0": 0, "unlicense": 0, "pddl": 0, "0bsd": 0, "blessing": 0, "wtfpl": 1,
    "mit": 1, "apache": 1, "bsd": 1, "isc": 1, "zlib": 1, "bsl": 1, "psf": 1, "python": 1, "ncsa": 1, "x11": 1, "postgresql": 1, "unicode": 1, "artistic": 1, "cc-by": 1, "afl": 1, "upl": 1,
    "lgpl": 2, "mpl": 2, "epl": 2, "cddl": 2, "cpl": 2, "ms-pl": 1, "ms-rl": 2, "eupl": 2, "cc-by-sa": 2, "odbl": 2, "gfdl": 2,
    "gpl": 3, "agpl": 3, "osl": 3, "sspl": 4, "cc-by-nc": 4, "cc-by-nd": 4, "cc-by-nc-sa": 4, "cc-by-nc-nd": 4, "busl": 4, "proprietary": 4,
}
# Exceptions that let a work be linked or used without its licence spreading.
EXCEPTIONS = ["classpath-exception", "gcc-exception", "llvm-exception", "linux-syscall-note", "font-exception", "autoconf-exception", "bison-exception", "openssl-exception", "qt-gpl-exception", "libtool-exception"]
#: Weight of the evidence for a label by its kind; a document's score is 1 less the product of what each label leaves open.
WEIGHTS = {"base": 0.5, "notice": 0.7, "tag": 0.95}

BREAKS = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))
IS_WORD = np.array([c != 32 for c in BREAKS])
OPENS = re.compile(rb"[\"']?[ \t]*[:=][ \t]*[\"'\[]?")
TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9][a-z0-9.+-]*)")
VERSION = re.compile(r"(?:-v?\d[\d.]*)?(?:-(?:only|or-later|clause(?:-.*)?|invariants-.*|no-invariants-.*))*\+?$")
BINDS = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str | None:
    """The family of a licence identifier (``gpl`` of ``gpl-2.0-or-later``), or None if no list has it."""
    short = VERSION.sub("", identifier.rstrip("."))
    return short if short in FAMILIES else None


def is_exception(identifier: str) -> bool:
    return any(identifier.startswith(e) for e in EXCEPTIONS)


def tokens(line: bytes) -> Iterator[str]:
    at = 0
    while m := TOKEN.match(line, at):
        yield m[1].decode("ascii")
        at = m.end()


def to_postfix(found: Iterator[str]) -> tuple[list[str], bool]:
    """The longest expression that ``found`` starts with, operators behind their operands, and whether it is whole."""
    out: list[str] = []
    waiting: list[str] = []
    operand_next, depth = True, 0
    for token in found:
        if operand_next:
            if token == "(":
                waiting.append(token)
                depth += 1
            elif token == ")" or token in BINDS:
                break
            else:
                out.append(token)
                operand_next = False
        elif token in BINDS:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand_next = True
        elif token == ")" and depth:
            while (top := waiting.pop()) != "(":
                out.append(top)
            depth -= 1
        else:
            break
    while operand_next and waiting:  # parentheses that hold nothing yet, and the operator without a right side
        operand_next = waiting[-1] == "("
        depth -= waiting.pop() == "("
    return out + [w for w in reversed(waiting) if w != "("], depth == 0 and bool(out)


def evaluate(postfix: list[str]) -> tuple[int, str]:
    """The class of a postfix expression (an index of CLASSES), and the expression with no more parentheses than it needs."""
    stack: list[tuple[int, str, int]] = []
    for token in postfix:
        if token not in BINDS:
            known = family(token)
            stack.append((len(CLASSES) - 1 if known is None else FAMILIES[known], token, 4))
            continue
        binds = BINDS[token]
        (right, right_text, right_binds), (left, left_text, left_binds) = stack.pop(), stack.pop()
        if token == "with":
            value = 2 if left == 3 and is_exception(right_text) else left
        else:
            value = min(left, right) if token == "or" else max(left, right)
        sides = [f"({t})" if b < binds else t for t, b in ((left_text, left_binds), (right_text, right_binds))]
        stack.append((value, f"{sides[0]} {token.upper()} {sides[1]}", binds))
    return (stack[0][0], stack[0][1]) if stack else (len(CLASSES) - 1, "")


def expression(line: bytes) -> tuple[int, str, list[str]] | None:
    """Class, text and known families of the expression at the start of ``line`` (lower-cased); None if there is none."""
    postfix, whole = to_postfix(tokens(line))
    if not postfix:
        return None
    value, text = evaluate(postfix)
    names = sorted({f for t in postfix if t not in BINDS and (f := family(t))})
    return value if whole else len(CLASSES) - 1, text, names


@cache
def automaton() -> ahocorasick.Automaton:
    """All phrases, a space at either end, with their words and what they mean."""
    meant: dict[str, list[tuple[str, str]]] = {}
    for kind, phrases in (("base", BASE.items()), ("notice", NOTICES.items()), ("tag", [(t, t) for t in TAGS])):
        for phrase, label in phrases:
            meant.setdefault(phrase, []).append((kind, label))
    built = ahocorasick.Automaton()
    for phrase, means in meant.items():
        built.add_word(f" {phrase} ", (phrase.count(" ") + 1, means))
    built.make_automaton()
    return built


def scan(text: str) -> tuple[int, list[tuple[int, int, str, str]], list[tuple[int, str, str, list[str]]]]:
    """Words of a text; places (start, end in words, kind, label) by start; expressions (word, class, text, families)."""
    raw = text.encode("utf-8", "surrogatepass").lower()
    words = raw.translate(BREAKS).split()
    row = b" " + b" ".join(words) + b" "
    places, tagged, gaps = [], {}, None
    for end, (length, means) in automaton().iter(row.decode("latin-1")):
        if gaps is None:
            gaps = np.flatnonzero(np.frombuffer(row, dtype=np.uint8) == 32)
        after = int(np.searchsorted(gaps, end))  # the gap behind the phrase has the number of the word after it
        for kind, label in means:
            if kind == "tag":
                tagged[after] = tagged.get(after, False) or label == SPDX
            else:
                places.append((after - length, after, kind, label))
    return len(words), sorted(places), expressions(raw, tagged) if tagged else []


def expressions(raw: bytes, tagged: dict[int, bool]) -> list[tuple[int, str, str, list[str]]]:
    """What stands behind tags; ``tagged``: the number of words up to the tag's end, and whether it is SPDX's."""
    is_word = np.concatenate([IS_WORD[np.frombuffer(raw, dtype=np.uint8)], [False]])
    ends = np.flatnonzero(is_word[:-1] & ~is_word[1:]) + 1
    out = []
    for word, spdx in sorted(tagged.items()):
        opens = OPENS.match(raw, int(ends[word - 1]))
        if not opens:
            continue
        stop = raw.find(b"\n", opens.end())
        found = expression(raw[opens.end() : stop if stop >= 0 else len(raw)])
        if found and (spdx or found[2]):
            out.append((word, CLASSES[found[0]], found[1], found[2]))
    return out


def score(kinds_by_label: dict[str, float]) -> float:
    left = 1.0
    for label in sorted(kinds_by_label):
        left *= 1.0 - kinds_by_label[label]
    return 1.0 - left


PLACE = "struct<start:bigint,end:bigint,kind:string,label:string>"
EXPRESSION = "struct<word:bigint,class:string,text:string,families:array<string>>"
FOUND = f"n_words long, places array<{PLACE}>, expressions array<{EXPRESSION}>, score double"


def _scan_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["text"]:
            n, places, found = scan(text or "")
            best: dict[str, float] = {}
            for kind, label in [(k, lb) for *_, k, lb in places] + [("tag", f) for *_, fs in found for f in fs]:
                best[label] = max(best.get(label, 0.0), WEIGHTS[kind])
            rows.append((n, [dict(zip(("start", "end", "kind", "label"), p, strict=True)) for p in places], [dict(zip(("word", "class", "text", "families"), e, strict=True)) for e in found], score(best)))
        made = pd.DataFrame(rows, columns=["n_words", "places", "expressions", "score"], index=batch.index)
        yield pd.concat([batch[["doc_id"]], made], axis=1)


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, places, expressions, score.

    ``places`` (start and end in words, kind, label) are ordered by start; ``expressions`` (word behind the tag, class, text,
    families of known identifiers) by word. ``score`` says how sure it is that the document states a licence.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return whole_texts(plain).mapInPandas(_scan_batches, f"doc_id long, {FOUND}")


def digests(found: DataFrame) -> DataFrame:
    """The columns of the registered query from those of :func:`find_licenses`."""
    base = F.filter("places", lambda p: p["kind"] == "base")
    starts = F.transform(base, lambda p: p["start"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    tagged = F.flatten(F.transform("expressions", lambda e: e["families"]))
    classes = F.array(*[F.lit(c) for c in CLASSES])
    heaviest = F.array_max(F.transform("expressions", lambda e: F.array_position(classes, e["class"])))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(F.transform(base, lambda p: p["label"])).alias("base_labels"), joined(F.concat(F.transform("places", lambda p: p["label"]), tagged)).alias("labels"),
        "score", F.array_join(F.transform("expressions", lambda e: e["text"]), "; ").alias("expressions"), F.get(classes, (heaviest - 1).cast("int")).alias("obligations"),
    )
