"""Token counts: edit-aware counting with a segment tree of pre-tokens per document.

A text is cut into leaves of a few pre-tokens (``LEAF_CHARS`` code points or little more), always before a space or line
feed, where no token can reach across. The tree keeps sums of code points and of tokens; its leaves are stored beside
the text by :func:`build_trees`, in a table that the caller writes, so that no later batch of edits encodes a text again.

An edit (position, code points to delete, text to insert) descends by code points to the leaves it touches. Only they are
re-encoded, with the leaf before as context where the edit starts at a leaf's first character (a word may then reach
over), and the sums on the path up are changed. The edits of a document apply one after another, each to the text that
the ones before have left. :func:`apply_edits` returns the counts with the new text and leaves, and :func:`edited_trees`
makes of them the table of trees for the next batch.

Cases: null texts and null or empty edit lists count as empty. Positions and lengths are clipped to the text. A leaf
that has grown to many times its size is cut anew. Repeated rows are counted alike, and edits of an id apply to all rows
that have it; edits of no known id are left out. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.bpe import ForcedBoundaryBpe, coder
from silverloom.llm.common import broadcast_if_small, materialize, whole_texts

LEAF_CHARS = 32
LEAF = re.compile(rf"(?s:.{{{LEAF_CHARS}}}[^ \n]*|.+)")
EDITS = "array<struct<pos:long,del:long,ins:string>>"
TREE = "doc_id long, text string, n_chars long, n_tokens long, leaf_chars array<int>, leaf_tokens array<int>"


class EditTree:
    """A text, and a tree over the (code points, tokens) of its leaves. Each leaf but the first starts with a gap."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, bpe: ForcedBoundaryBpe):
        self.text, self.bpe = text, bpe
        self.encoded_leaves = self.encoded_chars = self.encoded_tokens = 0
        self._fill(np.asarray(chars, dtype=np.int64), np.asarray(tokens, dtype=np.int64))

    @classmethod
    def of(cls, text: str, bpe: ForcedBoundaryBpe) -> EditTree:
        leaves = LEAF.findall(text)
        return cls(text, [len(x) for x in leaves], bpe.count_each(leaves) if leaves else [], bpe)

    def _fill(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.size = max(len(chars), 1)
        self.base = 1 << (self.size - 1).bit_length()
        self.chars, self.tokens = np.zeros(2 * self.base, dtype=np.int64), np.zeros(2 * self.base, dtype=np.int64)
        for sums, leaves in ((self.chars, chars), (self.tokens, tokens)):
            sums[self.base : self.base + len(leaves)] = leaves
            i = self.base
            while i > 1:
                sums[i // 2 : i] = sums[i : 2 * i : 2] + sums[i + 1 : 2 * i : 2]
                i //= 2

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return self.chars[self.base : self.base + self.size], self.tokens[self.base : self.base + self.size]

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    @property
    def n_chars(self) -> int:
        return int(self.chars[1])

    def locate(self, pos: int) -> tuple[int, int]:
        """The leaf that holds code point ``pos`` (the last leaf for the end of the text), and the place in it."""
        i = 1
        while i < self.base:
            i *= 2
            if pos >= self.chars[i] and self.chars[i + 1]:
                pos -= int(self.chars[i])
                i += 1
        return i - self.base, pos

    def _count(self, leaves: list[str]) -> list[int]:
        counts = self.bpe.count_each(leaves)
        self.encoded_leaves += len(leaves)
        self.encoded_chars += sum(map(len, leaves))
        self.encoded_tokens += sum(counts)
        return counts

    def _set(self, leaf: int, chars: int, tokens: int) -> None:
        i = self.base + leaf
        more_chars, more_tokens = chars - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += more_chars
            self.tokens[i] += more_tokens
            i //= 2

    def edit(self, pos: int, delete: int, insert: str) -> None:
        pos = min(max(pos, 0), self.n_chars)
        delete = min(max(delete, 0), self.n_chars - pos)
        first, offset = self.locate(pos)
        last, end = self.locate(pos + delete)
        while offset == 0 and first > 0:  # what comes before may now be part of the same word
            first -= 1
            offset = int(self.chars[self.base + first])
        start, stop = pos - offset, pos + delete - end + int(self.chars[self.base + last])
        self.text = self.text[:pos] + insert + self.text[pos + delete :]
        changed = self.text[start : stop - delete + len(insert)]
        if len(changed) <= 8 * LEAF_CHARS and last - first <= 8:
            self._set(first, len(changed), self._count([changed])[0])
            for i in range(first + 1, last + 1):
                self._set(i, 0, 0)
            return
        pieces = LEAF.findall(changed) if len(changed) > 8 * LEAF_CHARS else [changed]
        chars, tokens = self.leaves()
        self._fill(
            np.concatenate([chars[:first], [len(x) for x in pieces], chars[last + 1 :]]),
            np.concatenate([tokens[:first], self._count(pieces), tokens[last + 1 :]]),
        )


def build_trees(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", extra: list[Column] | None = None) -> DataFrame:
    """The trees of all rows, with their texts: TREE, and ``extra`` columns. To be written and kept by the caller."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = coder(shared.value)
        for batch in batches:
            trees = [EditTree.of(t or "", bpe) for t in batch["text"]]
            leaves = [t.leaves() for t in trees]
            yield batch.assign(
                text=[t.text for t in trees], n_chars=[t.n_chars for t in trees], n_tokens=[t.n_tokens for t in trees],
                leaf_chars=[c.astype(np.int32) for c, _ in leaves], leaf_tokens=[n.astype(np.int32) for _, n in leaves],
            )

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *(extra or []))
    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in plain.schema[2:])
    return whole_texts(plain).mapInPandas(run, TREE + kept)


def with_edit_table(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """``trees`` with a column ``edits``: the rows of ``edits`` (doc_id, seq, pos, del, ins) of each id, by seq."""
    listed = edits.where("doc_id is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "pos", "del", "ins"))).alias("edits"))
    listed = materialize(listed.select("doc_id", F.transform("edits", lambda e: F.struct(e.pos.alias("pos"), e["del"].alias("del"), e.ins.alias("ins"))).alias("edits")), "edits")
    return trees.join(broadcast_if_small(listed), "doc_id", "left")


def apply_edits(trees: DataFrame, edits: Column, spec: str, counts_only: bool = False) -> DataFrame:
    """One row per row of ``trees``: doc_id, n_chars and n_tokens as stored, edited_chars and edited_tokens after ``edits``

    (an array of pos, del, ins), leaves, what the edits re-encoded (leaves, chars and tokens); and without ``counts_only``
    the new text and leaves.
    """
    shared = trees.sparkSession.sparkContext.broadcast(spec)
    sums = ["edited_chars", "edited_tokens", "leaves", "leaves_reencoded", "chars_reencoded", "tokens_reencoded"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = coder(shared.value)
        for batch in batches:
            out = []
            for text, chars, tokens, todo in zip(batch["text"], batch["leaf_chars"], batch["leaf_tokens"], batch["edits"], strict=True):
                tree = EditTree(text, chars, tokens, bpe)
                for e in todo if todo is not None else []:
                    tree.edit(e["pos"] or 0, e["del"] or 0, e["ins"] or "")
                new_chars, new_tokens = (x.astype(np.int32) for x in tree.leaves())
                out.append((tree.n_chars, tree.n_tokens, len(chars), tree.encoded_leaves, tree.encoded_chars, tree.encoded_tokens, tree.text, new_chars, new_tokens))
            new = pd.DataFrame(out, columns=[*sums, "edited_text", "edited_leaf_chars", "edited_leaf_tokens"])
            new = new[sums] if counts_only else new
            yield pd.concat([batch[["doc_id", "n_chars", "n_tokens"]].reset_index(drop=True), new], axis=1)

    plain = trees.select("doc_id", "text", "n_chars", "n_tokens", "leaf_chars", "leaf_tokens", edits.cast(EDITS).alias("edits"))
    schema = "doc_id long, n_chars long, n_tokens long, " + ", ".join(f"{c} long" for c in sums)
    trees_too = "" if counts_only else ", edited_text string, edited_leaf_chars array<int>, edited_leaf_tokens array<int>"
    return whole_texts(plain).mapInPandas(run, schema + trees_too)


def edited_trees(applied: DataFrame) -> DataFrame:
    """The trees after :func:`apply_edits`, as a table for the next batch of edits."""
    names = {"text": "edited_text", "n_chars": "edited_chars", "n_tokens": "edited_tokens", "leaf_chars": "edited_leaf_chars", "leaf_tokens": "edited_leaf_tokens"}
    return applied.select("doc_id", *[F.col(c).alias(n) for n, c in names.items()])


def derived_edits(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Three edits that follow from the row itself: a cut, a replacement and an insertion, at places the id names."""
    n = F.length(F.coalesce(text_col, F.lit("")))
    place = lambda seed: F.pmod(F.xxhash64(id_col, F.lit(seed)), n + 1)
    edit = lambda pos, gone, ins: F.struct(pos.cast("long").alias("pos"), F.lit(gone).cast("long").alias("del"), ins.alias("ins"))
    said = F.concat(F.lit(" note "), F.coalesce("source", F.lit("")), F.lit(" "), F.coalesce("lang", F.lit("")))
    return F.array(edit(place(1), 24, F.lit("")), edit(place(2), 7, F.coalesce("lang", F.lit(""))), edit(place(3), 0, said))
