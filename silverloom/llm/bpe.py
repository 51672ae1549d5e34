"""BPE encoding and decoding by forced-boundary splitting.

A merge can only ever build a token of the vocabulary, so a pair of neighbouring bytes that occurs inside no token is
never merged across. Such pairs mark cuts that are certain without running a single merge. A text's pre-tokens are laid
end to end as bytes, each followed by an end-of-word mark (0xFF, which UTF-8 never uses); the mark is followed by
nothing inside a token, so word ends are forced boundaries too. One table look-up for each byte pair finds all cuts, the
fragments between them are encoded independently, and their ids are concatenated. Equal fragments are encoded once for
each task while they stay in its bounded memory.

The tokenizer file is a parameter; it holds a BPE model with an end-of-word suffix, byte-level letters, NFC and lower
case, and special tokens that are found in the raw text first. No decoder is given there, so decoding joins the tokens'
names by one space.

Ids must not change with an upgrade of Python or of a package, so letters, numbers, lower case and normal form are those
of the tables that the tokenizers library holds: Unicode 16 for letters and numbers, 17 for lower case, 9 for the order
of combining marks. They are made from the interpreter's tables, which must be of Unicode 15.1, and the fixed
differences below; under other tables nothing is encoded. A test compares every code point with the library. Texts
without a code point that the installed regex package sees otherwise are split by that package, which is faster.

Cases: a null text counts as empty and has no tokens. Repeated rows are encoded alike; an empty table gives an empty
result. Fragments of any length cost n log n. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import whole_texts

MARK = b"\xff"
#: The word pattern of the tokenizer files that are understood.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Fragments remembered in a task, and the longest that is remembered.
CACHE, CACHED_BYTES = 120_000, 64
#: Up to this many symbols a plain search for the next merge is faster than a heap.
SHORT = 40
#: Letters, digits and white space of Latin-1, whose texts a simpler pattern of the same meaning splits faster.
LATIN_LETTER, LATIN_NUMBER, LATIN_SPACE = r"A-Za-zªµºÀ-ÖØ-öø-ÿ", r"0-9²³¹¼-¾", r"\t-\r \x85\xa0"


WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
TABLES = "15.1.0"

# What Unicode 16 and 17 add to the tables of 15.1, and the marks that came after 9.
NEW_LETTERS = (
    r"\u1c89-\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d4a-\U00010d65\U00010d6f-\U00010d85\U00010ec2-\U00010ec4"
    r"\U00011380-\U00011389\U0001138b\U0001138e\U00011390-\U000113b5\U000113b7\U000113d1\U000113d3\U00011bc0-\U00011be0"
    r"\U00013460-\U000143fa\U00016100-\U0001611d\U00016d40-\U00016d6c\U00018cff\U0001e5d0-\U0001e5ed\U0001e5f0"
)
NEW_NUMBERS = (
    r"\U00010d40-\U00010d49\U000116d0-\U000116e3\U00011bf0-\U00011bf9\U00016130-\U00016139\U00016d70-\U00016d79"
    r"\U0001ccf0-\U0001ccf9\U0001e5f1-\U0001e5fa"
)
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEW_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
NEW_MARKS = (
    r"\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b-\u0d3c\u0eba\u1715\u1abf-\u1ace\u1df6-\u1dfa\ua82c\U00010d24-\U00010d27"
    r"\U00010eab-\U00010eac\U00010efd-\U00010eff\U00010f46-\U00010f50\U00010f82-\U00010f85\U00011070\U0001133b\U0001145e"
    r"\U00011839-\U0001183a\U00011930\U0001193d-\U0001193e\U00011943\U000119e0\U00011a34\U00011a47\U00011a99\U00011d42"
    r"\U00011d44-\U00011d45\U00011d97\U00011f41-\U00011f42\U00016ff0-\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae"
    r"\U0001e2ec-\U0001e2ef\U0001e4ec-\U0001e4ef"
)
IS_NEW_MARK = re.compile(f"([{NEW_MARKS}])")
#: Code points of a word by which leaves are told apart when a text is counted leaf by leaf.
LEAF_END = "\x01"


def flags_of(points: Iterable[int]) -> np.ndarray:
    flags = np.zeros(0x110000, dtype=bool)
    flags[list(points)] = True
    return flags


def has_any(text: str, flags: np.ndarray) -> bool:
    """Whether a text has a flagged code point; none of ASCII is flagged."""
    return not text.isascii() and bool(flags[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].any())


IS_NEW_LOWER = flags_of(NEW_LOWER)


@lru_cache(maxsize=1)
def word_classes() -> tuple[str, str, np.ndarray]:
    """Letters and numbers as the inside of character classes, and the code points that the regex package sees otherwise."""
    if unicodedata.unidata_version != TABLES:
        raise RuntimeError(f"words are split by the tables of Unicode {TABLES}, and this Python has {unicodedata.unidata_version}")
    every = "".join(map(chr, range(0x110000)))
    kinds = "".join([unicodedata.category(c)[0] for c in every])
    spans = lambda kind: "".join([f"\\U{m.start():08x}-\\U{m.end() - 1:08x}" for m in re.finditer(f"{kind}+", kinds)])
    letter, number = spans("L") + NEW_LETTERS, spans("N") + NEW_NUMBERS
    odd = set()
    for ours, theirs in ((letter, r"\p{L}"), (number, r"\p{N}"), (WHITE, r"\p{White_Space}")):
        odd ^= set(re.findall(f"[{ours}]", every)) ^ set(regex.findall(theirs, every))
    return letter, number, flags_of(map(ord, odd))


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in byte-level vocabularies, back to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ForcedBoundaryBpe:
    """Encoder and decoder made from the text of a tokenizer file."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model, letters = spec["model"], byte_letters()
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        # the file's pattern: a contraction, letters, one number, or other signs; no two of these start alike
        ends = r"'(?:s|t|re|ve|m|ll|d)"
        letter, number, self.odd = word_classes()
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != PATTERN:
            raise ValueError("the tokenizer file splits words by another pattern")
        self.words = re.compile(f"[{letter}]+|{ends}|[{number}]|[^{WHITE}{letter}{number}]+")
        self.fast_words = regex.compile(rf"[\p{{L}}]+|{ends}|[\p{{N}}]|[^\p{{White_Space}}\p{{L}}\p{{N}}]+")
        self.latin_words = re.compile(rf"[{LATIN_LETTER}]+|{ends}|[{LATIN_NUMBER}]|[^{LATIN_SPACE}{LATIN_LETTER}{LATIN_NUMBER}]+")

        def as_bytes(token: str) -> bytes:
            ends = token.endswith(self.suffix) and token != self.suffix
            body = bytes(letters[c] for c in (token[: -len(self.suffix)] if ends else token))
            return body + MARK * ends

        vocab = model["vocab"]
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        raw = {t: as_bytes(t) for t in vocab}
        self.ids = {b: vocab[t] for t, b in raw.items() if 0xFF not in b.removesuffix(MARK)}
        self.of_byte = [self.ids.get(bytes([b]), -1) for b in range(256)]
        self.of_last_byte = [self.ids.get(bytes([b]) + MARK, -1) for b in range(256)]
        allowed = np.zeros(65536, dtype=bool)
        for b in self.ids:
            for x, y in zip(b, b[1:], strict=False):
                allowed[x * 256 + y] = True
        self.forced = ~allowed
        self.merges, self.made = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.decimal = [str(i) for i in range(max(self.names) + 1)]
        self.known: dict[bytes, tuple[str, int, str]] = {}
        self.counts: dict[bytes, int] = {}

    def normalize(self, text: str) -> str:
        if not unicodedata.is_normalized("NFC", text):
            # what was no mark in the tables of the library stays in its place and joins nothing
            text = "".join([unicodedata.normalize("NFC", t) for t in IS_NEW_MARK.split(text)])
        if has_any(text, IS_NEW_LOWER):
            text = text.translate(NEW_LOWER)
        return text.replace("Σ", "σ").lower()  # letter by letter: no rule for a final sigma

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of one fragment: the merge of lowest rank first, leftmost among equals."""
        ids = [self.of_byte[b] for b in fragment]
        if fragment.endswith(MARK) and len(fragment) > 1:
            ids[-2:] = [self.of_last_byte[fragment[-2]]]
        return self.merge_short(ids) if len(ids) <= SHORT else self.merge_long(ids)

    def merge_short(self, ids: list[int]) -> list[int]:
        rank_of, made = self.merges.get, self.made
        none = len(made)
        ranks = [rank_of(pair, none) for pair in zip(ids, ids[1:])]  # noqa: B905
        ranks.append(none)
        while (rank := min(ranks)) < none:
            i = ranks.index(rank)
            del ranks[i], ids[i]
            new = ids[i] = made[rank]
            if ranks[i] < none or i + 1 < len(ids):
                ranks[i] = rank_of((new, ids[i + 1]), none)
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], new), none)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, for fragments where looking through all pairs again would be quadratic."""
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(rank, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (rank := self.merges.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (rank := self.merges.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (rank, a, ids[a], ids[b]))
        return [i for i in ids if i >= 0]

    def fragment(self, piece: bytes) -> tuple[str, int, str]:
        """Decimal ids, their number and the decoded names of a fragment."""
        ids = self.merge(piece)
        coded = (" ".join([self.decimal[i] for i in ids]), len(ids), self.decode(ids))
        if len(piece) <= CACHED_BYTES:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[piece] = coded
        return coded

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.names[i] for i in ids])

    def words_of(self, text: str) -> list[str]:
        """Pre-tokens of a normalized text."""
        try:
            text.encode("latin-1")
            return self.latin_words.findall(text)
        except UnicodeEncodeError:
            return (self.words if has_any(text, self.odd) else self.fast_words).findall(text)

    def fragments(self, text: str) -> list[bytes]:
        """The text's bytes between forced boundaries."""
        words = self.words_of(self.normalize(text))
        if not words:
            return []
        stream = "\0".join(words).encode() + b"\0"
        if stream.count(b"\0") == len(words):
            stream = stream.replace(b"\0", MARK)
        else:  # the text itself holds NUL
            stream = MARK.join(w.encode() for w in words) + MARK
        return self.cut(stream)

    def cut(self, stream: bytes) -> list[bytes]:
        codes = np.frombuffer(stream, dtype=np.uint8)
        pairs = codes[:-1].astype(np.uint16) << 8 | codes[1:]
        cuts = (np.flatnonzero(self.forced[pairs]) + 1).tolist()
        return [stream[a:b] for a, b in zip([0, *cuts], [*cuts, len(stream)])]  # noqa: B905

    def encode(self, text: str) -> list[tuple[str, int, str]]:
        """Encoded fragments of a whole text, special tokens included, in order."""
        out, at, known, fragment = [], 0, self.known, self.fragment
        for m in self.special_at.finditer(text) if "<|" in text else ():
            out += [known.get(f) or fragment(f) for f in self.fragments(text[at : m.start()])]
            i = self.special[m[0]]
            out.append((str(i), 1, m[0]))
            at = m.end()
        out += [known.get(f) or fragment(f) for f in self.fragments(text[at:] if at else text)]
        return out

    def counted(self, fragments: list[bytes]) -> list[int]:
        """Numbers of tokens of fragments, which are remembered without their ids."""
        known, sized = self.counts, self.sized
        return [known.get(f) or sized(f) for f in fragments]

    def sized(self, piece: bytes) -> int:
        n = len(self.merge(piece))
        if len(piece) <= CACHED_BYTES:
            if len(self.counts) >= CACHE:
                self.counts.clear()
            self.counts[piece] = n
        return n

    def count(self, text: str) -> int:
        """The number of tokens of a text."""
        total, at = 0, 0
        for m in self.special_at.finditer(text) if "<|" in text else ():
            total += 1 + sum(self.counted(self.fragments(text[at : m.start()])))
            at = m.end()
        return total + sum(self.counted(self.fragments(text[at:] if at else text)))

    def count_each(self, leaves: list[str]) -> list[int]:
        """The numbers of tokens of pieces of one text, cut where no token reaches across; in one pass over the text."""
        joined = f" {LEAF_END} ".join(leaves)
        if len(leaves) < 2 or "<|" in joined or joined.count(LEAF_END) != len(leaves) - 1:
            return [self.count(x) for x in leaves]
        fragments, end = self.fragments(joined), LEAF_END.encode() + MARK  # a word, and so a fragment, of its own
        ends = [i for i, f in enumerate(fragments) if f == end]
        upto = np.concatenate([[0], np.cumsum(self.counted(fragments), dtype=np.int64)])
        return (upto[[*ends, len(fragments)]] - upto[[0, *[i + 1 for i in ends]]]).tolist()


@lru_cache(maxsize=2)
def coder(spec: str) -> ForcedBoundaryBpe:
    return ForcedBoundaryBpe(spec)


def default_spec(name: str = "word_bpe_49k.json") -> str:
    """The text of a public tokenizer file, read on the driver; about 1.7 MB."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def encode_digests(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = coder(shared.value)
        sha = lambda parts: hashlib.sha256(" ".join(parts).encode()).hexdigest()
        for batch in batches:
            coded = []
            for text in batch["text"]:
                parts = bpe.encode(text or "")
                ids, counts, names = zip(*parts, strict=True) if parts else ((), (), ())
                coded.append((sum(counts), sha(ids), sha(names)))
            n, ids_sha, names_sha = zip(*coded, strict=True) if coded else ((), (), ())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": names_sha})

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return whole_texts(plain).mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
