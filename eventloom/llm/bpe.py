"""BPE encoding and decoding by per-prefix dynamic programming (operator 10).

For every prefix of a pre-token, the encoding of that prefix has exactly one last token. An
automaton over the vocabulary lists the tokens that are suffixes of the prefix; a candidate
is the last token if the token before it (the last token of the shorter prefix) and the
candidate would stay apart under the merge rules. Back-pointers then give the exact ids,
in time proportional to the pre-token's length times the longest token's.

Defined results: null and empty texts have no tokens and decode to the empty string; repeated
rows give repeated result rows; an empty table gives an empty result; columns other than the
id and the text are ignored. Texts are encoded whole, whatever their length. Letters, numbers,
white space, lower case and canonical composition of every code point are those of the
tokenizers library itself: tables are read off it once, on the driver, and texts with one of the
few code points on which its Unicode version and Python's differ take a slower way.
"""

from __future__ import annotations

import hashlib
import importlib.util
import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

VOCABULARY = "word_bpe_49k.json"
#: Stands for the word-end suffix, as one character (private use).
END = ""
#: Pre-tokens that each half of a worker's memory holds, and pairs of tokens that it remembers.
REMEMBERED, REMEMBERED_PAIRS = 80_000, 200_000
#: Texts whose ids are held at a time.
SLICE = 128


def vocabulary_path(name: str = VOCABULARY) -> str:
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.join(os.path.dirname(spec.origin), name) if spec else f"/opt/tokenizers/{name}"


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown, spare = {}, 256
    for byte in range(256):
        if byte in printable:
            shown[byte] = chr(byte)
        else:
            shown[byte], spare = chr(spare), spare + 1
    return [shown[b] for b in range(256)]


class CodePoints(Sequence):
    """The characters of all code points but surrogates. None is held: as a list they took 82 MB of every worker."""

    points = range(0xD800), range(0xE000, 0x110000)

    def __len__(self) -> int:
        return sum(map(len, self.points))

    def __iter__(self) -> Iterator[str]:
        return map(chr, chain(*self.points))

    def __getitem__(self, at: int | slice) -> str | list[str]:
        if isinstance(at, slice):
            return [self[i] for i in range(*at.indices(len(self)))]
        low, high = self.points
        at = range(len(self))[at]
        return chr(low[at] if at < len(low) else high[at - len(low)])


#: Every code point that a text can have.
EVERY = CodePoints()


def ranges(chars: list[str]) -> str:
    """Sorted characters as ranges for a class of `re`."""
    points = np.array([ord(c) for c in chars], np.int64)
    if not len(points):
        return ""
    first = np.flatnonzero(np.append(True, np.diff(points) != 1))
    last = np.append(first[1:], len(points)) - 1
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(points[first].tolist(), points[last].tolist(), strict=True))


@dataclass(frozen=True)
class Characters:
    """What the library makes of characters: classes, and where it departs from Python."""

    letters: str
    numbers: str
    blank: str
    low_letters: str  # the same up to U+FFFF: short classes are faster
    low_numbers: str
    odd: str  # code points whose lower case or composition may not be Python's
    low_odd: str


@lru_cache(maxsize=1)
def characters() -> Characters:
    from tokenizers import Regex, normalizers

    def those(kind: str) -> list[str]:
        return list(normalizers.Replace(Regex(f"[^{kind}]"), "").normalize_str(whole))

    whole = "".join(EVERY)
    letters, numbers, blank = those("\\p{L}"), those("\\p{N}"), those("\\s")
    lower, compose = normalizers.Lowercase().normalize_str, normalizers.NFC().normalize_str

    def departs(some: list[str]) -> list[str]:
        """The characters of which library and Python make different things; most runs have none."""
        joined = "\n".join(some)
        if lower(joined) == "\n".join(c.lower() for c in some) and compose(joined) == unicodedata.normalize("NFC", joined):
            return []
        if len(some) == 1:
            return some
        return departs(some[: len(some) // 2]) + departs(some[len(some) // 2 :])

    # What Python's tables have not assigned may only be composed or ordered within longer texts.
    odd = {c for c in EVERY if unicodedata.category(c) == "Cn"}
    odd.update(c for at in range(0, len(EVERY), 4096) for c in departs(EVERY[at : at + 4096]))
    low = lambda chars: ranges([c for c in chars if ord(c) <= 0xFFFF])
    return Characters(ranges(letters), ranges(numbers), ranges(blank), low(letters), low(numbers), ranges(sorted(odd)), low(sorted(odd)))


def splitter(letters: str, numbers: str, blank: str):
    """The file's splitting pattern."""
    return re.compile(f"[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d|[{numbers}]|[^{blank}{letters}{numbers}]+").findall


class Encoder:
    """The vocabulary file's normaliser, splitter, merges and ids."""

    def __init__(self, content: bytes, chars: Characters | None = None):
        import ahocorasick

        chars = chars or characters()
        file = json.loads(content)
        suffix = file["model"]["end_of_word_suffix"]
        written = {token: token.removesuffix(suffix) + END if token.endswith(suffix) else token for token in file["model"]["vocab"]}
        self.ids = {written[token]: i for token, i in file["model"]["vocab"].items()}
        self.names = {i: token for token, i in file["model"]["vocab"].items()}
        one = {token: token for token in self.ids}  # one string for all places of a token
        self.special = {x["content"]: x["id"] for x in file["added_tokens"]}
        self.names |= {i: content for content, i in self.special.items()}
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str, int]] = {}
        for rank, pair in enumerate(file["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            left, right = left.removesuffix(suffix) + END * left.endswith(suffix), right.removesuffix(suffix) + END * right.endswith(suffix)
            left, right, whole = (one.setdefault(x, x) for x in (left, right, left + right))
            self.rank[left, right] = rank
            self.parts.setdefault(whole, (left, right, rank))
        self.automaton = ahocorasick.Automaton()
        for token in self.ids:
            if self.reachable(token):
                self.automaton.add_word(token, (self.ids[token], token, len(token) - (token[-1] == END)))
        self.automaton.make_automaton()
        self.split, self.split_any = splitter(chars.low_letters, chars.low_numbers, chars.blank), splitter(chars.letters, chars.numbers, chars.blank)
        self.odd, self.low_odd = re.compile(f"[{chars.odd}]").search, re.compile(f"[{chars.low_odd}]").search
        self.beyond = re.compile("[\U00010000-\U0010ffff]").search
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.bytes = byte_characters()
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.apart: dict[int, bool] = {}

    def edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """The tokens at one edge of `token` while it is built, first to last, each with the rank of the merge that ends it."""
        found, ends = [], sys.maxsize
        while True:
            found.append((token, ends))
            if token not in self.parts:
                return found[::-1]
            ends = self.parts[token][2]
            token = self.parts[token][side]

    def stays_apart(self, left: str, right: str) -> bool:
        """Whether the merges leave `left` and `right`, each built on its own, side by side."""
        # Both edges grow over time; at each moment one token of either side touches the border.
        # Equal merges go from left to right: on a tie the left side's merge comes before the
        # border's, and the border's before the right side's.
        lefts, rights = self.edge(left, 1), self.edge(right, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = lefts[i], rights[j]
            across = self.rank.get((x, y))
            if across is not None and across < x_ends and across <= y_ends:
                return False
            if i + 1 == len(lefts) and j + 1 == len(rights):
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def reachable(self, token: str) -> bool:
        """Whether merging the characters of `token` gives `token`."""
        if token not in self.parts:
            return len(token) == 1 or (len(token) == 2 and token[1] == END)
        left, right, rank = self.parts[token]
        if not (self.reachable(left) and self.reachable(right)):
            return False
        lefts, rights = self.edge(left, 1), self.edge(right, 0)
        i = j = 0
        while i + 1 < len(lefts) or j + 1 < len(rights):
            (x, x_ends), (y, y_ends) = lefts[i], rights[j]
            across = self.rank.get((x, y))
            if across is not None and across < x_ends and across <= y_ends:
                return False
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
        return self.rank[left, right] == rank

    def tokens(self, word: str) -> list[tuple[int, str, int]]:
        """Id, token and length of a pre-token's tokens; `word` is in byte characters, without its end."""
        size, apart = len(word), self.apart
        last: list[tuple[int, str, int] | None] = [None] * (size + 1)
        for at, token in self.automaton.iter(word + END):
            # A token with the word end is found at `size`; others may not end the word.
            end = at + 1 if at < size else size
            if last[end] is not None or (at + 1 == size):
                continue
            before = end - token[2]
            if before:
                left = last[before]
                if left is None:
                    continue
                pair = left[0] << 20 | token[0]
                stays = apart.get(pair)
                if stays is None:
                    if len(apart) > REMEMBERED_PAIRS:
                        apart.clear()
                    stays = apart[pair] = self.stays_apart(left[1], token[1])
                if not stays:
                    continue
            last[end] = token
        found, end = [], size
        while end:
            token = last[end]
            found.append(token)
            end -= token[2]
        return found[::-1]

    def piece(self, word: str) -> bytes:
        """Ids of one pre-token, four bytes each: the smallest that can be remembered of it."""
        if not word.isascii() or not word.isprintable():
            word = "".join([self.bytes[b] for b in word.encode()])
        return array("i", [t[0] for t in self.tokens(word)]).tobytes()

    def decode(self, ids: list[int]) -> str:
        """The file has no decoder: its tokens are written as they are, a space between them."""
        return " ".join([self.names[i] for i in ids])

    def normalize(self, part: str) -> str:
        """Composed and in lower case, as by the library."""
        if part.isascii():
            return part.lower()
        if (self.odd if self.beyond(part) else self.low_odd)(part):
            from tokenizers import normalizers

            return normalizers.Lowercase().normalize_str(normalizers.NFC().normalize_str(part))
        # The library lowers one character at a time, Python a final sigma by its place.
        return unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()

    def pieces(self, text: str) -> list[bytes]:
        found = []
        for part in self.special_split(text) if self.special_split and any(s in text for s in self.special) else [text]:
            if part in self.special:
                found.append(array("i", [self.special[part]]).tobytes())
                continue
            part = self.normalize(part)
            split = self.split if part.isascii() or not self.beyond(part) else self.split_any
            known = self.known
            for word in split(part):
                piece = known.get(word)
                if piece is None:
                    piece = self.before.get(word) or self.piece(word)
                    if len(word) < 64:
                        known[word] = piece
                    if len(known) > REMEMBERED:  # what is used again moves on from the older half
                        self.before, known = known, {}
                        self.known = known
                found.append(piece)
        return found

    def encode_both(self, text: str) -> tuple[np.ndarray, str]:
        """Ids and decoding of a text."""
        ids = np.frombuffer(b"".join(self.pieces(text)), np.int32)
        return ids, self.decode(ids.tolist())

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.pieces(text)), np.int32).tolist()

    @cached_property
    def decimals(self) -> list[str]:
        """Every id in writing."""
        return [str(i) for i in range(max(self.names) + 1)]

    def digest(self, text: str) -> tuple[int, str, str]:
        ids, decimals = self.encode(text), self.decimals
        return len(ids), hashlib.sha256(" ".join([decimals[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(self.decode(ids).encode()).hexdigest()


@lru_cache(maxsize=2)
def encoder(content: bytes, chars: Characters | None = None) -> Encoder:
    return Encoder(content, chars)


def encode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int), decoded text: one row for each row of `docs`."""
    with open(vocabulary or vocabulary_path(), "rb") as file:
        content, chars = file.read(), characters()

    def run(batches):
        model = encoder(content, chars)
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                both = [model.encode_both(t.as_py() or "") for t in part.column(1)]
                offsets = np.cumsum([0, *(len(ids) for ids, _ in both)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([ids for ids, _ in both])))
                yield pa.record_batch([part.column(0), ids, pa.array([text for _, text in both], pa.string())], names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digest(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text, without moving the ids."""
    with open(vocabulary or vocabulary_path(), "rb") as file:
        content, chars = file.read(), characters()

    def run(batches):
        model = encoder(content, chars)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            counts, ids, texts = [], [], []
            for text in batch.column(1):
                n, of_ids, of_text = model.digest(text.as_py() or "")
                counts.append(n)
                ids.append(of_ids)
                texts.append(of_text)
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digest(table(spark, sf_dir, "documents"))
