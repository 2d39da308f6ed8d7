"""Benchmark decontamination by the q-gram lemma (operator 7).

A passage within k edits of an item of m characters shares at least m - q + 1 - k q of the
item's q-grams with it, on diagonals that differ by k at most. Hits of the items' q-grams
are counted in overlapping bands of 2 (k + 1) diagonals; bands with fewer hits than the bound
cannot hold a match and are dropped, and the regions that remain are verified by banded
alignment. No match within the budget is lost: q is Q, or less for items so short that the
bound would not be positive; items of one q are searched together.

Items of EDITED characters or more may differ by EDIT_RATE of their length. Shorter ones are
found as they are and as whole words only, because a short string within others proves nothing.

Both sides are compared in lower case with runs of white space as one space; results are in
code points of the whole text. The items' different texts are a query set: they are sent to the
tasks in blocks of about ITEM_BLOCK items or ITEM_BLOCK_CHARS characters, each of which is one
pass over the texts. With several blocks, a block's matches are written before the next block
is sent, so no more than one is held at a time. Texts are read in overlapping pieces, and
regions are aligned as many at a time as fit into CELLS cells, so memory is bounded by the
longest item, however many or long the texts are.

Defined results: one row for each text and item that it contains (the match with the fewest
edits, the first of equals); null and empty texts match nothing; items that are null or blank
match nothing; repeated rows of either table give repeated result rows; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, slices, table

Q = 8
#: Edits allowed for each character of an item of EDITED characters or more.
EDIT_RATE, EDITED = 0.1, 30
ITEM_BLOCK, ITEM_BLOCK_CHARS = 20_000, 4_000_000
#: Code points that are searched at a time, over texts joined together.
PIECE = 1 << 20
FILTER_BITS = 22
#: Characters of items and bands that are aligned together.
CELLS = 1 << 20
OUTSIDE = 0x110000


@lru_cache(maxsize=1)
def folding() -> np.ndarray:
    """The lower case of each code point (itself where that is longer), and a space for white space."""
    fold = np.arange(OUTSIDE + 1, dtype=np.uint32)
    for point in range(OUTSIDE):
        shown = chr(point)
        if shown.isspace():
            fold[point] = 32
        elif unicodedata.category(shown)[0] in "LNSM" and len(low := shown.lower()) == 1:
            fold[point] = ord(low)
    return fold


def normalize(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points and their places in the text."""
    points = folding()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    blank = points == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    at = np.flatnonzero(keep)
    return points[at], at


@lru_cache(maxsize=1)
def in_words() -> np.ndarray:
    """Whether each folded code point is a letter, mark or number."""
    return np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(OUTSIDE)] + [False])


def gram_hashes(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of the q code points from each place on."""
    n = max(0, len(points) - q + 1)
    h = np.zeros(n, np.uint64)
    for k in range(q):
        h = (h ^ points[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h * np.uint64(0xD6E8FEB86659FD93)


def trimmed(text: str) -> np.ndarray:
    points = normalize(text)[0]
    points = points[int(len(points) > 0 and points[0] == 32) :]
    return points[: len(points) - int(len(points) > 0 and points[-1] == 32)]


class Index:
    """The items of a block, dealt by q."""

    def __init__(self, items: list[tuple[object, str]]):
        folded = [(item_id, p) for item_id, text in items if len(p := trimmed(text or ""))]
        self.ids = [i for i, _ in folded]
        length = np.array([len(p) for _, p in folded], np.int64)
        self.budget = np.where(length >= EDITED, (length * EDIT_RATE).astype(np.int64), 0)
        q = np.minimum(Q, length // (self.budget + 1))
        self.groups = []
        for some in sorted({(int(x), bool(e)) for x, e in zip(q, length >= EDITED, strict=True)}):
            at = np.flatnonzero((q == some[0]) & ((length >= EDITED) == some[1]))
            self.groups.append(Group([folded[i][1] for i in at.tolist()], self.budget[at], at, *some))

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text its matches (edits, start, end, item), one for each item."""
        best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        if self.groups:
            folded = [(k, *normalize(t)) for k, t in enumerate(texts) if t]
            for group in self.groups:
                group.search(folded, best)
        return [[(*found, item) for item, found in sorted(b.items())] for b in best]


class Group:
    """The q-grams of items with one q, and the places where they stand."""

    def __init__(self, points: list[np.ndarray], budget: np.ndarray, number: np.ndarray, q: int, edited: bool):
        self.points, self.budget, self.number, self.q, self.edited = points, budget, number, q, edited
        self.length = np.array([len(p) for p in self.points], np.int64)
        self.least = self.length - q + 1 - self.budget * q
        self.width = self.budget + 1
        self.longest = int(self.length.max(initial=0))
        widest = int(self.width.max(initial=1))
        self.reach = self.longest + 4 * widest
        # No match reaches over this much foreign text, and matches in two texts are further apart than a band.
        self.gap = widest + q
        grams = [gram_hashes(p, q) for p in self.points]
        every = np.concatenate([np.zeros(0, np.uint64), *grams])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, first, count = np.unique(every[order], return_index=True, return_counts=True)
        self.first, self.count = first.astype(np.int64), count.astype(np.int64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.grams >> np.uint64(64 - FILTER_BITS)] = True

    def regions(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, least diagonal) of the bands that may hold a match; a band has 2 * width diagonals."""
        none = np.zeros(0, np.int64)
        if len(points) < self.q:
            return none, none
        hashes = gram_hashes(points, self.q)
        at = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
        found = np.searchsorted(self.grams, hashes[at])
        found[found == len(self.grams)] = 0
        real = self.grams[found] == hashes[at]
        at, found = at[real], found[real]
        count = self.count[found]
        posting = np.repeat(self.first[found] - np.cumsum(count) + count, count) + np.arange(count.sum())
        item, place = self.item[posting], self.place[posting]
        # Steps of `width` diagonals; a band is two steps, so bands overlap by one.
        step = (np.repeat(at, count) - place + self.longest) // self.width[item]
        steps = len(points) + self.longest + 2
        key = item * steps + step
        # First a count by hash, which can only be too high.
        slots = 1 << max(16, (len(key) // 2).bit_length())
        slot = key & (slots - 1)
        coarse = np.bincount(slot, minlength=slots)
        around = coarse[slot] + np.maximum(coarse[(slot - 1) & (slots - 1)], coarse[(slot + 1) & (slots - 1)])
        some = around >= self.least[item]
        key, place = key[some], place[some]
        if not len(key):
            return none, none
        # Then the number of the item's q-grams that have a hit in the band.
        both = np.concatenate((key, key - 1))
        pairs = np.unique(both * np.int64(self.longest) + np.concatenate((place, place)))
        band, number = np.unique(pairs // self.longest, return_counts=True)
        item = band // steps
        enough = number >= self.least[np.minimum(item, len(self.points) - 1)]
        band, item = band[enough], item[enough]
        return item, (band - item * steps) * self.width[item] - self.longest

    def verify(self, points: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edits, start and end (end exclusive) of the best match in each band; edits over the budget are no match."""
        edits, end = self.align(points, item, diagonal, backward=False)
        good = edits <= self.budget[item]
        start = np.zeros(len(item), np.int64)
        if good.any():
            _, start[good] = self.align(points, item[good], end[good], backward=True)
        return edits, start, end

    def align(self, points: np.ndarray, item: np.ndarray, anchor: np.ndarray, backward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits, and where the match ends, over a band of the matrix of item and text.

        Forward, the match begins anywhere on the band's diagonals. Backward, it is read from its
        known end `anchor` towards its start.
        """
        edits, other = np.empty(len(item), np.int64), np.empty(len(item), np.int64)
        order, a = np.argsort(-self.length[item], kind="stable"), 0
        while a < len(order):  # the longest first, which bounds what is aligned with it
            longest = item[order[a]]
            some = order[a : a + max(1, min(512, CELLS // int(self.length[longest] + 4 * self.width[longest])))]
            edits[some], other[some] = self.align_some(points, item[some], anchor[some], backward)
            a += len(some)
        return edits, other

    def align_some(self, points, item, anchor, backward):
        n, length, budget = len(item), self.length[item], self.budget[item]
        most = int(length.max())
        wide = int((2 * budget + 1).max()) if backward else int((2 * self.width[item] + 2 * budget + 1).max())
        pattern = np.full((n, most), OUTSIDE + 1, np.int64)
        for row, i in enumerate(item.tolist()):
            p = self.points[i]
            pattern[row, : len(p)] = p[::-1] if backward else p
        # Column c of row i stands for the text place base + i + c (or its mirror image).
        base = -budget if backward else anchor - budget
        column = np.arange(wide)
        far = np.int64(1 << 30)
        if backward:
            state = np.where(base[:, None] + column >= 0, np.abs(base[:, None] + column), far)
        else:
            state = np.zeros((n, wide), np.int64)
        best = np.where(length == 0, 0, far)
        where = np.zeros(n, np.int64)
        for i in range(most):
            place = base[:, None] + i + column
            real = anchor[:, None] - 1 - place if backward else place
            inside = (real >= 0) & (real < len(points)) & (place >= 0 if backward else True)
            shown = np.where(inside, points[np.clip(real, 0, len(points) - 1)], OUTSIDE)
            through = state + (shown != pattern[:, i : i + 1])
            skip = np.append(state[:, 1:], np.full((n, 1), far), axis=1) + 1  # a character of the item is missing
            through = np.minimum(through, skip)
            state = np.minimum.accumulate(through - column, axis=1) + column  # further characters in the text
            done = length == i + 1
            if done.any():
                rows = np.flatnonzero(done)
                best[rows] = state[rows].min(axis=1)
                c = state[rows].argmin(axis=1)
                after = base[rows] + i + 1 + c
                where[rows] = anchor[rows] - after if backward else after
        return best, np.clip(where, 0, len(points))

    def matches(self, points: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(edits, start, end, item) of every region within its item's budget."""
        item, diagonal = self.regions(points)
        if not len(item):
            return []
        edits, start, end = self.verify(points, item, diagonal)
        good = edits <= self.budget[item]
        if not self.edited:  # nothing of a word goes on beyond either end
            word = np.append(in_words()[points], False)
            good &= ~(word[start - 1] & word[start]) & ~(word[end - 1] & word[end])
        good = np.flatnonzero(good)
        return [(int(edits[i]), int(start[i]), int(end[i]), int(self.number[item[i]])) for i in good]

    def search(self, texts: list[tuple[int, np.ndarray, np.ndarray]], best: list[dict[int, tuple[int, int, int]]]) -> None:
        """Put the matches of folded texts (number, points, places) into `best`."""
        pieces, total = [], 0

        def flush():
            if not pieces:
                return
            gap = np.full(self.gap, OUTSIDE, np.uint32)
            joined = np.concatenate([x for p in pieces for x in (p[1], gap)])
            starts = np.cumsum([0, *(len(p[1]) + len(gap) for p in pieces)])
            for edits, start, end, item in self.matches(joined):
                k = int(np.searchsorted(starts, min(start, len(joined) - 1), "right")) - 1
                text, _, at = pieces[k]
                first, last = start - starts[k], min(end - starts[k], len(at))
                if first >= last:
                    continue
                found = (edits, int(at[first]), int(at[last - 1]) + 1)
                if item not in best[text] or found < best[text][item]:
                    best[text][item] = found

        for k, points, at in texts:
            for a in range(0, max(1, len(points) - self.reach), PIECE):
                some = slice(max(0, a - 1), a + PIECE + self.reach)  # with the character before
                pieces.append((k, points[some], at[some]))
                total += len(points[some]) + self.gap
                if total >= PIECE:
                    flush()
                    pieces, total = [], 0
        flush()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", item_block: int = ITEM_BLOCK) -> DataFrame:
    """doc_id, item_id, start, end, edits: one row for each text and item that it contains."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    items = items.select("item_id", "text", F.sha2("text", 256).alias("key"))
    # Items with the same text are searched once, and told apart again at the end.
    distinct = items.groupBy("key").agg(F.first("text").alias("text"))
    size = distinct.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = max(1, -(-size.n // item_block), -(-size.chars // ITEM_BLOCK_CHARS))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for block in range(blocks):
        some = distinct.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast([(r.key, r.text) for r in some])
        part = rows.mapInArrow(searcher(shared), "doc_id long, key string, start long, end long, edits long")
        if blocks > 1:
            part = materialize(part, "decontaminate-matches")
            shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found.join(items.select("key", "item_id"), "key").select("doc_id", "item_id", "start", "end", "edits")


def searcher(shared):
    def run(batches):
        index = Index(shared.value)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        for batch in (part for whole in batches for part in slices(whole, 1, rows=2048)):
            searched = zip(batch.column(0).to_pylist(), index.search(batch.column(1).to_pylist()), strict=True)
            out = [(doc_id, index.ids[item], start, end, edits) for doc_id, found in searched for edits, start, end, item in found]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["doc_id", "key", "start", "end", "edits"])

    return run


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
