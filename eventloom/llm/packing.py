"""Packed token ids (operator 9).

Texts are encoded with a byte-level vocabulary; documents longer than a row are split into
pieces of a row's width, losslessly. All pieces of a table are packed together by best-fit
decreasing: the longest first, each into the open row with the smallest sufficient room, which
a segment tree over capacities finds in logarithmic time.

Pieces of one length are interchangeable, so the packing is planned on the driver from the
number of pieces of each length (WIDTH numbers at most): a step of the plan puts runs of equal
pieces into runs of equally full rows. Each piece then finds its own place: pieces of a length
are dealt by hash into groups of about GROUP_PIECES, their order in the group and the sizes of
the groups before give its number among the pieces of its length, and the plan gives the row and
the place in it. Rows are then put together by row number. Neither the number of rows nor
what is in them depends on how the input is partitioned, and no task holds a length or a row set.

A result row is a row of the id matrix (WIDTH little-endian 32-bit ids, padded with PAD),
the cumulative segment lengths, the places where positions start again, and for each segment
its document and its first token's place in it. `write_binary` puts them into binary files.

Defined results: null and empty texts have no tokens and are in no row; repeated rows are
packed repeatedly; a null doc_id stays null; an empty table gives an empty result; columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import json
import os
import uuid
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import vocabulary_path
from .common import materialize, slices, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: The splitting pattern that belongs to the vocabulary: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WIDTH = 2048
#: An id that the vocabulary leaves free.
PAD = 50256
#: Pieces of one length that are numbered together; one number for each such group reaches the driver.
GROUP_PIECES = 10_000
#: Rows that a task puts together at a time.
ROWS = 128

#: A step of the plan: the pieces of a length from `first` on go into rows from `row` on, `each`
#: of them into a row, from token `at` of the row on.
Step = tuple[int, int, int, int]


class Capacities:
    """A segment tree over capacities; each leaf counts the open rows with that much room."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def least(self, size: int) -> int | None:
        """The smallest capacity of `size` or more that an open row has."""
        node = size + self.leaves
        if self.count[node]:
            return size
        while node > 1 and (node & 1 or not self.count[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(counts: dict[int, int], width: int) -> tuple[dict[int, list[Step]], int]:
    """The steps for each length, and the number of rows: best-fit decreasing on counted lengths.

    A piece goes into the smallest sufficient room; if what is left takes another piece of its
    length, that is now the smallest. So a row takes as many as fit before the next row does, and
    all rows with the same room are alike.
    """
    tree, rows = Capacities(width), 0
    open_rows: dict[int, list[tuple[int, int]]] = {}  # room -> runs of rows (first, number)
    steps: dict[int, list[Step]] = {}

    def leave(room: int, first: int, number: int) -> None:
        if room and number:
            open_rows.setdefault(room, []).append((first, number))
            tree.add(room, number)

    for size in sorted(counts, reverse=True):
        left, found = counts[size], []
        while left:
            room = tree.least(size)
            if room is None:
                room = width
                first, number = rows, -(-left // (width // size))
                rows += number
            else:
                first, number = open_rows[room].pop()
                tree.add(room, -number)
            each = room // size
            full = min(number, left // each)
            found.append((counts[size] - left, first, each, width - room))
            left -= full * each
            leave(room - each * size, first, full)
            if left and full < number:  # the last row is not filled up
                leave(room - left * size, first + full, 1)
                full, left = full + 1, 0
            leave(room, first + full, number - full)
        steps[size] = found
    return steps, rows


@lru_cache(maxsize=2)
def encoder(content: bytes):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(docs: DataFrame, content: bytes, width: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, at, size and ids (compressed) of each piece."""

    def run(batches):
        from zstandard import ZstdCompressor

        model, squeeze = encoder(content), ZstdCompressor(level=1).compress
        for batch in (part for whole in batches for part in slices(whole, 1)):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array(model.encode_ordinary(text.as_py() or ""), "<u4")
                for at in range(0, len(ids), width):
                    some = ids[at : at + width]
                    narrow = some.astype("<u2") if some.max() < 1 << 16 else some
                    out.append((doc_id, at, len(some), squeeze(narrow.tobytes())))
            yield as_batch(out, {"doc_id": pa.int64(), "at": pa.int64(), "size": pa.int32(), "ids": pa.binary()})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, at long, size int, ids binary")


def as_batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], names=list(kinds))


def placed(cut: DataFrame, width: int, group_pieces: int) -> DataFrame:
    """The pieces with row_id and start, their place in the packing."""
    spark = cut.sparkSession
    counts = {r[0]: r[1] for r in cut.groupBy("size").count().collect()}  # `width` rows at most
    steps, _ = best_fit(counts, width)
    parts = spark.createDataFrame([(s, -(-n // group_pieces)) for s, n in counts.items()] or [(0, 1)], "of int, parts long")
    key = F.xxhash64("doc_id", "at", "ids")
    dealt = cut.withColumn("key", key).join(F.broadcast(parts), F.col("size") == F.col("of")).withColumn("part", F.pmod("key", "parts")).drop("of", "parts")
    groups = dealt.groupBy("size", "part").count().toArrow()  # one row of three numbers for each group
    size, part, n = (groups[k].to_numpy() for k in range(3))
    before = {s: np.zeros(-(-c // group_pieces), np.int64) for s, c in counts.items()}
    for s, c in before.items():
        own = size == s
        c[part[own]] = n[own]
        c[:] = np.cumsum(c) - c
    shared = spark.sparkContext.broadcast((before, steps))

    def number(batches):
        offsets, plan = shared.value
        group, rank = None, 0
        for batch in batches:
            rows, starts = [], []
            for size, part in zip(batch.column("size").to_pylist(), batch.column("part").to_pylist(), strict=True):
                if (size, part) != group:
                    group, rank = (size, part), int(offsets[size][part])
                first, row, each, at = plan[size][bisect_right(plan[size], (rank, 1 << 62)) - 1]
                rows.append(row + (rank - first) // each)
                starts.append(at + (rank - first) % each * size)
                rank += 1
            columns = [pa.array(rows, pa.int64()), pa.array(starts, pa.int32())]
            yield pa.record_batch([*columns, *(batch.column(c) for c in ("doc_id", "at", "size", "ids"))], names=["row_id", "start", "doc_id", "at", "size", "ids"])

    grouped = dealt.repartition("size", "part").sortWithinPartitions("size", "part", "key", "doc_id", "at")
    return grouped.mapInArrow(number, "row_id long, start int, doc_id long, at long, size int, ids binary")


PACKED = "row_id long, ids binary, cu_seqlens array<int>, resets array<int>, doc_ids array<long>, offsets array<long>"


def assembler(width: int):
    """Pieces in the order of rows and places -> packed rows."""
    kinds = {"row_id": pa.int64(), "ids": pa.binary(), "cu_seqlens": pa.list_(pa.int32()), "resets": pa.list_(pa.int32()), "doc_ids": pa.list_(pa.int64()), "offsets": pa.list_(pa.int64())}

    def run(batches):
        from zstandard import ZstdDecompressor

        loosen = ZstdDecompressor().decompress
        made, row, held = [], None, []

        def finished():
            line, ends = np.full(width, PAD, "<i4"), [0]
            for size, ids, *_ in held:
                raw = loosen(ids)
                line[ends[-1] : ends[-1] + size] = np.frombuffer(raw, "<u2" if len(raw) == 2 * size else "<u4")
                ends.append(ends[-1] + size)
            return row, line.tobytes(), ends, ends[:-1], [h[2] for h in held], [h[3] for h in held]

        for batch in batches:
            for row_id, doc_id, at, size, ids in zip(*(batch.column(c).to_pylist() for c in ("row_id", "doc_id", "at", "size")), batch.column("ids"), strict=True):
                if row_id != row:
                    if held:
                        made.append(finished())
                        if len(made) == ROWS:
                            yield as_batch(made, kinds)
                            made = []
                    row, held = row_id, []
                held.append((size, ids.as_py(), doc_id, at))
        if held:
            made.append(finished())
        yield as_batch(made, kinds)

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """row_id, ids (binary), cu_seqlens, resets, doc_ids and offsets of each packed row."""
    with open(vocabulary or vocabulary_path(VOCABULARY), "rb") as file:
        content = file.read()
    cut = materialize(pieces(docs, content, width, id_col, text_col), "packing-pieces")
    found = placed(cut, width, group_pieces)
    # A piece as wide as a row is a row already; the others are moved to their rows.
    whole = found.filter(F.col("size") == width).mapInArrow(assembler(width), PACKED)
    rest = found.filter(F.col("size") < width).repartition("row_id").sortWithinPartitions("row_id", "start")
    return whole.unionByName(rest.mapInArrow(assembler(width), PACKED))


def write_binary(packed: DataFrame, folder: str) -> dict:
    """Write packed rows into `folder`, on a file system that driver and executors share.

    Each task writes `<name>.ids` (rows of 32-bit ids), `<name>.cu` and `<name>.resets` (32-bit
    integers, of one row after the other) and `<name>.segments` (a 32-bit number of segments for each row). index.json
    names the files of the tasks that ended well, in order: what a lost task has left behind is in none.
    """
    os.makedirs(folder, exist_ok=True)

    def run(batches):
        name, rows, tokens = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", 0, 0
        files = {kind: open(f"{folder}/{name}.{kind}", "wb") for kind in ("ids", "cu", "resets", "segments")}  # noqa: SIM115
        try:
            for batch in batches:
                for ids, cu, resets in zip(*(batch.column(c) for c in ("ids", "cu_seqlens", "resets")), strict=True):
                    cu, resets = np.array(cu.as_py(), "<i4"), np.array(resets.as_py(), "<i4")
                    files["ids"].write(ids.as_py())
                    files["cu"].write(cu.tobytes())
                    files["resets"].write(resets.tobytes())
                    files["segments"].write(np.array([len(resets)], "<i4").tobytes())
                    rows, tokens = rows + 1, tokens + int(cu[-1])
            for file in files.values():
                file.flush()
                os.fsync(file.fileno())
        finally:
            for file in files.values():
                file.close()
        yield pa.record_batch([[name], [rows], [tokens]], names=["name", "rows", "tokens"])

    done = [r.asDict() for r in packed.mapInArrow(run, "name string, rows long, tokens long").collect()]
    index = {"files": sorted((d for d in done if d["rows"]), key=lambda d: d["name"]), "rows": sum(d["rows"] for d in done), "tokens": sum(d["tokens"] for d in done)}
    draft = f"{folder}/.index.json.{uuid.uuid4().hex}"
    with open(draft, "w", encoding="utf-8") as file:
        json.dump(index, file)
    os.replace(draft, f"{folder}/index.json")
    return index


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
