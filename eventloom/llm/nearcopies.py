"""Groups of near copies by the Jaccard similarity of word shingles (the pipeline's near-dedup stage).

Two texts are linked if the sets of their SHINGLE-word shingles have a Jaccard similarity of
SIMILARITY or more; a component is what links connect.

Groups: texts with one set are one node. The method is that of `simhash`: a node's fingerprint
is the majority bits of its shingles' hashes, WORDS times 64 of them; fingerprints are compared
bit-sliced in buckets, those that differ in RADIUS bits or fewer are linked, and star contraction
makes the links' components the groups. A bit differs with a chance of 0.1875 at most at the
similarity (four shingles and one more; near 0.15 for long texts), so a pair at the similarity is
beyond the radius with a chance below 1e-7. Its buckets are pairs of blocks of the fingerprint's
first word, as in `simhash`, which two texts share for certain if that word differs in four bits
or fewer, and, for all other pairs, BANDS groups of BAND_ROWS min-hashes, of which a pair at the
similarity shares none with a chance below 1e-7, and less above it.

Check: the sets of a group's nodes are compared exactly. Starting at a node, the nodes
linked to it are found by counting common shingles, then the nodes linked to those, until all
nodes are reached or have been started at; so the links that leave a task connect all that
should be, and their number grows with the nodes. A group of more than BLOCK_SHINGLES shingles
is dealt out in blocks, and every two blocks are compared in a task: no group is cut.

Defined results: texts without words are copies of each other, texts of fewer words than a
shingle are one shingle; words are compared as ASCII lower case; rows with a null doc_id have
no component; repeated rows give repeated result rows; rows that share a doc_id but not the text
are nodes of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices
from .simhash import BUCKET_ROWS, components, first_masks, links_in_buckets, signed, wide_fingerprint

SEED = 42
SHINGLE = 5
SIMILARITY = Fraction(4, 5)
#: 64-bit words of a fingerprint, and the differing bits of two that are linked.
WORDS, RADIUS = 4, 84
BANDS, BAND_ROWS = 32, 4
#: Shingles of a block of a large group.
BLOCK_SHINGLES = 1_000_000
#: Shingles whose min-hashes are taken at a time.
CHUNK = 1 << 12
#: Ids (two longs each) are broadcast up to this number, 8 MB.
BROADCAST_IDS = 500_000

MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """The set of XXH64 values of a text's shingles, sorted."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if len(words) <= SHINGLE:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - SHINGLE + 1].tolist()
    return np.unique(np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)], np.uint64))


def key_of(values: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return signed(xxh64_intdigest(values.tobytes(), SEED))


def bands(values: np.ndarray) -> list[int]:
    """A hash of each band's min-hashes; none for an empty set."""
    from xxhash import xxh64_intdigest

    if not len(values):
        return []
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), CHUNK):
        least = np.minimum(least, (values[at : at + CHUNK, None] * MULTIPLIERS).min(axis=0))
    return [signed(xxh64_intdigest(band.tobytes(), k)) for k, band in enumerate(least.reshape(BANDS, BAND_ROWS))]


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, row, key of the set, number of shingles, fingerprint and bands, one row for each row of `docs` (doc_id, text, row)."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            found = [(key_of(v), len(v), wide_fingerprint(v, WORDS), bands(v)) for v in (shingles(t.as_py()) for t in batch.column(1))]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2))]
            yield pa.record_batch([batch.column(0), batch.column(2), *columns], names=["doc_id", "row", "key", "n", "fp", "bands"])

    return docs.mapInArrow(run, "doc_id long, row long, key long, n long, fp array<long>, bands array<long>")


def linked(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between places in `sets` that connect what the similarity connects."""
    sizes = np.array([len(s) for s in sets], np.int64)
    values, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(number, kind="stable")
    posting = owner[order]
    first = np.searchsorted(number[order], np.arange(len(values) + 1))
    own = np.split(number, np.cumsum(sizes)[:-1])
    found: list[tuple[int, int]] = []
    fresh = np.ones(len(sets), bool)
    for start in range(len(sets)):
        if not fresh[start]:
            continue
        fresh[start] = False
        queue = [start]
        while queue and fresh.any():
            at = queue.pop()
            # Rare shingles come one by one; `posting` of each is a run.
            begin, count = first[own[at]], first[own[at] + 1] - first[own[at]]
            places = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
            common = np.bincount(posting[places], minlength=len(sets))
            both = sizes + sizes[at] - common
            near = np.flatnonzero(fresh & (common * SIMILARITY.denominator >= both * SIMILARITY.numerator)).tolist()
            fresh[near] = False
            queue += near
            found += [(at, b) for b in near]
    return found


def link_cells(batches):
    """Rows (cell, key, values) sorted by cell -> links u > v between keys."""

    def links(keys, sets):
        return [(max(keys[a], keys[b]), min(keys[a], keys[b])) for a, b in linked(sets)] if len(keys) > 1 else []

    cell, keys, sets = None, [], []
    for batch in batches:
        out = []
        for c, key, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if c != cell:
                out += links(keys, sets)
                cell, keys, sets = c, [], []
            if not keys or keys[-1] != key:  # else a repeated row
                keys.append(key)
                sets.append(values.values.to_numpy().view(np.uint64))
        yield as_batch(out)
    yield as_batch(links(keys, sets))


def as_batch(links):
    return pa.record_batch([pa.array([k[i] for k in links], pa.int64()) for i in (0, 1)], names=["u", "v"])


def sets_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """key, group, k and the set's values for each of `members`."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            rows = [shingles(t.as_py()) for t in batch.column(1)]
            # A doc_id may have several texts: only that of the key is the node.
            same = [i for i, key in enumerate(batch.column(2).to_pylist()) if key_of(rows[i]) == key]
            values = pa.array([rows[i].view(np.int64) for i in same], pa.list_(pa.int64()))
            yield pa.record_batch([*(batch.column(k).take(pa.array(same, pa.int64())) for k in (2, 3, 4)), values], names=["key", "group", "k", "values"])

    wanted = F.broadcast(members) if members.count() <= BROADCAST_IDS else members
    rows = docs.join(wanted, F.col("doc_id") == F.col("rep")).select("rep", "text", "key", "group", "k")
    return rows.mapInArrow(run, "key long, group long, k int, values array<long>")


def near_fingerprints(distinct: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links u > v between keys that connect all fingerprints that share a bucket and are within the radius."""
    blocks = F.transform(F.array(*map(F.lit, first_masks())), lambda mask: F.xxhash64(mask, F.col("fp")[0].bitwiseAND(mask)))
    words = [F.col("fp")[k].alias(f"fp_{k}") for k in range(WORDS)]
    return links_in_buckets(distinct.select(F.explode(F.concat("bands", blocks)).alias("bucket"), F.col("key").alias("node"), *words), radius, bucket_rows)


def links(docs: DataFrame, distinct: DataFrame, block_shingles: int = BLOCK_SHINGLES, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links u > v between keys that connect all sets within the similarity."""
    stars = components(near_fingerprints(distinct, radius, bucket_rows))
    nodes = materialize(stars.unionByName(stars.select(F.col("root").alias("node"), "root")).distinct(), "nearcopies-groups")
    nodes = distinct.select("rep", "key", "n").join(nodes, F.col("key") == F.col("node")).select("rep", "key", "n", F.col("root").alias("group"))
    blocks = nodes.groupBy("group").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("k"))
    members = materialize(nodes.join(blocks, "group").select("rep", "key", "group", "k"), "nearcopies-members")
    # Blocks i < j of a group meet in cell (i, j); a group of one block is a cell.
    own = F.pmod(F.xxhash64("key"), F.col("k")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("k") - 1), lambda j: j != F.col("own"))
    cells = F.when(F.col("k") == 1, F.array(F.lit(0))).otherwise(F.transform(others, lambda j: F.least(j, F.col("own")) * F.col("k") + F.greatest(j, F.col("own"))))
    dealt = sets_of(docs, members).withColumn("own", own).select("key", "values", "group", F.explode(cells).alias("part"))
    dealt = dealt.select(F.struct("group", "part").alias("cell"), "key", "values")
    return dealt.repartition("cell").sortWithinPartitions("cell", "key").mapInArrow(link_cells, "u long, v long")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_shingles: int = BLOCK_SHINGLES, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, row (a hash of the text) and component_id (the smallest doc_id reachable) for each row of `docs`."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(sketches(texts.withColumn("row", F.xxhash64("text"))), "nearcopies-rows")
    distinct = rows.filter("doc_id IS NOT NULL").groupBy("key").agg(F.min(F.struct("doc_id", "n")).alias("at"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    distinct = materialize(distinct.select("key", F.col("at.doc_id").alias("rep"), F.col("at.n").alias("n"), "fp", "bands"), "nearcopies-distinct")
    stars = components(links(texts, distinct, block_shingles, radius, bucket_rows))
    classes = distinct.join(stars, F.col("key") == F.col("node"), "left").select("key", "rep", F.coalesce("root", "key").alias("class"))
    least = classes.groupBy("class").agg(F.min("rep").alias("component_id"))
    joined = rows.select("doc_id", "row", "key").join(classes.join(least, "class").select("key", "component_id"), "key", "left")
    return joined.select("doc_id", "row", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
