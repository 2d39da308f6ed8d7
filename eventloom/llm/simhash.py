"""SimHash near-duplicates by bit-sliced comparison (operator 4).

Fingerprints are 64 majority bits over the hashes of word shingles. Two texts are linked if
their fingerprints differ in RADIUS bits or fewer; a component is what links connect.

Candidates: the 64 bits form six blocks; at most four differing bits leave two blocks equal,
so each distinct fingerprint goes to the 15 buckets given by a pair of blocks. A bucket with
more than BUCKET_ROWS fingerprints is divided again by the same argument on its remaining
bits (five blocks, one of which is equal), as often as needed: no bucket is cut short.

Comparison: a run of buckets is stored as bit planes, one machine word for 64 fingerprints.
Each plane is compared with itself shifted by d rows, carry-save counters of three bits add
up the differences of all rows at once, and the shift ends when every row has exceeded the
radius. Only the links that connect something new inside a bucket leave the task, so their
number grows with the rows and not with the pairs; buckets whose rows are all connected are
left early.

Wider fingerprints (`wide_fingerprint`) and radii are compared in the same way in the buckets
that a caller names (`links_in_buckets`): a radius of a third of the bits leaves no block equal
for certain, so the blocks' buckets are joined by others, and a bucket with more than
BUCKET_ROWS nodes is dealt out in blocks, every two of which are compared.

Components come from alternating large-star and small-star steps on the links between
representatives (the smallest doc_id of each fingerprint), written to the shared folder.

Defined results: null and blank texts have fingerprint zero and are linked like any other;
rows with a null doc_id get a fingerprint and no component; repeated rows give repeated
result rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize, slices, table

SEED = 42
RADIUS = 4
BLOCKS, EQUAL_BLOCKS = 6, 2
#: Rows of a bucket that one task compares; larger buckets are divided by further bits.
BUCKET_ROWS = 20_000
#: Rows whose buckets are compared together.
RUN_ROWS = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Majority bits of the XXH64 (seed 42) of lower-cased word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        some = np.array(hashes[at : at + (1 << 14)], "<u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def mixed(values: np.ndarray) -> np.ndarray:
    """The values as SplitMix64 mixes them."""
    values = values + np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def wide_fingerprint(hashes: np.ndarray, words: int) -> list[int]:
    """Majority bits of the hashes, then of the hashes mixed once, twice and so on, as signed longs."""
    counts = np.zeros(64 * words, np.int64)
    for at in range(0, len(hashes), 255):  # sums of 255 bits fit a byte
        columns = [hashes[at : at + 255]]
        while len(columns) < words:
            columns.append(mixed(columns[-1]))
        some = np.stack(columns, axis=1).astype("<u8", copy=False)
        counts += np.unpackbits(some.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8").tolist()


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long), one row for each row of `docs`."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            fps = [signed(fingerprint(t.as_py(), shingle)) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def split_bits(bits: list[int], parts: int) -> list[int]:
    """Masks of `parts` nearly equal runs of the bits."""
    return [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(bits), parts)]


def first_masks() -> list[int]:
    return [signed(a | b) for a, b in combinations(split_bits(list(range(64)), BLOCKS), EQUAL_BLOCKS)]


def next_masks(mask: int) -> list[int]:
    """The mask with one of RADIUS + 1 blocks of its remaining bits added."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [signed((mask & (1 << 64) - 1) | m) for m in split_bits(rest, RADIUS + 1)]


def planes_of(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes, least significant row first, 64 rows to a word, with a spare word at the end.

    Bit 64 * w + b of a wide fingerprint is bit b of column w.
    """
    words = len(fps) // 64 + 2
    fps = fps[:, None] if fps.ndim == 1 else fps
    out = np.zeros((len(bits), words), "<u8")
    for k, bit in enumerate(bits):
        packed = np.packbits((fps[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1)).astype(np.uint8), bitorder="little")
        out[k].view(np.uint8)[: len(packed)] = packed
    return out


def within_radius(planes: np.ndarray, by: int, wanted: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Bit set for each wanted row i that differs from row i + by in `radius` bits or fewer.

    The counters (carry-save, a bit each) begin so that difference `radius` + 1 carries out of
    the last of them; `over` holds the rows beyond the radius, and words in which every row is
    over are not looked at again.
    """
    live = np.flatnonzero(wanted)
    words, bits = divmod(by, 64)
    begin = (1 << radius.bit_length()) - 1 - radius
    counters = [np.full(len(live), 0xFFFFFFFFFFFFFFFF if begin >> c & 1 else 0, np.uint64) for c in range(radius.bit_length())]
    over = ~wanted[live]
    size = planes.shape[1]
    low, high = np.minimum(live + words, size - 1), np.minimum(live + words + 1, size - 1)
    for k in range(len(planes)):
        plane = planes[k]
        other = plane[low]
        if bits:
            other = other >> np.uint64(bits) | plane[high] << np.uint64(64 - bits)
        carry = plane[live] ^ other
        for c, counter in enumerate(counters):
            counters[c], carry = counter ^ carry, counter & carry
        over = over | carry
        if k % 8 == 7:
            open_words = over != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not open_words.all():
                live, low, high, over = live[open_words], low[open_words], high[open_words], over[open_words]
                counters = [counter[open_words] for counter in counters]
                if not len(live):
                    break
    out = np.zeros(size, np.uint64)
    out[live] = ~over
    return out


def bits_of(flags: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words, "<u8")
    packed = np.packbits(flags, bitorder="little")
    out.view(np.uint8)[: len(packed)] = packed
    return out


def links_of_run(fps: np.ndarray, reps: np.ndarray, bucket: np.ndarray, bits: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect the rows of each bucket; `bucket` numbers the sorted rows' buckets."""
    found: list[tuple[int, int]] = []
    parent = np.arange(len(fps))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    rows, by = np.arange(len(fps)), 1
    planes = planes_of(fps, bits)
    refresh = 2
    while len(rows) > by:
        own = bucket[rows]
        same = np.zeros(len(rows), np.uint8)
        same[:-by] = own[:-by] == own[by:]
        if not same.any():
            break
        heads = parent[rows]
        same[:-by] &= heads[:-by] != heads[by:]  # what is connected need not be compared
        hit = within_radius(planes, by, bits_of(same, planes.shape[1]), radius)
        for i in np.flatnonzero(np.unpackbits(hit.view(np.uint8), bitorder="little")[: len(rows)]).tolist():
            a, b = root(rows[i]), root(rows[i + by])
            if a != b:
                parent[max(a, b)] = min(a, b)
                x, y = int(reps[rows[i]]), int(reps[rows[i + by]])
                found.append((max(x, y), min(x, y)))
        by += 1
        if by == refresh:  # leave buckets that are connected or too small for larger shifts
            refresh *= 2
            for _ in range(64):
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            sizes = np.diff(np.append(first, len(rows)))
            roots = parent[rows]
            one = np.minimum.reduceat(roots, first) == np.maximum.reduceat(roots, first)
            stay = np.repeat((sizes > by) & ~one, sizes)
            if not stay.all():
                rows = rows[stay]
                planes = planes_of(fps[rows], bits)
    return found


def link_buckets(batches):
    """Rows (mask, fp, rep) sorted by mask and bucket -> links, a run of whole buckets at a time."""
    held: list[np.ndarray] = []

    def flush(mask, fps, reps, last: bool):
        """Links of the rows' whole buckets, and the rows of an unfinished last bucket."""
        out: list[tuple[int, int]] = []
        keys = fps & mask
        change = np.append(True, (mask[1:] != mask[:-1]) | (keys[1:] != keys[:-1])) if len(mask) else np.zeros(0, bool)
        number = np.cumsum(change)
        stop = len(mask) if last else int(np.flatnonzero(change)[-1]) if len(mask) else 0
        edges = [0, *(np.flatnonzero(mask[1:stop] != mask[: max(stop - 1, 0)]) + 1).tolist(), stop]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a > 1:
                bits = [x for x in range(64) if not int(mask[a]) >> x & 1]
                out += links_of_run(fps[a:b], reps[a:b], number[a:b], bits)
        return out, (mask[stop:], fps[stop:], reps[stop:])

    def as_batch(links):
        x, y = ([k[i] for k in links] for i in (0, 1))
        return pa.record_batch([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["u", "v"])

    rest = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        held.append((columns[0].view(np.uint64), columns[1].view(np.uint64), columns[2]))
        if sum(len(h[0]) for h in held) >= RUN_ROWS:
            links, rest = flush(*(np.concatenate(c) for c in zip(rest, *held, strict=True)), last=False)
            held = []
            yield as_batch(links)
    links, _ = flush(*(np.concatenate(c) for c in zip(rest, *held, strict=True)), last=True)
    yield as_batch(links)


def link_runs(batches, radius: int):
    """Rows (bucket, node, fingerprint's words) sorted by bucket -> links, a run of whole buckets at a time."""
    held: list[np.ndarray] = []
    rest, size = None, 0

    def links(rows):
        """Links of rows whose buckets have others."""
        change = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
        sizes = np.diff(np.append(change, len(rows)))
        number = np.repeat(np.arange(len(sizes)), sizes)
        some = np.repeat(sizes > 1, sizes)
        rows, number = rows[some], number[some]
        fps = np.asfortranarray(rows[:, 2:]).view(np.uint64)
        found = links_of_run(fps, rows[:, 1], number, list(range(64 * fps.shape[1])), radius) if len(rows) else []
        return pa.record_batch([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    for batch in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1))
        size += batch.num_rows
        if size >= RUN_ROWS:
            rows = np.concatenate(held if rest is None else [rest, *held])
            stop = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            rest, held, size = rows[stop:], [], 0
            if stop:
                yield links(rows[:stop])
    if rest is not None:
        held.insert(0, rest)
    if held:
        yield links(np.concatenate(held))


def links_in_buckets(entries: DataFrame, radius: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links u > v between nodes that connect all that share a bucket and differ in `radius` bits or fewer.

    `entries` has bucket, node and the words of the fingerprint, all longs.
    """
    words = [c for c in entries.columns if c not in ("bucket", "node")]
    entries = entries.select("bucket", "node", *words)
    k = F.ceil(F.col("count") / bucket_rows).cast("int").alias("k")
    large = materialize(entries.groupBy("bucket").count().filter(F.col("count") > bucket_rows).select(F.col("bucket").alias("of"), k), "simhash-large")
    n_large = large.count()
    if n_large:
        # Blocks i < j of a large bucket meet in cell (i, j), a bucket of its own.
        rows = entries.join(F.broadcast(large) if n_large <= BROADCAST_ROWS else large, F.col("bucket") == F.col("of"), "left")
        own = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
        others = F.filter(F.sequence(F.lit(0), F.col("k") - 1), lambda j: j != own)
        cells = F.transform(others, lambda j: F.xxhash64("bucket", F.least(j, own), F.greatest(j, own)))
        entries = rows.select(F.explode(F.when(F.col("k").isNull(), F.array("bucket")).otherwise(cells)).alias("bucket"), "node", *words)
    dealt = entries.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda batches: link_runs(batches, radius), "u long, v long")


def compare(candidates: DataFrame) -> DataFrame:
    key = F.col("fp").bitwiseAND(F.col("mask"))
    return candidates.repartition(F.col("mask"), key).sortWithinPartitions("mask", key).mapInArrow(link_buckets, "u long, v long")


def links(distinct: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links u > v between representatives that connect all fingerprints within the radius."""
    candidates = distinct.select(F.explode(F.array(*map(F.lit, first_masks()))).alias("mask"), "fp", "rep")
    found = None
    while True:
        key = F.col("fp").bitwiseAND(F.col("mask")).alias("key")
        large = materialize(candidates.groupBy("mask", key).count().filter(F.col("count") > bucket_rows).select("mask", "key"), "simhash-large")
        n_large = large.count()
        if n_large:
            on = (F.col("mask") == F.col("l_mask")) & (F.col("fp").bitwiseAND(F.col("mask")) == F.col("l_key"))
            large = large.select(F.col("mask").alias("l_mask"), F.col("key").alias("l_key"))
            large = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
            some = compare(candidates.join(large, on, "left_anti"))
        else:
            some = compare(candidates)
        found = some if found is None else found.unionByName(some)
        if not n_large:
            return found
        # A bucket's masks are 15 at first and five times as many at each level.
        masks = [r[0] for r in large.select("l_mask").distinct().collect()]
        further = F.create_map(*(x for m in masks for x in (F.lit(m), F.array(*map(F.lit, next_masks(m))))))
        candidates = candidates.join(large, on, "left_semi").select(F.explode(further[F.col("mask")]).alias("mask"), "fp", "rep")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that links reach, for every node of a link but roots."""
    edges = materialize(edges.filter("u <> v").distinct(), "simhash-links")
    state = None
    while True:
        # Large star: what is larger than a node hangs on the smallest of its neighbours and itself.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours hang on the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "simhash-stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_distinct("u")).first()
        if now[0] == now[2] and now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def near_duplicates(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) for each row of `docs`."""
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash-rows")
    distinct = materialize(rows.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    stars = components(links(distinct, bucket_rows))
    classes = distinct.join(stars, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    joined = rows.join(classes, "fp", "left")
    return joined.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# The primes of XXH64.
PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)


def op4_sql() -> str:
    """The same rows in plain SQL: XXH64 in unsigned arithmetic of 128 bits, all pairs of fingerprints, recursion."""
    p1, p2, p3, p4, p5 = PRIMES

    def big(n: int) -> str:
        return f"{n % (1 << 64)}::UHUGEINT"

    def wrap(expression: str) -> str:
        return f"(({expression}) % {1 << 64}::UHUGEINT)"

    def times(a: str, n: int) -> str:
        return wrap(f"({a}) * {big(n)}")

    def turned(x: str, by: int) -> str:
        return f"({times(x, 1 << by)} + {x} // {big(1 << (64 - by))})"

    def bound(value: str, body: str) -> str:
        """`body` with x as the value: what it names twice is computed once."""
        return f"list_transform([{value}], lambda x: {body})[1]"

    def mixed(state: str, lane: str) -> str:
        return bound(wrap(f"{state} + {times(lane, p2)}"), times(turned("x", 31), p1))

    def read(at: str, size: int) -> str:
        """`size` bytes, the least first, from byte `at` of the hexadecimal digits d."""
        return "('0x' || " + " || ".join(f"substr(d, 2 * ({at}) + {2 * k + 1}, 2)" for k in reversed(range(size))) + ")::UBIGINT::UHUGEINT"

    def lanes(many: str, at: str, size: int) -> str:
        return f"list_transform(range({many}), lambda i: {read(at, size)})"

    def folded(first: str, values: str, step: str) -> str:
        return f"list_reduce(list_prepend({first}, {values}), lambda h, k: {step})"

    def shifted(h: str, by: int) -> str:
        return f"xor({h}, {h} // {big(1 << by)})"

    stripes = ", ".join(folded(big(s), lanes("n // 32", f"32 * i + {8 * j}", 8), mixed("h", "k")) for j, s in enumerate((SEED + p1 + p2, SEED + p2, SEED, SEED - p1)))
    gathered = wrap(" + ".join(turned(f"v[{j + 1}]", by) for j, by in enumerate((1, 7, 12, 18))))
    merged = wrap(f"{times('xor(h, ' + mixed(big(0), 'k') + ')', p1)} + {big(p4)}")
    eight = bound(f"xor(h, {mixed(big(0), 'k')})", wrap(f"{times(turned('x', 27), p1)} + {big(p4)}"))
    four = bound(f"xor(h, {times(read('n // 8 * 8', 4), p1)})", wrap(f"{times(turned('x', 23), p2)} + {big(p3)}"))
    one = bound(f"xor(h, {times('k', p5)})", times(turned("x", 11), p1))
    bits = " + ".join(f"CASE WHEN 2 * sum((h >> {b}) & 1) > count(*) THEN {big(1 << b)} ELSE 0 END" for b in range(64))
    return f"""
WITH RECURSIVE numbered AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT r, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(len(w) - 3), lambda i: array_to_string(w[i + 1 : i + 4], ' ')) END) AS s FROM numbered
), given AS (SELECT DISTINCT s, hex(encode(s)) AS d, strlen(s) AS n FROM shingles
), striped AS (SELECT *, CASE WHEN n >= 32 THEN [{stripes}] END AS v FROM given
), begun AS (SELECT s, d, n, CASE WHEN n < 32 THEN {big(SEED + p5)} ELSE {folded(gathered, "v", merged)} END AS h FROM striped
), sized AS (SELECT s, d, n, {wrap("h + n::UHUGEINT")} AS h FROM begun
), eights AS (SELECT s, d, n, {folded("h", lanes("n % 32 // 8", "n // 32 * 32 + 8 * i", 8), eight)} AS h FROM sized
), fours AS (SELECT s, d, n, CASE WHEN n % 8 >= 4 THEN {four} ELSE h END AS h FROM eights
), ones AS (SELECT s, {folded("h", lanes("n % 4", "n // 4 * 4 + i", 1), one)} AS h FROM fours
), spread AS (SELECT s, {times(shifted("h", 33), p2)} AS h FROM ones
), again AS (SELECT s, {times(shifted("h", 29), p3)} AS h FROM spread
), hashed AS (SELECT s, ({shifted("h", 32)})::UBIGINT AS h FROM again
), majority AS (SELECT r, {bits} AS fp FROM shingles JOIN hashed USING (s) GROUP BY r
), prints AS (SELECT doc_id, coalesce(fp, 0)::UBIGINT AS fp FROM numbered LEFT JOIN majority USING (r)
), kinds AS (SELECT fp, min(doc_id) AS rep FROM prints WHERE doc_id IS NOT NULL GROUP BY fp
), links AS (SELECT a.fp AS u, b.rep AS v, b.fp AS w FROM kinds a JOIN kinds b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)::HUGEINT) <= {RADIUS}
), reach AS (SELECT u, v, w FROM links UNION SELECT reach.u, links.v, links.w FROM reach JOIN links ON reach.w = links.u
), roots AS (SELECT fp, least(rep, coalesce(min(v), rep)) AS root FROM kinds LEFT JOIN reach ON u = fp GROUP BY fp, rep)
SELECT doc_id, printf('%016x', prints.fp) AS fingerprint, CASE WHEN doc_id IS NOT NULL THEN root END AS component_id FROM prints LEFT JOIN roots USING (fp)
"""
