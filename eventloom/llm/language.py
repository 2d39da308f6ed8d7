"""Language identification by error-correcting output codes (operator 5).

Every language has a codeword. For each bit, a binary classifier over hashed character
n-grams (one, two and three characters, words set off by one space) tells the languages
whose bit is one from the others; decoding adds the loss of every bit, weighted by how well
the bit separates its two sides, and chooses the nearest codeword. The gap between the two
nearest codewords gives the score and flags ambiguous texts. One more bit tells all languages
from noise (every n-gram equally likely): a text whose margin on it is nearer to noise's end
than to what texts of the languages have on average is in none of them.

Learning counts n-grams per language over all labelled texts outside the held-out quarter:
each task sends rows per language and n-gram bucket. All labels are learned, however many there
are: codewords grow with the logarithm of their number, the counts are turned into the two sides
of each bit bucket by bucket, in tasks, and the driver receives the labels and one row of bits
for each of BUCKETS buckets. Counts are sums of integers, and shares are added in the order of
labels, so the model does not depend on the order of rows.

Defined results: a text that is null or has no letter is `und` with score 0; so is every text
if nothing can be learned. A row with a null doc_id is not learned from and not held out.
Repeated rows give repeated result rows (and count repeatedly when learned from); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, slices, table

UNKNOWN = "und"
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
#: Languages whose counts a task holds at a time.
HELD_LANGUAGES = 128
#: Up to this number of languages every split into two sides is a bit.
EXHAUSTIVE = 6
#: Up to this number a simplex code; beyond, random codewords of so many bits for each doubling.
SIMPLEX, RANDOM_BITS = 64, 16
SEED = 7
#: Texts whose nearest codewords are closer than this are flagged.
AMBIGUOUS = 0.2
#: Share of the languages' own expected margin over noise that a text must have.
LEAST_FIT = 0.5
#: Characters scored at a time.
CHUNK = 1 << 18


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def grams(text: str) -> tuple[np.ndarray, bool]:
    """Buckets of the n-grams of a text, and whether it has a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    is_letter = letters()[points]
    if not is_letter.any():
        return np.zeros(0, np.int64), False
    points = np.where(is_letter, points, 32).astype(np.uint64)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    points = np.concatenate(([32], points[keep], [32])).astype(np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)  # multiplicative hashing
    down = np.uint64(64 - BUCKET_BITS)
    one = points[points != 32] * odd
    two = (points[:-1] * np.uint64(0x1FFFFF) + points[1:]) * odd
    three = ((points[:-2] * np.uint64(0x1FFFFF) + points[1:-1]) * np.uint64(0x3FFFFD) + points[2:]) * odd
    return (np.concatenate((one, two, three)) >> down).astype(np.int64), True


def codewords(n: int) -> np.ndarray:
    """A row of bits for each of n languages.

    Few languages: every split in two. More: the codes of a simplex of Walsh functions, whose
    rows differ in half of all bits. Many: random codewords, which differ in about half of their
    bits too, and whose number grows with the logarithm of the languages' number.
    """
    if n <= EXHAUSTIVE:
        sides = [c for k in range(1, n // 2 + 1) for c in combinations(range(n), k) if k * 2 < n or 0 in c]
        return np.array([[i in c for c in sides] for i in range(n)], bool).reshape(n, len(sides))
    if n > SIMPLEX:
        return np.random.default_rng(SEED).random((n, RANDOM_BITS * (n - 1).bit_length())) < 0.5
    size = 1 << (n - 1).bit_length()
    walsh = np.array([[bin(i & j).count("1") & 1 for j in range(1, size)] for i in range(n)], bool)
    return walsh[:, (walsh.any(axis=0)) & (~walsh.all(axis=0))]


class Model:
    """Binary classifiers and their decoding.

    `ones` and `others` are the mean shares of each bucket (rows) over the languages of the two
    sides of each bit (columns): every language weighs the same. In the last column all languages
    are on one side and noise is on the other.
    """

    def __init__(self, languages: list[str], ones: np.ndarray, others: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        weights = np.log(ones) - np.log(others)
        expected = (ones * weights).sum(axis=0)
        self.least_fit = LEAST_FIT * expected[-1]
        # Expected margin of the side that is harder to tell.
        self.bit_weight = np.maximum(1e-3, np.minimum(expected, -(others * weights).sum(axis=0)))[:-1]
        self.bit_weight /= max(self.bit_weight.sum(), 1e-9)
        self.weights = weights.astype(np.float32)

    def decode(self, margins: np.ndarray, n_grams: int) -> tuple[str, float, bool]:
        """Language, score and ambiguity from each bit's summed log odds."""
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        mean = margins / n_grams * min(n_grams, 400) ** 0.5
        zero, one = np.logaddexp(0.0, mean) * self.bit_weight, np.logaddexp(0.0, -mean) * self.bit_weight
        loss = zero.sum() + self.code @ (one - zero)
        near = np.argsort(loss, kind="stable")
        chance = np.exp(-(loss - loss[near[0]]) * len(self.bit_weight))
        score = float(1 / chance.sum())
        return self.languages[near[0]], score, bool(score - chance[near[1]] * score < AMBIGUOUS)

    def predict(self, text: str | None) -> tuple[str, float, bool, bool]:
        """Language, score, whether two codewords are about as near, and whether the text fits no language."""
        found, lettered = grams(text or "")
        if not lettered or not self.languages:
            return UNKNOWN, 0.0, True, True
        margins = np.zeros(self.weights.shape[1])
        for at in range(0, len(found), CHUNK):
            margins += self.weights[found[at : at + CHUNK]].sum(axis=0, dtype=np.float64)
        return *self.decode(margins[:-1], len(found)), bool(margins[-1] < self.least_fit * len(found))


def two_sides(counts: np.ndarray, total: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean shares over the two sides of each bit, for buckets (rows) counted in languages (columns)."""
    share = (counts + 0.5) / (total + 0.5 * BUCKETS)
    n = code.sum(axis=0)
    ones = np.column_stack((share @ code / np.maximum(n, 1), share.mean(axis=1)))
    return ones, np.column_stack((share @ ~code / np.maximum(len(code) - n, 1), np.full(len(share), 1 / BUCKETS)))


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> Model:
    """Fit on labelled rows outside the held-out quarter."""

    def as_batches(sums):
        for lang, of in sums.items():
            at = np.flatnonzero(of)
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(of[at])], names=["lang", "bucket", "n"])

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in (part for whole in batches for part in slices(whole, 1)):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in sums:
                    if len(sums) == HELD_LANGUAGES:
                        yield from as_batches(sums)
                        sums.clear()
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += np.bincount(grams(text.as_py())[0], minlength=BUCKETS)
        yield from as_batches(sums)

    known = docs.filter(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(count, "lang string, bucket int, n long")
    counted = materialize(counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    totals = {r.lang: r.n for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], np.ones((BUCKETS, 1)), np.ones((BUCKETS, 1)))
    code, total = codewords(len(languages)), np.array([totals[x] for x in languages], np.float64)
    row = docs.sparkSession.sparkContext.broadcast({lang: i for i, lang in enumerate(languages)})

    def sides(batches):
        """Whole buckets, one after the other -> the two sides of each bit."""
        place, held, counts = row.value, None, np.zeros(len(total))

        def finished():
            one, other = two_sides(counts[None], total, code)
            return pa.record_batch([pa.array([held], pa.int32()), pa.array(one.tolist()), pa.array(other.tolist())], names=["bucket", "ones", "others"])

        for batch in batches:
            for lang, bucket, n in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if bucket != held:
                    if held is not None:
                        yield finished()
                    held, counts = bucket, np.zeros(len(total))
                counts[place[lang]] = n
        if held is not None:
            yield finished()

    parts = min(BUCKETS, max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    found = counted.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(sides, "bucket int, ones array<double>, others array<double>")
    found = found.toArrow()
    at = found["bucket"].to_numpy()
    ones, others = (np.repeat(x, BUCKETS, axis=0) for x in two_sides(np.zeros((1, len(total))), total, code))
    for name, side in (("ones", ones), ("others", others)):
        if len(at):
            side[at] = found[name].combine_chunks().flatten().to_numpy().reshape(len(at), -1)
    return Model(languages, ones, others)


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The columns of `docs` as c_0, c_1 and so on, and lang_pred, score, ambiguous and unfit: one row for each row."""
    model = model or learn(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(docs.columns)))
    at = docs.columns.index(text_col)

    def run(batches):
        fitted = shared.value
        for batch in (part for whole in batches for part in slices(whole, at)):
            found = [fitted.predict(t.as_py()) for t in batch.column(at)]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_(), pa.bool_()))]
            yield pa.record_batch([*batch.columns, *columns], names=[*batch.schema.names, "lang_pred", "score", "ambiguous", "unfit"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double, ambiguous boolean, unfit boolean")


def predict(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous and unfit for each row of `docs`; only id and text reach the classifier."""
    model = model or learn(docs, id_col, text_col, lang_col)
    named = identify(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), model)
    return named.select(F.col("c_0").alias("doc_id"), held_out("c_0").alias("held_out"), "lang_pred", "score", "ambiguous", "unfit")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"))
