"""Quality rules with robust multivariate outliers (operator 1).

Each text gets word and repetition counts, two fixed base rules, and a verdict by the
minimum-covariance-determinant (MCD) estimate of its language and source: a text whose
transformed statistics lie too far from the robust centre is rejected.

The statistics are put on a fixed integer grid. One pass over the texts counts the rows of
each grid cell. A concentration step joins the groups' estimates to the cells, adds up counts and
moments by distance bin (BINS of them at most) in each task before anything is moved, and then
takes a group's nearest bins until they hold SUBSET of its texts. So no task holds a group: what
meets in one place are a group's bins, or the at most GRID_LIMIT values of one statistic. All
sums are sums of integers, so the estimates do not depend on the order of rows.

Defined results: a null or blank text has no words, fails the base rules and is not kept;
repeated rows give repeated result rows; null languages and sources form groups of their own;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_small, let, materialize, table, words_of

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Grid steps for one unit of each statistic, and the grid's bounds.
GRID, GRID_LIMIT = 64, 512
#: Least standard deviations of the four statistics; added to the covariance as a ridge, so
#: that a statistic that is constant over most texts does not make the estimate singular.
FLOORS = (0.08, 0.04, 0.06, 0.08)
#: Share of texts that the estimate rests on.
SUBSET = 0.75
STEPS = 4
#: Quantile of the chi-square distribution with four degrees of freedom at 1 - 1e-5.
CUTOFF = 28.47
#: Its median over its mean for the same degrees, to rescale the covariance of the subset.
MEDIAN_CHI2 = 3.357

#: Bins of distance: BIN for each unit of the distance's square root, BINS at most.
BIN, BINS = 64, 1024

DIMS = range(4)
PAIRS = [(i, j) for i in DIMS for j in DIMS if j <= i]


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of eight words found twice or more; `words` are hashes."""

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW)))),
            F.lit(0),
            lambda total, x: total + x,
        )

    def from_windows(windows: Column) -> Column:
        found = let(
            F.sort_array(F.transform(windows, lambda v, i: F.struct(v.alias("v"), i.alias("i")))),
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        F.transform(
                            s,
                            lambda x, k: F.struct(
                                x.i.alias("i"),
                                (F.coalesce(F.get(s, k - 1).v == x.v, F.lit(False)) | F.coalesce(F.get(s, k + 1).v == x.v, F.lit(False))).alias("twice"),
                            ),
                        ),
                        lambda x: x.twice,
                    ),
                    lambda x: x.i,
                )
            ),
        )
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(found, covered))

    def from_hashes(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WINDOW)
        windows = F.transform(at, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW))))
        return F.when(F.size(h) <= WINDOW, F.lit(0)).otherwise(let(windows, from_windows))

    return from_hashes(words)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def kept_chars(text: Column, character_class: str) -> Column:
    """Number of characters of a text that are in the class."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{character_class}]+", ""))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One row for each input row: its counts, grid statistics and base verdict."""
    base = docs.select(F.col(id_col).alias("doc_id"), *(F.col(g).alias(f"g_{k}") for k, g in enumerate(group_cols)), F.col(text_col).alias("t"))
    counted = base.select(
        "doc_id",
        *(f"g_{k}" for k in range(len(group_cols))),
        let(
            words_of(F.col("t")),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                let(
                    F.transform(w, lambda x: F.xxhash64(x)),
                    lambda h: F.struct(
                        repeated_words(h).cast("long").alias("repeats"),
                        F.size(F.filter(h, lambda x, i: x == F.get(h, i - 1))).cast("long").alias("adjacent"),
                    ),
                ).alias("h"),
            ),
        ).alias("w"),
        kept_chars(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        kept_chars(F.col("t"), r"\p{Lu}").cast("long").alias("n_upper"),
        duplicate_lines(F.col("t")).cast("long").alias("n_dup_lines"),
    ).select(
        "doc_id",
        *(f"g_{k}" for k in range(len(group_cols))),
        "w.n_words",
        "w.word_chars",
        F.col("w.h.repeats").alias("n_repeat_words"),
        F.col("w.h.adjacent").alias("n_adjacent"),
        "n_symbols",
        "n_upper",
        "n_dup_lines",
    )
    n, chars = F.col("n_words"), F.col("word_chars")
    # Short texts are pulled towards a word of five letters and towards zero: their ratios vary most.
    statistics = (
        F.log((chars + 100) / (n + 20)),
        F.sqrt(F.col("n_symbols") / (chars + 50)),
        F.sqrt(F.col("n_upper") / (chars + 50)),
        F.sqrt(F.col("n_adjacent") / (n + 20)),
    )
    return counted.select(
        "*",
        *(F.least(F.lit(GRID_LIMIT), F.floor(s * GRID + 0.5)).cast("long").alias(f"x_{i}") for i, s in enumerate(statistics)),
        ((n < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT)).alias("base_failed"),
    )


def cholesky(entry: dict[tuple[int, int], Column]) -> dict[tuple[int, int], Column]:
    """Lower factor of a four by four matrix of columns."""
    low: dict[tuple[int, int], Column] = {}
    for i, j in PAIRS:
        rest = entry[i, j]
        for k in range(j):
            rest = rest - low[i, k] * low[j, k]
        low[i, j] = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / low[j, j]
    return low


def with_distance(frame: DataFrame) -> DataFrame:
    """Add d2, the squared Mahalanobis distance of x_* to m_* under the factor l_*."""
    for i in DIMS:
        rest = F.col(f"x_{i}") / GRID - F.col(f"m_{i}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}{j}") * F.col(f"z_{j}")
        frame = frame.withColumn(f"z_{i}", rest / F.col(f"l_{i}{i}"))
    return frame.withColumn("d2", sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in DIMS), F.lit(0.0))).drop(*(f"z_{i}" for i in DIMS))


SUMS = ["n", *(f"s_{i}" for i in DIMS), *("q_%d%d" % p for p in PAIRS)]


def moments() -> list[Column]:
    """Sums over counted cells: rows, statistics, and their products."""
    n, x = F.col("cells"), [F.col(f"x_{i}") for i in DIMS]
    return [F.sum(c).alias(name) for c, name in zip([n, *(n * x[i] for i in DIMS), *(n * x[i] * x[j] for i, j in PAIRS)], SUMS, strict=True)]


def fitted(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Centre m_* and factor l_* of the covariance, with its ridge, from sums."""
    centre = {i: F.col(f"s_{i}") / F.col("n") for i in DIMS}
    spread = {(i, j): (F.col(f"q_{i}{j}") / F.col("n") - centre[i] * centre[j]) / GRID**2 + (FLOORS[i] ** 2 if i == j else 0.0) for i, j in PAIRS}
    sums = sums.select(*keys, *((centre[i] / GRID).alias(f"m_{i}") for i in DIMS), *(spread[p].alias("v_%d%d" % p) for p in PAIRS))
    low = cholesky({p: F.col("v_%d%d" % p) for p in PAIRS})
    return sums.select(*keys, *(f"m_{i}" for i in DIMS), *(low[p].alias("l_%d%d" % p) for p in PAIRS))


def binned(cells: DataFrame, estimates: DataFrame, groups: list[str], *sums: Column) -> DataFrame:
    """One row for each group and start: total, and its bins (bin and sums) from the nearest on."""
    scored = with_distance(join_small(cells, estimates, groups, F.xxhash64(*(f"x_{i}" for i in DIMS))))
    # The fourth root of d2 is the square root of the distance; roots are exact to the last digit everywhere.
    place = F.least(F.lit(BINS - 1), F.floor(F.sqrt(F.sqrt("d2")) * BIN)).cast("int")
    bins = scored.groupBy(*groups, "start", place.alias("bin")).agg(*sums)
    rest = [c for c in bins.columns if c not in (*groups, "start")]
    return bins.groupBy(*groups, "start").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct(*rest))).alias("bins"))


def refit(cells: DataFrame, estimates: DataFrame, groups: list[str]) -> DataFrame:
    """A concentration step: estimates from the SUBSET of each group nearest to its estimate (whole bins)."""
    found = binned(cells, estimates, groups, *moments())
    none = F.struct(*(F.lit(0).cast("long").alias(c) for c in SUMS))
    more = lambda a, b: F.when(a["n"] < F.col("total") * SUBSET, F.struct(*((a[c] + b[c]).alias(c) for c in SUMS))).otherwise(a)
    return fitted(found.select(*groups, "start", F.aggregate("bins", none, more).alias("k")).select(*groups, "start", "k.*"), [*groups, "start"])


def median(values: str, value: str) -> Column:
    """The first value of a sorted array of (value, n) at which half of the total is reached."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("x"))
    more = lambda a, b: F.when(a["n"] * 2 >= F.col("total"), a).otherwise(F.struct((a["n"] + b["n"]).alias("n"), b[value].cast("long").alias("x")))
    return F.aggregate(values, none, more)["x"]


def medians(cells: DataFrame, groups: list[str]) -> DataFrame:
    """m_*: the median of each statistic of each group."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), F.col(f"x_{i}").alias("x")) for i in DIMS)))
    counts = cells.select(*groups, "cells", each.alias("d")).groupBy(*groups, "d.dim", "d.x").agg(F.sum("cells").alias("n"))
    along = counts.groupBy(*groups, "dim").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("x", "n"))).alias("values"))
    middle = along.select(*groups, "dim", median("values", "x").alias("x"))
    return middle.groupBy(*groups).agg(*((F.max(F.when(F.col("dim") == i, F.col("x"))) / GRID).alias(f"m_{i}") for i in DIMS))


def estimate(cells: DataFrame, groups: list[str]) -> DataFrame:
    """MCD centre m_* and covariance factor l_* of each group, and the scale of its distances, from counted grid cells.

    Two deterministic starts: the group's medians with each statistic scaled alone, and its mean
    and plain covariance. STEPS concentration steps each; the start whose subset has the smaller
    determinant wins. Estimates are written after each step: their number is that of the groups.
    """
    alone = medians(cells, groups).select(
        *groups, F.lit(0).alias("start"), *(f"m_{i}" for i in DIMS), *(F.lit(FLOORS[i] if i == j else 0.0).alias(f"l_{i}{j}") for i, j in PAIRS)
    )
    plain = fitted(cells.groupBy(*groups).agg(*moments()), groups).withColumn("start", F.lit(1))
    found = materialize(alone.unionByName(plain), "quality-starts")
    for _ in range(STEPS):
        found = materialize(refit(cells, found, groups), "quality-step")
    # The median distance of the group against the chi-square's makes the covariance consistent.
    spread = binned(cells, found, groups, F.sum("cells").alias("n"))
    upper = (median("bins", "bin") + 1) / BIN
    scale = F.greatest(F.lit(1.0), upper * upper * upper * upper / MEDIAN_CHI2)
    spread = spread.select(*(F.col(g).alias(f"of_{g}") for g in groups), F.col("start").alias("of_start"), scale.alias("scale"))
    on = [F.col(g).eqNullSafe(F.col(f"of_{g}")) for g in groups] + [F.col("start") == F.col("of_start")]
    log_det = F.round(sum(F.log(F.col(f"l_{i}{i}")) for i in DIMS), 9)
    rest = ["scale", *(c for c in found.columns if c not in (*groups, "start"))]
    best = found.join(spread, on).groupBy(*groups).agg(F.min_by(F.struct(*rest), F.struct(log_det, "start")).alias("best"))
    return best.select(*groups, "best.*")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source"), cutoff: float = CUTOFF) -> DataFrame:
    """Counts, base rules, Mahalanobis distance and verdict for each row of `docs`."""
    measured = materialize(measure(docs, id_col, text_col, group_cols), "quality-measured")
    groups = [f"g_{k}" for k in range(len(group_cols))]
    # Texts that fail the base rules are judged already; the estimate rests on the others.
    cells = measured.filter(~F.col("base_failed")).groupBy(*groups, *(f"x_{i}" for i in DIMS)).agg(F.count(F.lit(1)).alias("cells"))
    cells = materialize(cells, "quality-cells")
    estimates = materialize(estimate(cells, groups), "quality-estimates")
    judged = with_distance(join_small(measured, estimates, groups, F.col("doc_id")))
    distance = F.col("d2") / F.col("scale")
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"),
        F.when(~F.col("base_failed"), distance).alias("distance"),
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).drop("distance")


def op1_sql() -> str:
    """The same rows from windows of words, ranks over bins and plain columns; steps are written out."""
    x, m = [f"x_{i}" for i in DIMS], [f"m_{i}" for i in DIMS]
    low = ["l_%d%d" % p for p in PAIRS]
    sums = ", ".join(["sum(cells) AS n", *(f"sum(cells * x_{i}) AS s_{i}" for i in DIMS), *(f"sum(cells * x_{i} * x_{j}) AS q_{i}{j}" for i, j in PAIRS)])

    def fit(source: str) -> str:
        """Centre and factor from sums, each level from the one before."""
        level = f"SELECT lang, source, start, {', '.join(f's_{i} / n / {GRID} AS m_{i}' for i in DIMS)}, "
        level += ", ".join(f"(q_{i}{j} / n - (s_{i} / n) * (s_{j} / n)) / {GRID**2} + {FLOORS[i] ** 2 if i == j else 0.0!r} AS v_{i}{j}" for i, j in PAIRS) + f" FROM ({source})"
        for i, j in sorted(PAIRS, key=lambda p: (p[0], p[1])):
            rest = f"v_{i}{j}" + "".join(f" - l_{i}{k} * l_{j}{k}" for k in range(j))
            level = f"SELECT *, {f'sqrt(greatest({rest}, 1e-9))' if i == j else f'({rest}) / l_{j}{j}'} AS l_{i}{j} FROM ({level})"
        return f"SELECT lang, source, start, {', '.join([*m, *low])} FROM ({level})"

    def distance(source: str) -> str:
        for i in DIMS:
            rest = f"x_{i} / {GRID} - m_{i}" + "".join(f" - l_{i}{j} * z_{j}" for j in range(i))
            source = f"SELECT *, ({rest}) / l_{i}{i} AS z_{i} FROM ({source})"
        return f"SELECT *, {' + '.join(f'z_{i} * z_{i}' for i in DIMS)} AS d2 FROM ({source})"

    def joined(table_: str, estimates: str) -> str:
        return f"SELECT c.*, e.* EXCLUDE (lang, source) FROM {table_} c JOIN {estimates} e ON c.lang IS NOT DISTINCT FROM e.lang AND c.source IS NOT DISTINCT FROM e.source"

    steps = []
    for k in range(STEPS + 1):
        steps.append(f"""bins_{k} AS MATERIALIZED (
  SELECT lang, source, start, least({BINS - 1}, CAST(floor(sqrt(sqrt(d2)) * {BIN}) AS INTEGER)) AS bin, {sums} FROM ({distance(joined("cells", f"est_{k}"))}) GROUP BY ALL
), ranked_{k} AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, start ORDER BY bin) AS reached, sum(n) OVER (PARTITION BY lang, source, start) AS total FROM bins_{k}
)""")
        if k < STEPS:
            inside = ", ".join(f"sum({c}) AS {c}" for c in SUMS)
            steps.append(f"est_{k + 1} AS MATERIALIZED ({fit(f'SELECT lang, source, start, {inside} FROM ranked_{k} WHERE reached - n < total * {SUBSET} GROUP BY ALL')})")
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), words AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM texts
), windows AS (
  SELECT rid, i, w[i:i + {WINDOW - 1}] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words WHERE len(w) > {WINDOW})
), twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), repeats AS (SELECT rid, count(DISTINCT i + k) AS r FROM twice, range({WINDOW}) AS o(k) GROUP BY rid
), counted AS (
  SELECT rid, doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS n_upper,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines, len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_adjacent
  FROM words
), measured AS MATERIALIZED (
  SELECT c.* EXCLUDE (lines), len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words, n_words < {MIN_WORDS} OR 100 * coalesce(r, 0) > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
    CAST(least({GRID_LIMIT}, floor(ln((word_chars + 100) / (n_words + 20)) * {GRID} + 0.5)) AS BIGINT) AS x_0,
    CAST(least({GRID_LIMIT}, floor(sqrt(n_symbols / (word_chars + 50)) * {GRID} + 0.5)) AS BIGINT) AS x_1,
    CAST(least({GRID_LIMIT}, floor(sqrt(n_upper / (word_chars + 50)) * {GRID} + 0.5)) AS BIGINT) AS x_2,
    CAST(least({GRID_LIMIT}, floor(sqrt(n_adjacent / (n_words + 20)) * {GRID} + 0.5)) AS BIGINT) AS x_3
  FROM counted c LEFT JOIN repeats USING (rid)
), cells AS MATERIALIZED (SELECT lang, source, {", ".join(x)}, count(*) AS cells FROM measured WHERE NOT base_failed GROUP BY ALL
), est_0 AS MATERIALIZED (
  SELECT lang, source, 0 AS start, {", ".join(f"quantile_disc(x_{i}, 0.5) / {GRID} AS m_{i}" for i in DIMS)}, {", ".join(f"CAST({FLOORS[i] if i == j else 0.0} AS DOUBLE) AS l_{i}{j}" for i, j in PAIRS)}
  FROM measured WHERE NOT base_failed GROUP BY lang, source
  UNION ALL {fit(f"SELECT lang, source, 1 AS start, {sums} FROM cells GROUP BY lang, source")}
), {", ".join(steps)}, middle AS (SELECT lang, source, start, min(bin) AS bin FROM ranked_{STEPS} WHERE reached * 2 >= total GROUP BY ALL
), best AS (
  SELECT e.*, greatest(1.0, ((b.bin + 1) / {BIN}) * ((b.bin + 1) / {BIN}) * ((b.bin + 1) / {BIN}) * ((b.bin + 1) / {BIN}) / {MEDIAN_CHI2}) AS scale
  FROM est_{STEPS} e JOIN middle b ON e.lang IS NOT DISTINCT FROM b.lang AND e.source IS NOT DISTINCT FROM b.source AND e.start = b.start
  QUALIFY row_number() OVER (PARTITION BY e.lang, e.source ORDER BY round({" + ".join(f"ln(l_{i}{i})" for i in DIMS)}, 9), e.start) = 1
), judged AS ({distance("SELECT c.*, e.* EXCLUDE (lang, source) FROM measured c LEFT JOIN best e ON c.lang IS NOT DISTINCT FROM e.lang AND c.source IS NOT DISTINCT FROM e.source")}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(d2 / scale <= {CUTOFF}, true) AS kept FROM judged
"""
