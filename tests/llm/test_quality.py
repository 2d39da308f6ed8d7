"""Counts against plain versions, the estimate against a plain MCD step, and edge cases."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from eventloom.llm import quality as Q


def plain(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(repeated), n < 20 or 100 * len(repeated) > 30 * n


def test_counts_and_verdicts(spark):
    rng = random.Random(12)
    some = ["the", "of", "é\x85a", "😀", "Big", "x*", "#", "a|b", "", "\t"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(some[: rng.choice([2, 10])]) + rng.choice([" ", " ", "\n", "\r\n", "  "]) for _ in range(rng.randint(0, 120)))
        rows.append((i, text, rng.choice(["en", "de", None]), "s"))
    clean = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    for i in range(300, 900):
        rows.append((i, " ".join(rng.choice(clean) for _ in range(rng.randint(30, 300))), "fr", "s"))
    for i in range(900, 920):
        rows.append((i, " ".join(rng.choice(clean).upper() + "***" for _ in range(100)), "fr", "s"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in Q.quality(frame).collect()}
    for i, text, *_ in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(text), text
        assert not (r.base_failed and r.kept)
    assert all(got[i].kept for i in range(300, 900))
    assert not any(got[i].kept for i in range(900, 920))


def plain_mcd(x):
    """Concentration steps on the points themselves until nothing changes, from the same two starts."""
    best = None
    for centre, spread in ((np.median(x, axis=0), np.diag(np.square(Q.FLOORS))), (x.mean(axis=0), np.cov(x.T, bias=True) + np.diag(np.square(Q.FLOORS)))):
        for _ in range(50):
            d2 = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(spread), x - centre)
            inside = x[np.argsort(d2, kind="stable")[: int(np.ceil(Q.SUBSET * len(x)))]]
            centre, spread = inside.mean(axis=0), np.cov(inside.T, bias=True) + np.diag(np.square(Q.FLOORS))
        found = np.linalg.det(spread), centre, spread
        best = min(best, found, key=lambda f: f[0]) if best else found
    _, centre, spread = best
    d2 = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(spread), x - centre)
    return centre, spread, d2 / max(1.0, np.median(d2) / Q.MEDIAN_CHI2)


def test_the_estimate_is_that_of_a_plain_mcd(spark):
    rng, groups = np.random.default_rng(3), {}
    for g, (n, bad) in {"a": (3000, 300), "b": (500, 60), "c": (40, 0)}.items():
        mixed = np.array([[6, 0, 0, 0], [3, 4, 0, 0], [0, 2, 5, 0], [1, 0, 1, 3.0]])
        groups[g] = np.round(np.vstack([rng.normal(size=(n, 4)) @ mixed.T + [100, 25, 30, 15], rng.normal([200, 90, 30, 60], 9, (bad, 4))]))
    rows = [(g, *map(int, v)) for g, x in groups.items() for v in x]
    frame = spark.createDataFrame(rows, "g_0 string, x_0 long, x_1 long, x_2 long, x_3 long")
    cells = frame.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias("cells"))
    for r in Q.estimate(cells, ["g_0"]).collect():
        x = groups[r.g_0] / Q.GRID
        centre = np.array([r[f"m_{i}"] for i in range(4)])
        low = np.array([[r[f"l_{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
        d2 = (np.linalg.solve(low, (x - centre).T) ** 2).sum(axis=0) / r.scale
        their_centre, their_spread, theirs = plain_mcd(x)
        assert np.abs(centre - their_centre).max() < 0.02
        assert np.abs(low @ low.T - their_spread).max() < 0.15 * np.abs(their_spread).max()
        assert np.mean((d2 > Q.CUTOFF) == (theirs > Q.CUTOFF)) > 0.995
        planted = {"a": 300, "b": 60, "c": 0}[r.g_0]
        assert (d2[len(x) - planted :] > Q.CUTOFF).all() and (d2[: len(x) - planted] <= Q.CUTOFF).mean() > 0.995


def test_no_window_and_no_group_in_one_task(spark):
    """All rows of a group meet as bins only: the plan has neither a window nor a sort over cells."""
    frame = spark.range(100).selectExpr("'g' g_0", "id x_0", "id x_1", "id x_2", "id x_3", "1L cells")
    starts = Q.medians(frame, ["g_0"]).withColumn("start", F.lit(0))
    for i, j in Q.PAIRS:
        starts = starts.withColumn(f"l_{i}{j}", F.lit(1.0 if i == j else 0.0))
    plan = Q.refit(frame, starts, ["g_0"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_sum" in plan


def test_edges(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None, None, None, 7), (1, None, None, None, 7), (2, "", "en", "s", 7), (None, words, "en", "s", 7), (3, "a " * 30_000, "en", "s", 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    got = sorted(((r.doc_id, r.n_words, r.n_repeat_words, r.kept) for r in Q.quality(frame).collect()), key=str)
    assert got == sorted([(1, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False), (None, 40, 0, True), (3, 30_000, 30_000, False)], key=str)
    assert Q.quality(frame.limit(0)).count() == 0
