"""Line dedup: planted templates, untouched texts and edge cases (the SQL twin covers whole tables)."""

import random

from pyspark.sql import functions as F

from eventloom.llm import lines as L


def text_of(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def run(spark, rows, **how):
    frame = spark.createDataFrame(rows, "doc_id long, text string, template string, row int")
    got = L.dedup_lines(frame, **how)
    return [(r.c_0, r.kept_text, r.n_lines, r.n_dropped) for r in got.collect()]


def test_templates(spark):
    rng = random.Random(9)
    own = {i: text_of(rng, 30) for i in range(8)}
    passage = text_of(rng, 60).split(" ")
    rows = []
    for i in own:
        varied = [*passage]
        varied[10 + i] = f"word{i}x".replace(str(i), "abcdefgh"[i])
        lines = [own[i], f"Page {i} of 12 shown", " ".join(varied), f"End {own[i][:3]}"]
        rows.append((i, "\n".join(lines), "c", 1))
    got = {r[0]: r[1] for r in run(spark, rows)}
    assert got[0] == rows[0][1]
    for i in range(1, 8):
        assert got[i] == f"{own[i]}\nEnd {own[i][:3]}"
    # Fewer documents than the threshold: nothing is dropped.
    assert {r[0]: r[1] for r in run(spark, rows[:4])} == {r[0]: r[1] for r in rows[:4]}


def test_masks_are_linear_and_whole(spark):
    frame = spark.createDataFrame([("a1 b@c d " + "x" * 200_000 + "\t9" + "y" * 10,)], "t string")
    assert frame.select(L.masked(F.col("t")).alias("m")).first().m == "<*> <*> d " + "x" * 200_000 + "\t<*>"


def test_edges(spark):
    line = "all rights are reserved here"
    rows = [(None, line, "c", 1), (1, None, "c", 1), (2, "", "c", 1), (3, line, "c", 1), (3, line, "c", 1), (3, f"own text\n{line}", "c", 1)]
    rows += [(i, f"\n {line}  \n\nend {'abcde'[i - 4]}\n", "c", 1) for i in range(4, 9)]
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert sorted(got, key=str) == sorted(
        [(None, "", 1, 1), (1, None, 0, 0), (2, "", 1, 0), (3, line, 1, 0), (3, line, 1, 0), (3, f"own text\n{line}", 2, 0)] + [(i, f"\n\nend {'abcde'[i - 4]}\n", 5, 1) for i in range(4, 9)], key=str
    )
    assert run(spark, [(1, " \n".join([line] * 5000), "c", 1)]) == [(1, " \n".join([line] * 5000), 5000, 0)]
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert L.dedup_lines(frame).count() == 0


def texts_after(spark, texts):
    return [r[1] for r in sorted(run(spark, [(i, t, "c", 1) for i, t in enumerate(texts)]))]


def test_one_variable_word_in_lines_of_any_length(spark):
    """Four tokens or more: three equal ones of four are the share; other lines of the leaf do not hide the template."""
    rng = random.Random(11)
    for n in (3, 4, 5, 9, 10, 11, 40):
        line, texts = text_of(rng, n).split(" "), []
        for i in range(20):
            varied = [*line[:-1], text_of(rng, 1)] if i % 2 else [*line[:2], *(rng.choice([x, y]) for x, y in zip(line[2:], text_of(rng, n - 2).split(" "), strict=True))]
            if not i % 2:  # an earlier line of the leaf that shares some of its runs only
                varied = [*line[:2], *(x if k == i % (n - 2) else text_of(rng, 1) for k, x in enumerate(line[2:]))]
            texts.append(" ".join(varied))
        got = texts_after(spark, texts)
        kept = [i for i, t in enumerate(got) if t]
        odd = [i for i in kept if i % 2]
        assert len(odd) <= 1 if n > 3 else len(odd) == 10, n


def test_chains_of_seven(spark):
    rng = random.Random(12)
    line, texts = text_of(rng, 34).split(" "), []
    for i in range(7):
        texts.append(" ".join(line))
        line = [*line[: 2 + 4 * i], *text_of(rng, 4).split(" "), *line[6 + 4 * i :]]
    assert texts_after(spark, texts) == [texts[0], *[""] * 6]


def test_lines_of_one_and_two_tokens(spark):
    got = texts_after(spark, [f"own {'abcdefghijklmnopqrst'[i]} text\nRead more\nMore" for i in range(20)])
    assert got == ["own a text\nRead more\nMore", *(f"own {c} text" for c in "bcdefghijklmnopqrst")]
