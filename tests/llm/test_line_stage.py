"""The pipeline's line stage, which has wider rules than op2_lines and its SQL twin."""

import random

import corpus_pipeline as C


def text_of(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def run(spark, texts):
    frame = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    return {r.doc_id: r.text for r in C.drop_repeated_lines(spark, frame, "").collect()}


def test_short_lines(spark):
    rng = random.Random(3)
    own = [text_of(rng, 30) for _ in range(6)]
    got = run(spark, [f"{t}\nLes.\n\nAnd so" if i < 5 else f"{t}\n\nEnd" for i, t in enumerate(own)])
    assert got == {0: f"{own[0]}\nLes.\n\nAnd so", **{i: f"{own[i]}\n" for i in range(1, 5)}, 5: f"{own[5]}\n\nEnd"}


def test_long_lines_with_changes_in_many_runs(spark):
    """Four of 130 tokens differ, in four runs of eight; a line with half of its tokens changed is another."""
    rng = random.Random(5)
    passage = text_of(rng, 130).split(" ")
    own, texts = [text_of(rng, 30) for _ in range(8)], []
    for i in range(8):
        line = [*passage]
        for k in (10, 40, 70, 100) if 0 < i < 7 else range(12, 120, 2) if i else ():
            line[k + i % 7] = text_of(rng, 1)
        texts.append(f"{own[i]}\n{' '.join(line)}")
    got = run(spark, texts)
    assert got == {0: texts[0], **{i: own[i] for i in range(1, 7)}, 7: texts[7]}


def test_templates_are_followed_to_their_end(spark):
    """Each line has two more runs of eight changed than the one before: five steps, one template."""
    rng = random.Random(6)
    line = text_of(rng, 82).split(" ")
    own, texts = [text_of(rng, 30) for _ in range(5)], []
    for i in range(5):
        texts.append(f"{own[i]}\n{' '.join(line)}")
        line = [*line[: 2 + 20 * i], *text_of(rng, 20).split(" "), *line[22 + 20 * i :]]
    assert run(spark, texts) == {0: texts[0], **{i: own[i] for i in range(1, 5)}}
