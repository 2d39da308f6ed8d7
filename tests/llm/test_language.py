"""Codes, held-out accuracy and edge cases of language identification."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from eventloom.llm import language as L

SYLLABLES = {"aa": ["ka", "to", "mi", "ran", "sel"], "bb": ["sch", "ung", "ein", "lich", "ber"], "cc": ["eau", "oui", "tre", "ais", "que"]}


def corpus(rng, n):
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 60)))
        rows.append((i, text, lang))
    return rows


def test_codewords_differ():
    for n in (2, 3, 4, 5, 7, 16, 40):
        code = L.codewords(n)
        distance = (code[:, None] != code[None]).sum(axis=2) + np.eye(n) * 1000
        assert distance.min() >= max(1, code.shape[1] // 3)
    code = L.codewords(500)
    distance = (code[:, None] != code[None]).sum(axis=2) + np.eye(500) * 1000
    assert distance.min() >= code.shape[1] // 4


def plain_model(rows):
    """Counts in Python, sides by plain means, decoding by the definition of the loss."""
    counts = {}
    for i, text, lang in rows:
        if lang is not None and text is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            counts.setdefault(lang, np.zeros(L.BUCKETS))
            for g in L.grams(text)[0].tolist():
                counts[lang][g] += 1
    names = sorted(counts)
    share = np.array([(counts[x] + 0.5) / (counts[x] + 0.5).sum() for x in names])
    code = L.codewords(len(names))
    ones = np.array([np.mean(share[c], axis=0) for c in code.T]).T
    others = np.array([np.mean(share[~c], axis=0) for c in code.T]).T
    weights = np.log(ones) - np.log(others)
    part = np.array([max(1e-3, min(ones[:, b] @ weights[:, b], -(others[:, b] @ weights[:, b]))) for b in range(code.shape[1])])
    part /= part.sum()

    def predict(text):
        found, lettered = L.grams(text or "")
        if not lettered:
            return "und"
        mean = weights[found].sum(axis=0) / len(found) * min(len(found), 400) ** 0.5
        loss = [sum(w * np.logaddexp(0, -m if bit else m) for w, m, bit in zip(part, mean, word, strict=True)) for word in code]
        return names[int(np.argmin(loss))]

    return names, ones, others, predict


def test_the_model_and_decoding_equal_a_plain_version(spark):
    rows = corpus(random.Random(14), 200) + [(900, None, "aa"), (901, "12", "bb"), (902, "kato", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, ones, others, predict = plain_model(rows)
    model = L.learn(docs, "doc_id", "text", "lang")
    assert model.languages == names
    assert np.abs(model.weights[:, :-1] - (np.log(ones) - np.log(others))).max() < 1e-4
    got = {r.doc_id: r.lang_pred for r in L.predict(docs).collect()}
    assert got == {i: predict(text) for i, text, _ in rows}


def test_many_labels_are_all_learned(spark):
    """300 labels, each with an alphabet and syllables of its own."""
    rng, rows = random.Random(8), []
    for k in range(300):
        own = ["".join(chr(0x4E00 + 20 * k + rng.randrange(20)) for _ in range(2)) for _ in range(8)]
        rows += [(len(rows) + j, " ".join(rng.choice(own) for _ in range(40)), f"l{k:03d}") for j in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.predict(docs).collect()
    assert len({r.lang_pred for r in got}) > 290
    assert np.mean([r.lang_pred == rows[r.doc_id][2] for r in got if r.held_out]) > 0.95


def test_held_out_accuracy_and_what_is_learned(spark):
    rows = corpus(random.Random(4), 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in L.predict(docs).collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert 60 < len(held) < 140
    assert np.mean([got[i].lang_pred == rows[i][2] for i in held]) > 0.97
    # The labels of held-out texts are never used.
    hidden = docs.withColumn("lang", F.when(~L.held_out("doc_id"), F.col("lang")).otherwise("zz"))
    assert {r.doc_id: r for r in L.predict(hidden).collect()} == got


def test_edges(spark):
    rows = [(1, None, "aa", 5), (1, None, "aa", 5), (2, "", "aa", 5), (3, "12 !", "bb", 5), (None, "kato mi", "aa", 5), (4, "ein lich " * 40_000, "bb", 5), (5, "ein", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = L.predict(docs).collect()
    assert len(got) == len(rows)
    assert all((r.lang_pred == "und") == (r.doc_id in (1, 2, 3)) and 0 <= r.score <= 1 for r in got)
    assert L.predict(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in L.predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert L.identify(docs).columns == ["c_0", "c_1", "c_2", "c_3", "lang_pred", "score", "ambiguous", "unfit"]


def test_what_fits_no_language(spark):
    rng, rows = random.Random(6), corpus(random.Random(5), 400)
    for i, alphabet in enumerate(["αβγδεζηθικλμν", "bcdfghjklmnpqrstvwxyz", "дежзийклмн"] * 10):
        rows.append((1000 + i, " ".join("".join(rng.choice(alphabet) for _ in range(6)) for _ in range(rng.randint(2, 80))), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    unfit = {r.doc_id for r in L.predict(docs).collect() if r.unfit}
    assert unfit == set(range(1000, 1030))
