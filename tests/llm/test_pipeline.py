"""The stages on planted documents, and the query against a plain run of the stages."""

import os
import random

import corpus_pipeline as C
from eventloom.llm import bpe, common, nearcopies

SYLLABLES = {"aa": ["ka", "to", "mi", "ran", "sel", "vo"], "bb": ["sch", "ung", "ein", "lich", "ber", "au"]}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus():
    rng = random.Random(21)
    rows = []
    for i in range(80):
        lang = rng.choice(sorted(SYLLABLES))
        rows.append([i, "\n".join(text_of(rng, lang, 40) for _ in range(3)), lang])
    items = [(k, text_of(rng, "aa", 25)) for k in range(3)]
    for i in range(0, 10):
        rows[i][1] += "\nall rights are reserved to us"
    rows[70][1] = rows[60][1]
    rows[71][1] = rows[60][1] + " ein"
    rows[72][1] = text_of(rng, "aa", 30) + " " + items[1][1] + " " + text_of(rng, "aa", 30)
    rows[73][1] = text_of(rng, "aa", 30) + " " + items[2][1].upper()[:-2] + " " + text_of(rng, "aa", 30)
    rows += [[90, "12 34 !!", "aa"], [91, None, "aa"], [92, "", None]]
    rows += [[93 + k, " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(60)), "aa"] for k, letters in enumerate(("αβγδεζηθικλμν", "qxjwyzfp"))]
    return rows, items


def test_pipeline(spark, tmp_path):
    rows, items = corpus()
    frame = spark.createDataFrame([(i, t, lang, "s", len(t) if t else 0, "more") for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "bpe":
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
    clean = set(range(80))
    assert set(kept["language_id"]) == clean == set(kept["line_dedup"])
    lines = {i: r.text.split("\n")[-1] == "all rights are reserved to us" for i, r in kept["line_dedup"].items()}
    assert [i for i, has in lines.items() if has] == [0]
    texts = {i: r.text for i, r in kept["line_dedup"].items()}
    sets = {i: set(nearcopies.shingles(t).tolist()) for i, t in texts.items()}
    near = {b for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert {70, 71} <= near and set(kept["near_dedup"]) == clean - near
    assert set(kept["decontamination"]) == clean - near - {72, 73}
    model = bpe.encoder(open(bpe.vocabulary_path(), "rb").read())
    assert {i: list(r.ids) for i, r in kept["bpe"].items()} == {i: model.encode(texts[i]) for i in clean - near - {72, 73}}
    assert {(r.doc_id, r.n_tokens) for r in C.run(spark, str(tmp_path)).collect()} == {(i, r.n_tokens) for i, r in kept["bpe"].items()}


def test_rows_and_columns_of_any_kind(spark, tmp_path):
    """Repeated rows, null ids, shared ids, and columns with dots and with the stages' own names."""
    rng = random.Random(22)
    texts = [text_of(rng, "aa", 60) for _ in range(6)]
    rows = [(1, texts[0])] * 3 + [(None, texts[1])] * 2 + [(None, texts[2]), (2, texts[0]), (3, texts[3]), (3, texts[4]), (4, texts[3] + " ka"), (5, None), (5, ""), (None, None)]
    names = ["a.b", "__first_id", "hit", "doc_id", "row", "text", "c_0", "n", "component_id", "lang", "n_chars", "template", "drops"]
    frame = spark.createDataFrame([(7, i, 1, i, 2, t, 3, 4, 5, "aa", 6, "t", 8) for i, t in rows], ", ".join(f"`{n}` " + ("string" if n in ("text", "lang", "template") else "long") for n in names))
    spark.createDataFrame([(1, texts[4]), (None, texts[2])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, empty = frame, frame.limit(0)
    expected = {
        "language_id": [r for r in rows if r[1]],
        "line_dedup": [r for r in rows if r[1]],
        "near_dedup": [(1, texts[0]), (None, texts[1]), (None, texts[2]), (3, texts[3]), (3, texts[4])],
        "decontamination": [(1, texts[0]), (None, texts[1]), (3, texts[3])],
    }
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == frame.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert sorted([(r.doc_id, r.text) for r in docs.collect()], key=str) == sorted(expected[name], key=str), name
        assert all(r["a.b"] == 7 and r["__first_id"] == r.doc_id for r in docs.collect())
        none = stage(spark, empty, str(tmp_path))
        assert none.count() == 0 and none.dtypes == frame.dtypes
    assert C.token_ids(spark, docs, "").count() == 3 and C.token_ids(spark, empty, "").count() == 0


def test_intermediates_are_deleted(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame([(i, t, lang) for i, t, lang in rows], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    folder = f"{common.shared_dir(spark)}/eventloom"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert C.run(spark, str(tmp_path)).count() > 0
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} == {f"pipeline-{C.STAGES[-2][0]}"}
