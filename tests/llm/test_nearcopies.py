"""Components of near copies against a plain comparison of all pairs."""

import random

import corpus_pipeline as C
import numpy as np
from eventloom.llm import nearcopies as N
from eventloom.llm import simhash as S


def plain(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def components(texts):
    sets = {i: plain(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(texts):
        for b in sorted(texts):
            if a < b and similar(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def corpus():
    """Chains of edited copies: what is linked to a copy is often not linked to the first."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    texts = {0: None, 1: "", 2: " \n", 3: "one two", 4: "One  two", 5: "one two three"}
    for _ in range(25):
        text = rng.choices(words, k=rng.randint(30, 300))
        for _ in range(rng.choice([1, 2, 3, 12])):
            texts[len(texts)] = " ".join(text)
            text = [*text]
            for _ in range(rng.randint(0, max(1, len(text) // 30))):
                text[rng.randrange(len(text))] = rng.choice(words)
    return texts


def test_the_same_components_as_a_plain_comparison(spark):
    texts = corpus()
    wanted = components(texts)
    assert len(set(wanted.values())) not in (1, len(texts))
    rows = [(i, t) for i, t in texts.items()] + [(None, texts[9]), (9, texts[9])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for how in ({}, {"block_shingles": 200}):
        got = [(r.doc_id, r.component_id) for r in N.near_copies(frame, **how).collect()]
        assert sorted(got, key=str) == sorted([*wanted.items(), (None, None), (9, wanted[9])], key=str)
    assert N.near_copies(frame.limit(0)).count() == 0


def test_the_stage_drops_copies_with_changed_words(spark):
    """A copy with one word in forty changed has a similarity over 0.8 and some ten differing bits."""
    rng = random.Random(8)
    rows = []
    for i in range(0, 40, 2):
        text = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows.append((i, " ".join(text)))
        for at in range(20, 200, 50):
            text[at] = "changed"
        assert similar(plain(rows[-1][1]), plain(" ".join(text)))
        rows.append((i + 1, " ".join(text)))
    kept = C.keep_one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in kept.collect()} == set(range(0, 40, 2))


def test_groups_come_from_fingerprints_compared_in_buckets(spark):
    """What the radius leaves out is not linked, and divided buckets give the same components."""
    texts = corpus()
    prints = {i: tuple(S.wide_fingerprint(N.shingles(t), N.WORDS)) for i, t in texts.items()}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    wanted = components(texts)
    same = {i: min(j for j in texts if wanted[j] == wanted[i] and prints[j] == prints[i]) for i in texts}
    assert same != wanted
    for how, expected in (({"radius": 0}, same), ({"bucket_rows": 2}, wanted)):
        assert {r.doc_id: r.component_id for r in N.near_copies(frame, **how).collect()} == expected


def bits(a, b):
    return sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(a, b, strict=True))


def test_the_similarity_is_within_the_radius():
    rng = random.Random(9)
    for n in [4] * 300 + [rng.randint(4, 600) for _ in range(300)]:
        common = np.array([rng.getrandbits(64) for _ in range(n)], np.uint64)
        more = np.array([rng.getrandbits(64) for _ in range(n // 4)], np.uint64)
        at = rng.choice([0, len(more) // 2])
        a, b = np.append(common, more[:at]), np.append(common, more[at:])
        a, b = (S.wide_fingerprint(x, N.WORDS) for x in (a, b))
        assert bits(a, b) <= N.RADIUS
    values = np.array([rng.getrandbits(64) for _ in range(700)], np.uint64)
    columns = [values.tolist(), S.mixed(values).tolist()]
    plain_bits = [sum(1 << b for b in range(64) if sum(v >> b & 1 for v in column) * 2 > len(column)) for column in columns]
    assert S.wide_fingerprint(values, 2) == [S.signed(v) for v in plain_bits]
    assert S.wide_fingerprint(values[:0], 2) == [0, 0]


def test_links_in_buckets_against_all_pairs(spark):
    rng = random.Random(10)
    rows = []
    for node in range(600):
        if node % 3 == 0:
            centre = [rng.getrandbits(64) for _ in range(2)]
        fp = [S.signed(word ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 12)))) for word in centre]
        rows += [(bucket, node, *fp) for bucket in {rng.choice([-5, 7]), rng.randint(0, 200)}]
    frame = spark.createDataFrame(rows, "bucket long, node long, a long, b long")
    for radius in (0, 1, 15, 16, 31):
        near = [(x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] > y[1] and bits(x[2:], y[2:]) <= radius]
        wanted = {r.node: r.root for r in S.components(spark.createDataFrame(near, "u long, v long")).collect()}
        for bucket_rows in (S.BUCKET_ROWS, 50):
            got = S.links_in_buckets(frame, radius, bucket_rows).collect()
            assert {(r.u, r.v) for r in got} <= set(near)
            assert {r.node: r.root for r in S.components(spark.createDataFrame(got, "u long, v long")).collect()} == wanted
