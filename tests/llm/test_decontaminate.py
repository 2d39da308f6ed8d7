"""Matches against a plain approximate search."""

import random
import re
import tracemalloc

from eventloom.llm import decontaminate as D


def plain(item, text):
    """Fewest edits between the item and any part of the text (Sellers)."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(item, 1):
            new.append(min(row[i - 1] + (p != c), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        kind = rng.random()
        if kind < 0.4:
            text[at] = rng.choice("abcdexyz é")
        elif kind < 0.7:
            del text[at]
        else:
            text.insert(at, rng.choice("abcdexyz é"))
    return "".join(text)


def words(rng, n):
    parts = ["tion", "the", "er", "an", "on", "é", "in", "re", "ing", "st"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_the_same_matches_as_a_plain_search():
    rng = random.Random(5)
    items = [(i, words(rng, rng.randint(6, 40))) for i in range(12)]
    items += [(12 + k, "".join(rng.choice("abcdexyz ") for _ in range(m - 2)).strip().ljust(m, "q")) for k, m in enumerate((30, 31, 32, 33, 45, 59))]
    index = D.Index(items)
    at = {i: k for k, i in enumerate(index.ids)}
    texts = []
    for _ in range(60):
        item = rng.choice(items)[1]
        texts.append(words(rng, rng.randint(0, 60)) + " " + edited(rng, item, rng.randint(0, int(len(item) * 0.13))) + " " + words(rng, rng.randint(0, 60)))
    hits = 0
    for text, found in zip(texts, index.search(texts), strict=True):
        got = {item: (edits, start, end) for edits, start, end, item in found}
        for i, item in items:
            if i not in at:
                continue
            fewest = plain(D.normalize(item)[0].tolist(), D.normalize(text)[0].tolist())
            if fewest <= index.budget[at[i]]:
                edits, start, end = got[at[i]]
                assert edits == fewest
                assert plain(D.normalize(item)[0].tolist(), D.normalize(text[start:end])[0].tolist()) == fewest
                hits += 1
            else:
                assert at[i] not in got
    assert hits > 30


def test_budgets_and_q_of_short_items():
    index = D.Index([(m, "x" * m) for m in (1, 5, 8, 29, 30, 31, 32, 39, 40, 71, 80)])
    assert index.budget.tolist() == [0, 0, 0, 0, 3, 3, 3, 3, 4, 7, 8]
    for group in index.groups:
        assert (group.least >= 1).all()


def test_short_items_are_found_as_whole_words():
    items = ["zebra", "a b", "x", "le 7", "exactly twenty-nine letters ok", "é"]
    index = D.Index(list(enumerate(items)))
    texts = ["one Zebra, two", "zebras and azebra", "A  B", "a bc", "", "x", "ax", "le 7.", "le 77", "exactly TWENTY-nine\nletters ok", "an É here", "zebra" * 3 + " zebra"]
    got = [[(items[item], start, end) for _, start, end, item in found] for found in index.search(texts)]
    expected = []
    for text in texts:
        own = []
        for item in items:
            pattern = r"(?<!\w)" + r"\s+".join(map(re.escape, item.split())) + r"(?!\w)"
            if m := re.search(pattern, text, re.I):
                own.append((item, m.start(), m.end()))
        expected.append(own)
    assert got == expected


def test_long_items_with_many_hits_take_bounded_memory():
    rng = random.Random(9)
    item = words(rng, 400)
    index = D.Index([(k, item[: len(item) - k]) for k in range(12)])
    tracemalloc.start()
    found = index.search([item + " tail", edited(rng, item, 60)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) == len(found[1]) == 12 and len(item) > 2000
    assert peak < 200e6


def test_whole_texts_in_pieces(monkeypatch):
    rng = random.Random(6)
    item = words(rng, 30)
    monkeypatch.setattr(D, "PIECE", 500)
    index = D.Index([(7, item)])
    for before in range(0, 1200, 37):
        text = words(rng, 400)[:before] + "\n\n " + item.upper().replace(" ", "  ") + " " + words(rng, 50)
        ((edits, start, end, _),) = index.search([text])[0]
        assert edits == 0 and text[start:end].lower().split() == item.split()


def test_edges(spark):
    rng = random.Random(7)
    item = words(rng, 20)
    rows = [(1, None, 0), (2, "", 0), (3, item, 0), (3, item, 0), (None, "x " + item, 0), (4, words(rng, 200), 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(10, item), (10, item), (11, None), (12, "short"), (13, words(rng, 30)), (14, " "), (None, item), (15, "x")], "item_id long, text string")
    for block in (D.ITEM_BLOCK, 1):
        got = sorted(((r.doc_id, r.item_id, r.edits) for r in D.contaminated(docs, bench, item_block=block).collect()), key=str)
        assert got == sorted([(3, 10, 0)] * 4 + [(None, 10, 0)] * 2 + [(3, None, 0)] * 2 + [(None, None, 0), (None, 15, 0)], key=str)
    assert D.contaminated(docs.limit(0), bench).count() == 0
    assert D.contaminated(docs, bench.limit(0)).count() == 0
