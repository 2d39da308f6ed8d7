"""Best fit against a plain search, and a lossless round trip."""

import random
from collections import Counter

import numpy as np

from eventloom.llm import packing as P
from eventloom.llm.bpe import vocabulary_path


def plain(sizes, width):
    rows, rooms = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in range(len(rows)) if rooms[r] >= sizes[i]]
        if fits:
            row = min(fits, key=lambda r: rooms[r])
        else:
            rows.append([])
            rooms.append(width)
            row = len(rows) - 1
        rows[row].append(i)
        rooms[row] -= sizes[i]
    return rows, rooms


def test_best_fit():
    rng = random.Random(4)
    for width, most in ((1, 1), (7, 7), (64, 64), (100, 100), (64, 9), (100, 30)):
        for n in (1, 3, 400):
            sizes = [rng.randint(1, most) for _ in range(n)]
            counts = Counter(sizes)
            steps, number = P.best_fit(counts, width)
            used: dict[int, list[tuple[int, int]]] = {}
            for size, c in counts.items():
                for rank in range(c):
                    first, row, each, at = max(s for s in steps[size] if s[0] <= rank)
                    used.setdefault(row + (rank - first) // each, []).append((at + (rank - first) % each * size, size))
            assert sorted(used) == list(range(number))
            rooms = []
            for row in used.values():  # pieces follow each other without a gap
                at = 0
                for start, size in sorted(row):
                    assert start == at
                    at += size
                assert at <= width
                rooms.append(width - at)
            assert sorted(rooms) == sorted(plain(sizes, width)[1])


def test_the_result_does_not_depend_on_partitions(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i % 390, " ".join(rng.choice(["one", "été", "x1", "long", "\n"]) for _ in range(rng.randint(0, 200)))) for i in range(400)]
    rows += [(7, "same words again")] * 50
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    for parts in (1, 16, 128):
        packed = P.pack(frame.repartition(parts), width=96, group_pieces=20)
        seen.append(sorted((r.row_id, bytes(r.ids), r.cu_seqlens, r.doc_ids, r.offsets) for r in packed.collect()))
    assert seen[0] == seen[1] == seen[2]
    assert [r[0] for r in seen[0]] == list(range(len(seen[0])))
    sizes = [b - a for r in seen[0] for a, b in zip(r[2][:-1], r[2][1:], strict=True)]
    assert len(seen[0]) == len(plain(sizes, 96)[0])
    index = P.write_binary(packed, f"{tmp_path}/out")
    assert index["rows"] == len(seen[0]) and index["tokens"] == sum(sizes)
    ids, resets = [], []
    for name in (f["name"] for f in index["files"]):
        part = lambda kind, name=name: np.fromfile(f"{tmp_path}/out/{name}.{kind}", "<i4")
        ids += [r.tobytes() for r in part("ids").reshape(-1, 96)]
        segments, at, cu = part("segments"), 0, part("cu")
        assert len(part("resets")) == segments.sum() and len(cu) == (segments + 1).sum()
        for n in segments:
            resets.append(cu[at : at + n].tolist())
            at += n + 1
        assert [x for r in resets[-len(segments) :] for x in r] == part("resets").tolist()
    assert sorted(ids) == sorted(r[1] for r in seen[0])


def test_round_trip_and_edges(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["été", "the", "x1", "\n"]) for _ in range(rng.randint(0, 300))), 0) for i in range(60)]
    rows += [(100, None, 0), (101, "", 0), (None, "no id here", 0), (102, "word " * 30_000, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    tokens: dict = {}
    for r in P.pack(frame, width=128).collect():
        ids = np.frombuffer(r.ids, "<i4")
        assert len(ids) == 128 and r.cu_seqlens[-1] <= 128 and r.resets == r.cu_seqlens[:-1]
        assert (ids[r.cu_seqlens[-1] :] == P.PAD).all()
        for doc, at, a, b in zip(r.doc_ids, r.offsets, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            tokens.setdefault(doc, {})[at] = ids[a:b].tolist()
    model = P.encoder(open(vocabulary_path(P.VOCABULARY), "rb").read())
    for doc, text, _ in rows:
        whole = [t for at in sorted(tokens.get(doc, {})) for t in tokens[doc][at]]
        assert model.decode(whole) == (text or "")
    assert P.pack(frame.limit(0)).count() == 0
