"""Whole days against golden numbers and the independent expectation."""

import hashlib
import itertools
import json

import pytest
from feed import DAY, NEXT, copied, edges, golden, put
from pyspark.sql import functions as F

from eventloom.functions.contracts import DATASETS
from eventloom.operators.compare import differences, fingerprint, same_rows
from eventloom.operators.copies import tag_copies, tag_copies_hashed, tag_copies_skewed
from eventloom.operators.daily import BUSINESS, KEY, transform
from eventloom.plans import verify
from eventloom.plans.jobs import Jobs
from eventloom.plans.policy import ShufflePolicy
from eventloom.plans.store import StoreError
from eventloom.sources.events import ingest
from eventloom.sources.published import read_day, write_day


def jobs(spark, tmp_path):
    return Jobs(spark, tmp_path / "raw", tmp_path / "out", policy=ShufflePolicy(spark, explicit=2))


def test_golden_day(spark, tmp_path):
    golden(tmp_path / "raw")
    rows = jobs(spark, tmp_path).run("pipeline", DAY)
    assert rows == {"ingested": 13, "clean": 8, "rejected": 5, "event_counts": 6, "daily_volume": 1, "top_repositories": 2, "top_actors": 3, "rejection_counts": 5}
    read = lambda name: read_day(spark, tmp_path / "out" / name, DAY)
    assert [tuple(r) for r in read("top_actors").orderBy("rank").select("rank", "actor_login", "event_count").collect()] == [(1, "alice", 4), (2, "bob", 2), (3, "ci[bot]", 2)]
    assert [tuple(r) for r in read("top_repositories").orderBy("rank").select("repo_name", "event_count").collect()] == [("acme/alpha", 5), ("acme/beta", 3)]
    clean = {r.event_id: r for r in read("clean").collect()}
    assert (clean["4"].pr_number, clean["5"].pr_number, clean["6"].issue_labels, clean["8"].org_login) == (42, 43, ["bug", "help wanted"], None)
    assert sum(r.is_bot for r in clean.values()) == 2 and clean["6"].event_category == "collaboration"
    assert {r.rejection_reason: r.event_count for r in read("rejection_counts").collect()} == dict.fromkeys(("corrupt_json", "missing_actor_login", "invalid_timestamp", "unsupported_event_type", "outside_date"), 1)
    assert jobs(spark, tmp_path).run("pipeline", NEXT)["rejection_counts"] == 0
    # Again, from a later stage: the same rows.
    before = [fingerprint(read(n)).first() for n in DATASETS]
    jobs(spark, tmp_path).run("pipeline", DAY, "transform")
    assert [fingerprint(read(n)).first() for n in DATASETS] == before


@pytest.mark.parametrize(("make", "clean", "rejected"), [(golden, 8, 5), (copied, 3, 10), (edges, 3, 8)])
def test_the_independent_expectation(spark, tmp_path, make, clean, rejected):
    make(tmp_path / "raw")
    rows = jobs(spark, tmp_path).run("pipeline", DAY)
    assert (rows["clean"], rows["rejected"]) == (clean, rejected)
    verify.write_expected(tmp_path / "raw", DAY, tmp_path / "expected")
    found = verify.validate_day(spark, tmp_path / "out", DAY, tmp_path / "expected")
    assert found["passed"], [k for k, v in found["checks"].items() if not v]
    # A swap of counts that keeps every total is found.
    path = tmp_path / "expected" / "rejection_counts.jsonl"
    changed = [json.loads(x) for x in path.read_text().splitlines()]
    changed[0]["event_count"] += 1
    path.write_text("\n".join(map(json.dumps, changed)))
    assert not verify.validate_day(spark, tmp_path / "out", DAY, tmp_path / "expected")["passed"]


def test_validation_looks_at_contents(spark, tmp_path):
    """Sources by size and digest; outcomes by a recount; old layouts by their rows."""
    golden(tmp_path / "raw")
    jobs(spark, tmp_path).run("pipeline", DAY)
    verify.write_expected(tmp_path / "raw", DAY, tmp_path / "expected")
    files = [p for p in (tmp_path / "raw").iterdir() if p.name.startswith(DAY)]
    done = [{"url": f"https://x/{p.name}", "bytes": p.stat().st_size, "sha256": hashlib.sha256(p.read_bytes()).hexdigest()} for p in files]
    validate = lambda **how: verify.validate_day(spark, tmp_path / "out", DAY, tmp_path / "expected", **how)
    found = validate(manifest={"complete": True, "completed": done})
    assert found["passed"] and found["profile"]["bots"] == {"False": 6, "True": 2} and found["files"]["clean"]["most_bytes"] >= found["files"]["clean"]["least_bytes"] > 0
    files[0].write_bytes(files[0].read_bytes()[:-1] + b"x")
    assert not validate(manifest={"complete": True, "completed": done})["checks"]["sources"]
    for name in DATASETS:
        read_day(spark, tmp_path / "out" / name, DAY).write.partitionBy("event_date").parquet(str(tmp_path / "plain" / name))
    assert verify.compare_plain(spark, tmp_path / "plain", tmp_path / "out", DAY) == dict.fromkeys(DATASETS, True)
    # A rejected row whose reason is swapped for another keeps all totals of rows.
    rejected = read_day(spark, tmp_path / "out" / "rejected", DAY)
    swapped = rejected.withColumn("rejection_reason", F.when(F.col("rejection_reason") == "outside_date", "corrupt_json").otherwise(F.col("rejection_reason")))
    spark.createDataFrame(swapped.collect(), rejected.schema).transform(lambda f: write_day(f, tmp_path / "out" / "rejected", DAY) and f)
    checks = validate()["checks"]
    assert not checks["rejected: recount"] and not checks["rejection_counts: recount"] and checks["ingested = clean + rejected"]
    assert not verify.compare_plain(spark, tmp_path / "plain", tmp_path / "out", DAY)["rejected"]


def test_outcomes_do_not_depend_on_order(spark, tmp_path):
    copied(tmp_path / "raw")
    seen = ingest(spark, tmp_path / "raw", DAY).cache()
    expected = [fingerprint(f).first() for f in transform(seen, DAY)]
    for n in (1, 7):
        assert [fingerprint(f).first() for f in transform(seen.repartition(n), DAY)] == expected
    counts = {}
    for r in transform(seen, DAY)[1].collect():
        counts[r.rejection_reason] = counts.get(r.rejection_reason, 0) + 1
    assert counts == {"duplicate_event_id": 2, "conflicting_event_id": 4, "missing_actor_login": 1, "invalid_timestamp": 1, "outside_date": 1, "corrupt_json": 1}
    assert {r.event_id for r in transform(seen, DAY)[0].collect()} == {"1", "3", "4"}
    seen.unpersist()


def test_ways_to_tag_copies_agree(spark):
    """Null and empty, order of labels and text of the same moment: all differ, though a hash may not."""
    labels = [None, [], ["a", "b"], ["b", "a"], ["a", None]]
    rows, n = [], itertools.count()
    for a, b in itertools.product(labels, labels):
        for source in (None, "f1"):
            i = next(n)
            rows += [(str(i), a, None, "x", "f2"), (str(i), b, None, "x", source)]
    rows += [("c", None, None, "x", "f"), ("c", None, "x", None, "f")] + [("hot", None, None, None, "f")] * 500
    frame = spark.createDataFrame(rows, "k string, labels array<string>, a string, b string, f string")
    ways = [way(frame, ["k"], ["labels", "a", "b"], "f") for way in (tag_copies, tag_copies_hashed, tag_copies_skewed)]
    assert same_rows(ways[0], ways[1]) and same_rows(ways[0], ways[2])
    by_key = {}
    for r in ways[0].collect():
        by_key.setdefault(r.k, []).append((r.rejection_reason, r.f))
    assert {x for x, _ in by_key["c"]} == {"conflicting_event_id"}
    assert sorted(str(x) for x, _ in by_key["hot"]) == ["None"] + ["duplicate_event_id"] * 499
    assert (None, "f1") in by_key["1" if False else next(k for k, v in by_key.items() if ("duplicate_event_id", "f2") in v)]


def test_empty_days_and_missing_input(spark, tmp_path):
    put(tmp_path / "raw", f"{DAY}-0")
    rows = jobs(spark, tmp_path).run("pipeline", DAY)
    assert set(rows.values()) == {0}
    for name, contract in DATASETS.items():
        assert dict(read_day(spark, tmp_path / "out" / name, DAY).dtypes) == contract.columns
    with pytest.raises(FileNotFoundError):
        jobs(spark, tmp_path).run("ingest", NEXT)
    assert not (tmp_path / "out" / "ingested" / f"event_date={NEXT}").exists()
    with pytest.raises(ValueError, match="unknown stage"):
        jobs(spark, tmp_path).run("other", DAY)
    with pytest.raises(StoreError):
        jobs(spark, tmp_path).run("aggregate", NEXT)


def test_comparison_counts_repetitions(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "n int, s string")
    b = spark.createDataFrame([("x", 1), (None, 2), (None, 2)], "s string, n int")
    assert sorted(tuple(r) for r in differences(a, b).select("side", "n").collect()) == [("left", 1), ("right", 2)]
    assert same_rows(a, a.repartition(3)) and not same_rows(a, b)
    assert fingerprint(a).first() == fingerprint(a.orderBy("s")).first() != fingerprint(b).first()


def test_plan_has_one_exchange_for_all_windows(spark):
    frame = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in DATASETS["ingested"].columns.items()) + ", event_timestamp timestamp")
    plan = tag_copies(frame, KEY, BUSINESS, "source_file")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_write_guards(spark, tmp_path):
    frame = spark.createDataFrame([("a", None)], "v string, event_date date")
    with pytest.raises(ValueError, match="another day"):
        write_day(frame, tmp_path / "d", DAY)
    with pytest.raises(ValueError, match="must be a date"):
        write_day(frame.select("v"), tmp_path / "d", DAY)
    with pytest.raises(StoreError):
        read_day(spark, tmp_path / "d", DAY)
