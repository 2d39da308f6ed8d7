"""Small raw days."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

DAY, NEXT = "2025-06-01", "2025-06-02"


def event(number, kind="PushEvent", at=f"{DAY}T00:10:00Z", repo="acme/alpha", actor="alice", **more):
    e = {"id": str(number), "type": kind, "created_at": at, "repo": {"id": 1, "name": repo}, "actor": {"id": 2, "login": actor}, "org": {"login": "acme"}, "payload": {"size": 1}, "public": True}
    return e | more


def put(folder, name, *lines):
    Path(folder).mkdir(parents=True, exist_ok=True)
    with gzip.open(Path(folder) / f"{name}.json.gz", "wt", encoding="utf-8") as file:
        file.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)


def golden(folder):
    """Thirteen lines, eight of them clean, and a second day of two."""
    put(folder, f"{DAY}-0", event(1), event(2, at=f"{DAY}T00:20:00Z"), event(3, actor="ci[bot]", repo="acme/beta", at=f"{DAY}T01:10:00Z"),
        event(4, "PullRequestEvent", f"{DAY}T01:20:00Z", payload={"number": 42, "pull_request": {"number": 42}}))
    put(folder, f"{DAY}-1",
        event(5, "PullRequestEvent", f"{DAY}T01:30:00Z", "acme/beta", "ci[bot]", payload={"number": 43}),
        event(6, "IssuesEvent", f"{DAY}T02:10:00Z", actor="bob", payload={"issue": {"number": 7, "labels": [{"name": "bug"}, {"name": "help wanted"}]}}),
        event(7, "WatchEvent", f"{DAY}T02:20:00Z"), event(8, "WatchEvent", f"{DAY}T02:30:00Z", "acme/beta", "bob", org=None),
        event(9, "ForkEvent", f"{DAY}T03:00:00Z"), event(10, actor=None, at=f"{DAY}T03:10:00Z"), event(11, at="not-a-timestamp"), event(12, "WatchEvent", f"{NEXT}T00:00:00Z"),
        '{"id": "broken", "type":')
    put(folder, f"{NEXT}-0", event(20, at=f"{NEXT}T05:00:00Z"), event(21, "WatchEvent", f"{NEXT}T06:00:00Z"))


def copied(folder):
    """Thirteen lines: copies that agree, differ, or have an invalid one among them; three stay."""
    pr = {"number": 42, "pull_request": {"number": None}}
    labels = lambda *names: {"issue": {"number": 1, "labels": [{"name": n} for n in names]}}
    put(folder, f"{DAY}-0", event(1), event(1), event(2), event(3), event(4, "PullRequestEvent", payload=pr), event(5, "IssuesEvent", payload=labels("a", "b")))
    put(folder, f"{DAY}-1", event(1), event(2, actor="bob"), event(3, actor=None), event(5, "IssuesEvent", payload=labels("b", "a")), event(6, at="x"), event(7, at=f"{NEXT}T00:00:00Z"), "{")


def edges(folder):
    put(folder, f"{DAY}-0",
        event("", None, "bad", "", None), event(2, None, "bad", "", None), event(3, "ForkEvent", "bad", " ", None), event(4, "ForkEvent", "bad", actor="  "), event(5, "ForkEvent", "bad"),
        event(6, "ForkEvent", f"{NEXT}T00:00:00Z"), event(7, at=f"{DAY}T00:30:00+01:00"), event(8, at="2025-05-31T23:30:00-01:00", actor="APP[BoT]"), event(9, actor="app[bot]middle"),
        event(10, actor=" dependabot ", at=f"{DAY}T05:00:00.123+02:00"), "[1, 2]")
