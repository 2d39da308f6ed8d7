"""Guarded download of hourly archives: sizes are agreed on first, and every file is checked."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from pathlib import Path
from urllib.request import Request, urlopen

MAX_FILE, MAX_TOTAL = 128 << 20, 3 << 30
ATTEMPTS, PAUSE_S, BLOCK = 3, 2, 1 << 20


@dataclass(frozen=True)
class Archive:
    hour: int
    url: str
    head_bytes: int

    @property
    def name(self) -> str:
        return self.url.rpartition("/")[2]


def hours_of(hours: Iterable[int]) -> list[int]:
    found = list(hours)
    if found != sorted(set(found)) or any(not 0 <= h <= 23 for h in found):
        raise ValueError("hours must be different, in order and between 0 and 23")
    return found


def plan(day: str, hours: Iterable[int], base_url: str, open_url: Callable = urlopen) -> list[Archive]:
    """Ask for the size of each hour's archive."""
    found = []
    for hour in hours_of(hours):
        url = f"{base_url.rstrip('/')}/{day}-{hour}.json.gz"
        with open_url(Request(url, method="HEAD"), timeout=60) as answer:
            found.append(Archive(hour, url, int(answer.headers["Content-Length"])))
    return found


def check_plan(archives: list[Archive], day: str, hours: list[int], base_url: str, max_file: int = MAX_FILE, max_total: int = MAX_TOTAL) -> None:
    expected = [f"{base_url.rstrip('/')}/{day}-{h}.json.gz" for h in hours]
    if [a.url for a in archives] != expected or [a.hour for a in archives] != hours:
        raise ValueError("the plan is not of these hours")
    if any(not 0 < a.head_bytes <= max_file for a in archives):
        raise ValueError("an archive is larger than allowed")
    if sum(a.head_bytes for a in archives) > max_total:
        raise ValueError("the archives together are larger than allowed")


def fetch(archive: Archive, folder: str | Path, max_file: int = MAX_FILE, open_url: Callable = urlopen, pause: float = PAUSE_S) -> dict:
    """Download one archive, or reuse a file of the agreed size; returns its size and digest."""
    target = Path(folder) / archive.name
    target.parent.mkdir(parents=True, exist_ok=True)
    reused = target.exists()
    for attempt in range(0 if reused else ATTEMPTS):
        try:
            download(archive, target, max_file, open_url)
            break
        except Exception:
            if attempt + 1 == ATTEMPTS:
                raise
            time.sleep(pause)
    if target.stat().st_size != archive.head_bytes:
        raise ValueError(f"{target} has another size than planned")
    with target.open("rb") as file:
        return asdict(archive) | {"bytes": archive.head_bytes, "sha256": hashlib.file_digest(file, "sha256").hexdigest(), "reused": reused}


def download(archive: Archive, target: Path, max_file: int, open_url: Callable) -> None:
    part = target.with_name(f"{target.name}.partial")
    try:
        size = 0
        with open_url(Request(archive.url), timeout=60) as answer, part.open("wb") as file:
            while block := answer.read(BLOCK):
                size += len(block)
                if size > min(max_file, archive.head_bytes):
                    raise ValueError("more bytes than agreed")
                file.write(block)
        if size != archive.head_bytes:
            raise ValueError("fewer bytes than agreed")
        part.replace(target)
    finally:
        part.unlink(missing_ok=True)


def acquire(day: str, archives: list[Archive], folder: str | Path, manifest: str | Path, **how) -> dict:
    """Fetch all archives; the manifest is rewritten after each and says whether all are there."""
    state = {"date": day, "sources": [asdict(a) for a in archives], "completed": [], "complete": False}

    def save() -> None:
        path = Path(manifest)
        path.parent.mkdir(parents=True, exist_ok=True)
        draft = path.with_name(f"{path.name}.tmp")
        draft.write_text(json.dumps(state, indent=2, sort_keys=True))
        draft.replace(path)

    save()
    for archive in archives:
        state["completed"].append(fetch(archive, folder, **how))
        save()
    state["complete"] = True
    save()
    return state


def covered(manifest: dict, found: dict[str, tuple[int, str]]) -> bool:
    """Whether the manifest is complete and of exactly these files: names, sizes and digests."""
    told = {c["url"].rpartition("/")[2]: (c["bytes"], c["sha256"]) for c in manifest["completed"]}
    return bool(manifest["complete"]) and len(told) == len(manifest["completed"]) and told == found
