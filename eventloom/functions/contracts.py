"""What each dataset holds: column types, grain and value domains."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the event feed: accepted types with their category, and the outcomes in order of precedence.
CATEGORIES = {"PushEvent": "content", "PullRequestEvent": "collaboration", "IssuesEvent": "collaboration", "WatchEvent": "passive"}
QUALITY_REASONS = ("corrupt_json", "missing_event_id", "missing_event_type", "missing_repo_name", "missing_actor_login", "invalid_timestamp", "unsupported_event_type", "outside_date")
COPY_REASONS = ("conflicting_event_id", "duplicate_event_id")
REASONS = QUALITY_REASONS + COPY_REASONS

#: The raw lines that are read; other fields of a line are dropped by the parser.
RAW_SCHEMA = """
  id string, type string, created_at string, repo struct<name: string>, actor struct<login: string>, org struct<login: string>,
  payload struct<action: string, number: bigint, pull_request: struct<number: bigint>, issue: struct<number: bigint, labels: array<struct<name: string>>>>,
  _corrupt_record string
"""

BASE = {
    "event_id": "string", "event_type": "string", "created_at": "string", "repo_name": "string", "actor_login": "string", "org_login": "string",
    "payload_action": "string", "pr_number": "bigint", "issue_number": "bigint", "issue_labels": "array<string>", "source_file": "string", "event_date": "date",
}


@dataclass(frozen=True)
class Contract:
    columns: dict[str, str]
    grain: tuple[str, ...] = ()
    ranking: str | None = None


_DAY = {"event_date": "date"}
_COUNT = {"event_count": "bigint"}
DATASETS = {
    "ingested": Contract(BASE | {"corrupt_record": "string"}),
    "clean": Contract(BASE | {"event_timestamp": "timestamp", "event_hour": "int", "is_bot": "boolean", "event_category": "string"}, ("event_date", "event_id")),
    "rejected": Contract(BASE | {"corrupt_record": "string", "event_timestamp": "timestamp", "rejection_reason": "string"}),
    "event_counts": Contract(_DAY | {"event_type": "string", "event_hour": "int", "is_bot": "boolean"} | _COUNT, ("event_date", "event_type", "event_hour", "is_bot")),
    "daily_volume": Contract(_DAY | _COUNT, ("event_date",)),
    "top_repositories": Contract(_DAY | {"rank": "int", "repo_name": "string"} | _COUNT, ("event_date", "rank"), "repo_name"),
    "top_actors": Contract(_DAY | {"rank": "int", "actor_login": "string"} | _COUNT, ("event_date", "rank"), "actor_login"),
    "rejection_counts": Contract(_DAY | {"rejection_reason": "string"} | _COUNT, ("event_date", "rejection_reason")),
}
METRICS = ("event_counts", "daily_volume", "top_repositories", "top_actors", "rejection_counts")
RANKINGS = tuple(name for name in METRICS if DATASETS[name].ranking)
