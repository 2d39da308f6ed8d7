"""The query catalogue: each operator over the driver's tables, with its SQL twin.

The tables hold no raw archives, so the event queries derive them: every row of `events`
becomes a raw event, and defects come from arithmetic on its id, written the same way in SQL.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import date

import duckdb
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import first_of, has_suffix, lookup
from ..functions.contracts import CATEGORIES
from ..operators import compare, copies, daily, metrics, rules
from ..sources import events, footers, published
from ..sources.scratch import local_path, scratch
from .export import export_day, verify_export
from .jobs import Jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The processing day of queries that judge events against one.
DAY = "2024-01-15"
TYPES = {"click": "PushEvent", "view": "WatchEvent", "signup": "IssuesEvent", "purchase": "PullRequestEvent"}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        QUERIES[name], SQL[name] = run, sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(n: int) -> Column:
    return F.col("event_id") % n == 0


def raw_lines(spark: SparkSession, sf_dir: str, broken_every: int | None = None) -> str:
    """Write the events as gzip JSON Lines, some of them cut off; returns the folder."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    payload = F.struct(
        F.lit("opened").alias("action"),
        k.alias("number"),
        F.struct(F.when(every(2), F.col("event_id")).alias("number")).alias("pull_request"),
        F.struct(F.col("user_id").alias("number"), F.array(F.struct(F.col("event_type").alias("name")), F.struct(F.concat(F.lit("k"), k.cast("string")).alias("name"))).alias("labels")).alias("issue"),
    )
    line = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.coalesce(lookup(TYPES, F.col("event_type")), F.lit("ForkEvent")).alias("type"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
            F.struct(F.concat(F.lit("acme/r"), (F.col("user_id") % 20).cast("string")).alias("name")).alias("repo"),
            F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("login")).alias("actor"),
            payload.alias("payload"),
        )
    )
    if broken_every:
        line = F.when(every(broken_every), F.substring(line, 1, 30)).otherwise(line)
    folder = scratch(spark, "raw-json")
    table(spark, sf_dir, "events").select(line.alias("value")).write.option("compression", "gzip").text(folder)
    return folder


def raw_json(spark: SparkSession, sf_dir: str, broken_every: int | None = None) -> DataFrame:
    """Scan the written events; what the scan found is written before it is judged."""
    seen = scratch(spark, "ingested")
    events.normalise(events.scan(spark, [raw_lines(spark, sf_dir, broken_every)]), DAY).write.parquet(seen)
    return spark.read.parquet(seen)


def defective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised events with one or more defects in some rows."""
    e = table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return e.select(
        F.when(every(41), "   ").otherwise(F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit("  "))).alias("event_id"),
        F.when(every(43), None).when(every(13), "ForkEvent").otherwise(F.coalesce(lookup(TYPES, F.col("event_type")), F.lit("PushEvent "))).alias("event_type"),
        F.when(every(59), "not-a-timestamp").when(every(61), text).when(every(3), F.concat(text, F.lit("+02:00"))).otherwise(F.concat(text, F.lit("Z"))).alias("created_at"),
        F.when(every(47), "").otherwise(F.concat(F.lit("acme/r"), (F.col("user_id") % 20).cast("string"))).alias("repo_name"),
        F.when(every(53), None).when(F.col("user_id") % 10 == 0, F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("[BoT]"))).otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("actor_login"),
        F.when(every(67), "{bad").alias("corrupt_record"),
        F.col("event_id").alias("n"),
    )


RAW_SQL = """raw AS (
  SELECT event_id, user_id, ts, event_type AS kind, CAST(event_id AS VARCHAR) AS id,
    CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent' WHEN 'signup' THEN 'IssuesEvent' WHEN 'purchase' THEN 'PullRequestEvent' ELSE 'ForkEvent' END AS type,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at, 'acme/r' || CAST(user_id % 20 AS VARCHAR) AS repo_name, 'u' || CAST(user_id AS VARCHAR) AS actor_login,
    CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
)"""

JUDGED_SQL = f"""given AS (
  SELECT event_id AS n, user_id,
    CASE WHEN event_id % 41 = 0 THEN '   ' ELSE ' ' || CAST(event_id AS VARCHAR) || '  ' END AS event_id,
    CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'ForkEvent' ELSE CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent'
      WHEN 'signup' THEN 'IssuesEvent' WHEN 'purchase' THEN 'PullRequestEvent' ELSE 'PushEvent ' END END AS event_type,
    CASE WHEN event_id % 59 = 0 THEN 'not-a-timestamp' WHEN event_id % 61 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS created_at,
    CASE WHEN event_id % 47 = 0 THEN '' ELSE 'acme/r' || CAST(user_id % 20 AS VARCHAR) END AS repo_name,
    CASE WHEN event_id % 53 = 0 THEN NULL WHEN user_id % 10 = 0 THEN 'U' || CAST(user_id AS VARCHAR) || '[BoT]' ELSE 'u' || CAST(user_id AS VARCHAR) END AS actor_login,
    CASE WHEN event_id % 67 = 0 THEN '{{bad' END AS corrupt_record FROM events
), parsed AS (
  SELECT n, trim(event_id, ' ') AS event_id, trim(event_type, ' ') AS event_type, trim(repo_name, ' ') AS repo_name, trim(actor_login, ' ') AS actor_login, corrupt_record,
    CASE WHEN regexp_full_match(created_at, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T([01][0-9]|2[0-3]):[0-9]{{2}}:[0-9]{{2}}([.][0-9]{{1,6}})?(Z|[+-](0[0-9]|1[0-8]):[0-9]{{2}})')
      THEN CASE WHEN created_at LIKE '%Z' THEN TRY_CAST(replace(replace(created_at, 'T', ' '), 'Z', '') AS TIMESTAMP)
        ELSE TRY_CAST(replace(created_at[1:19], 'T', ' ') AS TIMESTAMP) - INTERVAL 1 HOUR * CAST(created_at[20:22] AS INTEGER) END END AS moment FROM given
), judged AS (
  SELECT *, CASE WHEN corrupt_record IS NOT NULL THEN 'corrupt_json' WHEN coalesce(event_id, '') = '' THEN 'missing_event_id' WHEN coalesce(event_type, '') = '' THEN 'missing_event_type'
    WHEN coalesce(repo_name, '') = '' THEN 'missing_repo_name' WHEN coalesce(actor_login, '') = '' THEN 'missing_actor_login' WHEN moment IS NULL THEN 'invalid_timestamp'
    WHEN event_type NOT IN ('PushEvent', 'PullRequestEvent', 'IssuesEvent', 'WatchEvent') THEN 'unsupported_event_type' WHEN CAST(moment AS DATE) <> DATE '{DAY}' THEN 'outside_date' END AS rejection_reason
  FROM parsed
)"""


@query("q01_json_roundtrip", f"WITH {RAW_SQL} SELECT id AS event_id, type AS event_type, created_at, repo_name, actor_login, CAST(NULL AS VARCHAR) AS org_login, 'opened' AS payload_action, user_id AS issue_number FROM raw")
def q01(spark, sf_dir):
    return raw_json(spark, sf_dir).select("event_id", "event_type", "created_at", "repo_name", "actor_login", "org_login", "payload_action", "issue_number")


@query("q02_corrupt_capture", "SELECT event_id % 50 = 0 AS corrupt, count(*) AS n FROM events GROUP BY 1")
def q02(spark, sf_dir):
    return raw_json(spark, sf_dir, 50).groupBy(F.col("corrupt_record").isNotNull().alias("corrupt")).agg(F.count(F.lit(1)).alias("n"))


@query("q03_array_fields", f"WITH {RAW_SQL} SELECT id AS event_id, 2 AS n_labels, kind || ',k' || CAST(k AS VARCHAR) AS labels FROM raw")
def q03(spark, sf_dir):
    return raw_json(spark, sf_dir).select("event_id", F.size("issue_labels").alias("n_labels"), F.array_join("issue_labels", ",").alias("labels"))


@query("q04_conditional_coalesce", "SELECT event_id, CASE WHEN event_type = 'purchase' THEN coalesce(CASE WHEN event_id % 2 = 0 THEN event_id END, CAST(json_extract(props, '$.k') AS BIGINT)) END AS pr_number FROM events")
def q04(spark, sf_dir):
    number = first_of(F.col("event_type") == "purchase", F.when(every(2), F.col("event_id")), F.get_json_object("props", "$.k").cast("bigint"))
    return table(spark, sf_dir, "events").select("event_id", number.alias("pr_number"))


@query("q05_quality_reason", f"WITH {JUDGED_SQL} SELECT n, event_id, event_type, moment AS event_timestamp, rejection_reason FROM judged")
def q05(spark, sf_dir):
    judged = rules.classify(defective(spark, sf_dir), DAY)
    return judged.select("n", "event_id", "event_type", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"), "rejection_reason")


@query("q06_quarantine_split", f"WITH {JUDGED_SQL} SELECT CASE WHEN rejection_reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, count(*) AS n FROM judged GROUP BY 1")
def q06(spark, sf_dir):
    accepted, rejected = rules.split(rules.classify(defective(spark, sf_dir), DAY))
    both = accepted.select(F.lit("accepted").alias("outcome")).unionByName(rejected.select(F.lit("rejected").alias("outcome")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_REST = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query("q07_copy_count", "SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem")
def q07(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey", F.count(F.lit(1)).over(Window.partitionBy(*LINE_KEY)).alias("copies"))


@query("q08_conflict_flag", f"SELECT l_orderkey, l_linenumber, count(DISTINCT ({', '.join(LINE_REST)})) > 1 AS conflict FROM lineitem GROUP BY ALL")
def q08(spark, sf_dir):
    tagged = copies.tag_copies(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_REST, "l_shipdate")
    return tagged.groupBy(*LINE_KEY).agg(F.bool_or(F.coalesce(F.col("rejection_reason") == copies.CONFLICT, F.lit(False))).alias("conflict"))


COPIES_SQL = f"""given AS (SELECT *, 'a' AS source FROM lineitem UNION ALL SELECT *, 'b' FROM lineitem WHERE l_partkey % 7 = 0 UNION ALL SELECT *, NULL FROM lineitem WHERE l_partkey % 11 = 0),
seen AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY source ASC NULLS LAST) AS copy,
  count(DISTINCT ({", ".join(LINE_REST)})) OVER (PARTITION BY l_orderkey, l_linenumber) AS kinds FROM given)"""


def given_copies(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    tagged = [lines.withColumn("source", F.lit("a")), lines.filter("l_partkey % 7 = 0").withColumn("source", F.lit("b")), lines.filter("l_partkey % 11 = 0").withColumn("source", F.lit(None).cast("string"))]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


Q09_SQL = f"WITH {COPIES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, source, CASE WHEN kinds > 1 THEN '{copies.CONFLICT}' WHEN copy > 1 THEN '{copies.DUPLICATE}' END AS rejection_reason FROM seen"


@query("q09_dedup_keep_first", Q09_SQL)
def q09(spark, sf_dir):
    return copies.tag_copies(given_copies(spark, sf_dir), LINE_KEY, LINE_REST, "source").select(*LINE_KEY, "l_partkey", "source", "rejection_reason")


@query("q09_dedup_keep_first_skewed", Q09_SQL)
def q09_skewed(spark, sf_dir):
    return copies.tag_copies_skewed(given_copies(spark, sf_dir), LINE_KEY, LINE_REST, "source").select(*LINE_KEY, "l_partkey", "source", "rejection_reason")


@query("q09_dedup_keep_first_hashed", Q09_SQL)
def q09_hashed(spark, sf_dir):
    return copies.tag_copies_hashed(given_copies(spark, sf_dir), LINE_KEY, LINE_REST, "source").select(*LINE_KEY, "l_partkey", "source", "rejection_reason")


@query(
    "q10_dimensions",
    f"WITH {JUDGED_SQL} SELECT n, CAST(moment AS DATE) AS event_date, CAST(hour(moment) AS INTEGER) AS event_hour, suffix(lower(actor_login), '[bot]') AS is_bot, "
    "CASE event_type WHEN 'PushEvent' THEN 'content' WHEN 'PullRequestEvent' THEN 'collaboration' WHEN 'IssuesEvent' THEN 'collaboration' WHEN 'WatchEvent' THEN 'passive' END AS event_category FROM judged",
)
def q10(spark, sf_dir):
    judged = rules.classify(defective(spark, sf_dir), DAY)
    return daily.dimensions(judged).select("n", "event_date", "event_hour", "is_bot", "event_category")


DATED_SQL = "dated AS (SELECT *, CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour, user_id % 10 = 0 AS is_bot FROM events)"


def dated(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumns({"event_date": F.to_date("ts"), "event_hour": F.hour("ts"), "is_bot": F.col("user_id") % 10 == 0})


@query("q11_event_counts", f"WITH {DATED_SQL} SELECT event_date, event_type, event_hour, is_bot, count(*) AS event_count FROM dated GROUP BY ALL")
def q11(spark, sf_dir):
    return metrics.count_by(dated(spark, sf_dir), "event_type", "event_hour", "is_bot")


@query("q12_daily_volume", f"WITH {DATED_SQL} SELECT event_date, count(*) AS event_count FROM dated GROUP BY ALL")
def q12(spark, sf_dir):
    return metrics.count_by(dated(spark, sf_dir))


@query("q13_rejection_counts", f"WITH {JUDGED_SQL} SELECT DATE '{DAY}' AS event_date, rejection_reason, count(*) AS event_count FROM judged WHERE rejection_reason IS NOT NULL GROUP BY ALL")
def q13(spark, sf_dir):
    _, rejected = rules.split(rules.classify(defective(spark, sf_dir), DAY))
    return metrics.reason_counts(rejected.withColumn("event_date", F.lit(DAY).cast("date")), DAY)


@query(
    "q14_null_profile",
    f"WITH {JUDGED_SQL} SELECT count(*) FILTER (event_type IS NULL) AS event_type_nulls, count(*) FILTER (actor_login IS NULL) AS actor_login_nulls, count(*) FILTER (moment IS NULL) AS event_timestamp_nulls, "
    "coalesce(CAST(sum(n) AS BIGINT), 0) AS ids, coalesce(CAST(sum(n) FILTER (n < 0) AS BIGINT), 0) AS none FROM judged",
)
def q14(spark, sf_dir):
    judged = rules.classify(defective(spark, sf_dir), DAY).withColumn("negative", F.when(F.col("n") < 0, F.col("n")))
    return judged.agg(*metrics.null_counts(judged, "event_type", "actor_login", "event_timestamp"), metrics.total("n", "ids"), metrics.total("negative", "none"))


@query("q15_distinct_keys", f"WITH {DATED_SQL} SELECT count(DISTINCT event_id) AS ids, count(DISTINCT user_id) AS users, count(DISTINCT event_date) AS days FROM dated")
def q15(spark, sf_dir):
    return dated(spark, sf_dir).agg(F.count_distinct("event_id").alias("ids"), F.count_distinct("user_id").alias("users"), F.count_distinct("event_date").alias("days"))


TOP_SQL = f"""WITH {DATED_SQL}, counted AS (SELECT event_date, user_id, count(*) AS event_count FROM dated GROUP BY ALL)
SELECT event_date, user_id, event_count, CAST(row_number() OVER (PARTITION BY event_date ORDER BY event_count DESC, user_id) AS INTEGER) AS rank FROM counted QUALIFY rank <= 10"""


@query("q16_top_n_per_day", TOP_SQL)
def q16(spark, sf_dir):
    return metrics.top_n(dated(spark, sf_dir), "user_id", 10)


@query("q16_top_n_overall", "SELECT user_id, count(*) AS event_count FROM events GROUP BY user_id ORDER BY event_count DESC, user_id LIMIT 10")
def q16_overall(spark, sf_dir):
    counted = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("event_count"))
    return counted.orderBy(F.desc("event_count"), "user_id").limit(10)


BAG = "l_returnflag, l_linestatus, l_linenumber, l_quantity"


@query(
    "q17_multiset_diff",
    f"WITH a AS (SELECT {BAG} FROM lineitem WHERE l_linenumber <= 4), b AS (SELECT {BAG} FROM lineitem WHERE l_linenumber >= 3 OR l_quantity < 9) "
    f"SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)",
)
def q17(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*BAG.split(", "))
    return compare.differences(lines.filter("l_linenumber <= 4"), lines.filter("l_linenumber >= 3 OR l_quantity < 9"))


@query(
    "q18_contract_violations",
    "SELECT 'grain' AS violation, count(*) AS n FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1) "
    "UNION ALL SELECT 'range', count(*) FROM lineitem WHERE l_quantity NOT BETWEEN 2 AND 45 OR l_discount <= 0",
)
def q18(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    grain = metrics.repeated_grain(lines, *LINE_KEY).agg(F.lit("grain").alias("violation"), F.count(F.lit(1)).alias("n"))
    broken = ~F.col("l_quantity").between(2, 45) | (F.col("l_discount") <= 0)
    return grain.unionByName(lines.agg(F.lit("range").alias("violation"), F.count_if(broken).alias("n")))


@query(
    "q19_row_fingerprint",
    f"WITH {DATED_SQL}, rows AS (SELECT event_date, sha256(CAST(event_id AS VARCHAR) || '|' || CAST(user_id AS VARCHAR) || '|' || event_type || '|' || props) AS digest FROM dated) "
    "SELECT event_date, count(*) AS n, CAST(sum(CAST('0x' || substr(digest, 1, 15) AS BIGINT)) AS VARCHAR) AS fingerprint FROM rows GROUP BY event_date",
)
def q19(spark, sf_dir):
    digest = F.sha2(F.concat_ws("|", F.col("event_id").cast("string"), F.col("user_id").cast("string"), "event_type", "props"), 256)
    part = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)")
    return dated(spark, sf_dir).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), F.sum(part).cast("string").alias("fingerprint"))


STORED = ("event_id", "user_id", "event_type", "event_date")


@query("q20_publish_roundtrip", f"WITH {DATED_SQL} SELECT event_id, user_id, event_type, event_date FROM dated WHERE event_date = DATE '{DAY}'")
def q20(spark, sf_dir):
    root = local_path(scratch(spark, "store"))
    published.write_day(dated(spark, sf_dir).select(*STORED).filter(F.col("event_date") == F.lit(DAY).cast("date")), root, DAY)
    return published.read_day(spark, root, DAY)


WEEKS_SQL = "weeks AS (SELECT event_id, user_id, event_type, CAST(date_trunc('week', ts) AS DATE) AS event_date FROM events)"


def weeks(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.to_date(F.date_trunc("week", "ts")).alias("event_date"))


@query("q21_publish_all_dates", f"WITH {WEEKS_SQL} SELECT * FROM weeks")
def q21(spark, sf_dir):
    root = local_path(scratch(spark, "store"))
    published.write_days(weeks(spark, sf_dir), root)
    return published.read_days(spark, root)


@query("q22_rerun_replaces", f"WITH {WEEKS_SQL} SELECT * FROM weeks WHERE event_date <> DATE '2024-01-08'")
def q22(spark, sf_dir):
    root, frame = local_path(scratch(spark, "store")), weeks(spark, sf_dir)
    published.write_days(frame, root)
    published.write_day(frame.limit(0), root, date(2024, 1, 8))
    return published.read_days(spark, root)


@query("q23_csv_roundtrip", TOP_SQL)
def q23(spark, sf_dir):
    folder = scratch(spark, "csv")
    form = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": ""}
    ranking = metrics.top_n(dated(spark, sf_dir), "user_id", 10)
    ranking.orderBy("event_date", "rank").coalesce(1).write.options(**form).csv(folder)
    return spark.read.schema(ranking.schema).options(**form, multiLine="true").csv(folder)


#: CRC-32 of a number's digits, bit by bit.
CRC32_SQL = (
    "CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(range AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)), lambda c, b: "
    "list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda j: 0::UBIGINT)), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)), 4294967295::UBIGINT) AS BIGINT)"
)


@query(
    "q24_synthetic",
    "SELECT range AS n, CASE WHEN range % 100 < 3 THEN 'duplicate-' || CAST(range // 3 AS VARCHAR) ELSE 'unique-' || CAST(range AS VARCHAR) END AS event_id, "
    "repeat(sha256(CAST(range AS VARCHAR)), 2) AS wide, CAST(128 AS INTEGER) AS width, CAST(NULL AS BIGINT) AS pr_number, 'file:///' || CAST(range % 2 AS VARCHAR) AS source_file, "
    f"{CRC32_SQL} AS checksum FROM range(30000)",
)
def q24(spark, sf_dir):
    return wide_rows(spark, 30_000, 2).select("n", "event_id", "wide", F.length("wide").alias("width"), "pr_number", "source_file", "checksum")


def wide_rows(spark: SparkSession, rows: int, width: int) -> DataFrame:
    """Synthetic wide events: three in a hundred share an id with others."""
    n = F.col("id")
    shared = F.concat(F.lit("duplicate-"), F.floor(n / 3).cast("string"))
    return spark.range(rows).select(
        n.alias("n"),
        F.when(n % 100 < 3, shared).otherwise(F.concat(F.lit("unique-"), n.cast("string"))).alias("event_id"),
        F.repeat(F.sha2(n.cast("string"), 256), F.lit(width)).alias("wide"),
        F.lit(None).cast("bigint").alias("pr_number"),
        F.concat(F.lit("file:///"), (n % 2).cast("string")).alias("source_file"),
        F.crc32(n.cast("string")).alias("checksum"),
    )


@query(
    "q25_bounded_size",
    "SELECT count(*) AS rows, coalesce(CAST(sum(strlen('{\"event_id\":' || CAST(event_id AS VARCHAR) || ',\"event_type\":\"' || event_type || '\",\"user_id\":' || CAST(user_id AS VARCHAR) || '}')) AS BIGINT), 0) AS bytes FROM events",
)
def q25(spark, sf_dir):
    return metrics.bounded_bytes(table(spark, sf_dir, "events").select("event_id", "event_type", "user_id"), 100_000_000)


@query(
    "q26_daily_outcomes",
    f"""WITH {JUDGED_SQL}, twice AS (SELECT *, 0 AS copy FROM judged UNION ALL SELECT *, 1 FROM judged WHERE n % 5 = 0), keyed AS (
  SELECT *, CASE WHEN copy = 1 AND n % 10 = 0 THEN 'other' ELSE actor_login END AS actor FROM twice
), valid AS (SELECT *, count(DISTINCT actor) OVER (PARTITION BY event_id) AS kinds FROM keyed WHERE rejection_reason IS NULL), outcomes AS (
  SELECT n, copy, CASE WHEN kinds > 1 THEN '{copies.CONFLICT}' WHEN copy = 1 THEN '{copies.DUPLICATE}' END AS outcome FROM valid
  UNION ALL SELECT n, copy, CASE WHEN copy = 1 AND n % 10 = 0 AND rejection_reason = 'missing_actor_login' THEN second ELSE rejection_reason END FROM (
    SELECT *, CASE WHEN moment IS NULL THEN 'invalid_timestamp' WHEN event_type NOT IN ('PushEvent', 'PullRequestEvent', 'IssuesEvent', 'WatchEvent') THEN 'unsupported_event_type' WHEN CAST(moment AS DATE) <> DATE '{DAY}' THEN 'outside_date' END AS second
    FROM keyed WHERE rejection_reason IS NOT NULL)
) SELECT copy, outcome, count(*) AS event_count FROM outcomes GROUP BY ALL""",
)
def q26(spark, sf_dir):
    base = defective(spark, sf_dir).withColumns(
        {c: F.lit(None).cast("string") for c in ("org_login", "payload_action")}
        | {"pr_number": F.lit(None).cast("bigint"), "issue_number": F.lit(None).cast("bigint"), "issue_labels": F.array(F.lit("a")), "event_date": F.lit(DAY).cast("date")}
    )
    again = base.filter("n % 5 = 0").withColumn("actor_login", F.when(F.col("n") % 10 == 0, "other").otherwise(F.col("actor_login")))
    both = base.withColumns({"copy": F.lit(0), "source_file": F.lit("a")}).unionByName(again.withColumns({"copy": F.lit(1), "source_file": F.lit("b")}))
    return daily.tag(both, DAY).groupBy("copy", F.col("rejection_reason").alias("outcome")).agg(F.count(F.lit(1)).alias("event_count"))


@query(
    "q27_row_json",
    "SELECT '{\"event_id\":' || CAST(event_id AS VARCHAR) || ',\"event_type\":\"' || event_type || '\",\"user_id\":' || CAST(user_id AS VARCHAR) || ',\"none\":null}' AS value FROM events",
)
def q27(spark, sf_dir):
    return metrics.row_json(table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", F.lit(None).cast("string").alias("none")))


@query(
    "q28_moments",
    "SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS next_second, CAST(date_trunc('second', ts) - INTERVAL 1 DAY AS DATE) AS day_before FROM events",
)
def q28(spark, sf_dir):
    at = F.to_timestamp(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "yyyy-MM-dd'T'HH:mm:ss")
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.date_format(at + F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd HH:mm:ss").alias("next_second"), F.to_date(at - F.expr("INTERVAL 1 DAY")).alias("day_before"))


#: Each table of an export in one shape: what is counted, its place in a ranking, and the count.
EXPORTED = {
    "event_counts": "event_type || ' ' || event_hour || ' ' || is_bot",
    "daily_volume": "CAST(event_date AS VARCHAR)",
    "top_repositories": "repo_name",
    "top_actors": "actor_login",
    "rejection_counts": "rejection_reason",
}


@query(
    "q29_day_to_export",
    f"""WITH {RAW_SQL}, judged AS (
  SELECT *, CASE WHEN event_id % 50 = 0 THEN 'corrupt_json' WHEN type = 'ForkEvent' THEN 'unsupported_event_type' WHEN CAST(ts AS DATE) <> DATE '{DAY}' THEN 'outside_date' END AS reason FROM raw
), clean AS (SELECT * FROM judged WHERE reason IS NULL
), repositories AS (SELECT repo_name AS name, row_number() OVER (ORDER BY count(*) DESC, repo_name) AS place, count(*) AS n FROM clean GROUP BY repo_name
), actors AS (SELECT actor_login AS name, row_number() OVER (ORDER BY count(*) DESC, actor_login) AS place, count(*) AS n FROM clean GROUP BY actor_login
)
SELECT 'event_counts' AS dataset, type || ' ' || hour(ts) || ' false' AS name, CAST(NULL AS INTEGER) AS rank, count(*) AS event_count FROM clean GROUP BY ALL
UNION ALL SELECT 'daily_volume', '{DAY}', NULL, count(*) FROM clean HAVING count(*) > 0
UNION ALL SELECT 'top_repositories', name, CAST(place AS INTEGER), n FROM repositories WHERE place <= 10
UNION ALL SELECT 'top_actors', name, CAST(place AS INTEGER), n FROM actors WHERE place <= 10
UNION ALL SELECT 'rejection_counts', reason, NULL, count(*) FROM judged WHERE reason IS NOT NULL GROUP BY reason""",
)
def q29(spark, sf_dir):
    """A whole day: hourly archives, all stages, the export and its check; the rows are those of the database."""
    raw, out = local_path(raw_lines(spark, sf_dir, 50)), local_path(scratch(spark, "day"))
    for hour, name in enumerate(sorted(n for n in os.listdir(raw) if n.endswith(".gz"))):
        os.rename(f"{raw}/{name}", f"{raw}/{DAY}-{hour}.json.gz")
    # Stages set the shuffle of their session: that of the caller stays.
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    Jobs(own, raw, out).run("pipeline", DAY)
    export_day(out, DAY, f"{out}/csv", f"{out}/metrics.duckdb")
    verify_export(out, f"{out}/csv", f"{out}/metrics.duckdb", DAY)
    rows = []
    with duckdb.connect(f"{out}/metrics.duckdb", read_only=True) as connection:
        for name, shown in EXPORTED.items():
            place = "rank" if name.startswith("top_") else "NULL"
            rows += connection.execute(f"SELECT '{name}', {shown}, {place}, event_count FROM {name}").fetchall()
    return spark.createDataFrame(rows, "dataset string, name string, rank int, event_count bigint")


@query("q30_footer_rows", f"WITH {WEEKS_SQL} SELECT CAST(event_date AS VARCHAR) AS day, count(*) AS rows, true AS sized FROM weeks GROUP BY event_date")
def q30(spark, sf_dir):
    """Rows of each published day from the footers of its files, without reading a row."""
    root = local_path(scratch(spark, "store"))
    published.write_days(weeks(spark, sf_dir), root)
    found = []
    for day, state in published.store(spark, root).resolve_all().items():
        sizes = footers.volume(state.files)
        found.append((day, footers.rows_in(state.files), 0 < sizes["least_bytes"] <= sizes["most_bytes"] <= sizes["file_bytes"] and sizes["uncompressed_bytes"] > 0))
    return spark.createDataFrame(found, "day string, rows bigint, sized boolean")
