"""Line dedup by a log-template tree (operator 2).

Every line with a token is parsed at fixed depth: tokens with digits or an at sign become a
wildcard, then the token count and the first LEAD tokens lead to a leaf. Inside a leaf, lines are
generalised: two lines belong to one template if EQUAL_TOKENS of their tokens are equal, position
by position (so lines of three tokens or fewer are templates of their own). The tokens after the
lead form up to RUNS runs; a line is compared with the earliest line of each of its buckets, one
for each run (lines that have this run) and one for each run left out (lines that have all other
runs). Lines that differ in one field thus always meet. Links between lines are followed to their
end: what they connect is one template, and the positions that differ are its variable fields.

A template found in MIN_DOCS documents or more is recurring: its lines are dropped from every
document except the one with the smallest doc_id that has it, so that one copy of a repeated
passage stays. Counts cover all documents.

One pass over the texts writes ids and hashes of lines and leaves to the shared folder; exact lines are
64-bit hashes of masked lines. The tokens of the different lines of crowded leaves, which are few, come
from a second pass, which meets the leaves where the texts are and moves each line once a task. The runs decide most comparisons, as equal runs are equal tokens
and a differing run has one differing token at least. Counts are aggregated before they are shuffled, and the lines' joins have one row for
each template on their other side, so a template that a third of all lines share is split like
any skewed join.

Defined results: one row for each input row, with its lines in order; null texts stay null and
have no lines; lines without a token are always kept; a null doc_id counts as no document and
keeps no first copy; repeated rows are one document; an empty table gives an empty result; other
columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table, words_of
from .simhash import components

MIN_DOCS = 5
LEAD = 2
RUNS = 8
#: The share of equal tokens, position by position, that makes two lines one template.
EQUAL_TOKENS = 0.75
#: Fewer tokens cannot differ in one and agree in that share.
LEAST_GENERAL = 4
#: Leaves and templates (one or two longs each) are broadcast up to this number, 8 MB.
BROADCAST_HASHES = 500_000

WILDCARD = "<*>"
VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"


def mask(token: Column) -> Column:
    return F.when(token.rlike("[0-9@]"), WILDCARD).otherwise(token)


def masked(line: Column) -> Column:
    return F.when(line.rlike("[0-9@]"), F.regexp_replace(line, VARIABLE, WILDCARD)).otherwise(line)


def tokens_of(line: Column) -> Column:
    """Words of a line; a plain split at spaces, where there is no other white space, is faster."""
    return F.when(line.rlike(r"[\x09-\x0D]"), words_of(line)).otherwise(F.array_remove(F.split(line, " "), ""))


def edge(rest: Column, k: int) -> Column:
    """Where run k begins in the `rest` tokens after the lead: runs are nearly equal, and none is empty."""
    parts = F.least(rest, F.lit(RUNS))
    return F.floor(rest * F.least(F.lit(k), parts) / parts).cast("int")


def parse(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row (a hash of the text), pos, n, line and leaf of every line.

    Nothing is filtered here: a filter on the tokens would split every line once more.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row"), F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "raw"))
    split = rows.select("doc_id", "row", "pos", tokens_of(masked(F.col("raw"))).alias("w"))
    leaf = F.when(F.size("w") >= LEAST_GENERAL, F.xxhash64(F.size("w"), F.slice("w", 1, LEAD)))
    return split.select("doc_id", "row", "pos", F.size("w").alias("n"), F.xxhash64("w").alias("line"), leaf.alias("leaf"))


def hashes(frame: DataFrame, label: str) -> DataFrame:
    """A written table of hashes, to be broadcast if it has BROADCAST_HASHES rows or fewer.

    Beyond, it is joined by a shuffle of both sides, whose hot partitions are split at run time.
    """
    written = materialize(frame, label)
    return F.broadcast(written) if written.count() <= BROADCAST_HASHES else written


def leaf_of(words: Column) -> Column:
    """The leaf of a line from its unmasked words; zero for lines that are not generalised.

    It is never null, as a filter on nulls would split every line once more.
    """
    lead = F.transform(F.slice(words, 1, LEAD), mask)
    return F.when(F.size(words) >= LEAST_GENERAL, F.xxhash64(F.size(words), lead)).otherwise(F.lit(0).cast("long"))


def tokens_of_leaves(docs: DataFrame, id_col: str, text_col: str, known: DataFrame) -> DataFrame:
    """line and tokens (hashes) of the different lines in the leaves `known`: the texts are read again, and not moved."""
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.explode(F.split(F.col(text_col), "\n")).alias("raw"))
    split = rows.select(tokens_of(F.col("raw")).alias("words")).select("words", leaf_of(F.col("words")).alias("leaf"))
    inside = split.join(known, "leaf", "left_semi").select(F.transform("words", mask).alias("w"))
    lines = inside.select(F.xxhash64("w").alias("line"), F.transform("w", lambda x: F.hash(x)).alias("tokens"))
    return lines.groupBy("line").agg(F.first("tokens").alias("tokens"))


def generalise(docs: DataFrame, id_col: str, text_col: str, lines: DataFrame, min_docs: int) -> DataFrame:
    """line, template: the lines that share a template with an earlier line."""
    leaves = lines.filter("leaf IS NOT NULL").groupBy("leaf").agg(F.count(F.lit(1)).alias("c"), F.min("line").alias("a"), F.max("line").alias("b"))
    known = hashes(leaves.filter((F.col("c") >= min_docs) & (F.col("a") != F.col("b"))).select("leaf"), "lines-leaves")
    distinct = lines.filter(F.col("doc_id").isNotNull()).join(known, "leaf", "left_semi").groupBy("line").agg(F.min(F.struct("doc_id", "pos")).alias("at"))
    tokens = materialize(tokens_of_leaves(docs, id_col, text_col, known).join(distinct, "line"), "lines-tokens")
    n = F.size("tokens")
    leaf = F.xxhash64(n, F.slice("tokens", 1, LEAD))
    runs = F.array(*(F.when(n - LEAD > k, F.xxhash64(F.slice("tokens", edge(n - LEAD, k) + LEAD + 1, edge(n - LEAD, k + 1) - edge(n - LEAD, k)))) for k in range(RUNS)))
    distinct = tokens.select("line", "at", n.alias("n"), leaf.alias("leaf"), runs.alias("runs"))
    run = [F.get("runs", F.lit(k)) for k in range(RUNS)]
    rest = F.col("n") - LEAD
    own = [F.when(rest > k, F.xxhash64("leaf", F.lit(k), run[k])) for k in range(RUNS)]
    without = [F.when(rest > k, F.xxhash64("leaf", F.lit(-1 - k), *(run[j] for j in range(RUNS) if j != k))) for k in range(RUNS)]
    buckets = distinct.select("line", "at", "n", "runs", F.explode(F.array(*own, *without)).alias("bucket")).filter("bucket IS NOT NULL")
    first = buckets.groupBy("bucket").agg(F.min_by(F.struct("line", "runs"), F.struct("at", "line")).alias("first"), F.count(F.lit(1)).alias("c"))
    met = buckets.join(first.filter("c > 1").select("bucket", "first"), "bucket").filter(F.col("line") != F.col("first.line"))
    equal = [F.coalesce(F.get("runs", F.lit(k)) == F.get("first.runs", F.lit(k)), F.lit(False)) for k in range(RUNS)]
    zero = F.lit(0)
    least = sum((F.when(equal[k], edge(rest, k + 1) - edge(rest, k)).otherwise(zero) for k in range(RUNS)), F.lit(LEAD))
    differing = sum((F.when(~equal[k] & (rest > k), 1).otherwise(zero) for k in range(RUNS)), zero)
    need = EQUAL_TOKENS * F.col("n")
    met = met.filter(F.col("n") - differing >= need).select("line", F.col("first.line").alias("other"), (least >= need).alias("sure"))
    met = materialize(met.distinct(), "lines-pairs")
    own_tokens, others = tokens.select("line", "tokens"), tokens.select(F.col("line").alias("other"), F.col("tokens").alias("others"))
    both = met.filter("NOT sure").join(own_tokens, "line").join(others, "other")
    same = F.size(F.filter(F.zip_with("tokens", "others", lambda a, b: a == b), lambda x: x))
    near = met.filter("sure").select("line", "other").unionByName(both.filter(same >= EQUAL_TOKENS * F.size("tokens")).select("line", "other"))
    stars = components(near.select(F.col("line").alias("u"), F.col("other").alias("v")))
    return hashes(stars.select(F.col("node").alias("line"), F.col("root").alias("template")), "lines-generalised")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, row, drops: the places of the lines to drop, for documents that have some."""
    lines = materialize(parse(docs, id_col, text_col), "lines-parsed").filter("n > 0")
    templates = generalise(docs, id_col, text_col, lines, min_docs)
    slim = lines.select("doc_id", "row", "pos", "line").join(templates, "line", "left").withColumn("template", F.coalesce("template", "line")).drop("line")
    recurring = slim.groupBy("template").agg(F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("keeper")).filter(F.col("docs") >= min_docs)
    found = slim.join(hashes(recurring.select("template", "keeper"), "lines-recurring"), "template").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return found.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("drops"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """The columns of `docs` as c_0, c_1 and so on, with kept_text, n_lines and n_dropped."""
    drops = dropped_lines(docs, id_col, text_col, min_docs).select(F.col("doc_id").alias("d_id"), F.col("row").alias("d_row"), "drops")
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(docs.columns)))
    doc_id, text = (F.col(f"c_{docs.columns.index(c)}") for c in (id_col, text_col))
    joined = rows.join(drops, doc_id.eqNullSafe(F.col("d_id")) & (F.xxhash64(text) == F.col("d_row")), "left")
    lines = F.split(text, "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drops")), lambda p: F.get(F.col("lines"), p))
    return joined.withColumn("lines", F.when(F.col("drops").isNotNull(), lines)).select(
        *rows.columns,
        F.when(F.col("drops").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
        F.when(text.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(F.col("c_0").alias("doc_id"), "n_lines", "n_dropped", F.col("kept_text").alias("text"))


#: The same rows from whole tokens: runs are lists, links are followed by recursion, nothing is hashed.
OP2_SQL = f"""
WITH RECURSIVE raw AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS raw FROM documents WHERE text IS NOT NULL
), parsed AS (
  SELECT doc_id, pos, list_transform(list_filter(regexp_split_to_array(raw, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''),
    lambda x: CASE WHEN regexp_matches(x, '[0-9@]') THEN '{WILDCARD}' ELSE x END) AS w FROM raw
), lines AS (SELECT doc_id, pos, w, len(w) AS n, w[1:{LEAD}] AS head FROM parsed WHERE len(w) > 0
), leaves AS (
  SELECT n, head FROM lines WHERE n >= {LEAST_GENERAL} GROUP BY n, head HAVING count(*) >= {MIN_DOCS} AND min(w) <> max(w)
), firsts AS (
  SELECT w, n, head, min(struct_pack(d := doc_id, p := pos)) AS spot, row_number() OVER (ORDER BY w) AS id FROM lines SEMI JOIN leaves USING (n, head) GROUP BY w, n, head
), cut AS (
  SELECT *, list_transform(range(least(n - {LEAD}, {RUNS})), lambda k: w[{LEAD} + 1 + (n - {LEAD}) * k // least(n - {LEAD}, {RUNS}) : {LEAD} + (n - {LEAD}) * (k + 1) // least(n - {LEAD}, {RUNS})]) AS runs FROM firsts
), buckets AS (
  SELECT id, w, n, head, spot, 'own' AS kind, k, [runs[k + 1]] AS part FROM cut, range({RUNS}) AS r(k) WHERE k < len(runs)
  UNION ALL SELECT id, w, n, head, spot, 'without', k, list_concat(runs[1:k], runs[k + 2:]) FROM cut, range({RUNS}) AS r(k) WHERE k < len(runs)
), earliest AS (
  SELECT n, head, kind, k, part, arg_min(w, spot) AS founder, arg_min(id, spot) AS founder_id FROM buckets GROUP BY n, head, kind, k, part HAVING count(*) > 1
), near AS (
  SELECT DISTINCT b.id AS u, e.founder_id AS v FROM buckets b JOIN earliest e USING (n, head, kind, k, part)
  WHERE b.id <> e.founder_id AND list_sum(list_transform(list_zip(b.w, e.founder), lambda p: CASE WHEN p[1] = p[2] THEN 1 ELSE 0 END)) >= {EQUAL_TOKENS} * b.n
), links AS (SELECT u, v FROM near UNION SELECT v, u FROM near
), reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), templates AS (SELECT f.w, least(r.u, min(r.v)) AS template FROM reach r JOIN firsts f ON f.id = r.u GROUP BY f.w, r.u
), keyed AS (
  SELECT doc_id, pos, CASE WHEN t.template IS NULL THEN l.w ELSE [CAST(t.template AS VARCHAR)] END AS template, t.template IS NULL AS alone FROM lines l LEFT JOIN templates t ON l.w = t.w
), recurring AS (
  SELECT template, alone, min(doc_id) AS keeper FROM keyed GROUP BY template, alone HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), dropped AS (
  SELECT DISTINCT doc_id, pos FROM keyed JOIN recurring USING (template, alone) WHERE doc_id <> keeper
), kept AS (
  SELECT r.doc_id, count(*) AS n_lines, count(d.pos) AS n_dropped, coalesce(string_agg(r.raw, chr(10) ORDER BY r.pos) FILTER (WHERE d.pos IS NULL), '') AS text
  FROM raw r LEFT JOIN dropped d ON r.doc_id = d.doc_id AND r.pos = d.pos GROUP BY r.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped, k.text AS text FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
