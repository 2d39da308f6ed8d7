"""Secret scans (operator 6).

An Aho-Corasick automaton of key words runs over the whole text; anchored expressions are
tried only where a key word begins, so a text without key words costs one pass. Formats
that carry a checksum or an inner structure (token CRC, signed header, base64 key) are
validated, and spans that fail are dropped. Runs of hexadecimal digits have no key word;
one linear expression finds them.

The scan works on bytes shown as characters (one byte, one character), where ASCII lower
case keeps every position; spans are given in code points of the text.

Defined results: a null or empty text has no spans; repeated rows give repeated result rows;
an empty table gives an empty result; columns other than the id and the text are ignored.
Long texts are scanned whole, in time linear in their length: what an expression has
consumed is not tried again for the same kind, whether it was a secret or not.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

#: Kinds in their order; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "private_key")

ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(body: str) -> str:
    """CRC-32 of `body` as six base-62 digits, the checksum that ends tokens of two hosts."""
    value, digits = zlib.crc32(body.encode("latin-1")), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def token_checksum(match: re.Match) -> bool:
    body = match.group(1)
    return crc_base62(body[:-6]) == body[-6:]


def signed_header(match: re.Match) -> bool:
    """Whether the first part is a JSON object that names an algorithm."""
    if match.group(2) is None:
        return False
    part = match.group(1)
    try:
        found = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(found, dict) and "alg" in found


def key_length(match: re.Match) -> bool:
    """Whether the body is base64 of a DER sequence with the length that it states, or of an OpenSSH key."""
    try:
        body = base64.b64decode(re.sub(r"[^A-Za-z0-9+/=]", "", match.group(1)), validate=True)
    except (ValueError, binascii.Error):
        return False
    if body.startswith(b"openssh-key-v1\0"):
        return True
    if len(body) < 4 or body[0] != 0x30:
        return False
    size = body[1] & 0x7F
    if body[1] < 0x80:
        return len(body) == 2 + body[1]
    return len(body) == 2 + size + int.from_bytes(body[2 : 2 + size], "big")


#: Key word (lower case) -> kind, anchored expression, validation.
FORMATS: dict[str, tuple[str, re.Pattern, Callable[[re.Match], bool]]] = {
    **{word: ("assign", ASSIGN, lambda m: len(m.group(1)) >= 6) for word in ("password", "passwd", "secret", "token", "apikey", "api_key")},
    "akia": ("access", ACCESS, lambda m: m.end() - m.start() >= 20),
    **{f"gh{c}_": ("github", re.compile(rf"gh{c}_([A-Za-z0-9]{{36}})(?![A-Za-z0-9])"), token_checksum) for c in "pousr"},
    "npm_": ("npm", re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), token_checksum),
    # The tail is optional: a run of characters without it is consumed, and refused.
    "eyj": ("jwt", re.compile(r"(eyJ[A-Za-z0-9_-]*+)(\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)?"), signed_header),
    "-----begin ": ("private_key", re.compile(r"-----BEGIN (?:[A-Z]++ )?PRIVATE KEY-----([A-Za-z0-9+/=\s]++)-----END (?:[A-Z]++ )?PRIVATE KEY-----"), key_length),
}


@lru_cache(maxsize=1)
def key_words():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for word in FORMATS:
        automaton.add_word(word, word)
    automaton.make_automaton()
    return automaton


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a text's secrets, in code points, by start and then kind."""
    if not text:
        return []
    shown = text if text.isascii() else text.encode("utf-8", "surrogatepass").decode("latin-1")
    lowered = shown.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("latin-1")
    hits = [(at + 1 - len(word), word) for at, word in key_words().iter(lowered)]
    found = [("hex", m.start(), m.end()) for m in HEX.finditer(shown)]
    done: dict[str, int] = {}
    for start, word in sorted(hits):
        kind, expression, valid = FORMATS[word]
        if start < done.get(kind, 0):
            continue
        if match := expression.match(shown, start):
            done[kind] = match.end()
            if valid(match):
                found.append((kind, start, match.end()))
    if found and shown is not text:
        found = in_code_points(text, found)
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def in_code_points(text: str, found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Byte positions as code points, in one pass over the text."""
    body, points, byte, point = text.encode("utf-8", "surrogatepass"), {}, 0, 0
    for at in sorted({p for _, *span in found for p in span}):
        point += sum(map((0x80).__gt__, body[byte:at])) + sum(map((0xBF).__lt__, body[byte:at]))
        byte = at
        points[at] = point
    return [(kind, points[start], points[end]) for kind, start, end in found]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its spans (array of kind, start, end), one row for each row of `docs`."""

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in (part for whole in batches for part in slices(whole, 1)):
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in scan(t.as_py())] for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    as_text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s.kind.isin(*KINDS[:3]))
    return found.select("doc_id", *(of(k) for k in KINDS[:3]), F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))


def op6_sql() -> str:
    """The same rows by whole-text expressions: places from the pieces between matches, checksums in plain arithmetic."""
    words = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    white = r"\x09-\x0D\x1C-\x20"
    whole = {
        "assign": rf"""(?:{words})[\"\x27]?\x20*[:=]\x20*[\"\x27]?([A-Za-z0-9+/_.=-]+)""",
        "access": "AKIA[A-Z0-9]+",
        "hex": "[0-9a-f]{24,}",
        "jwt": r"(eyJ[A-Za-z0-9_-]*)(?:\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)?",
        "private_key": rf"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----([A-Za-z0-9+/={white}]+)-----END (?:[A-Z]+ )?PRIVATE KEY-----",
        # Only where a token may begin: what follows is read from the text.
        "github": "gh[pousr]_",
        "npm": "npm_",
    }
    found = " UNION ALL ".join(f"SELECT r, '{k}' AS kind, regexp_extract_all(t, '{e}') AS m, regexp_split_to_array(t, '{e}') AS p FROM texts WHERE regexp_matches(t, '{e}')" for k, e in whole.items())
    shift = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END"
    crc = f"list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(30), lambda i: ascii(body[i + 1])::UBIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda j: 0::UBIGINT)), lambda v, z: {shift}))"
    digits = " || ".join(f"'{BASE62}'[(crc // {62**k} % 62)::BIGINT + 1]" for k in reversed(range(6)))
    header = "regexp_extract(m, '^eyJ[A-Za-z0-9_-]*')"
    decoded = f"try(decode(from_base64(translate({header}, '-_', '+/') || repeat('=', (4 - length({header}) % 4) % 4))))"
    body = f"regexp_replace(regexp_extract(m, '{whole['private_key']}', 1), '[{white}]', '', 'g')"
    size = "('0x' || substr(der, 3, 2))::INTEGER"
    stated = f"ltrim(substr(der, 5, 2 * ({size} - 128)), '0')"
    sequence = f"der[1:2] = '30' AND length(der) >= 8 AND CASE WHEN {size} < 128 THEN length(der) // 2 = 2 + {size} ELSE length({stated}) < 15 AND length(der) // 2 = 2 + {size} - 128 + coalesce(try_cast('0x' || nullif({stated}, '') AS BIGINT), 0) END"
    order = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS))
    base = ", ".join(f"'{k}'" for k in KINDS[:3])
    return f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents
), found AS ({found}
), numbered AS (SELECT r, kind, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS m, unnest(p[1:len(m)]) AS p FROM found
), placed AS (SELECT r, kind, m, CAST(sum(length(p) + length(m)) OVER (PARTITION BY r, kind ORDER BY i) - length(m) AS BIGINT) AS s FROM numbered
), tokens AS (
  SELECT r, kind, s, substr(t, s + 1 + length(m), 36) AS body FROM placed JOIN texts USING (r)
  WHERE kind IN ('github', 'npm') AND regexp_matches(substr(t, s + 1 + length(m), 37), '^[A-Za-z0-9]{{36}}(?:[^A-Za-z0-9]|$)')
), apart AS (
  -- A token may begin in the last three characters of another: of such a chain, every second one is a match.
  SELECT *, row_number() OVER (PARTITION BY r, kind, chain ORDER BY s) AS k FROM (
    SELECT *, sum(new) OVER (PARTITION BY r, kind ORDER BY s) AS chain FROM (
      SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY r, kind ORDER BY s) < length(body) + 4 THEN 0 ELSE 1 END AS new FROM tokens))
), summed AS (SELECT r, kind, s, body, xor({crc}, 4294967295::UBIGINT) AS crc FROM apart WHERE k % 2 = 1
), keys AS (SELECT r, kind, s, m, hex(try(from_base64({body}))) AS der FROM placed WHERE kind = 'private_key'
), spans AS (
  SELECT r, kind, s, s + length(m) AS e FROM placed WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(m, '{whole["assign"]}', 1)) >= 6 WHEN 'access' THEN length(m) >= 20 ELSE kind = 'hex' END
  UNION ALL SELECT r, kind, s, s + 40 FROM summed WHERE {digits} = body[31:36]
  UNION ALL SELECT r, kind, s, s + length(m) FROM placed WHERE kind = 'jwt' AND contains(m, '.') AND coalesce(try(json_type({decoded}) = 'OBJECT' AND json_exists({decoded}, '$.alg')), false)
  UNION ALL SELECT r, kind, s, s + length(m) FROM keys WHERE starts_with(der, hex(encode('openssh-key-v1')) || '00') OR ({sequence})
), joined AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, CASE kind {order} END) FILTER (kind IN ({base})) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, CASE kind {order} END) AS spans FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM texts LEFT JOIN joined USING (r)
"""
