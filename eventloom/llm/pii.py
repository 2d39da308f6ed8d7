"""Personal data by weak supervision (operator 3).

Candidate spans come from the base expressions and from looser ones. Six labelers, each looking
at something else (form, checksum or range, gazetteer, words before, words after, characters
around), vote for, against or not at all on each candidate. Expectation-maximisation over the
counted vote patterns estimates how reliable each labeler is for each kind (labelers that have no vote on a
kind are left out), and its posteriors train the final span classifier (log odds of votes, size and share of digits), which decides on the
candidates that are not base spans. Base spans always stay; those that the classifier would refuse are
counted as doubted.

One pass over the texts writes the few candidates of each text to the shared folder. The
driver then receives the counts of distinct patterns of votes and form, at most
3^6 * 4 * 3 for each of nine kinds whatever the number of texts, and fits the two models in
exact order; everything else is DataFrame expressions. Expressions are possessive and
anchored, and overlaps of spans are found by binary search among sorted places, so the time
grows with the length of a text, and no faster than it by more than a logarithm.

Defined results: a null or empty text has no spans; repeated rows give repeated result rows;
an empty table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, materialize, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "email_text", "phone_local", "ssn", "iban", "name")
LABELERS = ("form", "check", "gazetteer", "before", "after", "around")
ROUNDS = 40
#: Characters of context that the context labelers read.
CONTEXT = 24
CHUNK = 512

LOCAL = "A-Za-z0-9._%+-"

# Fixed word lists: the gazetteers.
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Mme Sr Sra".split()
FIRST_NAMES = (
    "Adam Alan Albert Alice Amanda Amy Andrea Andreas Andrew Angela Anna Anne Antonio Barbara Benjamin Bernd Betty Brian Carlos Carmen Carol Catherine Charles "
    "Christian Christine Christopher Claire Claude Claudia Daniel David Deborah Diego Donald Dorothy Edward Elena Elizabeth Emily Emma Eric Eva Felix Fernando "
    "Francisco Frank Fritz George Gerhard Hannah Hans Heinz Helen Helga Henry Ines Isabelle Ivan Jack Jacques James Jan Jason Javier Jean Jeffrey Jennifer Jessica "
    "Joan Johann John Jonathan Jorge Jose Joseph Joshua Juan Julia Julie Karen Karl Katherine Kenneth Kevin Klaus Laura Lena Linda Lisa Louis Lucas Lucie Luis Manuel "
    "Margaret Maria Marie Mark Martin Mary Matthew Michael Michelle Miguel Monika Nancy Nicolas Olivier Pablo Patricia Patrick Paul Pedro Peter Petra Philippe Pierre "
    "Rachel Rafael Raymond Rebecca Richard Robert Ronald Rosa Ruth Samuel Sandra Sara Sarah Scott Sophie Stefan Stephen Susan Thomas Timothy Ursula Victoria Walter "
    "William Wolfgang"
).split()
LAST_NAMES = (
    "Adams Anderson Bauer Becker Bernard Brown Campbell Clark Davis Diaz Dubois Durand Evans Fernandez Fischer Garcia Gomez Gonzalez Green Hall Harris Hernandez Hill "
    "Hoffmann Jackson Johnson Jones Klein Koch Lefebvre Leroy Lewis Lopez Martin Martinez Meyer Miller Mitchell Moore Moreau Moreno Morgan Muller Perez Petit Ramirez "
    "Richter Rivera Roberts Robinson Rodriguez Ruiz Sanchez Schmidt Schneider Schulz Scott Simon Smith Taylor Thomas Thompson Torres Turner Wagner Walker Weber White "
    "Williams Wilson Wright Young"
).split()
DOMAINS = "com org net edu gov info io de fr es it uk eu ch at nl us ca be pt pl se no dk fi ie au nz jp br mx ar cl in cz gr ru cn biz name app dev".split()
# Length of the account numbers of a country.
ACCOUNT_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24,
}


def one_of(words) -> str:
    return "(?:" + "|".join(words) + ")"


#: A run may begin where the last match ended, or where no run character stands before it: the
#: places where an unanchored search would begin a match.
EXPRESSIONS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_text": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[(](?:dot|DOT)[\])]|\.)\x20?[A-Za-z0-9-]++)++",
    "phone_local": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "name": rf"(?<![\p{{L}}0-9])(?:{one_of(TITLES)}\.?\x20|(?={one_of(FIRST_NAMES)}\x20))\p{{Lu}}\p{{Ll}}++(?:\x20\p{{Lu}}\p{{Ll}}++){{0,2}}+",
}
#: What a text must have before the longer expression is tried.
NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "phone": r"\+[0-9]",
    "email_text": r"[\[(](?:at|AT)[\])]",
    "phone_local": r"[0-9]{3}[.\x20-][0-9]{4}",
    "ssn": r"[0-9]-[0-9]{2}-[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
    "name": rf"(?<![\p{{L}}0-9])(?:{one_of(TITLES)}\.?|{one_of(FIRST_NAMES)})\x20\p{{Lu}}",
}
#: The form labeler: strict forms, for kinds whose expression leaves some room.
FORMS = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$",
    "phone": r"^\+[1-9][0-9]{0,2}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}$",
    "email_text": r"^[A-Za-z0-9._-]+( ?)[\[(](?:at|AT)[\])]\1[A-Za-z0-9-]+(?:\1[\[(](?:dot|DOT)[\])]\1[A-Za-z0-9-]+)+$",
    "phone_local": r"^\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}$|^[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$|^[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?$",
    "name": r"\p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+$",
}
#: The check labeler: ranges that the numbering plans leave out.
RANGES = {
    "phone_local": r"^\(?[2-9](?!11)[0-9]{2}\)?[ .-]?[2-9](?!11)[0-9]{2}",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
}
#: The gazetteer labeler: lists of what there is.
LISTED = {
    "email": rf"\.{one_of(DOMAINS)}$",
    "ip": r"^(?!0\.|127\.|255\.|22[4-9]\.|23[0-9]\.|24[0-9]\.|25[0-5]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35)",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})",
    "email_text": rf"[^A-Za-z]{one_of(DOMAINS)}$",
    "iban": "^" + one_of(f"{c}(?:[^A-Z0-9]*[A-Z0-9]){{{n - 2}}}$" for c, n in ACCOUNT_LENGTHS.items()),
    "name": rf"(?:^|\x20){one_of(FIRST_NAMES)}\x20|\x20{one_of(LAST_NAMES)}$",
}
#: The labelers of context: words before and after a candidate that speak for its kind.
BEFORE = {
    "email": "e-?mail|mail|contact|kontakt|correo|courriel|address|write to",
    "ip": "ip|address|addr|host|server|from",
    "card": "card|visa|mastercard|credit|karte|tarjeta|carte|payment",
    "phone": "phone|call|tel|telephone|fax|mobile|cell|telefon|number",
    "email_text": "e-?mail|mail|contact|kontakt|correo|courriel|reach me at|write to",
    "phone_local": "phone|call|tel|telephone|fax|mobile|cell|telefon",
    "ssn": "ssn|social security|social|tax id|security number",
    "iban": "iban|account|konto|cuenta|compte|transfer to",
    "name": "dear|from|by|name|named|contact|signed|author|to|met|with|and",
}
AFTER = {
    "phone": "ext|extension|x[0-9]",
    "phone_local": "ext|extension|x[0-9]|for (?:help|more|details)",
    "name": "said|says|wrote|writes|born|lives|lived|told|asked|who|was|is|and|has|works",
}
#: Words before and after that speak against every kind: numbers of other things, and amounts.
AGAINST_BEFORE = "version|release|build|section|chapter|page|isbn|issn|order|invoice|ref|serial|part|figure|model|item|sku|ticket|no|v|hotel|street|plaza|ship"
AGAINST_AFTER = "kg|km|cm|mm|eur|usd|euros|dollars|pcs|pieces|items|percent|hotel|street|plaza|avenue|airport|award|prize"


def prefix_sums(values: Column) -> Column:
    """Sum of the values before each value; in chunks, so that long arrays stay cheap."""

    def whole(chunks: Column) -> Column:
        def total(xs: Column) -> Column:
            return F.aggregate(xs, F.lit(0), lambda s, x: s + x)

        return let(
            F.transform(chunks, total),
            lambda sums: F.flatten(
                F.transform(
                    chunks,
                    lambda xs, c: F.aggregate(
                        xs,
                        F.struct(total(F.slice(sums, 1, c)).alias("at"), F.array().cast("array<int>").alias("out")),
                        lambda s, x: F.struct((s.at + x).alias("at"), F.array_append(s.out, s.at).alias("out")),
                    ).out,
                )
            ),
        )

    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / CHUNK).cast("int") - 1, F.lit(0)))
    return let(values, lambda v: let(F.transform(starts, lambda c: F.slice(v, c * CHUNK + 1, CHUNK)), whole))


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether digits (19 or fewer) pass the Luhn check."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    value = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + F.when(i % 2 == 0, doubled(value(i))).otherwise(value(i)))
    return total % 10 == 0


def mod97(match: Column) -> Column:
    """Whether an account number of 34 characters or fewer has the remainder 1."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    points = F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(points, F.lit(0), lambda s, x: F.when(x > 9, s * 100 + x).otherwise(s * 10 + x) % 97) == 1


def base_valid(kind: str, match: Column) -> Column:
    """The base rules on a match; of the other kinds, only account numbers have a checksum."""
    count = F.length(digits_of(match))
    if kind == "ip":
        return match.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$")
    if kind == "card":
        return F.when(count.between(13, 19), luhn(digits_of(match))).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(9, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def vote(name: str, *cases: tuple[Column, int]) -> Column:
    """The vote of the first case that holds; 0 if none does."""
    value = F.lit(f"{name}:0")
    for condition, voted in reversed(cases):
        value = F.when(condition, f"{name}:{voted}").otherwise(value)
    return value


def listed(name: str, patterns: dict[str, str], kind: str, match: Column) -> Column:
    """For or against by a kind's pattern; no vote on kinds without one."""
    return vote(name, (match.rlike(patterns[kind]), 1), (F.lit(True), -1)) if kind in patterns else vote(name)


def candidates(text: Column, kind: str) -> Column:
    """Spans of a kind: kind number, start, end (code points) and features (votes and shape)."""

    def span(found: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            start = F.get(found.at, i) + F.length(F.get(found.p, i))
            before, after = F.lower(F.right(F.get(found.p, i), F.lit(CONTEXT))), F.lower(F.left(F.get(found.p, i + 1), F.lit(CONTEXT)))
            around = F.concat(F.right(F.get(found.p, i), F.lit(1)), F.lit("|"), F.left(F.get(found.p, i + 1), F.lit(1)))
            digits, size = F.length(digits_of(m)), F.length(m)
            ends = lambda words: before.rlike(rf"(?:^|[^\p{{L}}])(?:{words})[^\p{{L}}0-9]*$")
            begins = lambda words: after.rlike(rf"^[^\p{{L}}0-9]*(?:{words})(?:[^\p{{L}}]|$)")
            features = [
                listed("form", FORMS, kind, m),
                listed("check", RANGES, kind, m),
                listed("gazetteer", LISTED, kind, m),
                vote("before", (ends(AGAINST_BEFORE), -1), (ends(BEFORE[kind]), 1)),
                vote("after", (begins(AGAINST_AFTER), -1), *([(begins(AFTER[kind]), 1)] if kind in AFTER else [])),
                vote("around", (around.rlike(r"[\p{L}0-9]\||\|[\p{L}0-9]"), -1), (around.rlike(r"^[\x20\x09-\x0D]?\|[\x20\x09-\x0D.,;:!?)]?$"), 1)),
                F.when(size < 12, "size:a").when(size < 18, "size:b").when(size < 28, "size:c").otherwise("size:d"),
                F.when(digits == 0, "digits:none").when(digits * 2 < size, "digits:some").otherwise("digits:most"),
            ]
            return F.when(base_valid(kind, m), F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), (start + size).alias("end"), F.array(*features).alias("features")))

        return F.filter(F.transform(found.m, one), lambda x: x.isNotNull())

    expression = EXPRESSIONS[kind]
    pieces = F.struct(F.regexp_extract_all(text, F.lit(expression), F.lit(0)).alias("m"), F.split(text, expression).alias("p"))
    placed = let(pieces, lambda x: F.struct(x.m.alias("m"), x.p.alias("p"), prefix_sums(F.transform(x.m, lambda m, i: F.length(m) + F.length(F.get(x.p, i)))).alias("at")))
    needed = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(NEEDS[kind])
    return F.when(needed, let(placed, span))


def furthest(values: Column) -> Column:
    """The largest value up to and with each value; in chunks, so that long arrays stay cheap."""
    most = lambda xs, least: F.aggregate(xs, least, lambda a, b: F.greatest(a, b))

    def whole(chunks: Column) -> Column:
        def within(before: Column, xs: Column) -> Column:
            start = F.struct(before.alias("top"), F.array().cast("array<int>").alias("out"))
            return F.aggregate(xs, start, lambda s, x: F.struct(F.greatest(s.top, x).alias("top"), F.array_append(s.out, F.greatest(s.top, x)).alias("out"))).out

        tops = F.transform(chunks, lambda xs: most(xs, F.lit(-1)))
        return let(tops, lambda t: F.flatten(F.transform(chunks, lambda xs, c: within(most(F.slice(t, 1, c), F.lit(-1)), xs))))

    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / CHUNK).cast("int") - 1, F.lit(0)))
    return let(values, lambda v: let(F.transform(starts, lambda c: F.slice(v, c * CHUNK + 1, CHUNK)), whole))


def number_below(values: Column, bound: Column) -> Column:
    """How many of the sorted values are below the bound, by binary search."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s.low + s.high) / 2).cast("int")
        below = (s.low < s.high) & (F.get(values, middle) < bound)
        return F.struct(F.when(below, middle + 1).otherwise(s.low).alias("low"), F.when((s.low < s.high) & ~below, middle).otherwise(s.high).alias("high"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(values).alias("high")), halve).low


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""

    def of(x: Column) -> Column:
        """A span overlaps another if one that begins before its end reaches beyond its start."""
        free = lambda s: F.coalesce(F.get(x.reach, number_below(x.starts, s.end) - 1) <= s.start, F.lit(True))
        return F.filter(spans, free)

    places = F.sort_array(F.transform(others, lambda o: F.struct(o.start.alias("start"), o.end.alias("end"))))
    sorted_ = let(places, lambda o: F.struct(F.transform(o, lambda p: p.start).alias("starts"), furthest(F.transform(o, lambda p: p.end)).alias("reach")))
    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(let(sorted_, of))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and extra: the spans of the base kinds, and looser candidates apart from them."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    found = rows.select("doc_id", *(candidates(F.col("t"), k).alias(k) for k in KINDS))
    none = "array<struct<kind:int,start:int,end:int,features:array<string>>>"
    held = {k: F.coalesce(F.col(k), F.array().cast(none)) for k in KINDS}
    base = F.concat(*(held[k] for k in BASE_KINDS))
    extra = F.concat(*(held[k] for k in KINDS if k not in BASE_KINDS))
    return found.select("doc_id", base.alias("base"), extra.alias("extra")).select("doc_id", "base", apart(F.col("extra"), F.col("base")).alias("extra"))


def estimate(patterns: dict[tuple[str, ...], int]) -> dict[tuple[str, ...], float]:
    """Chance that each pattern of votes is personal data, by EM for one kind.

    Every labeler has its own chances of voting +1, 0 and -1 on either class; pseudo-counts
    lean towards labelers that are better than chance, which also fixes which class is which.
    Labelers that vote on no pattern are left out.
    """
    names = [n for n in (f"{n}:" for n in LABELERS) if any(f.startswith(n) and f != f"{n}0" for p in patterns for f in p)]
    votes = {p: [next(f for f in p if f.startswith(n)) for n in names] for p in patterns}
    chance = {}
    for p, v in votes.items():
        total = sum(int(f.partition(":")[2]) for f in p if f.partition(":")[0] in LABELERS)
        chance[p] = 0.9 if total > 0 else 0.1 if total < 0 else 0.5
    lean = {"1": (2.0, 0.5), "0": (1.0, 1.0), "-1": (0.5, 2.0)}
    for _ in range(ROUNDS):
        share = (sum(chance[p] * n for p, n in patterns.items()) + 1) / (sum(patterns.values()) + 2)
        rates = []
        for j in range(len(names)):
            sums = {v: list(c) for v, c in lean.items()}
            for p, n in patterns.items():
                v = votes[p][j].partition(":")[2]
                sums[v][0] += chance[p] * n
                sums[v][1] += (1 - chance[p]) * n
            totals = [sum(s[k] for s in sums.values()) for k in (0, 1)]
            rates.append({v: math.log(s[0] / totals[0]) - math.log(s[1] / totals[1]) for v, s in sums.items()})
        for p, v in votes.items():
            odds = math.log(share) - math.log(1 - share) + sum(r[x.partition(":")[2]] for r, x in zip(rates, v, strict=True))
            chance[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return chance


def train(counts: list[tuple[int, tuple[str, ...], int]]) -> dict[str, float]:
    """The span classifier: a bias for each kind and a weight for each of its features."""
    weights: dict[str, float] = {}
    for kind in range(len(KINDS)):
        patterns = {f: n for k, f, n in sorted(counts) if k == kind}
        if not patterns:
            continue
        chance = estimate(patterns)
        yes = sum(chance[p] * n for p, n in patterns.items())
        no = sum((1 - chance[p]) * n for p, n in patterns.items())
        weights[f"{kind}|"] = math.log((yes + 1) / (no + 1))
        for feature in sorted({f for p in patterns for f in p}):
            of = [(p, n) for p, n in patterns.items() if feature in p]
            a, b = sum(chance[p] * n for p, n in of), sum((1 - chance[p]) * n for p, n in of)
            weights[f"{kind}|{feature}"] = math.log((a + 1) / (yes + 2)) - math.log((b + 1) / (no + 2))
    return weights


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (spans), added (spans that the classifier accepts) and doubted (base spans it would refuse)."""
    scanned = materialize(scan(docs, id_col, text_col), "pii-spans")
    every = scanned.select(F.explode(F.concat("base", "extra")).alias("s"))
    counts = every.groupBy("s.kind", "s.features").count().collect()  # bounded by the number of patterns
    weights = train([(r[0], tuple(r[1]), r[2]) for r in counts])
    table_of = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair)) if weights else F.lit(None).cast("map<string,double>")

    def odds(s: Column) -> Column:
        weight = lambda f: F.coalesce(F.try_element_at(table_of, F.concat(s.kind.cast("string"), F.lit("|"), f)), F.lit(0.0))
        return F.aggregate(s.features, weight(F.lit("")), lambda total, f: total + weight(f))

    place = lambda spans: F.transform(spans, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    return scanned.select(
        "doc_id",
        place(F.col("base")).alias("base"),
        place(F.filter("extra", lambda s: odds(s) > 0)).alias("added"),
        F.size(F.filter("base", lambda s: odds(s) <= 0)).alias("doubted"),
    )


def joined(spans: Column) -> Column:
    """kind:start:end of spans by kind and start, comma-joined."""
    name = lambda s: F.get(F.array(*map(F.lit, KINDS)), s.kind)
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", name(s), s.start.cast("string"), s.end.cast("string"))), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    count = lambda i: F.size(F.filter("base", lambda s: s.kind == i)).cast("long")
    return found.select(
        "doc_id",
        *(count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
        F.col("doubted").cast("long").alias("n_doubted"),
    )
