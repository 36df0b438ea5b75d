"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, validators (Luhn, mod 97, address ranges, digit counts)
confirm them, and words near a span move its score. Offsets come from splitting a text by
the same expression: the lengths of gaps and matches add up to starts in code points.
Expressions use possessive quantifiers and look-behinds so that each is linear in the text,
and what they give is bound once for each text, never evaluated anew for each match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in order, patterns, base scores, words that raise a score nearby.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
# a maximal chain of digits with single separators, of 13 to 19 digits
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# characters of an IBAN by country
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS",
    23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}
IBAN = r"(?<![A-Za-z0-9])(?:%s)(?![A-Za-z0-9])" % "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
IP_OK = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban")
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.8}
CONTEXT = {
    "email": "mail|contact|write|courriel|correo",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|credit|karte|carte|tarjeta|pay",
    "phone": "call|phone|tel|mobile|anruf|appel",
    "iban": "iban|bank|account|konto|compte|cuenta",
}
NEAR = 40  # code points to either side that count as near, as far as the next match of the kind
MUST = {  # what a text holds if it has a match
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]",
}
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """True where the digits of value pass the Luhn check."""
    d = F.reverse(_digits(value))

    def step(acc, i):
        x = F.substring(d, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return acc + F.when(x > 9, x - 9).otherwise(x)

    return (F.length(d) > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), F.lit(0), step) % 10 == 0)


def mod97(value: Column) -> Column:
    """True where value, as an IBAN, leaves 1 when divided by 97."""
    s = F.regexp_replace(value, " ", "")
    s = F.concat(F.substr(s, F.lit(5)), F.substring(s, 1, 4))

    def step(acc, i):
        c = F.ascii(F.substring(s, i, F.lit(1)))
        return F.when(c < 65, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), step) == 1


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_OK)
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def _bound(value: Column, use) -> Column:
    """use(value) with value evaluated once, also where use has it in loops over arrays."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _matches(text: Column, kind: str) -> Column:
    """Matches of a kind in order: array of (before, value, after), the gaps between matches and the matches."""
    parts = F.struct(F.split(text, PATTERNS[kind], -1).alias("gaps"), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)).alias("hits"))

    def zipped(p):
        n = F.size(p["hits"])
        return F.arrays_zip(F.slice(p["gaps"], 1, n).alias("before"), p["hits"].alias("value"), F.slice(p["gaps"], 2, n).alias("after"))

    return _bound(parts, zipped)


def _has(text: Column, kind: str) -> Column:
    return F.contains(text, F.lit(MUST[kind])) if kind == "email" else text.rlike(MUST[kind])


def _score(kind: str, match: Column) -> Column:
    near = F.lower(F.concat(F.substring(match["before"], -NEAR, NEAR), F.lit(" "), F.substring(match["after"], 1, NEAR)))
    return F.round(F.lit(SCORES[kind]) + F.when(near.rlike(CONTEXT[kind]), 0.15).otherwise(0.0), 2)


def _sums(steps: Column) -> Column:
    """Running sums of an array, by parts of about the square root of its size, so that no append copies a long array."""
    none = F.array().cast("array<int>")

    def add(acc, x):
        return F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)

    def parts(s):
        width = F.ceil(F.sqrt(F.size(s))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / width).cast("int")), lambda i: F.aggregate(F.slice(s, i * width + 1, width), none, add))

    def joined(ps):
        totals = F.transform(ps, lambda p: F.element_at(p, -1))
        starts = F.concat(F.array(F.lit(0)), F.aggregate(totals, none, add))
        return _bound(starts, lambda b: F.flatten(F.zip_with(ps, F.slice(b, 1, F.size(ps)), lambda p, x: F.transform(p, lambda y: y + x))))

    return _bound(steps, lambda s: F.when(F.size(s) > 0, _bound(parts(s), joined)).otherwise(none))


def _found(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind, by start: array of (kind, start, end, score, value)."""

    def span(z):
        return F.struct(
            F.lit(kind).alias("kind"), (z["end"] - F.length(z["m"]["value"])).alias("start"), z["end"].alias("end"), _score(kind, z["m"]).alias("score"), z["m"]["value"].alias("value")
        )

    def spans(m):
        ends = _sums(F.transform(m, lambda x: F.length(x["before"]) + F.length(x["value"])))
        return F.transform(F.filter(F.arrays_zip(m.alias("m"), ends.alias("end")), lambda z: _confirmed(kind, z["m"]["value"])), span)

    empty = F.array().cast("array<struct<kind:string,start:int,end:int,score:double,value:string>>")
    return F.when(_has(text, kind), _bound(_matches(text, kind), spans)).otherwise(empty)


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """`docs` with array `out_col` of (kind, start, end, score, value), by kind as in KINDS, then start.

    Offsets are code points, end exclusive. Null and empty texts give an empty array; a column
    of docs named like out_col is replaced, all others stay. Spans of different kinds may overlap.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumn(out_col, F.concat(*[_found(text, k) for k in KINDS]))


def masked(text: Column, least: float = 0.0) -> Column:
    """text with every confirmed match of at least that score replaced by its kind in brackets.

    Kinds are masked one after the other, as in KINDS: where matches overlap, the first kind counts.
    """

    def one(kind):
        def put(match):
            sure = _confirmed(kind, match["value"]) & (_score(kind, match) >= least)
            return F.concat(match["before"], F.when(sure, F.lit(f"[{kind.upper()}]")).otherwise(match["value"]))

        def run(t):
            whole = _bound(_matches(t, kind), lambda m: F.concat(F.array_join(F.transform(m, put), ""), F.element_at(m, -1)["after"]))
            return F.when(_has(t, kind) & t.rlike(PATTERNS[kind]), whole).otherwise(t)

        return run

    for kind in KINDS:
        text = _bound(text, one(kind))
    return text


def mask_pii(docs: DataFrame, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """`docs` with confirmed personal data of at least that score masked in the text; texts without any stay as they are, null stays null."""
    return docs.withColumn(text_col, masked(F.col(text_col), least))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    best = F.array_max(F.transform("pii", lambda s: s["score"]))  # null where there is no span
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"), best.alias("top_score"))


def _kind_sql(kind: str) -> str:
    """Confirmed matches of a kind in DuckDB: (doc_id, kind, k, start, end, score). RE2 has no look-behinds; the base patterns need none."""
    base = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+){3}", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": PHONE,
        "iban": IBAN.replace("(?<![A-Za-z0-9])", r"\b").replace("(?![A-Za-z0-9])", r"\b"),
    }[kind]
    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN reverse({digits})[i]::INTEGER ELSE (reverse({digits})[i]::INTEGER * 2) % 10 + (reverse({digits})[i]::INTEGER * 2) // 10 END)) % 10 = 0"
    moved = "string_split(concat(substr(replace(value, ' ', ''), 5), left(value, 4)), '')"
    number = f"list_transform({moved}, lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)"
    sure = {
        "email": "true", "ip": "list_aggregate(list_transform(string_split(value, '.'), lambda p: CASE WHEN length(ltrim(p, '0')) > 3 THEN 999 ELSE p::INTEGER END), 'max') <= 255",
        "card": luhn, "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"list_reduce(list_prepend(0, {number}), lambda acc, x: (acc * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1",
    }[kind]
    match = f"length({digits}) BETWEEN 13 AND 19" if kind == "card" else "true"
    return f"""
SELECT doc_id, '{kind}' AS kind, {KINDS.index(kind)} AS k, start, stop,
  round({SCORES[kind]} + CASE WHEN regexp_matches(lower(concat(right(substr(t, p + 1, start - p), {NEAR}), ' ', substr(t, stop + 1, least({NEAR}, f - stop)))), '{CONTEXT[kind]}') THEN 0.15 ELSE 0 END, 2)::DOUBLE AS score
FROM (SELECT *, coalesce(lag(stop) OVER w, 0) AS p, coalesce(lead(start) OVER w, length(t)) AS f FROM (
  SELECT *, start + length(value) AS stop FROM (
    SELECT doc_id, t, v[i] AS value, (list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(v[1:i - 1], lambda y: length(y))), 0))::BIGINT AS start
    FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM (SELECT doc_id, t, regexp_extract_all(t, '{base}') AS v, string_split_regex(t, '{base}') AS g FROM d)))
  WHERE {match}) WINDOW w AS (PARTITION BY doc_id ORDER BY start)) WHERE {sure}"""


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_kind_sql(k) for k in KINDS)}),
a AS (SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in KINDS)}, max(score) AS top_score,
  string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY k, start) AS spans,
  string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY k, start) FILTER (WHERE kind <> 'iban') AS base FROM s GROUP BY 1)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, top_score
FROM d LEFT JOIN a USING (doc_id)
"""
