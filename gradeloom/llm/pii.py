"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.sqltext import listed, places

LOCAL = "A-Za-z0-9._%+-"
#: Length of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: An account number of a country's length, and any other run that may be one, up to where such a number begins.
KNOWN_IBAN = "|".join(
    rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items())
OTHER_IBAN = rf"[A-Z]{{2}}[0-9]{{2}}(?:(?:\x20(?!(?:{KNOWN_IBAN})(?![A-Za-z0-9])))?[A-Z0-9]){{11,30}}"
#: A match can only begin where its run of characters begins or the match before ended; saying so keeps
#: the search linear, and possessive loops keep it off the stack.
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{KNOWN_IBAN}|{OTHER_IBAN})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ["email", "ip", "card", "phone"]
NEEDS = {"email": "@", "phone": "+"}
CONTEXT = {
    "email": r"mail|contact|write to|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|adresse",
    "card": r"card|visa|credit|payment|karte|tarjeta|carte",
    "phone": r"phone|call|tel|mobile|fax|telefon|tél",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "ssn": r"ssn|social security|taxpayer",
}
#: Score of a match without context words; they add CONTEXT_GAIN. What a checksum confirms starts higher.
START = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT_GAIN = 0.2
#: Spans of the method's own kinds are reported from this score on; the base kinds are always reported.
LEAST_SCORE = 0.5


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits' Luhn sum is a multiple of ten."""
    figures = F.transform(F.split(F.reverse(number), ""), lambda c: c.cast("int"))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether an account number leaves 1 when divided by 97, its first four characters moved to the end."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    value = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(value, F.lit(0), lambda a, v: F.when(v > 9, a * 100 + v).otherwise(a * 10 + v) % 97) == 1


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"),
    "card": lambda m: F.when(F.length(digits(m)).between(16, 19), luhn(digits(m))).otherwise(False),
    "phone": lambda m: F.length(digits(m)).between(8, 15),
    "iban": mod97,
    "ssn": lambda m: ~m.rlike("^(000|666|9)"),
}


def rated(kind: str):
    return lambda match, around: F.least(F.lit(1.0), F.lit(START[kind]) + F.when(around.rlike(CONTEXT[kind]), CONTEXT_GAIN).otherwise(0.0))


def personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data in every whole text.

    Takes columns doc_id and text; others are ignored, whatever their names. Returns doc_id, `found`, an
    array of (kind, start, end, score) by kind in the order of PATTERNS and then start, and `base`, the same
    for the four base kinds alone. Null and empty texts have no spans. Equal rows are answered one by one;
    no rows give no rows. One pass, no shuffle.
    """
    nothing = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,score:double>>)")
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    text, spans = F.col("_text"), {}
    for kind, pattern in PATTERNS.items():
        if kind in NEEDS:
            maybe = F.contains(text, F.lit(NEEDS[kind]))
        else:
            maybe = F.col("_figures")
        spans[kind] = F.when(maybe, places(text, pattern, kind, VALID[kind], rated(kind))).otherwise(nothing)
    extra = [k for k in PATTERNS if k not in BASE]
    return (
        slim.withColumn("_figures", text.rlike("[0-9]"))
        .select("doc_id", F.concat(*(spans[k] for k in BASE)).alias("base"),
                F.filter(F.concat(*(spans[k] for k in extra)), lambda s: s["score"] >= LEAST_SCORE).alias("more"))
        .select("doc_id", F.concat("base", "more").alias("found"), "base")
    )


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans as text, one row per document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    scores = F.array_join(F.transform("found", lambda s: F.round(s["score"], 2).cast("string")), ",")
    return personal_data(docs).select(
        "doc_id", *(count(k) for k in BASE), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"), scores.alias("scores"),
    )
