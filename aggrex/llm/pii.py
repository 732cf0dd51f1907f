"""Operator 4: personal data by patterns, checksums and context words.

DataFrame expressions only. A pattern proposes spans; validators confirm them
(Luhn, mod-97, number ranges, digit counts); context words nearby raise or
lower the score. Positions come from cutting the text at the matches: a span
starts after all pieces and matches before it. The patterns are written so that
Java's matcher neither recurses nor scans a run of characters twice, whatever
the length of the text: possessive repeats, and starts only where a run starts
or the last match ended. They match what the plain patterns match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Plain patterns of the base kinds.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}([0-9A-Z]{11,30}|(\x20[0-9A-Z]{4}){2,7}(\x20[0-9A-Z]{1,3})?)\b",
    "ssn": r"\b[0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9][0-9][0-9]\b",
}
# The same matches without recursion and in one pass over each run.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": (r"(?<![0-9A-Za-z_])[A-Z]{2}[0-9]{2}"
             r"(?:[0-9A-Z]{11,30}|(?:\x20[0-9A-Z]{4}){2,7}(?:\x20[0-9A-Z]{1,3})?)(?![0-9A-Za-z_])"),
    "ssn": r"(?<![0-9A-Za-z_])[0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9][0-9][0-9](?![0-9A-Za-z_])",
}
# What a text must hold for a kind to be looked for at all.
NEEDS = {"email": "@", "phone": "+"}
BASE = ["email", "ip", "card", "phone"]
KINDS = BASE + ["iban", "ssn"]
# Score without context, and words that raise or lower it (any language of the corpus may add its own).
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
RAISES = {
    "email": "mail|contact|kontakt|correo|courriel", "ip": "ip|host|server|address|adresse",
    "card": "card|visa|pay|karte|tarjeta|carte", "phone": "call|phone|tel|mobile|telefon|llamar",
    "iban": "iban|bank|account|konto|cuenta|compte", "ssn": "ssn|social|security|insurance",
}
LOWERS = "version|example|test|sample|order|invoice|isbn"
CONTEXT = 40  # code points before and after a span
ADDED_SCORE = 0.5  # added kinds count from this score on; base kinds always count
BLOCK = 64  # lengths are summed by blocks, so many spans in one text stay cheap


def _pieces(text: Column, kind: str) -> Column:
    """Matches with start and end, in code points."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # regexp_extract_all and split see the same matches; a piece precedes each match.
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    cut = F.arrays_zip(found.alias("value"), gaps.alias("gap"))
    cut = F.slice(cut, 1, F.size(found))
    # whole: code points up to the end of the match, from the piece's start.
    steps = F.transform(cut, lambda x: F.struct(x["value"].alias("value"), x["gap"].alias("gap"),
                                                (x["gap"] + F.length(x["value"])).alias("whole")))
    return steps


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda acc, x: acc + x["whole"])


def _block_totals(steps: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor(F.size(steps) / F.lit(BLOCK)).cast("int")),
                       lambda b: _total(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))


def _rated(kind: str, place: int, text: Column, placed: Column) -> Column:
    """Confirmed spans of a kind with their scores."""
    return F.transform(F.filter(placed, lambda s: _valid(kind, s["value"])), lambda s: F.struct(
        s["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), s["end"].alias("end"),
        _score(kind, text, s).alias("score")))


def _count(place: int) -> Column:
    return F.size(F.filter("pii", lambda s: s["place"] == place)).cast("long")


def _placed(steps: Column, blocks: Column) -> Column:
    """start and end of every step: whole blocks before it, then the steps of its own block."""
    def place(x, i):
        block = F.floor(i / F.lit(BLOCK)).cast("int")
        before = (F.aggregate(F.slice(blocks, F.lit(1), block), F.lit(0), lambda acc, y: acc + y)
                  + _total(F.slice(steps, block * BLOCK + 1, i - block * BLOCK)))
        start = before + x["gap"]
        return F.struct(x["value"].alias("value"), start.alias("start"), (before + x["whole"]).alias("end"))

    return F.transform(steps, place)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """The Luhn sum of the digits is a multiple of ten."""
    digits = F.reverse(_digits(value))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
            F.substring(digits, i, F.lit(1)).cast("int") * 2
            - F.when(F.substring(digits, i, F.lit(1)).cast("int") > 4, 9).otherwise(0)))
    return total % 10 == 0


def _mod97(value: Column) -> Column:
    """ISO 7064 check: country and check digits go last, letters count 10 to 35."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)),
                      F.substring(plain, F.lit(1), F.lit(4)))
    rest = F.aggregate(
        F.sequence(F.lit(1), F.length(turned)), F.lit(0),
        lambda acc, i: F.when(
            F.substring(turned, i, F.lit(1)).rlike("[0-9]"),
            (acc * 10 + F.substring(turned, i, F.lit(1)).cast("int")) % 97).otherwise(
            (acc * 100 + F.ascii(F.substring(turned, i, F.lit(1))) - 55) % 97))
    return rest == 1


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.when(
            F.length(F.regexp_replace(p, "^0+", "")) <= 3,
            F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255).otherwise(False))
    if kind == "card":
        n = F.length(_digits(value))
        return F.when((n >= 14) & (n <= 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        n = F.length(_digits(value))
        return (n >= 10) & (n <= 15)
    if kind == "iban":
        n = F.length(F.regexp_replace(value, " ", ""))
        return F.when((n >= 15) & (n <= 34), _mod97(value)).otherwise(False)
    # ssn: area, group and serial that are never given out.
    return ~value.rlike("^(000|666|9)|-00-|-0000$")


def _score(kind: str, text: Column, span: Column) -> Column:
    """Base score, a quarter up for a word of the kind nearby, a quarter down for a word against it."""
    start = F.greatest(span["start"] - CONTEXT, F.lit(0))
    around = F.lower(F.concat_ws(
        " ", F.substring(text, start + 1, span["start"] - start),
        F.substring(text, span["end"] + 1, F.lit(CONTEXT))))
    raised = F.when(around.rlike(f"(^|[^a-z])(?:{RAISES[kind]})"), 0.25).otherwise(0.0)
    lowered = F.when(around.rlike(f"(^|[^a-z])(?:{LOWERS})"), 0.25).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(SCORES[kind]) + raised - lowered))


def pii_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii``: array of (start, place, kind, end, score), ordered.

    start and end are code points, end exclusive; place is the kind's place in
    ``KINDS``. Base kinds (email, ip, card, phone) are kept whatever their
    score; added kinds (iban, ssn) from ``ADDED_SCORE`` on. NULL and empty texts
    have no spans. No shuffle; one pass over the text per kind that the text
    can hold.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.drop("pii").withColumn("_text", text)
    nothing = F.expr("array()").cast("array<struct<value:string,gap:int,whole:int>>")
    for kind in KINDS:
        may = F.contains(F.col("_text"), F.lit(NEEDS[kind])) if kind in NEEDS else F.col("_text").rlike(
            {"ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "iban": "[A-Z][A-Z][0-9][0-9]",
             "ssn": "[0-9]-[0-9][0-9]-[0-9]"}[kind])
        out = out.withColumn(f"_{kind}", F.when(may, _pieces(F.col("_text"), kind)).otherwise(nothing))
    for kind in KINDS:
        steps = F.col(f"_{kind}")
        out = out.withColumn(f"_{kind}_blocks", F.when(F.size(steps) > 0, _block_totals(steps)))
    spans = []
    for place, kind in enumerate(KINDS):
        steps = F.col(f"_{kind}")
        rated = _rated(kind, place, F.col("_text"), _placed(steps, F.col(f"_{kind}_blocks")))
        if kind not in BASE:
            rated = F.filter(rated, lambda s: s["score"] >= ADDED_SCORE)
        empty = F.expr("array()").cast("array<struct<start:int,place:int,kind:string,end:int,score:double>>")
        spans.append(F.when(F.size(steps) > 0, rated).otherwise(empty))
    out = out.withColumn("pii", F.array_sort(F.concat(*spans)))
    return out.drop("_text", *[f"_{k}" for k in KINDS], *[f"_{k}_blocks" for k in KINDS])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, counts of the base kinds, sha256 of the base spans, all spans,
    and their scores after context in hundredths, in the order of the spans."""
    found = pii_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    base = F.filter("pii", lambda s: s["place"] < len(BASE))
    return found.select(
        "doc_id",
        *[_count(p).alias(f"n_{k}") for p, k in enumerate(BASE)],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"),
        F.size(F.filter("pii", lambda s: s["place"] >= len(BASE))).cast("long").alias("n_added"),
        F.array_join(F.transform("pii", lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",")
        .alias("scores"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span's text replaced by <KIND>; overlapping spans become
    one, named after the first. Columns and rows stay; texts without spans stay as they are."""
    found = pii_spans(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                                  docs[text_col].alias("text")))
    text = F.col("text")
    # Spans are ordered by start; what lies inside the last kept one is merged into it.
    merged = F.aggregate(
        "pii", F.expr("array()").cast("array<struct<start:int,end:int,kind:string>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > s["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"),
                F.element_at(acc, -1)["kind"].alias("kind"))))).otherwise(
            F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                           s["kind"].alias("kind"))))))
    out = found.withColumn("_spans", F.when(F.size("pii") > 0, merged))
    spans = F.col("_spans")
    kept = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.concat(
        F.when(i > 0, F.concat(F.lit("<"), F.upper(F.get(spans, i - 1)["kind"]), F.lit(">"))).otherwise(""),
        F.substring(text, F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0) + 1,
                    F.coalesce(F.get(spans, i)["start"], F.length(text))
                    - F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0))))
    clean = F.when(F.size("pii") > 0, F.array_join(kept, "")).otherwise(text)
    return out.select(*[(clean if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
