"""Personal data: patterns propose spans, checksums confirm them, context words weigh them.

Each kind has a pattern, a test that a match must pass (Luhn, mod-97, number ranges, digit
counts) and a base score; a context word shortly before the span raises the score. Base kinds
(email, ip, card, phone) are always kept; added kinds (iban, ssn) need the threshold.

The patterns are written without backtracking over runs: a match starts at the beginning of its
run or where the last match ended, and repetitions are possessive, so a text of one endless word
takes linear time. Positions are code points, end exclusive: the text is split at the matches, and
the lengths of the pieces are summed up.

Defined results: null text counts as empty; every input row gives one row, repeated or null
doc_ids included; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 48
THRESHOLD = 0.5
CONTEXT_BONUS = 0.3
CHUNK = 512


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The Luhn test of a string of digits."""
    def add(total: Column, place: Column) -> Column:
        digit = F.substr(number, F.length(number) - place, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 1, doubled).otherwise(digit)

    places = F.sequence(F.lit(0), F.length(number) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """The mod-97 test of an IBAN without blanks: first four characters last, letters as 10-35."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substr(turned, place, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    places = F.sequence(F.lit(1), F.length(turned))
    return F.aggregate(places, F.lit(0), add) == 1


def card_number(match: Column) -> Column:
    number = digits(match)
    return F.length(number).between(13, 19) & luhn(number)


def account_number(match: Column) -> Column:
    account = F.regexp_replace(match, " ", "")
    return F.length(account).between(15, 34) & mod97(account)


PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"


@dataclass(frozen=True)
class Kind:
    """``hint`` is a substring without which the pattern can't match (empty: none)."""

    name: str
    pattern: str
    passes: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True
    hint: str = ""


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda m: F.lit(True), 0.9, "mail|contact|write|schreib|escrib", hint="@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda m: m.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$"), 0.6, "ip|host|server|address",
         hint="."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", card_number, 0.7,
         "card|visa|credit|karte|carte|tarjeta|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(digits(m)).between(9, 15), 0.6,
         "phone|call|tel|mobile|fax|whatsapp", hint="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         account_number, 0.8, "iban|account|bank|konto|compte|cuenta", base=False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         lambda m: F.lit(True), 0.3, "ssn|social|security|insurance", base=False, hint="-"),
)


PAIRS = "array<struct<gap:string,match:string>>"
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def matches_of(text: Column, kind: Kind) -> Column:
    """The matches of one kind's pattern in ``text``."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return F.when(text.contains(kind.hint), found).otherwise(F.array().cast("array<string>")) \
        if kind.hint else found


def pairs_of(text: Column, matches: Column, kind: Kind) -> Column:
    """Each match with the text between it and the one before."""
    pairs = F.zip_with(F.split(text, kind.pattern, -1), matches,
                       lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    return F.when(F.size(matches) > 0, F.filter(pairs, lambda p: p["match"].isNotNull())).otherwise(
        F.array().cast(PAIRS))


def spans_of(pairs: Column, kind: Kind) -> Column:
    """The confirmed matches of one kind."""
    none = F.array().cast(SPANS)

    def step(acc: Column, pair: Column) -> Column:
        gap, match = pair["gap"], pair["match"]
        start = acc["at"] + F.length(gap)
        end = start + F.length(match)
        near = F.lower(F.right(gap, F.lit(CONTEXT_CHARS))).rlike(rf"(?<!\p{{L}})(?:{kind.context})")
        score = F.lit(kind.score) + F.when(near, CONTEXT_BONUS).otherwise(0.0)
        score = F.least(score, F.lit(1.0))
        keep = kind.passes(match) & (F.lit(kind.base) | (score >= THRESHOLD))
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"),
                        score.alias("score"))
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    def begun(at: Column) -> Column:
        return F.struct(at.alias("at"), none.alias("out"))

    def width(total: Column, pair: Column) -> Column:
        return total + F.length(pair["gap"]) + F.length(pair["match"])

    def in_chunks(pairs: Column) -> Column:
        """Fold ``CHUNK`` matches at a time, so that time stays linear in their number."""
        zero = F.lit(0).cast("bigint")
        chunks = F.transform(F.sequence(F.lit(0), F.size(pairs) - 1, F.lit(CHUNK)),
                             lambda i: F.slice(pairs, i + 1, F.lit(CHUNK)))
        starts = F.aggregate(chunks, F.array(zero), lambda done, chunk: F.concat(done, F.array(
            F.aggregate(chunk, F.element_at(done, -1), width))))
        return F.flatten(F.zip_with(chunks, F.slice(starts, F.lit(1), F.size(chunks)), lambda chunk, at:
                                    F.aggregate(chunk, begun(at), step, lambda acc: acc["out"])))

    count = F.size(pairs)
    whole = F.aggregate(pairs, begun(F.lit(0).cast("bigint")), step, lambda acc: acc["out"])
    return F.when(count == 0, none).when(count <= CHUNK, whole).otherwise(in_chunks(pairs))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and the spans (kind, start, end, score) by kind as in ``KINDS``, then start."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # one step each, so that no pattern runs once per match
    matched = text.select("doc_id", "text", *(matches_of(F.col("text"), k).alias(k.name) for k in KINDS))
    paired = matched.select("doc_id", *(pairs_of(F.col("text"), F.col(k.name), k).alias(k.name)
                                        for k in KINDS))
    found = paired.select("doc_id", *(spans_of(F.col(k.name), k).alias(k.name) for k in KINDS))
    return found.select("doc_id", F.concat(*(k.name for k in KINDS)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin([k.name for k in KINDS if k.base]))
