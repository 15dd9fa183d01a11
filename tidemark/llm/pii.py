"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust the score.

Per kind, matches are leftmost and do not overlap. A match that fails its check is dropped; nothing is tried
again inside it. Base kinds (email, ip, card, phone) stay whatever their score; added kinds (iban, confirmed
by mod-97, and national ids, which have no checksum) must reach ``least_score``. Places are code points, end
exclusive; they follow from the lengths of the matches and of the text between them, by a prefix sum.

The patterns are written so that they cannot backtrack far or recurse on very long runs: groups are possessive
and a match starts only at the head of a run or right after the match before it. This changes no match.

Defined cases: a null text counts as empty; rows are judged one by one, so equal rows give equal results;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.once import with_once


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # no capturing groups
    check: Callable[[Column], Column]  # match -> condition
    score: float
    context: str  # words that raise the score when near
    needs: str = ""  # a character that every match holds
    base: bool = True


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The weighted digit sum is a multiple of ten."""
    size = F.length(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when((size - place) % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Country and check digits moved to the end, letters as 10 to 35, remainder 1."""
    account = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(moved, place, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9]?)"

KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda match: F.lit(True),
        0.9,
        "mail|email|contact|write",
        "@",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda match: match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        0.7,
        "ip|host|server|address|login",
        ".",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda match: F.length(_digits(match)).between(16, 19) & luhn(_digits(match)),
        0.8,
        "card|visa|mastercard|credit|debit|payment",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda match: F.length(_digits(match)).between(8, 15),
        0.7,
        "phone|tel|telephone|call|mobile|fax",
        "+",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?+)(?![A-Za-z0-9])",
        mod97,
        0.8,
        "iban|account|bank|konto|compte|cuenta",
        base=False,
    ),
    Kind(
        "national_id",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda match: ~match.rlike("^(?:000|666|9)|-00-|-0000$"),
        0.3,
        "ssn|social security|national id",
        "-",
        base=False,
    ),
)
NEAR = 40


def _spans(kind: Kind, matches: Column, gaps: Column, least_score: float) -> Column:
    """array<struct<kind, start, end, score>>; gaps: the text between matches, one more than those."""
    ends = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda gap, match: F.length(gap) + F.length(match)
    )
    # Prefix sums by doubling the reach: log2(n) passes over the array.
    levels = F.ceil(F.log2(F.size(matches) + F.lit(1.0))).cast("int")

    def doubled(sums: Column, level: Column) -> Column:
        reach = F.pow(F.lit(2), level).cast("int")
        return F.transform(sums, lambda value, i: value + F.when(i >= reach, F.get(sums, i - reach)).otherwise(0))

    ends = F.aggregate(F.sequence(F.lit(0), levels), ends, doubled)
    near = rf"(?i)(?<![A-Za-z])(?:{kind.context})(?![A-Za-z])"

    def span(end: Column, i: Column) -> Column:
        match = F.get(matches, i)
        # A context word that a long gap cuts into is not one: the edge is part of the window.
        around = F.concat_ws("\n", F.right(F.get(gaps, i), F.lit(NEAR)), F.left(F.get(gaps, i + 1), F.lit(NEAR)))
        score = F.when(around.rlike(near), F.least(F.lit(1.0), F.lit(kind.score + 0.3))).otherwise(F.lit(kind.score))
        return F.struct(
            F.lit(kind.name).alias("kind"),
            (end - F.length(match)).alias("start"),
            end.alias("end"),
            score.alias("score"),
            kind.check(match).alias("valid"),
        )

    least = 0.0 if kind.base else least_score
    return F.filter(F.transform(ends, span), lambda found: found["valid"] & (found["score"] >= least))


def find(rows: DataFrame, text: str = "text", out: str = "pii", least_score: float = 0.5) -> DataFrame:
    """Add a struct with one array of spans per kind; a column of that name is replaced."""
    source = F.coalesce(F.col(text), F.lit(""))
    nothing = F.array().cast("array<string>")

    def matches(kind: Kind) -> Column:
        found = F.regexp_extract_all(source, F.lit(kind.pattern), F.lit(0))
        found = F.when(F.contains(source, F.lit(kind.needs)), found).otherwise(nothing) if kind.needs else found
        return found.alias(kind.name)

    def gaps(kind: Kind) -> Column:
        some = F.size(F.col(f"__matches.{kind.name}")) > 0
        return F.when(some, F.split(source, kind.pattern, -1)).otherwise(nothing).alias(kind.name)

    def spans(kind: Kind) -> Column:
        found, between = F.col(f"__matches.{kind.name}"), F.col(f"__gaps.{kind.name}")
        some = _spans(kind, found, between, least_score)
        none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double,valid:boolean>>")
        return F.when(F.size(found) > 0, some).otherwise(none).alias(kind.name)

    # Each step is evaluated once per row; the next ones use its fields many times.
    rows = with_once(rows.drop(out), "__matches", F.struct(*map(matches, KINDS)))
    rows = with_once(rows, "__gaps", F.struct(*map(gaps, KINDS)))
    return with_once(rows, out, F.struct(*map(spans, KINDS))).drop("__matches", "__gaps")


def report(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """doc_id, counts per base kind, base_sha256, spans; then the mean score of all spans, null without any."""
    rows = find(docs.select("doc_id", "text"), least_score=least_score).drop("text")
    base = [kind.name for kind in KINDS if kind.base]

    def listed(names: list[str]) -> Column:
        found = F.concat(*[F.col(f"pii.{name}") for name in names])
        return F.array_join(
            F.transform(
                found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
            ),
            ",",
        )

    scores = F.transform(F.concat(*[F.col(f"pii.{kind.name}") for kind in KINDS]), lambda x: x["score"])
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "doc_id",
        *[F.size(f"pii.{name}").cast("long").alias(f"n_{name}") for name in base],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed([kind.name for kind in KINDS]).alias("spans"),
        F.when(F.size(scores) > 0, F.round(total / F.size(scores), 4)).alias("mean_score"),
    )
