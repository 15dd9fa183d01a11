import hashlib
import random
import re

import pytest

from tidemark.llm import pii

DOCS = "doc_id long, text string, pii string, spans string"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
]


def brute(text):
    out = []
    for kind, pattern, check in BASE:
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text or "") if check(m.group())]
    return out


def texts():
    draw = random.Random(5)
    parts = ["a", "x.y", "@", ".", "b-c.de", " ", "+", "1", "255", "256", "0012", "-", "4225039295678253", "(0)", "_", "ü", "😀", "\n"]
    some = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 40))) for _ in range(400)]
    some += ["a@b.c_d@e.f", "4225 0392-9567 8253", "1.2.3.4.5.6.7.8", "+49 (0)30 1234567", "x" * 20000, "1" * 20000]
    some += ["1 " * 20000, "me@x.org " * 3000, "+1" * 5000, "a@" + "b." * 10000, "00000000255.1.1.1", "1.1.1.1" * 400]
    return [*some, "", None]


def test_base_spans_equal_brute_force(spark):
    data = [(i, t, "x", None) for i, t in enumerate(texts())]
    rows = pii.report(spark.createDataFrame(data, DOCS).repartition(4)).collect()
    for r in rows:
        want = brute(data[r.doc_id][1])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), data[r.doc_id][1][:200]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(k == kind for k, *_ in want) for kind, *_ in BASE
        )
        got = r.spans.split(",") if r.spans else []
        assert got[: len(want)] == [f"{k}:{a}:{b}" for k, a, b in want]


@pytest.mark.parametrize(
    "text, spans",
    [
        ("pay to DE89370400440532013000 now", "iban:7:29"),
        ("pay to DE89 3704 0044 0532 0130 00 now", "iban:7:34"),
        ("pay to DE88370400440532013000 now", ""),
        ("her SSN 123-45-6789 is", "national_id:8:19"),
        ("part 123-45-6789 is", ""),
        ("her SSN 000-45-6789 is", ""),
    ],
)
def test_added_kinds(spark, text, spans):
    found = pii.report(spark.createDataFrame([(1, text, "", "")], DOCS)).collect()[0].spans
    assert ",".join(s for s in found.split(",") if s.split(":")[0] in ("iban", "national_id")) == spans


def test_context_raises_the_score(spark):
    rows = [(1, "phone: +49 30 1234567", "", ""), (2, "lot +49 30 1234567", "", "")]
    scores = {r.doc_id: r.mean_score for r in pii.report(spark.createDataFrame(rows, DOCS)).collect()}
    assert scores == {1: 1.0, 2: 0.7}


def test_empty(spark):
    assert pii.report(spark.createDataFrame([], DOCS)).count() == 0
