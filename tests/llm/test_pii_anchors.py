"""Anchor expansion against the patterns run over whole texts."""

import hashlib
import random
import re

import pytest

pytest.importorskip("ahocorasick")

from martwright.llm import pii_anchors  # noqa: E402
from martwright.llm.queries import QUERIES  # noqa: E402
from shared import checkpoint_folder  # noqa: E402, F401

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    valid = {
        "email": (EMAIL, lambda m: True),
        "ip": (IP, lambda m: all(int(part) <= 255 for part in m[0].split("."))),
        "card": (CARD, lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (PHONE, lambda m: 9 <= len(digits(m)) <= 15),
    }
    return [(k, *m.span()) for k, (p, ok) in valid.items() for m in p.finditer(text) if ok(m)]


def base(text):
    return [s for s in pii_anchors.spans(text) if s[0] in pii_anchors.BASE_KINDS]


@pytest.mark.parametrize("signs", ["0123 -.+@a()é", "01.", "1@.a-", "0 -+().5", "a@b.c", "2.5 "])
def test_base_spans_equal_the_patterns(signs):
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choices(signs, k=rng.randint(0, 40)))
        assert base(text) == brute(text), text


def test_long_texts_take_time_in_proportion():
    for text in ("a" * 300_000 + "@b.c", "1." * 200_000, "1 " * 200_000, "+1" * 200_000, "@a" * 200_000,
                 "token " * 60_000, "a://b:c" * 60_000, "4" * 300_000):
        assert base(text) == brute(text) if len(text) < 200_000 else pii_anchors.spans(text) is not None


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("my account no: 00-123-456 x", "account", "00-123-456"),
        ("IBAN DE89 3704 0044 0532 0130 00 ok", "account", "DE89 3704 0044 0532 0130 00"),
        ('password="a1b2c3d4"', "account", "a1b2c3d4"),
        ("call tel:0301-234567.", "tel", "0301-234567"),
        ("see ftp://joe:pw@host.example/x y", "url", "ftp://joe:pw@host.example/x"),
    ],
)
def test_further_kinds(text, kind, part):
    assert [text[a:b] for k, a, b in pii_anchors.spans(text) if k == kind] == [part]


@pytest.mark.parametrize(
    "text", ["on account of this", "accounts 1234567", "IBAN DE88 3704 0044 0532 0130 00x", "see http://x.org/a", "token", ""]
)
def test_clean_texts_stay_clean(text):
    assert pii_anchors.spans(text) == []


def test_query_digests_and_odd_rows(spark, tmp_path):
    texts = ["a@b.cc 1.2.3.4 \U0001f600 x@y.zz 999.1.1.1", None, "", "+1 (555) 123-4567 é 4111 1111 1111 1111"]
    texts += [texts[0], " ".join(["x@y.zz 10.0.0.1"] * 3000)]
    rows = [(i if i != 4 else 0, t, "kept", 1) for i, t in enumerate(texts)] + [(None, texts[0], "s", 2)]
    schema = "doc_id long, text string, spans string, n_email int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op12_pii_anchors"](spark, str(tmp_path)).collect()
    expected = []
    for doc_id, text, *_ in rows:
        spans = brute(text or "")
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(s[0] == k for s in spans) for k in pii_anchors.BASE_KINDS]
        expected.append((doc_id, *counts, hashlib.sha256(said.encode()).hexdigest(), said))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    none = spark.createDataFrame([], schema)
    assert pii_anchors.find(none).count() == 0
