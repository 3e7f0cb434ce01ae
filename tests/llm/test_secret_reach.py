"""Whole secrets are found, whatever their length, line breaks and dots."""

import random
import string

import pytest

from foliospark.llm import secrets

rng = random.Random(6)
key = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
BODY = [key(64), key(64), key(64), key(21) + "=="]
LONG, JWT = key(64), f"{key(36)}.{key(60)}.{key(43)}"
PROSE = "and then there were some plain words of no great note"


@pytest.mark.parametrize("text, parts", [
    ("-----BEGIN PRIVATE KEY-----\n" + "\n".join(BODY) + "\n-----END PRIVATE KEY-----\n", BODY),
    ('{"private_key": "-----BEGIN PRIVATE KEY-----\\n' + "\\n".join(BODY) + '\\n-----END"}', BODY[1:]),
    (f"{PROSE} {LONG} is the secret {PROSE}", [LONG]),
    (f"the token {PROSE[:50]} {LONG} {PROSE}", [LONG]),
    (f"Authorization: Bearer {JWT}\n{PROSE}", JWT.split(".")),
])
def test_whole_secrets(text, parts):
    found = [(a, b) for _, a, b, _ in secrets.spans(text, secrets.Novelty())]
    for part in parts:
        a = text.index(part)
        assert any(x <= a and a + len(part) <= y for x, y in found), part
    assert all(w not in text[x:y] for x, y in found for w in PROSE.split() if len(w) > 4)


def test_lines_of_words_stay():
    text = f"password {LONG}\nfollowed\nby\nlines\n{PROSE}"
    assert {text[a:b] for _, a, b, _ in secrets.spans(text, secrets.Novelty())} == {LONG}


def test_redact_leaves_no_part(spark):
    text = "-----BEGIN PRIVATE KEY-----\r\n" + "\r\n".join(BODY) + "\r\n-----END PRIVATE KEY-----"
    got = secrets.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["text"]
    assert not any(line[:12] in got for line in BODY)
