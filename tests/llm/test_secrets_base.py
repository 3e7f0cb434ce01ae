"""The fixed patterns against a scanner that goes character by character."""

import random
import string

from foliospark.llm import secrets

KEY = set(string.ascii_letters + string.digits + "+/_=.-")
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")


def assign(text):
    out, at = [], 0
    while at < len(text):
        name = next((n for n in NAMES if all(c.isascii() for c in text[at : at + len(n)]) and text[at : at + len(n)].lower() == n), None)
        end = None
        if name:
            p = at + len(name)
            p += p < len(text) and text[p] in "\"'"
            while p < len(text) and text[p] == " ":
                p += 1
            if p < len(text) and text[p] in ":=":
                p += 1
                while p < len(text) and text[p] == " ":
                    p += 1
                p += p < len(text) and text[p] in "\"'"
                q = p
                while q < len(text) and text[q] in KEY:
                    q += 1
                if q > p:
                    end = q
        if end is None:
            at += 1
            continue
        if q - p >= 6:
            out.append(("assign", at, end))
        at = end
    return out


def runs(text, kind, head, chars, least):
    out, at = [], 0
    while at < len(text):
        if not text.startswith(head, at) or (not head and text[at] not in chars):
            at += 1
            continue
        end = at + len(head)
        while end < len(text) and text[end] in chars:
            end += 1
        if end == at + len(head) and head:
            at += 1
            continue
        if end - at >= least:
            out.append((kind, at, end))
        at = end
    return out


def test_base_spans():
    rng = random.Random(6)
    upper, low = string.ascii_uppercase + string.digits, "0123456789abcdef"
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "apiKEY", "\"", "'", " ", "  ", ":", "=", ".", "é", "ſecret", "AKIA", "AKI", "\n", "x"]
    novelty = secrets.Novelty()
    seen = 0
    for _ in range(3000):
        text = "".join(rng.choice([rng.choice(parts), rng.choice(parts), "".join(rng.choice(upper) for _ in range(rng.randint(1, 18))), "".join(rng.choice(low) for _ in range(rng.randint(3, 30)))]) for _ in range(rng.randint(1, 12)))
        want = assign(text) + runs(text, "access", "AKIA", set(upper), 20) + runs(text, "hex", "", set(low), 24)
        got = [s[:3] for s in secrets.spans(text, novelty) if s[0] != "novel"]
        assert sorted(got) == sorted(want), text
        seen += len(want)
    assert seen > 1000
