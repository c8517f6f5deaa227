"""Secrets longer than a rule's least length, and whole keys, are redacted to the last character."""

from __future__ import annotations

import random
import string

import pytest

from textloom.llm import secrets

_RNG = random.Random(8)


def _chars(n, more="+/"):
    return "".join(_RNG.choices(string.ascii_letters + string.digits + more, k=n))


_LINES = [*(_chars(64) for _ in range(20)), _chars(30) + "=="]
_BEGIN, _END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
_HEADERS = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,00FF", ""]
CASES = [
    f"ghp_{_chars(400, '')}",
    f"xoxb-{_chars(400, '-')}0",
    f"eyJ{_chars(1_200, '_')}.eyJ{_chars(1_200, '-_')}.{_chars(1_200, '_')}0",
    f"://{_chars(90, '')}:{_chars(200, '')}@",
    "\n".join([_BEGIN, *_LINES, _END]),
    "\r\n".join([_BEGIN, *_HEADERS, *_LINES, _END]),
    "\\n".join([_BEGIN, *_LINES, _END]),
    " ".join([_BEGIN, *_LINES, _END]),
    "\n".join([_BEGIN, *_LINES]),
    "\n".join([_BEGIN, *_HEADERS, *_LINES]),
    "\\n".join([_BEGIN, *_LINES]),
    _BEGIN,
]


@pytest.mark.parametrize("secret", CASES)
def test_nothing_of_a_secret_stays(secret):
    texts = [f'before "{secret}" after', f"before\n{secret}\n\nSome words, after", f"{secret}\n{secret}"]
    spans = secrets.spans_of(texts, secrets.plan(secrets.RULES))
    cut = [secrets._cut(t, s, "*").replace("**", "*") for t, s in zip(texts, spans, strict=True)]
    assert cut == ['before "*" after', "before\n*\n\nSome words, after", "*\n*"]


def test_keys_through_redaction(spark):
    docs = spark.createDataFrame([(i, f"a\n{c}\n\nb c") for i, c in enumerate(CASES)], "doc_id long, text string")
    assert {r.text for r in secrets.redact_secrets(docs).collect()} == {"a\n[secret]\n\nb c"}


def test_a_key_ends_at_its_own_end_line():
    words = "words - that -- stay"
    text = f"{_BEGIN}\n{_LINES[0]}\n\n{words}\n{_BEGIN}\n{_LINES[1]}\n{_END}\n{words}"
    spans = secrets.spans_of([text], secrets.plan(secrets.RULES))[0]
    assert secrets._cut(text, spans, "*") == f"*\n\n{words}\n*\n{words}"
