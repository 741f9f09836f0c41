"""Pseudonyms of account numbers whose country and body look like hexadecimal digits."""

from __future__ import annotations

import pytest

from tileplan.llm.pseudonyms import pseudonymised

VALID = ["DE89370400440532013000", "AE070331234567890123456", "BE68539007547034", "GB82WEST12345698765432"]
FAILING = ["DE88370400440532013000", "BE69539007547034"]
SECRET = "AB12" + "0F3C" * 7


def remainder(account):
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def test_account_numbers(spark):
    texts = [f"Pay to {a} today, {a}." for a in VALID + FAILING] + [f'key "{SECRET}" end']
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    changed = pseudonymised(docs, "k")
    got = {r.doc_id: r.text for r in changed.collect()}
    for k, account in enumerate(VALID):
        first, second = got[k].split()[2], got[k].split()[4].rstrip(".")
        assert first == second != account and first[:2] == account[:2] and remainder(first) == 1
        assert [c.isdigit() for c in first[2:]] == [c.isdigit() for c in account[2:]]
    for k in range(len(VALID), len(VALID) + len(FAILING)):
        assert got[k] == texts[k]
    secret = got[len(texts) - 1].split('"')[1]
    assert secret != SECRET and len(secret) == 32 and set(secret) <= set("0123456789ABCDEF")
    back = pseudonymised(changed, "k", undo=True)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts))
