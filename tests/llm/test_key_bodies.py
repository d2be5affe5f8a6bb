"""A private key's body is masked with its header."""

from __future__ import annotations

import base64
import random

from vitaldf.llm import secret_scan

BEGIN, END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"


def lines(seed: int, n: int, width: int = 64) -> list[str]:
    body = base64.b64encode(random.Random(seed).randbytes(n)).decode()
    return [body[i:i + width] for i in range(0, len(body), width)]


def test_no_body_character_survives_masking(spark):
    key, head = lines(1, 1190), ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123ABCD", ""]
    texts = [
        ("whole", "\n".join(["before", BEGIN, *key, END, "after it"])),
        ("crlf", "\r\n".join(["before", BEGIN, *key, END, "after it"])),
        ("headers", "\n".join(["before", BEGIN, *head, *key, END, "after it"])),
        ("indented", "\n    ".join(["before", BEGIN, *key, END, "after it"])),
        ("escaped", "\\n".join(["before ", BEGIN, *key, END, " after it"])),
        ("one line", " ".join(["before", BEGIN, "".join(key), END, "after it"])),
        ("open", "\n".join(["before", BEGIN, *key, "", "\tafter it"])),
        ("open headers", "\n".join(["before", BEGIN, *head, *key, "", "\tafter it"])),
        ("open indented", "\n    ".join(["before", BEGIN, *key, "after it"])),
        ("open long", "\n".join(["before", BEGIN, *lines(2, 400_000), "", "\tafter it"])),
        ("open long indented", "\n ".join(["before", BEGIN, *lines(3, 20_000), "after it"])),
        ("two", "\n".join(["before", BEGIN, *key, "", " words between - and more", BEGIN, *key, END, "after it"])),
        ("bare", f"before {BEGIN} a few words after it")]
    df = spark.createDataFrame(list(enumerate(t for _, t in texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in secret_scan.mask_secrets(df).collect()}
    for i, (name, text) in enumerate(texts):
        assert "before" in got[i] and "after it" in got[i] and "[SECRET]" in got[i], name
        assert not any(x in got[i] for x in key + lines(2, 400_000) + lines(3, 20_000)), name
        assert "KEY" not in got[i], name
    assert got[0] == "before\n[SECRET]\nafter it"
    assert "words between - and more" in got[11]
    assert got[12] == "before [SECRET] a few words after it"


def test_long_bodies_and_any_number_of_dashes(spark):
    """Of 10 MB, in lines and in words, with and without an END line, and with very many dashes."""
    body = lines(4, 7_500_000, 20)
    dashed = "-".join(f"{i:016d}" for i in range(400)) + "--" + "0" * 16 + "------" + "1" * 16
    texts = [
        "\n".join(["before", BEGIN, *body, END, "after it"]),
        " ".join(["before", BEGIN, *body, END, "after it"]),
        " ".join(["before", BEGIN, *body, "\n\nafter it"]),
        "\n".join(["before", BEGIN, *body, "", "\tafter it"]),
        f"before {BEGIN}\n{dashed}\n{END} after it",
        f"before {BEGIN}\n" + "Name: value\n" * 5000 + "\n".join(body[:50]) + "\n\n\tafter it",
        "before " + "-----BEGIN " * 3000 + " PRIVATE KEY- after it"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(len(texts))
    got = {r["doc_id"]: r["text"] for r in secret_scan.mask_secrets(df).collect()}
    assert got[0] == "before\n[SECRET]\nafter it"
    assert got[1] == "before [SECRET] after it"
    assert got[2].split() == ["before", "[SECRET]", "after", "it"]
    assert got[3].split() == ["before", "[SECRET]", "after", "it"]
    assert got[4] == "before [SECRET] after it"
    assert got[5].split() == ["before", "[SECRET]", "after", "it"]
    assert got[6] == texts[6]
