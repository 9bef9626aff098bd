"""Decontamination, license scan and personal data against plain-Python versions."""

import random
import re

import pytest

from ledgerloom.llm import decontamination, licenses, pii
from tests.llm.fixtures import odd_texts, table, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(texts, items, size=10):
    patterns = {}
    for item, t in items:
        w = split(t)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            patterns.setdefault(tuple(w[i : i + size]), set()).add(item)
    lengths = {len(p) for p in patterns}
    out = []
    for t in texts:
        w, hit, found = split(t), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                own = patterns.get(tuple(w[i : i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own - {None}
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block", [500_000, 40])
def test_contamination_equals_brute_force(spark, block):
    rng = random.Random(11)
    items = [(k, " ".join(words(rng, rng.choice([1, 2, 3, 7, 9, 10, 11, 30]), 60))) for k in range(60)]
    items += [(60, None), (61, ""), (None, "w1 w2 w3 w4 w5 w6"), (3, items[3][1]), (62, "ÉTÉ w5, W6!w7")]
    texts = [" ".join(words(rng, rng.randrange(400), 60)) for _ in range(60)] + odd_texts()
    texts += [f"{' '.join(words(rng, 50))} {items[7][1].upper()} tail" for _ in range(5)] + ["été w5 w6 w7"]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.contamination(table(spark, texts), benchmark, block=block).select("doc.doc_id", "n_words", "n_hit", "items", "hits").collect()
    want = brute_hits(texts, items)
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["items"]) == want[r["doc_id"]], r["doc_id"]
        assert sum(h["end"] - h["first"] for h in r["hits"]) == r["n_hit"]


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = decontamination.contamination(table(spark, odd_texts()), none).select("n_hit").collect()
    assert len(rows) == len(odd_texts()) and all(r["n_hit"] == 0 for r in rows)
    assert decontamination.contamination(table(spark, []), none).count() == 0


def brute_licenses(text):
    w = split(text)
    places = [(label, i) for label, p in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    blocks = []
    for i in range(0, len(w), licenses.STEP):
        own = set(w[i : i + licenses.BLOCK_WORDS])
        for k, (label, t) in enumerate(licenses.TEMPLATES):
            c = len(own & set(split(t))) / len(set(split(t)))
            if c >= licenses.THRESHOLD - 1e-9:
                blocks.append((label, k, i, min(i + licenses.BLOCK_WORDS, len(w)), c))
    return len(w), sorted(places), sorted(blocks)


def test_license_scan_equals_brute_force(spark):
    rng = random.Random(5)
    texts = odd_texts() + [f"{' '.join(words(rng, k * 23))}\n{t}\n{' '.join(words(rng, 90))}" for k, (_, t) in enumerate(licenses.TEMPLATES)]
    for _, t in licenses.TEMPLATES:
        w = split(t)
        for share in (0.95, 0.82, 0.78, 0.5):
            texts.append(" ".join(words(rng, rng.randrange(200)) + [x for x in w if rng.random() < share] + words(rng, 30)))
    texts += ["The MIT License. mit license, MIT-license", "apache", "license", "general public", "General Public License mit", " ".join(["mit license"] * 300)]
    rows = licenses.license_scan(table(spark, texts)).select("doc.doc_id", "n_words", "places", "blocks").collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r["n_words"], sorted((p["label"], p["word"]) for p in r["places"]), sorted(tuple(b) for b in r["blocks"]))
        assert got == brute_licenses(texts[r["doc_id"]]), r["doc_id"]
    assert any(r["blocks"] for r in rows) and licenses.license_scan(table(spark, [])).count() == 0


def brute_spans(t):
    t, out = t or "", []
    out += [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(x) for x in m[0] if x.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= sum(x.isdigit() for x in m[0]) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


PERSONAL = ["a@b.c@d.e", "a@b.c.d_e@f.g x.y@z", "1.2.3.4.5.6.7.8", "300.1.1.1 1.1.1.1 007.0.0.255", "4111 1111 1111 1111 5", "4111-1111-1111-1111", "+1 (555) 123-4567-",
            "é 漢 +49 151 2345678901", "x" * 10 + "9" * 3000, "1 " * 20000, "a" * 50000 + "@", "a@" * 5000, "+1 " + "(" * 50000, "1.2.3.4 " * 300, "a.b@c.d.e-f.g", "@a.b c@.d e@f..g",
            "👩‍👧 me@x.org 10.0.0.1, 4242424242424242!"]


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(2)
    texts = odd_texts() + PERSONAL + ["".join(rng.choice("0149@.-+ ()aZ_é") for _ in range(rng.randrange(200))) for _ in range(400)]
    rows = pii.find_pii(table(spark, texts)).select("doc.doc_id", "doc.spans", "spans").collect()
    assert len(rows) == len(texts) and {r[1] for r in rows} == {"s"}
    for r in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in r[2] if s["kind"] in pii.BASE] == brute_spans(texts[r["doc_id"]]), texts[r["doc_id"]][:80]


def test_added_kinds_need_checks_and_context(spark):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32 ok", "GB83WEST12345698765432", "call 555-123-4567", "number 555-123-4567", "server 10.0.0.1"]
    rows = {r["doc_id"]: r["spans"] for r in pii.find_pii(table(spark, texts)).select("doc.doc_id", "spans").collect()}
    assert [(s["kind"], s["value"]) for s in rows[0]] == [("iban", "GB82 WEST 1234 5698 7654 32")] and not rows[1]
    assert [s["kind"] for s in rows[2]] == ["local_phone"] and not rows[3] and rows[4][0]["score"] == pytest.approx(1.0)


def test_account_numbers_end_at_their_country_s_length(spark):
    numbers = ["GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
    after = [" Please pay", " BIC DEUTDEFF", " 12 pieces", " 5", " A", ". End", "", " " + "DE89370400440532013000"]
    texts = [f"to {n}{a}" for n in numbers for a in after] + ["GB82WEST12345698765432X", "GB82WEST123456987654321", "XGB82WEST12345698765432"]
    rows = {r["doc_id"]: r["spans"] for r in pii.find_pii(table(spark, texts)).select("doc.doc_id", "spans").collect()}
    for i, t in enumerate(texts):
        found = [s["value"] for s in rows[i] if s["kind"] == "iban"]
        want = [] if i >= len(numbers) * len(after) else [numbers[i // len(after)]] + ["DE89370400440532013000"] * (i % len(after) == len(after) - 1)
        assert found == want, t
    both = pii.find_pii(table(spark, ["GB82 WEST 1234 5698 7654 32", "lot BE12 GB82 WEST 1234 5698 7654 32 X"])).select("doc.doc_id", "spans").collect()
    assert {r[0]: [(s["start"], s["value"]) for s in r[1] if s["kind"] == "iban"] for r in both} == {i: [(a, numbers[0])] for i, a in ((0, 0), (1, 9))}


def test_redaction(spark):
    texts = ["mail me@x.org or 10.0.0.1 now", "none", None, "a@b.c@d.e", "é me@x.org é", ""]
    out = pii.redacted(table(spark, texts))
    rows = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "uid", "spans", "score"]
    assert [rows[i] for i in range(6)] == ["mail [EMAIL] or [IP] now", "none", None, "[EMAIL]@d.e", "é [EMAIL] é", ""]
    assert pii.redacted(table(spark, [])).count() == 0
