"""Repair and formatting of conversations, and phrase collocations, against plain versions."""

import hashlib
import itertools
import json
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import chat, collocations, repair, turns

SPACE = " \t\n\x0b\x0c\r"


def least_audit(symbols):
    """Cheapest, then ASCII-least audit, by trying everything forwards with (cost, audit) per state."""
    states = {"": (0, "")}  # role initials so far matter only through the last one and whether any are there

    def better(into, state, value):
        if state not in into or value < into[state]:
            into[state] = value

    def inserts(states):
        states = dict(states)
        for _ in range(3):
            for s, (c, a) in list(states.items()):
                better(states, "a" if s == "u" else "u", (c + 3, a + "I"))
        return states

    for role, fault in symbols:
        after = {}
        for s, (c, a) in inserts(states).items():
            better(after, s, (c + 4, a + "D"))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                fits = {"s": s == "", "u": s in ("", "s", "a"), "a": s == "u"}.get(role, False)
                if fits:
                    better(after, role, (c + more, a + "K"))
                better(after, "a" if s == "u" else "u", (c + 3 + more, a + "R"))
        states = after
    ends = inserts(states)
    return min(ends[s] for s in ("", "a") if s in ends)


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
    cost, audit = least_audit([(r[:1], f) for (_, r, _), f in zip(rows, faults)])
    out, i, last = [], 0, ""
    for edit in audit:
        new = "assistant" if last == "u" else "user"
        if edit == "I":
            out.append((new, ""))
        else:
            _, role, text = rows[i]
            i += 1
            if edit != "D":
                out.append((role if edit == "K" else new, text))
        last = out[-1][0][:1] if out else ""
    initials = "".join(r[:1] for r, _ in out)
    assert i == len(rows) and initials.removeprefix("s").replace("ua", "") == "" and (initials == "" or initials != "s")
    numbers = {t for t, _, _ in rows} - {None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    count = Counter(faults)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, text)


def random_rows(rng, n):
    texts = ["Yes.", "No!", "why", "", " \n", "Long words here?", "é。", "a" * 3000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    return [(rng.choice([None, *range(n)]), rng.choice(roles), rng.choice([*texts, None, f"t{rng.random()}."])) for _ in range(n)]


@pytest.mark.parametrize("chunk_rows", [1, 3, 1000])
def test_repair_equals_plain(spark, chunk_rows):
    rng = random.Random(chunk_rows)
    cases = {k: random_rows(rng, rng.randrange(1, 25)) for k in [None, *range(60)]}
    cases[100] = [(t, "user" if t % 2 else "assistant", f"line {t}.") for t in range(40)] + [(7, "user", "line 7.")] * 5
    data = [(k, *r, "x") for k, rows in cases.items() for r in rows]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, audit string")
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.summary(repair.repair(df, chunk_rows=chunk_rows)).collect()}
    said = lambda x: " " if x is None else x
    assert got == {k: plain_repair(sorted(((t, said(r), said(x)) for t, r, x in rows), key=order)) for k, rows in cases.items()}


def test_long_runs_use_powers():
    symbols = "u." * 1000 + "a." * 777 + "s." * 3 + "ux" * 500
    pairs = [(symbols[k], {".": None, "x": "blank", "t": "truncated"}[symbols[k + 1]]) for k in range(0, len(symbols), 2)]
    edits, place = repair.unroll(symbols, repair.END, repair.BEGIN)
    cost, audit = least_audit(pairs)
    assert "".join(edits) + repair.closing(place) == audit
    m = repair.matrix(symbols)
    assert min(m[0][j] + repair.END[j] for j in range(4)) == cost


def test_empty_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.summary(repair.repair(repair.damage(df))).collect() == []


CONTROL = st.sampled_from([*chat.TEMPLATE.controls, "\\", "<", "[", "</s", "<\\s>", "\n", "a", "é", "[INST]\\", "<|im_", "end|>"])
TEXT = st.lists(CONTROL, max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=4))
def test_marked_texts_are_read_back(said):
    formatted, spans = chat.TEMPLATE.render([(r or "assistant", t) for r, t in said])
    assert chat.TEMPLATE.read(formatted) == [(r or "assistant", t) for r, t in said]
    assert [chat.TEMPLATE.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in said if not r or r == "assistant"]
    assert formatted.count("<|im_start|>") == formatted.count("<|im_end|>\n") == len(said)
    assert not any(c in chat.TEMPLATE.escape(t) for _, t in said for c in chat.TEMPLATE.controls)


def test_layouts_by_fingerprint(spark):
    records = [
        {"messages": [{"role": "system", "content": "S"}, {"role": "user", "content": "Q"}, {"content": "A", "role": "assistant"}]},
        {"conversations": [{"from": "human", "value": "Q"}, {"from": "gpt", "value": "A"}]},
        {"prompt": "Q", "completion": "A"},
        {"system": "S", "prompt": "Q", "response": "A"},
        {"instruction": "Q", "input": "more", "output": "A"},
        {"instruction": "Q", "input": "", "output": None},
        {"history": [["Q", "A"], ["Q2", "A2"]], "query": "Q3", "response": "A3"},
        {"messages": []},
        {"unknown": {"deep": [1]}},
        None,
    ]
    texts = [None if r is None else json.dumps(r) for r in records] + ["{no json", ""]
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], "n long, record string, layout string, loss string")
    rows = sorted(chat.format_chats(df).collect(), key=lambda r: r["doc"]["n"])
    assert [r["layout"] for r in rows] == ["messages", "speakers", "prompt", "response", "instruction", "instruction", "history", "messages", None, None, None, None]
    read = {r["doc"]["n"]: r for r in chat.read_chats(chat.format_chats(df)).collect()}
    said = [[tuple(t) for t in read[k]["turns"]] for k in range(len(texts))]
    qa = [("user", "Q"), ("assistant", "A")]
    assert said[:5] == [[("system", "S"), *qa], qa, qa, [("system", "S"), *qa], [("user", "Q\n\nmore"), ("assistant", "A")]]
    assert said[5:8] == [[("user", "Q"), ("assistant", "")], [*qa, ("user", "Q2"), ("assistant", "A2"), ("user", "Q3"), ("assistant", "A3")], []]
    assert said[8:] == [[]] * 4 and len({r["fingerprint"] for r in rows[:9]}) == 8
    assert read[0]["learned"] == ["A"] and all(r["doc"]["loss"] == "y" for r in rows)


def test_two_layouts_of_the_same_fields_are_refused():
    with pytest.raises(ValueError):
        chat.registry((chat.Layout("a", first=(chat.Part("x", "user"),)), chat.Layout("b", first=(chat.Part("x", "system"),))))


def test_long_conversations_are_digested_in_order(spark):
    rng = random.Random(5)
    cases = {k: [(t, rng.choice(["user", "assistant", "system"]), f"{k} {t} </s>\\" * rng.randrange(4)) for t in range(rng.randrange(1, 40))] for k in range(20)}
    df = spark.createDataFrame([(k, *r) for k, rows in cases.items() for r in rows], "conv_id long, turn long, role string, text string")
    chunks = turns.chunked(df, "conv_id", ["turn", "role", "text"], "text", chunk_rows=4)
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    got = turns.digested(chunks.select("key", "conv_id", "chunk", "long", F.size("turns").cast("long").alias("n"), body.alias("h")), True, "conv_id", ["n"], ["h"])
    assert {r["conv_id"]: (r["n"], r["h"]) for r in got.collect()} == {
        k: (len(rows), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in rows).encode()).hexdigest()) for k, rows in cases.items()}
    assert chunks.filter("size(turns) > 4").isEmpty() and not chunks.filter("long").isEmpty()


def plain_collocations(rows, least=10, share=50, top=2000):
    cut, langs = ".,;:!?\n\x0b\x0c\r", {}
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for text, lang in rows:
        counts = langs.setdefault("und" if lang is None else lang, Counter())
        for c in cut:
            text = (text or "").replace(c, ".")
        for piece in text.translate(lower).split("."):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            for n in (1, 2, 3):
                counts.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in langs.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        found = []
        for g, a in f.items():
            if len(g) < 2 or a < least:
                continue
            if any(len(x) > len(g) and x[i : i + len(g)] == g and f[x] >= least and 100 * f[x] >= share * a for x in f if len(x) == 3 for i in (0, 1)):
                continue
            s, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-s, -a, " ".join(g).encode(), a, f[g[:k]], f[g[k:]]))
        out += [(lang, r + 1, p.decode(), a, left, right, n, -s) for r, (s, _, p, a, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("budget, top", [(1 << 20, 2000), (40, 2000), (300, 7)])
def test_collocations_equal_plain(spark, budget, top):
    rng = random.Random(budget)
    stock = ["the", "Of", "new", "york", "city", "É", "漢字", "a-b", " x", "w(1)", *[f"w{k}" for k in range(12)]]
    def text(n):
        words = []
        while len(words) < n:
            words += ["new", "York", "city"] if rng.random() < 0.2 else [rng.choice(stock)]
        return "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ", "]) for w in words)
    rows = [(text(rng.randrange(60)), rng.choice(["en", "de", None, "und"])) for _ in range(150)]
    rows += [(None, "en"), ("", None), (" .\n", "fr"), ("the of " * 4000, "en"), ("only.one.word", "es")] + [rows[0]] * 12
    df = spark.createDataFrame([(k, t, x, 1, "s") for k, (t, x) in enumerate(rows)], "doc_id long, text string, lang string, a long, w1 string")
    got = sorted(tuple(r) for r in collocations.collocations(df, budget=budget, top=top).collect())
    assert got == plain_collocations(rows, top=top) and len(got) > 10


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_scores_are_exact(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(300):
        left, right = rng.randrange(10**12, 10**15 - 1), rng.randrange(10**12, 10**15 - 1)
        rows.append((rng.randrange(10, min(left, right)), left, right))
    rows += [(10**15 - 1,) * 3, (10**14, 10**14, 10**15 - 7)]
    df = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", collocations._score("a", "l", "r").alias("s"))
    assert all(s == 1000000 * a * a // (left * right) for a, left, right, s in df.collect())
