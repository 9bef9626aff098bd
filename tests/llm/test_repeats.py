import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import repeats
from tests.llm.fixtures import odd_texts, table


def brute(texts, length):
    seen = {}
    data = [(t or "").encode() for t in texts]
    for d, body in enumerate(data):
        for i in range(len(body) - length + 1):
            seen.setdefault(body[i : i + length], []).append((d, i))
    cover = [bytearray(len(b)) for b in data]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                cover[d][i : i + length] = b"\1" * length
    return [(len(b), bytes(x for x, c in zip(b, m) if not c), sum(m)) for b, m in zip(data, cover)]


def check(spark, texts, **shape):
    rows = repeats.without_repeats(table(spark, texts), **shape).select("doc.doc_id", "n_bytes", "removed", "kept").collect()
    want = brute(texts, shape.get("length", 400))
    assert len(rows) == len(texts)
    for r in rows:
        n, kept, gone = want[r["doc_id"]]
        assert (r["n_bytes"], bytes(r["kept"]), sum(s["end"] - s["start"] for s in r["removed"])) == (n, kept, gone), r["doc_id"]
        ends = [x for s in r["removed"] for x in (s["start"], s["end"])]
        assert ends == sorted(set(ends))
    return rows


def planted(seed, n, alphabet, passages, sizes):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    stock = [text(rng.choice(sizes)) for _ in range(passages)]
    out = []
    for _ in range(n):
        parts = [text(rng.randrange(300))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(stock)
            a = rng.randrange(len(p) // 3)
            parts += [p[a : a + rng.randrange(len(p))], text(rng.randrange(60))]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("seed,alphabet,large", [(1, "abcdefgh ", 4096), (2, "ab", 4096), (3, "abé漢 ", 4096), (4, "abcd", 3)])
def test_small_shapes_equal_brute_force(spark, seed, alphabet, large):
    texts = planted(seed, 60, alphabet, 5, [60, 120, 200])
    check(spark, texts, length=40, gram=10, large=large)


def test_production_shape_equals_brute_force(spark):
    texts = planted(9, 40, "abcdefghijklmnop ", 4, [500, 900, 1500]) + ["x" * 1500, "y" * 399, "lorem ipsum " * 90]
    texts += [texts[0], texts[3], texts[3]]
    check(spark, texts)


def test_odd_rows(spark):
    texts = odd_texts()
    rows = {r["doc_id"]: r for r in check(spark, texts)}
    assert rows[8]["kept"] == b"" and rows[0]["n_bytes"] == 0 and rows[10]["kept"] == b""
    assert repeats.without_repeats(table(spark, [])).count() == 0
    assert repeats.without_repeats(table(spark, [None, ""])).select("removed").collect()[0][0] == []


def test_intervals_are_the_prefix_tree():
    suffixes = sorted(["banana", "band", "bandana", "can", "candle", "ban"])
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    lcp = [common(a, b) for a, b in zip(suffixes, suffixes[1:])]
    want = set()
    for i in range(len(suffixes)):
        for j in range(i + 1, len(suffixes)):
            v = min(lcp[i:j])
            if v and (i == 0 or lcp[i - 1] < v) and (j == len(suffixes) - 1 or lcp[j] < v):
                want.add((v, i, j))
    assert set(repeats.intervals(lcp)) == want


def _by_group(groups):
    out = {}
    for r in groups.collect():
        out.setdefault(r["group"], []).append(r)
    return out


def test_groups_list_all_occurrences(spark):
    rng = random.Random(4)
    text = lambda k: "".join(rng.choice("abcdefghijkl ") for _ in range(k))
    passage = text(150)
    texts = [text(100) + passage + text(80) for _ in range(5)]
    groups = repeats.repeat_groups(table(spark, texts), length=40, gram=10)
    bodies = {hashlib.md5(t.encode()).digest(): t for t in texts}
    for rows in _by_group(groups).values():
        assert len({bodies[bytes(r["key"])][r["start"] : r["end"]] for r in rows if r["end"] - r["start"] == max(x["end"] - x["start"] for x in rows)}) >= 1
    whole = groups.groupBy("group").agg(F.countDistinct("key").alias("docs"), F.max(F.col("end") - F.col("start")).alias("n"))
    assert whole.filter("docs = 5 AND n >= 40").count() >= 1


def test_sliding_least_and_greatest():
    x = np.random.default_rng(0).integers(0, 50, 1000).astype(np.uint64)
    for w in (1, 2, 7, 351):
        views = np.lib.stride_tricks.sliding_window_view(x, w)
        assert (repeats._sliding(x, w, np.minimum) == views.min(axis=1)).all()
        assert (repeats._sliding(x, w, np.maximum) == views.max(axis=1)).all()
