import random
from collections import Counter
from itertools import combinations
from math import log

import numpy as np

from ledgerloom.llm import near_dedup
from ledgerloom.llm.arrays import Words, shingles
from tests.llm.fixtures import odd_texts, table, words


def brute_classes(texts, threshold=0.8, cells=near_dedup.CELLS):
    """Weighted Jaccard of all pairs, then components."""
    sets = []
    for t in texts:
        data = np.frombuffer((t or "").encode(), dtype=np.uint8)
        w = Words(data, np.array([0, len(data)]))
        h, _ = shingles(w.hash, w.first, 5)
        sets.append(Counter((h >> np.uint64(16)).tolist()))
    df = np.zeros(1 << cells, dtype=np.int64)
    cell = lambda x: int(near_dedup._cell(np.array([x], dtype=np.uint64), cells)[0])
    for s in sets:
        for x in s:
            df[cell(x)] += 1
    idf = near_dedup.idf_table(df, len(texts))
    weighted = [{x: (1 + log(n)) * float(idf[cell(x)]) for x, n in s.items()} for s in sets]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    near = []
    for i, j in combinations(range(len(texts)), 2):
        a, b = weighted[i], weighted[j]
        both = sum(min(a[x], b[x]) for x in a.keys() & b.keys())
        either = sum(a.values()) + sum(b.values()) - both
        s = both / either if either else float(not a and not b)
        near.append(s)
        if s >= threshold:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))], near


def variants(seed, groups, size, edits):
    rng, texts = random.Random(seed), []
    for _ in range(groups):
        origin = words(rng, 200, 5000)
        for _ in range(size):
            w = list(origin)
            for _ in range(rng.randrange(edits)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    return texts


def got(df):
    return {r["doc_id"]: (r["class_id"], r["class_size"]) for r in df.select("doc.doc_id", "class_id", "class_size").collect()}


def test_classes_equal_brute_force(spark):
    texts = variants(1, 12, 8, 9) + [" ".join(words(random.Random(k), 150, 9000)) for k in range(40)]
    want, near = brute_classes(texts)
    # Pairs within a hair of the threshold aside, the drawn samples miss one in thousands.
    assert not [s for s in near if abs(s - 0.8) < 1e-6]
    found = got(near_dedup.near_duplicates(table(spark, texts)))
    assert [found[i][0] for i in range(len(texts))] == want
    assert [found[i][1] for i in range(len(texts))] == [want.count(x) for x in want]


def test_large_group_of_near_copies_is_one_class(spark):
    texts = variants(3, 1, 120, 4) + [" ".join(words(random.Random(k), 150, 9000)) for k in range(20)]
    found = got(near_dedup.near_duplicates(table(spark, texts)))
    assert {found[i] for i in range(120)} == {(0, 120)} and all(found[i] == (i, 1) for i in range(120, 140))


def test_odd_rows(spark):
    texts = odd_texts()
    found = near_dedup.near_duplicates(table(spark, texts, ids=[None if i == 4 else i for i in range(len(texts))]))
    rows = found.select("doc.doc_id", "doc.uid", "class_id", "class_size", (found.uid == found.representative).alias("first")).collect()
    assert len(rows) == len(texts) and {r["uid"] for r in rows} == {"u"}
    of = {r["doc_id"]: r for r in rows}
    assert of[0]["class_id"] == of[1]["class_id"] == of[2]["class_id"] == of[11]["class_id"] == 0  # no words
    assert of[None]["class_id"] == of[5]["class_id"] == of[6]["class_id"] == 5 and of[5]["first"] and not of[None]["first"]
    assert of[8]["class_size"] == 2 and of[3]["class_size"] == 1 and sum(r["first"] for r in rows) == len({r["class_id"] for r in rows})
    assert near_dedup.near_duplicates(table(spark, [])).count() == 0


def test_samples_agree_as_often_as_weights(spark):
    """The share of equal samples estimates the weighted Jaccard similarity."""
    rng = np.random.default_rng(5)
    elements = rng.integers(1, 1 << 48, 400).astype(np.uint64)
    a, b = rng.uniform(0.5, 3, 400).astype(np.float32), rng.uniform(0.5, 3, 400).astype(np.float32)
    s = near_dedup._samples(np.tile(elements, 2), np.concatenate([a, b]), np.array([0, 400, 800]), 3000)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[:, 0] == s[:, 1]).mean() - true) < 0.03


def test_texts_are_picked_where_they_lie(spark):
    """All nodes and few others pass the bit table; documents meet their labels by a join that is the same at every size."""
    nodes = spark.range(0, 60_000, 3).withColumnRenamed("id", "node")
    kept = {r["uid"] for r in spark.range(60_000).withColumnRenamed("id", "uid").filter(near_dedup._among(nodes)).collect()}
    assert kept >= set(range(0, 60_000, 3)) and len(kept) < 20_000 + 4_000
    assert not spark.range(100).withColumnRenamed("id", "uid").filter(near_dedup._among(nodes.limit(0))).count()
    plan = near_dedup.near_duplicates(table(spark, variants(3, 1, 6, 4)))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan
