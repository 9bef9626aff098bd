import random
import re

import numpy as np
import pytest

import corpus_pipeline
from ledgerloom.llm import pii
from ledgerloom.llm.queries import tokenizer_path
from tests.llm.fixtures import odd_texts, words
from tests.llm.test_models import brute_counts
from tests.llm.test_near_dedup import brute_classes
from tests.llm.test_search import brute_hits, brute_spans

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(21)
    items = [(k, " ".join(words(rng, 25, 5000))) for k in range(6)]
    plain = [" ".join(words(rng, 150, 5000)) for _ in range(30)]
    copies = [p + f" tail{k}" for k, p in enumerate(plain[:6])] + plain[6:9]
    leaks = [f"{' '.join(words(rng, 70, 5000))} {items[k][1].upper()} {' '.join(words(rng, 30, 5000))}" for k in range(4)]
    private = [f"{' '.join(words(rng, 60, 5000))} write a.b@mail.org or call +49 151 23456789{k}, host 10.0.0.{k}" for k in range(4)]
    return plain + copies + leaks + private + odd_texts() + [" ".join(words(rng, 9000, 5000))], items


def stages(spark, folder, corpus):
    texts, items = corpus
    docs = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in enumerate(texts)], COLUMNS)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    seen = {i: t for i, t in enumerate(texts)}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = seen, stage(spark, docs, str(folder))
        docs = corpus_pipeline.durable(docs)
        if name != "packing":
            assert docs.dtypes == [tuple(c.split()) if c.split()[1] != "long" else (c.split()[0], "bigint") for c in COLUMNS.split(", ")]
            seen = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(r["n_chars"] == len(r["text"] or "") for r in docs.collect())
        yield name, before, seen, docs


def test_every_stage_equals_brute_force(spark, tmp_path, corpus):
    texts, items = corpus
    for name, before, after, docs in stages(spark, tmp_path, corpus):
        if name == "quality_rules":
            # No group of these few rows but their own language's; no gross outliers among them.
            assert after == {i: t for i, t in before.items() if not brute_counts(t)[-1]}
        elif name == "near_duplicates":
            ids = sorted(before)
            classes, _ = brute_classes([before[i] for i in ids])
            assert sorted(after) == sorted({ids[c] for c in classes}) and len(after) < len(before)
        elif name == "decontamination":
            ids = sorted(before)
            hits = brute_hits([before[i] for i in ids], items)
            assert sorted(after) == [i for i, h in zip(ids, hits) if not h[1]] and len(after) < len(before)
        elif name == "personal_data":
            assert after.keys() == before.keys()
            for i, t in before.items():
                out, at = "", 0
                for kind, a, b in brute_spans(t):
                    if a >= at:
                        out += t[at:a] + f"[{kind.upper()}]"
                    at = max(at, b)
                assert after[i] == out + t[at:]
            assert sum("[EMAIL]" in t for t in after.values()) == 4 and not any(re.search(r"@mail", t) for t in after.values())
        else:
            rows = docs.collect()
            assert {r["doc_id"] for r in rows} == set(before) and max(r["length"] for r in rows) <= 2048
            bins = {}
            for r in rows:
                bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
                assert len(np.frombuffer(bytes(r["ids"]), dtype="<u4")) == r["length"]
            for placed in bins.values():
                at = 0
                for offset, length in sorted(placed):
                    assert offset == at
                    at += length
                assert at <= 2048


def test_run_returns_the_last_stage(spark, tmp_path, corpus):
    texts, items = corpus
    spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in enumerate(texts)], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {"doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"} == set(corpus_pipeline.run(spark, str(tmp_path)).columns)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_labels_name_every_kind():
    assert set(pii.PATTERNS) == set(pii.SCORE) == set(pii.CONTEXT) == set(pii.KINDS) and tokenizer_path().endswith(".json")
