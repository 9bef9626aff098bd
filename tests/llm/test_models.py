"""Quality rules, language-model scores and the classifier."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import lm_score, quality, toxicity
from tests.llm.fixtures import odd_texts, table, words


def brute_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def test_counts_equal_brute_force(spark):
    rng = random.Random(8)
    texts = odd_texts() + [rng.choice(["\n", " ", "\x0b"]).join(words(rng, rng.randrange(120), rng.choice([3, 20, 900]))) for _ in range(120)] + ["a b c", "a b c a b c", "é# é# é#\n\né# é# é#"]
    rows = quality.quality(table(spark, texts)).select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:7] == brute_counts(texts[r["doc_id"]]), r["doc_id"]
        assert not (r["base_failed"] and r["kept"])
    assert quality.quality(table(spark, [])).count() == 0


def mcd_distances(x, floors):
    """The same concentration steps in numpy, with exact quantiles."""
    m = np.median(x, axis=0)
    s = 1.4826 * np.median(np.abs(x - m), axis=0)
    cov = np.diag(s**2 + floors**2)
    for step in range(quality.STEPS + 1):
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
        if step < quality.STEPS:
            near = x[d <= np.quantile(d, quality.SUPPORT)]
            m, cov = near.mean(axis=0), np.cov(near.T, bias=True) + np.diag(floors**2)
    return d / max(np.median(d) / quality.MEDIAN_4, 1)


def test_distances_follow_concentration_steps(spark):
    rng = np.random.default_rng(2)
    good = rng.multivariate_normal([1.5, 0.3, 0.2, 0.4], 0.03 * np.array([[2, 1, 0, 0], [1, 2, 0, 0], [0, 0, 1, 0.5], [0, 0, 0.5, 1]]), 500)
    bad = rng.normal([4, 3, 1, 1], 0.1, (60, 4))
    x = np.concatenate([good, bad])
    names = list(quality.FEATURES)
    rows = spark.createDataFrame([(k, "en", None, *map(float, v)) for k, v in enumerate(x)], "uid long, lang string, source string, " + ", ".join(f"{n} double" for n in names))
    found = {r["uid"]: r["distance"] for r in quality.outliers(rows).collect()}
    got, want = np.array([found[k] for k in range(len(x))]), mcd_distances(x, np.array(list(quality.FEATURES.values())))
    assert (got[500:] > quality.CUTOFF).all() and (got[:500] < quality.CUTOFF).all()
    assert np.corrcoef(got[:500], want[:500])[0, 1] > 0.99 and abs(np.median(got) / np.median(want) - 1) < 0.15


def test_small_groups_reject_nobody_and_odd_groups_count_apart(spark):
    texts = [" ".join(words(random.Random(k), 80)) for k in range(20)] + ["#### " * 60]
    rows = quality.quality(table(spark, texts)).select("doc.doc_id", "base_failed", "kept", "distance").collect()
    assert all(r["kept"] for r in rows if not r["base_failed"]) and sum(r["base_failed"] for r in rows) == 1


def test_junk_within_the_fixed_limits_is_rejected(spark):
    """Each kind of junk by itself, in a group whose other texts have no symbols or repetitions."""
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(10**6):06d}" for _ in range(n)]
    lines = lambda n: [" ".join(fresh(12)) for _ in range(n)]
    clean = ["\n".join(lines(rng.randrange(6, 30))) for _ in range(150)]
    clean += ["\n".join(x + [x[0]]) for x in (lines(9) for _ in range(3))] + ["\n".join(lines(8)) + " #1" for _ in range(3)]
    double = lambda x: x + x[: len(x) // 2 - 1]
    repeated = [" ".join(double(fresh(100))[:130]) for _ in range(3)]
    duplicated = ["\n".join(x + ["ab"] * 18) for x in (lines(18) for _ in range(3))]
    marked = ["\n".join(" ".join([*fresh(11), "#"]) for _ in range(20)) for _ in range(3)]
    texts = clean + repeated + duplicated + marked
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    rows = {r["doc_id"]: r for r in quality.quality(docs).select("doc.doc_id", "base_failed", "kept", "distance").collect()}
    assert not any(r["base_failed"] for r in rows.values())
    assert [i for i in rows if rows[i]["kept"] != (i < len(clean))] == []


@pytest.mark.parametrize("block_bytes,bucket_bytes", [(lm_score.BLOCK_BYTES, lm_score.BUCKET_BYTES), (2000, 3000)])
def test_cross_entropy_equals_brute_force(spark, monkeypatch, block_bytes, bucket_bytes):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", bucket_bytes)
    rng = random.Random(4)
    texts = [" ".join(words(rng, 90, 40) if k % 3 else [f"t{rng.randrange(30)}" for _ in range(90)]) for k in range(60)] + odd_texts()
    good = [k for k in range(60) if k % 3 == 0]
    target = spark.createDataFrame([(k,) for k in [*good, good[0], None]], "doc_id long")
    rows = lm_score.cross_entropy_difference(table(spark, texts), target, prior=3.0).select("doc.doc_id", "n_tokens", "target_loss", "background_loss", "score").collect()
    split = [re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    steps = [list(zip([None, *w], [*w, None])) if w else [] for w in split]
    kinds = len({x for w in split for x in w}) + 1
    counts = []
    for chosen in (good, range(len(texts))):
        pairs = Counter(p for k in chosen for p in steps[k])
        counts.append((pairs, Counter(w for k in chosen for _, w in steps[k]), pairs.total()))

    def mean_loss(k, model, scale, inside):
        own, own_words = Counter(steps[k]), Counter(w for _, w in steps[k])
        n = lambda total, mine: (total - mine * inside) * scale
        pairs, single, size = model
        out = 0.0
        for c, w in steps[k]:
            share = (n(single[w], own_words[w]) + 1) / (n(size, len(steps[k])) + kinds)
            out -= np.log((n(pairs[c, w], own[c, w]) + 3.0 * share) / (n(single[c], own_words[c]) + 3.0))
        return out / max(len(steps[k]), 1)

    assert len(rows) == len(texts)
    for r in rows:
        k = r["doc_id"]
        t, b = mean_loss(k, counts[0], 1.0, k in good), mean_loss(k, counts[1], counts[0][2] / counts[1][2], True)
        assert r["n_tokens"] == len(split[k]) and r["target_loss"] == pytest.approx(t) and r["background_loss"] == pytest.approx(b)
        assert r["score"] == pytest.approx(t - b, abs=1e-9)
    scores = {r["doc_id"]: r["score"] for r in rows}
    assert max(scores[k] for k in good) < min(scores[k] for k in range(60) if k % 3) and scores[len(texts) - 13] == 0.0


def test_rare_words_tell_copies_apart(spark):
    rng = random.Random(11)
    common = [" ".join([*words(rng, 40, 30), *(f"w{k}x{i}" for i in range(20))]) for k in range(40)]
    docs = table(spark, common + common[:4])  # the first four texts occur twice; all rare words count
    rows = {r["doc_id"]: r["background_loss"] for r in lm_score.cross_entropy_difference(docs, docs.filter("doc_id = 39")).select("doc.doc_id", "background_loss").collect()}
    twice = [0, 1, 2, 3, 40, 41, 42, 43]
    assert max(rows[k] for k in twice) < min(rows[k] for k in rows if k not in twice)


def test_scores_without_target_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long")
    rows = lm_score.cross_entropy_difference(table(spark, odd_texts()), none).select("score").collect()
    assert all(r["score"] == 0.0 for r in rows)
    assert lm_score.cross_entropy_difference(table(spark, []), none).count() == 0


def test_classifier_on_held_out_rows(spark):
    rng = random.Random(6)
    texts, labels = [], []
    for k in range(400):
        w, bad = words(rng, 60), k % 5 == 0
        if bad:
            w[rng.randrange(60)] = rng.choice(["blockhead", "numbskull", "Dimwit"])
        texts.append(" ".join(w))
        labels.append((k, int(bad)))
    docs = table(spark, texts + odd_texts())
    known = spark.createDataFrame([x for x in labels if x[0] % 4] + [(1, None), (None, 1)], "doc_id long, toxic int")
    weights, intercept = toxicity.fit(docs, known)
    rows = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, weights, intercept).select("doc.doc_id", "score").collect()}
    assert len(rows) == 400 + len(odd_texts()) and all(0 <= s <= 1 for s in rows.values())
    wrong = sum((rows[k] >= 0.5) != bool(y) for k, y in labels if k % 4 == 0)
    assert wrong <= 4


def test_classifier_without_both_classes(spark):
    docs = table(spark, odd_texts())
    for rows, score in (([], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0)):
        weights, intercept = toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        got = toxicity.toxicity(docs, weights, intercept).select("score").collect()
        assert all(abs(r["score"] - score) < 1e-9 for r in got)
