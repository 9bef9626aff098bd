"""Small tables with nulls, empty and long texts, repeated rows, clashing column names."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, uid string, spans string, score string"


def words(rng, n, stock=400):
    return [f"w{rng.randrange(stock)}" for _ in range(n)]


def table(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en" if i % 3 else None, f"s{i % 2}", len(t or ""), "u", "s", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS)


def odd_texts(seed=7):
    rng = random.Random(seed)
    long = " ".join(words(rng, 6000, 3000))
    plain = " ".join(words(rng, 120))
    return [None, "", " \n\t ", "one", plain, plain, plain + " more", "É ñ 漢字 👩‍👧 ß", long, long, "a" * 5000, "#" * 300, "\n".join(["same line here"] * 30)]


def by_id(rows):
    return {r["doc_id"]: r for r in rows}
