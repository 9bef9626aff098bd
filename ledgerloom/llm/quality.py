"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Everything is DataFrame expressions. Counts are taken inside each row. Documents within the fixed limits are described by
four transformed statistics (``FEATURES``); per language and source a minimum-covariance-determinant estimate is found by
concentration steps: keep the ``SUPPORT`` share of rows nearest to the centre, re-estimate mean and covariance from them,
repeat. There are three starts: medians and absolute deviations, the half of the rows nearest to the medians, all rows;
of their ends the least determinant counts. The kept share varies less than all rows, so distances are divided by the
group's median over that of the chi-squared law (the consistency factor), where it is above 1. Rows whose squared
Mahalanobis distance then exceeds ``CUTOFF``, a quantile of that law, are rejected.

Shares are square roots and lines count two more, so that one repeated line of a short text is no outlier; each feature
can reject alone, even in a group without spread (above about a third of words repeated or lines duplicated).

Quantiles within groups come from histograms of fixed resolution (``_quantile``): map-side counts, so a source with a
third of all rows costs no more than any other, and equal inputs give equal results.

Groups of fewer than ``LEAST`` rows are judged with the other small groups of their language, then of all languages; if
even those are fewer, nobody is rejected. Deviations have floors, so that a group in which all agree rejects no small
difference.

Defined results: a null text has no words and fails the limits; null language or source is a group of its own;
repeated rows stay; extra columns stay inside ``doc``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import whole
from ledgerloom.scale import computed_once, durable, join_unique

LEAST_WORDS = 50
MOST_REPEATED = 50
LEAST = 60
SUPPORT = 0.75
STEPS = 4
#: chi-squared law with four degrees of freedom: one of 10,000 rows is beyond it
CUTOFF = 23.513
#: median of the chi-squared law with four degrees of freedom
MEDIAN_4 = 3.3567
FEATURES = {"word_length": 0.05, "symbols": 0.10, "dup_lines": 0.12, "repeats": 0.12}
_STEP = 1 / 128


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeated(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""

    def of_windows(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        repeated = _let(
            by_hash,
            lambda s: F.filter(s, lambda e, k: (F.get(s, k - 1)["x"] == e["x"]) | (F.get(s, k + 1)["x"] == e["x"])),
        )
        covered = F.array_distinct(F.flatten(F.transform(repeated, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2))))
        any_twice = _let(F.sort_array(h), lambda s: F.exists(F.transform(s, lambda x, k: F.coalesce(F.get(s, k - 1) == x, F.lit(False))), lambda b: b))
        return F.when(any_twice, F.size(covered)).otherwise(0)

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    return F.when(F.size(words) >= 4, _let(hashes, of_windows)).otherwise(0).cast("long")


def counts(text: Column) -> list[Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(0))
    n_words = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated(w).alias("repeated"))).alias("w")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup = _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return [
        n_words,
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        dup.alias("n_dup_lines"),
        F.size(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long").alias("n_lines"),
    ]


def _quantile(rows: DataFrame, values: dict[str, Column], share: float) -> DataFrame:
    """Per group ``g`` a quantile of each value, from counts of cells of fixed width."""
    cells = rows.select("g", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.floor(v / _STEP).alias("cell")) for n, v in values.items()])).alias("c"))
    counted = cells.groupBy("g", "c.name", "c.cell").agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy("g", "name").orderBy("cell")
    all_ = Window.partitionBy("g", "name")
    reached = counted.withColumn("below", F.sum("n").over(up)).withColumn("total", F.sum("n").over(all_)).filter(F.col("below") >= share * F.col("total"))
    return reached.groupBy("g").agg(*[F.min(F.when(F.col("name") == n, (F.col("cell") + 1) * _STEP)).alias(n) for n in values])


def _distance() -> Column:
    """Squared Mahalanobis distance of the FEATURES: forward substitution with a Cholesky factor."""
    z: list[Column] = []
    for i, name in enumerate(FEATURES):
        rest = F.col(name) - F.col(f"m_{i}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * z[j]
        z.append(rest / F.col(f"l_{i}_{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _with_factor(model: DataFrame) -> DataFrame:
    """Cholesky factor (l_i_j) of the covariances (c_i_j), row by row."""
    k = len(FEATURES)
    for i in range(k):
        for j in range(i + 1):
            rest = F.col(f"c_{i}_{j}")
            for m in range(j):
                rest = rest - F.col(f"l_{i}_{m}") * F.col(f"l_{j}_{m}")
            model = model.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l_{j}_{j}"))
    return model


def _place(lang: Column, source: Column) -> Column:
    """Key of a language and source; nulls are values."""
    return F.to_json(F.array(lang, source), {"ignoreNullFields": "false"})


def _groups(rows: DataFrame) -> DataFrame:
    """(place, g): the group in which each language and source is judged, a wider pool where these have few rows."""
    wide = F.to_json(F.array(F.col("lang")), {"ignoreNullFields": "false"})
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    pooled = sizes.withColumn("pool", F.sum(F.when(F.col("n") < LEAST, F.col("n"))).over(Window.partitionBy("lang")))
    place = _place(F.col("lang"), F.col("source"))
    return pooled.select(
        place.alias("place"), F.when(F.col("n") >= LEAST, place).when(F.col("pool") >= LEAST, wide).otherwise(F.lit("*")).alias("g"))


_MEANS = [f"m_{i}" for i in range(len(FEATURES))]
_FACTOR = [f"l_{i}_{j}" for i in range(len(FEATURES)) for j in range(i + 1)]


def estimates(rows: DataFrame) -> DataFrame:
    """(place, means, Cholesky factor, scale, group_size) of every language and source; rows: lang, source, FEATURES."""
    names, floors, k = list(FEATURES), list(FEATURES.values()), len(FEATURES)
    groups = durable(_groups(rows))
    rows = durable(join_unique(rows.withColumn("place", _place(F.col("lang"), F.col("source"))), groups, ["place"], "inner").select("g", *names))
    centre = durable(_quantile(rows, {n: F.col(n) for n in names}, 0.5).withColumnsRenamed(dict(zip(names, _MEANS))))
    spread = _quantile(rows.join(centre, "g"), {n: F.abs(F.col(n) - F.col(m)) for n, m in zip(names, _MEANS)}, 0.5)
    size = rows.groupBy("g").agg(F.count(F.lit(1)).alias("group_size"))

    def moments(of: DataFrame) -> DataFrame:
        return of.groupBy("g").agg(
            *[F.avg(n).alias(m) for n, m in zip(names, _MEANS)],
            *[(F.covar_pop(names[i], names[j]) + (floors[i] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}") for i in range(k) for j in range(i + 1)],
        )

    def nearest(placed: DataFrame, share: float) -> DataFrame:
        return placed.join(_quantile(placed, {"limit": F.col("d")}, share), "g").filter(F.col("d") < F.col("limit"))

    by_medians = centre.join(spread, "g").select(
        "g", *_MEANS,
        *[((F.pow(F.col(n) * 1.4826, 2) + floors[i] ** 2) if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, n in enumerate(names) for j in range(i + 1)],
    )
    from_medians = sum((F.pow((F.col(n) - F.col(m)) / f, 2) for n, m, f in zip(names, _MEANS, floors)), F.lit(0.0))
    by_half = moments(nearest(rows.join(centre, "g").withColumn("d", F.log1p(from_medians)), 0.5).select("g", *names))
    starts = [by_medians, by_half, moments(rows)]
    started = lambda no: F.concat(F.lit(f"{no} "), F.col("g")).alias("g")
    model = reduce(DataFrame.union, [m.select(started(no), *m.columns[1:]) for no, m in enumerate(starts)])
    tries = rows.select(F.explode(F.array(*[started(no) for no in range(len(starts))])).alias("g"), *names)
    for _ in range(STEPS):
        model = durable(_with_factor(model))
        model = moments(nearest(tries.join(model, "g").withColumn("d", F.log1p(_distance())), SUPPORT).select("g", *names))
    model = durable(_with_factor(model))
    determinant = reduce(lambda a, b: a * b, [F.col(f"l_{i}_{i}") for i in range(k)])
    best = model.groupBy(F.substr(F.col("g"), F.lit(3)).alias("g")).agg(
        F.min_by(F.struct(*_MEANS, *_FACTOR), F.struct(determinant, F.col("g"))).alias("best"))
    model = durable(best.select("g", "best.*").join(size, "g"))
    placed = rows.join(model, "g").withColumn("d", F.log1p(_distance()))
    scale = _quantile(placed, {"median": F.col("d")}, 0.5).select("g", F.greatest(F.expm1("median") / MEDIAN_4, F.lit(1.0)).alias("scale"))
    return groups.join(model.join(scale, "g"), "g").select("place", *_MEANS, *_FACTOR, "scale", "group_size")


def _scaled() -> Column:
    """Distance in units in which the group's median is as expected; 0 in a group too small to judge."""
    return F.when(F.col("group_size") >= LEAST, _distance() / F.col("scale")).otherwise(F.lit(0.0))


def outliers(rows: DataFrame) -> DataFrame:
    """The rows with their ``distance``; rows: lang, source, FEATURES and any others."""
    keyed = rows.withColumn("place", _place(F.col("lang"), F.col("source")))
    return join_unique(keyed, estimates(rows), ["place"], "left").withColumn("distance", _scaled()).select(*rows.columns, "distance")


def quality(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: ``doc``, the counts, base_failed, distance (null if base_failed) and kept.

    Documents are read twice, for the estimates and for the verdicts, and never shuffled: each meets the estimates of its
    language and source, a table whose size is checked before it is broadcast.
    """
    def counted(*kept: Column) -> DataFrame:
        rows = docs.select(
            *kept, F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{source}`").cast("string").alias("source"), *counts(F.col(f"`{text}`")))
        once = computed_once(rows, keys=["doc"] if kept else [])
        n, repeated = F.col("w.n"), F.col("w.repeated")
        features = {
            "word_length": F.log(F.col("word_chars") / n), "symbols": F.log1p(F.col("n_symbols") * 10.0 / n),
            "dup_lines": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 2)), "repeats": F.sqrt(repeated / n),
        }
        return once.select(
            *(["doc"] if kept else []), "lang", "source", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", repeated.alias("n_repeat_words"),
            ((n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)).alias("base_failed"), *[F.when(n > 0, v).alias(c) for c, v in features.items()])

    described = counted().filter(~F.col("base_failed")).select("lang", "source", *FEATURES)
    models = estimates(durable(described))
    rows = counted(whole(docs)).withColumn("place", _place(F.col("lang"), F.col("source")))
    judged = join_unique(rows, models, ["place"], "left").withColumn("distance", F.when(~F.col("base_failed"), _scaled()))
    return judged.select(
        "doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"))
