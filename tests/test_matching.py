"""Distributed linkage against the sequential rule, on small inputs with many conflicts."""

import datetime as dt
import random
from difflib import SequenceMatcher

import pytest

from pyspark.sql import functions as F

from ledgerloom.functions.similarity import EditDistances, blocks_bound, edit_bound, edit_similarity, letter_counts, token_set_quick, token_set_score
from ledgerloom.operators import matching
from tests.helpers import d, rows

DAY = dt.date(2024, 3, 1)
WORDS = ["acme", "acme corp", "blue cafe", "blue", "corp cafe", "delta"]


def ledger(n, seed):
    r = random.Random(seed)
    return [(i, i, DAY + dt.timedelta(days=r.randrange(2)), d(f"{-r.randrange(100, 103)}.{r.choice(['00', '25', '50'])}"), r.choice(WORDS)) for i in range(n)]


def sheet(n, seed):
    r = random.Random(seed)
    return [(100 + i, i, DAY + dt.timedelta(days=r.randrange(2)), d(f"{r.randrange(100, 103)}.{r.choice(['00', '25', '75'])}"), r.choice(WORDS)) for i in range(n)]


def sequential(q, w, fits, score, least=None):
    used, pairs = set(), []
    for a in sorted(q, key=lambda x: x[1]):
        best, best_score = None, None
        for b in sorted(w, key=lambda x: x[1]):
            if b[0] in used or not fits(a, b):
                continue
            s = score(a, b)
            if least is not None and s < least:
                continue
            if best is None or s > best_score:
                best, best_score = b, s
        if best is not None:
            used.add(best[0])
            pairs.append((a[0], best[0]))
    return sorted(pairs)


@pytest.fixture(params=["components", "rounds"])
def way(request, monkeypatch):
    """Small components in one task each, or everything by rounds of proposals."""
    if request.param == "rounds":
        monkeypatch.setattr(matching, "COMPONENT_ROWS", 0)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_date_amount_equals_sequential(spark, seed, way):
    q, w = ledger(40, seed), sheet(35, seed + 10)
    want = sequential(
        q, w, lambda a, b: a[2] == b[2] and abs(abs(a[3]) - b[3]) <= d("0.50"),
        lambda a, b: SequenceMatcher(None, a[4].lower(), b[4].lower()).ratio(),
    )
    got = matching.match_date_amount(
        spark.createDataFrame(q, "q_id INT, q_ord BIGINT, date DATE, amount DECIMAL(18,2), description STRING"),
        spark.createDataFrame(w, "w_id INT, w_ord BIGINT, date DATE, cost DECIMAL(18,2), source STRING"),
    )
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len({b for _, b in want}) == len(want) > 10


@pytest.mark.parametrize("seed", [4, 5])
def test_fuzzy_equals_sequential(spark, seed, way):
    r = random.Random(seed)
    make = lambda base, n: [
        (base + i, i, DAY + dt.timedelta(days=r.randrange(8)), d(str(r.randrange(3))), r.choice(WORDS)) for i in range(n)]
    q, w = make(0, 40), make(100, 40)
    want = sequential(q, w, lambda a, b: a[3] == b[3] and abs((a[2] - b[2]).days) <= 3,
                      lambda a, b: token_set_score(a[4], b[4]), least=0.72)
    schema = "{0}_id INT, {0}_ord BIGINT, date DATE, amount DECIMAL(18,2), description STRING"
    got = matching.match_fuzzy(spark.createDataFrame(q, schema.format("q")), spark.createDataFrame(w, schema.format("w")))
    assert sorted((x.q_id, x.w_id) for x in got.collect()) == want


def test_hot_copies_pair_in_order_whatever_the_path(spark, monkeypatch):
    q = [(i, i, DAY, d("-5.00"), "same") for i in range(30)]
    w = [(100 + i, i, DAY, d("5.00"), "copy") for i in range(20)]
    make = lambda: matching.match_date_amount(
        spark.createDataFrame(q, "q_id INT, q_ord BIGINT, date DATE, amount DECIMAL(18,2), description STRING"),
        spark.createDataFrame(w, "w_id INT, w_ord BIGINT, date DATE, cost DECIMAL(18,2), source STRING"),
    )
    want = [(i, 100 + i) for i in range(20)]
    assert rows(make()) == sorted(want, key=repr)
    monkeypatch.setattr(matching, "needs_spreading", lambda *_, **__: True)
    monkeypatch.setattr(matching, "CHUNK_ROWS", 4)
    assert rows(make()) == sorted(want, key=repr)


def test_double_counts_equal_sequential(spark, way):
    r = random.Random(9)
    groups = []
    for g in range(12):
        for m in range(r.randrange(1, 4)):
            groups.append((g * 10 + m, f"R{g}", DAY + dt.timedelta(days=r.randrange(12)), d(str(r.randrange(1, 4))), "Owner Distributions / S corp Distributions"))
    groups.append((999, None, DAY, d("3"), "Owner Distributions / S corp Distributions"))
    groups.append((998, "R0", DAY, None, "Owner Distributions / S corp Distributions"))
    groups.append((997, "R1", DAY, d("50"), "Water"))
    deposits = [(i, i, DAY + dt.timedelta(days=r.randrange(15)), d(f"{r.randrange(1, 8)}.{r.choice(['00', '40', '60'])}"),
                 r.choice(["ACME pm payout", "other"])) for i in range(30)]
    refs, used, want = {}, set(), []
    for o, ref, day, out, cat in sorted(groups):
        if ref is not None and cat.startswith("Owner"):
            refs.setdefault(ref, []).append((day, out))
    order = sorted(refs, key=lambda x: min(o for o, r2, *_ , c in groups if r2 == x and c.startswith("Owner")))
    for q_id, _, day, amount, text in deposits:
        if "acme pm" not in text.lower():
            continue
        for ref in order:
            total = sum((o for _, o in refs[ref] if o), d("0"))
            if ref in used or abs(amount - total) > d("0.50") or not any(abs((day - x).days) <= 5 for x, _ in refs[ref]):
                continue
            used.add(ref)
            want.append((q_id, ref))
            break
    got = matching.double_counts(
        spark.createDataFrame(deposits, "q_id INT, q_ord BIGINT, date DATE, amount DECIMAL(18,2), description STRING"),
        spark.createDataFrame(groups, "ord BIGINT, reference STRING, date DATE, cash_out DECIMAL(18,2), category STRING"),
        payer="Acme PM",
    )
    assert sorted((x.q_id, x.reference) for x in got.collect()) == sorted(want)
    assert len(want) > 3


@pytest.mark.parametrize("similarity", ["blocks"])
def test_bands_equal_sequential_and_score_less(spark, monkeypatch, similarity):
    """One date and amount with many different texts: pairs in bands, the outcome of the rule."""
    r = random.Random(3)
    names = ["alpha bakery", "Bolt hardware", "city of xyz", "DELTA air", "echo gym membership", "f", ""]
    text = lambda: r.choice(names) + r.choice(["", " ", f" {r.randrange(10 ** 5)}", f" #{r.randrange(40)} inc"])
    q = [(i, i, DAY, d(f"-5.{r.choice(['00', '30'])}"), text()) for i in range(60)]
    w = [(200 + i, i, DAY, d(f"5.{r.choice(['00', '40', '60'])}"), text()) for i in range(50)]
    lev = {}

    def edit(a, b):
        if (a, b) not in lev:
            row = list(range(len(b) + 1))
            for i, x in enumerate(a):
                row, old = [i + 1], row
                for j, y in enumerate(b):
                    row.append(min(row[-1] + 1, old[j + 1] + 1, old[j] + (x != y)))
            lev[a, b] = 1 - row[-1] / max(len(a), len(b)) if a or b else 1.0
        return lev[a, b]

    score = (lambda a, b: SequenceMatcher(None, a, b).ratio()) if similarity == "blocks" else edit
    want = sequential(q, w, lambda a, b: abs(abs(a[3]) - b[3]) <= d("0.50"), lambda a, b: score(a[4].lower(), b[4].lower()))
    scored = []
    whole = matching._scored
    monkeypatch.setattr(matching, "_scored", lambda pairs, s: scored.append(pairs.count()) or whole(pairs, s))
    got = matching.match_date_amount(
        spark.createDataFrame(q, "q_id INT, q_ord BIGINT, date DATE, amount DECIMAL(18,2), description STRING"),
        spark.createDataFrame(w, "w_id INT, w_ord BIGINT, date DATE, cost DECIMAL(18,2), source STRING"), similarity=similarity, all_pairs=50)
    assert sorted(tuple(x) for x in got.collect()) == want and len(want) > 40
    assert sum(scored) < 0.9 * len({(a[3], a[4].lower()) for a in q}) * len({(b[3], b[4].lower()) for b in w})


def test_letter_bounds_hold(spark):
    r = random.Random(8)
    make = lambda: "".join(r.choice("abcde é漢👩") for _ in range(r.randrange(12)))
    pairs = [(make(), make()) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a STRING, b STRING")
    letters = (F.length("a"), letter_counts(F.col("a")), F.length("b"), letter_counts(F.col("b")))
    for row in df.select("a", "b", blocks_bound(*letters).alias("x"), edit_bound(*letters).alias("y"), edit_similarity(F.col("a"), F.col("b")).alias("e")).collect():
        assert row.x >= SequenceMatcher(None, row.a, row.b).ratio() and row.y + 1e-9 >= row.e
    quick = df.select("a", "b", token_set_quick(F.col("a"), F.col("b"), 0.72).alias("s")).filter("s IS NOT NULL").collect()
    for row in quick:
        assert row.s == token_set_score(row.a, row.b) or row.s == 0 and token_set_score(row.a, row.b) < 0.72


def test_competing_lists_in_few_rounds(spark, monkeypatch):
    """Two kinds of rows want the same offers in the same order: the later ones pass over all that is held."""
    monkeypatch.setattr(matching, "COMPONENT_ROWS", 40)  # too few for any component, so the earliest rows are settled in several steps
    n = 60
    seekers = spark.createDataFrame([(i, i, f"q{i % 3}") for i in range(n)], "q_id INT, q_ord BIGINT, q_class STRING")
    offers = spark.createDataFrame([(1000 + i, i, f"w{i % 5}") for i in range(n)], "w_id INT, w_ord BIGINT, w_class STRING")
    pairs = [(f"q{a}", f"w{b}", 0.0) for a in range(3) for b in range(5) if (a, b) != (2, 4)]
    edges = spark.createDataFrame(pairs, "q_class STRING, w_class STRING, score DOUBLE")
    got = matching.assign_in_order(*[matching.durable(x) for x in (seekers, offers, edges)])
    want = sequential([(i, i, i % 3) for i in range(n)], [(1000 + i, i, i % 5) for i in range(n)], lambda a, b: (a[2], b[2]) != (2, 4), lambda a, b: 0)
    assert sorted((x.q_id, x.w_id) for x in got.collect()) == want


def test_exclusion_drops_every_equal_row(spark):
    schema = "id INT, date DATE, description STRING, amount DECIMAL(18,2)"
    data = spark.createDataFrame([(1, DAY, "x", d("1")), (2, DAY, "x", d("1")), (3, DAY, "y", d("1"))], schema)
    assert rows(matching.exclude_deposits(data, data.filter("id = 1")), "id") == [(3,)]


def test_zero_tolerance_means_equal_amounts(spark):
    q = [(1, 1, DAY, d("-5.00"), "a"), (2, 2, DAY, d("-5.01"), "b"), (3, 3, DAY, d("7.00"), "c")]
    w = [(11, 1, DAY, d("5.01"), "x"), (12, 2, DAY, d("5.00"), "y")]
    for tolerance in (0, 0.001):
        got = matching.match_date_amount(
            spark.createDataFrame(q, "q_id INT, q_ord BIGINT, date DATE, amount DECIMAL(18,2), description STRING"),
            spark.createDataFrame(w, "w_id INT, w_ord BIGINT, date DATE, cost DECIMAL(18,2), source STRING"), tolerance=tolerance)
        assert rows(got) == [(1, 12), (2, 11)]


def test_equal_payouts_in_one_week_are_one_class(spark):
    """n equal deposits on one day and n equal payouts: paired in order, without a round per row."""
    pm = [(i, f"R{i:02d}", DAY, d("9.00"), "Owner Distributions / S corp Distributions") for i in range(25)]
    deposits = [(i, i, DAY, d("9.00"), "acme pm") for i in range(20)]
    got = matching.double_counts(
        spark.createDataFrame(deposits, "q_id INT, q_ord BIGINT, date DATE, amount DECIMAL(18,2), description STRING"),
        spark.createDataFrame(pm, "ord BIGINT, reference STRING, date DATE, cash_out DECIMAL(18,2), category STRING"), payer="Acme PM", tolerance=0)
    assert rows(got, "q_id", "reference") == sorted([(i, f"R{i:02d}") for i in range(20)], key=repr)


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, old = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[-1] + 1, old[j + 1] + 1, old[j] + (x != y)))
    return 1 - row[-1] / max(len(a), len(b)) if a or b else 1.0


def test_bulk_edit_similarities():
    r = random.Random(9)
    texts = ["".join(r.choice("abcé👩 ") for _ in range(r.choice([0, 1, 5, 30, 63, 64, 65, 90]))) for _ in range(40)]
    bulk = EditDistances(texts)
    for a in [*texts, "zz", "z" * 70]:
        assert list(bulk.similarities(a)) == [edit(a, b) for b in texts]


def test_recurring_parts_are_compared_once():
    texts = [f"{city} *{i} {kind}" for i in range(300) for city in ("rome", "oslo") for kind in ("food", "fuel")]
    bulk = EditDistances(texts)
    assert len(bulk.heads.length) + len(bulk.tails.length) < len(texts) / 2
    assert list(bulk.similarities("fuel oslo 17")) == [edit("fuel oslo 17", b) for b in texts]


@pytest.mark.parametrize("copies", [False, True])
def test_best_pairs_equal_sequential_and_few_become_rows(spark, monkeypatch, copies):
    """A crowded date by edit similarity: a seeker's best pairs are rows, the next ones once they are not enough."""
    monkeypatch.setattr(matching, "BEST", 3)
    monkeypatch.setattr(matching, "MORE", 2)
    monkeypatch.setattr(matching, "PIECE_ROWS", 20)
    monkeypatch.setattr(matching, "BLOCK_ROWS", 15)
    r = random.Random(5)
    names = ["alpha bakery", "Bolt hardware", "city of xyz", "DELTA air", ""]
    text = lambda i: r.choice(names) + (r.choice(["", " inc"]) if copies else f" {i}")
    q = [(i, i, DAY, d(f"-5.{r.choice(['00', '30'])}"), text(i)) for i in range(60)]
    w = [(200 + i, i, DAY, d(f"5.{r.choice(['00', '40', '60'])}"), text(i)) for i in range(50)]
    want = sequential(q, w, lambda a, b: abs(abs(a[3]) - b[3]) <= d("0.50"), lambda a, b: edit(a[4].lower(), b[4].lower()))
    edges = []
    whole = matching.assign_in_order
    monkeypatch.setattr(matching, "assign_in_order", lambda q, w, e: edges.append(e.count()) or whole(q, w, e))
    got = matching.match_date_amount(
        spark.createDataFrame(q, "q_id INT, q_ord BIGINT, date DATE, amount DECIMAL(18,2), description STRING"),
        spark.createDataFrame(w, "w_id INT, w_ord BIGINT, date DATE, cost DECIMAL(18,2), source STRING"), similarity="edit", all_pairs=50)
    assert sorted(tuple(x) for x in got.collect()) == want and len(want) > 40
    assert edges[0] <= 60 * 3 or copies


def test_crowded_date_is_settled_in_steps_without_components(spark, monkeypatch):
    """All want the same offers: the earliest rows are settled for good, and only a few lists grow."""
    monkeypatch.setattr(matching, "components", lambda edges: pytest.fail("components of one date"))
    monkeypatch.setattr(matching, "STEP_ROWS", 25, raising=False)
    monkeypatch.setattr(matching, "BEST", 4)
    r = random.Random(7)
    q = [(i, i, DAY, d("-5"), f"shop {r.randrange(10 ** 4)}") for i in range(40)]
    w = [(200 + i, i, DAY, d("5"), f"shop *{i} store") for i in range(60)]
    want = sequential(q, w, lambda a, b: True, lambda a, b: edit(a[4], b[4]))
    got = matching.match_date_amount(
        spark.createDataFrame(q, "q_id INT, q_ord BIGINT, date DATE, amount DECIMAL(18,2), description STRING"),
        spark.createDataFrame(w, "w_id INT, w_ord BIGINT, date DATE, cost DECIMAL(18,2), source STRING"), similarity="edit", all_pairs=50)
    assert sorted(tuple(x) for x in got.collect()) == want and len(want) == 40


def test_recurring_texts_are_scored_once(spark, monkeypatch):
    r = random.Random(6)
    make = lambda base: [(base + i, i, DAY, d(str(i // 20)), r.choice(["acme corp", "acme cord", "blue hut"])) for i in range(200)]
    q, w = make(0), make(1000)
    tables = []
    store = matching.durable
    monkeypatch.setattr(matching, "durable", lambda df: tables.append(df) or store(df))
    schema = "{0}_id INT, {0}_ord BIGINT, date DATE, amount DECIMAL(18,2), description STRING"
    got = matching.match_fuzzy(spark.createDataFrame(q, schema.format("q")), spark.createDataFrame(w, schema.format("w")))
    want = sequential(q, w, lambda a, b: a[3] == b[3], lambda a, b: token_set_score(a[4], b[4]), least=0.72)
    assert sorted((x.q_id, x.w_id) for x in got.collect()) == want
    assert [t.count() for t in tables if "quick" in t.columns] == [9]


@pytest.mark.parametrize("bins", [50_000, 3])
def test_blocks_are_settled_without_components(spark, monkeypatch, bins):
    monkeypatch.setattr(matching, "components", lambda edges: pytest.fail("components of small blocks"))
    monkeypatch.setattr(matching, "BIN_ROWS", bins)
    q, w = ledger(30, 5), sheet(30, 6)
    want = sequential(q, w, lambda a, b: a[2] == b[2] and abs(abs(a[3]) - b[3]) <= d("0.50"), lambda a, b: EditDistances([b[4]]).similarities(a[4])[0])
    got = matching.match_date_amount(
        spark.createDataFrame(q, "q_id INT, q_ord INT, date DATE, amount DECIMAL(18,2), description STRING"),
        spark.createDataFrame(w, "w_id INT, w_ord INT, date DATE, cost DECIMAL(18,2), source STRING"), similarity="edit")
    assert rows(got, "q_id", "w_id") == sorted(want, key=repr)


def test_sums_in_reach_share_a_block(spark, monkeypatch):
    """Deposits and payouts whose sums follow each other; payouts on several days give one pair each."""
    monkeypatch.setattr(matching, "components", lambda edges: pytest.fail("components of small blocks"))
    days = lambda n: DAY + dt.timedelta(days=n)
    deposits = [(i, i, days(i % 9), d(f"{100 + i % 3 * 0.4 + i // 9 * 40:.2f}"), "from acme") for i in range(27)]
    payouts = [(i, days(i % 7), d(f"{100 + i % 3 * 0.4 + i // 9 * 40:.2f}")) for i in range(27)]
    parts = [(2 * i + k, f"{i:02}", day + dt.timedelta(days=k * (i % 4)), amount if k == 0 else d("0"), "payout") for i, day, amount in payouts for k in (0, 1)]
    want = sequential(
        [(*x[:4],) for x in deposits], [(f"{i:02}", i, day, amount) for i, day, amount in payouts],
        lambda a, b: abs(a[3] - b[3]) <= d("0.50") and any(abs((a[2] - b[2]).days - k * (int(b[0]) % 4)) <= 5 for k in (0, 1)), lambda a, b: 0)
    got = matching.double_counts(
        spark.createDataFrame(deposits, "q_id INT, q_ord INT, date DATE, amount DECIMAL(18,2), description STRING"),
        spark.createDataFrame(parts, "ord INT, reference STRING, date DATE, cash_out DECIMAL(18,2), category STRING"), payer="acme", category="payout")
    assert rows(got, "q_id", "reference") == sorted(want, key=repr)
