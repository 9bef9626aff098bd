import pytest
from pyspark.sql import functions as F

from ledgerloom import scale
from tests.helpers import rows


@pytest.fixture()
def ordered(spark):
    return spark.range(1000).select(
        (F.col("id") % 3).alias("g"), F.col("id").alias("n"), F.when(F.col("id") % 17 == 0, F.col("id")).alias("v")
    )


@pytest.mark.parametrize("inclusive", [True, False])
def test_chunked_scan_equals_window(ordered, inclusive):
    def run(spread):
        return rows(scale.running_last(ordered, ["g"], scale.chunk_of("n", 64), ["n"], {"last": F.col("v")}, spread=spread, inclusive=inclusive))

    assert run(True) == run(False)


def test_chunked_rank_equals_window(ordered):
    def run(spread):
        return rows(scale.group_rank(ordered, ["g"], scale.chunk_of("n", 64), ["n"], spread=spread))

    assert run(True) == run(False)


def test_dense_index_is_gapless_and_ordered(ordered):
    got = rows(scale.dense_index(ordered, [F.desc("g"), "n"], "i"), "i", "g", "n")
    assert [r[0] for r in sorted(got)] == list(range(1000))
    by_index = [r[1:] for r in sorted(got)]
    assert by_index == sorted(by_index, key=lambda r: (-r[0], r[1]))


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = rows(left.join(right, ["k"], how), "k", "id")
    salted = scale.join_unique(left, right, ["k"], how, max_rows=5, hot_rows=1000, salts=8)
    assert rows(salted, "k", "id") == plain
    cold = scale.join_unique(left, right, ["k"], how, max_rows=5, hot_rows=10**6)
    assert rows(cold, "k", "id") == plain
    small = scale.join_unique(left, right, ["k"], how)
    assert rows(small, "k", "id") == plain


def test_needs_spreading(ordered):
    assert scale.needs_spreading(ordered, ["g"], 300)
    assert not scale.needs_spreading(ordered, ["g"], 400)


class _Session:
    """Just enough of a session to answer configuration questions."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("C", (), {"master": master})


def test_shared_folder_comes_from_the_session():
    assert scale.shared_folder(_Session("hdfs://x/ckpt/", "yarn")) == "hdfs://x/ckpt"
    with pytest.raises(RuntimeError):
        scale.shared_folder(_Session(None, "yarn"))
    assert scale.shared_folder(_Session(None, "local[2]")).startswith("/tmp/spark-")


@pytest.mark.parametrize("edges,want", [
    ([(1, 2), (2, 3), (3, 4), (9, 8)], [(2, 1), (3, 1), (4, 1), (9, 8)]),
    ([(i, i + 1) for i in range(40)], [(i, 0) for i in range(1, 41)]),
    ([(0, i) for i in range(1, 30)] + [(5, 77)], [*((i, 0) for i in range(1, 30)), (77, 0)]),
])
def test_components(spark, edges, want):
    found = scale.components(spark.createDataFrame(edges, "a LONG, b LONG"))
    assert rows(found) == sorted(want, key=repr)


def test_long_strings_do_not_fit_a_broadcast(spark):
    few = spark.createDataFrame([("x" * 1000,)] * 5, "t STRING")
    assert scale.fits_broadcast(few) and not scale.fits_broadcast(few, max_bytes=4000) and not scale.fits_broadcast(few, max_rows=4)


def test_islands_begin_after_gaps(spark):
    numbers = spark.createDataFrame([(n,) for n in (5, 3, 4, 4, 9, -2, -1, 10, 7)], "n BIGINT")
    assert rows(scale.islands(numbers, "n"), "n", "block") == sorted(
        [(3, 3), (4, 3), (5, 3), (7, 7), (9, 9), (10, 9), (-2, -2), (-1, -2)], key=repr)
