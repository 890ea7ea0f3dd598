import pytest
from pyspark.sql import functions as F

from paygrain.functions import fingerprint
from paygrain.operators import modeling

# Published fingerprints.
PUBLISHED = {"1footrue": -1541654101129638711, "2applefalse": 2794438866806483259, "3true": -4880158226897771312}


def wrapped(text: bytes) -> int:
    """The fingerprint in plain Python, for whole numbers of any size."""
    n, wrap = len(text), (1 << 64) - 1
    k0, k1, k2 = fingerprint.K0, fingerprint.K1, fingerprint.K2
    mul = k2 + 2 * n

    def at(start, count):
        return int.from_bytes(text[start : start + count], "little")

    def turn(x, bits):
        x &= wrap
        return x >> bits | x << (64 - bits) & wrap

    def fold(x):
        x &= wrap
        return x ^ x >> 47

    if n == 0:
        return k2
    if n <= 3:
        return fold((text[0] + (text[n // 2] << 8)) * k2 & wrap ^ (n + (text[-1] << 2)) * k0 & wrap) * k2 & wrap
    if n <= 7:
        u, v = n + (at(0, 4) << 3), at(n - 4, 4)
    elif n <= 16:
        a, b = at(0, 8) + k2, at(n - 8, 8)
        u, v = turn(b, 37) * mul + a, (turn(a, 25) + b) * mul
    else:
        a, b, c, d = at(0, 8) * k1, at(8, 8), at(n - 8, 8) * mul, at(n - 16, 8) * k2
        u, v = turn(a + b, 43) + turn(c, 30) + d, a + turn(b + k2, 18) + c
    v &= wrap
    return fold((v ^ fold((u & wrap ^ v) * mul)) * mul) * mul & wrap


def test_published_strings(spark):
    rows = spark.createDataFrame([(t,) for t in PUBLISHED], "t string")
    found = fingerprint.with_fingerprint(rows, "t", "h").collect()
    assert {r.t: r.h for r in found} == PUBLISHED


def test_all_lengths_and_bytes(spark):
    texts = ["", "é", "日本", "\x00\x01"] + [("9876543210zé~" * 3)[k : k + n] for n in range(1, 29) for k in range(3)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in fingerprint.with_fingerprint(rows, "t", "h").collect():
        assert r.h == fingerprint.signed(wrapped(r.t.encode())), r.t


def test_null_long_and_clashing_names(spark):
    rows = spark.createDataFrame([(None, 1, 2), ("7", 3, 4)], "t string, stepn int, step_u int")
    found = fingerprint.with_fingerprint(rows, "t", "h").orderBy("stepn").collect()
    assert [tuple(r)[:3] for r in found] == [(None, 1, 2), ("7", 3, 4)]
    assert found[0].h is None and found[1].h == fingerprint.signed(wrapped(b"7"))
    long = spark.createDataFrame([("x" * 33,)], "t string")
    with pytest.raises(Exception, match="at most 32 bytes"):
        fingerprint.with_fingerprint(long, "t", "h").collect()
    assert fingerprint.with_fingerprint(rows.limit(0), "t", "h").count() == 0


def test_sample_is_the_published_one(spark):
    ids = spark.range(1, 3000).select(F.col("id").alias("transaction_id"), F.lit("kept").alias("fingerprint"))
    found = modeling.hash_sample(ids)
    assert found.columns == ["transaction_id", "fingerprint"]
    assert {r[0] for r in found.collect()} == {i for i in range(1, 3000) if wrapped(str(i).encode()) % 4 == 0}


def test_a_filter_stays_above_the_fingerprint(spark):
    plan = modeling.hash_sample(spark.range(9).withColumnRenamed("id", "transaction_id"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert len(text) < 30_000 and text.index("Filter") < text.index("Generate")
