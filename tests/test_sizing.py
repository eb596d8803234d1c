"""Broadcast bounds and the measured-broadcast helper."""

from quarry.plans import sizing


def test_byte_sizes():
    assert sizing._bytes("1g") == 1 << 30
    assert sizing._bytes("512m") == 512 << 20
    assert sizing._bytes("16G") == 16 << 30
    assert sizing._bytes("2048") == 2048


def test_bound_follows_driver_memory(spark):
    # the test session has a 16 GB driver: the cap applies
    assert sizing.broadcast_rows(spark) == sizing.DEFAULT_BROADCAST_ROWS
    assert sizing.broadcast_rows(spark, cap=1000) == 1000
    assert sizing.broadcast_bytes(spark) == sizing.DEFAULT_BROADCAST_BYTES


def test_measure_decides_on_the_count(spark):
    df = spark.range(10)
    small = sizing.measure(df, max_rows=10)
    big = sizing.measure(df, max_rows=9)
    assert (small.rows, small.broadcast) == (10, True)
    assert (big.rows, big.broadcast) == (10, False)
    small.df.unpersist()


def test_measure_counts_bytes(spark):
    """Few rows of long texts are over the byte bound; the same number of short ones is not."""
    long = spark.createDataFrame([("x" * 10_000, 1)] * 3, "t string, n int")
    assert sizing.measure(long, max_bytes=30_000).broadcast is False
    sized = sizing.measure(long, max_bytes=31_000)
    assert sized.broadcast and 30_000 < sized.bytes <= 31_000
    assert sizing.measure(spark.createDataFrame([("é", None)] * 3, "t string, n int"), max_bytes=1000).bytes == 3 * (2 + 32)
    assert sizing.measure(long.limit(0)).bytes == 0


def synonym_rows(spark):
    toks = spark.createDataFrame([(q, p, "hot") for q in range(4) for p in range(50)] + [(9, 0, "Cold"), (9, 1, "none")], "query_id long, pos int, tok string")
    table = spark.createDataFrame([("hot", 0, 1, "warm"), ("cold", 0, 1, "cool"), ("other", 0, 1, "x"), ("hot", 1, 1, "y")],
                                  "word string, sense_rank int, lemma_rank int, lemma string")
    return toks, table


def test_synonyms_on_both_sides_of_the_bound(spark):
    from quarry.operators.search import expand_synonyms
    from test_plans import plan
    toks, table = synonym_rows(spark)
    within, beyond = expand_synonyms(toks, table), expand_synonyms(toks, table, max_rows=1)
    assert "__salt" not in plan(within) and "__salt" in plan(beyond)
    assert sorted(within.collect()) == sorted(beyond.collect())
    assert within.where("tok in ('warm', 'cool')").count() == 201
