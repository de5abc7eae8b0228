from access_spark.operators.settlements import smallest_reachable


def test_path_that_ends_in_two_stars(spark):
    """After one round 3 and 5 hang on nodes that hang on none, but one of them on two."""
    links = spark.createDataFrame([("X", 5, 1), ("X", 5, 4), ("X", 4, 3), ("X", 3, 2)], "iso string, a long, b long")
    out = {(r.node, r.root) for r in smallest_reachable(links).collect()}
    assert {(i, 1) for i in range(2, 6)} == out
