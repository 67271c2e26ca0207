from conftest import rows

from staymark.operators.reconcile import differences, differences_by_digest, differing_buckets, match_summary

SCHEMA = "k string, d date, a int, b double"
SAME = [("x", None, 1, 1.0), (None, None, None, None), ("nan", None, 1, float("nan"))]


def test_differences(spark):
    left = spark.createDataFrame(
        [*SAME, ("changed", None, 1, 1.0), ("null", None, None, 2.0), ("gone", None, 1, 1.0),
         ("twice", None, 1, 1.0), ("twice", None, 1, 1.0)], SCHEMA
    )
    right = spark.createDataFrame(
        [*SAME, ("changed", None, 2, 3.0), ("null", None, 1, 2.0), ("new", None, 1, 1.0),
         ("twice", None, 1, 1.0)], SCHEMA
    )
    found = differences(left, right, ["k", "d"], ["a", "b"])
    assert rows(found, "k", "presence", "differing") == {
        ("changed", "both", "a,b"),
        ("null", "both", "a"),
        ("gone", "left_only", ""),
        ("new", "right_only", ""),
        ("twice", "repeated_key", ""),
    }
    changed = found.where("k = 'changed'").first()
    assert (changed["left_a"], changed["right_a"], changed["right_b"]) == (1, 2, 3.0)
    summary = match_summary(left, right, ["k", "d"], ["a", "b"]).first()
    assert tuple(summary) == (8, 7, 3, 5, False)


def test_equal_and_empty(spark):
    left = spark.createDataFrame(SAME, SCHEMA)
    assert differences(left, left, ["k"], ["a", "b"]).isEmpty()
    assert tuple(match_summary(left, left, ["k"], ["a"]).first()) == (3, 3, 3, 0, True)
    nothing = left.limit(0)
    assert tuple(match_summary(nothing, nothing, ["k"], ["a"]).first()) == (0, 0, 0, 0, True)
    assert tuple(match_summary(left, nothing, ["k"], ["a"]).first()) == (3, 0, 0, 3, False)


def test_digests_name_the_buckets_that_differ(spark):
    data = [(f"k{n}", None, n % 7 or None, float(n)) for n in range(300)]
    left = spark.createDataFrame(data, SCHEMA).repartition(5)
    changed = [
        ("k3", None, 4, 3.0), ("k7", None, 5, 7.0), (None, None, None, None),
        *[r for r in data if r[0] not in ("k3", "k7", "k11")],
    ]
    right = spark.createDataFrame(changed, SCHEMA).repartition(2)
    for buckets in (1, 16, 4096):
        found = differences_by_digest(left, right, ["k", "d"], ["a", "b"], buckets)
        assert rows(found) == rows(differences(left, right, ["k", "d"], ["a", "b"]))
        assert len(differing_buckets(left, right, ["k", "d"], ["a", "b"], buckets)) <= 4
    same = spark.createDataFrame(data[::-1], SCHEMA).repartition(3)
    assert differing_buckets(left, same, ["k", "d"], ["a", "b"]) == []
    assert differences_by_digest(left, same, ["k", "d"], ["a", "b"]).isEmpty()
    none = left.limit(0)
    assert rows(differences_by_digest(left, none, ["k", "d"], ["a"], 8), "presence", "k") == {
        ("left_only", r[0]) for r in data
    }


def test_digests_see_values_change_places_and_copies(spark):
    """NULLs are skipped by hashes, and equal rows could cancel out."""
    one = spark.createDataFrame([("k", None, 1, None), ("c", None, 2, 2.0)], "k string, a int, b int, c double")
    two = spark.createDataFrame([("k", 1, None, None), ("c", None, 2, 2.0)], "k string, a int, b int, c double")
    assert len(differing_buckets(one, two, ["k"], ["a", "b", "c"], 64)) == 1
    twice = one.unionByName(one)
    assert len(differing_buckets(one, twice, ["k"], ["a", "b"], 1 << 20)) == 2
