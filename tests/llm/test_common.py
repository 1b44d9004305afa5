from pyspark.sql import functions as F

from quernel.llm import common


def test_split_join(spark, monkeypatch):
    """Rows with their group's values, whichever way the join goes; nulls are a key like any other."""
    keys = [("a", 1)] * 3000 + [("b", None)] * 5 + [(None, None)] * 4 + [("c", 2)] * 3
    rows = spark.createDataFrame([(i, k, j) for i, (k, j) in enumerate(keys)], "i long, k string, j int")
    groups = common.stash(spark.createDataFrame([("a", 1, 3000, "A"), ("b", None, 5, "B"), (None, None, 4, "N"), ("z", 9, 0, "Z")], "k string, j int, n long, v string"), "groups")
    want = {i: {("a", 1): "A", ("b", None): "B", (None, None): "N"}.get(x) for i, x in enumerate(keys)}
    for most in (common.BROADCAST_ROWS, 0):
        monkeypatch.setattr(common, "BROADCAST_ROWS", most)
        got = common.split_join(rows, groups, ["k", "j"])
        assert sorted(got.columns) == ["i", "j", "k", "v"] and {r["i"]: r["v"] for r in got.collect()} == want
        assert got.count() == len(keys)


def test_free_names_and_text_keys(spark):
    df = spark.createDataFrame([("x",), (None,), ("",)], "_key string").withColumn("_KEY_", F.lit(1))
    assert common.free_name(df, "_key") == "_key__" and common.free_name(df, "other") == "other"
    assert [r[0] for r in df.select(F.count_distinct(common.text_key(F.col("_key")))).collect()] == [2]


def test_a_folder_is_needed_on_a_cluster(spark):
    import pytest

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        common.shared_dir(Session())
