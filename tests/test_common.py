"""Helpers: counted lineage cut, overwrite mode, order keys, exact ratios."""

from pyspark.sql import functions as F

from trainyard.operators.analysis import round_ratio
from trainyard.operators.common import cut_and_count, cut_lineage
from trainyard.operators.textmatch import text_matches
from trainyard.plans.proxies import change_rows
from trainyard.sources.tables import overwrite_mode


def test_cut_and_count(spark):
    df = spark.range(20).selectExpr("id", "id % 3 = 0 AS hit")
    out, n = cut_and_count(df, "t", "hit")
    assert n == 7 and out.count() == 20
    assert cut_lineage(df, "t").count() == 20


def test_overwrite_mode_restores(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "static")
    with overwrite_mode(spark, "dynamic"):
        assert spark.conf.get(key) == "dynamic"
    assert spark.conf.get(key) == "static"
    spark.conf.set(key, "dynamic")


def test_order_keys_of_large_tables(spark, tmp_path):
    """Order keys neither overflow nor meet where a packed number would."""
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(1)
    rows = [(2 ** 34, 1, 1), (7, 1, 2 ** 25 + 1), (7, 2, 1)]
    big = None
    for o, n, p in rows:
        r = li.withColumn("l_orderkey", F.lit(o).cast("long")) \
            .withColumn("l_linenumber", F.lit(n)) \
            .withColumn("l_partkey", F.lit(p).cast("long"))
        big = r if big is None else big.unionByName(r)
    big.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = [r.seq for r in change_rows(spark, str(tmp_path))
           .orderBy("seq").select("seq").collect()]
    assert [tuple(s)[1:] for s in got] == sorted(rows)
    assert all(s.phase == 1 for s in got)


def test_round_ratio_beyond_double_precision(spark):
    big = 2 ** 56 + 1
    row = spark.range(1).select(
        round_ratio(F.lit(big), F.lit(1).cast("long"), 0).alias("a"),
        round_ratio(F.lit(-7), F.lit(2).cast("long"), 0).alias("b")).first()
    assert row.a == float(big) and row.b == -4.0


def test_counts_come_from_the_written_rows(spark):
    """Whatever happens while a table is written, its rows are counted."""
    df = spark.range(100).repartition(7).groupBy(
        (F.col("id") % 5).alias("k")).agg(F.count("*").alias("n"))
    out, rows, big = cut_and_count(df, "t", F.lit(True), "n > 30")
    assert (rows, big) == (5, 0) == (out.count(), out.filter("n > 30").count())
    assert "CollectMetrics" not in out._jdf.queryExecution().toString()


def test_text_whose_lower_case_is_longer(spark):
    """The lower case of U+0130 is two characters."""
    names = spark.createDataFrame([("x\u0130s",), ("is",)], "name string")
    req = spark.createDataFrame([("\u0130s",), (None,)], "text string")
    got = text_matches(names, "name", req).collect()
    assert [tuple(r) for r in got] == [("\u0130s", "x\u0130s")]
