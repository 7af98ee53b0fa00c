"""Relations over the check tables: the lines are sorted once, the edges of a search are derived once."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.adapter import Driver
from freightloom.operators import graph

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def test_lines_are_sorted_once(spark, tmp_path):
    def line(order, part, number, day):
        return (order, part, 3, number, 5.0, 1.0, 0.0, 0.0, "N", "O", day and datetime(2024, 1, day))

    rows = [line(1, 7, 1, 2), line(1, 8, 1, 1), line(1, 9, 2, 3), line(None, 4, 1, 5), line(None, 5, 1, 4), line(2, 6, None, 1)]
    spark.createDataFrame(rows, LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    d = Driver(spark, str(tmp_path))
    first = {(r.l_orderkey, r.hop, r.l_partkey) for r in d["l1"].collect()}
    assert first == {(1, 1, 8), (1, 2, 9), (None, 1, 5), (2, None, 6)}
    assert [(r.batch_id, r.product_id, r.quantity) for r in d["batches"].orderBy("batch_id").collect()] == [(1, 8, 10), (2, 6, 5)]
    for name in ("node_processings", "transport_completions", "order_items", "batches"):
        assert "Window" not in d[name]._jdf.queryExecution().toString(), name


def test_edges_of_a_search_are_derived_once(spark):
    derived = spark.sparkContext.accumulator(0)

    def count(x):
        derived.add(1)
        return x

    pairs = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(6)], "src string, dst string")
    seen = F.udf(count).asNondeterministic()
    edges = pairs.select(
        F.lit("L").alias("type"), seen("src").alias("src"), "dst", F.create_map(F.lit("m"), F.lit("x"), F.lit("w"), F.lit("1")).alias("properties")
    )
    assert graph.shortest_path(edges, "n0", "n6", "L", "w", "m").first().hops == 6
    assert derived.value <= 12  # a checkpoint may derive its rows twice


def test_tasks_sort_in_memory(spark):
    """A session that somebody else built gets splits and partitions of bounded size; Spark's own defaults made tasks of gigabytes."""
    from freightloom.session import configure

    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sizes = configure(spark)._jsparkSession.sessionState().conf()
    assert sizes.filesMaxPartitionBytes() <= 32 << 20
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").rstrip("m")) <= 16
