"""Sinks: each query reads back what it wrote."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from trackfuse.learning.stages import assemble, linear
from trackfuse.learning.train import evaluate, run_stamp, save_model
from trackfuse.operators.enrich import key_average
from trackfuse.queries.registry import ONCE, query, stream, table
from trackfuse.session import new_name, new_path, stage
from trackfuse.sources.decode import decode_flat_json
from trackfuse.sources.scans import load_model
from trackfuse.streaming.sinks import (
    append_files,
    append_stream,
    console_sink,
    ensure_tables,
    fan_out,
    finish,
    key_value_json,
    message_sink,
    metrics_json,
    multi_sink,
    overwrite_table,
    remove_versions,
)


@query("k1_append_stream", "SELECT * FROM orders")
def append(spark, sf):
    name = new_name("k1")
    query = append_stream(
        stream(spark, sf, "orders"),
        name,
        new_path(spark, "k1_checkpoint"),
        path=new_path(spark, "k1"),
        trigger=ONCE,
    )
    finish(query)
    return spark.table(name)


@query(
    "k2_overwrite_table",
    "SELECT o_orderpriority, round(avg(o_totalprice), 3) AS mean FROM orders GROUP BY o_orderpriority",
)
def overwrite(spark, sf):
    name, path, orders = new_name("k2"), new_path(spark, "k2"), table(spark, sf, "orders")
    for key in ("o_orderstatus", "o_orderpriority"):
        means = key_average(orders, key, "o_totalprice", "mean").withColumn("mean", F.round("mean", 3))
        overwrite_table(means, name, path=path)
    return spark.table(name)


@query(
    "k2_overwrite_partitioned",
    """SELECT 'after' AS seen, o_orderkey, o_totalprice, o_orderpriority AS part FROM orders WHERE o_orderpriority <> '5-LOW'
       UNION ALL SELECT 'before', o_orderkey, o_totalprice, nullif(o_orderstatus, 'P') FROM orders""",
)
def overwrite_partitioned(spark, sf):
    """A partitioned table is replaced by one with other partitions while somebody reads it; then old versions go."""
    base, root, orders = new_name("k2"), new_path(spark, "k2"), table(spark, sf, "orders")
    name = f"{base}.orders"
    columns = ("o_orderkey", "o_totalprice")
    first = orders.select(*columns, F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("part"))
    ensure_tables(spark, {name: first.schema}, root=root, partition_by={name: ["part"]})
    first.write.insertInto(name)
    overwrite_table(first, name, path=f"{root}/orders")
    reader = spark.table(name).select(F.lit("before").alias("seen"), "*")
    before = reader.inputFiles()  # the reader has begun: it knows its files
    second = orders.filter("o_orderpriority <> '5-LOW'").select(*columns, F.col("o_orderpriority").alias("part"))
    overwrite_table(second, name, path=f"{root}/orders")
    seen = stage(reader, "before")
    assert remove_versions(spark, name, keep=0) and before
    after = spark.table(name).select(F.lit("after").alias("seen"), "*")
    return after.unionAll(seen)


_MESSAGE_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS key,
       '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || CASE WHEN o_orderstatus <> 'P'
       THEN ',"status":"' || o_orderstatus || '"' ELSE '' END || '}' AS value FROM orders"""


def _messages(orders):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status")
    return key_value_json(orders.select("o_orderkey", "o_custkey", status), "o_orderkey")


@query("k3_key_value_json", _MESSAGE_SQL)
def key_values(spark, sf):
    return _messages(table(spark, sf, "orders"))


@query("k4_message_sink", _MESSAGE_SQL)
def messages(spark, sf):
    path = new_path(spark, "k4")
    sent = message_sink(
        _messages(stream(spark, sf, "orders")), {"path": path}, new_path(spark, "k4_checkpoint"), "json", ONCE
    )
    finish(sent)
    return spark.read.schema("key string, value string").json(path)


_BOTH_SQL = """SELECT 'rows' AS sink, o_orderkey, o_totalprice FROM orders
               UNION ALL SELECT 'keys', o_orderkey, NULL FROM orders"""


def _both(spark, rows, keys):
    rows = rows.select(F.lit("rows").alias("sink"), "o_orderkey", "o_totalprice")
    return rows.unionByName(keys.select(F.lit("keys").alias("sink"), "o_orderkey"), allowMissingColumns=True)


@query("k5_multi_sink", _BOTH_SQL)
def several(spark, sf):
    orders = stream(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    rows, keys = new_path(spark, "k5_rows"), new_path(spark, "k5_keys")
    queries = multi_sink(
        orders,
        [
            lambda df: append_files(df, rows, new_path(spark, "k5_checkpoint"), trigger=ONCE),
            lambda df: append_files(df.select("o_orderkey"), keys, new_path(spark, "k5_checkpoint"), trigger=ONCE),
        ],
    )
    finish(*queries)
    return _both(spark, spark.read.parquet(rows), spark.read.parquet(keys))


@query("k5_fan_out", _BOTH_SQL)
def once_for_several(spark, sf):
    orders = stream(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    paths = {"rows": new_path(spark, "k5_rows"), "keys": new_path(spark, "k5_keys")}
    shapes = {"rows": lambda df: df, "keys": lambda df: df.select("o_orderkey")}
    finish(fan_out(orders, paths, shapes, new_path(spark, "k5_checkpoint"), ONCE))
    return _both(spark, *(spark.read.parquet(p) for p in paths.values()))


#: Rows of each batch that the console shows.
SHOWN = 20


@query("k6_console_sink", "SELECT o_orderkey, o_orderstatus FROM orders")
def console(spark, sf):
    """The orders, if the sink saw each of them once and showed its few rows of every batch as they are in the table."""
    orders = stream(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    shown, counts = [], new_path(spark, "k6_counts")
    finish(console_sink(orders, new_path(spark, "k6_checkpoint"), SHOWN, ONCE, shown.append, counts))
    lines = spark.createDataFrame([(line,) for line in shown if not line.startswith("batch ")], "value string")
    stored = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    lines = decode_flat_json(lines, orders.schema).select(F.struct("*").alias("line"))  # SHOWN a batch at most
    same = F.struct(*stored.columns).eqNullSafe(F.col("line"))
    hits = stored.join(F.broadcast(lines), same, "left_semi").distinct()  # as few
    found = lines.join(F.broadcast(hits), same, "left_semi").agg(F.count("*").alias("found"))
    seen = spark.read.schema("n bigint").parquet(counts).agg(
        F.sum("n").alias("seen"), F.sum(F.least("n", F.lit(SHOWN))).alias("wanted")
    )
    evidence = seen.crossJoin(found).crossJoin(stored.agg(F.count("*").alias("stored")))  # one row
    ok = evidence.filter((F.col("seen") == F.col("stored")) & (F.col("found") == F.col("wanted")))
    return stored.crossJoin(F.broadcast(ok.select()))


# R2 and RMSE of "price = 1500 * quantity" over all lineitems.
METRICS_SQL = """
SELECT 'Fixed' AS "Model", round(1 - sum(pow(l_extendedprice - 1500 * l_quantity, 2)) / (var_pop(l_extendedprice) * count(*)), 6)
       AS "R2", round(sqrt(avg(pow(l_extendedprice - 1500 * l_quantity, 2))), 2) AS "RMSE" FROM lineitem"""


def fixed_metrics(spark, sf):
    scored = table(spark, sf, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 1500).alias("prediction")
    )
    return evaluate(scored, "l_extendedprice").select(
        F.lit("Fixed").alias("Model"), F.round("R2", 6).alias("R2"), F.round("RMSE", 2).alias("RMSE")
    )


@query("k7_metrics_json", METRICS_SQL)
def metrics(spark, sf):
    path = new_path(spark, "k7")
    metrics_json(fixed_metrics(spark, sf), path)
    return spark.read.schema("Model string, R2 double, RMSE double").json(path)


@query("k8_save_model", "SELECT count(*) AS scored, CAST(0 AS BIGINT) AS changed, true AS named FROM lineitem")
def saved_model(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    model = Pipeline(stages=[assemble(["l_quantity"]), linear("l_extendedprice")]).fit(lines)
    stamp = run_stamp()
    path = save_model(model, new_path(spark, "k8"), "linear_regression", stamp)
    again = load_model(path).transform(model.transform(lines).drop("features").withColumnRenamed("prediction", "before"))
    return again.agg(
        F.count("*").alias("scored"),
        F.count_if(F.col("before") != F.col("prediction")).alias("changed"),
        F.first(F.lit(path.endswith(f"/linear_regression_{stamp}"))).alias("named"),
    )


@query("k9_ensure_tables", "SELECT * FROM orders")
def ensured(spark, sf):
    orders = table(spark, sf, "orders")
    name, root = f"{new_name('k9')}.orders", new_path(spark, "k9")
    for _ in range(2):
        ensure_tables(spark, {name: orders.schema}, root=root)
    orders.write.insertInto(name)
    return spark.table(name)
