"""Sampling and models. Where a model has a closed form on these tables, SQL states it."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from trackfuse.learning.stages import assemble, mean_impute, one_hot, string_index
from trackfuse.learning.train import fit_model, model_report, save_model, score
from trackfuse.operators.enrich import inverse_count_weight
from trackfuse.operators.sampling import bootstrap_sample, poisson_bootstrap, poisson_steps, random_split
from trackfuse.queries.registry import query, table
from trackfuse.queries.sinks import METRICS_SQL, fixed_metrics
from trackfuse.session import new_path, stage
from trackfuse.sources.scans import load_model

LINE_SQL = """
WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope,
                    regr_intercept(l_extendedprice, l_quantity) AS base FROM lineitem)
SELECT l_orderkey, l_linenumber, round(base + slope * l_quantity, 2) AS prediction FROM lineitem CROSS JOIN fit"""


def _line(spark, sf):
    return fit_model(table(spark, sf, "lineitem"), "linear_regression", "l_extendedprice", numerical=["l_quantity"])


def _line_scores(model, spark, sf):
    scored = score(model, table(spark, sf, "lineitem"))
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 2).alias("prediction"))


@query(
    "r1_bootstrap_sample",
    """SELECT count(*) AS source, true AS size_fits, true AS has_repeats, CAST(0 AS BIGINT) AS from_elsewhere
       FROM orders""",
)
def bootstrap(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    drawn = stage(bootstrap_sample(orders), "bootstrap")
    per_key = drawn.groupBy("o_orderkey").agg(F.count("*").alias("n"))
    both = orders.join(per_key, "o_orderkey", "full")
    known = orders.withColumn("known", F.lit(1))
    both = both.join(known, "o_orderkey", "left")
    size, source = F.coalesce(F.sum("n"), F.lit(0)), F.count("known")
    return both.agg(
        source.alias("source"),
        (F.abs(size - source) <= 6 * F.sqrt(source)).alias("size_fits"),
        (F.max("n") > 1).alias("has_repeats"),
        F.count_if(F.col("known").isNull()).alias("from_elsewhere"),
    )


def _drawn_sql(source: str, values: tuple[str, ...], nth: str) -> str:
    """The draws of ``poisson_bootstrap`` in SQL: a digest of seed and values, as a number, against the Poisson steps."""
    parts = "".join(f" || coalesce('|' || CAST({v} AS VARCHAR), '-')" for v in (*values, nth))
    draw = f"CAST('0x' || substr(md5('42'{parts}), 1, 13) AS BIGINT) / CAST(16 AS DOUBLE) ** 13"
    steps = ", ".join(map(repr, poisson_steps(1.0)))
    return f"SELECT *, len(list_filter([{steps}], lambda s: u >= s)) AS times FROM (SELECT *, {draw} AS u FROM ({source}))"


_EQUAL_ROWS = """SELECT o_custkey % 40 AS k, nullif(o_orderstatus, 'P') AS status,
    row_number() OVER (PARTITION BY o_custkey % 40, nullif(o_orderstatus, 'P')) AS nth FROM orders"""


@query(
    "r1_poisson_bootstrap",
    f"""SELECT k, status, sum(times)::BIGINT AS drawn FROM ({_drawn_sql(_EQUAL_ROWS, ("k", "status"), "nth")})
        WHERE times > 0 GROUP BY k, status""",
)
def poisson(spark, sf):
    """Few different rows, each many times over; drawn from another partitioning than they are stored in."""
    status = F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status")
    rows = table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("k"), status)
    drawn = poisson_bootstrap(rows.repartition(7, F.rand(1)), part_rows=50)
    return drawn.groupBy("k", "status").agg(F.count("*").alias("drawn"))


@query(
    "r1_poisson_by_key",
    f"""SELECT o_orderkey, o_totalprice, unnest(range(times)) + 1 AS copy
        FROM ({_drawn_sql("SELECT o_orderkey, o_totalprice, 1 AS nth FROM orders", ("o_orderkey",), "nth")})""",
)
def poisson_by_key(spark, sf):
    drawn = poisson_bootstrap(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), by=["o_orderkey"])
    number = Window.partitionBy("o_orderkey").orderBy("o_totalprice")  # as many as a row's copies
    return drawn.withColumn("copy", F.row_number().over(number).cast("bigint"))


_SPLIT_SQL = "SELECT count(*) AS total, count(DISTINCT {key}) AS keys, true AS size_fits FROM {table}"


@query("r2_random_split", _SPLIT_SQL.format(key="o_orderkey", table="orders"))
def split(spark, sf):
    train, test = random_split(table(spark, sf, "orders").select("o_orderkey"))
    parts = train.withColumn("test", F.lit(0)).unionAll(test.withColumn("test", F.lit(1)))
    return parts.agg(
        F.count("*").alias("total"),
        F.count_distinct("o_orderkey").alias("keys"),
        (F.abs(F.avg("test") - 0.2) <= 6 * 0.4 / F.sqrt(F.count("*"))).alias("size_fits"),
    )


@query(
    "r2_random_split_by_entity",
    "SELECT l_orderkey, count(*) AS n, 1 AS sides FROM lineitem GROUP BY l_orderkey",
)
def split_by_entity(spark, sf):
    train, test = random_split(table(spark, sf, "lineitem").select("l_orderkey"), split_by="l_orderkey")
    parts = train.withColumn("test", F.lit(0)).unionAll(test.withColumn("test", F.lit(1)))
    sides = (F.max("test") - F.min("test") + 1).alias("sides")
    return parts.groupBy("l_orderkey").agg(F.count("*").alias("n"), sides)


_FILL = """l_orderkey, l_partkey, coalesce({q}, (SELECT avg({q}) FROM lineitem)) AS quantity,
           coalesce({n}, (SELECT CAST(trunc(avg({n})) AS INTEGER) FROM lineitem)) AS number""".format(
    q="nullif(l_quantity, 50.0)", n="nullif(l_linenumber, 1)"
)


def _gaps(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.nullif(F.col("l_quantity"), F.lit(50.0)).alias("quantity"),
        F.nullif(F.col("l_linenumber"), F.lit(1)).alias("number"),
    )


@query("m1_mean_impute", f"SELECT l_orderkey, l_partkey, round(quantity, 6) AS quantity, number FROM (SELECT {_FILL} FROM lineitem)")
def imputed(spark, sf):
    gaps = _gaps(spark, sf)
    filled = mean_impute(["quantity", "number"]).fit(gaps).transform(gaps)
    return filled.withColumn("quantity", F.round("quantity", 6))


@query(
    "m1_mean_impute_keep_raw",
    f"""SELECT l_orderkey, l_partkey, round(f.quantity, 6) AS quantity_filled, f.raw AS quantity FROM
        (SELECT nullif(l_quantity, 50.0) AS raw, {_FILL} FROM lineitem) f""",
)
def imputed_beside(spark, sf):
    gaps = _gaps(spark, sf).drop("number")
    filled = mean_impute(["quantity"], keep_raw=True).fit(gaps).transform(gaps)
    return filled.withColumn("quantity_filled", F.round("quantity_filled", 6))


_INDEX_SQL = """
WITH labels AS (SELECT nullif(p_type, 'PROMO') AS label, count(*) AS n FROM part GROUP BY 1),
     ranked AS (SELECT label, row_number() OVER (ORDER BY n DESC, label) - 1 AS idx FROM labels WHERE label IS NOT NULL)
SELECT p_partkey, nullif(p_type, 'PROMO') AS kind, coalesce(idx, (SELECT count(*) FROM ranked)) AS idx
FROM part LEFT JOIN ranked ON nullif(p_type, 'PROMO') = label"""


def _kinds(spark, sf):
    kind = F.nullif(F.col("p_type"), F.lit("PROMO")).alias("kind")
    return table(spark, sf, "part").select("p_partkey", kind, "p_size")


@query("m2_string_index", f"SELECT p_partkey, kind, CAST(idx AS DOUBLE) AS kind_idx FROM ({_INDEX_SQL})")
def indexed(spark, sf):
    kinds = _kinds(spark, sf).drop("p_size")
    return string_index(["kind"]).fit(kinds).transform(kinds)


@query(
    "m3_one_hot",
    f"""WITH i AS ({_INDEX_SQL}), k AS (SELECT count(DISTINCT kind) AS n FROM i)
        SELECT p_partkey, CAST(n AS INTEGER) AS width, CASE WHEN idx < n THEN CAST(idx AS INTEGER) ELSE -1 END AS hot
        FROM i CROSS JOIN k""",
)
def encoded(spark, sf):
    kinds = _kinds(spark, sf)
    stages = Pipeline(stages=[string_index(["kind"]), one_hot(["kind"])])
    bits = vector_to_array("kind_vec")
    return (
        stages.fit(kinds)
        .transform(kinds)
        .select(
            "p_partkey",
            F.size(bits).alias("width"),
            (F.array_position(bits, 1.0) - 1).cast("int").alias("hot"),
        )
    )


@query(
    "m4_assemble",
    f"SELECT p_partkey, CAST(idx AS DOUBLE) AS first, CAST(p_size AS DOUBLE) AS second FROM ({_INDEX_SQL}) JOIN part USING (p_partkey)",
)
def assembled(spark, sf):
    kinds = _kinds(spark, sf)
    rows = Pipeline(stages=[string_index(["kind"]), assemble(["kind_idx", "p_size"])]).fit(kinds).transform(kinds)
    values = vector_to_array("features")
    return rows.select("p_partkey", values[0].alias("first"), values[1].alias("second"))


@query(
    "m5_linear_regression",
    """WITH w AS (SELECT l_quantity AS x, l_extendedprice AS y, 1.0 / count(*) OVER (PARTITION BY l_orderkey) AS w
                  FROM lineitem),
            s AS (SELECT sum(w) AS w, sum(w * x) AS x, sum(w * y) AS y, sum(w * x * y) AS xy, sum(w * x * x) AS xx FROM w),
            f AS (SELECT (w * xy - x * y) / (w * xx - x * x) AS slope, s.* FROM s)
       SELECT DISTINCT l_quantity, round((f.y - slope * f.x) / f.w + slope * l_quantity, 2) AS prediction
       FROM lineitem CROSS JOIN f""",
)
def weighted_line(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    weighted = stage(inverse_count_weight(lines, "l_orderkey"), "weighted")
    model = fit_model(weighted, "linear_regression", "l_extendedprice", numerical=["l_quantity"], weight="sample_weight")
    scored = score(model, weighted.select("l_quantity").distinct())
    return scored.withColumn("prediction", F.round("prediction", 2))


# Orders with a weight; the label is unknown for status P.
_WEIGHTED = """w AS (SELECT o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS y,
                       1.0 / count(*) OVER (PARTITION BY o_custkey) AS w FROM orders)"""

# A tree with one category and enough depth ends in one leaf per category: its weighted mean label.
_GROUP_SQL = f"""WITH {_WEIGHTED}
                SELECT o_orderpriority, count(*) AS n,
                       round(sum(w * y) / sum(CASE WHEN y IS NOT NULL THEN w END), 2) AS prediction
                FROM w GROUP BY o_orderpriority"""


def _labelled_orders(spark, sf):
    label = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("label")
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", label)


def _weighted_orders(spark, sf):
    return stage(inverse_count_weight(_labelled_orders(spark, sf), "o_custkey"), "weighted")


def _group_scores(scored):
    return scored.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.avg("prediction"), 2).alias("prediction")
    )


@query("m6_tree_regression", _GROUP_SQL)
def tree_means(spark, sf):
    orders = _weighted_orders(spark, sf)
    model = fit_model(orders, "decision_tree_regression", "label", ["o_orderpriority"], weight="sample_weight")
    return _group_scores(score(model, orders))


def _stump_sql(group: str, target: str, out: str) -> str:
    """The best split of the categories, in the order of their means, into two; the mean of each side."""
    return f"""
    {out}_cut AS (SELECT o_orderpriority, {target} AS t, w,
        sum(w) OVER below AS wl, sum(w * {target}) OVER below AS sl, sum(w) OVER () AS wt, sum(w * {target}) OVER () AS st
        FROM {group} WINDOW below AS (ORDER BY {target} ROWS UNBOUNDED PRECEDING)),
    {out}_best AS (SELECT t AS edge, sl / wl AS low, (st - sl) / (wt - wl) AS high FROM {out}_cut WHERE wt - wl > 1e-9
        ORDER BY sl * sl / wl + (st - sl) * (st - sl) / (wt - wl) DESC LIMIT 1),
    {out} AS (SELECT o_orderpriority, g.w, g.m, g.f + {{step}} * CASE WHEN {target} <= edge THEN low ELSE high END AS f
        FROM {group} g CROSS JOIN {out}_best)"""


# Two rounds of boosted stumps on squared error, as the library does it: the first tree counts whole, the second
# is fitted on twice the residuals and counts 0.3.
_BOOSTED_SQL = f"""WITH {_WEIGHTED},
    g0 AS (SELECT o_orderpriority, sum(w) AS w, sum(w * y) / sum(w) AS m, 0.0 AS f FROM w WHERE y IS NOT NULL GROUP BY 1),
    {_stump_sql("g0", "m", "g1").format(step="1.0")},
    {_stump_sql("g1", "2 * (m - f)", "g2").format(step="0.3")}"""


def _boosted_orders(orders):
    rounds = {"maxDepth": 1, "maxIter": 2, "stepSize": 0.3}
    return fit_model(
        orders, "boosted_regression", "label", ["o_orderpriority"], weight="sample_weight", **rounds
    )


@query(
    "m7_boosted_regression",
    f"""{_BOOSTED_SQL} SELECT o_orderpriority, (SELECT count(*) FROM orders o WHERE o.o_orderpriority = g2.o_orderpriority) AS n,
        round(f, 2) AS prediction FROM g2""",
)
def boosted_means(spark, sf):
    orders = _weighted_orders(spark, sf)
    return _group_scores(score(_boosted_orders(orders), orders))


@query(
    "m8_forest_regression",
    "SELECT o_orderpriority, count(*) AS n, true AS in_range FROM orders GROUP BY o_orderpriority",
)
def forest_range(spark, sf):
    orders = _labelled_orders(spark, sf)
    scored = score(fit_model(orders, "forest_regression", "label", ["o_orderpriority"]), orders)
    # A mean of bootstrapped means: within the noise of the group's own mean.
    near = F.abs(F.avg("label") - F.avg("prediction")) <= 6 * F.stddev("label") / F.sqrt(F.count("label"))
    return scored.groupBy("o_orderpriority").agg(F.count("*").alias("n"), near.alias("in_range"))


@query(
    "m9_fit_model",
    """SELECT count(*) AS n, CAST(0 AS DOUBLE) AS miss, CAST(0 AS DOUBLE) AS miss_by_quantity,
              CAST(0 AS DOUBLE) AS miss_by_first FROM lineitem""",
)
def normal_equations(spark, sf):
    # Least squares leaves residuals that are orthogonal to every input.
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_returnflag", "l_extendedprice")
    model = fit_model(
        lines, "linear_regression", "l_extendedprice", ["l_returnflag"], ["l_quantity", "l_discount"], tol=1e-9
    )
    miss = F.col("l_extendedprice") - F.col("prediction")
    first = F.when(F.col("l_returnflag") == "A", miss).otherwise(0.0)

    def mean(value):
        return F.round(F.avg(value), 1) + 0.0

    return score(model, lines).agg(
        F.count("*").alias("n"),
        mean(miss).alias("miss"),
        mean(miss * F.col("l_quantity")).alias("miss_by_quantity"),
        mean(first).alias("miss_by_first"),
    )


@query("m10_evaluate", METRICS_SQL)
def evaluated(spark, sf):
    return fixed_metrics(spark, sf)


_REPORT_SQL = """SELECT '{name}' AS "Model", round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)), 6) AS "R2",
         round(sqrt(avg(pow(y - p, 2))), 2) AS "RMSE", 'now' AS "Timestamp" FROM {rows}"""


@query(
    "m11_model_report",
    f"""{_BOOSTED_SQL}, t AS (SELECT y, m AS p FROM w JOIN g0 USING (o_orderpriority) WHERE y IS NOT NULL),
        b AS (SELECT y, f AS p FROM w JOIN g2 USING (o_orderpriority) WHERE y IS NOT NULL)
        {_REPORT_SQL.format(name="DecisionTreeRegression", rows="t")}
        UNION ALL {_REPORT_SQL.format(name="BoostedRegression", rows="b")}""",
)
def report(spark, sf):
    orders = _weighted_orders(spark, sf)
    tree = fit_model(orders, "decision_tree_regression", "label", ["o_orderpriority"], weight="sample_weight")
    models = {"decision_tree_regression": tree, "boosted_regression": _boosted_orders(orders)}
    rows = model_report({kind: score(model, orders) for kind, model in models.items()}, "label", "now")
    return rows.withColumn("R2", F.round("R2", 6)).withColumn("RMSE", F.round("RMSE", 2))


@query("m12_batch_score", LINE_SQL)
def batch_scores(spark, sf):
    return _line_scores(_line(spark, sf), spark, sf)


@query("s11_load_model", LINE_SQL)
def loaded(spark, sf):
    path = save_model(_line(spark, sf), new_path(spark, "s11"), "linear_regression")
    return _line_scores(load_model(path), spark, sf)


# The parts are an id of many values. Its mean price, mixed with ten rows of the overall mean, is the one feature.
@query(
    "m2_target_means",
    """WITH a AS (SELECT avg(l_extendedprice) AS m FROM lineitem),
            p AS (SELECT l_partkey, (sum(l_extendedprice) + 10 * any_value(m)) / (count(*) + 10) AS x FROM lineitem, a GROUP BY l_partkey),
            f AS (SELECT regr_slope(l_extendedprice, x) AS slope, regr_intercept(l_extendedprice, x) AS base FROM lineitem JOIN p USING (l_partkey))
       SELECT l_orderkey, l_linenumber, round(base + slope * x, 2) AS prediction FROM lineitem JOIN p USING (l_partkey), f""",
)
def target_encoded(spark, sf):
    lines = table(spark, sf, "lineitem")
    model = fit_model(lines, "linear_regression", "l_extendedprice", averaged=["l_partkey"])
    return _line_scores(model, spark, sf)


@query("m2_hashed", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS off, true AS spread FROM lineitem")
def hash_encoded(spark, sf):
    """A linear model without intercept on hashed parts: each place's score must be the mean price of its rows."""
    lines = table(spark, sf, "lineitem")
    how = {"hashed": ["l_partkey"], "hash_size": 512, "fitIntercept": False}
    model = fit_model(lines, "linear_regression", "l_extendedprice", **how)
    scored = model.transform(lines.select("l_partkey", "l_extendedprice"))
    place = vector_to_array("hashed_vec")
    scored = scored.withColumn("place", F.array_position(place, F.lit(1.0)))
    means = scored.groupBy("place").agg(
        F.count("*").alias("n"), F.avg("l_extendedprice").alias("mean"), F.min("prediction").alias("low"),
        F.max("prediction").alias("high"), F.count_distinct("l_partkey").alias("parts"),
    )
    off = F.greatest(F.abs(F.col("low") - F.col("mean")), F.abs(F.col("high") - F.col("mean"))) > 0.01
    spread = F.count("*") > F.least(F.lit(512), F.sum("parts")) / 2
    return means.agg(F.sum("n").alias("rows"), F.count_if(off).alias("off"), spread.alias("spread"))
