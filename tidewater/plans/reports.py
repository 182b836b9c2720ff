"""Business reports (B1-B9) on the star schema.

Money is summed as exact decimals (cast to double at the end), so totals do not depend
on the order rows arrive in. Line items are aggregated per order before they meet the
order, customer and geography dimensions: every later join is 1:1 on a small side, and
a hot key is partially aggregated before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import series as SE
from ..operators import windows as W
from ..operators.ordering import top_k_per_group
from ..operators.selection import add_ntiles
from ..session import cut_lineage
from ..sources.tables import Tables

# Order priorities, the heatmap's columns.
ORDER_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _dec(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def line_values(t: Tables) -> DataFrame:
    """Per line: revenue = price * (1 - discount), cost = retail price * quantity (exact decimals)."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                           "l_returnflag")
    part = t.part.select("p_partkey", "p_type", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return j.select(
        "l_orderkey", "l_partkey", "l_suppkey", "p_type", "l_quantity", "l_returnflag",
        (_dec("l_extendedprice") * (F.lit(1).cast("decimal(18,2)") - _dec("l_discount"))).alias("revenue"),
        (_dec("p_retailprice") * _dec("l_quantity")).alias("cost"),
    )


def line_revenue(t: Tables) -> DataFrame:
    """Per line: revenue = price * (1 - discount) as an exact decimal; reads line items only."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                           "l_returnflag")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
                     (_dec("l_extendedprice") * (F.lit(1).cast("decimal(18,2)") - _dec("l_discount"))).alias("revenue"))


def geography(t: Tables) -> DataFrame:
    """nation -> region names; 25 rows at any scale, so broadcast."""
    n, r = t.nation, t.region
    return F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name"))


def _order_customer_region(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    c = t.customer.select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").join(geography(t), F.col("c_nationkey") == F.col("n_nationkey"))


def sales_by_region(t: Tables) -> DataFrame:
    """B1: sales and profit by region, highest sales first."""
    per_order = line_values(t).groupBy("l_orderkey").agg(F.sum("revenue").alias("rev"), F.sum("cost").alias("cost"))
    j = per_order.join(_order_customer_region(t).select("o_orderkey", "r_name"),
                       F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("r_name").agg(
        F.sum("rev").cast("double").alias("total_sales"),
        (F.sum("rev") - F.sum("cost")).cast("double").alias("total_profit"),
    ).orderBy(F.desc("total_sales"))


def kpis(t: Tables) -> DataFrame:
    """B2: headline KPIs as (kpi, value) rows from two aggregate passes."""
    lv = line_values(t).agg(
        F.sum("revenue").cast("double").alias("total_revenue"),
        (F.sum("revenue") - F.sum("cost")).cast("double").alias("total_profit"),
        F.count(F.lit(1)).cast("double").alias("lines"),
        (F.count_if(F.col("l_returnflag") == "R") / F.count(F.lit(1))).alias("return_rate"),
    )
    o = t.orders.agg(
        F.count(F.lit(1)).cast("double").alias("orders"),
        (F.sum(_dec("o_totalprice")).cast("double") / F.count("o_totalprice")).alias("avg_order_value"),
        F.count_distinct("o_custkey").cast("double").alias("active_customers"),
    )
    row = lv.crossJoin(o)
    names = ["total_revenue", "total_profit", "lines", "return_rate", "orders", "avg_order_value", "active_customers"]
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("kpi"), F.col(n).alias("value")) for n in names]))
                      .alias("kv")).select("kv.*")


def monthly_revenue(t: Tables) -> DataFrame:
    per_order = line_revenue(t).groupBy("l_orderkey").agg(F.sum("revenue").alias("rev"))
    o = t.orders.select("o_orderkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
    return per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("month") \
        .agg(F.sum("rev").cast("double").alias("revenue"))


def sales_trend(t: Tables) -> DataFrame:
    """Revenue per month, previous month and growth in percent (one row per month)."""
    m = monthly_revenue(t)
    m = W.add_lag(m, "revenue", ["month"], "prev_revenue", allow_global=True)
    return m.withColumn("growth_pct", F.try_divide(F.col("revenue") - F.col("prev_revenue"), F.col("prev_revenue")) * 100)


def profitability(t: Tables) -> DataFrame:
    """Revenue, cost, profit and margin by product type and region."""
    lv = line_values(t)
    per = lv.groupBy("l_orderkey", "p_type").agg(F.sum("revenue").alias("rev"), F.sum("cost").alias("cost"))
    j = per.join(_order_customer_region(t).select("o_orderkey", "r_name"), F.col("l_orderkey") == F.col("o_orderkey"))
    g = j.groupBy("p_type", "r_name").agg(F.sum("rev").alias("rev"), F.sum("cost").alias("cost"))
    return g.select("p_type", "r_name", F.col("rev").cast("double").alias("revenue"),
                    F.col("cost").cast("double").alias("cost"), (F.col("rev") - F.col("cost")).cast("double").alias("profit"),
                    (F.try_divide((F.col("rev") - F.col("cost")).cast("double"), F.col("rev").cast("double")) * 100).alias("margin_pct"))


def part_revenue(t: Tables) -> DataFrame:
    """Revenue and quantity of every part: lines are summed per part before the part is joined."""
    per = line_revenue(t).groupBy("l_partkey").agg(F.sum("revenue").cast("double").alias("revenue"),
                                                   F.sum("l_quantity").alias("quantity"))
    part = t.part.select("p_partkey", "p_type")
    return per.join(part, per.l_partkey == part.p_partkey).select("l_partkey", "p_type", "revenue", "quantity")


def top_products(t: Tables, k: int = 10) -> DataFrame:
    """The k parts with the highest revenue (ties by key)."""
    return part_revenue(t).orderBy(F.desc("revenue"), "l_partkey").limit(k)


def top_products_per_type(t: Tables, k: int = 3) -> DataFrame:
    """The k best parts of every product type, ranked (skew-safe top-k per group)."""
    return top_k_per_group(part_revenue(t), ["p_type"], [("revenue", False), ("l_partkey", True)], k,
                           rank="rank", rank_col="type_rank")


def customer_segments(t: Tables, buckets: int = 4) -> DataFrame:
    """Recency / frequency / value per customer, each scored by NTILE over all customers.

    The cut points of all three scores come from one selection over the pinned rollup; no customer is sorted.
    """
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    last = o.agg(F.max(F.col("o_orderdate").cast("date")).alias("_as_of"))
    per = o.groupBy("o_custkey").agg(
        F.max(F.col("o_orderdate").cast("date")).alias("last_order"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(_dec("o_totalprice")).cast("double").alias("monetary"),
    ).crossJoin(F.broadcast(last)).withColumn("recency_days", F.datediff("_as_of", "last_order")).drop("_as_of")
    per = cut_lineage(per.withColumn("_often", -F.col("frequency")).withColumn("_much", -F.col("monetary")))
    scored = add_ntiles(per, {"r_score": "recency_days", "f_score": "_often", "m_score": "_much"}, "o_custkey", buckets)
    return scored.select(F.col("o_custkey").alias("c_custkey"), "recency_days", "frequency", "monetary",
                         "r_score", "f_score", "m_score",
                         F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"),
                                  F.col("m_score").cast("string")).alias("segment"))


def stock_levels(t: Tables, initial_per_size: int = 10, threshold: int = 0) -> DataFrame:
    """Stock per part = initial (size x 10) + returned - shipped; low when under the threshold."""
    li = t.lineitem
    moves = li.groupBy("l_partkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", _dec("l_quantity")).otherwise(0)).alias("returned"),
        F.sum(F.when(F.col("l_returnflag") != "R", _dec("l_quantity")).otherwise(0)).alias("shipped"),
    )
    p = t.part.select("p_partkey", "p_size")
    j = p.join(moves, p.p_partkey == moves.l_partkey, "left")
    stock = (F.col("p_size") * initial_per_size).cast("decimal(18,2)") + F.coalesce("returned", F.lit(0)) \
        - F.coalesce("shipped", F.lit(0))
    return j.select("p_partkey", F.coalesce("shipped", F.lit(0)).cast("double").alias("shipped"),
                    F.coalesce("returned", F.lit(0)).cast("double").alias("returned"),
                    stock.cast("double").alias("stock"), (stock < threshold).alias("low_stock"))


def supplier_performance(t: Tables) -> DataFrame:
    """Per supplier -- lines, quantity shipped, distinct parts, return rate, revenue."""
    return line_revenue(t).groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(_dec("l_quantity")).cast("double").alias("quantity"),
        F.count_distinct("l_partkey").alias("parts"),
        (F.count_if(F.col("l_returnflag") == "R") / F.count(F.lit(1))).alias("return_rate"),
        F.sum("revenue").cast("double").alias("revenue"),
    )


def revenue_forecast(t: Tables, horizon: int = 6, season: int = 12) -> DataFrame:
    """Linear trend over the month index plus the seasonal-naive value, with future months.

    The monthly series has one row per calendar month, so its windows are small.
    """
    m = monthly_revenue(t).withColumn("idx", F.months_between("month", F.lit("1970-01-01").cast("date")).cast("int"))
    fit = m.agg(F.regr_slope("revenue", "idx").alias("slope"), F.regr_intercept("revenue", "idx").alias("intercept"),
                F.max("idx").alias("_last"), F.max("month").alias("_last_month"))
    hist = W.add_lag(m, "revenue", ["idx"], "seasonal_naive", offset=season, allow_global=True) \
        .select("month", "idx", "revenue", "seasonal_naive")
    future = fit.select(F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"), "_last", "_last_month") \
        .select(F.add_months("_last_month", F.col("h")).alias("month"), (F.col("_last") + F.col("h")).alias("idx"),
                F.lit(None).cast("double").alias("revenue"), F.lit(None).cast("double").alias("seasonal_naive"))
    allm = hist.unionByName(future).crossJoin(F.broadcast(fit.select("slope", "intercept")))
    return allm.select("month", "revenue", "seasonal_naive",
                       F.round(F.col("intercept") + F.col("slope") * F.col("idx"), 2).alias("trend"))


def stock_movement(t: Tables, initial_per_size: int = 10) -> DataFrame:
    """Stock of every part after each day on which it moved: returned lines come in, the others go out."""
    signed = F.when(F.col("l_returnflag") == "R", _dec("l_quantity")).otherwise(-_dec("l_quantity"))
    moves = t.lineitem.select("l_partkey", F.col("l_shipdate").cast("date").alias("day"), signed.alias("amount"))
    moved = SE.running_balance(moves, ["l_partkey"], "day", "amount")
    start = t.part.select("p_partkey", (F.col("p_size") * initial_per_size).cast("decimal(18,2)").alias("initial"))
    return moved.join(start, F.col("l_partkey") == F.col("p_partkey")).select("p_partkey", "day", "net", (F.col("initial") + F.col("moved")).alias("stock"))


def stock_history(t: Tables) -> DataFrame:
    """The movements as numbers of a report."""
    return stock_movement(t).select("p_partkey", "day", F.col("net").cast("double").alias("net"), F.col("stock").cast("double").alias("stock"))


def stock_shortages(t: Tables, threshold: int = 0) -> DataFrame:
    """Per part the first day its stock was under the threshold, the days under it, the lowest and the last stock."""
    found = SE.shortages(stock_movement(t), ["p_partkey"], "day", "stock", threshold)
    return found.select("p_partkey", "first_day_below", "days_below", *[F.col(c).cast("double").alias(c) for c in ("lowest", "last")])


def _type_months(t: Tables) -> DataFrame:
    """Revenue per product type and month of the order."""
    o = t.orders.select("o_orderkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
    per = line_values(t).groupBy("l_orderkey", "p_type").agg(F.sum("revenue").alias("rev")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return per.groupBy("p_type", "month").agg(F.sum("rev").cast("double").alias("revenue"))


def forecast_errors(t: Tables, season: int = 12, history: int = 24) -> DataFrame:
    """How far trend and seasonal-naive are off, one month ahead, per product type."""
    filled = SE.gap_filled(_type_months(t), ["p_type"], "month", "revenue", fill=0.0)
    errors = SE.forecast_errors(SE.rolling_origin(filled, ["p_type"], "revenue", season, history), ["p_type"], "revenue")
    return errors.withColumns({c: F.round(c, 2) for c in ("mae_trend", "mae_seasonal")})


def forecast_per_type(t: Tables, horizon: int = 6) -> DataFrame:
    """The next months of every product type."""
    filled = SE.gap_filled(_type_months(t), ["p_type"], "month", "revenue", fill=0.0)
    return SE.forecast(filled, ["p_type"], "month", "revenue", horizon).withColumn("trend", F.round("trend", 2))


def region_priority_heatmap(t: Tables) -> DataFrame:
    """Revenue by region (rows) and order priority (columns)."""
    per_order = line_revenue(t).groupBy("l_orderkey").agg(F.sum("revenue").alias("rev"))
    j = per_order.join(_order_customer_region(t).select("o_orderkey", "r_name", "o_orderpriority"),
                       F.col("l_orderkey") == F.col("o_orderkey"))
    p = j.groupBy("r_name").pivot("o_orderpriority", list(ORDER_PRIORITIES)).agg(F.sum("rev"))
    return p.select("r_name", *[F.col(f"`{v}`").cast("double").alias(v) for v in ORDER_PRIORITIES])
