"""Position-completion and subtotal queries over the driver tables.

Portfolios are nations; every order of a nation's customers is a holding
with asset type = market segment, sector = order priority, currency = order
status and market value = total price. The known positions are each
portfolio's ten largest holdings; the marginals are the totals of all its
holdings by each dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..operators import allocation as al
from ..operators.procedures import run_procedure
from . import fixtures as fx
from .ingest_queries import _HOLD_SQL, load_line_holdings
from .registry import query

PID = al.PID
TOP_K = 10


def order_holdings(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders")
    c = fx.table(spark, sf, "customer")
    return (o.join(c, o["o_custkey"] == c["c_custkey"])
            .select(c["c_nationkey"].cast("long").alias(PID),
                    F.concat(F.lit("Order "), o["o_orderkey"].cast("string")).alias("holding_name"),
                    c["c_mktsegment"].alias("asset_type"), o["o_orderpriority"].alias("sector"),
                    o["o_orderstatus"].alias("currency"),
                    o["o_totalprice"].cast(al.MONEY).alias("market_value")))


def inputs(spark: SparkSession, sf: str):
    """Known positions, marginals and totals, read many times by a completion and
    much smaller than the holdings: written once, from one pass over these for
    the positions and one for all sums."""
    h = order_holdings(spark, sf)
    sums = materialize(al.subtotals(h), "subtotals")
    totals = sums.filter(F.col("dim") == "all").select(PID, F.col("total").alias("total_net_assets"))
    return materialize(al.top_positions(h, TOP_K), "top-positions"), materialize(al.numbered(sums), "marginals"), totals


def exact_weight_sql(v: str, tot: str) -> str:
    """round(v / tot, 8) half-up, exactly, for positive 2-decimal values."""
    vc, tc = f"CAST(({v}) * 100 AS HUGEINT)", f"CAST(({tot}) * 100 AS HUGEINT)"
    return (f"CAST(CAST(({vc} * 200000000 + {tc}) // (2 * {tc}) AS DECIMAL(18,0)) "
            f"* CAST(0.00000001 AS DECIMAL(10,8)) AS DECIMAL(18,8))")


H_SQL = """h AS (SELECT CAST(c_nationkey AS BIGINT) AS portfolio_id, 'Order ' || o_orderkey AS holding_name,
  c_mktsegment AS asset_type, o_orderpriority AS sector, o_orderstatus AS currency,
  CAST(o_totalprice AS DECIMAL(18,2)) AS market_value
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
TOP_SQL = H_SQL + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY portfolio_id ORDER BY market_value DESC, holding_name) AS position_no FROM h),
top AS (SELECT * FROM r WHERE position_no <= {TOP_K})"""
MARG_SQL = """m AS (
  SELECT portfolio_id, 'asset_type' AS dim, asset_type AS key, sum(market_value) AS total FROM h GROUP BY 1, 2, 3
  UNION ALL SELECT portfolio_id, 'sector', sector, sum(market_value) FROM h GROUP BY 1, 2, 3
  UNION ALL SELECT portfolio_id, 'currency', currency, sum(market_value) FROM h GROUP BY 1, 2, 3)"""
GRID_SQL = """g AS (SELECT a.portfolio_id, a.key AS asset_type, s.key AS sector, c.key AS currency
  FROM m a JOIN m s ON s.portfolio_id = a.portfolio_id AND s.dim = 'sector'
           JOIN m c ON c.portfolio_id = a.portfolio_id AND c.dim = 'currency'
  WHERE a.dim = 'asset_type'),
oc AS (SELECT g.*, row_number() OVER (PARTITION BY portfolio_id ORDER BY asset_type, sector, currency) AS cell_no
  FROM g WHERE NOT EXISTS (SELECT 1 FROM top t WHERE t.portfolio_id = g.portfolio_id
    AND t.asset_type = g.asset_type AND t.sector = g.sector AND t.currency = g.currency))"""


@query("holdings_subtotals", f"""
WITH h AS ({_HOLD_SQL}),
g AS (SELECT sector, currency, count(*) AS n, CAST(sum(mv) AS DECIMAL(38,2)) AS mv FROM h GROUP BY 1, 2),
t AS (SELECT sum(mv) AS tot FROM g)
SELECT sector, currency, n, mv, {exact_weight_sql('mv', 'tot')} AS wt FROM g, t
""", covers="flagship: holdings file -> typed table -> read procedure -> subtotals by two dimensions with weights")
def holdings_subtotals(spark: SparkSession, sf: str) -> DataFrame:
    t = load_line_holdings(spark, sf)
    h = run_procedure(spark, "usp_holdweb_process", table=t)
    g = h.groupBy("sector", "currency").agg(F.count(F.lit(1)).alias("n"),
                                            F.sum("mv").cast("decimal(38,2)").alias("mv"))
    # the total over the grouped rows (one row per sector x currency)
    g = g.withColumn("_tot", F.sum("mv").over(Window.partitionBy()))
    return al.with_weight(g, "mv", "_tot").drop("_tot")


@query("category_subtotals", f"""
WITH {H_SQL}
SELECT portfolio_id, 'asset_type' AS dim, asset_type AS key, count(*) AS n, CAST(sum(market_value) AS DECIMAL(38,2)) AS total FROM h GROUP BY 1, 2, 3
UNION ALL SELECT portfolio_id, 'sector', sector, count(*), CAST(sum(market_value) AS DECIMAL(38,2)) FROM h GROUP BY 1, 2, 3
UNION ALL SELECT portfolio_id, 'currency', currency, count(*), CAST(sum(market_value) AS DECIMAL(38,2)) FROM h GROUP BY 1, 2, 3
UNION ALL SELECT portfolio_id, 'all', NULL, count(*), CAST(sum(market_value) AS DECIMAL(38,2)) FROM h GROUP BY 1
""", covers="G02 G03 G04 subtotals by three dimensions and the total in one GROUPING SETS pass")
def category_subtotals(spark: SparkSession, sf: str) -> DataFrame:
    return al.subtotals(order_holdings(spark, sf))


@query("weights", f"""
WITH {H_SQL}, t AS (SELECT portfolio_id, sum(market_value) AS tot FROM h GROUP BY 1)
SELECT h.portfolio_id, holding_name, market_value, {exact_weight_sql('market_value', 'tot')} AS wt
FROM h JOIN t ON h.portfolio_id = t.portfolio_id
""", covers="P08 X11 weight = round(mv / total net assets, 8), exact decimals")
def weights(spark: SparkSession, sf: str) -> DataFrame:
    h = order_holdings(spark, sf)
    # Written, so that its size is known: a small one is broadcast, and a hot portfolio is not shuffled.
    tot = materialize(al.net_assets_of(h), "net-assets")
    return al.with_weight(h.join(tot, PID), "market_value", "total_net_assets").select(
        PID, "holding_name", "market_value", "wt")


@query("known_combos", f"""
WITH {TOP_SQL}
SELECT portfolio_id, asset_type, sector, currency, count(*) AS n_positions FROM top GROUP BY 1, 2, 3, 4
""", covers="G06 distinct combinations of the known top positions (top-k per portfolio)")
def known_combos(spark: SparkSession, sf: str) -> DataFrame:
    return al.known_combos(al.top_positions(order_holdings(spark, sf), TOP_K))


@query("open_cells", f"""
WITH {TOP_SQL}, {MARG_SQL}, {GRID_SQL}
SELECT portfolio_id, CAST(cell_no AS INTEGER) AS cell_no, 'Hypothetical Position ' || cell_no AS holding_name,
       asset_type, sector, currency FROM oc
""", covers="C02 C03 J03 J04 W04 P10 grid per portfolio minus known combinations, numbered")
def open_cells(spark: SparkSession, sf: str) -> DataFrame:
    top, marg, _ = inputs(spark, sf)
    return al.open_cells(al.grid(marg), top)


@query("residual_marginals", f"""
WITH {TOP_SQL}, {MARG_SQL},
k AS (SELECT portfolio_id, 'asset_type' AS dim, asset_type AS key, sum(market_value) AS known FROM top GROUP BY 1, 2, 3
  UNION ALL SELECT portfolio_id, 'sector', sector, sum(market_value) FROM top GROUP BY 1, 2, 3
  UNION ALL SELECT portfolio_id, 'currency', currency, sum(market_value) FROM top GROUP BY 1, 2, 3)
SELECT m.portfolio_id, m.dim, m.key,
       CAST(row_number() OVER (PARTITION BY m.portfolio_id, m.dim ORDER BY m.key) AS INTEGER) AS ordinal,
       CAST(m.total AS DECIMAL(18,2)) AS total, CAST(coalesce(k.known, 0) AS DECIMAL(18,2)) AS known,
       CAST(m.total - coalesce(k.known, 0) AS DECIMAL(18,2)) AS residual
FROM m LEFT JOIN k ON m.portfolio_id = k.portfolio_id AND m.dim = k.dim AND m.key = k.key
""", covers="C01 C05 J05 residual marginals (total minus known), may be negative")
def residual_marginals(spark: SparkSession, sf: str) -> DataFrame:
    top, marg, _ = inputs(spark, sf)
    r = al.residuals(marg, top)
    return r.select(PID, "dim", "key", F.col("ordinal").cast("int").alias("ordinal"), "total", "known", "residual")


KKT_TOL = 1e-6


@query("fit_kkt", f"""
WITH {TOP_SQL}, {MARG_SQL}, {GRID_SQL}
SELECT portfolio_id, count(*) AS n_cells, TRUE AS kkt_ok FROM oc GROUP BY 1
""", covers="C06 C07 per-portfolio non-negative least squares; optimality (KKT) checked, not cell values")
def fit_kkt(spark: SparkSession, sf: str) -> DataFrame:
    top, marg, _ = inputs(spark, sf)
    cells = al.open_cells(al.grid(marg), top)
    resid = al.residuals(marg, top)
    fitted = materialize(al.fit(cells, resid), "fit")
    return al.optimality(fitted, resid).select(PID, "n_cells", (F.col("violation") <= F.lit(KKT_TOL)).alias("kkt_ok"))


@query("completed_subtotals", f"""
WITH {TOP_SQL}, {MARG_SQL}
SELECT portfolio_id, dim, key, CAST(total AS DECIMAL(38,2)) AS given, TRUE AS given_met FROM m
""", covers="C08 U01 V06 X12 completed positions: subtotals against the given totals")
def completed_subtotals(spark: SparkSession, sf: str) -> DataFrame:
    top, marg, tot = inputs(spark, sf)
    d = al.subtotal_diff(al.complete_positions(top, marg, tot), marg)
    # every completed row is rounded to cents, so a met total is off by at most half a cent a row
    return d.select(PID, "dim", "key", "given", (F.abs("diff") <= F.lit(0.005) * (F.col("n") + 1)).alias("given_met"))


@query("completed_totals", f"""
WITH {TOP_SQL}, {MARG_SQL}
SELECT portfolio_id, CAST(sum(total) AS DECIMAL(38,2)) AS given, TRUE AS mv_met, TRUE AS wt_met FROM m WHERE dim = 'asset_type' GROUP BY 1
""", covers="G03 a completed portfolio's market value and weight totals against its net assets")
def completed_totals(spark: SparkSession, sf: str) -> DataFrame:
    top, marg, tot = inputs(spark, sf)
    done = al.grand_total(al.complete_positions(top, marg, tot)).join(tot, PID)
    # each row is rounded to cents, and its weight to eight decimals
    return done.select(PID, F.col("total_net_assets").cast("decimal(38,2)").alias("given"),
                       (F.abs(F.col("total_mv") - F.col("total_net_assets")) <= F.lit(0.005) * (F.col("n") + 1)).alias("mv_met"),
                       (F.abs(F.col("total_wt") - 1) <= F.lit(5e-9) * (F.col("n") + 1)).alias("wt_met"))


@query("unknown_categories", f"""
WITH {TOP_SQL}, {MARG_SQL}
SELECT top.portfolio_id, 'sector' AS dim, top.sector AS key, count(*) AS n_positions, CAST(sum(top.market_value) AS DECIMAL(38,2)) AS value
FROM top WHERE top.sector LIKE '%-URGENT' GROUP BY 1, 2, 3
""", covers="J05 known positions in categories without a total are reported")
def unknown_categories(spark: SparkSession, sf: str) -> DataFrame:
    top, marg, _ = inputs(spark, sf)
    return al.unknown_categories(marg.where(~F.col("key").endswith("-URGENT")), top)


@query("first_rows", f"""
WITH {TOP_SQL}, {MARG_SQL}, {GRID_SQL},
nk AS (SELECT portfolio_id, count(*) AS n FROM top GROUP BY 1),
u AS (SELECT portfolio_id, CAST(position_no AS INTEGER) AS ordinal, holding_name, asset_type, sector, currency,
             FALSE AS hypothetical FROM top
      UNION ALL SELECT oc.portfolio_id, CAST(nk.n + cell_no AS INTEGER), 'Hypothetical Position ' || cell_no,
             asset_type, sector, currency, TRUE FROM oc JOIN nk ON oc.portfolio_id = nk.portfolio_id)
SELECT * FROM u WHERE ordinal <= 15
""", covers="L02 first 15 rows of each completed portfolio")
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    top, marg, tot = inputs(spark, sf)
    done = al.complete_positions(top, marg, tot)
    return al.first_rows(done, 15).select(PID, "ordinal", "holding_name", *al.DIMS, "hypothetical")
