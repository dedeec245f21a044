"""The star of the test data written for DuckDB, shared by every oracle.

The fact CTE is MATERIALIZED: DuckDB evaluates it once per query.
"""

STAR_CTES = """
dim_store AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS store_id, n.n_name AS store_name, r.r_name AS location
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
dim_product AS (
  SELECT p.p_partkey AS product_id, p.p_name AS product_name,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS product_price,
         s.s_suppkey AS supplier_id, s.s_name AS supplier_name,
         CAST(s.s_nationkey AS INTEGER) AS store_id
  FROM part p JOIN supplier s ON s.s_suppkey = p.p_partkey % (SELECT count(*) FROM supplier)),
fact AS MATERIALIZED (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER) AS date_id,
         o.o_custkey AS customer_id,
         l.l_partkey AS product_id,
         dp.store_id,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         dp.product_price AS unit_price,
         CAST(dp.product_price * CAST(l.l_quantity AS INTEGER) AS DECIMAL(18,2)) AS total_sale
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN dim_product dp ON l.l_partkey = dp.product_id),
tx AS (
  SELECT l.l_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date,
         l.l_partkey AS product_id, o.o_custkey AS customer_id,
         CAST(l.l_quantity AS INTEGER) AS quantity, l.l_linenumber AS line_number
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
dim_customer AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment FROM customer),
daily AS (
  SELECT product_id, order_date, SUM(total_sale) AS daily_sales,
         COUNT(*) OVER (PARTITION BY product_id) AS n,
         SUM(SUM(total_sale)) OVER (PARTITION BY product_id) AS total,
         SUM(SUM(total_sale) * SUM(total_sale)) OVER (PARTITION BY product_id) AS sumsq
  FROM fact GROUP BY product_id, order_date)
"""


def with_star(body: str, extra_ctes: str = "") -> str:
    """``WITH <star>[, extra] <body>``."""
    ctes = STAR_CTES.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"


def r2(x: str) -> str:
    """ROUND(x, 2) with the same decimal steps as sparkmart.functions.round2."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,8)), 2) AS DECIMAL(38,2))"


def div(a: str, b: str) -> str:
    """a / b as DOUBLE, NULL when b is NULL or 0."""
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0.0))"
