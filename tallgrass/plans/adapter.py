"""Silver-shaped data from the TPC-H-like tables: suppliers are entities, nations counties, ship months production months.

Volumes are whole numbers, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import conform


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem: entity k, nation, state, month, flag, quantity, line, seq."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    state = F.when(F.col("n_regionkey") % 3 == 0, "TX").when(F.col("n_regionkey") % 3 == 1, "NM").otherwise("OK")
    out = li.join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
    out = out.select(
        F.col("s_suppkey").alias("k"), F.col("n_nationkey").alias("nk"), F.col("n_name").alias("county"), state.alias("state"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("production_date"), F.col("l_returnflag").alias("flag"),
        F.col("l_quantity").alias("q"), F.col("l_linenumber").alias("ln"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_shipdate").alias("shipped"),
    )
    return out.filter(~((F.col("k") % 5 == 0) & (F.month("production_date") == 7)))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table: ``reports`` summed by entity and month, with invented descriptions."""
    r = reports(spark, sf_dir)

    def total(flag: str, x: str) -> F.Column:
        return F.sum(F.when(F.col("flag") == flag, F.expr(x)))

    g = r.groupBy("k", "nk", "county", "state", "production_date").agg(
        total("N", "q").alias("oil_bbl"), total("R", "q * ln").alias("gas_mcf"), total("A", "q").alias("w"),
        total("N", "cast(ln as double)").alias("c"), total("R", "cast(ln as double)").alias("h"), F.least(F.count("*"), F.lit(31)).cast("int").alias("d"),
    )
    tx, k, nk = F.col("state") == "TX", F.col("k"), F.col("nk")
    lease = tx & (k % 4 == 0)
    code = F.when(tx, "42").when(F.col("state") == "NM", "30").otherwise("35")
    api = F.concat(code, F.lit("-"), F.lpad(nk.cast("string"), 3, "0"), F.lit("-"), F.lpad(k.cast("string"), 5, "0"))
    out = g.withColumns(
        {
            "entity_type": F.when(lease, "lease").otherwise("well"),
            "api_number": F.when(~lease, api),
            "lease_number": F.when(lease, F.lpad(k.cast("string"), 6, "0")),
            "district": F.when(lease, F.lpad((nk % 10).cast("string"), 2, "0")),
            "well_name": F.concat(F.lit("WELL "), k.cast("string")),
            "operator": F.when(k % 13 != 0, F.concat(F.lit("OPERATOR "), (k % 17).cast("string"))),
            "field_name": F.concat(F.lit("FIELD "), (k % 29).cast("string")),
            "basin": F.when(nk % 3 == 0, "Permian").when(nk % 3 == 1, "San Juan"),
            "well_type": F.when(k % 3 == 0, "OIL").when(k % 3 == 1, "GAS").otherwise("OTHER"),
            "well_status": F.when(k % 7 == 0, "SHUT-IN").otherwise("ACTIVE"),
            "latitude": F.when(k % 6 != 0, 30 + nk * 0.25),
            "longitude": F.when(k % 6 != 0, -100 - nk * 0.5),
            "condensate_bbl": F.when(tx, F.col("c")),
            "casinghead_gas_mcf": F.when(tx, F.col("h")),
            "water_bbl": F.when(~tx, F.col("w")),
            "days_produced": F.when(~tx, F.col("d")),
            "source_file": F.lit("lineitem"),
            "ingested_at": F.lit("2026-01-01 00:00:00").cast("timestamp"),
        }
    )
    return conform(out)


#: The same in DuckDB SQL: common table expressions ``reports`` and ``silver``.
SILVER_SQL = """
reports AS (
  SELECT s_suppkey AS k, n_nationkey AS nk, n_name AS county, CASE n_regionkey % 3 WHEN 0 THEN 'TX' WHEN 1 THEN 'NM' ELSE 'OK' END AS state,
    cast(date_trunc('month', l_shipdate) AS DATE) AS production_date, l_returnflag AS flag, l_quantity AS q, l_linenumber AS ln,
    l_orderkey * 10 + l_linenumber AS seq, l_shipdate AS shipped
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  WHERE NOT (s_suppkey % 5 = 0 AND month(l_shipdate) = 7)),
monthly AS (
  SELECT k, nk, county, state, production_date, sum(q) FILTER (flag = 'N') AS o, sum(q * ln) FILTER (flag = 'R') AS g, sum(q) FILTER (flag = 'A') AS w,
    cast(sum(ln) FILTER (flag = 'N') AS DOUBLE) AS c, cast(sum(ln) FILTER (flag = 'R') AS DOUBLE) AS h, cast(least(count(*), 31) AS INTEGER) AS d
  FROM reports GROUP BY ALL),
typed AS (SELECT *, state = 'TX' AND k % 4 = 0 AS lease, state = 'TX' AS tx FROM monthly),
silver AS (
  SELECT state, CASE WHEN lease THEN 'lease' ELSE 'well' END AS entity_type,
    CASE WHEN NOT lease THEN CASE state WHEN 'TX' THEN '42' WHEN 'NM' THEN '30' ELSE '35' END || '-' || lpad(nk::VARCHAR, 3, '0') || '-' || lpad(k::VARCHAR, 5, '0') END AS api_number,
    CASE WHEN lease THEN lpad(k::VARCHAR, 6, '0') END AS lease_number, CASE WHEN lease THEN lpad((nk % 10)::VARCHAR, 2, '0') END AS district,
    'WELL ' || k AS well_name, CASE WHEN k % 13 <> 0 THEN 'OPERATOR ' || (k % 17) END AS operator, county, 'FIELD ' || (k % 29) AS field_name,
    CASE nk % 3 WHEN 0 THEN 'Permian' WHEN 1 THEN 'San Juan' END AS basin, CASE k % 3 WHEN 0 THEN 'OIL' WHEN 1 THEN 'GAS' ELSE 'OTHER' END AS well_type,
    CASE WHEN k % 7 = 0 THEN 'SHUT-IN' ELSE 'ACTIVE' END AS well_status, CASE WHEN k % 6 <> 0 THEN 30 + nk * 0.25::DOUBLE END AS latitude,
    CASE WHEN k % 6 <> 0 THEN -100 - nk * 0.5::DOUBLE END AS longitude, production_date, o AS oil_bbl, g AS gas_mcf,
    CASE WHEN tx THEN c END AS condensate_bbl, CASE WHEN tx THEN h END AS casinghead_gas_mcf, CASE WHEN NOT tx THEN w END AS water_bbl,
    CASE WHEN NOT tx THEN d END AS days_produced, 'lineitem' AS source_file, TIMESTAMP '2026-01-01 00:00:00' AS ingested_at
  FROM typed)
"""
