import pytest

from tallgrass.operators import serve
from tallgrass.schema import RESERVES


def test_queries_only(spark, tmp_path):
    spark.range(5).createOrReplaceTempView("five")
    assert serve.query(spark, "SELECT max(id) AS m, replace('a', 'a', 'b') AS r FROM five").splitlines()[-1] == "| 4 | b |"
    for sql in ("DROP VIEW five", "CREATE TABLE t AS SELECT 1", "INSERT INTO five VALUES (1)", "SET x = 1", f"INSERT OVERWRITE DIRECTORY '{tmp_path}' USING parquet SELECT 1"):
        with pytest.raises(serve.NotReadOnly):
            serve.parsed(spark, sql)
        assert serve.query(spark, sql).startswith("Error:")
    spark.range(2).write.parquet(str(tmp_path / "p"))
    java = "'java.lang.System', 'getProperty', 'user.home'"
    refused = [f"SELECT {f}({java})" for f in ("reflect", "java_method", "try_reflect")]
    refused += [f"SELECT 1 WHERE EXISTS (SELECT reflect({java}))", f"WITH a AS (SELECT java_method({java}) AS x) SELECT * FROM a", f"SELECT * FROM five ORDER BY reflect({java})"]
    refused += [f"SELECT * FROM parquet.`{tmp_path}/p`", f"SELECT (SELECT max(id) FROM parquet.`{tmp_path}/p`)", "SELECT TRANSFORM (id) USING 'cat' AS x FROM five"]
    for sql in refused:
        with pytest.raises(serve.NotReadOnly):
            serve.parsed(spark, sql)
    served = ["WITH a AS (SELECT * FROM five), b AS (SELECT * FROM a) SELECT id, count(*) OVER () FROM b WHERE id IN (SELECT id FROM a) GROUP BY id HAVING id > 1 ORDER BY 1 LIMIT 2"]
    served += ["SELECT * FROM five JOIN five g USING (id) UNION ALL SELECT 7", "SELECT x FROM (VALUES (1), (2)) t(x) INTERSECT SELECT 2", "SELECT * FROM range(3)", "SELECT explode(array(1, 2)) AS e"]
    served += ["SELECT * FROM five, LATERAL (SELECT five.id + 1 AS k)", "SELECT * FROM five PIVOT (count(*) FOR id IN (1, 2))", "SELECT id FROM five SORT BY id"]
    for sql in served:
        assert not serve.query(spark, sql).startswith("Error:"), serve.query(spark, sql)
    assert "first 3 rows" in serve.query(spark, "SELECT * FROM five", 3)
    assert serve.query(spark, "SELECT * FROM nothing_here").startswith("Error:")


def test_cells_stay_cells(spark):
    spark.createDataFrame([("a|b\\c\nd", None)], "`x|y` string, z int").createOrReplaceTempView("odd")
    assert serve.query(spark, "SELECT * FROM odd").splitlines()[::2] == ["| x\\|y | z |", "| a\\|b\\\\c<br>d |  |"]


def test_reserves_are_queried(spark):
    from tallgrass.operators import reserves

    tables = reserves.tables(spark)
    tables["price_decks"] = reserves.set_price_deck(tables["price_decks"], "d", "Deck", [(70, 3), (60, 2)])
    out = serve.query_reserves(tables, "SELECT price_deck_id, max(oil_price) AS top FROM price_decks GROUP BY ALL")
    assert out.splitlines()[-1] == "| d | 70.0 |"
    assert serve.query_reserves(tables, "SELECT count(*) AS n FROM cases WHERE case_id = :c", args={"c": "x"}).endswith("| 0 |")
    assert serve.query_reserves(tables, "DROP TABLE cases").startswith("Error:")


def test_cases(spark):
    names = [c.split()[0] for c in RESERVES["cases"].split(", ")]
    base = dict.fromkeys(names) | {"case_id": "a", "pv10": 5.0, "npv": 9.0}
    cases = spark.createDataFrame([tuple(base[n] for n in names)], RESERVES["cases"])
    two = serve.clone_case(cases, "a", "b", pv10=8.0)
    assert {r.measure: r.difference for r in serve.compare_cases(two, "a", "b").collect()} == {"eur_oil_bbl": None, "eur_gas_mcf": None, "pv10": 3.0, "npv": 0.0}
    props = spark.createDataFrame([("Alpha", "TX"), ("Beta", "NM")], "operator string, state string")
    assert serve.search_wells(props, operator="alph").count() == 1
