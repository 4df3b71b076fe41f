"""Read-only SQL serving, and the reserves tables' operations."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_ROWS = 1000


class NotReadOnly(ValueError):
    """The statement is more than a query."""


#: Operators that a served query may have; a plan with any other is no query.
OPERATORS = {
    "Aggregate", "CTERelationDef", "CTERelationRef", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "Intersect", "Join", "LateralJoin", "LocalLimit", "LocalRelation",
    "Offset", "OneRowRelation", "Pivot", "Project", "Range", "ResolvedInlineTable", "Sample", "Sort", "SubqueryAlias", "Tail", "Union", "Unpivot", "UnresolvedHaving", "UnresolvedHint",
    "UnresolvedInlineTable", "UnresolvedPivot", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases", "UnresolvedTVFAliases", "UnresolvedTableValuedFunction", "UnresolvedWith", "Window",
    "WithCTE", "WithWindowDefinition",
}
#: Functions that call any static Java method.
REFLECTIVE = {"reflect", "try_reflect", "java_method"}


def items(seq) -> list:
    """A Scala sequence as a list."""
    return [seq.apply(i) for i in range(seq.size())]


def parsed(spark: SparkSession, sql: str):
    """The statement's plan; raises NotReadOnly unless it consists of query operators over named tables.

    Subqueries and common table expressions count as well. A relation is a table or view of the catalog or of the
    query itself, never a path; functions that call Java are refused wherever they stand.
    """
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    load = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass
    is_plan = load("org.apache.spark.sql.catalyst.plans.logical.LogicalPlan").isInstance
    has_plan = load("org.apache.spark.sql.catalyst.expressions.PlanExpression").isInstance
    nodes, expressions, relations, local = [plan], [], [], set()
    while nodes or expressions:
        if nodes:
            node = nodes.pop()
            name = node.getClass().getSimpleName()
            if name not in OPERATORS:
                raise NotReadOnly(f"only queries are served, not {name}")
            if name == "UnresolvedRelation":
                relations.append(items(node.multipartIdentifier()))
            if name == "UnresolvedWith":
                local |= {str(x._1()).lower() for x in items(node.cteRelations())}
            nodes += [*items(node.children()), *(x for x in items(node.innerChildren()) if is_plan(x))]
            if name == "UnresolvedTableValuedFunction" and str(items(node.name())[-1]).lower() in REFLECTIVE:
                raise NotReadOnly("functions that call Java are not served")
            expressions += items(node.expressions())
        else:
            e = expressions.pop()
            kind = e.getClass().getSimpleName()
            if kind == "UnresolvedFunction" and str(items(e.nameParts())[-1]).lower() in REFLECTIVE or "Reflect" in kind:
                raise NotReadOnly("functions that call Java are not served")
            if has_plan(e):
                nodes.append(e.plan())
            expressions += items(e.children())
    for parts in relations:
        if not (len(parts) == 1 and str(parts[0]).lower() in local) and not spark.catalog.tableExists(".".join(f"`{p}`" for p in parts)):
            raise NotReadOnly(f"no table {'.'.join(parts)}")
    return plan


def query(spark: SparkSession, sql: str, limit: int = MAX_ROWS, args: dict | None = None) -> str:
    """The result of a query as a Markdown table of at most ``limit`` rows; errors as text."""
    try:
        parsed(spark, sql)
        df = spark.sql(sql, args=args)
        rows = df.limit(limit + 1).collect()
    except Exception as e:
        return f"Error: {str(e).splitlines()[0]}"

    def line(cells: list) -> str:
        """Bars and line ends in a cell are written so that they end no cell."""
        return "| " + " | ".join("" if v is None else re.sub("\r\n|\r|\n", "<br>", str(v).replace("\\", "\\\\").replace("|", "\\|")) for v in cells) + " |"

    out = [line(df.columns), "|" + " --- |" * len(df.columns)]
    out += [line(list(r)) for r in rows[:limit]]
    return "\n".join(out + ([f"Showing the first {limit} rows."] if len(rows) > limit else []))


def query_reserves(tables: dict[str, DataFrame], sql: str, limit: int = MAX_ROWS, args: dict | None = None) -> str:
    """``query`` over the reserves tables (``reserves.tables``, or stored ones), under their own names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    spark = next(iter(tables.values())).sparkSession
    return query(spark, sql, limit, args)


def list_tables(spark: SparkSession, registry: DataFrame) -> DataFrame:
    """The registry's tables with their row counts."""
    counts = [(r.table_name, spark.table(r.table_name).count()) for r in registry.select("table_name").collect() if spark.catalog.tableExists(r.table_name)]
    return registry.join(F.broadcast(spark.createDataFrame(counts, "table_name string, row_count long")), "table_name", "left")


def describe_table(columns: DataFrame, name: str) -> DataFrame:
    """The registry's columns of one table."""
    return columns.filter(F.col("table_name") == name).orderBy("ordinal_position")


def search_wells(properties: DataFrame, **like: str) -> DataFrame:
    """Properties whose columns contain the given texts, in any case."""
    for c, v in like.items():
        properties = properties.filter(F.lower(c).contains(v.lower()))
    return properties


def clone_case(cases: DataFrame, case_id: str, new_id: str, **changes) -> DataFrame:
    """``cases`` and a copy of one under a new id, with some columns changed."""
    copy = cases.filter(F.col("case_id") == case_id).withColumn("case_id", F.lit(new_id))
    return cases.unionByName(copy.withColumns({k: F.lit(v).cast(cases.schema[k].dataType) for k, v in changes.items()}))


def compare_cases(cases: DataFrame, left: str, right: str, measures: tuple[str, ...] = ("eur_oil_bbl", "eur_gas_mcf", "pv10", "npv")) -> DataFrame:
    """One row per measure: both cases' values and their difference."""
    two = F.broadcast(cases.filter(F.col("case_id").isin(left, right)))
    sides = [(F.max(F.when(F.col("case_id") == left, F.col(m))), F.max(F.when(F.col("case_id") == right, F.col(m)))) for m in measures]
    each = F.array(*(F.struct(F.lit(m).alias("measure"), a.alias("a"), b.alias("b")) for m, (a, b) in zip(measures, sides, strict=True)))
    return two.agg(each.alias("e")).select(F.inline("e")).withColumn("difference", F.col("b") - F.col("a"))
