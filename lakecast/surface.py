"""SQL over registered tables: describe, sample, and run a SELECT that may come wrapped in prose."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_ROWS = 5


def register(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def describe(df: DataFrame) -> DataFrame:
    """Name, type and mode (NULLABLE or REQUIRED) of each column."""
    rows = [
        (f.name, f.dataType.simpleString(), "NULLABLE" if f.nullable else "REQUIRED")
        for f in df.schema.fields
    ]
    return df.sparkSession.createDataFrame(rows, "name string, type string, mode string")


def sample_rows(df: DataFrame, *order_by: str, limit: int = SAMPLE_ROWS) -> DataFrame:
    """A few rows; the same ones each time if ``order_by`` is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(limit)


_START = re.compile(r"^[ \t]*(select\b|with\s+\w+\s*(\([^)]*\)\s*)?as\s*\()", re.IGNORECASE | re.MULTILINE)


def extract_select(text: str) -> str:
    """The SELECT inside free text: a fenced sql block first, else from the first line on that starts a SELECT or its WITH.

    Raises ValueError when there is none.
    """
    fenced = re.search(r"```sql\s*\n(.*?)\n?```", text, re.DOTALL | re.IGNORECASE)
    body = fenced.group(1) if fenced else text
    start = _START.search(body)
    if start is None:
        raise ValueError("only queries that start with SELECT are accepted")
    return body[start.start() :].strip().rstrip(";").rstrip()


def _items(found) -> list:
    """A Scala sequence as a list."""
    return [found.apply(i) for i in range(found.size())]


def check_query(spark: SparkSession, text: str) -> None:
    """Raises ValueError unless ``text`` is one query that reads registered views only.

    Spark's own parser decides: a command, an insert or a second statement is no query, and every relation has to be a view of
    this session or a name from the query's WITH. A path as a table has two parts and is never a view.
    """
    jvm = spark.sparkContext._jvm
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as error:
        raise ValueError("this is not one query") from error
    plans = "org.apache.spark.sql.catalyst"
    kinds = {
        name: jvm.java.lang.Class.forName(f"{plans}.{place}", True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
        for name, place in {
            "command": "plans.logical.Command",
            "statement": "plans.logical.ParsedStatement",
            "relation": "analysis.UnresolvedRelation",
            "with": "plans.logical.UnresolvedWith",
            "function": "analysis.UnresolvedTableValuedFunction",
        }.items()
    }
    views = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    waiting = [(plan, frozenset())]
    while waiting:
        node, named = waiting.pop()
        if kinds["command"].isInstance(node) or kinds["statement"].isInstance(node):
            raise ValueError("only queries are accepted, no commands")
        if kinds["function"].isInstance(node):
            raise ValueError("table functions are not accepted")
        if kinds["relation"].isInstance(node):
            name = ".".join(_items(node.multipartIdentifier())).lower()
            if node.multipartIdentifier().size() != 1 or name not in views | named:
                raise ValueError(f"{name} is not a registered view")
        if kinds["with"].isInstance(node):
            for definition in _items(node.cteRelations()):
                waiting.append((definition._2(), named))
                named = named | {definition._1().lower()}
        waiting += [(child, named) for child in [*_items(node.children()), *_items(node.subqueries())]]


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """Run one SELECT on the registered views; the result stays a DataFrame. See ``check_query`` for what is refused."""
    query = extract_select(text)
    check_query(spark, query)
    return spark.sql(query)


def with_calendar_parts(df: DataFrame, time: str) -> DataFrame:
    """Year, month, week number and date of the time column, as the question-answering table has."""
    t = F.col(time)
    return df.withColumns(
        {
            "year": F.year(t),
            "month": F.month(t),
            "week_number": F.weekofyear(t),
            "date": F.to_date(t),
        }
    )
