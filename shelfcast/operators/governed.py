"""Governed read-only SQL over the approved marts, and canned questions.

Caller SQL runs in an isolated session (``newSession``: own temp views and
settings, no direct file reads) whose temp views expose only the approved
columns of the approved marts.  Spark's own parser and analyzer enforce the
rules; nothing here parses SQL text:

1. the text is wrapped as ``SELECT * FROM (\\n<sql>\\n)``, so DDL, DML,
   several statements or anything but a query fail to parse;
2. before any job runs, the analyzed plan (subqueries included) is walked:
   every leaf must sit under one of the approved temp views, so base tables,
   catalog-qualified names and files are rejected wherever they appear;
3. every expression must be of a class on an allow list: Spark's own
   functions of the groups in ``ALLOWED_GROUPS`` and the parts that plans are
   made of (``STRUCTURE``);
4. the optimized plan may hold no join without an equality between its sides
   (what would run as a nested loop or a Cartesian product, lateral joins
   included), unless one side has at most one row, and no generator or list
   of rows beyond ``MOST_GENERATED``;
5. the result is capped unless the caller's statement has a LIMIT of its own,
   wherever it stands.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import forecast_reads as fr
from . import kpis, scoring

# Approved marts and their columns.  dim_date's holiday-week
# column is not produced by the model, so it is left out.
APPROVED_MARTS: dict[str, tuple[str, ...]] = {
    "dim_store": ("store_id", "store_type", "store_size"),
    "dim_date": ("date_day", "year", "month", "week_of_year"),
    "fact_sales": ("store_id", "dept_id", "sales_date", "weekly_sales", "is_holiday"),
    "fact_inventory": ("store_id", "dept_id", "inventory_date", "available_inventory"),
    "fact_demand": ("store_id", "dept_id", "demand_date", "observed_demand", "available_inventory",
                    "safety_stock_units", "reorder_point_units"),
    "fact_forecast": ("store_id", "dept_id", "forecast_date", "horizon_days", "predicted_demand", "actual_demand",
                      "prediction_interval_lower", "prediction_interval_upper", "model_name", "model_version"),
    "fact_stockout_risk": ("store_id", "dept_id", "risk_date", "predicted_demand", "available_inventory",
                           "stockout_risk_score", "risk_category", "recommended_action", "model_version"),
    "fact_anomalies": ("store_id", "dept_id", "sales_date", "weekly_sales", "anomaly_score", "is_anomaly", "severity",
                       "direction", "model_version"),
}
DEFAULT_ROW_LIMIT = 100
# Leaves that read no stored data: constant rows, VALUES lists, ranges, and
# references to a WITH clause (whose definitions are walked as children of
# the WithCTE node).
HARMLESS_LEAVES = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef"}


class GovernedSqlError(ValueError):
    """The statement is not a read of the approved marts."""


def _seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


def referenced_views(df: DataFrame, allowed: set[str]) -> set[str]:
    """Walk the analyzed plan; return the approved views read, raise on any
    other data source and on expressions outside the allow list."""
    seen: set[str] = set()
    functions = allowed_functions(df.sparkSession)
    stack = [df._jdf.queryExecution().analyzed()]
    while stack:
        node = stack.pop()
        kind = node.getClass().getSimpleName()
        if kind == "View":
            ident = node.desc().identifier()
            name = str(ident.table()).lower()
            db = ident.database()
            if not node.isTempView() or name not in allowed or (db.isDefined() and str(db.get())):
                raise GovernedSqlError(f"relation {ident} is not an approved mart")
            seen.add(name)
            continue
        check_expressions(node, functions)
        children = _seq(node.children()) + _seq(node.subqueries())
        if not children and kind not in HARMLESS_LEAVES:
            raise GovernedSqlError(f"the query reads {kind}, which is not an approved mart")
        stack.extend(children)
    return seen


# Groups of Spark's function registry a query may call.
ALLOWED_GROUPS = {
    "agg_funcs", "bitwise_funcs", "conditional_funcs", "conversion_funcs", "datetime_funcs", "hash_funcs", "math_funcs",
    "predicate_funcs", "string_funcs", "struct_funcs", "window_funcs", "generator_funcs",
}
# Functions of these groups that make values of any size out of nothing.
UNBOUNDED = {"repeat", "space", "lpad", "rpad"}
# Classes that plans are made of, besides functions.
STRUCTURE = {
    "Alias", "AttributeReference", "OuterReference", "LateralSubquery", "Literal", "Cast", "SortOrder", "ScalarSubquery",
    "Exists", "ListQuery", "InSubquery", "AggregateExpression", "WindowExpression", "WindowSpecDefinition",
    "SpecifiedWindowFrame", "CurrentRow$", "UnboundedPreceding$", "UnboundedFollowing$", "UnspecifiedFrame$", "CaseWhen", "If",
    "In", "And", "Or", "Not", "GetStructField", "CreateArray", "CreateNamedStruct", "NamePlaceholder$", "GetArrayItem",
    "PromotePrecision", "CheckOverflow", "TimeAdd", "DateAddInterval", "MultiAlias", "Grouping", "GroupingID",
    "VirtualColumn$", "ExtractANSIIntervalDays", "TimestampAddInterval", "TimestampAddYMInterval", "DateAddYMInterval", "UpCast", "KnownNotNull", "LateralColumnAliasReference", "PredicateSubquery", "Collate", "ResolvedCollation",
}
# Code from outside Spark's own functions: not even inside what an allowed function is replaced by.
FOREIGN_CODE = {
    "CallMethodViaReflection", "TryReflect", "ScalaUDF", "ScalaUDAF", "ScalaAggregator", "PythonUDF", "PythonUDAF", "PythonUDTF",
    "HiveSimpleUDF", "HiveGenericUDF", "HiveGenericUDTF", "HiveUDAFFunction",
}
MOST_GENERATED = 100

_FUNCTIONS: dict[str, tuple] = {}


def allowed_functions(spark: SparkSession) -> tuple:
    """(classes a query may use, classes of all other registered functions, the
    type of functions that stand for another expression), by the groups of this
    Spark's registry; read once for an application."""
    app = spark.sparkContext.applicationId
    if app not in _FUNCTIONS:
        registry = spark._jsparkSession.sessionState().functionRegistry()
        good, bad = set(STRUCTURE), set()
        for name in _seq(registry.listFunction()):
            info = registry.lookupFunction(name)
            if info.isDefined():
                kind = info.get().getClassName().rsplit(".", 1)[-1]
                fits = info.get().getGroup() in ALLOWED_GROUPS and info.get().getName() not in UNBOUNDED
                # A builder makes an expression of another class.
                (good if fits else bad).update({kind, kind.removesuffix("Builder").removesuffix("Expression")})
        replaceable = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.RuntimeReplaceable")
        _FUNCTIONS[app] = good, (bad - good) | FOREIGN_CODE, replaceable
    return _FUNCTIONS[app]


def check_expressions(node, functions: tuple) -> None:
    """Reject expressions of a plan node that aren't on the allow list.

    Some functions stand for an expression of other classes (their only
    child then); those may be of any class of Spark's that isn't a function
    off the list or foreign code.
    """
    good, bad, replaceable = functions
    stack = [(e, False) for e in _seq(node.expressions())]
    while stack:
        e, inside = stack.pop()
        kind = e.getClass().getSimpleName()
        if kind in bad or kind not in good and not inside:
            raise GovernedSqlError(f"the function {e.prettyName()} is not allowed")
        replaced = inside or replaceable.isInstance(e)
        stack.extend((child, replaced) for child in _seq(e.children()))


def _size(option) -> int | None:
    return int(str(option.get())) if option.isDefined() else None


def check_plan(df: DataFrame) -> None:
    """Reject joins without an equality between their sides, and generators or
    made-up rows beyond ``MOST_GENERATED``, in the optimized plan."""
    equi = df.sparkSession._jvm.org.apache.spark.sql.catalyst.planning.ExtractEquiJoinKeys
    stack = [df._jdf.queryExecution().optimizedPlan()]
    while stack:
        node = stack.pop()
        kind = node.getClass().getSimpleName()
        if kind == "Join" and not equi.unapply(node).isDefined():
            sides = [_size(side.maxRows()) for side in (node.left(), node.right())]
            if not any(n is not None and n <= 1 for n in sides):
                raise GovernedSqlError("a join needs an equality between its sides")
        elif kind in ("LateralJoin", "CartesianProduct"):
            raise GovernedSqlError("a lateral join needs an equality between its sides")
        elif kind == "Generate":
            check_generator(node.generator())
        elif kind == "Range" and (_size(node.maxRows()) or 0) > MOST_GENERATED:
            raise GovernedSqlError(f"more than {MOST_GENERATED} made-up rows")
        stack.extend(_seq(node.children()) + _seq(node.subqueries()))


def check_generator(generator) -> None:
    """A generator must make a number of rows that its text fixes, at most ``MOST_GENERATED``."""
    kind, inputs = generator.getClass().getSimpleName(), _seq(generator.children())
    rows = None
    if kind == "Stack" and inputs[0].getClass().getSimpleName() == "Literal":
        rows = int(str(inputs[0].value()))
    elif len(inputs) == 1 and inputs[0].getClass().getSimpleName() == "CreateArray":
        rows = inputs[0].children().size()
    elif len(inputs) == 1 and inputs[0].getClass().getSimpleName() == "Literal" and inputs[0].value() is not None:
        rows = inputs[0].value().numElements()
    if rows is None or rows > MOST_GENERATED:
        raise GovernedSqlError(f"the generator {generator.prettyName()} needs a fixed list of at most {MOST_GENERATED} values")


def has_own_limit(df: DataFrame) -> bool:
    """Whether the caller's statement has a LIMIT anywhere (the marts' own plans aside)."""
    stack = [df._jdf.queryExecution().analyzed()]
    while stack:
        node = stack.pop()
        kind = node.getClass().getSimpleName()
        if kind in ("GlobalLimit", "LocalLimit"):
            return True
        if kind != "View":
            stack.extend(_seq(node.children()) + _seq(node.subqueries()))
    return False


def governed_session(spark: SparkSession, marts: dict[str, DataFrame]) -> SparkSession:
    """An isolated session whose temp views are the approved columns only.

    The approved projections are published once as application-wide global
    temp views under a private prefix; the isolated session's own temp views
    select from them.  Queries that name the global views directly are
    rejected by the plan walk (they are not the approved temp views).
    """
    import uuid

    iso = spark.newSession()
    iso.conf.set("spark.sql.runSQLOnFiles", "false")
    prefix = f"governed_{uuid.uuid4().hex[:12]}"
    db = spark.conf.get("spark.sql.globalTempDatabase", "global_temp")
    for name, cols in APPROVED_MARTS.items():
        if name in marts:
            marts[name].select(*cols).createOrReplaceGlobalTempView(f"{prefix}_{name}")
            iso.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM {db}.{prefix}_{name}")
    return iso


def governed_sql(iso: SparkSession, sql: str, row_limit: int = DEFAULT_ROW_LIMIT) -> DataFrame:
    """Run caller SQL under the rules above; a lazy DataFrame, capped when the
    caller's statement has no LIMIT."""
    text = sql.strip().rstrip(";").strip()
    if not text:
        raise GovernedSqlError("empty statement")
    try:
        df = iso.sql(f"SELECT * FROM (\n{text}\n)")
    except Exception as exc:  # parse or analysis error: not an allowed query
        raise GovernedSqlError(f"rejected: {str(exc).splitlines()[0][:200]}") from exc
    views = referenced_views(df, set(APPROVED_MARTS))
    if not views:
        raise GovernedSqlError("the query must read at least one approved mart")
    check_plan(df)
    return df if has_own_limit(df) else df.limit(int(row_limit))


def canned_questions() -> dict[str, Callable]:
    """The eight fixed business questions (I9), each ``warehouse -> DataFrame``."""
    return {
        "top_stockout_risk": lambda w: scoring.top_stockout(w.fact_stockout_risk),
        "risk_summary": lambda w: scoring.risk_summary(w.fact_stockout_risk),
        "anomaly_summary": lambda w: scoring.anomaly_summary(w.fact_anomalies),
        "forecast_accuracy": lambda w: fr.accuracy_by_version(w.fact_forecast),
        "top_stores": lambda w: kpis.top_stores(w.fact_sales, w.dim_store),
        "top_departments": lambda w: kpis.top_departments(w.fact_sales),
        "recent_trend": lambda w: kpis.recent_trend(w.fact_sales),
        "sales_totals": lambda w: kpis.sales_totals(w.fact_sales),
    }


def answer(w, question: str, row_limit: int = DEFAULT_ROW_LIMIT) -> DataFrame:
    """A canned question's result under the same row cap."""
    return canned_questions()[question](w).limit(int(row_limit))


def preview(df: DataFrame, max_rows: int = 12) -> DataFrame:
    """First rows for display: NaN as NULL, dates as ISO text, doubles to 4
    places (F9).  The projection runs before the rows leave the cluster."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(F.nanvl(c, F.lit(None).cast("double")), 4)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.limit(max_rows).select(*cols)
