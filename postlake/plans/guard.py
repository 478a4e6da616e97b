"""What SQL a caller may run: reading the mailbox's relations, nothing else."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession

from postlake.errors import UnsupportedError

#: The words a query may begin with.
FIRST_WORDS = frozenset("select with describe summarize show explain pragma table".split())
#: Functions by the group Spark lists them under. Its group of all sorts holds what calls the JVM, reads files and reports on
#: the host: of that only names that begin as here.
FUNCTION_GROUPS = frozenset("math agg generator datetime array string map predicate bitwise variant window json conversion lambda conditional st csv url hash struct collection".split())
OTHER_FUNCTIONS = ("typeof", "uuid", "bitmap_", "hll_", "kll_", "theta_", "approx_top_k")
TABLE_FUNCTIONS = frozenset("range explode explode_outer posexplode posexplode_outer inline inline_outer stack json_tuple".split())
#: Logical nodes that may occur in a parsed query; whatever is not here is refused.
ALLOWED_NODES = frozenset(
    (
        "Project Filter Aggregate Join Sort GlobalLimit LocalLimit Limit Offset Distinct Deduplicate Union Intersect Except SubqueryAlias Generate Window WindowExpression LateralJoin Pivot Unpivot Sample Expand"
        " UnresolvedWith UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedHaving UnresolvedInlineTable UnresolvedOrderBy UnresolvedTableValuedFunction UnresolvedTVFAliases UnresolvedTableAlias OneRowRelation WithWindowDefinition CTE CTERelationDef CTERelationRef"
        " ParameterizedQuery NameParameterizedQuery PosParameterizedQuery UnionLoop UnionLoopRef ResolvedInlineTable LocalRelation Range WithCTE Tail"
        " ExplainCommand ShowTables ShowColumns ShowFunctions DescribeRelation DescribeColumn DescribeQueryCommand DescribeFunction UnresolvedTableOrView UnresolvedNamespace UnresolvedFunctionName CurrentNamespace LateralSubquery ShowTablesCommand"
    ).split()
)


def check_read_only(sql: str) -> str:
    """The text without its final semicolons, or an error.

    The first word, up to white space or a bracket, must be one of FIRST_WORDS; a semicolon anywhere
    else is refused, also one inside a literal; so is a comment at the start.
    """
    text = sql.strip()
    while text.endswith(";"):
        text = text[:-1].rstrip()
    if ";" in text:
        raise UnsupportedError("one statement only: a semicolon is not allowed inside a query")
    m = re.match(r"[\s(]*([^\s(]*)", text)
    word = m.group(1).lower()
    if word not in FIRST_WORDS:
        raise UnsupportedError(f"only read-only queries are allowed, not {word or 'an empty text'!r}")
    return text


#: Expressions that hold a plan.
_SUBQUERIES = frozenset("ScalarSubquery Exists ListQuery LateralSubquery FunctionTableSubqueryArgumentExpression".split())


def _each(seq) -> Iterator:
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


@functools.lru_cache(maxsize=1)
def _functions() -> frozenset[str]:
    """Names of Spark's own functions that a query may call."""
    registry = SparkSession.getActiveSession()._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin()
    out = set()
    for f in _each(registry.listFunction()):
        name, info = f.funcName().lower(), registry.lookupFunction(f)
        group = info.get().getGroup().removesuffix("_funcs") if info.isDefined() else ""
        if group in FUNCTION_GROUPS or (group == "misc" and name.startswith(OTHER_FUNCTIONS)):
            out.add(name)
    return frozenset(out)


def check_plan(spark: SparkSession, sql: str, relations: frozenset[str]) -> None:
    """Parse with the session's parser; refuse foreign plan nodes, relations and functions.

    A keyword check alone lets through scripts (TRANSFORM), WITH ... INSERT, java_method and paths as
    tables; this looks at what was parsed. A name of a WITH clause counts where the clause reaches: its own
    query, the clauses after it and what those hold.
    """
    _check(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql), relations, frozenset(), _functions())


def _check(node, relations: frozenset[str], named: frozenset[str], functions: frozenset[str]) -> None:
    name = node.nodeName().rstrip("$").removesuffix(" All")
    again = lambda x, scope=named: _check(x, relations, scope, functions)
    if name == "UnresolvedWith":
        for cte in _each(node.cteRelations()):
            own = frozenset((cte._1().lower(),))
            again(cte._2(), named | own if node.allowRecursion() else named)
            named = named | own
        again(node.child(), named)
        return
    if name in ("UnresolvedRelation", "UnresolvedTableOrView"):
        parts = node.multipartIdentifier().mkString(".")
        if parts.lower() not in relations | named:
            raise UnsupportedError(f"no such relation: {parts}")
    elif name == "UnresolvedTableValuedFunction":
        called = node.name().mkString(".").lower()
        if called not in relations | TABLE_FUNCTIONS:
            raise UnsupportedError(f"no such table function: {called}")
    elif name not in ALLOWED_NODES:
        raise UnsupportedError(f"{name} is not allowed in a query")
    if name == "ExplainCommand":
        again(node.logicalPlan())
    if name == "DescribeQueryCommand":
        again(node.plan())
    for part in (node.children(), node.innerChildren()):
        for child in _each(part):
            if hasattr(child, "nodeName") and hasattr(child, "innerChildren"):
                again(child)
    todo = list(_each(node.expressions()))
    while todo:
        e = todo.pop()
        kind = e.getClass().getSimpleName()
        if kind in ("UnresolvedFunction", "UnresolvedGenerator"):
            called = e.nameParts().mkString(".").lower() if kind == "UnresolvedFunction" else e.name().funcName().lower()
            if called not in functions:
                raise UnsupportedError(f"{called} is not allowed in a query")
        # Subqueries hold plans of their own.
        if kind in _SUBQUERIES:
            again(e.plan())
        todo.extend(_each(e.children()))
