"""The read-only SQL surface, and the rendering of its results."""

from __future__ import annotations

import base64
import datetime as dt
import decimal
import json
import math
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import DecimalType, LongType, StructType


def statements(sql: str) -> list[str]:
    """Statements of a text, split at semicolons outside of quotes and comments."""
    masked = re.sub(r"--[^\n]*|/\*.*?\*/", " ", re.sub(r"'(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`", lambda m: "q" * len(m[0]), sql), flags=re.S)
    return [s for s in masked.split(";") if s.strip()]


#: Functions that reach outside of the data, or change something.
REFUSED_FUNCTIONS = ("reflect", "java_method", "try_reflect", "read_files", "from_avro_file", "input_file_name", "current_user", "session_user", "user")
_SUBQUERIES = {"ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression"}
#: Nodes of a parsed query that do more than read.
_FORBIDDEN = re.compile(r"Insert|Create|Drop|Alter|Delete|Update|Merge|Set(?!Operation)|Cache|Refresh|Load|Truncate|Command|Execute|CallStatement|Overwrite|Append|ScriptTransformation|StreamingRelation")


def accept(sql: str, spark: SparkSession | None = None, relations: Sequence[str] | None = None, describing: bool = False) -> None:
    """Refuse all but one SELECT or WITH (with describing also DESCRIBE of one).

    With a session the parsed plan is walked too: names in FROM must be among the relations, or defined by WITH; paths
    as relations, table functions but range and explode's kin, scripts, and functions that call into the JVM are refused."""
    parts = statements(sql)
    if len(parts) != 1 or ";" in parts[0]:
        raise ValueError("exactly one statement is accepted")
    word = re.match(r"\s*\(*\s*([A-Za-z]+)", parts[0])
    allowed = {"select", "with"} | ({"describe"} if describing else set())
    if not word or word[1].lower() not in allowed:
        raise ValueError(f"only {', '.join(sorted(allowed)).upper()} are accepted")
    if re.search(r"\binsert\s+(into|overwrite)\b", parts[0], re.I):
        raise ValueError("a WITH statement may not insert")
    if spark is not None:
        body = re.sub(r"(?is)^\s*describe\s+(query\s+)?", "", sql) if word[1].lower() == "describe" else sql
        _walk(spark, body.rstrip().rstrip(";"), {r.lower() for r in relations or ()})


def _walk(spark: SparkSession, sql: str, relations: set[str]) -> None:
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)

    def seq(xs) -> list:
        return [xs.apply(i) for i in range(xs.size())]

    def expressions(x) -> Iterator:
        yield x
        for child in seq(x.children().toSeq()):
            yield from expressions(child)

    def visit(node, known: set[str]) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedWith":
            for pair in seq(node.cteRelations().toSeq()):
                # A definition sees those before it.
                visit(pair.productElement(1), known)
                known = known | {str(pair.productElement(0)).lower()}
            visit(node.child(), known)
            return
        if _FORBIDDEN.search(kind):
            raise ValueError(f"{kind} is not read-only")
        if kind == "UnresolvedRelation":
            name = ".".join(seq(node.multipartIdentifier().toSeq()))
            if name.lower() not in known:
                raise ValueError(f"{name} is no relation of this store")
        if kind == "UnresolvedTableValuedFunction":
            name = ".".join(seq(node.name().toSeq()))
            if name.lower() not in ("range", "explode", "explode_outer", "posexplode", "inline", "stack"):
                raise ValueError(f"the table function {name} is refused")
        for e in seq(node.expressions().toSeq()):
            for x in expressions(e):
                name = x.getClass().getSimpleName()
                if name == "UnresolvedFunction" and ".".join(seq(x.nameParts().toSeq())).lower().split(".")[-1] in REFUSED_FUNCTIONS:
                    raise ValueError(f"{'.'.join(seq(x.nameParts().toSeq()))} is refused")
                if name in _SUBQUERIES:
                    visit(x.plan(), known)
                elif "Subquery" in name and name != "InSubquery":  # that one's query is a child of its own
                    raise ValueError(f"{name} is refused")
        for child in seq(node.children().toSeq()):
            visit(child, known)

    visit(plan, relations)


def render_value(value, kind=None):
    """A JSON value: 64-bit integers and decimals as text, non-finite numbers null, binary as base64."""
    if value is None:
        return None
    if isinstance(kind, LongType | DecimalType) or isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, bytes | bytearray):
        return base64.b64encode(bytes(value)).decode()
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
        if value.microsecond:
            text += f".{value.microsecond:06d}".rstrip("0")
        return text + ("+00" if value.tzinfo else "")
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, dt.timedelta):
        return str(value)
    if isinstance(value, Row):
        fields = kind.fields if isinstance(kind, StructType) else [None] * len(value)
        return {k: render_value(v, f and f.dataType) for (k, v), f in zip(value.asDict().items(), fields, strict=True)}
    if isinstance(value, dict):
        return {str(k): render_value(v, getattr(kind, "valueType", None)) for k, v in value.items()}
    if isinstance(value, list):
        return [render_value(v, getattr(kind, "elementType", None)) for v in value]
    return value


def render(df: DataFrame) -> Iterator[str]:
    """Rows as JSON texts, one partition at a time."""
    for row in df.toLocalIterator(prefetchPartitions=True):
        yield json.dumps({f.name: render_value(row[i], f.dataType) for i, f in enumerate(df.schema.fields)}, ensure_ascii=False)
