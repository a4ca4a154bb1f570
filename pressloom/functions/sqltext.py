"""Large expressions as SQL text.

The page expressions hold thousands of nodes.  Built with ``Column`` each node is
several calls into the JVM, which took most of a minute per plan; written as text
and handed to ``expr`` once, the same tree takes milliseconds.  ``Sql`` has the
operators of ``Column`` and ``F`` the functions of ``pyspark.sql.functions``, so
the expressions read the same.
"""

from __future__ import annotations

import datetime as dt
import functools
import inspect
import itertools
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as spark_functions

_names = itertools.count()


# Binding strength of SQL operators; brackets are written only where needed, as the
# parser is slow on nested ones.
RANK = {"OR": 1, "AND": 2, "NOT": 3, "TEST": 4, "+": 5, "-": 5, "*": 6, "/": 6, "%": 6}
ATOM = 9


class Sql:
    """The text of one SQL expression."""

    def __init__(self, text: str, name: str | None = None, rank: int = ATOM) -> None:
        self.text = text
        self.name = name
        self.rank = rank  # binding strength of the outermost operator

    __hash__ = None  # type: ignore[assignment]

    def __eq__(self, other: Any) -> "Sql":  # type: ignore[override]
        return _infix(self, "=", other)

    def __ne__(self, other: Any) -> "Sql":  # type: ignore[override]
        return _infix(self, "<>", other)

    def __invert__(self) -> "Sql":
        return Sql(f"NOT {self.at(RANK['NOT'])}", rank=RANK["NOT"])

    def __neg__(self) -> "Sql":
        return Sql(f"(- {self.at(ATOM)})")

    def __rsub__(self, other: Any) -> "Sql":
        return _infix(sql(other), "-", self)

    def alias(self, name: str) -> "Sql":
        return Sql(self.text, name, self.rank)

    def at(self, rank: int) -> str:
        """The text for a place that binds at least as strongly as ``rank``."""
        return self.text if self.rank >= rank else f"({self.text})"

    def getField(self, name: str) -> "Sql":  # noqa: N802 - Column's name
        base = self.text if re.fullmatch(r"[\w.`]+", self.text) else f"({self.text})"
        return Sql(f"{base}.`{name}`")

    def isNull(self) -> "Sql":  # noqa: N802
        return Sql(f"{self.at(RANK['TEST'] + 1)} IS NULL", rank=RANK["TEST"])

    def isNotNull(self) -> "Sql":  # noqa: N802
        return Sql(f"{self.at(RANK['TEST'] + 1)} IS NOT NULL", rank=RANK["TEST"])

    def rlike(self, pattern: str) -> "Sql":
        return _infix(self, "RLIKE", pattern)

    def startswith(self, other: Any) -> "Sql":
        return F.startswith(self, other)

    def endswith(self, other: Any) -> "Sql":
        return F.endswith(self, other)

    def isin(self, *values: Any) -> "Sql":
        values = values[0] if len(values) == 1 and isinstance(values[0], list) else values
        return Sql(f"{self.at(RANK['TEST'] + 1)} IN ({', '.join(sql(v).text for v in values)})", rank=RANK["TEST"])

    def between(self, low: Any, high: Any) -> "Sql":
        inner = RANK["TEST"] + 1
        return Sql(f"{self.at(inner)} BETWEEN {sql(low).at(inner)} AND {sql(high).at(inner)}", rank=RANK["TEST"])

    def cast(self, kind: str) -> "Sql":
        return Sql(f"CAST({self.text} AS {kind})")

    def try_cast(self, kind: str) -> "Sql":
        return Sql(f"TRY_CAST({self.text} AS {kind})")


class _Case(Sql):
    """``CASE`` under construction; complete at every step."""

    def __init__(self, branches: list[tuple[Any, Any]], default: Any = None) -> None:
        steps = " ".join(f"WHEN {sql(c).text} THEN {sql(v).text}" for c, v in branches)
        super().__init__(f"CASE {steps} ELSE {sql(default).text} END")
        self._branches = branches

    __hash__ = None  # type: ignore[assignment]

    def when(self, condition: Any, value: Any) -> "_Case":
        return _Case([*self._branches, (condition, value)])

    def otherwise(self, value: Any) -> "_Case":
        return _Case(self._branches, value)


def _infix(left: Any, op: str, right: Any) -> Sql:
    rank = RANK.get(op, RANK["TEST"])
    loose = rank if op in RANK else rank + 1
    return Sql(f"{sql(left).at(loose)} {op} {sql(right).at(rank + (op not in ('AND', 'OR')))}", rank=rank)


for _method, _op in {
    "__lt__": "<", "__le__": "<=", "__gt__": ">", "__ge__": ">=", "__add__": "+", "__sub__": "-", "__mul__": "*",
    "__truediv__": "/", "__mod__": "%", "__and__": "AND", "__or__": "OR",
}.items():
    setattr(Sql, _method, lambda self, other, op=_op: _infix(self, op, other))


def literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, dt.datetime):
        zone = ""
        if value.tzinfo:
            value, zone = value.astimezone(dt.timezone.utc), "+00:00"
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}{zone}'"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql(value: Any) -> Sql:
    """Text of a value: SQL as it is, a plain column by its name, anything else as a literal."""
    if isinstance(value, Sql):
        return value
    if isinstance(value, Column):
        name = re.fullmatch(r"Column<'([A-Za-z_][\w.]*)'>", str(value))
        if not name:
            raise TypeError(f"give {value} a name with withColumn first")
        return Sql(name[1])
    return Sql(literal(value))


class _Functions:
    """SQL functions by name; the few whose Python form differs are spelled out."""

    def __getattr__(self, name: str) -> Callable[..., Sql]:
        def call(*args: Any) -> Sql:
            return Sql(f"{name}({', '.join(sql(a).text for a in args)})")

        return call

    @staticmethod
    def col(name: str) -> Sql:
        return Sql(name)

    @staticmethod
    def lit(value: Any) -> Sql:
        return sql(value)

    @staticmethod
    def when(condition: Any, value: Any) -> _Case:
        return _Case([(condition, value)])

    @staticmethod
    def struct(*fields: Sql) -> Sql:
        return Sql("named_struct(" + ", ".join(f"'{f.name}', {f.text}" for f in fields) + ")")

    @staticmethod
    def nothing(kind: str = "string") -> Sql:
        return Sql(f"CAST(NULL AS {kind})")

    @staticmethod
    def empty(kind: str = "string") -> Sql:
        return Sql(f"CAST(array() AS array<{kind}>)")

    @staticmethod
    def _lambda(body: Callable[..., Any]) -> str:
        names = [f"{p}{next(_names)}" for p in inspect.signature(body).parameters]
        inner = sql(body(*map(Sql, names))).text
        return f"{names[0]} -> {inner}" if len(names) == 1 else f"({', '.join(names)}) -> {inner}"

    def transform(self, array: Any, body: Callable[..., Any]) -> Sql:
        return Sql(f"transform({sql(array).text}, {self._lambda(body)})")

    def filter(self, array: Any, body: Callable[..., Any]) -> Sql:
        return Sql(f"filter({sql(array).text}, {self._lambda(body)})")

    def exists(self, array: Any, body: Callable[..., Any]) -> Sql:
        return Sql(f"exists({sql(array).text}, {self._lambda(body)})")

    def aggregate(self, array: Any, start: Any, step: Callable[..., Any]) -> Sql:
        return Sql(f"aggregate({sql(array).text}, {sql(start).text}, {self._lambda(step)})")


F = _Functions()


def column(text: Sql) -> Column:
    """The finished expression as a column."""
    return spark_functions.expr(text.text)


def column_function(body: Callable[..., Any]) -> Callable[..., Any]:
    """Let a text expression be called with columns too: columns in, a column out."""

    @functools.wraps(body)
    def call(*args: Any, **named: Any) -> Any:
        given = [*args, *named.values()]
        if not any(isinstance(a, Column) for a in given):
            return body(*args, **named)
        text = lambda a: sql(a) if isinstance(a, Column) else a
        out = body(*map(text, args), **{k: text(v) for k, v in named.items()})
        return column(out)

    return call


def strip(text: Sql) -> Sql:
    """Trim all Unicode white space."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def let(value: Any, body: Callable[[Sql], Any]) -> Sql:
    """Evaluate ``value`` once and use it as often as ``body`` likes."""
    return F.get(F.transform(F.array(value), body), 0)


def filled(value: Any) -> Sql:
    """The value, or NULL for ''."""
    return let(value, lambda v: F.when(v != "", v))


def first(values: Any, test: Callable[[Sql], Any] | None = None) -> Sql:
    """First element that passes ``test`` (by default: is not NULL)."""
    return F.get(F.filter(values, test or (lambda v: v.isNotNull())), 0)
