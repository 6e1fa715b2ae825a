"""Metrics and quality rules given as rows of a table.

A metric row names a kind of aggregate, a value and an optional condition, both SQL
expressions over the columns of one journey; a rule row names the predicate of a failing
journey. Rows are checked against the columns they will read before anything runs, and
become the same ``MetricSpec`` / ``Rule`` objects as the built-in ones, so they are computed in
the same scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from .. import config as C
from .metrics import METRICS, MetricSpec, gated, rate, share

METRIC_SCHEMA = ("name string, label string, unit string, kind string, value string, condition string, "
                 "lower_is_better boolean, compare_as_points boolean, floor double")
RULE_SCHEMA = "name string, label string, category string, fails string"
UNITS = ("count", "score", "percent", "minutes", "hours")
MOST_ROWS = 500     # of a definition table: it becomes expressions of one plan
_NAME = re.compile(r"[a-z][a-z0-9_]*")

# kind -> (type of its value, aggregate of a value that is NULL outside the condition)
_NUMERIC = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}
KINDS = ("count", "distinct", "rate", "share", *_NUMERIC)


@dataclass(frozen=True)
class Rule:
    """A quality rule: ``fails`` is true for a failing journey."""
    key: str
    label: str
    category: str
    fails: Column


def _rows(table: DataFrame, what: str) -> list:
    rows = table.limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS:
        raise ValueError(f"More than {MOST_ROWS} {what} definitions")
    names = [r["name"] for r in rows]
    wrong = [n for n in names if not n or not _NAME.fullmatch(n)]
    if wrong:
        raise ValueError(f"Not a {what} name: {wrong}")
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"Several {what} definitions of: {twice}")
    return rows


def _expression(over: DataFrame, name: str, text: str, wanted: type | None) -> Column:
    """``text`` as a column, if it reads one row of ``over`` and has the wanted type."""
    try:
        column = F.expr(text)
        # A filter allows no aggregate, window or generator, an aggregate nothing that differs between runs.
        over.where(column.isNotNull()).agg(F.count(column)).schema
        kind = over.select(column.alias("value")).schema["value"].dataType
    except (AnalysisException, ParseException) as e:
        raise ValueError(f"{name}: not an expression over one journey: {text} ({e.getCondition()})") from e
    if wanted and not isinstance(kind, wanted):
        raise ValueError(f"{name}: {text} is {kind.simpleString()}")
    return column


def _builder(kind: str, value: Column | None, condition: Column | None):
    def build(cond: Column | None) -> Column:
        inside = condition if cond is None else cond if condition is None else cond & condition
        if kind == "count":
            return F.count(gated(inside, F.lit(1)))
        if kind == "rate":
            return rate(value, inside)
        if kind == "share":
            return share(value, inside)
        if kind == "distinct":
            return F.count_distinct(gated(inside, value))
        return _NUMERIC[kind](gated(inside, value))
    return build


def read_metrics(table: DataFrame, journeys: DataFrame) -> dict[str, MetricSpec]:
    """The built-in metrics and those of ``table`` (``METRIC_SCHEMA``), checked against ``journeys``.

    ``count`` takes no value; ``rate`` (of the known ones) and ``share`` (of all) take a boolean; ``distinct``
    takes any value; ``sum``, ``avg``, ``min`` and ``max`` a number. ``floor`` is the least move
    that an anomaly scan reports (NULL: 0). A NULL label is the name, NULL flags are false. Raises
    ValueError for a wrong row; an empty table gives the built-in metrics.
    """
    out = dict(METRICS)
    for r in _rows(table, "metric"):
        name, kind = r["name"], r["kind"]
        if name in METRICS or name in C.RESERVED_METRICS or name in journeys.columns:
            raise ValueError(f"{name} is a built-in name or a column")
        if kind not in KINDS:
            raise ValueError(f"{name}: unsupported kind {kind}")
        if r["unit"] not in UNITS:
            raise ValueError(f"{name}: unsupported unit {r['unit']}")
        if (r["value"] is None) != (kind == "count"):
            raise ValueError(f"{name}: {'no value' if kind != 'count' else 'a value'} for {kind}")
        wanted = BooleanType if kind in ("rate", "share") else NumericType if kind in _NUMERIC else None
        value = None if r["value"] is None else _expression(journeys, name, r["value"], wanted)
        condition = None if r["condition"] is None else _expression(journeys, name, r["condition"], BooleanType)
        out[name] = MetricSpec(name, r["label"] or name, r["unit"], _builder(kind, value, condition),
                               bool(r["compare_as_points"]), bool(r["lower_is_better"]), r["floor"] or 0.0)
    return out


def read_rules(table: DataFrame, raw: DataFrame) -> tuple[Rule, ...]:
    """The quality rules of ``table`` (``RULE_SCHEMA``), checked against the raw journeys. A predicate
    that is NULL doesn't fail. Raises ValueError for a wrong row."""
    out = []
    for r in _rows(table, "rule"):
        name = r["name"]
        if name in C.RESERVED_RULES or name.startswith("present_") or name in raw.columns:
            raise ValueError(f"{name} is a built-in name or a column")
        if r["category"] not in C.QUALITY_CATEGORY_WEIGHTS:
            raise ValueError(f"{name}: unsupported category {r['category']}")
        if r["fails"] is None:
            raise ValueError(f"{name}: no predicate")
        out.append(Rule(name, r["label"] or name, r["category"],
                        _expression(raw, name, r["fails"], BooleanType)))
    return tuple(out)
