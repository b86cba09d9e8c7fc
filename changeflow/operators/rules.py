"""Rules of a table: filters and transforms, in configured order, as one plan over its changes.

A rule class has ``apply(changes) -> DataFrame``; the engine chains those of the table, each seeing what
earlier ones made. Consecutive filters are one filter after optimisation, transforms are projections.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import model, pgtypes
from changeflow.functions.mask import mask
from changeflow.functions.regex import compile_rule
from changeflow.operators.predicates import OPERATORS, predicate


class Rule(Protocol):
    """What the engine takes; own rules implement it."""

    def apply(self, changes: DataFrame) -> DataFrame: ...


def _gate(operations: Iterable[str], skip_deletes: bool) -> Column | None:
    """Where a rule acts on a row; None if it acts on every change of data."""
    acts = [o for o in operations if not (skip_deletes and o == model.DELETE)]
    return F.col("_op").isin(*acts) if acts else F.lit(False)


@dataclass(frozen=True)
class FilterRule:
    """Drops changes whose value fails the predicate; a DELETE is judged on its old value."""

    column: str
    operator: str
    value: object
    operations: tuple[str, ...] = model.DATA_OPERATIONS
    allow_empty_deletes: bool = False
    typed: bool = False

    def condition(self, changes: DataFrame) -> Column:
        row = model.row_type(changes)

        def judge(side: str) -> Column:
            if self.column not in row.names:
                return F.lit(False)
            return predicate(model.field(side, self.column), row[self.column], self.operator, self.value, self.typed)

        deletes = model.DELETE in self.operations and not self.allow_empty_deletes
        others = [o for o in self.operations if o != model.DELETE]
        # Each side of the operation is a bare predicate on a stored field, which a scan can take.
        old = F.when(F.col("old").isNotNull(), judge("old")).otherwise(judge("new"))
        out = F.lit(False)
        if others:
            out = F.col("_op").isin(*others) & judge("new")
        if deletes:
            out = out | ((F.col("_op") == model.DELETE) & old)
        untouched = [o for o in model.OPERATIONS if o not in self.operations or o == model.DELETE and self.allow_empty_deletes]
        return out | F.col("_op").isin(*untouched) if untouched else out

    def apply(self, changes: DataFrame) -> DataFrame:
        return changes.where(self.condition(changes))


def _with_field(changes: DataFrame, side: str, name: str, value: Column, when: Column) -> DataFrame:
    """Replaces a field of ``new`` or ``old`` where the side is there and ``when`` holds; null sides stay null."""
    row = model.row_type(changes)
    made = F.struct(*[(F.when(when, value).otherwise(model.field(side, f.name)) if f.name == name else model.field(side, f.name)).cast(f.dataType).alias(f.name) for f in row])
    return changes.withColumn(side, F.when(F.col(side).isNotNull(), made))


@dataclass(frozen=True)
class RegexRule:
    """Replaces all matches in a text column; reads the new row, so it leaves a DELETE as it is."""

    column: str
    pattern: str
    replace: str
    operations: tuple[str, ...] = model.DATA_OPERATIONS
    allow_empty_deletes: bool = False
    compiled: tuple[str, str] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "compiled", compile_rule(self.pattern, self.replace))

    def apply(self, changes: DataFrame) -> DataFrame:
        row = model.row_type(changes)
        if self.column not in row.names or not pgtypes.is_text_like(row[self.column]):
            return changes
        value = F.regexp_replace(model.field("new", self.column).cast("string"), F.lit(self.compiled[0]), F.lit(self.compiled[1]))
        return _with_field(changes, "new", self.column, value, _gate(self.operations, self.allow_empty_deletes))


@dataclass(frozen=True)
class MaskRule:
    """Masks a text column between its first and last byte; in the old row of a DELETE, else in the new one."""

    column: str
    mask_char: str
    operations: tuple[str, ...] = model.DATA_OPERATIONS
    allow_empty_deletes: bool = False

    def apply(self, changes: DataFrame) -> DataFrame:
        row = model.row_type(changes)
        if self.column not in row.names or not pgtypes.is_text_like(row[self.column]):
            return changes
        gate, is_delete = _gate(self.operations, self.allow_empty_deletes), F.col("_op") == model.DELETE
        made = _with_field(changes, "new", self.column, mask(model.field("new", self.column).cast("string"), self.mask_char), gate & ~is_delete)
        if model.DELETE in self.operations and not self.allow_empty_deletes:
            made = _with_field(made, "old", self.column, mask(model.field("old", self.column).cast("string"), self.mask_char), is_delete)
        return made


@dataclass(frozen=True)
class ExcludeRule:
    """Drops columns from the changes (an extension)."""

    columns: tuple[str, ...]

    def apply(self, changes: DataFrame) -> DataFrame:
        return changes.withColumns({s: F.col(s).dropFields(*[f"`{c}`" for c in self.columns]) for s in ("new", "old")})


@dataclass(frozen=True)
class RuleConfig:
    """One rule as a configuration file has it; ``operations`` and ``allow_empty_deletes`` may stand here or among the parameters."""

    type: str
    column: str = ""
    parameters: Mapping[str, object] = field(default_factory=dict)
    operations: tuple[str, ...] = ()
    allow_empty_deletes: bool = False


def build(config: RuleConfig | Mapping[str, object]) -> Rule:
    """The rule of a configuration; errors in it are raised here, before any data is read."""
    if isinstance(config, Mapping):
        unknown = set(config) - {"type", "column", "parameters", "operations", "allow_empty_deletes"}
        if unknown:
            raise ValueError(f"unknown rule settings: {sorted(unknown)}")
        config = RuleConfig(**{**config, "operations": tuple(config.get("operations") or ())})
    p = dict(config.parameters or {})
    operations = tuple(config.operations or p.get("operations") or model.DATA_OPERATIONS)
    if bad := [o for o in operations if o not in model.OPERATIONS]:
        raise ValueError(f"unknown operations: {bad}")
    gates = {"operations": operations, "allow_empty_deletes": bool(config.allow_empty_deletes or p.get("allow_empty_deletes"))}

    def need(name: str, kind: type | tuple = str) -> object:
        if not isinstance(p.get(name), kind):
            raise ValueError(f"a rule of type {config.type} on {config.column!r} lacks {name}, or has it in another form")
        return p[name]

    if config.type == "filter":
        operator = need("operator")
        if "value" not in p:
            raise ValueError(f"the filter on {config.column!r} has nothing to compare with")
        if operator not in OPERATORS:
            raise ValueError(f"{operator!r} is none of the operators {sorted(OPERATORS)}")
        return FilterRule(config.column, operator, p["value"], typed=bool(p.get("typed")), **gates)
    if config.type == "transform":
        kind = need("type")
        if kind == "regex":
            return RegexRule(config.column, need("pattern"), need("replace"), **gates)
        if kind == "mask":
            return MaskRule(config.column, need("mask_char"), **gates)
        raise ValueError(f"transforms are regex and mask, not {kind!r}")
    if config.type == "exclude_columns":
        return ExcludeRule(tuple(need("columns", (list, tuple))))
    raise ValueError(f"rules are filter, transform and exclude_columns, not {config.type!r}")


class RuleEngine:
    """The rules of each table; tables may be named with or without schema."""

    def __init__(self, tables: Mapping[str, Iterable[RuleConfig | Mapping[str, object]]] | None = None) -> None:
        self.rules: dict[str, list[Rule]] = {t: [build(c) for c in configs or ()] for t, configs in (tables or {}).items()}

    def add(self, table: str, rule: Rule) -> None:
        self.rules.setdefault(table, []).append(rule)

    def of(self, table: str, schema: str = "public") -> list[Rule]:
        return self.rules.get(f"{schema}.{table}") or self.rules.get(table) or []

    def apply(self, changes: DataFrame, table: str, schema: str = "public") -> DataFrame:
        """The changes that the table's rules let through, transformed; without rules the changes themselves."""
        for rule in self.of(table, schema):
            changes = rule.apply(changes)
        return changes
