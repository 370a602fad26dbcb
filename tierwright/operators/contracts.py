"""Layer contracts: which columns a table has, and what holds for their values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwright.functions.literals import empty_frame, small_frame
from tierwright.functions.values import sql_text

VIOLATIONS_SCHEMA = "contract string, column_name string, rule string, violations bigint"


class ContractError(RuntimeError):
    """A table does not meet its contract.  ``violations`` lists the breaches."""

    def __init__(self, contract: str, violations: Sequence[tuple[str, str, int]]):
        self.contract = contract
        self.violations = list(violations)
        listed = ", ".join(f"{column}: {rule} ({n})" for column, rule, n in self.violations)
        super().__init__(f"{contract} is violated: {listed}")


@cache
def data_type(ddl: str) -> T.DataType:
    return T.DataType.fromDDL(ddl)


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str = "string"
    nullable: bool = False
    unique: bool = False
    domain: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[ColumnRule, ...]
    ordered: bool = False
    strict: bool = True

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, data_type(c.type), c.nullable) for c in self.columns]
        )

    def derive(self, name: str, changes: Mapping[str, Mapping] | None = None, **kwargs) -> Contract:
        """A contract like this one, with some column rules changed."""
        changes = changes or {}
        columns = tuple(replace(c, **changes.get(c.name, {})) for c in self.columns)
        return replace(self, name=name, columns=columns, **kwargs)


def structural_violations(schema: T.StructType, contract: Contract) -> list[tuple[str, str, int]]:
    """Missing, unexpected, mistyped and misplaced columns; reads no data."""
    actual = {f.name: f.dataType for f in schema}
    found = []
    for rule in contract.columns:
        if rule.name not in actual:
            found.append((rule.name, "missing", 1))
        elif actual[rule.name] != data_type(rule.type):
            found.append((rule.name, "type", 1))
    if contract.strict:
        found += [(n, "unexpected", 1) for n in actual if n not in contract.names]
    if contract.ordered and not found and list(actual) != contract.names:
        pairs = zip(actual, contract.names)
        found += [(have, "order", 1) for have, want in pairs if have != want]
    return found


def _rule_tests(contract: Contract, present: Iterable[str]) -> dict[tuple[str, str], str]:
    """SQL condition under which a row breaks each null or domain rule."""
    present = set(present)
    tests = {}
    for rule in contract.columns:
        if rule.name not in present:
            continue
        if not rule.nullable:
            tests[(rule.name, "not_null")] = f"`{rule.name}` IS NULL"
        if rule.domain:
            values = ", ".join(sql_text(v) for v in rule.domain)
            tests[(rule.name, "domain")] = f"coalesce(`{rule.name}` NOT IN ({values}), false)"
    return tests


def breach_list(parts: Iterable[tuple[Contract, Mapping[str, Column]]]) -> Column:
    """The null and domain rules that a row breaks: an array of ``column:rule``, each once.

    Each contract comes with the values that its columns will have; columns that get theirs later (keys, say)
    are left out.  One expression over one row: a contract then holds, or says for which rows it does not,
    before anything is written.
    """
    marks: dict[str, Column] = {}
    for contract, values in parts:
        for rule in contract.columns:
            value = values.get(rule.name)
            if value is None:
                continue
            if not rule.nullable:
                marks.setdefault(f"{rule.name}:not_null", value.isNull())
            if rule.domain:
                outside = F.coalesce(~value.isin(*rule.domain), F.lit(False))
                marks.setdefault(f"{rule.name}:domain", outside)
    listed = [F.when(broken, F.lit(label)) for label, broken in marks.items()]
    return F.array_compact(F.array(*listed)) if listed else F.array().cast("array<string>")


def breaching_rows(contract: Contract, present: Iterable[str]) -> Column:
    """How many rows break a null or domain rule: one counter, cheap to keep."""
    tests = _rule_tests(contract, present).values()
    return F.expr(f"count_if({' OR '.join(tests) or 'false'})")


def repeated_rows(df: DataFrame, column: str) -> DataFrame:
    """One value: how many rows share their non-null ``column`` value with another."""
    sizes = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("n")
    )


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """(contract, column_name, rule, violations) for every value rule, 0 = holds.

    All null and domain rules share one pass; each unique rule is one narrow
    aggregation.  Structural breaches are added as rows of their own.
    """
    spark = df.sparkSession
    parts = []
    broken = structural_violations(df.schema, contract)
    if broken:
        rows = [(contract.name, *b) for b in broken]
        parts.append(small_frame(spark, rows, VIOLATIONS_SCHEMA))

    def labelled(column: str, rule: str, count: Column) -> Column:
        return F.struct(
            F.lit(contract.name).alias("contract"),
            F.lit(column).alias("column_name"),
            F.lit(rule).alias("rule"),
            count.cast("bigint").alias("violations"),
        )

    tests = _rule_tests(contract, df.columns)
    if tests:
        aliases = {key: f"m{i}" for i, key in enumerate(tests)}
        totals = df.agg(*[F.expr(f"count_if({t})").alias(aliases[k]) for k, t in tests.items()])
        lines = [labelled(*key, F.col(alias)) for key, alias in aliases.items()]
        parts.append(totals.select(F.explode(F.array(*lines)).alias("r")).select("r.*"))
    for rule in contract.columns:
        if rule.unique and rule.name in df.columns:
            line = labelled(rule.name, "unique", F.col("n"))
            parts.append(repeated_rows(df, rule.name).select(line.alias("r")).select("r.*"))
    if not parts:
        return empty_frame(spark, VIOLATIONS_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """Return ``df`` unchanged, or raise :class:`ContractError`."""
    broken = structural_violations(df.schema, contract)
    if broken:
        raise ContractError(contract.name, broken)
    # bounded by the number of rules, not by the data
    rows = contract_report(df, contract).where("violations > 0").collect()
    if rows:
        raise ContractError(contract.name, [(r.column_name, r.rule, r.violations) for r in rows])
    return df


def enforce_unique(df: DataFrame, contract: Contract, skip: Sequence[str] = ()) -> DataFrame:
    """Like :func:`enforce`, for the unique columns only: one job over those columns."""
    keys = [rule.name for rule in contract.columns if rule.unique and rule.name not in skip]
    if keys:
        extra = [f"count(`{k}`) - count(DISTINCT `{k}`) AS `{k}`" for k in keys]
        if any(df.selectExpr(*extra).first()):
            found = {k: repeated_rows(df, k).first()["n"] for k in keys}
            broken = [(k, "unique", n) for k, n in found.items() if n]
            raise ContractError(contract.name, broken)
    return df
