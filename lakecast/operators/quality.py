"""Data-quality rules: one-pass suites, and isolating the rows that break a rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecast.operators.joins import member_flag

NULL_POLICIES = ("bad", "drop")
_FIXED = (
    "rule int, kind string, `column` string, success boolean, unexpected_count bigint, unexpected_percent double"
)


@dataclass(frozen=True, eq=False)
class Rule:
    """One expectation on one column; build with the class methods."""

    kind: str
    column: str
    pattern: str | None = None
    values: tuple | None = None
    low: float | None = None
    high: float | None = None
    table: DataFrame | None = None
    table_column: str | None = None

    @classmethod
    def exists(cls, column: str) -> Rule:
        return cls("expect_column_to_exist", column)

    @classmethod
    def regex(cls, column: str, pattern: str) -> Rule:
        return cls("expect_column_values_to_match_regex", column, pattern=pattern)

    @classmethod
    def in_set(cls, column: str, values: Sequence) -> Rule:
        return cls("expect_column_values_to_be_in_set", column, values=tuple(values))

    @classmethod
    def in_table(cls, column: str, table: DataFrame, table_column: str) -> Rule:
        """Membership in a dimension; joined, never spelled out as a literal list."""
        return cls(
            "expect_column_values_to_be_in_set", column, table=table, table_column=table_column
        )

    @classmethod
    def between(cls, column: str, low, high) -> Rule:
        return cls("expect_column_values_to_be_between", column, low=low, high=high)

    @property
    def on_values(self) -> bool:
        return self.kind != "expect_column_to_exist"

    def predicate(self, flag: str) -> Column:
        """True, false, or null for a null value; ``flag`` names a membership column."""
        c = F.col(self.column)
        if self.pattern is not None:
            return c.cast("string").rlike(self.pattern)
        if self.table is not None:
            return F.col(flag)
        if self.values is not None:
            # No value is in an empty set.
            return c.isin(*self.values) if self.values else F.when(c.isNotNull(), F.lit(False))
        return c.between(self.low, self.high)


def _value_rules(df: DataFrame, rules: Sequence[Rule]) -> list[tuple[int, Rule]]:
    return [(i, r) for i, r in enumerate(rules) if r.on_values and r.column in df.columns]


def _flag(i: int) -> str:
    return f"_member_{i}"


def flagged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with a membership column for each rule on a table; see ``suite_measures``."""
    return _with_flags(df, rules)


def suite_measures(df: DataFrame, rules: Sequence[Rule]) -> dict[str, Column]:
    """The value rules' counts as named aggregates over ``flagged`` rows, to be observed while these are written."""
    measures = {}
    for i, rule in _value_rules(df, rules):
        ok = rule.predicate(_flag(i))
        measures |= {f"ok_{i}": F.count_if(ok), f"bad_{i}": F.count_if(~ok), f"present_{i}": F.count(rule.column)}
    return measures


def _with_flags(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    for i, rule in _value_rules(df, rules):
        if rule.table is not None:
            df = member_flag(df, rule.column, rule.table, rule.table_column, _flag(i))
    return df


def _without_flags(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.drop(*(_flag(i) for i, r in enumerate(rules) if r.table is not None))


def missing_columns(columns: Sequence[str], rules: Sequence[Rule]) -> list[str]:
    """Columns an existence rule asks for that ``columns`` lacks. Pass the files' columns."""
    present = set(columns)
    return [r.column for r in rules if not r.on_values and r.column not in present]


def schema_gate(columns: Sequence[str], rules: Sequence[Rule]) -> None:
    """Fail before anything is written if a required column is absent."""
    absent = missing_columns(columns, rules)
    if absent:
        raise ValueError(f"required columns are missing: {', '.join(absent)}")


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per value rule: rows that pass and rows that do not, all rules in one aggregate."""
    counts = _counts(_with_flags(df, rules), _value_rules(df, rules))
    return counts.select("kind", "column", "success_count", "failure_count")


def _counts(checked: DataFrame, numbered: list[tuple[int, Rule]]) -> DataFrame:
    measured = [F.count(F.lit(1)).alias("rows")]
    for i, rule in numbered:
        ok = rule.predicate(_flag(i))
        measured.append(F.count_if(ok).alias(f"ok_{i}"))
        measured.append(F.count_if(~ok).alias(f"bad_{i}"))
        measured.append(F.count(rule.column).alias(f"present_{i}"))
    lines = [
        F.struct(
            F.lit(i).alias("rule"),
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.column).alias("column"),
            F.col(f"ok_{i}").alias("success_count"),
            (F.col("rows") - F.col(f"ok_{i}")).alias("failure_count"),
            F.col(f"bad_{i}").alias("unexpected_count"),
            F.col(f"present_{i}").alias("present_count"),
            F.col("rows").alias("row_count"),
        )
        for i, rule in numbered
    ]
    return checked.agg(*measured).select(F.inline(F.array(*lines)))


def _samples(checked: DataFrame, numbered: list[tuple[int, Rule]], size: int) -> DataFrame:
    """The smallest ``size`` offending values per rule, as text.

    The rank limit is applied in each task before the shuffle, so a rule broken by every
    row still moves only ``size`` values per task.
    """
    hits = F.array_compact(
        F.array(
            *(
                F.when(
                    ~rule.predicate(_flag(i)),
                    F.struct(F.lit(i).alias("rule"), F.col(rule.column).cast("string").alias("value")),
                )
                for i, rule in numbered
            )
        )
    )
    by_rule = Window.partitionBy("rule").orderBy("value")
    return (
        checked.select(F.inline(hits))
        .withColumn("position", F.row_number().over(by_rule))
        .where(F.col("position") <= size)
        .groupBy("rule")
        .agg(F.sort_array(F.collect_list("value")).alias("partial_unexpected_list"))
    )


def _summary(
    df: DataFrame,
    checked: DataFrame,
    rules: Sequence[Rule],
    columns: Sequence[str] | None,
    nulls_pass: bool,
) -> DataFrame:
    """The suite's result without samples: one aggregate pass."""
    present = set(columns if columns is not None else df.columns)
    bad = F.col("unexpected_count") if nulls_pass else F.col("failure_count")
    base = F.col("present_count") if nulls_pass else F.col("row_count")
    numbered = _value_rules(df, rules)
    parts = []
    if numbered:
        parts.append(
            _counts(checked, numbered).select(
                "rule",
                "kind",
                "column",
                (bad == 0).alias("success"),
                bad.alias("unexpected_count"),
                F.coalesce(F.try_divide(bad * 100.0, base), F.lit(0.0)).alias("unexpected_percent"),
            )
        )
    fixed = [
        (i, r.kind, r.column, r.column in present and r.column in df.columns, 0, 0.0)
        for i, r in enumerate(rules)
        if not r.on_values or r.column not in df.columns
    ]
    if fixed:
        parts.append(
            df.sparkSession.createDataFrame(fixed, _FIXED)
        )
    return reduce(DataFrame.unionByName, parts)


def _with_samples(summary: DataFrame, samples: DataFrame | None) -> DataFrame:
    name, empty = "partial_unexpected_list", F.array().cast("array<string>")
    if samples is None:
        return summary.withColumn(name, empty)
    return summary.join(samples, "rule", "left").withColumn(name, F.coalesce(name, empty))


def run_suite(
    df: DataFrame,
    rules: Sequence[Rule],
    columns: Sequence[str] | None = None,
    nulls_pass: bool = True,
    sample: int = 20,
) -> DataFrame:
    """One row per rule: kind, column, success, unexpected count and percent, sample values.

    All value rules share one aggregate pass, and the samples one more (``sample=0`` skips
    it). ``columns`` are the columns the files have, for the existence rules. Nulls do not
    count against a rule unless ``nulls_pass`` is off; the percentage is then of all rows,
    otherwise of the non-null ones.
    """
    checked, numbered = _with_flags(df, rules), _value_rules(df, rules)
    summary = _summary(df, checked, rules, columns, nulls_pass)
    samples = _samples(checked, numbered, sample) if sample and numbered else None
    return _with_samples(summary, samples)


def judge(
    df: DataFrame,
    rules: Sequence[Rule],
    columns: Sequence[str] | None = None,
    nulls_pass: bool = True,
    sample: int = 20,
) -> tuple[DataFrame, bool]:
    """The suite's result, already computed, and whether all rules passed.

    A clean batch costs one pass; values are sampled only for rules that failed.
    """
    checked = _with_flags(df, rules)
    counted = _summary(df, checked, rules, columns, nulls_pass)
    rows = counted.collect()  # one row per rule
    summary = df.sparkSession.createDataFrame(rows, counted.schema)
    failed = {r["rule"] for r in rows if not r["success"]}
    numbered = [(i, rule) for i, rule in _value_rules(df, rules) if i in failed]
    samples = _samples(checked, numbered, sample) if sample and numbered else None
    return _with_samples(summary, samples), not failed


def judge_measured(
    rows: DataFrame,
    rules: Sequence[Rule],
    measures: dict,
    columns: Sequence[str] | None = None,
    nulls_pass: bool = True,
    sample: int = 20,
) -> tuple[DataFrame, bool]:
    """``judge`` for rows whose counts (``rows`` and ``suite_measures``) were observed: they are read again only for sample values of failed rules."""
    numbered, total = dict(_value_rules(rows, rules)), measures.get("rows") or 0
    present = set(columns if columns is not None else rows.columns)
    lines, failed = [], []
    for i, rule in enumerate(rules):
        if i in numbered:
            ok, wrong, there = (measures.get(f"{name}_{i}") or 0 for name in ("ok", "bad", "present"))
            bad, base = (wrong, there) if nulls_pass else (total - ok, total)
            lines.append((i, rule.kind, rule.column, bad == 0, bad, bad * 100.0 / base if base else 0.0))
            failed += [(i, rule)] if bad else []
        else:
            found = rule.column in present and rule.column in rows.columns
            lines.append((i, rule.kind, rule.column, found, 0, 0.0))
    summary = rows.sparkSession.createDataFrame(lines, _FIXED)
    samples = _samples(_with_flags(rows, rules), failed, sample) if sample and failed else None
    return _with_samples(summary, samples), all(line[3] for line in lines)


def all_success(summary: DataFrame, kind: str | None = None) -> bool:
    """Do all rules (of one kind) pass? The summary has one row per rule."""
    rows = summary if kind is None else summary.where(F.col("kind") == kind)
    return bool(rows.agg(F.coalesce(F.bool_and("success"), F.lit(True))).first()[0])


def verdict(df: DataFrame, rules: Sequence[Rule]) -> Column:
    """All value rules at once: true, false, or null if a null decides. One on an absent column is false."""
    if any(rule.on_values and rule.column not in df.columns for rule in rules):
        return F.lit(False)
    checks = [rule.predicate(_flag(i)) for i, rule in _value_rules(df, rules)]
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def isolate(
    df: DataFrame, rules: Sequence[Rule], null_policy: str = "bad"
) -> tuple[DataFrame, DataFrame]:
    """Good and bad rows. Good means every rule is true.

    A row whose nulls leave the verdict open is bad; ``null_policy="drop"`` puts it in
    neither output.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    checked = _with_flags(df, rules)
    ok = verdict(df, rules)
    if null_policy == "bad":
        ok = F.coalesce(ok, F.lit(False))
    return (
        _without_flags(checked.where(ok), rules),
        _without_flags(checked.where(~ok), rules),
    )


def good_bad_ratio(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Row count and the shares of good and bad rows, in one pass."""
    ok = F.coalesce(verdict(df, rules), F.lit(False))
    good = F.avg(ok.cast("double"))
    return _with_flags(df, rules).agg(
        F.count(F.lit(1)).alias("row_count"),
        good.alias("good_ratio"),
        (F.lit(1.0) - good).alias("bad_ratio"),
    )
