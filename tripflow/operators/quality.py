"""Data checks. Every check yields (check, column, evaluated, failed, success)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = ["check", "column", "evaluated", "failed", "success"]


class QualityError(RuntimeError):
    """A gate found failed checks."""


@dataclass(frozen=True)
class Rule:
    """One expectation on a table: ``check`` names the kind, the other fields its arguments."""

    check: str
    column: str
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    mostly: float = 1.0


def exists(column: str) -> Rule:
    return Rule("column_exists", column)


def not_null(column: str, mostly: float = 1.0) -> Rule:
    return Rule("not_null", column, mostly=mostly)


def between(column: str, low: float, high: float, mostly: float = 1.0) -> Rule:
    return Rule("between", column, low, high, mostly=mostly)


def in_set(column: str, values: Sequence, mostly: float = 1.0) -> Rule:
    return Rule("in_set", column, values=tuple(values), mostly=mostly)


def row_count(low: int, high: int | None = None) -> Rule:
    return Rule("row_count", "*", low, high)


def run_rules(rows: DataFrame, rules: Sequence[Rule], footers: DataFrame | None = None) -> DataFrame:
    """All rules in one aggregate pass over the table.

    With ``footers``, the same rows as ``sources.footers`` reads them, rules that counts decide are answered
    there, and the pass reads only the columns of the others.

    Bounds are inclusive. Missing values (NaN counts as missing) leave the denominator of
    range and set rules, a column without values passes them, and a rule succeeds when at
    least ``mostly`` of the evaluated values pass. A rule on an absent column fails.
    """
    if footers is not None:
        counted = [rule for rule in rules if _is_counted(rule, rows)]
        others = [rule for rule in rules if rule not in counted]
        passes = [run_rules(source, own) for source, own in ((rows, others), (footers, counted)) if own]
        return reduce(DataFrame.unionAll, passes)
    counters = ["count(1) AS rows"]
    outcomes = []
    for position, rule in enumerate(rules):
        present, failing = f"present_{position}", f"failing_{position}"
        if rule.check == "column_exists":
            missing = int(rule.column not in rows.columns)
            outcomes.append(_outcome(rule, "1", str(missing)))
            continue
        if rule.check == "row_count":
            inside = f"rows >= {rule.low}"
            if rule.high is not None:
                inside += f" AND rows <= {rule.high}"
            outcomes.append(_outcome(rule, "rows", f"if({inside}, 0, 1)", inside))
            continue
        if rule.column not in rows.columns:
            outcomes.append(_outcome(rule, "0", "0", "false"))
            continue
        value = f"`{rule.column}`"
        absent = f"{value} IS NULL"
        if _is_counted(rule, rows):
            counters.append(f"count(1) - count({value}) AS {failing}")
            outcomes.append(_outcome(rule, "rows", failing))
            continue
        if _has_nan(rows, rule.column):
            absent = f"({absent} OR isnan({value}))"
        if rule.check == "not_null":
            counters.append(f"count_if({absent}) AS {failing}")
            outcomes.append(_outcome(rule, "rows", failing))
            continue
        if rule.values:
            bad = f"{value} NOT IN ({', '.join(_literal(v) for v in rule.values)})"
        else:
            bad = f"{value} NOT BETWEEN {_literal(rule.low)} AND {_literal(rule.high)}"
        counters.append(f"count_if(NOT {absent}) AS {present}")
        counters.append(f"count_if(NOT {absent} AND {bad}) AS {failing}")
        outcomes.append(_outcome(rule, present, failing))
    if all(rule.check == "column_exists" for rule in rules):  # the schema answers
        return rows.sparkSession.range(1).selectExpr(_rows_of(outcomes))
    return rows.agg(*map(F.expr, counters)).selectExpr(_rows_of(outcomes))


def _has_nan(rows: DataFrame, column: str) -> bool:
    return isinstance(rows.schema[column].dataType, (T.DoubleType, T.FloatType))


def _is_counted(rule: Rule, rows: DataFrame) -> bool:
    """Whether counts of rows and of non-null values decide the rule."""
    if rule.check == "not_null":
        return rule.column in rows.columns and not _has_nan(rows, rule.column)
    return rule.check == "row_count"


def _literal(value: object) -> str:
    """A number or text as SQL; fractions as DOUBLE, not DECIMAL."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def _outcome(rule: Rule, evaluated: str, failed: str, success: str | None = None) -> str:
    if success is None:
        passed = f"({evaluated} - {failed}) / nullif({evaluated}, 0)"
        success = f"coalesce({passed} >= {_literal(float(rule.mostly))}, true)"
    return f"""named_struct('check', '{rule.check}', 'column', {_literal(rule.column)},
        'evaluated', cast({evaluated} AS bigint), 'failed', cast({failed} AS bigint),
        'success', {success})"""


def _rows_of(outcomes: Sequence[str]) -> str:
    return f"inline(array({', '.join(outcomes)}))"


def failing_values(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """What range and set rules reject: every failing value, its rows and its share of the values.

    One row per rule and value; all rules count in one pass. Numbers only.
    """
    counts = _failing_counts(rows, rules)
    everything = F.expr("sum(rows) OVER (PARTITION BY check, column)")
    shared = counts.withColumn("share", F.col("rows") / everything)
    return shared.filter("value IS NOT NULL")


def _failing_counts(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows of every failing value of a rule, and under NULL of all values that pass it."""
    parts = []
    for rule in rules:
        if rule.check not in ("between", "in_set") or rule.column not in rows.columns:
            continue
        value = f"cast(`{rule.column}` AS double)"
        if rule.values:
            bad = f"{value} NOT IN ({', '.join(_literal(float(v)) for v in rule.values)})"
        else:
            bad = f"{value} NOT BETWEEN {_literal(float(rule.low))} AND {_literal(float(rule.high))}"
        parts.append(f"named_struct('check', '{rule.check}', 'column', '{rule.column}', 'value', {value}, 'bad', {bad})")
    values = rows.select(F.expr(f"inline(array({', '.join(parts)}))")).filter("value IS NOT NULL AND NOT isnan(value)")
    # A failing value is a group, all others of its rule are one.
    return values.groupBy("check", "column", F.expr("if(bad, value, NULL)").alias("value")).agg(F.expr("count(1) AS rows"))


def top_failing_values(rows: DataFrame, rules: Sequence[Rule], k: int) -> DataFrame:
    """The ``k`` most frequent failing values of each rule, with exact rows and share of the rule's values.

    Values are counted where they are and once more after one exchange; every task then hands on the
    ``k`` best of a rule (equal counts by value), so however many distinct values fail, what comes out is
    at most ``k`` rows a rule, and no task holds all values of one.
    """
    counts = _failing_counts(rows, rules)
    totals = counts.groupBy("check", "column").agg(F.sum("rows").alias("evaluated"))
    best = Window.partitionBy("check", "column").orderBy(F.desc("rows"), "value")
    top = counts.filter("value IS NOT NULL").withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
    shared = top.join(totals, ["check", "column"]).withColumn("share", F.col("rows") / F.col("evaluated"))
    return shared.select("check", "column", "place", "value", "rows", "share")


def orphan_values(child: DataFrame, columns: Sequence[str], parent: DataFrame, key: str) -> DataFrame:
    """Values of the child that are no key of the parent, with their rows."""
    counts = _values_of(child, columns)
    keys = parent.select(F.col(key).alias("value")).distinct()
    return counts.join(keys, "value", "left_anti").select("column", "value", "rows")


def _values_of(child: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    return (
        child.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def check_values(
    rows: DataFrame, not_null: Sequence[str] = (), accepted: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """Strict value checks of a table in one pass; NaN is a value here.

    ``failed`` counts rows without a value, and for accepted values the distinct values
    outside the set.
    """
    counters, outcomes = ["count(1) AS rows"], []
    for i, name in enumerate(not_null):
        counters.append(f"count_if(`{name}` IS NULL) AS nulls_{i}")
        outcomes.append(_strict("not_null", name, "rows", f"nulls_{i}"))
    for i, (name, values) in enumerate((accepted or {}).items()):
        counters.append(f"count(`{name}`) AS values_{i}")
        outside = f"CASE WHEN {_outside(f'`{name}`', values)} THEN `{name}` END"
        counters.append(f"count(DISTINCT {outside}) AS outside_{i}")
        outcomes.append(_strict("accepted_values", name, f"values_{i}", f"outside_{i}"))
    return rows.agg(*map(F.expr, counters)).selectExpr(_rows_of(outcomes))


def check_not_null(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return check_values(rows, not_null=columns)


def check_accepted_values(rows: DataFrame, column: str, values: Sequence) -> DataFrame:
    return check_values(rows, accepted={column: values})


def duplicate_keys(rows: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their counts."""
    return _value_counts(rows, column).filter(F.col("rows") > 1)


def check_unique(rows: DataFrame, column: str) -> DataFrame:
    """``failed`` counts the repeated values."""
    return _fold(_value_counts(rows, column), "unique", column, "rows > 1")


def unaccepted_values(rows: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Non-null values outside the set, with their counts."""
    return _value_counts(rows, column).filter(_outside("value", values))


def check_relationships(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, key: str
) -> DataFrame:
    """``failed`` counts child rows whose non-null value is no key of the parent.

    The child is counted per distinct value first, so the join sees values, not rows, and a
    value shared by a third of all rows is one of them.
    """
    counts = _values_of(child, columns)
    keys = parent.select(F.col(key).alias("value")).distinct().withColumn("known", F.lit(True))
    counters, outcomes = [], []
    for i, column in enumerate(columns):
        mine = f"column = {_literal(column)}"
        counters.append(f"coalesce(sum(rows) FILTER (WHERE {mine}), 0) AS present_{i}")
        orphan = f"{mine} AND known IS NULL"
        counters.append(f"coalesce(sum(rows) FILTER (WHERE {orphan}), 0) AS failing_{i}")
        outcomes.append(_strict("relationships", column, f"present_{i}", f"failing_{i}"))
    totals = counts.join(keys, "value", "left").agg(*map(F.expr, counters))
    return totals.selectExpr(_rows_of(outcomes))


def _value_counts(rows: DataFrame, column: str) -> DataFrame:
    values = rows.selectExpr(f"`{column}` AS value").filter("value IS NOT NULL")
    return values.groupBy("value").agg(F.expr("count(1) AS rows"))


def _outside(value: str, values: Sequence) -> str:
    return f"{value} NOT IN ({', '.join(_literal(v) for v in values)})"


def _fold(counts: DataFrame, check: str, column: str, failing: str) -> DataFrame:
    totals = counts.agg(
        F.expr("coalesce(sum(rows), 0) AS present"), F.expr(f"count_if({failing}) AS failing")
    )
    return totals.selectExpr(_rows_of([_strict(check, column, "present", "failing")]))


def _strict(check: str, column: str, evaluated: str, failed: str) -> str:
    return _outcome(Rule(check, column), evaluated, failed, f"{failed} = 0")


@dataclass(frozen=True)
class ModelTest:
    """A test of a built table. ``unique`` and ``not_null`` need only the column."""

    table: str
    check: str
    column: str
    values: tuple = ()
    parent: str | None = None
    key: str | None = None


def run_model_tests(tables: Mapping[str, DataFrame], tests: Sequence[ModelTest]) -> DataFrame:
    """Results of all tests with the table's name in front; every table is computed and read once."""
    results = []
    for name in dict.fromkeys(test.table for test in tests):
        own = [test for test in tests if test.table == name]
        if all(test.check in ("not_null", "accepted_values") for test in own):
            not_null = [t.column for t in own if t.check == "not_null"]
            found = check_values(tables[name], not_null, {t.column: t.values for t in own if t.check == "accepted_values"})
        else:
            found = _checked_by_value(tables, own)
        results.append(found.select(F.lit(name).alias("table"), *RESULT))
    return reduce(DataFrame.unionByName, results)


def _checked_by_value(tables: Mapping[str, DataFrame], tests: Sequence[ModelTest]) -> DataFrame:
    """All tests of one table from one count of (column, value), so the table is scanned once.

    Each row gives a pair per tested column; a column that is tested for NULL alone has two values, and pairs are
    added up before the exchange. Parents come as keys beside the counts, of which a child's orphans are
    those without one, so values meet the parent and rows do not.
    """
    rows = tables[tests[0].table]
    by_value = {test.column for test in tests if test.check != "not_null"}
    pairs = []
    for name in dict.fromkeys(test.column for test in tests):
        value = f"cast(`{name}` AS string)" if name in by_value else f"if(`{name}` IS NULL, NULL, '')"
        pairs.append(f"named_struct('column', {_literal(name)}, 'value', {value})")
    counts = rows.select(F.expr(f"inline(array({', '.join(pairs)}))")).groupBy("column", "value").agg(F.expr("count(1) AS rows"))
    related = dict.fromkeys((t.column, t.parent, t.key) for t in tests if t.check == "relationships")
    known = "false"
    if related:
        keys = [
            tables[parent].select(F.lit(column).alias("column"), F.col(key).cast("string").alias("value")).distinct()
            for column, parent, key in related
        ]
        counts = counts.join(reduce(DataFrame.union, keys).withColumn("known", F.lit(True)), ["column", "value"], "left")
        known = "known"
    first = _literal(tests[0].column)
    counters = [f"coalesce(sum(rows) FILTER (WHERE column = {first}), 0) AS total"]
    outcomes = []
    for i, test in enumerate(tests):
        mine = f"column = {_literal(test.column)}"
        has = f"{mine} AND value IS NOT NULL"
        match test.check:
            case "not_null":
                failing = f"coalesce(sum(rows) FILTER (WHERE {mine} AND value IS NULL), 0)"
            case "unique":
                failing = f"count_if({has} AND rows > 1)"
            case "accepted_values":
                failing = f"count_if({has} AND value NOT IN ({', '.join(_literal(str(v)) for v in test.values)}))"
            case _:
                failing = f"coalesce(sum(rows) FILTER (WHERE {has} AND {known} IS NULL), 0)"
        counters += [f"coalesce(sum(rows) FILTER (WHERE {has}), 0) AS present_{i}", f"{failing} AS failing_{i}"]
        evaluated = "total" if test.check == "not_null" else f"present_{i}"
        outcomes.append(_strict(test.check, test.column, evaluated, f"failing_{i}"))
    return counts.agg(*map(F.expr, counters)).selectExpr(_rows_of(outcomes))


def summarize(results: DataFrame) -> DataFrame:
    """One row: how many checks ran, passed and failed, and whether all passed."""
    return results.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("unsuccessful"),
        F.coalesce(F.every("success"), F.lit(True)).alias("success"),
    )


def gate(results: DataFrame) -> list:
    """Stops with ``QualityError`` when a check failed; returns the results (one row per check)."""
    rows = results.collect()
    failed = [row for row in rows if not row["success"]]
    if failed:
        details = "; ".join(str(row.asDict()) for row in failed)
        raise QualityError(f"{len(failed)} of {len(rows)} checks failed: {details}")
    return rows
