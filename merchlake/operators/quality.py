"""Data-quality audit, fail-fast check, load rejects and reference checks.

All key checks share one job. Each table gives out its own key and the keys it refers to,
in one scan; grouping them by (relation, key) shows how often a key is held and how often
each referring column uses it. Repeated keys and dangling references are both sums over
those groups, so no join is needed, and a key that fills a third of a table is counted down
to one row per task before it is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from merchlake.functions.skew import hot_keys_of, spread_join
from merchlake.functions.text import is_moment, missing_as_null
from merchlake.model import RELATIONS, Relation, ValueRule
from merchlake.session import fresh_path
from merchlake.sources.files import write_json


class DataQualityError(ValueError):
    """Data broke a rule that the caller wanted enforced."""


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def mark_missing(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All-text tables with the usual tokens for a missing value turned into NULL."""
    return {
        name: table.select(*[missing_as_null(c).alias(c) for c in table.columns])
        for name, table in tables.items()
    }


# --- keys and references ----------------------------------------------------------------


def _uses() -> list[tuple[str, str, str]]:
    """(referring relation, column, parent) of every reference."""
    return [(r.name, c, parent) for r in RELATIONS.values() for c, parent in r.references.items()]


def _count_name(child: str, column: str) -> str:
    return f"{child}_{column}"


_ISSUES = "#issues"  # stands for a relation in the ledger; its keys name checks


def _entry(owner: str, key: Column, role: str, number: Column | None = None) -> Column:
    return F.struct(
        F.lit(owner).alias("relation"),
        key.cast("string").alias("key"),
        F.lit(role).alias("role"),
        (F.lit(1) if number is None else number).cast("bigint").alias("n"),
    )


def _issue(dataset: str, check: str, detail: str, number: Column) -> Column:
    """An entry for a row's issues with one check, NULL if it has none."""
    return F.when(number > 0, _entry(_ISSUES, F.lit(f"{dataset}/{check}/{detail}"), "issue", number))


def key_ledger(tables: dict[str, DataFrame], issues: dict[str, list[Column]] | None = None) -> DataFrame:
    """Per relation and key: rows holding it and rows referring to it, by column.

    ``issues`` by table are entered in the same pass (see ``_issue``).
    """
    entries = []
    for name, table in tables.items():
        relation = RELATIONS[name]
        named = [_entry(name, F.col(relation.key), "holds")]
        named += [_entry(parent, F.col(c), _count_name(name, c)) for c, parent in relation.references.items()]
        found = F.array(*named, *(issues or {}).get(name, []))
        entries.append(table.select(F.inline(F.array_compact(found) if issues else found)))
    roles = ["holds"] + [_count_name(child, column) for child, column, _ in _uses()]
    return (
        _union(entries)
        .groupBy("relation", "key")
        .agg(
            *[F.expr(f"count_if(role = '{role}') AS {role}") for role in roles],
            F.sum(F.when(F.col("role") == "issue", F.col("n"))).alias("issues"),
        )
    )


def _ledger_findings(ledger: DataFrame) -> DataFrame:
    """(dataset, check, detail, issues) for repeated keys, dangling references, rows and entered issues."""
    dangling = F.col("key").isNull() | (F.col("holds") == 0)
    uses = _uses()
    check = F.when(F.col("relation") == _ISSUES, F.col("key")).alias("check")
    per_relation = ledger.groupBy("relation", check).agg(
        F.sum("holds").alias("rows"),
        F.sum("issues").alias("issues"),
        F.sum(F.greatest(F.col("holds") - 1, F.lit(0))).alias("repeated"),
        *[
            F.sum(F.when(dangling, F.col(_count_name(child, column))).otherwise(0)).alias(
                _count_name(child, column)
            )
            for child, column, _ in uses
        ],
    )

    def line(dataset: Column, check: Column, detail: Column, issues: str) -> Column:
        return F.struct(
            dataset.alias("dataset"), check.alias("check"), detail.alias("detail"), F.col(issues).alias("issues")
        )

    held = F.col("relation") != _ISSUES
    parts = F.split("check", "/")
    lines = [
        F.when(held, line(F.col("relation"), F.lit("duplicate_ids"), F.lit("duplicate_ids"), "repeated")),
        F.when(held, line(F.col("relation"), F.lit("rows"), F.lit("rows"), "rows")),
        F.when(~held, line(F.get(parts, 0), F.get(parts, 1), F.get(parts, 2), "issues")),
    ]
    for child, column, parent in uses:
        lines.append(
            F.when(
                F.col("relation") == parent,
                line(F.lit(child), F.lit("foreign_keys"), F.lit(column), _count_name(child, column)),
            )
        )
    return per_relation.select(F.explode(F.array_compact(F.array(*lines))).alias("line")).select("line.*")


def duplicate_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows beyond the first per key, repeated missing keys included."""
    counts = [
        table.groupBy(RELATIONS[name].key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_id_count"))
        .select(F.lit(name).alias("dataset"), "duplicate_id_count")
        for name, table in tables.items()
    ]
    return _union(counts)


def reference_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per reference whose parent key is missing; a NULL reference counts."""
    return (
        _ledger_findings(key_ledger(tables))
        .filter(F.col("check") == "foreign_keys")
        .select("dataset", F.col("detail").alias("column_name"), F.col("issues").alias("violations"))
    )


def dangling_rows(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str, nulls_count: bool = False
) -> DataFrame:
    """Child rows whose reference finds no parent.

    Only the distinct references are compared with the parent. The few that fail are stored with their numbers
    of rows and looked up in the child, the rows of a frequent one spread over several tasks.
    """
    key = F.col(column).cast("string")
    known = parent.select(F.col(parent_key).cast("string").alias("_ref")).filter("_ref IS NOT NULL")
    used = child.select(key.alias("_ref")).filter("_ref IS NOT NULL").groupBy("_ref").agg(F.count("*").alias("_uses"))
    lost = _stored(used.join(known, "_ref", "left_anti"), "lost-references")
    hot = hot_keys_of(lost, ["_ref"], "_uses")
    found = spread_join(child.withColumn("_ref", key), lost.select("_ref"), ["_ref"], "left_semi", hot)
    rows = found.select(*[F.col(f"`{name}`") for name in child.columns])
    return rows.unionByName(child.filter(F.col(column).isNull())) if nulls_count else rows


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


# Lost keys up to this number are sent to every task as 64-bit hashes; more are joined without.
MOST_HASHES = 4_000_000

_CANDIDATE = ("dataset", "error", "row_id", "value", "parent", "ref")


def _candidate(name: str, error: str, value: Column, parent: str | None, ref: Column) -> Column:
    """A possible error of one row: certain if it names no parent, else one if ``ref`` is a lost key."""
    values = (F.lit(name), F.lit(error), F.col(RELATIONS[name].key), value, F.lit(parent or ""), ref)
    return F.struct(*[v.cast("string").alias(n) for v, n in zip(values, _CANDIDATE)])


def _troubled_keys(tables: dict[str, DataFrame], issues: dict[str, list[Column]] | None = None) -> DataFrame:
    """relation, key, holds and uses of the keys that are lost (used, but not held), stored.

    With ``issues`` by table (see ``_issue``) also the keys held more than once, and each check with its issues as
    ``holds``; without them the keys of relations that no other refers to aren't looked at. One number stands for a
    relation on the way and all references share one count, as nearly every key is shuffled.
    """
    numbers = {name: F.lit(n) for n, name in enumerate([*RELATIONS, _ISSUES])}
    parents = {parent for name in tables for parent in RELATIONS[name].references.values()}

    def entry(relation: str, key: Column, holds: Column, uses: int) -> Column:
        return F.struct(
            numbers[relation].alias("number"),
            key.cast("string").alias("key"),
            holds.cast("bigint").alias("holds"),
            F.lit(uses).cast("bigint").alias("uses"),
        )

    entries = []
    for name, table in tables.items():
        relation = RELATIONS[name]
        found = [F.when(F.col(c).isNotNull(), entry(parent, F.col(c), F.lit(0), 1)) for c, parent in relation.references.items()]
        if issues is not None or name in parents:
            found.append(entry(name, F.col(relation.key), F.lit(1), 0))
        for noted in (issues or {}).get(name, []):
            found.append(F.when(noted.isNotNull(), entry(_ISSUES, noted["key"], noted["n"], 0)))
        if found:
            entries.append(table.select(F.inline(F.array_compact(F.array(*found)))))
    counted = _union(entries).groupBy("number", "key").agg(F.sum("holds").alias("holds"), F.sum("uses").alias("uses"))
    wanted = F.col("key").isNotNull() & (F.col("holds") == 0)
    if issues is not None:
        wanted |= (F.col("holds") > 1) | (F.col("number") == numbers[_ISSUES])
    names = F.array(*[F.lit(name) for name in [*RELATIONS, _ISSUES]])
    return _stored(counted.filter(wanted).select(F.get(names, F.col("number")).alias("relation"), "key", "holds", "uses"), "troubled-keys")


def _confirmed(candidates: list[DataFrame], troubled: DataFrame) -> DataFrame:
    """The candidates that are errors, by a join with the lost keys; the rows of a frequent one are spread."""
    lost = troubled.filter(F.col("key").isNotNull() & (F.col("holds") == 0)).select(
        F.col("relation").alias("parent"), F.col("key").alias("ref"), "uses", F.lit(True).alias("lost")
    )
    key = ["parent", "ref"]
    possible = _union(candidates)
    if lost.count() <= MOST_HASHES:
        # A row whose reference can't be lost by its hash isn't shuffled.
        hashes = lost.select(F.xxhash64(*key).alias("_hash"), F.lit(True).alias("_may")).distinct()
        hashed = possible.withColumn("_hash", F.xxhash64(*key)).join(F.broadcast(hashes), "_hash", "left")
        possible = hashed.filter((F.col("parent") == "") | F.col("_may")).drop("_hash", "_may")
    joined = spread_join(possible, lost.drop("uses"), key, "left", hot_keys_of(lost, key, "uses"))
    return joined.filter((F.col("parent") == "") | F.col("lost")).select("dataset", "error", "row_id", "value")


def reference_violation_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Stored rows with a dangling reference; NULL references do not count here."""
    candidates = []
    for name, table in tables.items():
        references = RELATIONS[name].references
        if references:
            found = [
                F.when(F.col(c).isNotNull(), _candidate(name, c, F.col(c), parent, F.col(c)))
                for c, parent in references.items()
            ]
            candidates.append(table.select(F.inline(F.array_compact(F.array(*found)))))
    return _confirmed(candidates, _troubled_keys(tables)).select(
        "dataset", "row_id", F.col("error").alias("column_name"), F.col("value").alias("missing_key")
    )


# --- values, dates, statuses ------------------------------------------------------------


def _breaks(rule: ValueRule, number: Column) -> Column:
    """Whether a number breaks a rule; NULL where there is no number."""
    if rule.above is not None:
        return number <= rule.above
    if rule.at_least is not None:
        return number < rule.at_least
    return ~number.between(*rule.within)


def _audit_breaks(rule: ValueRule) -> Column:
    missing_counts = rule.within is not None
    number = F.col(rule.column).try_cast("double")
    return F.coalesce(_breaks(rule, number), F.lit(missing_counts))


def _row_checks(relation: Relation, columns: list[str]) -> list[tuple[str, str, Column]]:
    """(check, detail, a row's number of issues) of the checks that look at one row at a time."""
    missing = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    checks = [("missing_values", "missing_values", missing)]
    for rule in relation.rules:
        checks.append(("invalid_values", rule.check, _audit_breaks(rule).cast("int")))
    if relation.moment:
        checks.append(("dates", relation.moment, (~is_moment(F.col(relation.moment))).cast("int")))
    if relation.statuses:
        known = F.coalesce(F.col("status").isin(*relation.statuses), F.lit(False))
        checks.append(("statuses", "status", (~known).cast("int")))
    return checks


def _row_findings(name: str, table: DataFrame, only: str | None = None) -> DataFrame | None:
    """The row-wise checks of one table, or those of one kind, and the row count, in one aggregate."""
    checks = [*_row_checks(RELATIONS[name], table.columns), ("rows", "rows", F.lit(1))]
    checks = [c for c in checks if only in (None, c[0])]
    if not checks:
        return None
    counted = table.agg(
        *[F.coalesce(F.sum(issues), F.lit(0)).alias(f"_{i}") for i, (_, _, issues) in enumerate(checks)]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("dataset"),
                F.lit(check).alias("check"),
                F.lit(detail).alias("detail"),
                F.col(f"_{i}").alias("issues"),
            )
            for i, (check, detail, _) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(lines))


def _some_findings(tables: dict[str, DataFrame], check: str) -> DataFrame:
    found = (_row_findings(name, table, only=check) for name, table in tables.items())
    return _union([lines for lines in found if lines is not None])


def missing_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _some_findings(tables, "missing_values").select(
        "dataset", F.col("issues").alias("missing_value_count")
    )


def invalid_value_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _some_findings(tables, "invalid_values").select(
        "dataset", F.col("detail").alias("rule"), F.col("issues").alias("invalid_count")
    )


def date_errors(tables: dict[str, DataFrame]) -> DataFrame:
    return _some_findings(tables, "dates").select("dataset", F.col("issues").alias("date_errors"))


def status_errors(tables: dict[str, DataFrame]) -> DataFrame:
    return _some_findings(tables, "statuses").select("dataset", F.col("issues").alias("status_errors"))


# --- audit ------------------------------------------------------------------------------


def _malformed_findings(lines: DataFrame) -> DataFrame:
    counted = lines.groupBy("dataset").agg(F.count("*").alias("issues"))
    return counted.select("dataset", F.lit("lines").alias("check"), F.lit("malformed_lines").alias("detail"), "issues")


def audit_findings(tables: dict[str, DataFrame], malformed: DataFrame | None = None) -> DataFrame:
    """Every check of every table as (dataset, check, detail, issues), malformed lines (dataset, line) among them if given.

    ``tables`` are all-text with missing values already NULL (see ``mark_missing``). Checks of single rows
    are one aggregate of each table: entering them in the ledger would save a pass but costs more (11.9
    against 8 seconds at 600,000 sales rows).
    """
    rows = [_row_findings(name, table) for name, table in tables.items()]
    lines = [] if malformed is None else [_malformed_findings(malformed)]
    return _union(rows + [_ledger_findings(key_ledger(tables)).filter("check <> 'rows'")] + lines)


def audit_report(findings: DataFrame) -> DataFrame:
    """One row per dataset; a dataset passes if no check found an issue."""

    def issues(check: str) -> Column:
        return F.sum(F.when(F.col("check") == check, F.col("issues")).otherwise(0))

    report = findings.groupBy("dataset").agg(
        issues("rows").alias("rows_checked"),
        issues("missing_values").alias("missing_value_count"),
        issues("duplicate_ids").alias("duplicate_id_count"),
        issues("invalid_values").alias("invalid_value_count"),
        issues("foreign_keys").alias("foreign_key_violations"),
        issues("dates").alias("date_errors"),
        issues("statuses").alias("status_errors"),
        issues("lines").alias("malformed_lines"),
        F.sum(F.when(F.col("check") != "rows", F.col("issues")).otherwise(0)).alias("issues"),
        F.map_from_entries(
            F.collect_list(
                F.when(F.col("check") == "invalid_values", F.struct("detail", "issues"))
            )
        ).alias("invalid_value_counts"),
    )
    return report.withColumn("passed", F.col("issues") == 0)


def audit_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("overall_passed"),
        F.coalesce(F.sum("issues"), F.lit(0)).alias("total_issues_found"),
    )


def write_audit(tables: dict[str, DataFrame], path: str, malformed: DataFrame | None = None) -> dict:
    """Audit all-text tables, and the malformed lines of their files if given, write the report as JSON and return its summary.

    The report has one row per relation of the model, so reading it back is small.
    """
    spark = next(iter(tables.values())).sparkSession
    write_json(audit_report(audit_findings(mark_missing(tables), malformed)).coalesce(1), path)
    report = spark.read.schema("dataset string, issues bigint, passed boolean").json(path)
    return audit_summary(report).first().asDict()


# --- fail-fast check --------------------------------------------------------------------


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Errors of typed tables as (dataset, error, row_id, value).

    Repeated keys and missing values are one error per table; broken values and references
    are one error per row.
    """
    gaps, candidates = {}, []
    for name, table in tables.items():
        relation = RELATIONS[name]
        key = F.col(relation.key)
        empty = reduce(
            Column.__or__,
            [F.col(c).isNull() | (F.col(c).cast("string") == "") for c in table.columns],
        )
        gaps[name] = [_issue(name, "missing value", "", empty.cast("int"))]
        found = [
            F.when(_breaks(rule, F.col(rule.column)), _candidate(name, f"invalid {rule.column}", F.col(rule.column), None, key))
            for rule in relation.rules
            if rule.fail_fast
        ]
        for column, parent in relation.references.items():
            error, used = f"Broken FK: {column}", F.col(column)
            found.append(
                F.when(used.isNull(), _candidate(name, error, used, None, key)).otherwise(
                    _candidate(name, error, used, parent, used)
                )
            )
        if found:
            candidates.append(table.select(F.inline(F.array_compact(F.array(*found)))))
    troubled = _troubled_keys(tables, gaps)
    noted = F.col("relation") == _ISSUES
    dataset = F.when(noted, F.get(F.split("key", "/"), 0)).otherwise(F.col("relation"))
    kind = F.when(noted, F.get(F.split("key", "/"), 1)).otherwise(F.lit("duplicate primary ids"))
    per_table = (
        troubled.filter(noted | (F.col("holds") > 1))
        .select(dataset.alias("dataset"), kind.alias("error"))
        .distinct()
        .withColumns({"row_id": F.lit(None).cast("string"), "value": F.lit(None).cast("string")})
    )
    return per_table.unionByName(_confirmed(candidates, troubled))


def write_findings(findings: DataFrame, path: str) -> int:
    """Write all rows of a list of findings as Parquet and return their number."""
    seen = Observation()
    findings.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def require_valid(tables: dict[str, DataFrame], path: str) -> None:
    """Write all errors of typed tables to ``path`` and raise if there are any."""
    errors = write_findings(violations(tables), path)
    if errors:
        spark = next(iter(tables.values())).sparkSession
        kinds = spark.read.parquet(path).groupBy("dataset", "error").count().collect()
        listed = ", ".join(sorted(f"{k['error']} in {k['dataset']}: {k['count']}" for k in kinds))
        raise DataQualityError(f"{errors} errors ({listed}), all listed in {path}")


# --- load constraints -------------------------------------------------------------------


def with_violated_rules(table: DataFrame, relation: Relation) -> DataFrame:
    """Add ``violated_rules``: the NOT NULL and value constraints each row breaks."""
    broken = [
        F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in relation.columns
    ] + [
        F.when(_breaks(rule, F.col(rule.column)), F.lit(rule.check)) for rule in relation.rules
    ]
    return table.withColumn("violated_rules", F.array_compact(F.array(*broken)))


def accepted(table: DataFrame, relation: Relation) -> DataFrame:
    marked = with_violated_rules(table, relation)
    return marked.filter(F.size("violated_rules") == 0).drop("violated_rules")


def rejected(table: DataFrame, relation: Relation) -> DataFrame:
    return with_violated_rules(table, relation).filter(F.size("violated_rules") > 0)


def parse_table(table: DataFrame, relation: Relation) -> DataFrame:
    """An all-text table in the relation's types; unreadable values become NULL."""
    return table.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in relation.schema.fields]
    )


def load_verification(source: dict[str, DataFrame], stored: dict[str, DataFrame]) -> DataFrame:
    """Source and stored row counts per table, and whether they agree."""
    lines = []
    for name, table in source.items():
        sides = [
            (table, F.lit(1), F.lit(0)),
            (stored[name], F.lit(0), F.lit(1)),
        ]
        rows = _union([t.select(a.alias("in_source"), b.alias("in_store")) for t, a, b in sides])
        lines.append(
            rows.agg(
                F.coalesce(F.sum("in_source"), F.lit(0)).alias("source_count"),
                F.coalesce(F.sum("in_store"), F.lit(0)).alias("stored_count"),
            ).select(F.lit(name).alias("table_name"), "source_count", "stored_count")
        )
    return _union(lines).withColumn("matched", F.col("source_count") == F.col("stored_count"))
