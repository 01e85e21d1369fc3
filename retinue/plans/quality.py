"""Key, reference, presence and range rules as jobs that report violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.operators.keyed import duplicate_keys
from retinue.sources.schemas import TABLES
from retinue.sources.tables import Tables


def key_violations(t: Tables, table: str) -> DataFrame:
    """Keys that repeat or hold a NULL."""
    key = TABLES[table].key
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in key])
    return (
        t[table]
        .groupBy(*key)
        .agg(F.count("*").alias("nb_lignes"))
        .where((F.col("nb_lignes") > 1) | missing)
    )


def repeated_keys(t: Tables, table: str) -> DataFrame:
    return duplicate_keys(t[table], TABLES[table].key)


def missing_values(t: Tables, table: str) -> DataFrame:
    """NULLs per required column, from one pass over the table."""
    required = TABLES[table].required
    counts = t[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "colonne", "nb_violations").select(
        F.lit(table).alias("table_name"), "colonne", "nb_violations"
    )


def missing_parents(t: Tables, table: str, column: str) -> DataFrame:
    """Referenced keys that do not exist, with the number of rows that name them.

    Counting per key first leaves one row of a hot key for the join.
    """
    parent, parent_key = TABLES[table].references[column]
    named = t[table].where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("nb_lignes"))
    known = t[parent].select(F.col(parent_key).alias(column))
    return named.join(known, column, "left_anti")


def out_of_range(t: Tables, table: str, column: str) -> DataFrame:
    low, high = TABLES[table].ranges[column]
    return t[table].where(~F.col(column).between(low, high))


def _line(check: str, table: str, columns: Sequence[str], violations: DataFrame) -> DataFrame:
    """``violations`` is a one-row frame with the column ``nb_violations``."""
    return violations.select(
        F.lit(check).alias("controle"),
        F.lit(table).alias("table_name"),
        F.lit(",".join(columns)).alias("colonnes"),
        F.col("nb_violations").cast("bigint").alias("nb_violations"),
    )


def key_report(t: Tables, composite: bool) -> DataFrame:
    """Number of bad keys of every table with a single-column or a composite key."""
    lines = [
        _line("cle", name, spec.key, key_violations(t, name).agg(F.count("*").alias("nb_violations")))
        for name, spec in TABLES.items()
        if (len(spec.key) > 1) == composite
    ]
    return reduce(DataFrame.unionByName, lines)


def presence_report(t: Tables) -> DataFrame:
    lines = [
        missing_values(t, name).select(
            F.lit("non_null").alias("controle"),
            "table_name",
            F.col("colonne").alias("colonnes"),
            F.col("nb_violations").cast("bigint").alias("nb_violations"),
        )
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, lines)


def reference_report(t: Tables) -> DataFrame:
    """Rows with an unknown parent, per reference."""
    lines = [
        _line(
            "reference",
            name,
            [column],
            missing_parents(t, name, column).agg(
                F.coalesce(F.sum("nb_lignes"), F.lit(0)).alias("nb_violations")
            ),
        )
        for name, spec in TABLES.items()
        for column in spec.references
    ]
    return reduce(DataFrame.unionByName, lines)


def range_report(t: Tables) -> DataFrame:
    lines = [
        _line(
            "domaine",
            name,
            [column],
            t[name].agg(F.count_if(~F.col(column).between(low, high)).alias("nb_violations")),
        )
        for name, spec in TABLES.items()
        for column, (low, high) in spec.ranges.items()
    ]
    return reduce(DataFrame.unionByName, lines)


# --- all rules in one pass -------------------------------------------------------------

# Every row becomes a few counted facts: its own key, each parent it names, and which of its
# values are faulty, if any. Facts about one key meet in one group, whichever table they come
# from: ``n0`` counts rows that have the key, ``n1`` and on rows of the tables that refer to it.
# Faults of a table meet by their combination, so keys carry no counts of them. Tables are
# numbered, as names would take most of a fact.

_TABLES = list(TABLES)


def _children(table: str) -> list[tuple[str, str]]:
    """Tables and columns that refer to a table, in order."""
    return [
        (name, column) for name, spec in TABLES.items() for column, (parent, _) in spec.references.items() if parent == table
    ]


def _faults(table: str) -> dict[tuple[str, str], str]:
    spec = TABLES[table]
    return {("non_null", c): f"{c} IS NULL" for c in spec.required} | {
        ("domaine", c): f"NOT {c} BETWEEN {low} AND {high}" for c, (low, high) in spec.ranges.items()
    }


_ROWS = [f"n{i}" for i in range(1 + max(len(_children(name)) for name in TABLES))]
_FAULTS = [f"f{i}" for i in range(max(len(_faults(name)) for name in TABLES))]


def _fact(domain: int, values: Sequence[str], counter: str) -> str:
    keys = [f"cast({v} AS string)" for v in values] + ["cast(NULL AS string)"] * (2 - len(values))
    counters = ", ".join(f"'{c}', {int(c == counter)}" for c in _ROWS)
    return f"named_struct('domaine', {domain}, 'v1', {keys[0]}, 'v2', {keys[1]}, {counters})"


def _facts(t: Tables, table: str) -> DataFrame:
    """Faulty values are bits of ``v1``, in a domain of their own: the table's, negative."""
    spec, number = TABLES[table], _TABLES.index(table) + 1
    facts = [_fact(number, spec.key, "n0")]
    for column, (parent, _) in spec.references.items():
        facts.append(_fact(_TABLES.index(parent) + 1, [column], f"n{1 + _children(parent).index((table, column))}"))
    faults = " + ".join(f"if({bad}, {1 << i}, 0)" for i, bad in enumerate(_faults(table).values()))
    facts.append(_fact(-number, [f"({faults or 0})"], "n0"))
    return t[table].selectExpr(f"inline(array({', '.join(facts)}))").where("domaine > 0 OR v1 != '0'")


def _rules() -> list[tuple[str, str, str, str, str]]:
    """Rule, table, columns, and where its violations are counted: domain and measure."""
    rules = []
    for name, spec in TABLES.items():
        rules.append(("cle", name, ",".join(spec.key), name, "cles"))
        rules += [(check, name, column, name, f) for f, (check, column) in zip(_FAULTS, _faults(name))]
        for column, (parent, _) in spec.references.items():
            rules.append(("reference", name, column, parent, f"n{1 + _children(parent).index((name, column))}"))
    return rules


def constraints(t: Tables) -> DataFrame:
    """All rules in one report: rule, table, columns, violations.

    Each table is read once. Facts are counted per key on the map side and once more after
    the only shuffle of keys; no table is joined with another, and hot keys are one row a task.
    """
    facts = reduce(DataFrame.unionByName, [_facts(t, name) for name in TABLES])
    per_key = facts.groupBy("domaine", "v1", "v2").agg(*[F.sum(c).alias(c) for c in _ROWS])
    composite = ", ".join(str(n + 1) for n, name in enumerate(_TABLES) if len(TABLES[name].key) > 1)
    missing = f"(v1 IS NULL OR (domaine IN ({composite}) AND v2 IS NULL))"
    names = F.array(*[F.lit(name) for name in _TABLES])
    per_domain = per_key.groupBy(F.get(names, F.abs("domaine") - 1).alias("domaine")).agg(
        F.expr(f"count_if(domaine > 0 AND (n0 > 1 OR (n0 = 1 AND {missing})))").alias("cles"),
        *[F.expr(f"sum(if(domaine > 0 AND n0 = 0 AND v1 IS NOT NULL, {c}, 0))").alias(c) for c in _ROWS[1:]],
        *[
            F.expr(f"sum(if(domaine < 0 AND (cast(if(domaine < 0, v1, '0') AS int) & {1 << i}) != 0, n0, 0))").alias(c)
            for i, c in enumerate(_FAULTS)
        ],
    )
    counted = per_domain.unpivot(["domaine"], per_domain.columns[1:], "mesure", "nb_violations")
    names = ("controle", "table_name", "colonnes", "domaine", "mesure")
    rules = ", ".join(
        f"named_struct({', '.join(f"'{n}', '{v}'" for n, v in zip(names, rule, strict=True))})" for rule in _rules()
    )
    listed = facts.sparkSession.range(1).selectExpr(f"inline(array({rules}))")
    return listed.join(counted, ["domaine", "mesure"], "left").select(
        *names[:3], F.coalesce("nb_violations", F.lit(0)).cast("bigint").alias("nb_violations")
    )
