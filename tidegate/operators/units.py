"""Unit-of-measure dimension: build, check and look up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidegate.functions import code_text, strip
from tidegate.operators.keys import key_counts, unique_lookup
from tidegate.operators.numbering import number_rows
from tidegate.runtime import fits_broadcast, materialize, scratch_path
from tidegate.schemas import UNIT_MAPPING_COLUMNS

KNOWN_SHOWN = 20  # known codes that an error names


def clean_mapping(mapping: DataFrame, position: str) -> DataFrame:
    """One row per code; a later row (by ``position``) replaces an earlier one.

    Codes are upper-cased, all text is stripped, rows without code or name are dropped.
    """
    absent = [c for c in UNIT_MAPPING_COLUMNS if c not in mapping.columns]
    if absent:
        raise ValueError(f"unit mapping lacks column(s) {absent}; it has {mapping.columns}")
    rows = mapping.select(
        code_text(F.col("source_code")).alias("code"),
        strip(F.col("target_name")).alias("target_name"),
        strip(F.col("category")).alias("category"),
        F.col(position).alias("_pos"),
    ).where((F.col("code") != "") & (F.col("target_name") != ""))
    last = F.max_by(F.struct("target_name", "category"), F.col("_pos"))
    return rows.groupBy("code").agg(last.alias("_last")).select(
        "code", "_last.target_name", "_last.category"
    )


def first_target_units(target: DataFrame, position: str) -> DataFrame:
    """Target units with the first id (by ``position``) of each name."""
    return target.groupBy("name").agg(F.min_by("id", position).alias("id")).select("id", "name")


class UnresolvedUnits(ValueError):
    """Codes of a mapping name no target unit.  ``path`` holds the table of all of them."""

    def __init__(self, count: int, path: str, first: list[str]):
        super().__init__(
            f"{count} unit mapping(s) name no target unit, all listed in {path}; first {', '.join(first)}"
        )
        self.count, self.path = count, path


def _named(mapping: DataFrame, target: DataFrame) -> DataFrame:
    """The mapping with ``id`` and ``_hit``.  Few names hold most codes, so names are hot keys."""
    side = target.select(F.col("name").alias("target_name"), "id", F.lit(True).alias("_hit"))
    return unique_lookup(mapping, side, ["target_name"])


def _resolved(named: DataFrame) -> DataFrame:
    return named.where("_hit").select("code", "id", F.col("target_name").alias("name"), "category")


def _unresolved(named: DataFrame) -> DataFrame:
    return named.where("_hit IS NULL").select("code", "target_name")


def resolve_mapping(mapping: DataFrame, target: DataFrame) -> DataFrame:
    """Mapped codes whose target name exists: (code, id, name, category).

    ``target`` holds a name once (``first_target_units``).
    """
    return _resolved(_named(mapping, target))


def unresolved_mapping(mapping: DataFrame, target: DataFrame) -> DataFrame:
    """Mapped codes whose target name does not exist."""
    return _unresolved(_named(mapping, target))


def build_dimension(mapping: DataFrame, target: DataFrame) -> DataFrame:
    """Resolved dimension, stored, or ``UnresolvedUnits`` with a table of the codes that do not resolve."""
    named = materialize(_named(mapping, target), "units")
    bad = _unresolved(named)
    first = bad.orderBy("code").take(3)
    if first:
        path = scratch_path(mapping.sparkSession, "unresolved-units")
        bad.write.parquet(path)
        raise UnresolvedUnits(bad.count(), path, [f"{r.code} -> {r.target_name}" for r in first])
    return _resolved(named)


def offline_target_units(mapping: DataFrame, position: str) -> DataFrame:
    """Stand-in target units: distinct mapped names numbered by first appearance."""
    names = (
        mapping.select(
            strip(F.coalesce("target_name", F.lit(""))).alias("name"), F.col(position).alias("_pos")
        )
        .groupBy("name")
        .agg(F.min("_pos").alias("_first"))
    )
    numbered = number_rows(names, ["_first", "name"], F.lit(0), "id")
    return numbered.select(F.col("id").cast("bigint"), "name")


def known_codes(units: DataFrame) -> DataFrame:
    """Resolvable codes, sorted."""
    return units.select("code").distinct().orderBy("code")


def unknown_codes(items: DataFrame, units: DataFrame) -> DataFrame:
    """Non-empty unit codes of the batch that the dimension does not hold."""
    used = (
        items.select(F.explode(F.array("_source_unit1", "_source_unit2")).alias("code"))
        .where(F.col("code") != "")
        .distinct()
    )
    return used.join(units.select("code"), "code", "left_anti")


def resolve_units(df: DataFrame, units: DataFrame, code: str = "uom_id") -> DataFrame:
    """Attach the dimension row of the code column; rows without one get nulls."""
    side = units.select(
        F.col("code").alias(code),
        F.col("id").alias("_unit_id"),
        F.col("name").alias("_unit_name"),
        F.col("category").alias("_unit_category"),
    )
    return unique_lookup(df, side, [code])


class UnknownUnit(LookupError):
    """A unit code that the dimension does not hold."""


def resolve_code(units: DataFrame, code: str | None) -> Row:
    """The dimension row (code, id, name, category) of one code, trimmed and in upper case.

    Raises ``UnknownUnit``, which tells the first of the known codes, for any other code and for none.
    """
    wanted = (code or "").strip().upper()
    row = units.where(F.col("code") == wanted).select("code", "id", "name", "category").first()
    if row is None:
        known = [r[0] for r in known_codes(units).limit(KNOWN_SHOWN + 1).collect()]
        more = ", ..." if len(known) > KNOWN_SHOWN else ""
        raise UnknownUnit(f"unknown unit {code!r}; known: {', '.join(known[:KNOWN_SHOWN])}{more}")
    return row


def with_unit_categories(
    items: DataFrame, units: DataFrame, counted: DataFrame | None = None
) -> DataFrame:
    """Add known-flag and category of both unit columns.

    Codes are counted, where that is needed, in ``counted``: the same rows, cheaper to compute.
    """
    out = items
    small = fits_broadcast(units)
    counted = items if counted is None else counted
    for n in ("1", "2"):
        side = units.select(
            F.col("code").alias(f"_source_unit{n}"),
            F.col("category").alias(f"_unit{n}_category"),
            F.lit(True).alias(f"_unit{n}_hit"),
        )
        key = [f"_source_unit{n}"]
        out = unique_lookup(out, side, key, frequency=key_counts(counted, key), small=small)
        out = out.withColumn(f"_unit{n}_known", F.coalesce(f"_unit{n}_hit", F.lit(False)))
        out = out.drop(f"_unit{n}_hit")
    return out
