"""The nine kinds of record checks.

A rule says when a record is broken.  Row rules are plain expressions and are all evaluated in one
projection.  The two set rules (``Unique``, ``ExistsIn``) compare records with other records; they
list the keys that break them, or work on one column and the record's position only, so the full records
are not shuffled for each of them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.values import parse_as
from ordermill.operators.lookup import (
    first_positions,
    flag_repeats,
    flag_unknown,
    repeated_keys,
    unknown_keys,
    with_firsts,
    with_known,
    with_unknown,
)

ERROR, WARN = "ERROR", "WARN"
POSITION = "_source_row_number"
#: Distinct share of a column's values below which first copies are listed instead of repeated keys.
MANY_COPIES = 0.875
#: Times that the unknown keys, or the known ones, go into all distinct ones where the other list is the longer.
MOSTLY = 2


@dataclass(frozen=True)
class Scope:
    """What the rules of one dataset may look at besides the record itself.

    ``parents`` holds, per parent dataset, a one-column frame of distinct known keys; ``sources`` the frames
    of keys that these come from, where they are given.
    """

    schema: T.StructType
    run_date: date
    parents: Mapping[str, DataFrame] = field(default_factory=dict)
    sources: Mapping[str, tuple[DataFrame, ...]] = field(default_factory=dict)

    def typed(self, column: str) -> Column:
        return parse_as(F.col(column), self.schema[column].dataType)

    def unreadable(self, column: str) -> Column:
        return F.col(column).isNotNull() & self.typed(column).isNull()


@dataclass(frozen=True)
class Rule:
    rule_id: str
    column: str
    severity: str = field(default=ERROR, kw_only=True)

    def broken(self, scope: Scope) -> Column:
        raise NotImplementedError

    def failed(self, scope: Scope) -> Column:
        """TRUE where the record fails the rule, else FALSE."""
        return F.coalesce(self.broken(scope), F.lit(False))


class NotNull(Rule):
    def broken(self, scope):
        return F.col(self.column).isNull()


class SetRule(Rule):
    """A rule that needs other records, which :meth:`broken` knows from the column :attr:`name`.

    That column is made from :meth:`positions`; or from written :meth:`keys`, which are joined to the records
    by :meth:`joined`, or lead to positions by :meth:`positions_by`.
    """

    @property
    def name(self) -> str:
        """Column that tells whether another record, or its absence, breaks the rule."""
        return f"_{self.rule_id}"

    @property
    def listed(self) -> Column:
        return F.col(self.name)

    def positions(self, records: DataFrame, scope: Scope) -> DataFrame | None:
        """Positions of broken records; None when ``broken`` can tell without them."""
        raise NotImplementedError

    def decided(self, scope: Scope) -> bool:
        """Whether ``broken`` can tell without other records."""
        return False

    def keys(self, records: DataFrame, scope: Scope) -> DataFrame | None:
        """Distinct keys that break the rule; None where they would be too many to be worth listing."""
        raise NotImplementedError

    def joined(self, records: DataFrame, keys: DataFrame) -> DataFrame:
        """``records`` with the column :attr:`name`, by written :meth:`keys`."""
        raise NotImplementedError

    def positions_by(
        self, records: DataFrame, keys: DataFrame | None, place: str = POSITION
    ) -> tuple[DataFrame, bool]:
        """By written :meth:`keys`, the column ``place`` of the broken records that have a value, or of the sound
        ones, and whether it is those of the sound ones."""
        raise NotImplementedError

    def told(self, found: Column, sound: bool) -> Column:
        """The column :attr:`name`, if ``found`` tells that a record is among :meth:`positions_by`."""
        return F.col(self.column).isNotNull() & ~found if sound else found


class Unique(SetRule):
    """Every copy of a key after the first one; NULL keys are left to ``NotNull``."""

    def positions(self, records, scope):
        keyed = records.select(self.column, POSITION).where(F.col(self.column).isNotNull())
        flagged = flag_repeats(keyed, self.column, POSITION, "_later")
        return flagged.where("_later").select(POSITION)

    def keys(self, records, scope):
        values, distinct = records.agg(
            F.count(self.column), F.approx_count_distinct(self.column)
        ).first()
        if distinct < MANY_COPIES * values:
            return None
        return repeated_keys(records, self.column, POSITION)

    def joined(self, records, keys):
        found, later = with_firsts(records, self.column, POSITION, keys, "_first_copy")
        return found.withColumn(self.name, later).drop("_first_copy")

    def positions_by(self, records, keys, place=POSITION):
        """Those of the first copies: each key is one row, and no record is shuffled to look its key up."""
        firsts = first_positions(records, self.column, POSITION, place)
        return firsts.select(F.col("_first").alias(place)), True

    def broken(self, scope):
        return self.listed


@dataclass(frozen=True)
class OneOf(Rule):
    values: tuple[str, ...]

    def broken(self, scope):
        return F.col(self.column).isNull() | ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class InRange(Rule):
    low: int | None = None
    high: int | None = None
    optional: bool = False

    def broken(self, scope):
        value = scope.typed(self.column)
        outside = scope.unreadable(self.column)
        if not self.optional:
            outside = outside | F.col(self.column).isNull()
        if self.low is not None:
            outside = outside | (value < self.low)
        if self.high is not None:
            outside = outside | (value > self.high)
        return outside


@dataclass(frozen=True)
class ValidTime(Rule):
    """Readable as the column's date or timestamp, for all ``columns``; optionally not later than
    the end of the run date."""

    also: tuple[str, ...] = ()
    optional: bool = False
    not_future: bool = False

    def broken(self, scope):
        result = F.lit(False)
        for name in (self.column, *self.also):
            bad = scope.unreadable(name)
            if not self.optional:
                bad = bad | F.col(name).isNull()
            if self.not_future:
                bad = bad | (F.to_date(scope.typed(name)) > F.lit(scope.run_date))
            result = result | F.coalesce(bad, F.lit(False))
        return result


@dataclass(frozen=True)
class NotAfter(Rule):
    """``column`` is not after ``other``, judged only where both are readable."""

    other: str

    def broken(self, scope):
        return scope.typed(self.column) > scope.typed(self.other)


@dataclass(frozen=True)
class ExistsIn(SetRule):
    """``column`` is a key of ``parent``; a parent without known keys breaks every record."""

    parent: str

    def positions(self, records, scope):
        if self.decided(scope):
            return None
        given = records.select(self.column, POSITION).where(F.col(self.column).isNotNull())
        flagged = flag_unknown(given, self.column, scope.parents[self.parent], "_new")
        return flagged.where("_new").select(POSITION)

    def decided(self, scope):
        return scope.parents.get(self.parent) is None

    def keys(self, records, scope):
        """The unknown keys, or where most keys are unknown the known ones, for which no key of a record is looked
        up before the records themselves are.

        Both estimates only choose between the two; the keys of earlier batches are not counted for it.
        """
        known = scope.sources.get(self.parent) or (scope.parents[self.parent],)
        if len(known) == 1:
            distinct = records.agg(F.approx_count_distinct(self.column)).first()[0]
            if MOSTLY * known[0].count() < distinct:
                return known[0].toDF("_known_key").where("_known_key IS NOT NULL").distinct()
        return unknown_keys(records, self.column, *known)

    def joined(self, records, keys):
        by = with_known if "_known_key" in keys.columns else with_unknown
        found, unknown = by(records, self.column, keys, "_listed")
        return found.withColumn(self.name, unknown).drop("_listed")

    def positions_by(self, records, keys, place=POSITION):
        """Those of known keys where these are listed, or where most keys are unknown."""
        key = keys.columns[0]
        given = records.select(F.col(self.column).alias(key), place)
        given = given.where(F.col(key).isNotNull())
        if key == "_known_key":
            return given.join(keys, key, "left_semi").select(place), True
        distinct = records.agg(F.approx_count_distinct(self.column)).first()[0]
        mostly = MOSTLY * keys.count() > distinct
        found = given.join(keys, key, "left_anti" if mostly else "left_semi")
        return found.select(place), mostly

    def broken(self, scope):
        if self.decided(scope):
            return F.lit(True)
        return F.col(self.column).isNull() | self.listed


@dataclass(frozen=True)
class RequiredWhen(Rule):
    when: str
    equals: str

    def broken(self, scope):
        return (F.col(self.when) == self.equals) & F.col(self.column).isNull()
