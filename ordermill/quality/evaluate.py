"""Evaluate a dataset's rules over its raw records and split them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ordermill.functions.values import blank_to_null, count_if, parse_as, upper_code
from ordermill.model import ALLOWED, KEY, LINEAGE, SOURCE
from ordermill.operators.lookup import MOST_BROADCAST, bounded, known_keys
from ordermill.operators.places import PLACE, blocks_of, placed, with_marks
from ordermill.quality.catalog import CATALOG, WAVES, parents_of
from ordermill.quality.rules import ERROR, POSITION, Rule, Scope, SetRule
from ordermill.session import side_by_side

BROKEN = "_broken_rules"  # one bit per rule of the dataset, in catalogue order
LONG_LIST = MOST_BROADCAST  # keys; longer lists are not broadcast
Keep = Callable[[str, DataFrame], DataFrame]  # write a frame under a name, return the copy
LINEAGE_COLUMNS = LINEAGE.fieldNames()


def normalise(raw: DataFrame, dataset: str, *also: str) -> DataFrame:
    """Source columns trimmed, blank ones NULL, codes in upper case; lineage and columns ``also`` named as they are."""

    def cleaned(name: str):
        value = blank_to_null(F.col(name))
        return (upper_code(value) if name in ALLOWED else value).alias(name)

    return raw.select(*map(cleaned, SOURCE[dataset].fieldNames()), *LINEAGE_COLUMNS, *also)


def by_positions(records: DataFrame, scope: Scope, rules: list[SetRule]) -> DataFrame:
    """``records`` with the rules' columns, by the positions of broken records; lazy."""
    lists = [(rule, rule.positions(records, scope)) for rule in rules]
    lists = [(rule, positions) for rule, positions in lists if positions is not None]
    joined, found = with_positions(records, lists)
    return joined.withColumns({rule.name: found[rule] for rule, _ in lists}).drop("_bits")


def by_keys(
    records: DataFrame,
    scope: Scope,
    rules: list[SetRule],
    keep: Keep,
    located: DataFrame | None = None,
) -> DataFrame:
    """``records`` with the rules' columns, by the keys that break them, which ``keep`` writes side by side.

    Short lists are joined to the records as they lie.  Long ones lead to the places of records in their files, from
    narrow rows, and what is joined to ``located``, the records with their places, are bitmaps of the places.  Records
    without places are joined to a single long list, for which Spark shuffles them once; several lead to positions
    first, and the records are shuffled once for all positions.
    """

    def listed(rule: SetRule) -> tuple[DataFrame | None, bool]:
        keys = rule.keys(records, scope)
        if keys is None:
            return None, True
        written = keep(f"keys_{rule.rule_id}", keys)
        count = written.count()
        return bounded(written, count), count > LONG_LIST

    rules = [rule for rule in rules if not rule.decided(scope)]
    lists = dict(zip(rules, side_by_side([partial(listed, rule) for rule in rules]), strict=True))
    long = [(rule, keys) for rule, (keys, many) in lists.items() if many]
    place = POSITION
    if long and located is not None:
        records, place = located, PLACE
    elif len(long) == 1 and long[0][1] is not None:
        long = []
    narrow = {rule: rule.positions_by(records, keys, place) for rule, keys in long}
    for rule, (keys, _) in lists.items():
        if rule not in narrow:
            records = rule.joined(records, keys)
    if not narrow:
        return records
    rows = [rows for rows, _ in narrow.values()]
    if place == PLACE:
        blocks = keep(f"marks_{next(iter(narrow)).rule_id}", blocks_of(rows))
        joined, marks = with_marks(records, blocks, len(rows))
        found = dict(zip(narrow, marks, strict=True))
    else:
        joined, found = with_positions(records, list(zip(narrow, rows, strict=True)))
    return joined.withColumns(
        {rule.name: rule.told(found[rule], sound) for rule, (_, sound) in narrow.items()}
    )


def with_positions(
    records: DataFrame, lists: list[tuple[SetRule, DataFrame]]
) -> tuple[DataFrame, dict[SetRule, Column]]:
    """``records`` joined with lists of positions, and per rule whether a record's is in its list."""
    if not lists:
        return records, {}
    marked = (rows.withColumn("_bit", F.lit(1 << bit)) for bit, (_, rows) in enumerate(lists))
    found = reduce(DataFrame.unionByName, marked)
    found = found.groupBy(POSITION).agg(F.bit_or("_bit").alias("_bits"))
    bits = F.coalesce("_bits", F.lit(0))
    return records.join(found, POSITION, "left"), {
        rule: bits.bitwiseAND(F.lit(1 << bit)) != 0 for bit, (rule, _) in enumerate(lists)
    }


def tag(
    raw: DataFrame,
    dataset: str,
    scope: Scope,
    rules: tuple[Rule, ...] | None = None,
    keep: Keep | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Normalised records with the rules each one breaks, as bits in ``_broken_rules``.

    With ``keep`` the broken keys and then the tagged records are written, so that the rules are
    evaluated once however often the result is read; ``seen`` gets the counts of :func:`summary` from
    that write.  Spark joins the keys by their written size: few are broadcast, many sorted and
    merged.
    """
    rules = CATALOG[dataset] if rules is None else rules
    records = normalise(raw, dataset)
    columns = records.columns
    set_rules = [rule for rule in rules if isinstance(rule, SetRule)]
    if keep:
        located = placed(raw)
        located = None if located is None else normalise(located, dataset, PLACE)
        records = by_keys(records, scope, set_rules, keep, located)
    else:
        records = by_positions(records, scope, set_rules)
    marks = (F.when(r.failed(scope), F.lit(_bit(dataset, r))).otherwise(0) for r in rules)
    tagged = records.select(*columns, reduce(Column.bitwiseOR, marks).cast("long").alias(BROKEN))
    if seen is not None:
        tagged = tagged.observe(seen, *summary_columns(dataset))
    return keep(f"{dataset}_tagged", tagged) if keep else tagged


def _bit(dataset: str, rule: Rule) -> int:
    return 1 << CATALOG[dataset].index(rule)


def breaks(dataset: str, *rules: Rule) -> Column:
    """Whether a tagged record breaks any of ``rules``."""
    return F.col(BROKEN).bitwiseAND(F.lit(sum(_bit(dataset, r) for r in rules))) != 0


def breaks_only(dataset: str, rule: Rule) -> Column:
    """Whether a tagged record breaks ``rule`` and no other.

    Looks at the bits once: Spark puts the rules themselves in the place of a column that it filters by, as
    often as the filter names it.
    """
    return F.col(BROKEN) == F.lit(_bit(dataset, rule))


def held_back(dataset: str) -> Column:
    """Whether a tagged record breaks a rule of severity ERROR."""
    return breaks(dataset, *(r for r in CATALOG[dataset] if r.severity == ERROR))


def broken_ids(dataset: str) -> Column:
    """Ids of the rules a tagged record breaks, joined by ``;``."""
    ids = (F.when(breaks(dataset, r), F.lit(r.rule_id)) for r in CATALOG[dataset])
    return F.concat_ws(";", *ids)


def valid_records(tagged: DataFrame, dataset: str) -> DataFrame:
    """Records without errors, in their types; warnings do not hold a record back."""
    typed = (parse_as(F.col(f.name), f.dataType).alias(f.name) for f in SOURCE[dataset])
    return tagged.where(~held_back(dataset)).select(*typed, *LINEAGE_COLUMNS)


def valid_keys(tagged: DataFrame, dataset: str) -> DataFrame:
    """Business keys of the records without errors."""
    return tagged.where(~held_back(dataset)).select(KEY[dataset])


def quarantined_records(tagged: DataFrame, dataset: str, validated_at) -> DataFrame:
    """Records with errors as text, with the ids of all broken rules, warnings too."""
    return tagged.where(held_back(dataset)).select(
        *SOURCE[dataset].fieldNames(),
        *LINEAGE_COLUMNS,
        broken_ids(dataset).alias("_dq_failed_rules"),
        F.lit(validated_at).cast("timestamp").alias("_dq_validated_at"),
    )


def summary_columns(dataset: str) -> list[Column]:
    """Aggregates over tagged records: ``total``, ``valid`` and one count per rule of the dataset."""
    return [
        F.count(F.lit(1)).alias("total"),
        count_if(~held_back(dataset)).alias("valid"),
        *(count_if(breaks(dataset, rule)).alias(rule.rule_id) for rule in CATALOG[dataset]),
    ]


def summary(tagged: DataFrame, dataset: str) -> DataFrame:
    """One row of :func:`summary_columns`."""
    return tagged.agg(*summary_columns(dataset))


def rule_counts(counts: DataFrame, dataset: str) -> DataFrame:
    """:func:`summary` as one row per rule."""
    rules = CATALOG[dataset]
    pairs = ", ".join(f"'{r.rule_id}', '{r.severity}', `{r.rule_id}`" for r in rules)
    return counts.selectExpr(
        f"'{dataset}' AS dataset",
        f"stack({len(rules)}, {pairs}) AS (rule_id, severity, failed_records)",
    )


def scope_for(
    dataset: str,
    records: DataFrame,
    run_date,
    valid_parents: dict[str, DataFrame],
    earlier_parents: dict[str, DataFrame],
) -> Scope:
    """Parent keys seen by ``records``: valid ones of this batch and those of earlier run dates.

    Frames in both dictionaries need only the parent's key column.  A parent without either has no
    known keys.
    """
    parents, sources = {}, {}
    for parent in parents_of(dataset):
        frames = [
            side[parent].select(KEY[parent])
            for side in (valid_parents, earlier_parents)
            if side.get(parent) is not None
        ]
        if frames:
            sources[parent] = tuple(frames)
            columns = {r.column for r in CATALOG[dataset] if getattr(r, "parent", None) == parent}
            seen = F.explode(F.array(*(blank_to_null(F.col(name)) for name in sorted(columns))))
            parents[parent] = known_keys(records.select(seen.alias("key")), *frames)
    return Scope(SOURCE[dataset], run_date, parents, sources)


def tag_all(
    raw: dict[str, DataFrame],
    run_date,
    earlier: dict[str, DataFrame] | None = None,
    keep: Keep | None = None,
) -> dict[str, DataFrame]:
    """Tag all datasets, parents first; a record whose parent is held back is held back too.

    ``keep(name, df)`` may write a frame and return the written copy (see :func:`tag`); the
    datasets of a wave are then evaluated together.
    """
    tagged, valid = {}, {}

    def one(dataset: str) -> DataFrame:
        scope = scope_for(dataset, raw[dataset], run_date, valid, earlier or {})
        return tag(raw[dataset], dataset, scope, keep=keep)

    for wave in WAVES:
        made = side_by_side([partial(one, name) for name in wave]) if keep else map(one, wave)
        for dataset, frame in zip(wave, made, strict=True):
            tagged[dataset] = frame
            valid[dataset] = valid_keys(frame, dataset)
    return tagged
