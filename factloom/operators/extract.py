"""Facts blob -> one typed row per entry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import pad_identifier, strict_date, strict_double, value_type
from factloom.operators.normalize import normalize_tag, tracked_only
from factloom.params import DEFAULTS, Params
from factloom.schemas import FACT_ENTRY

# A concept is read at once down to its entries, which stay text. One that cannot be is read level
# by level, each from the text of the one above it. So what cannot be read costs itself alone,
# and says where it stood.
TAXONOMY = "`us-gaap` MAP<STRING, STRING>"
UNREAD = "_unread"
AT_ONCE = f"units MAP<STRING, ARRAY<STRING>>, {UNREAD} STRING"
CONCEPT = "units STRING"
UNITS = "MAP<STRING, STRING>"
ENTRIES = "ARRAY<STRING>"

NO_CONCEPT, NO_UNITS = "concept is no object", "units is no object"
REPEATED_UNIT, NO_ARRAY, NO_ENTRY = "repeated unit", "unit is no array", "entry is no object"


def read_entries(
    bronze: DataFrame,
    seed: DataFrame | None = None,
    units: tuple[str, ...] = DEFAULTS.units,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every entry of the wanted units: cik, entity_name, raw_concept, unit, entry_text, reason.

    `reason` is null for an entry that can be read. A concept, a `units`, a unit or an entry
    that cannot is a row of its own with the reason, and null for what lies below it. A unit
    that its concept names twice has no single reading and gives no entries. Absent or empty
    taxonomies, units and arrays give no rows. With `seed` only the concepts it lists are
    read beyond their name, whatever its size. `carry` names columns of the document that each
    of its rows keeps, here and in the functions below.
    """
    gaap = F.from_json("facts_blob", TAXONOMY)["us-gaap"]
    concepts = bronze.select(
        *carry, pad_identifier("cik_raw").alias("cik"), "entity_name",
        # Exploding the bare column would make the optimizer test it for rows first, below
        # the projection, and so parse every document again for the test.
        F.explode(F.map_filter(gaap, lambda name, _: name.isNotNull())).alias("raw_concept", "concept"),
    )
    if seed is not None:
        concepts = tracked_only(seed)(concepts)
    named = [*carry, "cik", "entity_name", "raw_concept"]
    read = concepts.filter(F.col("concept").isNotNull()).select(
        *named, "concept", F.from_json("concept", AT_ONCE, {"columnNameOfCorruptRecord": UNREAD}).alias("parsed")
    )
    # Kept apart from the parse above, so that the second one is only made where it is needed.
    found = F.when(_is_read(), _units_read(units)).otherwise(_units_by_level(units))
    arrays = read.select(*named, F.explode_outer(found).alias("u")).filter("u IS NOT NULL")
    entries = arrays.select(*named, "u.unit", "u.above", "u.entries")
    # A unit named twice came as two rows.
    entries = entries.filter("above IS NOT NULL OR size(entries) > 0")
    single = entries.select(*named, "unit", "above", F.explode_outer("entries").alias("entry_text"))
    bad = F.col("above").isNull() & ~F.coalesce(F.col("entry_text").startswith("{"), F.lit(False))
    return single.select(
        *named, "unit", "entry_text", F.when(bad, NO_ENTRY).otherwise(F.col("above")).alias("reason")
    )


def _is_read() -> Column:
    """Whether one parse of the concept gave all there is in it."""
    parsed = F.col("parsed")
    return F.col("concept").startswith("{") & parsed.isNotNull() & parsed[UNREAD].isNull()


def _each_unit(by_unit: Column, units: tuple[str, ...], value: Callable[[Column], Column], unread: str) -> Column:
    """Wanted units of a map as (unit, above, entries); `value` makes entries of what the map holds."""
    names = F.map_keys(by_unit)
    wanted = F.filter(F.map_entries(by_unit), lambda e: e["key"].isin(*units) & e["value"].isNotNull())

    def one(e: Column) -> Column:
        twice = F.size(F.filter(names, lambda n: n == e["key"])) > 1
        entries = F.when(~twice, value(e["value"]))
        reason = F.when(twice, REPEATED_UNIT).when(entries.isNull(), unread)
        return _unit(e["key"], reason, entries)

    return F.transform(wanted, one)


def _unit(name: Column, above: Column, entries: Column) -> Column:
    return F.struct(
        name.cast("string").alias("unit"), above.cast("string").alias("above"),
        entries.cast("array<string>").alias("entries"),
    )


def _units_read(units: tuple[str, ...]) -> Column:
    return _each_unit(F.col("parsed")["units"], units, lambda entries: entries, NO_ARRAY)


def _units_by_level(units: tuple[str, ...]) -> Column:
    """The same for a concept that one parse could not read whole, level by level."""
    text = F.from_json("concept", CONCEPT)["units"]
    by_unit = F.from_json(text, UNITS)
    above = F.when(~F.col("concept").startswith("{"), NO_CONCEPT).when(text.isNotNull() & by_unit.isNull(), NO_UNITS)
    whole = F.array(_unit(F.lit(None), above, F.lit(None)))
    return F.when(above.isNotNull(), whole).otherwise(
        _each_unit(by_unit, units, lambda entries: F.from_json(entries, ENTRIES), NO_ARRAY)
    )


def good_entries(entries: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Readable entries of `read_entries` as structs: cik, entity_name, raw_concept, unit, entry."""
    # Exploded, so that the optimizer leaves a filter on fields of the entry above the parse; moved
    # below it, the filter would parse the entry again for each mention of a field.
    parsed = F.explode_outer(F.array(F.from_json("entry_text", FACT_ENTRY)))
    return entries.filter("reason IS NULL").select(
        *carry, "cik", "entity_name", "raw_concept", "unit", parsed.alias("entry")
    )


def unreadable(entries: DataFrame) -> DataFrame:
    """(cik, raw_concept, unit, reason, n): what `read_entries` could not read, and how often."""
    return entries.filter("reason IS NOT NULL").groupBy("cik", "raw_concept", "unit", "reason").agg(
        F.count(F.lit(1)).alias("n")
    )


def unnest_all(bronze: DataFrame, units: tuple[str, ...] = DEFAULTS.units) -> DataFrame:
    """The readable entries of every concept: cik, entity_name, raw_concept, unit, entry."""
    return good_entries(read_entries(bronze, None, units))


def unnest_tracked(
    bronze: DataFrame,
    seed: DataFrame,
    units: tuple[str, ...] = DEFAULTS.units,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of `unnest_all` whose concept the seed lists."""
    return good_entries(read_entries(bronze, seed, units, carry), carry)


def extract_entries(entries: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Entry structs -> typed columns, nothing filtered yet."""
    return entries.select(
        *carry,
        "cik",
        "entity_name",
        "raw_concept",
        strict_double("entry.val").alias("reported_value"),
        strict_date("entry.start").alias("period_start"),
        strict_date("entry.end").alias("period_end"),
        F.col("entry.accn").alias("accession_number"),
        F.upper("entry.form").alias("form_type"),
        strict_date("entry.filed").alias("filed_date"),
        F.col("entry.fp").alias("fiscal_period_label"),
        value_type("entry.start").alias("value_type"),
    )


def usable_facts(facts: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Rows with a value, a period end and a form that is not excluded (null forms go too)."""
    # The form first: it spares the excluded rows their casts.
    return facts.filter(
        ~F.col("form_type").isin(*params.excluded_forms)
        & F.col("reported_value").isNotNull()
        & F.col("period_end").isNotNull()
    )


def typed_facts(
    entries: DataFrame, seed: DataFrame, params: Params = DEFAULTS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Typed, filtered and normalised facts of readable entries."""
    return normalize_tag(seed)(usable_facts(extract_entries(entries, carry), params))


def extracted_facts(
    bronze: DataFrame, seed: DataFrame, params: Params = DEFAULTS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Tracked, typed, filtered and normalised facts of the bronze documents."""
    return typed_facts(unnest_tracked(bronze, seed, params.units, carry), seed, params, carry)
