"""Species-code expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from nightgrid import constants as K
from nightgrid.functions.numbers import as_column


def recode_species(code) -> Column:
    """Four-letter codes to six letters; everything else passes through.

    All keys have four letters, so the map is only searched for those.
    """
    code = as_column(code)
    table = F.create_map(
        *[F.lit(x) for x in chain.from_iterable(K.SPECIES_CODES_4_TO_6.items())]
    )
    return F.when(F.length(code) == 4, F.coalesce(F.try_element_at(table, code), code)).otherwise(code)


def is_valid_label(label) -> Column:
    label = as_column(label)
    return label.isNotNull() & ~label.isin(*K.INVALID_SPECIES_LABELS)


def unified_species(manual_id, auto_id) -> Column:
    """Manual label if valid, else automatic label if valid, else 'NoID'."""
    manual, auto = as_column(manual_id), as_column(auto_id)
    return (
        F.when(is_valid_label(manual), manual)
        .when(is_valid_label(auto), auto)
        .otherwise(F.lit(K.AUTO_NOID))
    )


def is_identified(species) -> Column:
    species = as_column(species)
    return species.isNotNull() & ~species.isin(*K.CHART_UNIDENTIFIED)


def is_unidentified(species) -> Column:
    """Never NULL: a missing label counts as unidentified."""
    species = as_column(species)
    return species.isNull() | species.isin(*K.CHART_UNIDENTIFIED)


def is_unidentified_any_case(species) -> Column:
    species = as_column(species)
    return (
        species.isNull()
        | (species == "")
        | F.lower(species).isin(*K.UNIDENTIFIED_ANY_CASE)
    )
