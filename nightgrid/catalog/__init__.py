"""All registered queries, by inventory key, with the SQL that checks them."""

from nightgrid.catalog import (  # noqa: F401 - importing registers the entries
    chart_entries,
    check_entries,
    function_entries,
    grid_entries,
    ingest_entries,
    summary_entries,
)
from nightgrid.catalog.registry import QUERIES, SQL  # noqa: F401
