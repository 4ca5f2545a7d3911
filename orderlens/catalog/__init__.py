"""Every operator as a query on the test tables, with the SQL that must give the same rows."""

from orderlens.catalog import aggregates, joins, projections, scans
from orderlens.catalog.base import Entry

ENTRIES: dict[str, Entry] = {**scans.ENTRIES, **projections.ENTRIES, **joins.ENTRIES, **aggregates.ENTRIES}

__all__ = ["ENTRIES", "Entry"]
