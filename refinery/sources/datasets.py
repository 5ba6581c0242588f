"""Descriptions of landed datasets: where they lie, how a page wraps its records."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

# The JSON paths at which each kind of page holds its records. Where a
# payload may be a bare list or an object, both paths are tried in this order.
PAGE_SHAPES = {
    "SINGLE": ("$.results", "$"),
    "OFFSET": ("$",),
    "NEXT": ("$.results",),
    "JIRA_NEXT": ("$.issues",),
    "GRAPH_NEXT": ("$.value",),
    "ODATA_NEXT": ("$.value",),
    "TEMPO_NEXT": ("$.results",),
}


@dataclass(frozen=True)
class Dataset:
    """One dataset to land: ``pagination`` names the page shape, ``path`` the page files."""

    name: str
    source: str
    path: str
    pagination: str
    bronze_table: str
    incremental_field: str | None = None
    params: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.pagination not in PAGE_SHAPES and self.pagination != "TABULAR_FILE":
            raise ValueError(f"dataset {self.name}: unknown pagination '{self.pagination}'")

    @property
    def pipeline(self) -> str:
        """Owner of the dataset's high-water mark."""
        return f"{self.source}_ingestion"

    @property
    def record_paths(self) -> tuple[str, ...]:
        return PAGE_SHAPES[self.pagination]

    def request_params(self, mark: datetime | None = None, *, full_load: bool = False) -> dict:
        """Parameters that ask the source for records after the mark only.

        The OData form takes whole seconds and a ``$filter``; the other form takes
        microseconds, quotes and ``query``.
        """
        params = dict(self.params)
        if full_load or mark is None or not self.incremental_field:
            return params
        if self.pagination == "ODATA_NEXT":
            params["$filter"] = f"{self.incremental_field} gt {mark:%Y-%m-%dT%H:%M:%S}Z"
        else:
            params["query"] = f"{self.incremental_field}>'{mark:%Y-%m-%dT%H:%M:%S.%f}Z'"
        return params
