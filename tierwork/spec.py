"""What is particular to one dataset, in one place."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from tierwork.operators.metrics import AverageHours, CountBy, CountByMonth, Metric

# The metadata columns of the bronze layer.
INGEST_TIME_COLUMN = "ingestion_timestamp"
SOURCE_FILE_COLUMN = "source_file_name"
METADATA = (INGEST_TIME_COLUMN, SOURCE_FILE_COLUMN)


@dataclass(frozen=True)
class DatasetSpec:
    """Names, paths and rules of a dataset.

    ``duplicate_key`` is the whole row if left out, load time and source file included, so equal
    records of two loads are two rows; ``across_loads`` makes it the record without these two, and
    the one loaded first stays. ``file_names`` says what the source-file column holds: the name of
    the path read ("path") or of the file each row came from ("each"). ``malformed_column`` is the
    bronze column for the text of records that do not fit their header; such records go to
    quarantine. ``by_name`` lets the files of a load have their columns in different orders. ``multi_line``
    says whether records may span lines; if it does not, a pass over the text finds out, and the
    run compares its count of lines with what arrives.
    ``on_fail``, ``on_loss`` and ``on_date_loss`` say whether nulls in critical columns,
    a row count that does not add up, and dates in no known format stop a run ("raise") or not
    ("warn").
    """

    name: str
    catalog: str | None = None
    schema: str = "default"
    renames: Mapping[str, str] = field(default_factory=dict)
    sanitize: bool = True
    critical: tuple[str, ...] = ()
    duplicate_key: tuple[str, ...] | None = None
    duplicate_order: tuple[str, ...] = ()
    across_loads: bool = False
    defaults: Mapping[str, str] = field(default_factory=dict)
    date_columns: tuple[str, ...] = ()
    date_formats: tuple[str, ...] = ("dd-MM-yyyy HH:mm", "yyyy-MM-dd HH:mm:ss")
    metrics: tuple[Metric, ...] = ()
    infer_types: bool = False
    malformed_column: str = "malformed_record"
    by_name: bool = False
    multi_line: bool | None = None
    file_names: str = "path"
    on_fail: str = "warn"
    on_loss: str = "raise"
    on_date_loss: str = "warn"

    def __post_init__(self) -> None:
        reactions = ("raise", "warn")
        for name, allowed in (
            ("file_names", ("path", "each")),
            ("on_fail", reactions),
            ("on_loss", reactions),
            ("on_date_loss", reactions),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} is one of {', '.join(allowed)}, not {getattr(self, name)!r}")
        if self.across_loads and self.duplicate_key is not None:
            raise ValueError("across_loads names a duplicate key already")

    def table(self, layer: str) -> str:
        """Full name of a layer's table: bronze, silver, quarantine, gold or quality."""
        own = "quality_report" if layer == "quality" else f"{layer}_{self.name}"
        return ".".join(part for part in (self.catalog, self.schema, own) if part)


# Columns, defaults, formats and metrics of the incident dataset.
INCIDENTS = DatasetSpec(
    name="incidents",
    renames={
        "User ID": "User_ID",
        "Assignment group": "Assignment_Group",
        "Assigned to": "Assigned_To",
        "Service Family": "Service_Family",
        "Service Subcategory": "Service_Subcategory",
        "Updated by": "Updated_By",
    },
    critical=("Number", "Category", "Priority", "State"),
    defaults={
        "short_description": "No Description",
        "Caller": "Unknown",
        "User_ID": "Unknown",
        "Assignment_Group": "Unassigned",
        "Assigned_To": "Unassigned",
        "Channel": "Unknown",
        "Service": "Unknown",
        "Service_Family": "Unknown",
        "Service_Subcategory": "Unknown",
        "Updated_By": "Unknown",
    },
    date_columns=("Opened", "Updated"),
    metrics=(
        CountBy("by_priority", "Priority", "incident_count"),
        CountBy("by_category", "Category", "incident_count"),
        CountBy("by_state", "State", "incident_count"),
        CountByMonth("by_month", "Opened", "incident_count"),
        AverageHours(
            "avg_resolution_time", "Assignment_Group", "Opened", "Updated", "avg_resolution_hours"
        ),
    ),
)
