"""Study settings, held on the driver as plain frozen dataclasses."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

_TRUE_WORDS = {"yes", "true", "on", "1"}
_FALSE_WORDS = {"no", "false", "off", "0", ""}


def as_bool(value, default: bool = False) -> bool:
    """Read a YAML-style switch; anything but a clear yes or no is an error."""
    if value is None:
        return default
    word = str(value).strip().lower()
    if word in _TRUE_WORDS:
        return True
    if word in _FALSE_WORDS:
        return False
    raise ValueError(f"not a yes/no value: {value!r}")


@dataclass(frozen=True)
class DataFilters:
    remove_duplicates: bool = True
    remove_noid: bool = False
    remove_zero_pulse: bool = False


@dataclass(frozen=True)
class Schedule:
    """One nightly window for all detectors, or a window per detector."""

    start: str = "18:00:00"
    end: str = "07:00:00"
    per_detector: Mapping[str, tuple[str, str]] | None = None

    @property
    def cutoff_hour(self) -> int:
        return int(self.start[:2])


@dataclass(frozen=True)
class StudyConfig:
    start_date: str
    end_date: str
    timezone: str = "America/Chicago"
    study_name: str = "study"
    detector_names: Mapping[str, str] = field(default_factory=dict)
    external_sources: tuple[str, ...] = ()
    filters: DataFilters = DataFilters()
    schedule: Schedule = Schedule()
    intended_hours: float | None = 13.0
    detector_specific_schedules: bool = False
    noid_handling: str = "keep"
    nights_threshold: int | None = 20
    outlier_percentile: float = 95.0

    @classmethod
    def from_dict(cls, raw: Mapping) -> "StudyConfig":
        """Build from the nested settings document of a study."""
        study = raw.get("study_parameters", {})
        processing = raw.get("processing_options", {})
        plots = raw.get("plot_configuration", {})
        switches = study.get("data_filters") or {}
        sources = study.get("external_data_sources") or ()
        if isinstance(sources, str):
            sources = (sources,)
        own_schedules = processing.get(
            "detector_specific_schedules", processing.get("advanced_scheduling")
        )
        return cls(
            start_date=str(study["start_date"]),
            end_date=str(study["end_date"]),
            timezone=study.get("timezone") or "America/Chicago",
            study_name=study.get("study_name") or "study",
            detector_names=dict(study.get("detector_mapping") or {}),
            external_sources=tuple(sources),
            filters=DataFilters(
                remove_duplicates=as_bool(switches.get("remove_duplicates"), True),
                remove_noid=as_bool(switches.get("remove_noid")),
                remove_zero_pulse=as_bool(switches.get("remove_zero_pulse_calls")),
            ),
            schedule=Schedule(
                start=processing.get("recording_start") or "18:00:00",
                end=processing.get("recording_end") or "07:00:00",
            ),
            intended_hours=processing.get("intended_hours"),
            detector_specific_schedules=as_bool(own_schedules),
            noid_handling=plots.get("noid_handling") or "keep",
            nights_threshold=plots.get("detector_nights_threshold"),
            outlier_percentile=float(plots.get("outlier_percentile") or 95),
        )
