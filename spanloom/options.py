"""Job options and their checks."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import urlparse

# The four codec names and the schema name.
CODECS = ("SNAPPY", "GZIP", "ZSTD", "UNCOMPRESSED")
SCHEMA_NAME = "main"


# The names options have in a settings file, and the units of a duration in seconds.
SETTINGS = {
    "output_path": "output_path",
    "data_path": "data_path",
    "batch_size": "batch_size",
    "batch_timeout": "batch_timeout_seconds",
    "compression": "compression",
    "enable_bloom_filters": "enable_bloom_filters",
    "logs_table_name": "logs_table",
    "traces_table_name": "traces_table",
}
UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0}


def seconds(duration: str | int | float) -> float:
    """A duration like 10s, 1m30s or 250ms; a bare number is seconds."""
    if isinstance(duration, (int, float)):
        return float(duration)
    parts = re.findall(r"([0-9.]+)(ms|s|m|h)", duration)
    if not parts or "".join(n + u for n, u in parts) != duration:
        raise OptionsError(f"not a duration: {duration}")
    return sum(float(n) * UNITS[u] for n, u in parts)


class OptionsError(ValueError):
    """All problems found, one per line."""


@dataclass(frozen=True)
class LakeOptions:
    output_path: str
    data_path: str = ""
    batch_size: int = 10_000
    batch_timeout_seconds: float = 10.0
    compression: str = "SNAPPY"
    enable_bloom_filters: bool = True
    logs_table: str = "otel_logs"
    traces_table: str = "otel_traces"

    @classmethod
    def from_settings(cls, settings: Mapping) -> "LakeOptions":
        """From a parsed settings file. Sections may be nested; settings of other parts of a pipeline are left alone."""
        found: dict = {"output_path": ""}

        def collect(section: Mapping) -> None:
            for key, value in section.items():
                if isinstance(value, Mapping):
                    collect(value)
                elif key in SETTINGS:
                    found[SETTINGS[key]] = seconds(value) if key == "batch_timeout" else value

        collect(settings)
        return cls(**found)

    def __post_init__(self):
        # Object stores are addressed the same way by writer and reader, so the two paths cannot differ there.
        if self._scheme() not in ("", "file") or not self.data_path:
            object.__setattr__(self, "data_path", self.output_path)

    def _scheme(self) -> str:
        return urlparse(self.output_path).scheme

    def problems(self) -> list[str]:
        found = []
        url = urlparse(self.output_path)
        if not self.output_path:
            found.append("no output_path given")
        elif url.scheme in ("", "file"):
            if os.path.exists(url.path) and not os.path.isdir(url.path):
                found.append(f"output_path names a file, not a folder: {self.output_path}")
        elif not url.netloc:
            found.append(f"output_path has no bucket or host: {self.output_path}")
        if self.batch_size <= 0:
            found.append(f"batch_size is {self.batch_size}; a file needs at least one row")
        if self.batch_timeout_seconds <= 0:
            found.append(f"batch_timeout_seconds is {self.batch_timeout_seconds}; it has to be positive")
        if self.compression not in CODECS:
            found.append(f"unknown compression {self.compression!r}, known are {', '.join(CODECS)}")
        if not self.logs_table or not self.traces_table or self.logs_table == self.traces_table:
            found.append("logs_table and traces_table must be two different names")
        return found

    def validate(self) -> "LakeOptions":
        found = self.problems()
        if found:
            raise OptionsError("\n".join(found))
        return self

    def table(self, signal: str) -> str:
        return {"logs": self.logs_table, "traces": self.traces_table}[signal]

    def table_dir(self, signal: str) -> str:
        return f"{self.output_path.rstrip('/')}/{SCHEMA_NAME}/{self.table(signal)}"

    def data_dir(self, signal: str) -> str:
        """The table's folder as readers find it."""
        return f"{self.data_path.rstrip('/')}/{SCHEMA_NAME}/{self.table(signal)}"

    @property
    def catalog_dir(self) -> str:
        return f"{self.output_path.rstrip('/')}/_catalog"

    @property
    def commits_dir(self) -> str:
        return f"{self.catalog_dir}/commits"

    @property
    def folds_dir(self) -> str:
        return f"{self.catalog_dir}/folds"
