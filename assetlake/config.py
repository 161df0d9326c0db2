"""Job configuration: flags plus allow/deny lists (driver side, tiny).

The file format is TOML with three tables::

    [config]     enableDataSetMapping = "yes", tsPointsWindowDays = "2", ...
    [allowList]  dataSetExternalId = ["*"], tsExternalIdRegEx = ["ts:1.*"], ...
    [denyList]   tsExternalId = ["ts:5"], ...
"""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field


@dataclass
class JobConfig:
    config: dict[str, str] = field(default_factory=dict)
    allow: dict[str, list[str]] = field(default_factory=dict)
    deny: dict[str, list[str]] = field(default_factory=dict)

    @classmethod
    def from_toml(cls, text: str) -> "JobConfig":
        data = tomllib.loads(text)
        return cls(
            config={k: str(v) for k, v in data.get("config", {}).items()},
            allow={k: [str(x) for x in v] for k, v in data.get("allowList", {}).items()},
            deny={k: [str(x) for x in v] for k, v in data.get("denyList", {}).items()},
        )

    @classmethod
    def from_file(cls, path: str) -> "JobConfig":
        with open(path, encoding="utf-8") as fh:
            return cls.from_toml(fh.read())

    def flag(self, key: str, default: str = "no") -> bool:
        """yes/no flag, case-insensitive, default "no"."""
        return self.config.get(key, default).strip().lower() == "yes"

    def integer(self, key: str, default: int) -> int:
        return int(self.config.get(key, str(default)))

    def allow_list(self, key: str) -> list[str]:
        return list(self.allow.get(key, []))

    def deny_list(self, key: str) -> list[str]:
        return list(self.deny.get(key, []))


# Config keys (fixed values of the job-config format).
DATA_SET_MAPPING = "enableDataSetMapping"
CONTEXTUALIZATION = "enableContextualization"
IGNORE_INVALID_LABELS = "ignoreInvalidLabels"
TS_HEADERS = "tsHeaders"
TS_POINTS = "tsPoints"
TS_WINDOW_DAYS = "tsPointsWindowDays"
SEQUENCE_HEADERS = "sequenceHeaders"
SEQUENCE_ROWS = "sequenceRows"
DATA_SET_EXT_ID = "dataSetExternalId"
ROOT_ASSET_EXT_ID = "rootAssetExternalId"
DB_NAMES = "dbNames"
SEQUENCE_EXT_ID = "sequenceExternalId"
TS_EXT_ID = "tsExternalId"
TS_EXT_ID_REGEX = "tsExternalIdRegEx"
