"""Parameters of the registered queries (run time, delta mark, job configs)."""

from __future__ import annotations

from ..config import JobConfig

# The driver data spans 2024-01-01 .. 2024-01-30; "now" is a parameter so
# rolling windows and audit columns are reproducible.
RUN_TIME = "2024-01-30T12:34:56Z"
RUN_MS = 1706618096000
RUN_TS_TEXT = "2024-01-30 12:34:56.000"
DELTA_MARK_MS = 1705708800000          # 2024-01-20T00:00:00Z
DELTA_OFFSET_MS = 10 * 60000


def cfg_assets() -> JobConfig:
    return JobConfig(config={"enableDataSetMapping": "yes"},
                     allow={"dataSetExternalId": ["*"], "rootAssetExternalId": ["R:0", "R:1", "R:2", "R:4"]},
                     deny={"rootAssetExternalId": ["R:1"]})


def cfg_events() -> JobConfig:
    return JobConfig(config={"enableContextualization": "yes", "enableDataSetMapping": "YES"},
                     allow={"dataSetExternalId": ["*"]})


def cfg_files() -> JobConfig:
    return JobConfig(config={"enableContextualization": "yes", "enableDataSetMapping": "yes",
                             "ignoreInvalidLabels": "yes"},
                     allow={"dataSetExternalId": []})


def cfg_raw(allow: list[str], deny: list[str]) -> JobConfig:
    return JobConfig(allow={"dbNames": allow}, deny={"dbNames": deny})


def cfg_relationships() -> JobConfig:
    return JobConfig(config={"enableDataSetMapping": "yes"},
                     allow={"dataSetExternalId": ["ds:AFRICA", "ds:AMERICA", "ds:EUROPE"]})


def cfg_sequences() -> JobConfig:
    return JobConfig(config={"sequenceHeaders": "yes", "sequenceRows": "yes", "enableContextualization": "yes",
                             "enableDataSetMapping": "yes"},
                     allow={"dataSetExternalId": ["*"], "sequenceExternalId": ["*"]},
                     deny={"sequenceExternalId": ["seq:1", "seq:2", "seq:3", "seq:100"]})


def cfg_ts() -> JobConfig:
    return JobConfig(config={"tsHeaders": "yes", "tsPoints": "yes", "tsPointsWindowDays": "2",
                             "enableContextualization": "yes", "enableDataSetMapping": "yes"},
                     allow={"dataSetExternalId": ["*"], "tsExternalId": ["ts:1", "ts:3"],
                            "tsExternalIdRegEx": ["ts:2.*", "ts:1[0-9]"]},
                     deny={"tsExternalId": ["ts:25"], "tsExternalIdRegEx": ["ts:.*7"]})

# longest silence that q_hour_filled fills
FILL_GAP_MS = 24 * 3600000

# allow and deny lists beyond what becomes literals
LONG_ALLOW = [f"ev:{k}" for k in range(0, 6000, 2)]
LONG_DENY = [f"ev:{k}" for k in range(0, 20000, 10)]

# the series whose points q_text_export writes
EXPORT_SERIES = "ts:1"
