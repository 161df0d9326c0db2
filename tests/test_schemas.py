"""Every published table has exactly the declared schema (FIXTURES §3)."""

import pytest

from assetlake.plans import publish as P
from assetlake.plans.params import RUN_TIME
from assetlake.schemas import PUBLISHED
from assetlake.sinks.writers import assert_schema

JOBS = {
    "assets": P.publish_assets, "data_sets": P.publish_data_sets, "events": P.publish_events,
    "files": P.publish_files, "labels": P.publish_labels, "raw": P.publish_raw,
    "relationships": P.publish_relationships, "sequence_columns": P.publish_sequence_columns,
    "sequence_headers": P.publish_sequence_headers, "sequence_rows": P.publish_sequence_rows,
    "ts_headers": P.publish_ts_headers, "ts_points": P.publish_ts_points,
    "ts_points_hour": P.publish_ts_points_hour,
}


@pytest.mark.parametrize("table", sorted(JOBS))
def test_published_schema(tenants, table):
    src, _ = tenants
    df = JOBS[table](src, RUN_TIME)
    assert_schema(df, PUBLISHED[table])
