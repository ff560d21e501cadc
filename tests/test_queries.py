"""Registered queries against their SQL on the smallest tables.

All of them run with ``HUSTINGS_ALL_QUERIES=1``; otherwise one or two of each module.
"""

import os
from pathlib import Path

import pytest

from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SHORT = ["elect_topn", "race_share", "line_standing", "standardize_names", "split_office", "canonical_places", "staged_linkage",
         "crosswalk", "kin_rates", "prefix_links", "encode_columns", "null_profile", "locality_gaps", "pooled_feed",
         "carry_forward", "ring_areas", "vote_counts", "assembled_polygons", "containing_rings", "chained_rings", "canvass_units",
         "crosswalk_near", "landed_stream", "audit_log", "written_localities", "torn_lines", "backfilled_winners", "clan_detail", "agreement"]
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def names():
    from __spark_entry__ import queries
    return list(queries()) if os.environ.get("HUSTINGS_ALL_QUERIES") else SHORT


@pytest.mark.parametrize("name", names())
def test_query(spark, name):
    from __spark_entry__ import oracle_sql, queries
    _, problem = compare(spark, FOLDER, queries()[name], oracle_sql().get(name), connect(FOLDER))
    assert problem is None, problem


def test_entry_has_rows(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["race", "candidate", "party", "votes", "seats", "place", "tie_at_cutoff"] and df.count() > 0


def test_every_sql_has_a_query():
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())
