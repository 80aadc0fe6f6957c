"""The registered queries of the operators on the smallest tables, next to their SQL where they have one."""

from __future__ import annotations

import pandas as pd
import pytest

from check import canonical, tables
from meterline.llm.oracle import ORACLE_SQL
from meterline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLE = {"op2_extract_article": "pages", "op3_warc_bundles": "pages", "op12_ranked_search": "benchmark"}
SEVERAL = ("op1_pack_sequences", "op6_sample_pieces", "op12_ranked_search")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, SF).toPandas()
    if name in ORACLE_SQL:
        theirs = tables(SF).execute(ORACLE_SQL[name]).df()
        # Columns of nulls only come in different types.
        ours, theirs = (canonical(frame).convert_dtypes() for frame in (found, theirs))
        pd.testing.assert_frame_equal(ours, theirs, check_exact=True)
    rows = spark.read.parquet(f"{SF}/{TABLE.get(name, 'documents')}.parquet").count()
    assert len(found) >= rows if name in SEVERAL else len(found) == rows
