from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from benelake.schemas import CONDITION_FLAGS, ID_COLUMN, MONTH_COLUMNS, RAW_COLUMNS, RAW_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

# A plain valid row: every flag absent, every amount zero, a full year covered.
DEFAULT_ROW = dict.fromkeys(RAW_COLUMNS, "0.00") | dict.fromkeys(CONDITION_FLAGS, "2") | dict.fromkeys(MONTH_COLUMNS, "12")
DEFAULT_ROW |= {ID_COLUMN: "T-77", "BENE_BIRTH_DT": "19310709", "BENE_DEATH_DT": None, "SP_STATE_CODE": "05", "BENE_COUNTY_CD": "250"}
DEFAULT_ROW |= {"BENE_SEX_IDENT_CD": "2", "BENE_RACE_CD": "3", "BENE_ESRD_IND": "0"}


@pytest.fixture(scope="session")
def spark():
    from benelake.session import build_session

    scratch = tempfile.mkdtemp(prefix="benelake-test-")
    s = build_session(
        "local[*]",
        app_name="benelake-tests",
        shuffle_partitions=8,
        extra_conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
        },
    )
    yield s
    s.stop()


@pytest.fixture
def raw_rows(spark):
    """Build a raw 32-column frame from override dicts on the default row."""

    def make(*overrides: dict):
        rows = [{**DEFAULT_ROW, **o} for o in (overrides or ({},))]
        return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)

    return make


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="benelake-run-")
