from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillsight.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g", app="tests")
    yield session
    session.stop()


def rows(df, *columns):
    """Sorted tuples of a frame."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


STORES = "Store,Type,Size\n1,A,151315\n2,B,37392\n"
DEPARTMENTS = """Store,Dept,Date,Weekly_Sales,IsHoliday
1,1,2010-02-05,24924.50,FALSE
1,1,2010-02-12,46039.49,TRUE
1,2,2010-02-05,50605.27,FALSE
1,2,2010-02-12,44682.74,TRUE
2,1,2010-02-05,-12.50,FALSE
2,1,2010-02-12,NA,TRUE
2,2,2010-03-05,99.99,FALSE
"""
FACTS = """Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,CPI,Unemployment,IsHoliday
1,2010-02-05,42.31,2.572,NA,NA,NA,NA,NA,211.0963582,8.106,FALSE
1,2010-02-12,38.51,2.548,10.10,NA,NA,NA,5.00,211.2421698,8.106,TRUE
2,2010-02-05,40.19,2.572,NA,NA,NA,NA,NA,210.7526053,8.324,FALSE
2,2010-02-12,38.49,2.548,NA,NULL,null,NA,NA,210.8979935,8.324,TRUE
"""


@pytest.fixture
def delivery(tmp_path):
    """A folder of delivered files."""
    folder = tmp_path / "delivery"
    folder.mkdir()
    (folder / "stores.csv").write_text(STORES)
    (folder / "department.csv").write_text(DEPARTMENTS)
    (folder / "fact.csv").write_text(FACTS)
    return folder
