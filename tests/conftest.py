import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from footfall.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        8,
        {
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def skewed(spark, tmp_path_factory):
    """The small tables with one user, session and part holding a third of all rows."""
    root = tmp_path_factory.mktemp("skewed")
    changes = {
        "events": """SELECT event_id,
            CASE WHEN event_id % 3 = 0 THEN TIMESTAMP_NTZ'2024-01-15 09:00:00'
              + make_dt_interval(0, 0, 0, event_id div 30) ELSE ts END AS ts,
            CASE WHEN event_id % 3 = 0 THEN 7L ELSE user_id END AS user_id, event_type, value, props FROM t""",
        "lineitem": "SELECT * EXCEPT (l_partkey), IF(l_orderkey % 3 = 0, 5L, l_partkey) AS l_partkey FROM t",
        "orders": """SELECT * EXCEPT (o_orderdate), IF(o_orderkey % 3 = 0, TIMESTAMP_NTZ'1997-03-03 00:00:00',
            o_orderdate) AS o_orderdate FROM t""",
    }
    for name in os.listdir(SMALL):
        table = name.removesuffix(".parquet")
        spark.read.parquet(f"{SMALL}/{name}").createOrReplaceTempView("t")
        sql = changes.get(table, "SELECT * FROM t")
        spark.sql(sql).write.parquet(f"{root}/{name}")
    return str(root)
