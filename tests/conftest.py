import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetstar import schemas as S  # noqa: E402
from fleetstar.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 8, app_name="fleetstar-tests",
                      extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="fleetstar-test-")


def _ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M")


# Micro-fixture of FIXTURES.md section 2: 4 stores/devices, 12 readings.
STORES = [
    (1, "S1", "Alpha", "Paris", None, "France", "EMEA", "Flagship", dt.date(2020, 1, 1), True),
    (2, "S2", "Beta", "Tokyo", None, "Japan", "APAC", "Flagship", dt.date(2020, 1, 1), True),
    (3, "S3", "Alpha", "Sao Paulo", None, "Brazil", "LATAM", "Flagship", dt.date(2020, 1, 1), True),
    (4, "S4", "Gamma", "Base One", None, "Nowhere", "POLAR", "Flagship", dt.date(2020, 1, 1), True),
]
DEVICES = [
    (1, "D1", 1, "v1", "FW-A", dt.date(2024, 6, 1), dt.date(2027, 6, 1), True, False),
    (2, "D2", 2, "v1", "FW-A", dt.date(2024, 6, 1), dt.date(2027, 6, 1), True, True),
    (3, "D3", 3, "v2", "FW-B", dt.date(2024, 6, 1), dt.date(2027, 6, 1), True, False),
    (4, "D4", 4, "v2", "FW-B", dt.date(2024, 6, 1), dt.date(2027, 6, 1), True, False),
]
READINGS = [  # key, device, alert, ts, temp, spike, secs, watts, quality
    (1, 1, None, "2025-01-10 08:00", "200.00", False, 300, "1500.00", "CLEAN"),
    (2, 1, None, "2025-01-10 09:00", "221.00", False, 320, "1510.00", "CLEAN"),
    (3, 1, 2, "2025-01-12 10:00", "230.01", True, 340, "1520.00", "CLEAN"),
    (4, 1, None, "2025-02-01 08:00", "230.00", False, 360, "1530.00", "CLEAN"),
    (5, 2, 1, "2025-01-10 08:00", None, True, 380, "1540.00", "MISSING"),
    (6, 2, 1, "2025-01-11 08:00", "245.01", True, 400, "1550.00", "CLEAN"),
    (7, 2, 2, "2025-01-11 09:00", "245.00", True, 420, "1560.00", "CLEAN"),
    (8, 2, None, "2025-03-05 08:00", "180.00", False, 440, "1570.00", "NOISY"),
    (9, 3, None, "2025-01-10 08:00", "210.00", False, 460, "1580.00", "CLEAN"),
    (10, 3, None, "2025-02-10 08:00", "212.00", False, 480, "1590.00", "CLEAN"),
    (11, 4, 1, "2025-03-01 08:00", "250.00", True, 500, "1600.00", "CLEAN"),
    (12, 4, None, "2025-03-01 09:00", "150.00", False, 1800, "1875.00", "SPIKE"),
]


def fact_rows(readings=READINGS):
    out = []
    for key, dev, alert, ts, temp, spike, secs, watts, q in readings:
        t = _ts(ts)
        out.append((key, int(t.strftime("%Y%m%d")), dev, dev, alert, t, t,
                    Decimal(temp) if temp is not None else None, Decimal("230.00"), Decimal("0.00"),
                    spike, secs, Decimal(watts), 3, True, q, False))
    return out


@pytest.fixture(scope="session")
def micro(spark):
    from fleetstar.sources.profiles import Star, alert_dim

    fact = spark.createDataFrame(fact_rows(), schema=S.FACT)
    store = spark.createDataFrame(STORES, schema=S.STORE)
    device = spark.createDataFrame(DEVICES, schema=S.DEVICE)
    return Star(fact=fact, store=store, device=device, alert=alert_dim(spark))


@pytest.fixture(scope="session")
def micro_routing(spark):
    rows = [("EMEA", "Ann Example", "ann@example.com", "@ann"),
            ("APAC", "Bo Example", "bo@example.com", "@bo"),
            ("LATAM", "Cy Example", "cy@example.com", "@cy"),
            ("North America", "Di Example", "di@example.com", "@di")]
    default = {"manager_name": "Ops Desk", "manager_email": "ops@example.com", "manager_handle": "@ops"}
    return spark.createDataFrame(rows, schema=S.ROUTING), default
