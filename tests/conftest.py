import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import checkpoint_dir, get_session
    s = get_session("local[4]", 4, app_name="tidewatch-tests")
    checkpoint_dir(s)
    yield s


TX = ("TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, card1 string, card2 string, "
      "card3 string, card5 string, addr1 string, DeviceInfo string, P_emaildomain string, ProductCD string")


@pytest.fixture
def simple_tx(spark):
    rows = [(1, 0, 100.0, 0), (2, 3600, 200.0, 0), (3, 7200, 150.0, 1)]
    return spark.createDataFrame([(i, t, a, f, "A", "B", "C", "D", "1", "iOS", "gmail.com", "W") for i, t, a, f in rows], TX)


@pytest.fixture
def multi_tx(spark):
    rows = [(1, 0, 100.0, 0, "A", "1", "iOS", "g.com", "W"), (2, 3600, 200.0, 1, "A", "1", "iOS", "g.com", "W"),
            (3, 0, 50.0, 0, "B", "2", "Android", "y.com", "H"), (4, 3600, 75.0, 0, "B", "2", "Android", "y.com", "H")]
    return spark.createDataFrame([(i, t, a, f, c, "", "", "", ad, d, e, p) for i, t, a, f, c, ad, d, e, p in rows], TX)
