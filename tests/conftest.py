import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskweave.session import build_session  # noqa: E402
from riskweave.workload import all_queries  # noqa: E402,F401  (registers by-value pickling)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[8]", 4, "riskweave-tests")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def churn(spark):
    """2 000 customers with a known logistic signal (about 23 % ones)."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(11)
    n = 2000
    flyer = (rng.random(n) < 0.3).astype(int)
    income = rng.choice([0, 1, 2], n, p=[0.4, 0.43, 0.17])
    df = pd.DataFrame(
        {
            "id": np.arange(n),
            "Age": rng.integers(27, 39, n),
            "FrequentFlyer": flyer,
            "AnnualIncomeClass": income,
            "ServicesOpted": rng.integers(1, 7, n),
            "AccountSyncedToSocialMedia": rng.integers(0, 2, n),
            "BookedHotelOrNot": rng.integers(0, 2, n),
        }
    )
    z = -4.2 + 2.5 * flyer + 2.2 * flyer * income + 0.6 * income + 0.2 * df["BookedHotelOrNot"]
    df["Target"] = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    return spark.createDataFrame(df).repartition(4)
