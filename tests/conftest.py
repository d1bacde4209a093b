import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillcast.params import SOURCE_FILE, STORE_SALES_ROLES, JobParams, ModelParams  # noqa: E402
from tillcast.session import local_session, work_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4")
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def workspace(spark):
    from tillcast.plans.jobs import Workspace

    return Workspace(spark, work_path(spark, "test"))


@pytest.fixture
def store_params():
    return JobParams(
        roles=STORE_SALES_ROLES,
        model=ModelParams(
            training_mode="single",
            candidate_models=("ridge",),
            parameters={"ridge": {"alpha": 1.0}},
        ),
    )


@pytest.fixture
def store_sales(spark):
    """Twenty days of two stores, one row a day."""
    rows = []
    for i in range(20):
        odd = i % 2
        rows.append(
            (
                datetime(2024, 1, 1) + timedelta(days=i),
                str(1 + odd),
                100.0 + i,
                str(10 + i),
                float(i % 7 + 1),
                1.0,
                float(odd),
                0.0,
                "0",
                "b" if odd else "a",
                "c" if odd else "a",
                100.0 + i,
                1.0,
                2020.0,
                0.0,
                1.0,
                2020.0,
                "Jan,Apr,Jul,Oct",
                "train.csv",
            )
        )
    schema = (
        "Date timestamp_ntz, Store string, Sales double, Customers string, DayOfWeek double, "
        "Open double, Promo double, SchoolHoliday double, StateHoliday string, "
        "StoreType string, Assortment string, CompetitionDistance double, "
        "CompetitionOpenSinceMonth double, CompetitionOpenSinceYear double, Promo2 double, "
        f"Promo2SinceWeek double, Promo2SinceYear double, PromoInterval string, {SOURCE_FILE} string"
    )
    return spark.createDataFrame(rows, schema)
