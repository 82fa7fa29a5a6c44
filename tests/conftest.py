import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def expit(x):
    return 1 / (1 + np.exp(-x))


def cohort(n=2000, seed=11):
    """Patients with a drug and a diet, given by age and mass; three outcomes.

    On the blood pressure the drug adds 1.2, the diet takes 0.8, both together add 0.6 more.
    Three patients have an unknown recovery.
    """
    r = np.random.default_rng(seed)
    age, mass, income = r.normal(size=n), r.uniform(-1, 1, n), r.exponential(1.0, n)
    drug = r.uniform(size=n) < expit(0.4 - 0.8 * age)
    diet = r.uniform(size=n) < expit(mass - 0.5)
    level = 10 - 3 * age + 2 * mass + 0.5 * income + 1.2 * drug - 0.8 * diet + 0.6 * drug * diet
    recovered = pd.Series(r.uniform(size=n) < expit(0.3 * (level - 10) + 0.5)).astype(object)
    recovered[[4, 9, 14]] = None
    return pd.DataFrame(
        {
            "SAMPLE_ID": np.arange(1, n + 1),
            "drug": drug,
            "diet": diet,
            "age": age,
            "mass": mass,
            "income": income,
            "pressure (mm/Hg), mean": level + r.normal(0, 0.3, n),
            "recovered?": recovered,
            "visits": r.poisson(2 + drug, n),
        }
    )


SCHEMA = (
    "SAMPLE_ID bigint, drug boolean, diet boolean, age double, mass double, income double, "
    "`pressure (mm/Hg), mean` double, `recovered?` boolean, visits bigint"
)


@pytest.fixture(scope="session")
def people(spark):
    return spark.createDataFrame(cohort(), SCHEMA).persist()
