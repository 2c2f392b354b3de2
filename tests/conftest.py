import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# A hand-made census extract: blanks, a missing marker, a dotted label, copies, zeros.
CENSUS_LINES = [
    "39, State-gov, 77516, Bachelors, 13, Never-married, Adm-clerical, Not-in-family, White, Male, 2174, 0, 40, United-States, <=50K",
    "50, Self-emp-not-inc, 83311, Bachelors, 13, Married, Exec-managerial, Husband, White, Male, 0, 0, 13, United-States, <=50K",
    "38, Private, 215646, HS-grad, 9, Divorced, Handlers-cleaners, Not-in-family, White, Male, 0, 0, 40, United-States, <=50K.",
    "53, Private, 234721, 11th, 7, Married, Handlers-cleaners, Husband, Black, Male, 0, 0, 40, United-States, >50K.",
    "28, Private, 338409, Bachelors, 13, Married, Prof-specialty, Wife, Black, Female, 0, 0, 40, Cuba, <=50K",
    "37, ?, 284582, Masters, 14, Married, Exec-managerial, Wife, White, Female, 0, 0, 40, United-States, >50K",
    "49,  Private , 160187, 9th, 5, Absent, Other-service, Not-in-family, Black, Female, 0, 0, 16, Jamaica, <=50K",
    "52, Private, 209642, HS-grad, 9, Married, Exec-managerial, Husband, White, Male, 0, 0, 45, United-States, >50K",
    "31, Private, 45781, Masters, 14, Never-married, Prof-specialty, Not-in-family, White, Female, 14084, 0, 50, ?, >50K",
    "42, Private, 159449, Bachelors, 13, Married, Exec-managerial, Husband, White, Male, 5178, 0, 40, United-States, >50K",
    "42, Private, 159449, Bachelors, 13, Married, Exec-managerial, Husband, White, Male, 5178, 0, 40, United-States, >50K",
    "37, Private, 280464, Some-college, 10, Married, Exec-managerial, Husband, Black, Male, 0, 0, 80, United-States, >50K",
]


@pytest.fixture(scope="session")
def census_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("census") / "census.csv"
    path.write_text("\n".join(CENSUS_LINES) + "\n")
    return str(path)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
