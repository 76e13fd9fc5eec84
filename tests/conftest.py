from __future__ import annotations

from datetime import datetime

import pytest

from gridloom.session import get_session
from gridloom.sources.warehouse import Warehouse

RUN = datetime(2024, 1, 20)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


@pytest.fixture
def landing(tmp_path):
    """Writes a landed file and returns its folder."""
    root = tmp_path / "landing"
    (root / "meter_readings").mkdir(parents=True)

    def write(name: str, text: str) -> str:
        (root / name).write_text(text, encoding="utf-8")
        return str(root)

    write.root = str(root)
    write.readings = str(root / "meter_readings")
    return write


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
