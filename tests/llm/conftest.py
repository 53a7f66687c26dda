"""Fixtures of the edge rows."""

from __future__ import annotations

import pytest
from edge_rows import frame


@pytest.fixture
def edge(spark):
    return frame(spark)


@pytest.fixture
def nothing(spark):
    return frame(spark, [])


@pytest.fixture
def rows_of():
    return frame
