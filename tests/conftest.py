from __future__ import annotations

import json

import pytest
from pyspark.sql import SparkSession

from pageloom.runtime import RESPONSES_SCHEMA


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture
def land(spark):
    """Landed responses from dicts; a body that is not text is written as JSON."""

    def make(*pages, pull="p"):
        rows = []
        for i, page in enumerate(pages):
            page = page if isinstance(page, dict) and "body" in page else {"body": page}
            body = page["body"]
            row = dict.fromkeys(RESPONSES_SCHEMA.names)
            row |= {"pull": pull, "window_seq": 0, "page_seq": i, "url": "https://h/a"}
            row |= {"params": {}, "headers": {}, "status": 200} | page
            row["body"] = body if isinstance(body, str) else json.dumps(body)
            rows.append(tuple(row[n] for n in RESPONSES_SCHEMA.names))
        return spark.createDataFrame(rows, RESPONSES_SCHEMA)

    return make


@pytest.fixture
def values():
    """Sorted list of the rows of some columns (one column: bare values)."""

    def get(df, *cols):
        found = [tuple(r[c] for c in cols) for r in df.collect()]
        found.sort(key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])
        return [r[0] for r in found] if len(cols) == 1 else found

    return get
