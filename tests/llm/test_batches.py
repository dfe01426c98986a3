"""Texts go to Python workers in batches of a bounded number of rows."""

from __future__ import annotations

import pyarrow as pa

from stocktally.session import tune


def test_a_python_worker_gets_at_most_two_thousand_rows_at_once(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        tune(spark)
        rows = spark.range(0, 9_000, 1, 1).mapInArrow(sizes, "n long").collect()
        assert sum(r.n for r in rows) == 9_000 and max(r.n for r in rows) <= 2_000
    finally:
        spark.conf.set(name, before)
