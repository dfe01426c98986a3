"""Lead times: values by hand, and wide rows that move once."""

from __future__ import annotations

import datetime
import re

from stocktally.plans import purchasing


def _exchanges(df) -> list[str]:
    """Columns that each exchange of the plan moves."""
    execution = df._jdf.queryExecution()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", execution.explainString(mode))


def _receipts(spark):
    day = datetime.datetime(2024, 1, 1)
    rows = [(i, v, p, "w" * i, day, None if i == 5 else day + datetime.timedelta(days=i)) for i, (v, p) in enumerate(
        [(1, "a"), (1, "b"), (2, "a"), (None, "a"), (1, None), (3, "c"), (1, "a"), (None, None)])]
    return spark.createDataFrame(rows, "id int, vendor int, part string, payload string, started timestamp, received timestamp")


def test_wide_receipts_move_once_for_their_lead_times(spark):
    out = purchasing.with_lead_times(_receipts(spark), "vendor", "part", "started", "received", 2, ["id"])
    assert sum("payload" in columns for columns in _exchanges(out)) == 1
    assert out.columns == ["part", "vendor", "id", "payload", "started", "received", "vendor_product_leadtime", "vendor_lead_time", "product_leadtime", "precise_leadtime"]
    got = {r.id: (r.vendor_product_leadtime, r.vendor_lead_time, r.product_leadtime, r.precise_leadtime) for r in out.collect()}
    assert got == {
        0: (3, 5, 5, 3), 6: (3, 5, 5, 3), 1: (1, 5, 1, 1), 2: (2, 2, 5, 2), 3: (None, None, 5, 5), 4: (None, 5, None, 5), 5: (None, None, None, None), 7: (None, None, None, None),
    }
