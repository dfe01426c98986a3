"""Every cleaned table from a landing log with several versions, deletes and null keys.

The logs are derived from the order lines: the part is the key, so that a key has many records. Each column that a
table names itself, keeps, or casts gets its own value; the others follow the naming rule, tested in tests/.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktally.sources import silver
from workload.registry import add

# Columns of every log, by their naming: an id, a plain word, a date and a flag of the ERP; the shop's counterparts.
_ERP_MORE = {"locationgroupid": "location_group_id", "datescheduled": "scheduled_at"}
_SHOP_MORE = {"qty_ordered": "quantity_ordered", "base_row_total": "base_row_total"}


def _columns(model: str) -> dict[str, str]:
    """Landing column -> output column of a model's log."""
    spec = silver.ERP.get(model) or silver.SHOP[model]
    more = _ERP_MORE if model in silver.ERP else _SHOP_MORE
    key = spec.key or next(iter(spec.names or spec.keep or ("id",)))
    found = dict.fromkeys([key, *spec.keep, *spec.names, *spec.flags, *(() if spec.keep else more)])
    names, _ = silver.output_names(model, list(found))
    for source, out in {**{c: c for c in spec.keep}, **spec.names}.items():
        if names.get(source) != out and not (spec.keep and source not in spec.keep):
            raise ValueError(f"{model}: {source} becomes {names.get(source)}, not {out}")
    return names


def _value(column: str, flag: bool, key: bool) -> str:
    if key:
        return "nullif(l_partkey % 500, 0)"
    return "l_linenumber % 2" if flag else f"concat(l_orderkey, ':{column}:', l_linenumber)"


def _log(model: str) -> str:
    spec = silver.ERP.get(model) or silver.SHOP[model]
    names = _columns(model)
    key = spec.key or next(iter(names))
    _, flags = silver.output_names(model, list(names))
    columns = [f"{_value(c, c in flags, c == key)} as {c}" for c in dict.fromkeys([key, *names])]
    return f"""select {', '.join(columns)}, case when l_returnflag = 'R' then 'gone' end as _ab_cdc_deleted_at,
 l_shipdate as _airbyte_extracted_at, l_orderkey * 10 + l_linenumber as _ab_cdc_cursor, l_suppkey as _airbyte_raw_id from lineitem"""


def _cleaned(model: str, mode: str):
    def frame(t):
        spark = t["lineitem"].sparkSession
        landing = spark.sql(_log(model).replace("from lineitem", "from {lineitem}"), lineitem=t["lineitem"])
        result = silver.clean(model, landing, mode)
        return result.select([F.col(c).cast("string") for c in result.columns])

    return frame


def _statement(model: str, mode: str) -> str:
    spec = silver.ERP.get(model) or silver.SHOP[model]
    names, flags = silver.output_names(model, list(_columns(model)))
    if model in silver.KEEPS_LOG:
        names["_ab_cdc_cursor"] = "_ab_cdc_cursor"
    picked = ", ".join(f"cast({f'cast({c} as boolean)' if c in flags else c} as varchar) as {o}" for c, o in names.items())
    rows = f"({_log(model)})"
    if spec.key is None:
        return f"select {picked} from {rows}"
    rank = f"row_number() over (partition by {spec.key} order by _airbyte_extracted_at desc nulls last, _ab_cdc_cursor desc nulls last, _airbyte_raw_id desc nulls last) = 1"
    live = "_ab_cdc_deleted_at is null"
    some = f"{spec.key} is not null" if spec.drop_null_keys else "true"
    if mode == "latest_wins":
        return f"select {picked} from (select * from {rows} where {some} qualify {rank}) where {live}"
    return f"select {picked} from {rows} where {some} and {live} qualify {rank}"


for _model in silver.LANDING:
    add(f"clean_{_model}", _cleaned(_model, "filter_first"), _statement(_model, "filter_first"))
for _model in ("fishbowl_so", "magento_sales_order"):
    add(f"clean_{_model}_latest_wins", _cleaned(_model, "latest_wins"), _statement(_model, "latest_wins"))
