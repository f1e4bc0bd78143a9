"""Proof that the layers hold the same events: order-free digests by day.

Row counts cannot tell a run that rebuilt some days from one that rebuilt all. Here each
table gives, by day, its number of rows and the sum of the 64-bit hashes of its rows. The
sum does not depend on order, files or tasks, and one changed row changes it, so that
tables written in different ways can be compared without bringing their rows together:
what is shuffled is one row per day, layer and task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantlens.plans.build import EVENT_DATE, dated_activity
from tenantlens.schemas import TYPED_COLUMNS
from tenantlens.sources.landing import usable_records
from tenantlens.sources.tables import TableStore


def digests(rows: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """by, rows, digest: of the columns named, whatever others there are. A missing value
    is told from its neighbour's by the mask of missing ones, since hashing skips it."""
    values = [F.col(f"`{c}`") for c in columns]
    missing = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    mark = F.xxhash64(*values, missing)
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(mark.cast("decimal(38,0)")).alias("digest")
    )


def compared(layers: Mapping[str, DataFrame], columns: Sequence[str], by: str) -> DataFrame:
    """by, ``<layer>_rows`` of each layer, agrees: whether a day is the same in all layers."""
    told = [
        digests(rows, columns, by).select(F.lit(name).alias("layer"), by, "rows", "digest")
        for name, rows in layers.items()
    ]
    counts = [
        F.coalesce(F.max(F.when(F.col("layer") == name, F.col("rows"))), F.lit(0)).alias(f"{name}_rows") for name in layers
    ]
    same = (F.count(F.lit(1)) == len(layers)) & (F.min("rows") == F.max("rows")) & (F.min("digest") == F.max("digest"))
    return reduce(DataFrame.unionByName, told).groupBy(by).agg(*counts, same.alias("agrees"))


def activity_by_day(store: TableStore) -> DataFrame:
    """event_date, bronze_rows, silver_rows, gold_rows, agrees: the events as landed, typed
    and in the star schema, compared on all typed columns."""
    columns = list(TYPED_COLUMNS["activity"])
    gold = store.read("gold.fact_activity").withColumnRenamed("user_id_raw", "user_id")
    layers = {
        "bronze": dated_activity(usable_records(store.read("bronze.activity"))),
        "silver": store.read("silver.activity"),
        "gold": gold,
    }
    return compared(layers, columns, EVENT_DATE)
