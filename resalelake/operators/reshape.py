"""Attribute rows to columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAMESPACE = "product_metafield_namespace"
KEY = "product_metafield_key"
VALUE = "product_metafield_value"
UPDATED = "product_metafield_update_at"


def pivot_attributes(
    attributes: DataFrame, wanted: Mapping[str, tuple[str, str]], by: str = "product_id", newest: bool = True
) -> DataFrame:
    """One row per product, one column per wanted (namespace, key).

    ``newest`` takes the value of the latest version of the attribute (null if that version is null);
    otherwise the greatest value over all versions. Either way it is one aggregation and one shuffle;
    the filter lets the scan skip attributes nobody asked for.
    """
    namespaces = sorted({ns for ns, _ in wanted.values()})
    keys = sorted({k for _, k in wanted.values()})
    rows = attributes.where(F.col(NAMESPACE).isin(namespaces) & F.col(KEY).isin(keys) & F.col(by).isNotNull())
    carried = F.struct(UPDATED, "date", VALUE) if newest else F.struct(VALUE)
    aggs = []
    for name, (ns, key) in wanted.items():
        hit = (F.col(NAMESPACE) == ns) & (F.col(KEY) == key)
        if newest:
            aggs.append(F.max(F.when(hit, carried))[VALUE].alias(name))
        else:
            aggs.append(F.max(F.when(hit, F.col(VALUE))).alias(name))
    return rows.groupBy(by).agg(*aggs)
