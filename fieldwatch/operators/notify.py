"""Notifications: recipients per farm (A7), alert x recipient fan-out (J5) with
the message body (P25), and alerts nobody receives (J6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.config import NOTIFICATION_TEMPLATE


def routes_by_farm(routes: DataFrame) -> DataFrame:
    """Recipient list per farm, duplicates kept, sorted. The routes table
    is configuration (one to a few addresses per farm), so the list is small."""
    return routes.groupBy("farm_id").agg(F.array_sort(F.collect_list("email")).alias("emails"),
                                         F.count(F.lit(1)).alias("n_recipients"))


def _py_text(c):
    """Text of a value as Python's print would show it: None for NULL."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def _py_list(c):
    """Python's str() of a list of strings: ['a', 'b']."""
    inner = F.array_join(F.transform(c, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")
    return F.when(c.isNull(), F.lit("None")).otherwise(F.concat(F.lit("["), inner, F.lit("]")))


def render(template: str, *values):
    """Fill the ``%s`` slots of a template with columns using ``concat``
    (code-generated, unlike ``format_string``'s java Formatter)."""
    parts = template.split("%s")
    if len(parts) != len(values) + 1:
        raise ValueError("template slots and values differ")
    cols = [F.lit(parts[0])]
    for v, lit in zip(values, parts[1:]):
        cols += [v, F.lit(lit)]
    return F.concat(*cols)


def notifications(alerts: DataFrame, routes: DataFrame) -> DataFrame:
    """J5 + P25: one row per alert and recipient of its farm (a duplicated
    route sends twice), with the rendered message."""
    j = alerts.join(routes.select("farm_id", "email"), "farm_id", "inner")
    lat = F.col("device_location.lat")
    lon = F.col("device_location.lon")
    body = render(NOTIFICATION_TEMPLATE, F.col("email"), _py_text(F.col("device_id")), _py_text(F.col("state")),
                  _py_text(lat), _py_text(lon), _py_text(F.col("gateway_ts_iso")), _py_list(F.col("details")))
    return j.select("email", "farm_id", "device_id", "state", lat.alias("lat"), lon.alias("lon"), "gateway_ts_iso",
                    "details", *[c for c in alerts.columns if c == "seq"], body.alias("message"))


def unrouted_alerts(alerts: DataFrame, routes: DataFrame) -> DataFrame:
    """Alerts whose farm has no recipient, NULL farm included."""
    return alerts.join(routes.select("farm_id").distinct(), "farm_id", "left_anti")
