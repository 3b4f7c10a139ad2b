"""One request sent to several peers: who stayed silent and why, merged lists, first success.

``replies``: (broadcast, peer, position, reply), the reply as JSON text or null if none came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _items(key: str) -> Column:
    return F.get_json_object("reply", f"$.result.{key}")


def named(key: str) -> Column:
    """Entries with a name, of a reply that holds a list."""
    parsed = F.from_json(_items(key), "array<struct<name:string>>")
    return F.filter(parsed, lambda x: x["name"].isNotNull())


def silent_peers(replies: DataFrame, key: str) -> DataFrame:
    """(broadcast, peer, position, why): no reply, error, malformed or empty; peers that named something are left out."""
    is_list = F.expr(f"json_array_length(get_json_object(reply, '$.result.{key}'))").isNotNull()
    why = (
        F.when(F.col("reply").isNull(), "no reply")
        .when(F.get_json_object("reply", "$.error").isNotNull(), "error")
        .when(~is_list, "malformed")
        .when(F.coalesce(F.size(named(key)), F.lit(0)) <= 0, "empty")
    )
    return replies.select("broadcast", "peer", "position", why.alias("why")).where("why is not null")


def merged_list(replies: DataFrame, key: str) -> DataFrame:
    """(broadcast, peer, position, place, name): the named entries of all peers, in the peers' order."""
    rows = replies.where(F.get_json_object("reply", "$.error").isNull()).select("broadcast", "peer", "position", F.posexplode(named(key)).alias("place", "item"))
    return rows.select("broadcast", "peer", "position", "place", F.col("item.name").alias("name"))


def first_success(replies: DataFrame) -> DataFrame:
    """(broadcast, peer, ok): the first peer that answered without an error, else the first error."""
    ok = F.get_json_object("reply", "$.error").isNull()
    rows = replies.where("reply is not null").select("broadcast", "peer", ok.alias("ok"), F.struct((~ok).alias("failed"), "position").alias("place"))
    return rows.groupBy("broadcast").agg(F.min_by(F.struct("peer", "ok"), "place").alias("x")).select("broadcast", "x.peer", "x.ok")
