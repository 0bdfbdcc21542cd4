"""Coded messages by a join with the codebook table, for codebooks of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A codebook of up to so many entries (some 5 MB) is broadcast.
BROADCAST_ENTRIES = 10_000


def join_codebook(messages: DataFrame, codebook: DataFrame) -> DataFrame:
    """(prefix, code, body) rows with vendor, description, action, event_type and the body's fields.

    An unknown code leaves them null; `fields` is null where the body isn't what the codebook says.
    """
    small = codebook.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES
    joined = messages.join(F.broadcast(codebook) if small else codebook, ["prefix", "code"], "left")
    values = F.expr("transform(groups, (g, i) -> regexp_extract(body, regex, i + 1))")
    kept = F.expr("filter(arrays_zip(groups, v), x -> x.groups IS NOT NULL)")
    found = joined.withColumn("v", F.when(F.expr("body rlike regex"), values))
    return found.withColumn("fields", F.when(F.col("v").isNotNull(), F.map_from_entries(kept))).drop("v", "regex", "groups")
