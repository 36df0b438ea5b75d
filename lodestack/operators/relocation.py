"""Stored spans found again in sources that have changed since."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = ("missing", "current", "relocated", "ambiguous", "stale")


def relocated(spans: DataFrame, sources: DataFrame) -> DataFrame:
    """(span_id, source_id, state, line): where spans (span_id, source_id, start, block) stand in sources (source_id, text) now.

    A block is whole lines, `start` its first line as stored, from 1. It is current where it still stands
    there, relocated if it occurs as whole lines at one place only, ambiguous at several (places may
    overlap), stale at none, and missing if its source is gone or null. `line` is the line where it
    stands, for current and relocated spans. Null blocks and ids have no state.

    Spans meet their source as one row, which carries the text once; the text is searched only for spans
    that do not stand where they were, and at most two places of each are looked for.
    """
    spans = spans.where("span_id IS NOT NULL AND source_id IS NOT NULL AND block IS NOT NULL")
    grouped = spans.groupBy("source_id").agg(F.collect_list(F.struct("span_id", F.coalesce("start", F.lit(0)).cast("int").alias("start"), "block")).alias("spans"))
    now = grouped.join(sources.select("source_id", "text"), "source_id", "left").withColumn("now", F.split("text", "\n", -1)).withColumn("framed", F.concat(F.lit("\n"), "text", F.lit("\n")))

    def at(s):
        """Places of the block, as (there, first, second); the last two are characters, 0 for none."""
        size = F.size(F.split(s["block"], "\n", -1))
        here = (s["start"] >= 1) & (F.array_join(F.slice("now", F.greatest(s["start"], F.lit(1)), size), "\n") == s["block"]) & (s["start"] + size - 1 <= F.size("now"))
        needle = F.concat(F.lit("\n"), s["block"], F.lit("\n"))
        first = F.when(here, 0).otherwise(F.position(needle, F.col("framed"), F.lit(1)))
        second = F.when(first > 0, F.position(needle, F.col("framed"), first + 1)).otherwise(0)
        return F.struct(s["span_id"].alias("span_id"), s["start"].alias("start"), here.alias("here"), first.alias("first"), second.alias("second"))

    rows = now.select("source_id", "framed", F.explode(F.transform("spans", at)).alias("p")).select("source_id", "framed", "p.*")
    state = F.when(F.col("framed").isNull(), STATES[0]).when(F.col("here"), STATES[1]).when(F.col("first") == 0, STATES[4]).when(F.col("second") > 0, STATES[3]).otherwise(STATES[2])
    before = F.size(F.split(F.substr("framed", F.lit(1), F.col("first") - 1), "\n", -1))
    line = F.when(F.col("state") == "current", F.col("start")).when(F.col("state") == "relocated", before)
    return rows.withColumn("state", state).select("span_id", "source_id", "state", line.cast("int").alias("line"))
