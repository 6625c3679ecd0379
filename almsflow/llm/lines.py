"""Removal of boilerplate lines that are spread over many sites, in DataFrame operations only.

Each distinct line gets a HyperLogLog sketch of its sites, merged by aggregation. Where the estimate is
far from the threshold it decides; lines near the threshold get an exact distinct count.
The hashes of lines that go are joined back, and each text is rebuilt without them.

A sketch of 2^``LG_K`` registers has a standard error of 1.04 / sqrt(2^LG_K), 3.3 % here; ``NEAR`` is over
six of these.

Defined cases: a line is what stands between line feeds, without blanks at its ends; empty lines stay; null
text stays null with no lines; a null site is no site; a line of one document counts its site once;
repeated rows are rebuilt alike; an empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from almsflow.runtime import cut_lineage

MIN_SITES = 8
LG_K = 10
NEAR = 0.2


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _rows(docs: DataFrame, site: str) -> DataFrame:
    """One row per non-empty line: document key, place, site, hash of the trimmed line."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("_t"), F.col(site).alias("_site"), F.posexplode(_lines(F.col("text"))).alias("_pos", "_line"))
    trimmed = F.trim(F.col("_line"))
    return keyed.where(trimmed != "").select("doc_id", "_t", "_pos", "_site", F.xxhash64(trimmed).alias("_h"), F.octet_length(trimmed).alias("_n"))


def spread_lines(rows: DataFrame, min_sites: int) -> DataFrame:
    """``(_h, _n)`` of lines on ``min_sites`` sites or more."""
    sketched = (rows.groupBy("_h", "_n").agg(F.hll_sketch_agg("_site", F.lit(LG_K)).alias("_s"))
                .select("_h", "_n", F.hll_sketch_estimate("_s").alias("_sites")).where(F.col("_sites") >= min_sites * (1 - NEAR)))
    judged = cut_lineage(sketched)
    near = judged.where(F.col("_sites") <= min_sites * (1 + NEAR)).select("_h", "_n")
    exact = (rows.where(F.col("_site").isNotNull()).join(near, ["_h", "_n"], "left_semi").select("_h", "_n", "_site").distinct()
             .groupBy("_h", "_n").agg(F.count(F.lit(1)).alias("_exact")).where(F.col("_exact") >= min_sites).select("_h", "_n"))
    return judged.where(F.col("_sites") > min_sites * (1 + NEAR)).select("_h", "_n").union(exact)


def without_spread_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, n_lines, n_removed and the remaining text of every document."""
    rows = _rows(docs, site)
    spread = cut_lineage(spread_lines(rows, min_sites))
    # A repeated row finds the same places again; a set keeps each once.
    places = cut_lineage(rows.join(spread, ["_h", "_n"]).groupBy("doc_id", "_t").agg(F.collect_set("_pos").alias("_gone")))
    id_key = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_t"), id_key(F.col("doc_id")).alias("_id"))
    gone = places.select(id_key(F.col("doc_id")).alias("_id"), "_t", "_gone")
    joined = keyed.join(gone, ["_id", "_t"], "left")
    lines = _lines(F.col("text"))
    left = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_gone", i)), "\n"))
    return joined.select("doc_id", F.coalesce(F.size(F.filter(lines, lambda x: F.trim(x) != "")), F.lit(0)).cast("long").alias("n_lines"),
                         F.greatest(F.coalesce(F.size("_gone"), F.lit(0)), F.lit(0)).cast("long").alias("n_removed"), left.alias("text"))
