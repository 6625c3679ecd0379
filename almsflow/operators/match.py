"""Resolve grant recipients to registry organisations by blocked fuzzy matching.

A recipient takes the best registry name|city in its ZIP that scores at least
the threshold, else the best in its state, else nothing. The search inside a
block is :mod:`almsflow.operators.nearest`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from almsflow.functions import text as X
from almsflow.functions.similarity import indel_score, levenshtein_score
from almsflow.operators.nearest import search
from almsflow.operators.relational import nonempty
from almsflow.runtime import cut_lineage

Scorer = Callable[[Column, Column], Column]

CLEAN_KEY = ["clean_recipient_name", "clean_recipient_city", "clean_recipient_state", "clean_recipient_zip"]


def _payloads(left: DataFrame, right: DataFrame, block: Sequence[str]) -> tuple[list[Column], list[Column]]:
    return ([F.col(c).alias(f"l_{c}") for c in left.columns if c not in block],
            [F.col(c).alias(f"r_{c}") for c in right.columns if c not in block])


def _pairs_of_block(left: DataFrame, right: DataFrame, block: Sequence[str]) -> DataFrame:
    of_left, of_right = _payloads(left, right, block)
    return left.select(*block, *of_left).join(right.select(*block, *of_right), [*block], "inner")


#: Scorers that never exceed the indel score, so its bounds lose nothing. The Levenshtein score of
#: strings with m = max(a, b): an alignment at distance d keeps at least m - d characters, so the longest
#: common subsequence is no shorter, and 200 * LCS / (a + b) >= 200 * (m - d) / (2 m) = 100 * (1 - d / m).
_BOUNDED = (indel_score, levenshtein_score)


def candidate_pairs(left: DataFrame, right: DataFrame, block: Sequence[str], threshold: float, prune: bool = True) -> DataFrame:
    """Every pair of a block that could reach the threshold, each once, payloads prefixed ``l_`` / ``r_``.

    ``prune`` uses bounds of the indel score; without it all pairs of a block come out, which is quadratic in a block.
    """
    if not prune:
        return _pairs_of_block(left, right, block)
    return search(left, right, block, threshold, best=False).withColumnRenamed("text", "l_text").drop("score")


def best_matches(left: DataFrame, right: DataFrame, block: Sequence[str], threshold: float,
                 scorer: Scorer = indel_score) -> DataFrame:
    """Per left ``(block, text)``: the best-scoring right row at or above the threshold.

    ``right`` carries ``(ord, key, ein)``; equal scores go to the lowest
    ``ord``. The arg-max aggregates before its shuffle. Any other scorer than
    those of ``_BOUNDED`` is tried on all pairs of a block.
    """
    if scorer is indel_score:
        scored = search(left, right, block, threshold)
    else:
        pairs = candidate_pairs(left, right, block, threshold, scorer in _BOUNDED)
        scored = (pairs.withColumnRenamed("l_text", "text").withColumn("score", scorer(F.col("text"), F.col("r_text")))
                  .filter(F.col("score") >= threshold))
    winner = F.min_by(F.struct("score", F.col("r_ein").alias("ein"), F.col("r_key").alias("key")),
                      F.struct((-F.col("score")).alias("s"), F.col("r_ord").alias("o")))
    return (scored.groupBy(*block, "text").agg(winner.alias("w"))
            .select(*block, "text", "w.score", "w.ein", "w.key"))


def with_clean_recipients(grants: DataFrame) -> DataFrame:
    """Cleaned recipient columns; rows without a usable name or state are left out."""
    cleaned = grants.withColumns({
        CLEAN_KEY[0]: X.clean_name(F.col("recipient_name")), CLEAN_KEY[1]: X.clean_city(F.col("recipient_city")),
        CLEAN_KEY[2]: X.clean_state(F.col("recipient_state")), CLEAN_KEY[3]: X.clean_zip(F.col("recipient_zip")),
    })
    return nonempty(cleaned, CLEAN_KEY[0], CLEAN_KEY[2])


def clean_registry(registry: DataFrame) -> DataFrame:
    """``(state, zip, key, ein, ord)`` rows; ``ord`` of any sortable type must be a total order of the registry."""
    return registry.select(
        X.clean_state(F.col("STATE")).alias("state"), X.clean_zip(F.col("ZIP")).alias("zip"),
        X.lookup_key(X.clean_name(F.col("NAME")), X.clean_city(F.col("CITY"))).alias("key"),
        F.col("EIN").alias("ein"), F.col("ord"))


def last_wins(rows: DataFrame, keys: Sequence[str], value: str = "ein", order: str = "ord") -> DataFrame:
    """Per key the value of its last row, and the position of its first."""
    return rows.groupBy(*keys).agg(F.max_by(value, order).alias(value), F.min(order).alias(order))


def _one_per_text(keys: DataFrame, block: Sequence[str]) -> DataFrame:
    """Keys with the same words score alike: keep the first of each."""
    return (keys.withColumn("text", X.sorted_tokens(F.col("key")))
            .groupBy(*block, "text").agg(F.min_by(F.struct("key", "ein", "ord"), "ord").alias("k"))
            .select(*block, "text", "k.key", "k.ein", "k.ord"))


def match_recipients(recipients: DataFrame, registry: DataFrame, threshold: float = 85,
                     scorer: Scorer = indel_score) -> DataFrame:
    """``(CLEAN_KEY, inferred_ein, match_score, match_type)`` for distinct recipients.

    ``recipients`` holds CLEAN_KEY; ``registry`` the raw registry with an
    ``ord`` column. Passes, each over what the one before left:
    ZIP pass -> exact words in the state -> fuzzy in the state.
    """
    # Both feed several steps below; written once, the grants are read once.
    who = cut_lineage(recipients.select(
        *CLEAN_KEY, F.col(CLEAN_KEY[2]).alias("state"), F.col(CLEAN_KEY[3]).alias("zip"),
        X.sorted_tokens(X.lookup_key(F.col(CLEAN_KEY[0]), F.col(CLEAN_KEY[1]))).alias("text")))
    rows = cut_lineage(clean_registry(registry))
    by_state = last_wins(rows, ["state", "key"])
    # A ZIP's key takes the state-wide identifier of that key, but its own first position.
    by_zip = (rows.filter("zip <> ''").groupBy("state", "zip", "key").agg(F.min("ord").alias("ord"))
              .join(by_state.drop("ord"), ["state", "key"], "inner"))
    zip_texts = _one_per_text(by_zip, ["state", "zip"])
    state_texts = _one_per_text(by_state, ["state"])

    zip_hits = cut_lineage(best_matches(
        who.filter("zip <> ''").select("state", "zip", "text").distinct(), zip_texts,
        ["state", "zip"], threshold, scorer))
    left_over = who.join(zip_hits, ["state", "zip", "text"], "left_anti").select("state", "text").distinct()
    if scorer is indel_score:
        # Equal word strings score 100 and nothing scores more, so they need no search.
        exact = left_over.join(state_texts, ["state", "text"], "inner").select(
            "state", "text", F.lit(100.0).alias("score"), "ein", "key")
        rest = left_over.join(state_texts, ["state", "text"], "left_anti")
        state_hits = exact.unionByName(best_matches(rest, state_texts, ["state"], threshold, scorer))
    else:
        state_hits = best_matches(left_over, state_texts, ["state"], threshold, scorer)

    # One row per two-letter state code, so it may go to every executor.
    known_states = rows.select("state").distinct().withColumn("known", F.lit(True))
    z = zip_hits.select("state", "zip", "text", F.struct("ein", "score").alias("z"))
    s = state_hits.select("state", "text", F.struct("ein", "score").alias("s"))
    hit = F.coalesce("z", "s")
    return (who.join(z, ["state", "zip", "text"], "left").join(s, ["state", "text"], "left")
            .join(F.broadcast(known_states), "state", "left")
            .select(*CLEAN_KEY, hit["ein"].alias("inferred_ein"),
                    F.coalesce(hit["score"], F.when(F.col("known"), F.lit(0.0))).alias("match_score"),
                    F.when(F.col("z").isNotNull(), "zip+fuzzy").when(F.col("s").isNotNull(), "state_fuzzy")
                    .when(F.col("known"), "no_match").alias("match_type")))


def infer_recipients(grants: DataFrame, registry: DataFrame, threshold: float = 85,
                     scorer: Scorer = indel_score) -> DataFrame:
    """Grant rows with cleaned columns and the inferred recipient identifier.

    A recipient in a state the registry does not cover keeps null score and
    type. When the registry covers no recipient's state at all, every row
    reads 'no_match' with score 0.
    """
    cleaned = with_clean_recipients(grants)
    found = cut_lineage(match_recipients(cleaned.select(*CLEAN_KEY).distinct(), registry, threshold, scorer))
    if found.filter("match_type IS NOT NULL").isEmpty():
        found = found.withColumns({"match_score": F.lit(0.0), "match_type": F.lit("no_match")})
    return cleaned.join(found, CLEAN_KEY, "left")
