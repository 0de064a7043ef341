"""Removing products already exported or already accepted in this run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmill.session import stored


def first_per_handle(
    cards: DataFrame, handle: str = "handle", order: str = "seq"
) -> DataFrame:
    """Earliest row per handle.

    An aggregate combines on the map side, so a handle that holds a large part
    of the table costs one row per task in the shuffle.
    """
    rest = [c for c in cards.columns if c != handle]
    first = cards.groupBy(handle).agg(F.min_by(F.struct(*rest), order).alias("_first"))
    return first.select(handle, "_first.*").select(*cards.columns)


def not_exported(
    cards: DataFrame, exported: DataFrame, handle: str = "handle"
) -> DataFrame:
    """Cards whose handle is not in the exported handles (column ``handle``).

    Both sides keep their size: adaptive execution broadcasts the handles only
    if they measure small, and splits hot keys of the cards otherwise.
    """
    known = exported.select(F.col("handle").alias(handle))
    return cards.join(known, handle, "left_anti")


def known_handles(*sources: DataFrame) -> DataFrame:
    """Distinct union of handle tables (column ``handle``)."""
    union = sources[0].select("handle")
    for s in sources[1:]:
        union = union.unionByName(s.select("handle"))
    return union.where(F.col("handle").isNotNull()).distinct()


def _skipped_in_chains(pending: DataFrame) -> DataFrame:
    """``s`` of the pending pairs that the chains they lie in decide against.

    A pair with one pending producer of its card handle before it is the
    opposite of that producer. Along a run of such pairs the opposites compose
    to a parity, so pointer doubling leads every pair to the head of its run in
    a number of rounds that grows with the logarithm of the run. A head without
    a pending producer is accepted.
    """
    one = pending.groupBy(F.col("f").alias("h")).agg(F.min("s").alias("s1"))
    two = pending.join(one, F.col("f") == F.col("h")).where(F.col("s") > F.col("s1"))
    two = two.groupBy(F.col("f").alias("h2")).agg(F.min("s").alias("s2"))
    held = pending.join(one, F.col("c") == F.col("h"), "left").join(two, F.col("c") == F.col("h2"), "left")
    held = stored(held.select("s", F.when(F.col("s1") < F.col("s"), F.col("s1")).alias("s1"), F.coalesce(F.col("s2") < F.col("s"), F.lit(False)).alias("more")), "producers")
    heads = held.where("s1 is null").select(F.col("s").alias("head"))
    runs = stored(held.where("s1 is not null and not more").select("s", F.col("s1").alias("up"), F.lit(1).alias("odd")), "runs")
    while True:
        far = runs.select(F.col("s").alias("node"), F.col("up").alias("far"), F.col("odd").alias("odd2"))
        ahead = runs.join(far, F.col("up") == F.col("node"), "left")
        ahead = ahead.select("s", F.coalesce("far", "up").alias("up"), F.col("odd").bitwiseXOR(F.coalesce("odd2", F.lit(0))).alias("odd"), F.col("node").isNotNull().alias("moved"))
        ahead = stored(ahead, "runs")
        runs = ahead.drop("moved")
        if not ahead.where("moved").take(1):
            break
    return runs.where("odd = 1").join(heads, F.col("up") == F.col("head"), "left_semi").select("s")


def accept_in_order(
    cards: DataFrame,
    card_handle: str = "handle",
    final_handle: str = "final_handle",
    order: str = "seq",
) -> DataFrame:
    """Cards a sequential run accepts when it tests one handle and records another.

    A card is skipped iff an earlier *accepted* card recorded its card handle.
    Let T(h) be the first accepted card with final handle h; card i is
    accepted iff its order <= T(card handle of i), or T is undefined there.
    Lower and upper bounds of T are refined in turn until they agree. Only the
    first card of each (card handle, final handle) pair can define T, so the
    rounds run on a pre-aggregated pair table. Runs of pairs that each hang on
    one other are settled at once, so the number of rounds grows with the
    nesting of pairs that hang on several, and with the logarithm of a run.
    ``order`` is unique.
    """
    pairs = stored(
        cards.groupBy(F.col(card_handle).alias("c"), F.col(final_handle).alias("f")).agg(
            F.min(order).alias("s")
        ),
        "pairs",
    )

    def earliest(accepted: DataFrame) -> DataFrame:
        return accepted.groupBy(F.col("f").alias("c")).agg(F.min("s").alias("t"))

    def admitted(bound: DataFrame) -> DataFrame:
        held = pairs.join(bound, "c", "left")
        return held.where(F.col("t").isNull() | (F.col("s") <= F.col("t"))).drop("t")

    possible = pairs
    while True:
        sure = stored(admitted(earliest(possible)), "sure")
        possible = stored(admitted(earliest(sure)), "possible")
        pending = stored(possible.join(sure.select("s"), "s", "left_anti"), "pending")
        if not pending.take(1):
            break
        possible = possible.join(_skipped_in_chains(pending), "s", "left_anti")
    first = earliest(sure).select(F.col("c").alias(card_handle), "t")
    verdict = cards.join(first, card_handle, "left")
    return verdict.where(F.col("t").isNull() | (F.col(order) <= F.col("t"))).select(
        *cards.columns
    )


def handle_collisions(products: DataFrame, handle: str = "handle", identity: str = "source_url") -> DataFrame:
    """Handles shared by several distinct products."""
    return (
        products.groupBy(handle)
        .agg(F.countDistinct(identity).alias("n_products"))
        .where(F.col("n_products") > 1)
    )
