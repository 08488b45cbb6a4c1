"""Near duplicates: events of one block whose Status texts are nearly the same.

A block holds the events that agree on device, type and time (or on device and type only). A row is
dropped when any earlier row of its block has a similar Status, dropped or not. Since the score depends
on the token-sort key of the Status alone, only the first arrival of every (block, key) matters:

1. exact copies go, by a first-per-identity filter that thins out copies before the shuffle, and what is
   left is written once; the steps below read narrow columns of it;
2. blocks with a single row are settled, and of the others only the first arrival per key goes on;
3. every key is compared with the first few keys of its block, which settles all blocks with no more
   keys than that;
4. keys that are still open in larger blocks look for an earlier similar key through shared substrings,
   which misses none (see functions.similarity) and does not form the pairs of the block.

These steps run when the operator is called, and are left out where they have nothing to do. Whole events
are moved by the first step alone; the others find the identities of the rows that are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.similarity import (
    chunks_needed,
    key_chunks,
    key_grams,
    key_ratio,
    longest_partner,
    similar_keys,
    token_sort_key,
)
from hearthline.operators.dedup import exact_dedup, first_n_per
from hearthline.schemas import ARRIVAL, IDENTITY, SIMILARITY_THRESHOLD
from hearthline.session import staged

DEVICE = ["DeviceId", "DeviceType"]
# Keys of a block every other key is compared with directly.
HEADS = 8
# Ways a substring shared by many keys of one block is spread over tasks.
SPREAD = 16


def block_columns(match_timestamp: bool = True) -> list[str]:
    return [*DEVICE, "TimestampUTC"] if match_timestamp else list(DEVICE)


def checked_threshold(threshold: float) -> float:
    """A similarity of 0 would make every text of a block a copy of its first one, which nobody means."""
    if not 0 < threshold <= 100:
        raise ValueError(f"a similarity threshold lies above 0 and up to 100, not at {threshold}")
    return threshold


def _with_key(events: DataFrame, case_insensitive: bool) -> DataFrame:
    return events.withColumn("_key", token_sort_key(F.col("Status"), case_insensitive))


def _by_merge(rows: DataFrame) -> DataFrame:
    """For joins with a table that grows with the events: it is never broadcast.

    The planner goes by the size of files, and similar texts take far less room there than in memory.
    """
    return rows.hint("merge")


def _mixed_blocks(rows: DataFrame, block: Sequence[str], text: str) -> DataFrame:
    """Blocks with at least two values of `text`; the extremes combine on the map side."""
    return (
        rows.groupBy(*block)
        .agg(F.min(text).alias("_lo"), F.max(text).alias("_hi"))
        .where(F.col("_lo") != F.col("_hi"))
        .select(*block)
    )


def _first_arrivals(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per group the order columns, time and Status of its first arrival, as `_first`."""
    return rows.groupBy(*by).agg(F.min(F.struct(*order, "TimestampUTC", "Status")).alias("_first"))


def first_keys_per_device(keyed: DataFrame, block: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First arrival of each key, for blocks with at least two keys: block, `_key`, `_first`.

    There are few keys per device, so grouping thins the rows out first.
    """
    firsts = staged(_first_arrivals(keyed, [*block, "_key"], order), "first-keys")
    return firsts.join(_by_merge(_mixed_blocks(firsts, block, "_key")), list(block), "left_semi")


def _gram_rows(keys: DataFrame, block: Sequence[str], threshold: float) -> DataFrame:
    """One row per key and substring under which a shorter key may look it up: block, `_l`, `_gram`."""
    return keys.select(
        *block, F.struct("_key", "_first").alias("_l"), F.explode(key_grams(F.col("_key"), threshold)).alias("_gram")
    )


def _chunk_rows(keys: DataFrame, grams: DataFrame, block: Sequence[str], threshold: float) -> DataFrame:
    """One row per key and chunk it is looked up by: block, `_s`, `_chunks`, `_no`, `_gram`.

    Of its chunks each key uses as many as needed, those that fewest keys of the block contain.
    """
    holders = grams.groupBy(*block, "_gram").agg(F.count("*").alias("_holders"))
    chunks = keys.select(*block, "_key", "_first", F.explode(key_chunks(F.col("_key"), threshold)).alias("_gram"))
    ranked = (
        chunks.join(_by_merge(holders), [*block, "_gram"])
        .groupBy(*block, "_key", "_first")
        .agg(F.sort_array(F.collect_list(F.struct("_holders", "_gram"))).alias("_ranked"))
    )
    chosen = F.slice("_ranked", F.lit(1), chunks_needed(F.length("_key"), threshold))
    return ranked.select(
        *block,
        F.struct("_key", "_first").alias("_s"),
        F.array_distinct(F.transform(chosen, lambda c: c["_gram"])).alias("_chunks"),
    ).select("*", F.posexplode("_chunks").alias("_no", "_gram"))


def _is_similar_pair(threshold: float) -> Column:
    """For a shorter key `_s` and a longer key `_l`; two keys of one length count in one order only."""
    s_key, l_key = F.col("_s._key"), F.col("_l._key")
    s_len, l_len = F.length(s_key), F.length(l_key)
    return (
        ((s_len < l_len) | ((s_len == l_len) & (s_key < l_key)))
        & (l_len <= longest_partner(s_len, threshold))
        & similar_keys(s_key, l_key, threshold)
    )


def _at_first_shared_chunk() -> Column:
    """No chunk of `_s` before `_no` occurs in `_l`."""
    return ~F.exists(F.slice("_chunks", F.lit(1), F.col("_no")), lambda c: F.contains(F.col("_l._key"), c))


def _salted_join(
    left: DataFrame, left_key: str, right: DataFrame, block: Sequence[str], condition: Column, how: str
) -> DataFrame:
    """Join on block and substring, with the left rows of a common substring spread over tasks.

    The number of partitions is fixed: merged by their size, which is small, they would leave the many
    comparisons to few tasks.
    """
    by = [*block, "_gram", "_salt"]
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(left_key), F.lit(SPREAD)).cast("int"))
    copied = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    names = {c: f"_right_{c}" for c in by}
    renamed = copied.repartition(n, *by).withColumnsRenamed(names)
    same = reduce(lambda x, y: x & y, [F.col(c) == F.col(name) for c, name in names.items()])
    return spread.repartition(n, *by).join(_by_merge(renamed), same & condition, how)


def _similar_pairs(keys: DataFrame, block: Sequence[str], threshold: float) -> DataFrame:
    """All pairs of similar keys, each once: block, `_s`, `_l`."""
    nonempty = keys.where(F.length("_key") > 0)
    grams = _gram_rows(nonempty, block, threshold)
    chunks = _chunk_rows(nonempty, grams, block, threshold)
    condition = _at_first_shared_chunk() & _is_similar_pair(threshold)
    pairs = _salted_join(grams, "_l._key", chunks, block, condition, "inner")
    return pairs.select(*block, "_s", "_l")


def _beaten(keys: DataFrame, is_open: Column, block: Sequence[str], threshold: float) -> DataFrame:
    """Open keys with an earlier similar key: block and `_key`.

    Semi-joins stop at the first such key, once with the open key as the shorter and once as the longer.
    """
    nonempty = keys.where(F.length("_key") > 0)
    grams = _gram_rows(nonempty, block, threshold)
    chunks = _chunk_rows(nonempty, grams, block, threshold)
    opened = nonempty.where(is_open)
    open_grams = _gram_rows(opened, block, threshold)
    open_chunks = _chunk_rows(opened, grams, block, threshold)
    similar = _is_similar_pair(threshold)
    as_short = _salted_join(
        open_chunks, "_s._key", grams, block, (F.col("_l._first") < F.col("_s._first")) & similar, "left_semi"
    )
    as_long = _salted_join(
        open_grams, "_l._key", chunks, block, (F.col("_s._first") < F.col("_l._first")) & similar, "left_semi"
    )
    found = as_short.select(*block, F.col("_s._key").alias("_key"))
    return found.unionByName(as_long.select(*block, F.col("_l._key").alias("_key"))).distinct()


def losing_keys(firsts: DataFrame, block: Sequence[str], threshold: float, heads: int | None = None) -> DataFrame:
    """Keys with an earlier similar key in their block: block and `_key`."""
    heads = heads or HEADS
    leading = (
        first_n_per(firsts, block, ["_first"], heads)
        .groupBy(*block)
        .agg(F.collect_list(F.struct("_first", "_key")).alias("_heads"))
    )

    def beaten_by(head: Column) -> Column:
        return (head["_first"] < F.col("_first")) & similar_keys(head["_key"], F.col("_key"), threshold)

    last_head = F.array_max(F.transform("_heads", lambda h: h["_first"]))
    judged = staged(
        firsts.join(_by_merge(leading), list(block)).select(
            *block,
            "_key",
            "_first",
            F.exists("_heads", beaten_by).alias("_lost"),
            ((F.size("_heads") >= heads) & (F.col("_first") > last_head)).alias("_after_heads"),
        ),
        "judged-keys",
    )
    lost = judged.where("_lost").select(*block, "_key")
    is_open = F.col("_after_heads") & ~F.col("_lost")
    unsettled = judged.where(is_open).select(*block).distinct()
    if unsettled.isEmpty():
        return lost
    crowded = judged.join(_by_merge(unsettled), list(block), "left_semi")
    late = staged(_beaten(crowded, is_open, block, threshold), "late-keys")
    return lost.unionByName(late)


def lost_events(exact: DataFrame, threshold: float, case_insensitive: bool, order: Sequence[str]) -> DataFrame | None:
    """Identities of the rows with an earlier similar one at the same time; None where no block has two rows.

    `exact` holds one row per identity. So a block of several rows has several texts, and a plain count finds
    the few blocks that need a closer look.
    """
    block = block_columns()
    crowded = exact.groupBy(*block).agg(F.count("*").alias("_rows")).where(F.col("_rows") > 1).select(*block)
    narrow = _with_key(exact.select(*dict.fromkeys([*block, "Status", *order])), case_insensitive)
    mixed = staged(narrow.join(_by_merge(crowded), block, "left_semi"), "mixed-blocks")
    if mixed.isEmpty():
        return None
    firsts = staged(_first_arrivals(mixed, [*block, "_key"], order), "first-keys")
    later = mixed.withColumn("_rn", F.row_number().over(Window.partitionBy(*block, "_key").orderBy(*order))).where(F.col("_rn") > 1)
    similar = mixed.join(_by_merge(losing_keys(firsts, block, threshold)), [*block, "_key"], "left_semi")
    return staged(later.select(*IDENTITY).unionByName(similar.select(*IDENTITY)).distinct(), "lost-events")


def without(rows: DataFrame, lost: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key isn't among the lost ones; NULLs count as equal."""
    renamed = lost.select(*[F.col(c).alias(f"_lost_{c}") for c in key])
    return rows.join(renamed, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_lost_{c}")) for c in key]), "left_anti")


def drop_near_duplicates(
    events: DataFrame,
    threshold: float = SIMILARITY_THRESHOLD,
    case_insensitive: bool = True,
    match_timestamp: bool = True,
    order: Sequence[str] = ARRIVAL,
    is_exact: bool = False,
) -> DataFrame:
    """Events without an earlier similar event in their block.

    Exact duplicates are the special case of equal texts, so this removes them as well. With
    `match_timestamp=False` any two similar events of a device count as duplicates, whatever their times.
    `is_exact` tells that the events are a written table of one row per identity, so that step 1 is done.
    """
    checked_threshold(threshold)
    exact = events if is_exact else staged(exact_dedup(events, order), "exact-events")
    if match_timestamp:
        lost = lost_events(exact, threshold, case_insensitive, order)
        return exact if lost is None else without(exact, lost, IDENTITY).select(*events.columns)
    block = block_columns(match_timestamp)
    keyed = _with_key(exact, case_insensitive)
    kept = first_n_per(keyed, [*block, "_key"], order, 1)
    firsts = first_keys_per_device(keyed, block, order)
    return kept.join(_by_merge(losing_keys(firsts, block, threshold)), [*block, "_key"], "left_anti").select(*events.columns)


def candidate_pairs(
    events: DataFrame,
    threshold: float = SIMILARITY_THRESHOLD,
    case_insensitive: bool = True,
    match_timestamp: bool = True,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Similar Status texts within a block, with the comparison features, earlier text on the left.

    One row per pair of similar keys, between their first arrivals, and one per further spelling of a
    key, paired with the first spelling. Pairs below the threshold are never formed.
    """
    checked_threshold(threshold)
    block = block_columns(match_timestamp)
    keyed = _with_key(events, case_insensitive)
    spelled = keyed.withColumn("_text", F.col("Status"))
    by = [*block, "_key", "_text"]
    if match_timestamp:
        mixed = staged(_mixed_blocks(keyed, block, "Status"), "mixed-blocks")
        spelled = spelled.join(_by_merge(mixed), block, "left_semi")
    texts = staged(_first_arrivals(spelled, by, order), "first-texts")
    firsts = texts.groupBy(*block, "_key").agg(F.min("_first").alias("_first"))
    spellings = (
        texts.select(*block, "_key", F.col("_first").alias("_right"))
        .join(_by_merge(firsts.withColumnRenamed("_first", "_left")), [*block, "_key"])
        .where(F.col("_left.Status") != F.col("_right.Status"))
        .select(*block, "_left", "_right", F.lit(100.0).alias("status_fuzzy"))
    )
    similar = _similar_pairs(firsts, block, threshold).select(
        *block,
        F.least("_s._first", "_l._first").alias("_left"),
        F.greatest("_s._first", "_l._first").alias("_right"),
        key_ratio(F.col("_s._key"), F.col("_l._key")).alias("status_fuzzy"),
    )

    def exact(left: Column, right: Column) -> Column:
        return F.coalesce((left == right).cast("int"), F.lit(0))

    return spellings.unionByName(similar).select(
        *DEVICE,
        F.col("_left.TimestampUTC").alias("left_timestamp"),
        F.col("_left.Status").alias("left_status"),
        F.col("_right.TimestampUTC").alias("right_timestamp"),
        F.col("_right.Status").alias("right_status"),
        F.lit(1).alias("DeviceId_exact"),
        F.lit(1).alias("DeviceType_exact"),
        exact(F.col("_left.TimestampUTC"), F.col("_right.TimestampUTC")).alias("timestamp_exact"),
        "status_fuzzy",
    )
