"""Semantic event groups: same city and category, at most 24 h apart, similar titles.

Events are taken in time order. An event joins the first group whose leader matches it, else it leads
a new group. Similarity is 1 − edit distance / longer length (the reference behaviour uses a matching-
blocks ratio; thresholds are parameters).

Scale: copies (same city, category, title, place) share one entry, so similarity is computed once per
distinct title. A block with few titles on one side compares all pairs; candidates of a crowded one come from a
segment index: a title within d edits of another contains one of its d + 1 segments near the same position. Grouping is rounds over (title, day) frontiers - the
earliest and latest open event of each day. A round links only the first titles of each block and day, which
become leaders or wait, with the others: titles that all match meet a leader, not each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelforge.functions import text as tx, times as tm
from panelforge.session import cut_lineage, sorted_join

DAY = 86_400_000_000


def _max_edits(length: Column, ratio: float) -> Column:
    return F.floor(length * (1 - ratio) + F.lit(1e-9)).cast("int")


def _segments(df: DataFrame, ratio: float) -> DataFrame:
    """Adds _i (1-based), _p (start) and _w (width) for the d + 1 segments of a title of length _m."""
    parts = df.withColumn("_d", _max_edits(F.col("_m"), ratio)).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_d") + 1)))
    base = F.floor(F.col("_m") / (F.col("_d") + 1)).cast("int")
    longer = F.col("_d") + 1 - F.col("_m") % (F.col("_d") + 1)
    extra = F.greatest(F.lit(0), F.col("_i") - 1 - longer)
    return parts.withColumns(
        {"_p": (F.col("_i") - 1) * base + extra + 1, "_w": base + F.when(F.col("_i") > longer, 1).otherwise(0)}
    )


#: Titles of the smaller side of a block up to which all its pairs are compared: an index makes some thousand rows of each title.
PAIRED = 1024
#: Titles of the right side that one part of such a block holds.
PART = 4096


def _alike(ratio: Column) -> Column:
    """Whether titles _s and _rs, the longer of length _m, reach the ratio; the distance is counted no further than needed."""
    edits = F.call_function("levenshtein", F.col("_s"), F.col("_rs"), _max_edits(F.col("_m"), ratio) + 1)
    return F.when(F.col("_m") == 0, True).otherwise((edits >= 0) & (1 - edits / F.col("_m") >= ratio - 1e-9))


def similar_titles(left: DataFrame, right: DataFrame, block: list[str], key: str, title: str, ratio: float | Column) -> DataFrame:
    """(a, b) of all pairs of a block with a from ``left``, b from ``right`` and a similarity of at least ``ratio``, a number or a
    column made of the block's. A title on both sides is no pair with itself. Complete: blocks with few titles on one side
    compare all pairs, parts of the other side apart; crowded ones find them by a segment index.
    """
    ratio = ratio if isinstance(ratio, Column) else F.lit(float(ratio))
    sized = lambda t: t.select(*block, key, F.col(title).alias("_s"), F.length(title).alias("_l"))
    one, two = sized(left), sized(right)
    counted = lambda t, name: t.groupBy(*block).agg(F.count(F.lit(1)).alias(name))
    sizes = counted(one, "_n1").join(sorted_join(counted(two, "_n2")), block)
    sizes = cut_lineage(sizes.select(*block, (F.least("_n1", "_n2") <= PAIRED).alias("_few"), F.ceil(F.col("_n2") / PART).cast("int").alias("_parts")))
    few, many = sorted_join(sizes.filter("_few")), sorted_join(sizes.filter("NOT _few").select(*block))
    paired = _compared(one.join(few, block), two.join(few, block), block, key, ratio)
    if many.isEmpty():
        return paired.distinct()
    return paired.unionByName(_indexed(one.join(many, block, "left_semi"), two.join(many, block, "left_semi"), block, key, ratio)).distinct()


def _compared(left: DataFrame, right: DataFrame, block: list[str], key: str, ratio: Column) -> DataFrame:
    """``similar_titles`` by comparing all pairs of a block."""
    ones = left.select(*block, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), F.col(key).alias("_r"), "_s", "_l")
    twos = right.select(*block, F.pmod(F.xxhash64(key), F.col("_parts")).cast("int").alias("_part"), F.col(key).alias("_k"), F.col("_s").alias("_rs"), F.col("_l").alias("_rl"))
    # A number of tasks, not of bytes: a few rows make many pairs, and partitions of little data would be put together.
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda t: t.repartition(tasks, *block, "_part")
    pairs = dealt(ones).join(sorted_join(dealt(twos)), [*block, "_part"]).filter("_r != _k").withColumn("_m", F.greatest("_l", "_rl"))
    return pairs.filter(F.least("_l", "_rl") >= F.col("_m") * ratio - 1e-6).filter(_alike(ratio)).select(F.col("_r").alias("a"), F.col("_k").alias("b"))


def _indexed(left: DataFrame, right: DataFrame, block: list[str], key: str, ratio: Column) -> DataFrame:
    """``similar_titles`` by pigeonhole. The longer title of a pair is indexed and the shorter one probes, so each side does
    both; one join serves both directions."""
    sides = left.withColumn("_left", F.lit(True)).unionByName(right.withColumn("_left", F.lit(False)))
    indexed = _segments(sides.withColumn("_m", F.col("_l")), ratio).select(
        *block, F.col(key).alias("_r"), F.col("_s").alias("_rs"), "_m", "_i", F.col("_left").alias("_of"), F.substring("_s", F.col("_p"), F.col("_w")).alias("_seg")
    )
    # Lengths of the longer partner: from its own up to length / ratio, as far as the other side has them.
    lengths = sides.select(*block, F.col("_l").alias("_m"), (~F.col("_left")).alias("_left")).distinct()
    options = F.sequence(F.col("_l"), F.greatest(F.col("_l"), F.floor(F.col("_l") / ratio + F.lit(1e-9)).cast("int")))
    placed = _segments(sides.withColumn("_m", F.explode(options)).join(sorted_join(lengths), [*block, "_m", "_left"], "left_semi"), ratio)
    shift = F.col("_l") - F.col("_m")
    behind = F.col("_d") + 1 - F.col("_i")
    low = F.greatest(F.lit(1), F.col("_p") - (F.col("_i") - 1), F.col("_p") + shift - behind)
    high = F.least(F.col("_l") - F.col("_w") + 1, F.col("_p") + (F.col("_i") - 1), F.col("_p") + shift + behind)
    starts = placed.withColumns({"_low": low, "_high": high}).filter("_low <= _high")
    probing = starts.withColumn("_at", F.explode(F.sequence("_low", "_high"))).select(
        *block, key, "_s", "_m", "_i", "_left", (~F.col("_left")).alias("_of"), F.substring("_s", F.col("_at"), F.col("_w")).alias("_seg")
    )
    pairs = probing.join(sorted_join(indexed), [*block, "_m", "_i", "_of", "_seg"]).filter(F.col(key) != F.col("_r")).filter(_alike(ratio))
    return pairs.select(F.when(F.col("_left"), F.col(key)).otherwise(F.col("_r")).alias("a"), F.when(F.col("_left"), F.col("_r")).otherwise(F.col(key)).alias("b"))


#: Titles of a block and day that are linked in the first round, and how that number grows.
HEADS, GROWTH = 128, 8


def event_groups(
    events: DataFrame, key: str = "record_id", strict: float = 0.82, same_place: float = 0.68, hours: int = 24
) -> DataFrame:
    """(key, leader, dedup_group_id) for every event."""
    reach = hours * 3_600_000_000
    if reach > DAY:
        raise ValueError("groups reach at most one day back")
    blank = lambda n: F.coalesce(F.col(n), F.lit(""))
    shaped = events.select(
        F.col(key).alias("id"), blank("city").alias("city"), blank("event_category").alias("category"),
        tx.comparable_title(blank("title")).alias("title"), blank("location_text").alias("place"),
        tm.epoch_micros(F.col("event_time_start")).alias("t"),
    ).withColumns({"g": F.md5(F.concat_ws("\x01", "city", "category", "title", "place")), "day": F.floor(F.col("t") / DAY)})
    shaped = cut_lineage(shaped)
    block = ["city", "category"]
    # Every title meets those of its block at the strict similarity and those of its place at the lower one.
    places = F.explode(F.array_distinct(F.array(F.lit(""), F.col("place"))))
    titles = cut_lineage(shaped.select("g", *block, "title", "place", "day").distinct().withColumn("_place", places))
    wanted = F.when(F.col("_place") == "", strict).otherwise(same_place)

    days = F.explode(F.array(F.col("day") - 1, F.col("day"), F.col("day") + 1))
    # Settled titles too: of two leaders that match an event the earlier one counts, whichever was found first.
    other = titles.withColumn("_near", days)

    def linked(heads: DataFrame) -> DataFrame:
        """(a, b): titles of ``heads`` with the titles they match, of the day and the days beside it."""
        first = titles.join(sorted_join(heads), ["g", "day"], "left_semi").withColumn("_near", F.col("day"))
        near = similar_titles(first, other, [*block, "_near", "_place"], "g", "title", wanted)
        own = heads.select(F.col("g").alias("a"), F.col("g").alias("b"))
        return near.unionByName(own).distinct()

    rows = shaped.select("id", "g", "t", "day")
    undecided, matches, leaders, links, known, size = rows, None, None, None, None, HEADS
    of_block = shaped.select("g", *block).distinct()
    while True:
        when = F.struct("t", "id")
        frontier = undecided.groupBy("g", "day").agg(F.min(when).alias("first"), F.max("t").alias("last"))
        frontier = cut_lineage(frontier)
        if frontier.isEmpty():
            break
        # The earliest open titles of each block and day take part; more in every round. Only they are linked.
        rank = F.row_number().over(Window.partitionBy(*block, "day").orderBy("first"))
        heads = frontier.join(sorted_join(of_block), "g").withColumn("_rank", rank).filter(F.col("_rank") <= size).select("g", "day", "first")
        heads, size = cut_lineage(heads), size * GROWTH
        # Stored, as the heads known so far are subtracted from them in every later round: plans grow by a table a round.
        new = cut_lineage(heads.select("g", "day") if known is None else heads.select("g", "day").join(sorted_join(known), ["g", "day"], "left_anti"))
        if known is None or not new.isEmpty():
            found_links = linked(new)
            links = cut_lineage(found_links) if links is None else links.unionByName(cut_lineage(found_links))
            known = new if known is None else known.unionByName(new)
        earlier = frontier.select(F.col("g").alias("b"), F.col("day").alias("_day"), F.col("first").alias("_first"), F.col("last").alias("_last"))
        around = heads.join(sorted_join(links), heads["g"] == links["a"]).withColumn(
            "_day", F.explode(F.array(F.col("day") - 1, F.col("day")))
        )
        blocks = F.when(F.col("_day") == F.col("day"), F.col("_first") < F.col("first")).otherwise(
            F.col("_last") >= F.col("first.t") - reach
        )
        blocked = around.join(sorted_join(earlier), ["b", "_day"]).filter(blocks).select("g", "day").distinct()
        found = cut_lineage(heads.join(sorted_join(blocked), ["g", "day"], "left_anti").select("g", "day", "first"))
        leaders = found if leaders is None else leaders.unionByName(found)
        targets = found.join(sorted_join(links), found["g"] == links["a"]).select(
            F.col("b").alias("g"), F.col("first").alias("_lead"), F.explode(F.array("day", F.col("day") + 1)).alias("day")
        )
        after = (F.struct("t", "id") > F.col("_lead")) & (F.col("t") <= F.col("_lead.t") + reach)
        hit = cut_lineage(rows.join(sorted_join(targets), ["g", "day"]).filter(after).select("id", "_lead"))
        matches = hit if matches is None else matches.unionByName(hit)
        settled = found.select(F.col("first.id").alias("id")).unionByName(hit.select("id")).distinct()
        undecided = cut_lineage(undecided.join(sorted_join(settled), "id", "left_anti"))
    best = matches.groupBy("id").agg(F.min("_lead").alias("_lead"))
    own = leaders.select(F.col("first.id").alias("id"), F.col("first").alias("_lead"))
    assigned = own.unionByName(best)
    titles = shaped.select(F.col("id").alias("_id"), "city", "category", "title", F.col("t").alias("_t"))
    label = F.concat_ws(
        "|", "city", "category", "title", F.date_format(F.timestamp_micros("_t"), "yyyy-MM-dd"), F.col("_lead.id").cast("string")
    )
    return assigned.join(sorted_join(titles), F.col("_lead.id") == F.col("_id")).select(
        F.col("id").alias(key), F.col("_lead.id").alias("leader"), F.sha1(label).alias("dedup_group_id")
    )
