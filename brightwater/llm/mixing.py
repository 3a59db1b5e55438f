"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brightwater.session import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
BLOCK_WORDS = 256
DOCS_PER_BUCKET = 256
SLOTS_PER_SPAN = 1024
GROUP = 4096
CELLS = 4096
# The golden ratio's fraction in units of 2**-40: exact for up to 2**40 points.
GOLDEN = 679535556991


def word_count(text: Column) -> Column:
    """Words of a whole text; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size, target``: shares of all words by repeating weights, capped at ``epochs`` times the source.

    Sources take the weights in code point order, null last. Filling by
    weight while capped sources drop out has one fixed point: with sources
    ordered by cap over weight, the level at which the rest shares what the caps before
    it leave. It needs one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = sources.withColumn("w", F.element_at(table, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("cap", (F.col("source_size") * epochs).cast("double"))
    ranked = Window.orderBy((F.col("cap") / F.col("w")), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    left = weighed.withColumns(
        {
            "goal": F.sum("source_size").over(whole) * share,
            "caps_before": F.coalesce(F.sum("cap").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "w_left": F.sum("w").over(ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    level = (F.col("goal") - F.col("caps_before")) / F.col("w_left")
    leveled = left.withColumn("level", F.max(F.when(F.col("cap") >= level * F.col("w"), level)).over(whole))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap")))
    return leveled.select("source", "source_size", target.alias("target"))


def _offsets(counts: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """``key, order, offset``: the key's sum of values before each row, in two levels so that no task has a key's all rows."""
    grouped = counts.withColumn("far", F.floor(F.col(order) / GROUP))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    far = grouped.groupBy(key, "far").agg(F.sum(value).alias("far_sum"))
    far = far.withColumn("far_offset", F.coalesce(F.sum("far_sum").over(before(key).orderBy("far")), F.lit(0)))
    far = far.select(F.col(key).alias("far_key"), F.col("far").alias("far_no"), "far_offset")
    near = grouped.withColumn("near_offset", F.coalesce(F.sum(value).over(before(key, "far").orderBy(order)), F.lit(0)))
    joined = near.join(far, F.col(key).eqNullSafe(F.col("far_key")) & (F.col("far") == F.col("far_no")))
    return joined.select(key, order, value, (F.col("far_offset") + F.col("near_offset")).alias("offset"))


def _stream(sizes: DataFrame, buckets: int) -> DataFrame:
    """Each document's first word (``start``) in its source's shuffled stream.

    The shuffle orders documents by the MD5 of their id. Positions are sums
    within buckets of that hash plus the sums of the buckets before, so that no source is
    one task's work.
    """
    hashed = sizes.withColumn("h", F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))))
    hashed = hashed.withColumn("bucket", (F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("long"))
    within = Window.partitionBy("source", "bucket").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    totals = hashed.groupBy("source", "bucket").agg(F.sum("size").alias("total"))
    offsets = written(_offsets(totals, "source", "bucket", "total"), "offsets")
    local = hashed.withColumn("local", F.coalesce(F.sum("size").over(within), F.lit(0)))
    o = offsets.select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"), "offset")
    joined = local.join(o, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
    return joined.select("id", "source", "size", (F.col("offset") + F.col("local")).alias("start"))


def _slots(sources: DataFrame, total: int, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``position, source_no, slot``: which source each block of the mix comes from, and its rank among that source's.

    Point i is the fraction of i times the golden ratio; its place among the
    sources' cumulative shares names the source, so any stretch of the mix holds every
    source near its share. Ranks are counted within spans of positions, plus the counts of the
    spans before. A source that falls a few slots short of its target gets them at the end.
    """
    spark = sources.sparkSession
    # The product modulo 2**40 by halves of 20 bits, which do not overflow.
    low, high, half, all_bits = "(id & 1048575)", "(id >> 20)", (1 << 20) - 1, (1 << 40) - 1
    point = F.expr(f"((({low} * {GOLDEN}L) & {all_bits}L) + ((({high} * {GOLDEN}L) & {half}L) << 20)) & {all_bits}L")
    points = spark.range(0, total, 1, max(spark.sparkContext.defaultParallelism, total // 500_000))
    points = points.select(F.col("id").alias("position"), (point / F.lit(float(1 << 40))).alias("u"), F.floor(F.col("id") / SLOTS_PER_SPAN).alias("span"))
    edges = sources.select("source_no", "lo", "hi").where("hi > lo")
    # A cell of the unit interval names the few sources that it touches.
    edges = edges.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))))
    drawn = points.withColumn("cell", F.floor(F.col("u") * CELLS)).join(small(edges), "cell")
    drawn = drawn.where("u >= lo AND u < hi").select("position", "span", "source_no")
    counts = drawn.groupBy("source_no", "span").agg(F.count("*").alias("n"))
    offsets = written(_offsets(counts, "source_no", "span", "n"), "slot-offsets")
    rank = F.row_number().over(Window.partitionBy("source_no", "span").orderBy("position"))
    ranked = drawn.withColumn("rank", rank).join(offsets.drop("n"), ["source_no", "span"])
    given = ranked.select("position", "source_no", (F.col("offset") + F.col("rank") - 1).alias("slot"))
    have = offsets.groupBy("source_no").agg(F.sum("n").alias("have"))
    short = sources.join(have, "source_no", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < slots")
    extra = short.select("source_no", F.explode(F.sequence(F.col("have"), F.col("slots") - 1)).alias("slot"))
    return given.unionByName(extra.select((F.lit(total) + F.col("slot")).alias("position"), "source_no", "slot"))


def mix(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    block_words: int = BLOCK_WORDS,
    broadcast_sources: int = 10_000,
) -> tuple[DataFrame, DataFrame]:
    """The mix's schedule and what it takes of each document.

    ``plan`` has one row for each piece of a document in a block of the mix: ``position`` (the
    block's place), ``id, source, size, epoch, first_word, words``. ``taken`` has one row per
    document: ``id, source, size, source_size, target, taken``.

    Each source is a stream of its documents, shuffled by a hash of their
    ids and cut into blocks of ``block_words`` words. The schedule's slots take a source's
    blocks in order, again from the start when they are used up, until its target; the last
    block is cut there, so a source's words are its target rounded down, and no document is
    taken more than ``epochs`` times. Reruns agree: nothing depends on partitions.

    Documents are told apart by id and source; rows that repeat both are one document with the sum
    of their words (null ids too). A null text has no words. A source without words has
    target 0. Up to ``broadcast_sources`` sources their table is broadcast; beyond, the same
    joins shuffle. An empty table gives no rows. Only the three columns are read.
    """
    rows = documents.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    sizes = written(rows.groupBy("id", "source").agg(F.sum("size").alias("size")), "sizes")
    targets = source_targets(sizes, weights, share, epochs)
    blocks = F.ceil(F.col("source_size") / block_words)
    goal = F.floor("target")
    turns = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0)
    rest = goal - turns * F.col("source_size")
    planned = targets.withColumns({"blocks": blocks, "goal": goal, "slots": turns * blocks + F.ceil(rest / block_words)})
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    planned = planned.withColumns({"source_no": F.row_number().over(by_name), "hi": F.sum("slots").over(by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    total = F.greatest(F.sum("slots").over(Window.partitionBy()), F.lit(1))
    planned = planned.withColumns({"lo": (F.col("hi") - F.col("slots")) / total, "hi": F.when(F.col("hi") == total, 1.0).otherwise(F.col("hi") / total)})
    sources = written(planned, "sources")
    facts = sources.agg(F.count("*").alias("n"), F.sum("slots").alias("slots")).first()
    small = F.broadcast if facts["n"] <= broadcast_sources else lambda frame: frame
    buckets = max(1, sizes.count() // DOCS_PER_BUCKET)
    s = sources.select(F.col("source").alias("s_source"), "source_no", "source_size", "target", "goal", F.col("blocks").alias("n_blocks"))
    placed = _stream(sizes, buckets).join(small(s), F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
    placed = written(placed, "placed")
    spans = placed.where("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)))
    )
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = spans.select("id", "source", "source_no", "size", "start", "block", "goal", "source_size", low.alias("low"), high.alias("high"))
    sized = sources.select("source_no", F.col("blocks").alias("in_source"), "slots")
    slots = _slots(sources, int(facts["slots"] or 0), small).join(small(sized), "source_no").where("slot < slots")
    slots = slots.select("position", "source_no", F.floor(F.col("slot") / F.col("in_source")).alias("epoch"), (F.col("slot") % F.col("in_source")).alias("block"))
    met = pieces.join(slots, ["source_no", "block"])
    words = F.least(F.col("high"), F.col("goal") - F.col("epoch") * F.col("source_size")) - F.col("low")
    plan = met.withColumn("words", words).where("words > 0")
    plan = plan.select("position", "id", "source", "size", "epoch", (F.col("low") - F.col("start")).alias("first_word"), "words")
    took = plan.groupBy(F.col("id").alias("t_id"), F.col("source").alias("t_source")).agg(F.sum("words").alias("taken"))
    same = F.col("id").eqNullSafe(F.col("t_id")) & F.col("source").eqNullSafe(F.col("t_source"))
    taken = placed.join(took, same, "left").select(
        "id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
    return plan, taken


def mixed_documents(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", whole: bool = False, **options
) -> DataFrame:
    """The documents as the mix takes them, with their own columns, in the order of the schedule.

    A document comes once for each epoch that takes all of it, at the position of its first block;
    documents of one block follow its source's shuffled stream. Where its
    source's target ends inside a document, a copy has its text up to the last word taken, and
    ``n_chars``, if there is one, says its length. With ``whole`` that copy is all of its text where the
    target takes half of it or more, and none where it takes less, so a source misses its target by half a
    document at most. Documents not taken and
    those without words do not come. Of rows that repeat an id and a source one stands for all.
    """
    plan, _ = mix(documents, id_col, text_col, source_col, **options)
    t = plan.groupBy(F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "epoch").agg(
        F.min("position").alias("_position"), F.sum("words").alias("_words")
    ).drop("epoch")
    if whole:
        t = t.where("2 * _words >= _size").withColumn("_words", F.col("_size"))
    same = F.col(id_col).eqNullSafe(F.col("_id")) & F.col(source_col).eqNullSafe(F.col("_source"))
    rows = documents.join(t, same)
    if not whole:
        ends = F.split(text_col, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
        cut = F.array_join(F.slice(ends, F.lit(1), F.col("_words").cast("int")), "")
        rows = rows.withColumn(text_col, F.when(F.col("_words") < F.col("_size"), cut).otherwise(F.col(text_col)))
        if "n_chars" in documents.columns:
            full = F.col("_words") == F.col("_size")
            rows = rows.withColumn("n_chars", F.when(full, F.col("n_chars")).otherwise(F.char_length(text_col).cast(documents.schema["n_chars"].dataType)))
    stream = F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")))
    return rows.orderBy("_position", stream, "_id").select(*documents.columns)
