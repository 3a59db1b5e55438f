"""Line dedup: a suffix array over the corpus's line names by prefix doubling, and the repeated runs it shows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brightwater.session import written


def _line_names(lines: Column) -> Column:
    """A 128-bit name for each line."""
    return F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(x, F.lit(1)).alias("b")))


def _joined(names: Column, shift: int) -> Column:
    """Names of the prefixes made of two of these, the second ``shift`` lines on; as many as fit."""
    fit = F.greatest(F.size(names) - shift, F.lit(0))
    return F.zip_with(
        F.slice(names, F.lit(1), fit),
        F.slice(names, F.lit(shift + 1), fit),
        lambda x, y: F.struct(F.xxhash64(x["a"], y["a"]).alias("a"), F.xxhash64(x["b"], y["b"], F.lit(1)).alias("b")),
    )


def _windows(documents: DataFrame, run: int) -> DataFrame:
    """Adds ``lines`` and ``names``, one name for each window of ``run`` lines.

    Names double in reach, 1, 2, 4, ... lines; the last step lets two overlap so that they reach ``run``. A text
    with fewer lines is filled up with end marks, so that it equals whole texts only.
    """
    frame = documents.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    frame = frame.withColumn("lines", F.when(F.col("text").isNull(), F.slice("lines", 1, 0)).otherwise(F.col("lines")))
    mark = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    missing = F.when(F.size("lines") == 0, 0).otherwise(F.greatest(run - F.size("lines"), F.lit(0)))
    frame = frame.withColumn("names", F.concat(_line_names(F.col("lines")), F.array_repeat(mark, missing)))
    reach = 1
    while reach < run:
        step = min(reach, run - reach)
        frame = frame.withColumn("names", _joined(F.col("names"), step))
        reach += step
    return frame


def _keyed(documents: DataFrame) -> DataFrame:
    """Adds ``ka, kb``, a 128-bit key of a row's id and text, which only rows equal in both share."""
    return documents.withColumns({"ka": F.xxhash64("id", "text"), "kb": F.xxhash64("text", F.lit(1), "id")})


def suffixes(documents: DataFrame, run: int) -> DataFrame:
    """``place, line, left, id, ka, kb, a, b``: the corpus as one sequence of windows.

    ``place`` numbers all windows in the order of id (null first), key and line, and a text's are consecutive;
    ``left`` windows stand from here to the text's end, ``(a, b)`` names this one. Rows equal in id and text are
    one. Written before use, as the numbers come from the sorted partitions.
    """
    rows = _keyed(_windows(documents, run)).select("ka", "kb", "id", "names")
    single = rows.groupBy("ka", "kb").agg(F.first("id").alias("id"), F.first("names").alias("names")).orderBy("id", "ka", "kb")
    found = single.select("id", "ka", "kb", F.size("names").alias("n"), F.posexplode("names").alias("line", "name"))
    return found.select(
        F.monotonically_increasing_id().alias("place"), "line", (F.col("n") - F.col("line")).alias("left"), "id", "ka", "kb", "name.a", "name.b"
    )


def _ranked(windows: DataFrame, names: list[str]) -> DataFrame:
    """Suffixes whose name stands more than once; ``rank`` is the first place of the name.

    The first place is a combined minimum that the suffixes meet in a join that can be split, so a name that a third of
    them bear is no one task's work.
    """
    first = windows.groupBy(*names).agg(F.min("place").alias("rank_"), F.max("place").alias("last")).where("rank_ < last").drop("last")
    return windows.join(first, names).select("place", "line", "left", F.col("rank_").alias("rank"))


def doubled_ranks(sequence: DataFrame) -> list[DataFrame]:
    """Tables ``place, line, left, rank`` for prefixes of 1, 2, 4, ... windows, until no prefix repeats.

    A rank is doubled by joining it with the rank as many windows on in the same text; a suffix that stands alone at
    one length stands alone at all greater ones and is left out. So a table has the suffixes that share
    a prefix of its length with another, and equal ranks are its intervals of the suffix array.
    """
    levels = []
    ranked = written(_ranked(sequence, ["a", "b"]), "ranks")
    while not ranked.isEmpty():
        levels.append(ranked)
        reach = 1 << (len(levels) - 1)
        onward = ranked.select((F.col("place") - reach).alias("place"), F.col("rank").alias("next"))
        pairs = written(ranked.where(F.col("left") > reach).join(onward, "place"), "pairs")
        ranked = written(_ranked(pairs, ["rank", "next"]), "ranks")
    return levels


def earlier_runs(levels: list[DataFrame]) -> DataFrame:
    """``place, line, source, common``: suffixes with an earlier copy, and their common prefix with it in windows.

    ``source`` is the first place of the suffix's longest doubled prefix that stands earlier. The rest of the common
    prefix is below that length, so it is found by comparing the ranks of both at each shorter length once, longest
    first. A suffix whose predecessor's source is the predecessor of its own is part of that one's run and not returned.
    """
    later = [level.where("rank < place").withColumn("reach", F.lit(1 << i)) for i, level in enumerate(levels)]
    longest = reduce(DataFrame.unionByName, later).groupBy("place", "line", "left").agg(
        F.max("reach").alias("reach"), F.max_by("rank", "reach").alias("source")
    )
    sources = levels[0].select(F.col("place").alias("source"), F.col("line").alias("source_line"), F.col("left").alias("source_left"))
    longest = written(longest.join(sources, "source"), "longest")
    before = longest.select((F.col("place") + 1).alias("p"), (F.col("source") + 1).alias("s"))
    goes_on = (F.col("place") == F.col("p")) & (F.col("source") == F.col("s")) & (F.col("line") > 0) & (F.col("source_line") > 0)
    runs = longest.join(before, goes_on, "left_anti").withColumn("common", F.col("reach"))
    for i in reversed(range(len(levels) - 1)):
        step = 1 << i
        mine = levels[i].select(F.col("place").alias("p"), F.col("rank").alias("mine"))
        theirs = levels[i].select(F.col("place").alias("q"), F.col("rank").alias("theirs"))
        runs = runs.join(mine, F.col("place") + F.col("common") == F.col("p"), "left")
        runs = runs.join(theirs, F.col("source") + F.col("common") == F.col("q"), "left")
        within = (F.col("reach") > step) & (F.col("left") > F.col("common")) & (F.col("source_left") > F.col("common"))
        same = within & F.coalesce(F.col("mine") == F.col("theirs"), F.lit(False))
        runs = runs.withColumn("common", F.col("common") + F.when(same, step).otherwise(0)).drop("p", "q", "mine", "theirs")
    return runs.select("place", "line", "source", "common")


def _runs(sequence: DataFrame, run: int) -> DataFrame | None:
    """``ka, kb, id, line, end, source, covered``: maximal runs, lines from ``line`` up to ``end``; ``None`` if there is none.

    Those that lie in another one of their text are left out. The runs of the text
    further up reach ``covered`` (null for the first).
    """
    levels = doubled_ranks(sequence)
    if not levels:
        return None
    starts = sequence.where("line = 0").select(F.col("place").alias("start"), "ka", "kb", "id")
    found = earlier_runs(levels).withColumn("start", F.col("place") - F.col("line")).join(starts, "start")
    up = Window.partitionBy("ka", "kb").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    ended = found.withColumn("end", F.col("line") + F.col("common") + (run - 1))
    return ended.withColumn("covered", F.max("end").over(up)).where("covered IS NULL OR end > covered").select(
        "ka", "kb", "id", "line", "end", "source", "covered"
    )


def repeated_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 3) -> DataFrame:
    """Maximal runs of lines that stand earlier: ``id, first_line, n_lines, from_id, from_line``.

    A run has ``run`` lines or more or is a whole text; no run of a text lies inside another. Rows equal in id and text
    are one row here.
    """
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sequence = written(suffixes(rows, run), "suffixes")
    found = _runs(sequence, run)
    if found is None:
        return sequence.limit(0).select("id", F.col("line").alias("first_line"), F.col("left").alias("n_lines"), F.col("id").alias("from_id"), F.col("line").alias("from_line"))
    sizes = _keyed(_windows(rows, run)).select("ka", "kb", F.size("lines").alias("size")).distinct()
    origin = sequence.select(F.col("place").alias("source"), F.col("id").alias("from_id"), F.col("line").alias("from_line"))
    return found.join(origin, "source").join(sizes, ["ka", "kb"]).select(
        "id", F.col("line").alias("first_line"), (F.least("end", "size") - F.col("line")).alias("n_lines"), "from_id", "from_line"
    )


def drop_repeated_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 3) -> DataFrame:
    """Texts without the later copies of repeated runs of ``run`` lines or more, or of whole shorter texts.

    One row per input row: ``id_col, text_col, n_lines, n_removed``. Lines end at
    ``\\n``; blank ones count. A line goes if a run of ``run`` lines that holds it stands
    earlier: in a smaller id, or further up in the same text. A text with fewer lines goes if an
    earlier text equals it. Runs are judged on the input. A null text has no lines and becomes empty. A null id is the
    smallest; rows that share an id stand in the order of a hash of their texts, and of rows equal in both one stands
    before the others. Other columns are not read; an empty table gives no rows.
    """
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sequence = written(suffixes(rows, run), "suffixes")
    found = _runs(sequence, run)
    single = _keyed(rows).groupBy("ka", "kb").agg(F.first("id").alias("id"), F.first("text").alias("text"), F.count("*").alias("copies"))
    if found is None:
        met = single.withColumn("cuts", F.lit(None).cast("array<struct<line:int,end:int>>"))
    else:
        first = F.greatest("line", F.coalesce("covered", F.lit(0))).cast("int").alias("line")
        cuts = found.select("ka", "kb", F.struct(first, F.col("end").cast("int").alias("end")).alias("cut"))
        met = single.join(cuts.groupBy("ka", "kb").agg(F.collect_list("cut").alias("cuts")), ["ka", "kb"], "left")
    split = F.when(F.col("text").isNotNull(), F.split("text", "\n", -1)).otherwise(F.array().cast("array<string>"))
    named = met.withColumn("lines", split)
    places = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)).otherwise(F.array().cast("array<int>"))
    gone = F.flatten(F.transform("cuts", lambda c: F.sequence(c["line"], F.least(c["end"], F.size("lines")) - 1)))
    kept = named.withColumn("kept", F.when(F.col("cuts").isNull(), places).otherwise(F.array_except(places, gone)))
    left = F.when(F.size("kept") == F.size("lines"), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n"))
    counted = kept.select("id", left.alias("left_text"), F.size("lines").cast("long").alias("n_lines"), F.size("kept").cast("long").alias("n_kept"), "copies")
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select(
        F.col("id").alias(id_col),
        F.when(F.col("copy") == 1, F.col("left_text")).otherwise("").alias(text_col),
        "n_lines",
        (F.col("n_lines") - F.when(F.col("copy") == 1, F.col("n_kept")).otherwise(0)).alias("n_removed"),
    )
