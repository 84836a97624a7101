"""Mixing sources to target weights by entropy balancing.

Sources share all words by weight, no source beyond a multiple of its own size. Among all
rates that give each source its target, those nearest to 1 in relative entropy over the
words are r = exp(lambda of the source); lambda solves the convex dual

    minimise  sum_s  size_s exp(lambda_s) - target_s lambda_s

by Newton's steps. The dual needs of the documents only their total size per source, which
Spark reduces in each task before anything is shuffled. Rates are then rounded into whole
copies systematically: along the texts of a source from the longest down, the copies up to
each are the rounded sum of the rates, so words miss the target by half the longest text at
most, whatever the number of texts. What is missing is made up by copies of shorter texts.
All this looks at how many texts have each size; texts of one size share their copies in the
order of a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import enrich
from ..session import durable
from .shared import word_count, written

MOST_COPIES = 3
WEIGHTS = (1, 2, 3)
NEWTON_STEPS = 80
#: Bits of the hash and of the place that each pass leaves out, until it finds where the extra copies end.
PASSES = ((46, 63), (30, 63), (0, 63), (0, 33), (0, 0))


def _key(source: Column) -> Column:
    """A source as a join key that is never NULL."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def source_targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(key, source_size, target, rate) per source of (source, key, size).

    Weights repeat over the sources in code point order, NULL last. With level the words per
    weight, a target is the smaller of most * size and weight * level; the level that uses all
    words is the largest of those found by taking sources as full one after another. One row
    per source meets in the windows.
    """
    sums = sized.groupBy("source", "key").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ordered = sums.withColumn("place", place)
    ordered = ordered.withColumn("weight", F.element_at(cycle, F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1))
    ordered = ordered.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = F.coalesce(F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    whole = Window.partitionBy(F.lit(0))
    level = ordered.withColumn("level", (F.sum("source_size").over(whole) - before) / after)
    level = level.withColumn("target", F.least("cap", F.col("weight") * F.max("level").over(whole)))
    newton = F.expr(
        f"aggregate(sequence(1, {NEWTON_STEPS}), 0D, "
        "(l, k) -> l - (source_size * exp(l) - target) / (source_size * exp(l)))"
    )
    rate = F.when(F.col("source_size") > 0, F.least(F.exp(newton), F.lit(float(most)))).otherwise(F.lit(1.0))
    return durable(level.select("key", F.col("source_size").cast("long").alias("source_size"), "target", rate.alias("rate")))


def _copies_by_size(sized: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """(key, size, n, copies): how many copies the n texts of a size in a source get together.

    A source has no more sizes than its longest text has words, and the sizes that make up
    for what is missing are at most half as long, so windows and lists stay small.
    """
    counts = sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n"))
    longest_first = Window.partitionBy("key").orderBy(F.col("size").desc())
    upto = enrich(counts, targets.select("key", "target", "rate"), "key", "inner", hot_rows=None)
    upto = upto.withColumn("upto", F.sum("n").over(longest_first.rowsBetween(Window.unboundedPreceding, 0)))
    rounded = upto.withColumn("copies", F.expr("floor(rate * upto + 0.5D) - floor(rate * (upto - n) + 0.5D)"))
    rounded = durable(rounded.withColumn("copies", F.expr(f"least(copies, {most} * n)")).drop("upto"))
    gap = F.first("target") - F.sum(F.col("size") * F.col("copies"))
    gaps = durable(rounded.groupBy("key").agg(gap.alias("gap")))
    room = F.expr(f"IF(gap > 0, {most} * n - copies, copies)").alias("room")
    able = enrich(rounded, gaps, "key", "inner", hot_rows=None).select("key", "gap", "size", room)
    able = able.where("room > 0 AND size > 0 AND size <= abs(gap)")
    lists = able.groupBy("key").agg(
        F.first("gap").alias("gap"), F.sort_array(F.collect_list(F.struct("size", "room")), False).alias("sizes")
    )
    filled = F.expr(
        "aggregate(sizes, struct(abs(gap) AS gap, slice(sizes, 1, 0) AS used), (a, s) -> IF(s.size > a.gap, a, "
        "struct(a.gap - s.size * least(s.room, floor(a.gap / s.size)) AS gap, "
        "concat(a.used, array(struct(s.size AS size, least(s.room, floor(a.gap / s.size)) AS room))) AS used))).used"
    )
    sign = F.when(F.col("gap") > 0, 1).otherwise(-1)
    made_up = lists.select("key", sign.alias("sign"), F.explode(filled).alias("s"))
    made_up = durable(made_up.select("key", "s.size", (F.col("sign") * F.col("s.room")).alias("change")))
    whole = enrich(rounded, made_up, ["key", "size"], "left", hot_rows=None)
    return whole.select("key", "size", "n", (F.col("copies") + F.coalesce("change", F.lit(0))).cast("long").alias("copies"))


def _shares(sized: DataFrame, by_size: DataFrame) -> DataFrame:
    """(key, size, each, hash_to, place_to): each text's copies, and up to where one more is given.

    The remainder goes to the texts with the smallest hashes, rows alike in id and text by their
    place. Where it ends is found by counts of leading bits, of more bits at each pass, so no
    group is sorted or meets in a task; passes end when no group is open.
    """
    each = F.expr("copies div n").alias("each")
    by_size = durable(by_size.select("key", "size", each, (F.col("copies") % F.col("n")).alias("rest")))
    still = by_size.where("rest > 0").select("key", "size", F.lit(0).cast("long").alias("h0"), F.lit(0).cast("long").alias("p0"), "rest")
    ends, before = [], (62, 63)
    for bits in PASSES:
        cut = {f"{c}{k}": F.shiftright(name, b) for k, by in enumerate((before, bits)) for c, name, b in zip("hp", ("hash", "place"), by)}
        rows = sized.select("key", "size", *[v.alias(k) for k, v in cut.items()])
        counts = rows.groupBy("key", "size", *cut).agg(F.count(F.lit(1)).alias("n"))
        counts = enrich(counts, still, ["key", "size", "h0", "p0"], "inner", hot_rows=None)
        order = Window.partitionBy("key", "size").orderBy("h1", "p1").rowsBetween(Window.unboundedPreceding, 0)
        border = counts.withColumn("upto", F.sum("n").over(order)).where("rest > upto - n AND rest <= upto")
        border = durable(border.select("key", "size", "h1", "p1", "rest", "upto", "n"))
        last = [
            F.expr(f"shiftleft({c} + 1L, {b}) - 1L").alias(name) if b < 63 else F.lit((1 << 63) - 1).alias(name)
            for c, b, name in (("h1", bits[0], "hash_to"), ("p1", bits[1], "place_to"))
        ]
        ends.append(border.where("rest = upto").select("key", "size", *last))
        still = border.where("rest < upto").select(
            "key", "size", F.col("h1").alias("h0"), F.col("p1").alias("p0"), F.expr("rest - (upto - n)").alias("rest")
        )
        before = bits
        if still.isEmpty():
            break
    found = ends[0]
    for more in ends[1:]:
        found = found.unionByName(more)
    return durable(enrich(by_size.drop("rest"), durable(found), ["key", "size"], "left", hot_rows=None))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    source = F.col(source_col).cast("string")
    text = F.col(text_col).cast("string")
    doc_id = F.col(id_col).cast("long")
    return docs.select(
        "*",
        doc_id.alias("_id"),
        source.alias("_source"),
        _key(source).alias("key"),
        word_count(text).alias("size"),
        F.shiftrightunsigned(F.xxhash64(F.lit(10), doc_id, text), 2).alias("hash"),
        F.monotonically_increasing_id().alias("place"),
    )


def _with_copies(sized: DataFrame, most: int, weights) -> DataFrame:
    """Add source_size, target, rate and copies to a table that was written with its places."""
    narrow = sized.select("key", "size", "hash", "place")
    targets = source_targets(sized.select(F.col("_source").alias("source"), "key", "size"), weights, most)
    shares = _shares(narrow, _copies_by_size(narrow, targets, most))
    told = enrich(sized, shares, ["key", "size"], "inner", spread_by=["place"])
    told = enrich(told, targets, "key", "inner", spread_by=["place"])
    more = "hash < hash_to OR (hash = hash_to AND place <= place_to)"
    return told.withColumn("copies", F.expr(f"cast(each + IF({more}, 1, 0) AS int)")).drop("each", "hash_to", "place_to")


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    most: int = MOST_COPIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How often the mix takes each document, one row per input row.

    Returns doc_id, source, size (words: runs of characters other than space and \\t to \\r),
    source_size, target (of its source), rate, copies (0 to ``most``), taken (copies * size).

    A NULL text has size 0, a NULL source is the last source. A source without words has
    target 0 and keeps each row once. Rows without an id and rows that repeat are rows like
    others: they share the copies of their size one by one. Other columns are ignored; an empty
    table gives an empty result. The same rows give the same mix, in whatever order or files
    they come; rows alike in id and text are told apart by their place only.
    """
    sized = _sized(docs.select(id_col, text_col, source_col), id_col, text_col, source_col)
    sized = durable(sized.drop(id_col, text_col, source_col))
    return _with_copies(sized, most, weights).select(
        F.col("_id").alias("doc_id"),
        F.col("_source").alias("source"),
        "size",
        "source_size",
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``docs`` (doc_id, text, source and any others) with each row as often as the mix takes it.

    The rows are written once with their sizes, hashes and places; texts then stay where they
    are unless the table of sizes is too large to broadcast.
    """
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = kept.select("_row", F.col("_row.doc_id").alias("_doc"), F.col("_row.text").alias("_text"), F.col("_row.source").alias("_from"))
    sized = _sized(rows, "_doc", "_text", "_from").drop("_doc", "_text", "_from")
    counted = _with_copies(written(sized, "mix"), most, weights)
    return counted.withColumn("_copy", F.explode(F.expr("array_repeat(0, copies)"))).select("_row.*")
