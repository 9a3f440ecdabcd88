"""Mixing sources to target weights, from DataFrame functions alone.

The words of a source, its documents one after another in a pseudorandom order, are cut into blocks of fixed length. A mix
is a row of slots, each filled by a block. Each source has as many slots as its target asks for. The source counts of each
output shard are a multinomial draw, keyed by the shard, in proportion to the slots of the sources; a last step settles
what draws and targets differ by. Within a source, slot k of epoch e takes the block at place k of a permutation keyed by
(source, e), so no block comes twice before all came once. Slots and documents meet on (source, block).

The position of a document in its source is a sum over buckets plus a sum within its bucket, so a source with a third of
all rows is no group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volframe.llm.common import WORD, stage, text_of

WEIGHTS = (5.0, 2.0, 1.0)
ROUNDS = 20


def permuted(place: Column, n: Column, *keys: Column) -> Column:
    """Pseudorandom permutation of 0..n-1 by swap-or-not rounds (Hoang, Morris and Rogaway, 2012), keyed by the seeds."""

    def turn(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(r, *keys), n) - x, n)
        return F.when(F.pmod(F.xxhash64(r, F.greatest(x, other), *keys), F.lit(2)) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), place.cast("long"), turn)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = 3.0) -> DataFrame:
    """sizes(source, source_size): adds weight and target.

    Sources in code point order, null last, weigh as `weights` repeats. They share `share` of all words by weight; a
    target stops at `most` times the source's size, and the excess goes to the others by weight until none is above. With
    sources ordered by cap / weight, those that stop are a first part of the order, so one pass of running sums finds it.
    One row per source is handled in one task here: sources name corpora, of which a million would still fit.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("level", level).withColumn("stops", F.col("cap") <= F.col("level") * F.col("weight"))
    # the level that holds is that of the first source that doesn't stop
    final = F.min(F.when(~F.col("stops"), F.struct((F.col("cap") / F.col("weight")).alias("at"), F.col("rank"), F.col("level")))).over(everything)["level"]
    ranked = ranked.withColumn("final", final)
    target = F.when(F.col("final").isNull() | (F.col("cap") <= F.col("final") * F.col("weight")), F.col("cap")).otherwise(F.col("final") * F.col("weight"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def _so_far(rows: DataFrame, key: str, at: str, n: str, run: int = 1024) -> DataFrame:
    """rows(key, at, n) with `base`, the sum of n over smaller `at` of the key: sums of runs first, then within each run."""
    rows = rows.withColumn("run", F.expr(f"{at} div {run}"))
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy(key, "run").agg(F.sum(n).alias("_n"))
    runs = runs.select(key, "run", F.coalesce(F.sum("_n").over(before(key, "run")), F.lit(0)).alias("_above"))
    inside = F.coalesce(F.sum(n).over(before(key, "run", at)), F.lit(0))
    return rows.withColumn("_inside", inside).join(runs.hint("merge"), [key, "run"]).withColumn("base", F.col("_above") + F.col("_inside")).drop("run", "_above", "_inside")


def shard_counts(plan: DataFrame, total: int, shard_blocks: int, seed: int) -> DataFrame:
    """src, shard, n: multinomial draws of shard_blocks sources for each shard (the last shard has what is left of total).

    plan(src, first, slots): the places first..first + slots - 1 of 0..total - 1 are the source's. Each draw is a hash of
    its number modulo total, so a source is drawn in proportion to its slots. A draw finds its source within one of some
    ten thousand ranges of places, which sources are cut into.
    """
    width = max(1024, -(-total // 65_536))
    ranges = plan.select("src", "first", "slots", F.explode(F.sequence(F.expr(f"first div {width}"), F.expr(f"(first + slots - 1) div {width}"))).alias("range"))
    drawn = plan.sparkSession.range(total).select(F.expr(f"id div {shard_blocks}").alias("shard"), F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), F.lit(total)).alias("place"))
    drawn = drawn.withColumn("range", F.expr(f"place div {width}")).join(ranges, "range").where("place >= first and place < first + slots")
    return drawn.groupBy("src", "shard").agg(F.count("*").alias("n"))


def draws(goals: DataFrame, block_words: int, shard_blocks: int, seed: int) -> DataFrame:
    """goals(source, source_size, target): one row per slot with source, epoch, block, words taken from its start, shard.

    The slots of a source go to the shards in the order of its draws. What a source was drawn too often is left out, and
    what it was drawn too seldom (both about the root of its slots) fills shards of its own after the others, so that each
    source takes its target.
    """
    plan = goals.where("source_size > 0 and target > 0").select("source", "source_size", F.round("target").cast("long").alias("want"))
    plan = plan.withColumn("src", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    plan = plan.withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long")).withColumn("epochs", F.expr("want div source_size"))
    plan = plan.withColumn("rest", F.col("want") - F.col("epochs") * F.col("source_size"))
    # the last, partial epoch: so many blocks that their words reach the rest; the last of them gives what is missing
    plan = plan.withColumn("slots", F.col("epochs") * F.col("blocks") + F.when(F.col("rest") > 0, F.least(F.col("blocks"), F.ceil(F.col("rest") / block_words).cast("long") + 1)).otherwise(0)).where("slots > 0")
    before = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)  # a row for each source
    plan = stage(plan.withColumn("first", F.coalesce(F.sum("slots").over(before), F.lit(0))), "op10-plan")
    total = plan.agg(F.sum("slots")).first()[0] or 0
    counts = stage(shard_counts(plan, total, shard_blocks, seed), "op10-counts")
    dealt = _so_far(counts, "src", "shard", "n").join(plan.select("src", "slots"), "src")
    dealt = dealt.select("src", "shard", F.col("base").alias("lo"), F.least(F.col("base") + F.col("n"), "slots").alias("hi"))
    short = plan.join(counts.groupBy("src").agg(F.sum("n").alias("got")), "src", "left").select("src", F.coalesce("got", F.lit(0)).alias("lo"), F.col("slots").alias("hi")).where("lo < hi")
    short = short.withColumn("at", F.coalesce(F.sum(F.col("hi") - F.col("lo")).over(before), F.lit(0)))
    short = short.withColumn("slot", F.explode(F.sequence("lo", F.col("hi") - 1)))
    short = short.select("src", (F.expr(f"(at + slot - lo) div {shard_blocks}") + -(-total // shard_blocks)).alias("shard"), "slot")
    parts = int(goals.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a fixed number: AQE would put the few small rows, which explode here, into one task
    slots = dealt.where("lo < hi").repartition(parts, "src", "shard").select("src", "shard", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("slot")).unionByName(short).join(plan, "src")
    k = F.lit(seed)
    slots = slots.withColumn("epoch", F.expr("slot div blocks")).withColumn("place", F.col("slot") % F.col("blocks"))
    slots = slots.withColumn("block", permuted(F.col("place"), F.col("blocks"), k, F.col("source"), F.col("epoch")))
    size = F.least(F.lit(block_words), F.col("source_size") - F.col("block") * block_words)
    # only one block of a source is short; before the slot, the partial epoch took place * block_words or that much less
    lack = F.col("blocks") * block_words - F.col("source_size")
    last = permuted_place_of_last(k)
    taken = F.col("place") * block_words - F.when(last < F.col("place"), lack).otherwise(0)
    take = F.when(F.col("epoch") < F.col("epochs"), size).otherwise(F.greatest(F.lit(0), F.least(size, F.col("rest") - taken)))
    return slots.withColumn("take", take.cast("long")).where("take > 0").select("source", "epoch", "block", "take", "shard")


def permuted_place_of_last(k: Column) -> Column:
    """The place at which a source's last, shorter block comes: the rounds of permuted() undone in reverse order."""
    n, keys = F.col("blocks"), (k, F.col("source"), F.col("epoch"))

    def turn(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(r, *keys), n) - x, n)
        return F.when(F.pmod(F.xxhash64(r, F.greatest(x, other), *keys), F.lit(2)) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)), n - 1, turn)


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, key (of the row), size in words. Columns are taken by name; a null text has no words."""
    text = text_of(text_col)
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(F.col(id_col), text).alias("key"), words.alias("size"))


def placed(docs: DataFrame, goals: DataFrame, buckets: int, seed: int) -> DataFrame:
    """docs(doc_id, source, key, size) with `start`, the number of the source's words before the document."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(buckets)).cast("int")
    docs = docs.withColumn("bucket", bucket).withColumn("src", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    sums = _so_far(docs.groupBy("src", "bucket").agg(F.sum("size").alias("words")), "src", "bucket", "words").select("src", "bucket", "base")
    inside = F.coalesce(F.sum("size").over(Window.partitionBy("src", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return docs.withColumn("inside", inside).join(sums.hint("merge"), ["src", "bucket"]).withColumn("start", F.col("base") + F.col("inside")).drop("bucket", "base", "inside")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = 3.0, block_words: int = 256, shard_blocks: int = 4096, rows_per_bucket: int = 500, seed: int = 11, **cols) -> tuple[DataFrame, DataFrame]:
    """(documents, slots). documents: doc_id, source, key, size, source_size, target, start, pieces, taken.

    pieces are the parts of the document that the mix takes, as (shard, epoch, from, to) in words, in no order; taken is
    their sum. Each source's taken words are its rounded target exactly, and no document is taken more than `most` times.
    Documents without words, and sources of such, take part with 0. A null source is a source of its own, last in order;
    a null id is as any other; rows that repeat id, source and text are separate documents. Reruns on the same rows agree
    whatever the partitioning. An empty table gives empty results; other columns are not read.
    """
    base = stage(sized(docs, **cols), "op10-sizes")
    sizes = stage(base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")), "op10-sources")
    goals = stage(targets(sizes.drop("rows"), weights, share, most), "op10-targets")
    n = sizes.agg(F.sum("rows")).first()[0] or 0
    located = placed(base, goals, max(1, int(n // rows_per_bucket)), seed)
    goals = goals.withColumn("src", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    slots = draws(goals, block_words, shard_blocks, seed).withColumn("src", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    drawn = slots.groupBy("src", "block").agg(F.collect_list(F.struct("shard", "epoch", "take")).alias("draws"))  # at most `most` rounded up
    parts = located.withColumn("row", F.struct("key", "doc_id", "start")).withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"greatest(start, start + size - 1) div {block_words}"))))
    parts = parts.where("size > 0").join(drawn.hint("merge"), ["src", "block"])
    left, right = F.greatest(F.col("start"), F.col("block") * block_words), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    one = lambda d: F.struct(d.shard.alias("shard"), d.epoch.alias("epoch"), (left - F.col("start")).alias("from"), (F.least(right, F.col("block") * block_words + d.take) - F.col("start")).alias("to"))
    got = F.filter(F.transform("draws", one), lambda x: x["to"] > x["from"])
    pieces = parts.select("src", "row", got.alias("got")).groupBy("src", "row").agg(F.flatten(F.collect_list("got")).alias("pieces"))
    located = located.withColumn("row", F.struct("key", "doc_id", "start"))
    out = located.join(pieces.hint("merge"), ["src", "row"], "left").join(goals.select("src", "source_size", "target"), "src")
    pieces = F.when(F.col("size") > 0, F.col("pieces"))
    taken = F.aggregate(F.coalesce(pieces, F.array().cast("array<struct<shard:bigint,epoch:bigint,from:bigint,to:bigint>>")), F.lit(0).cast("long"), lambda s, p: s + p["to"] - p["from"])
    return out.select("doc_id", "source", "key", "size", "source_size", "target", "start", pieces.alias("pieces"), taken.alias("taken")), slots.drop("src")
