"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes count words. Sources in code-point order (null last) get the weights of
``weights`` in turn and share ``share`` times all words; no target exceeds
``cap`` times its source's size, and what is cut is shared out again by weight
until no target is above its cap.

A source's documents fall into blocks by hash. A permuted order of the blocks
is drawn as often as the target needs: whole rounds first, then leading blocks
of one more round, and of the block in which the target is reached the
documents that still fit, largest first. What room is then left is spent in the
same way on the fitting documents of the blocks after it, until none is left. So
whole documents are taken, each at most ceil(cap) times, and a source misses its
target by less than the smallest of its documents that the last round left out.

The number of block draws of each source is exact. A binary tree over the
output shards splits these counts: at every node the left half's counts are a
multivariate hypergeometric draw (an urn emptied source by source with hashed
uniforms), so shards hold disjoint draws, quotas sum exactly, and reruns agree.
Inside a shard rows are ordered by a hash.

Only (row, id, source, size) tuples are shuffled, by (source, block); a block is
bounded in documents, also where many rows share an id, and but for a long
document in words, so a hot source is many groups. Totals per
source are partial aggregates. Sources are joined by broadcast only when a
count shows at most ``MAX_SOURCES``.

Defined results: null or empty texts have size 0 and are never drawn; a null
source is a source of its own; repeated rows are separate rows; rows with a
null id are spread by their row number; an empty table gives an empty mix.
Input columns named like an internal one (leading ``__``) are not supported;
others are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .text import SPACED_WORD, read_table, shared_folder, whole, words_of

MAX_SOURCES = 50_000


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    cap: float = 2.0
    block_words: int = 1 << 16
    block_docs: int = 1 << 12
    shards: int = 16
    seed: int = 20


def numbered(docs: DataFrame, keep: list[str], source: str, doc_id: str, text: str, path: str) -> DataFrame:
    """Columns ``keep`` with size, number and id of every row, written once so that numbers can't change."""
    rows = docs.select(*keep, F.col(doc_id).alias("__id"), F.col(source).alias("__source"),
                       F.size(words_of(whole(F.col(text)), SPACED_WORD)).cast("long").alias("__size"),
                       F.monotonically_increasing_id().alias("__row"))
    rows.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def targets(rows: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: size, documents, blocks, target, whole rounds ``q`` and words of the last round ``r``.

    Windows without a partition key run over one row per source.
    """
    per = rows.groupBy("__source").agg(F.sum("__size").alias("s"), F.count(F.lit(1)).alias("docs"),
                                       F.min(F.when(F.col("__size") > 0, F.col("__size"))).alias("least"))
    by_name = W.orderBy(F.col("__source").asc_nulls_last())
    per = per.withColumn("idx", F.row_number().over(by_name) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in mix.weights])
    per = per.withColumn("w", F.get(cycle, F.pmod(F.col("idx"), F.lit(len(mix.weights)))))
    all_rows = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = W.orderBy("fill", "idx").rowsBetween(W.unboundedPreceding, -1)
    per = (per.withColumn("fill", mix.cap * F.col("s") / F.col("w"))  # the level at which the source is at its cap
           .withColumn("capped", F.coalesce(F.sum(mix.cap * F.col("s")).over(before), F.lit(0.0)))
           .withColumn("w_rest", F.sum("w").over(all_rows) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           .withColumn("level", (mix.share * F.sum("s").over(all_rows) - F.col("capped")) / F.col("w_rest"))
           .withColumn("level", F.coalesce(F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "idx", "level")))
                                           .over(all_rows)["level"], F.max("fill").over(all_rows)))
           .withColumn("target", F.least(F.col("level") * F.col("w"), mix.cap * F.col("s"))))
    words = F.round("target").cast("long")
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("s") / mix.block_words), F.ceil(F.col("docs") / mix.block_docs))
    return per.select("__source", "idx", "s", "docs", "least", "target", blocks.alias("blocks"),
                      F.when(F.col("s") > 0, F.floor(words / F.col("s"))).otherwise(0).alias("q"),
                      F.when(F.col("s") > 0, F.pmod(words, F.greatest("s", F.lit(1)))).otherwise(0).cast("long").alias("r"))


def _left_counts(seed: int) -> Column:
    """What is left of the left half's capacity before each source and after the last one (array)."""
    start = F.struct(F.col("n").alias("n"), F.array(F.col("cap")).alias("left"))

    def source(acc: Column, c: Column, i: Column) -> Column:
        def ball(a: Column, k: Column) -> Column:
            u = F.pmod(F.xxhash64(F.lit(seed), F.col("lo"), F.col("m"), i, k), F.lit(1 << 30)) / F.lit(float(1 << 30))
            return F.struct((a["n"] - 1).alias("n"), (a["l"] - F.when(u * a["n"] < a["l"], 1).otherwise(0)).alias("l"))

        balls = F.when(c > 0, F.sequence(F.lit(1).cast("long"), c)).otherwise(F.array().cast("array<bigint>"))
        rest = F.aggregate(balls, F.struct(acc["n"].alias("n"), F.element_at(acc["left"], -1).alias("l")), ball, lambda a: a["l"])
        return F.struct((acc["n"] - c).alias("n"), F.concat(acc["left"], F.array(rest)).alias("left"))

    numbered_counts = F.transform("counts", lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.aggregate(numbered_counts, start, lambda a, x: source(a, x["c"], x["i"]), lambda a: a["left"])


def split_quotas(counts: DataFrame, mix: Mix) -> DataFrame:
    """(shard, counts): the source block counts of each output shard; ``counts`` is one row with an array."""
    node = counts.select(F.lit(0).alias("lo"), F.lit(mix.shards).alias("m"), "counts")
    width = mix.shards
    while width > 1:
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
        half = F.floor(F.col("m") / 2).cast("int")
        step = node.withColumn("n", total).withColumn("half", half)
        step = step.withColumn("cap", F.floor(F.col("n") * F.col("half") / F.col("m")).cast("long"))
        step = step.withColumn("rest", _left_counts(mix.seed))
        step = step.withColumn("taken", F.transform("counts", lambda c, i: F.get(F.col("rest"), i) - F.get(F.col("rest"), i + 1)))
        left = F.struct("lo", F.col("half").alias("m"), F.col("taken").alias("counts"))
        right = F.struct((F.col("lo") + F.col("half")).alias("lo"), (F.col("m") - F.col("half")).alias("m"),
                         F.zip_with("counts", "taken", lambda c, t: c - t).alias("counts"))
        same = F.struct("lo", "m", "counts")
        node = step.select(F.explode_outer(F.when(F.col("m") > 1, F.array(left, right)).otherwise(F.array(same))).alias("x")).select("x.*")
        width = -(-width // 2)
    return node.select(F.col("lo").alias("shard"), "counts")


def _fitting(found: DataFrame) -> DataFrame:
    """(idx, block, __row, size): of each block's rows, a bounded list, those that fit its ``room``, largest first."""
    entry = F.struct((-F.col("__size")).alias("neg"), "h", "__row")
    lists = found.where("__size > 0").groupBy("idx", "block", "room").agg(F.sort_array(F.collect_list(entry)).alias("rows"))
    none = F.array().cast("array<boolean>")
    fits = F.aggregate("rows", F.struct(F.col("room").alias("room"), none.alias("fit")), lambda a, x: F.struct(
        F.when(-x["neg"] <= a["room"], a["room"] + x["neg"]).otherwise(a["room"]).alias("room"),
        F.concat(a["fit"], F.array(-x["neg"] <= a["room"])).alias("fit")), lambda a: a["fit"])
    each = lists.withColumn("fit", fits).select("idx", "block", F.explode(F.arrays_zip("rows", "fit")).alias("x")).where("x.fit")
    return each.select("idx", "block", F.col("x.rows.__row").alias("__row"), (-F.col("x.rows.neg")).alias("size"))


def _parted(slim: DataFrame, mix: Mix, folder: str) -> DataFrame:
    """``slim`` with blocks of about ``block_docs`` rows where one holds over twice as many: rows that share an id hash alike
    and are dealt over further blocks by row number. Unique ids fill no block so far, so their blocks don't change."""
    counts = slim.groupBy("idx", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * mix.block_docs)
    counts.select("idx", "block", F.ceil(F.col("n") / mix.block_docs).alias("pieces")).write.parquet(f"{folder}/full")
    full = slim.sparkSession.read.parquet(f"{folder}/full")
    n = full.count()
    if not n:
        return slim
    full = F.broadcast(full) if n <= MAX_SOURCES else full
    piece = F.pmod(F.xxhash64(F.lit(mix.seed), "h", "__row"), F.coalesce("pieces", F.lit(1)))
    return slim.join(full, ["idx", "block"], "left").withColumn("block", F.col("block") + F.col("blocks") * piece).drop("pieces")


def _last_round(slim: DataFrame, blocks: DataFrame, sources: DataFrame, folder: str, seed: int, small: bool) -> DataFrame:
    """(idx, block, __row, size) of the documents that the last round takes one by one: of the block in which the target
    is reached, then of the blocks after it, until the source's room is below its smallest document left out.

    A step deals with documents of at most half the room. Where all of them fit, at most one larger one does, and the
    source is done. Elsewhere a block is reached again, and largest first fills more than half of the room. So each step
    halves the room, and steps are at most as many as its bits.
    """
    spark = slim.sparkSession
    same = ["idx", "block"]
    place = F.struct(F.xxhash64(F.lit(seed), "idx", "block").alias("at"), "block")  # in the permuted order
    before = W.partitionBy("idx").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    reached = blocks.where("state = 2").select(*same, "room", place.alias("place"))
    _fitting(slim.join(reached.select(*same, "room"), same)).write.parquet(f"{folder}/picks-0")
    step = 0
    while True:
        spent = spark.read.parquet(f"{folder}/picks-{step}").groupBy(*same).agg(F.sum("size").alias("spent"))
        left = reached.join(spent, same, "left").join(sources.select("idx", "least"), "idx").select(
            "idx", (F.col("room") - F.coalesce("spent", F.lit(0))).alias("limit"), F.col("place").alias("behind"), "least")
        left.where("limit >= least").drop("least").write.parquet(f"{folder}/left-{step}")
        left = spark.read.parquet(f"{folder}/left-{step}")
        if left.isEmpty():
            return spark.read.parquet(*[f"{folder}/picks-{k}" for k in range(step + 1)])
        step += 1
        rest = (slim.join(F.broadcast(left) if small else left, "idx").withColumn("place", place)
                .where("place > behind and __size > 0 and __size <= limit"))
        halves = rest.where("2 * __size <= limit")
        sums = halves.groupBy(*same, "place", "limit").agg(F.sum("__size").alias("words"))
        sums = sums.withColumn("room", F.col("limit") - F.coalesce(F.sum("words").over(before), F.lit(0)))
        sums.where("room > 0").write.parquet(f"{folder}/later-{step}")
        later = spark.read.parquet(f"{folder}/later-{step}")
        entire, reached = later.where("words <= room"), later.where("words > room").select(*same, "room", "place")
        done = left.join(reached.select("idx"), "idx", "left_anti").join(
            entire.groupBy("idx").agg(F.sum("words").alias("spent")), "idx", "left").select(
            F.col("idx").alias("d_idx"), (F.col("limit") - F.coalesce("spent", F.lit(0))).alias("over"))
        larger = rest.join(F.broadcast(done) if small else done, F.col("idx") == F.col("d_idx")).where("2 * __size > limit and __size <= over")
        larger = larger.groupBy("idx").agg(F.min(F.struct("place", "h", "__row", "block", "__size")).alias("x"))
        got = halves.join(entire.select(*same), same).select(*same, "__row", F.col("__size").alias("size"))
        got = got.unionByName(_fitting(halves.join(reached.select(*same, "room"), same)))
        got = got.unionByName(larger.select("idx", "x.block", "x.__row", F.col("x.__size").alias("size")))
        got.write.parquet(f"{folder}/picks-{step}")


def draw(rows: DataFrame, mix: Mix, folder: str) -> DataFrame:
    """Per row of ``numbered``: __row, __id, size, source_size, target, draws and ``shards`` (one entry per draw)."""
    spark = rows.sparkSession
    targets(rows, mix).write.parquet(f"{folder}/sources")
    sources = spark.read.parquet(f"{folder}/sources")
    small = sources.count() <= MAX_SOURCES
    held = sources.select(F.col("__source").alias("s_name"), "idx", "s", "target", "blocks", "q", "r")
    held = F.broadcast(held) if small else held
    key = F.xxhash64(F.lit(mix.seed), "__id", F.when(F.col("__id").isNull(), F.col("__row")))
    slim = rows.select("__row", "__id", "__source", "__size", key.alias("h"))
    slim = slim.join(held, F.col("__source").eqNullSafe(F.col("s_name"))).select(
        "__row", "__id", "__size", "h", "idx", "s", "target", "blocks", "q", "r",
        F.pmod(F.xxhash64(F.lit(mix.seed), "h"), F.col("blocks")).alias("block"))
    slim = _parted(slim, mix, folder)
    sizes = slim.groupBy("idx", "block", "blocks", "q", "r").agg(F.sum("__size").alias("words"))
    order = W.partitionBy("idx").orderBy(F.xxhash64(F.lit(mix.seed), "idx", "block"), "block")  # over blocks, not rows
    placed = (sizes.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
              .withColumn("present", F.count(F.lit(1)).over(W.partitionBy("idx")))
              .withColumn("room", F.col("r") - F.coalesce(F.sum("words").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))))
    placed = placed.withColumn("state", F.when(F.col("room") <= 0, 0).when(F.col("words") <= F.col("room"), 1).otherwise(2))
    placed.write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    picks = _last_round(slim, blocks, sources, folder, mix.seed, small)
    parts = picks.select("idx", "block").distinct().withColumn("part", F.lit(True))
    blocks = blocks.join(parts, ["idx", "block"], "left").withColumn("part", (F.col("state") == 2) | F.coalesce("part", F.lit(False)))
    # the last round's draws are those of its whole blocks and of the blocks it takes documents of, numbered without gaps
    taken = F.when((F.col("state") > 0) | F.col("part"), 1).otherwise(0)
    blocks = blocks.withColumn("last", taken).withColumn("turn", F.sum("last").over(W.partitionBy("idx").orderBy("rank")) - 1)
    blocks.write.parquet(f"{folder}/drawn")
    blocks = spark.read.parquet(f"{folder}/drawn")
    n_draws = blocks.groupBy("idx").agg((F.max(F.col("q") * F.col("present")) + F.sum("last")).alias("n"))
    counts = n_draws.agg(F.transform(F.sort_array(F.collect_list(F.struct("idx", "n"))), lambda x: x["n"]).alias("counts"))
    quotas = split_quotas(counts, mix).select("shard", F.posexplode("counts").alias("idx", "quota"))
    upto = F.sum("quota").over(W.partitionBy("idx").orderBy("shard"))
    bounds = (quotas.withColumn("upto", upto).groupBy("idx")
              .agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "upto"))), lambda x: x["upto"]).alias("bounds")))
    # draw number: whole rounds one after the other, then the last round; each in the permuted order of the blocks
    epochs = F.when(F.col("q") + F.col("last") > 0, F.sequence(F.lit(0).cast("long"), F.col("q") + F.col("last") - 1)).otherwise(
        F.array().cast("array<bigint>"))
    number = lambda e: e * F.col("present") + F.when(e < F.col("q"), F.col("rank")).otherwise(F.col("turn"))
    shard_of = F.transform(epochs, lambda e: F.size(F.filter("bounds", lambda b: b <= number(e))))
    joined = blocks.join(F.broadcast(bounds) if small else bounds, "idx")
    plan = joined.select(F.col("idx").alias("p_idx"), F.col("block").alias("p_block"), "state", "part", shard_of.alias("shards"))
    found = slim.join(plan, (F.col("idx") == F.col("p_idx")) & (F.col("block") == F.col("p_block")))
    out = ["__row", "__id", "__size", "s", "target", "draws", "shards"]
    whole_blocks = found.where("not part").withColumn("draws", F.col("q") + F.col("state"))
    picked = picks.select(F.col("__row").alias("p_row"))
    last = found.where("part").join(picked, F.col("__row") == F.col("p_row"), "left").withColumn(
        "draws", F.col("q") + F.col("p_row").isNotNull().cast("long"))
    got = whole_blocks.select(*out).unionByName(last.select(*out))
    return got.select("__row", "__id", F.col("__size").alias("size"), F.col("s").alias("source_size"), "target",
                      F.when(F.col("__size") > 0, F.col("draws")).otherwise(0).cast("long").alias("draws"),
                      F.when(F.col("__size") > 0, F.slice("shards", F.lit(1), F.col("draws").cast("int")))
                      .otherwise(F.array().cast("array<int>")).alias("shards"))


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", source: str = "source",
                    text: str = "text") -> DataFrame:
    """The mix: each row of ``docs`` as often as it is drawn, with ``shard`` and ``shard_order`` (in place of input columns of these names)."""
    folder = shared_folder(docs.sparkSession, "mix")
    kept = [c for c in docs.columns if c not in ("shard", "shard_order") or c in (source, text, doc_id)]
    rows = numbered(docs, kept, source, doc_id, text, f"{folder}/rows")
    drawn = draw(rows, mix, folder).where("draws > 0").select(F.col("__row").alias("__drawn"), F.posexplode("shards").alias("__turn", "__shard"))
    place = F.xxhash64(F.lit(mix.seed), "__shard", "__id", "__row", "__turn").alias("shard_order")
    return rows.join(drawn, F.col("__row") == F.col("__drawn")).select(
        *[c for c in kept if c not in ("shard", "shard_order")], F.col("__shard").alias("shard"), place)


def local_shuffle(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Rows clustered by output shard and shuffled inside each, ready for ``write.partitionBy('shard')`` when ``columns`` has it."""
    return mixed.repartition("shard", F.pmod("shard_order", F.lit(8))).sortWithinPartitions("shard", "shard_order").select(*columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "mix")
    rows = numbered(read_table(spark, sf_dir, "documents"), [], "source", "doc_id", "text", f"{folder}/rows")
    return draw(rows, Mix(), folder).select(F.col("__id").alias("doc_id"), "size", "source_size", "target",
                                            (F.col("draws") * F.col("size")).alias("taken"),
                                            F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards"))
