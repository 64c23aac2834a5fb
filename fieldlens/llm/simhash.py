"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has 64 bits: a bit is 1 when it is set in more than half
of the XXH64 hashes (seed 42) of its word shingles, repeats included. Two
fingerprints link when at most ``max_bits`` bits differ.

Search. Bits are grouped into m partitions, correlated bits together. With
thresholds t_i >= -1 and sum(t_i + 1) = max_bits + 1, any two fingerprints
that differ in at most ``max_bits`` bits differ in at most t_i bits of some
partition i. A dynamic program picks the thresholds (and m) with the lowest
estimated cost: rows probed plus candidates, from the collisions counted in
each partition over all fingerprints and the balance of each bit. Each
fingerprint is stored once per used partition and probes it with every value
within t_i bits; the Hamming distance verifies each candidate inside the join.
All choices only move cost: the links are exact for every choice.

Skew. Equal fingerprints are one node before anything is joined, so copies
never make pairs. Components come from alternating large-star / small-star
rounds over linked nodes only, each round written to the shared folder.

Defined results: null, empty or white-space texts have fingerprint zero and
link like any other; a text with fewer words than a shingle is one shingle;
repeated rows each get their own result row; null ids are ignored by the
smallest id (null if a component has no other); an empty table gives an empty
result. Other columns are not read by ``components``.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import read_table, shared_folder

BITS = 64
SHINGLE, MAX_BITS = 3, 3
CHUNK = 1 << 15  # shingles whose bits are counted at once

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one UTF-8 text."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, CHUNK):
        hashes = np.fromiter((xxh64_intdigest(b" ".join(words[i:i + shingle]), 42) for i in range(at, min(n, at + CHUNK))),
                             dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """Columns ``keep`` (default: all) and ``name``, the fingerprint as a signed long, of every row."""
    import pyarrow as pa

    keep = docs.columns if keep is None else keep
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(fingerprint(t.as_py(), shingle)) for t in b.column("__text")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(fps, pa.int64())], names=[*keep, name])

    return rows.mapInArrow(run, T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, T.LongType())]))


# ------------------------------------------------------------------ partitions and thresholds
def bit_statistics(fps: DataFrame) -> tuple[int, list[list[int]]]:
    """Rows, and for each pair of bits the rows that have both set (64 x 64 counts; the diagonal: each bit)."""
    import numpy as np
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), dtype=np.int64), 0
        for b in batches:
            x = np.ascontiguousarray(b.column("fp").to_numpy(zero_copy_only=False)).astype("<i8")
            for at in range(0, len(x), CHUNK):
                bits = np.unpackbits(x[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
            n += len(x)
        i, j = np.indices((BITS, BITS))
        yield pa.RecordBatch.from_pydict({"i": [*i.ravel().tolist(), -1], "j": [*j.ravel().tolist(), -1],
                                          "c": [*both.ravel().tolist(), n]})

    rows = fps.select("fp").mapInArrow(run, "i long, j long, c long").groupBy("i", "j").agg(F.sum("c").alias("c")).collect()
    both, n = [[0] * BITS for _ in range(BITS)], 0
    for r in rows:  # 4,097 rows whatever the input
        if r["i"] < 0:
            n = r["c"]
        else:
            both[r["i"]][r["j"]] = r["c"]
    return n, both


def group_bits(n: int, both: list[list[int]], m: int) -> list[list[int]]:
    """m partitions of nearly equal width; each grows by the free bit most correlated with it."""
    import numpy as np

    c = np.array(both, dtype=float) / max(n, 1)
    p = np.diag(c)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((c - np.outer(p, p)) / np.outer(sd, sd))
    free, groups = set(range(BITS)), []
    for g in range(m):
        width = len(free) // (m - g)
        group = [min(free, key=lambda b: (-sum(corr[b][x] for x in free if x != b), b))]
        free -= set(group)
        while len(group) < width:
            best = min(free, key=lambda b: (-sum(corr[b][x] for x in group), b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def allocate(costs: list[list[float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = max_bits + 1 and the least total cost; costs[i][t + 1]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for k in range(max_bits + 2 - used):
                option = (cost + row[k], [*ts, k - 1])
                if used + k not in step or option < step[used + k]:
                    step[used + k] = option
        best = step
    return best[max_bits + 1]


def plan(fps: DataFrame, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is used, for distinct fingerprints ``fps``.

    Collisions per partition are counted over all fingerprints; what comes to
    the driver is 64 x 64 counts and one number per partition.
    """
    n, both = bit_statistics(fps)
    layouts = {m: group_bits(n, both, m) for m in range(2, max_bits + 2)} or {1: [list(range(BITS))]}
    parts = [(m, g) for m, groups in layouts.items() for g in groups]
    entry = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_mask(g))).alias("v"))
                                for k, (_, g) in enumerate(parts)])).alias("e")
    same = (fps.select(entry).groupBy("e.k", "e.v").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("k").agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2).alias("pairs")))
    pairs = {r["k"]: r["pairs"] for r in same.collect()}
    p = [both[b][b] / max(n, 1) for b in range(BITS)]
    options = []
    for m, groups in layouts.items():
        costs = []
        for k, (of, g) in enumerate(parts):
            if of != m:
                continue
            odds = [2 * p[b] * (1 - p[b]) / max(1 - 2 * p[b] * (1 - p[b]), 0.5) for b in g]
            within = [1.0] + [0.0] * max_bits  # elementary symmetric sums: chances of t unequal bits, over those of none
            for o in odds:
                for t in range(max_bits, 0, -1):
                    within[t] += within[t - 1] * o
            row = [0.0]
            for t in range(max_bits + 1):
                probes = sum(math.comb(len(g), x) for x in range(t + 1))
                found = max(pairs.get(k, 0.0), n * n / 2 * math.prod(1 / (1 + o) for o in odds)) * sum(within[:t + 1])
                row.append(n * (1.0 + probes) + 0.1 * found)
            costs.append(row)
        total, ts = allocate(costs, max_bits)
        options.append((total, m, [(g, t) for g, t in zip(groups, ts) if t >= 0]))
    return min(options)[2]


def links(fps: DataFrame, max_bits: int = MAX_BITS, parts: list[tuple[list[int], int]] | None = None) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints that differ in at most ``max_bits`` bits, each once."""
    parts = plan(fps, max_bits) if parts is None else parts
    fp = F.col("fp")

    def entries(probes: bool) -> Column:
        made = []
        for k, (bits, t) in enumerate(parts):
            turned = [_mask(list(x)) for r in range(t + 1 if probes else 1) for x in itertools.combinations(bits, r)]
            made.append(F.transform(F.array(*[F.lit(x).cast("long") for x in turned]), _entry(k, fp.bitwiseAND(F.lit(_mask(bits))))))
        return F.explode_outer(F.concat(*made)).alias("e")

    index = fps.select(fp.alias("a"), entries(False)).select("a", F.col("e.k").alias("k"), F.col("e.v").alias("v"))
    probe = fps.select(fp.alias("b"), entries(True)).select("b", F.col("e.k").alias("pk"), F.col("e.v").alias("pv"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return (index.join(probe, (F.col("k") == F.col("pk")) & (F.col("v") == F.col("pv")) & (F.col("a") < F.col("b")) & near)
            .select("a", "b").distinct())


def _entry(k: int, key: Column):
    return lambda f: F.struct(F.lit(k).alias("k"), key.bitwiseXOR(f).alias("v"))


# ------------------------------------------------------------------ components
def connected(spark: SparkSession, pairs: DataFrame, folder: str) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``pairs`` (a, b).

    Alternating stars. Each round joins edges with the per-node minimum, a
    partial aggregate, so a hub's neighbours are never gathered in one place.
    """
    edges = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    seen, turn = None, 0
    while True:
        path = f"{folder}/star-{turn}"
        edges.write.parquet(path)
        edges = spark.read.parquet(path)  # lineage ends here; the files are in the shared folder
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if turn and state == seen and turn % 2 == 0:
            break
        if turn % 2 == 0:
            seen = state
            both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))  # large star
            low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
            edges = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            low = edges.groupBy("u").agg(F.min("v").alias("m"))  # small star
            edges = edges.join(low, "u").select(F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = edges.where("u <> v").distinct()
        turn += 1
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _grouped(spark: SparkSession, rows: DataFrame, folder: str, max_bits: int, best: Column) -> DataFrame:
    """(fp, best): for each distinct fingerprint of ``rows`` the smallest ``best`` of its component."""
    rows.groupBy("fp").agg(F.min(best).alias("best")).write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    roots = connected(spark, links(nodes.select("fp"), max_bits), folder)
    joined = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "best", F.coalesce("root", "fp").alias("root"))
    linked = joined.groupBy("root").agg(F.min("best").alias("least"))
    return joined.join(linked, "root").select("fp", F.col("least").alias("best"))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of every row."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "simhash")
    fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle, ["doc_id"]).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    groups = _grouped(spark, rows, folder, max_bits, F.col("doc_id"))
    return rows.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                          F.col("best").alias("component_id"))


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: that with the smallest doc_id (null ids last; of equal ids any one row).

    Rows are numbered when they are written, so a lost executor can't number
    them anew; only (fingerprint, id, number) takes part in the search.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "simhash")
    numbered = fingerprints(docs, text, shingle, name="__fp").withColumn("__row", F.monotonically_increasing_id())
    numbered.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    slim = rows.select(F.col("__fp").alias("fp"), F.col(doc_id).alias("id"), F.col("__row").alias("row"))
    groups = _grouped(spark, slim, folder, max_bits, order)
    stay = groups.select(F.col("best.row").alias("__stay")).distinct()
    return rows.join(stay, F.col("__row") == F.col("__stay"), "left_semi").drop("__row", "__fp")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read_table(spark, sf_dir, "documents"))
