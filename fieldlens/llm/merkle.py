"""Merkle manifest of a dataset, kept as an append log in postorder.

Leaves are SHA-256 digests of rows. Within a group they stand in order of their
id; every two consecutive nodes become the digest of their hexadecimal texts, a
node left over becomes the digest of its own, until one node, the group's root,
remains. The groups' roots, in order of the group, make the dataset's root the
same way.

Aligned builders. Leaf numbers are cut into blocks of ``BLOCK`` = 2^k leaves. A
builder adds the leaves of one block and writes each node as it is completed, so
its log holds the block's nodes in postorder, 32 bytes each. Block roots are the
leaves of the next stage, built the same way, until one block holds the group;
the groups' roots are one more tree. A stage shuffles digests only, in tasks of
whole blocks, and no block grows with the data.

Addresses. A node of level h and number i starts at leaf L = i 2^h and holds m
leaves. Before it stand the nodes completed within the first L leaves, which are
2 L - popcount(L); its own subtree has sum of ceil(m / 2^l) for l = 0 .. h nodes, the
last of which it is. ``position`` is that closed form; proof extraction reads the
sibling of each level at its address and never searches. Paths of the upper stages are
found once per block and handed down to its leaves.

Every stage is a written table in the shared folder, so a lost executor repeats
one stage at most.

Defined results: null fields are ``-``; rows with a null id come first, rows with equal ids
are ordered by their digest; a null group is a group of its own, before all others;
repeated rows are leaves of their own with proofs of their own places; a row with a null id
or n_chars is never tampered with; an empty
table has no root and no rows. Only the named columns are read, so clashing names do no harm.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import read_table, shared_folder
from .token_files import small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 10        # leaves a builder takes
ROWS = 64              # blocks handed to Python at once
DIGEST = 32
LEFT, RIGHT, ALONE = 0, 1, 2   # where the sibling stands


# ------------------------------------------------------------------ one block
def parent(left: bytes, right: bytes = b"") -> bytes:
    return hashlib.sha256((left.hex() + right.hex()).encode()).digest()


def height_of(n: int) -> int:
    """Levels above the leaves until one node remains."""
    return (n - 1).bit_length()


def append_log(leaves: list[bytes], height: int) -> list[bytes]:
    """All nodes up to ``height`` in the order of their completion; the last is the block's root."""
    log: list[bytes] = []
    waiting: list[bytes | None] = [None] * (height + 1)

    def add(level: int, node: bytes) -> None:
        log.append(node)
        while level < height:
            if waiting[level] is None:
                waiting[level] = node
                return
            node, waiting[level] = parent(waiting[level], node), None
            level += 1
            log.append(node)

    for leaf in leaves:
        add(0, leaf)
    for level in range(height):
        if waiting[level] is not None:  # a run of one
            node, waiting[level] = parent(waiting[level]), None
            add(level + 1, node)
    return log


def position(level: int, number: int, n: int) -> int:
    """Place in the log of the node ``number`` of ``level`` in a block of n leaves."""
    first = number << level
    m = min(n - first, 1 << level)
    before = 2 * first - first.bit_count()
    return before + sum(-(-m >> h) for h in range(level + 1)) - 1


def path_in_block(log: bytes, leaf: int, n: int, height: int) -> bytes:
    """Per level one byte for the sibling's side and, unless there is none, its digest."""
    out = []
    for level in range(height):
        at = (leaf >> level) ^ 1
        if at << level >= n:
            out.append(bytes([ALONE]))
        else:
            p = position(level, at, n) * DIGEST
            out.append(bytes([LEFT if at < leaf >> level else RIGHT]) + log[p:p + DIGEST])
    return b"".join(out)


def siblings(path: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(path):
        side = path[at]
        width = 0 if side == ALONE else DIGEST
        yield side, path[at + 1:at + 1 + width]
        at += 1 + width


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for side, other in siblings(path):
        leaf = parent(other, leaf) if side == LEFT else parent(leaf, other)
    return leaf


def proof_digest(path: bytes) -> str:
    return hashlib.sha256("".join(d.hex() for _, d in siblings(path)).encode()).hexdigest()


# ------------------------------------------------------------------ numbering
def field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]), 256))


def numbered(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` (grp, id, digest, ...) with ``at``, the row's number in its group by (id, digest), and the group's ``total``.

    Rows are range-partitioned and sorted once and written; a row's number is its place behind the first row of its
    group in the partition, plus the group's rows in partitions before. Equal rows may be split anywhere.
    """
    keys = ["grp", "id", "digest", "__tie"]
    rows = rows.withColumn("__tie", F.rand(7))
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")
    rows.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}-sorted")
    rows = rows.sparkSession.read.parquet(f"{folder}-sorted").withColumn("task", F.shiftright("row", 33))
    runs = rows.groupBy("task", "grp").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("grp")   # as many rows as the group has partitions
    runs = runs.select("task", F.col("grp").alias("g"), "first", F.sum("n").over(group).alias("total"),
                       (F.sum("n").over(group.orderBy("task")) - F.col("n")).alias("before"))
    joined = rows.join(runs.withColumnRenamed("task", "t"), (F.col("task") == F.col("t")) & F.col("grp").eqNullSafe(F.col("g")))
    return joined.withColumn("at", F.col("row") - F.col("first") + F.col("before")).drop("row", "task", "t", "g", "first", "before")


# ------------------------------------------------------------------ stages
def build_stage(nodes: DataFrame, path: str, carry: list[str]) -> DataFrame:
    """One log row per block of ``nodes`` (grp, at, total, digest, carried columns), written to ``path``."""
    import pyarrow as pa

    row = F.struct("at", "digest", *carry)
    blocks = (nodes.groupBy("grp", "total", F.floor(F.col("at") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(row)).alias("r"))
              .select("grp", "total", "block", F.col("r.digest").alias("leaves"),
                      *[F.col(f"r.{c}").alias(c) for c in carry]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            logs, roots, heights = [], [], []
            for total, leaves in zip(b.column("total").to_pylist(), b.column("leaves").to_pylist()):
                height = height_of(min(total, BLOCK))
                log = append_log(leaves, height)
                logs.append(b"".join(log))
                roots.append(log[-1])
                heights.append(height)
            keep = [c for c in b.schema.names if c != "leaves"]
            n = [len(x) for x in b.column("leaves").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(n, pa.int32()), pa.array(heights, pa.int32()),
                                              pa.array(logs, pa.binary()), pa.array(roots, pa.binary())], names=[*keep, "n", "height", "log", "root"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema if f.name != "leaves"]
    with small_batches(nodes.sparkSession, ROWS):
        blocks.mapInArrow(run, ", ".join([*fields, "n int", "height int", "log binary", "root binary"])).write.parquet(path)
    return nodes.sparkSession.read.parquet(path)


def build_trees(nodes: DataFrame, folder: str, carry: list[str]) -> list[DataFrame]:
    """The stages of log rows above ``nodes``; each group ends in the stage where one block holds it."""
    stages = [build_stage(nodes, f"{folder}-0", carry)]
    while True:
        more = stages[-1].where(F.col("total") > BLOCK)
        if more.isEmpty():
            return stages
        up = more.select("grp", F.col("block").alias("at"), F.ceil(F.col("total") / BLOCK).alias("total"), F.col("root").alias("digest"))
        stages.append(build_stage(up, f"{folder}-{len(stages)}", []))


@dataclass(frozen=True)
class Manifest:
    groups: list[DataFrame]     # stages of the groups' trees, from the leaves up
    top: list[DataFrame]        # stages of the tree over the groups' roots
    root: bytes | None
    folder: str


def build(leaves: DataFrame, folder: str, carry: list[str] | None = None) -> Manifest:
    """The manifest of ``leaves`` (grp, id, digest and carried columns)."""
    groups = build_trees(numbered(leaves, f"{folder}/leaves"), f"{folder}/groups", ["id", *(carry or [])])
    done = [s.where(F.col("total") <= BLOCK).select("grp", "root") for s in groups]
    roots = done[0]
    for d in done[1:]:
        roots = roots.unionByName(d)
    # All roots are one group; a root's own group is its id.
    roots = roots.select(F.lit(0).alias("grp"), F.col("grp").alias("id"), F.col("root").alias("digest"))
    top = build_trees(numbered(roots, f"{folder}/roots"), f"{folder}/top", ["id"])
    last = top[-1].select("root").head()   # one row at most
    return Manifest(groups, top, bytes(last["root"]) if last else None, folder)


def hand_down(blocks: DataFrame, above: DataFrame, extra: list[str]) -> DataFrame:
    """Per leaf of ``blocks``: grp, its number, digest, extra columns and its path, the block's own path (``above``) included."""
    import pyarrow as pa

    joined = blocks.join(above.withColumnsRenamed({"grp": "g", "block": "b"}),
                         F.col("grp").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b"))).select(
        "grp", "block", "n", "height", "log", "above", "subroot", *extra)
    kinds = {f.name: f.dataType for f in joined.schema}
    elements = {c: kinds[c].elementType.simpleString() for c in extra}
    block = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {c: b.column(c) for c in b.schema.names}
            for i in range(b.num_rows):
                n, height, log, up = (col[c][i].as_py() for c in ("n", "height", "log", "above"))
                paths = [path_in_block(log, leaf, n, height) + up for leaf in range(n)]
                first = col["block"][i].as_py() * block
                digests = [log[p:p + DIGEST] for p in (DIGEST * position(0, leaf, n) for leaf in range(n))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([col["grp"][i].as_py()] * n, col["grp"].type), pa.array(range(first, first + n), pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(paths, pa.binary()), pa.array([col["subroot"][i].as_py()] * n, pa.binary()), *[col[c][i].values for c in extra]],
                    names=["grp", "at", "digest", "path", "subroot", *extra])

    out = [f"grp {kinds['grp'].simpleString()}", "at long", "digest binary", "path binary", "subroot binary", *[f"`{c}` {t}" for c, t in elements.items()]]
    return joined.mapInArrow(run, ", ".join(out))


def _paths(stages: list[DataFrame], tops: DataFrame | None, folder: str, extra: list[str]) -> DataFrame:
    """Paths of the leaves of the lowest stage; ``tops`` (grp, above, subroot) are the paths of the groups' roots, none for a lone tree."""
    spark = stages[0].sparkSession
    handed = None
    for i in reversed(range(len(stages))):
        ended = stages[i].where(F.col("total") <= BLOCK).select("grp", "block", "root")
        if tops is None:
            above = ended.select("grp", "block", F.lit(b"").alias("above"), F.col("root").alias("subroot"))
        else:
            above = ended.join(tops.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).select("grp", "block", "above", "subroot")
        if handed is not None:
            above = above.unionByName(handed.select("grp", F.col("at").alias("block"), F.col("path").alias("above"), "subroot"))
        with small_batches(spark, ROWS):
            hand_down(stages[i], above, extra if i == 0 else []).write.parquet(f"{folder}-{i}")
        handed = spark.read.parquet(f"{folder}-{i}")
    return handed


def proofs(m: Manifest, carry: list[str] | None = None) -> DataFrame:
    """grp, id, at, digest, path up to the dataset's root, subroot and carried columns of every leaf."""
    tops = _paths(m.top, None, f"{m.folder}/top-paths", ["id"])
    tops = tops.select(F.col("id").alias("grp"), F.col("path").alias("above"), F.col("digest").alias("subroot"))
    return _paths(m.groups, tops, f"{m.folder}/paths", ["id", *(carry or [])])


def check_proofs(found: DataFrame, claim: str) -> DataFrame:
    """``found`` of ``proofs`` with the root folded from ``claim`` (null: the leaf itself) and the digest of the siblings."""
    import pyarrow as pa

    names = [c for c in found.columns if c != "path"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name != "path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = b.column("path").to_pylist()
            claims = [c or d for c, d in zip(b.column(claim).to_pylist(), b.column("digest").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array([proof_digest(p) for p in paths], pa.string()),
                 pa.array([fold(c, p).hex() for c, p in zip(claims, paths)], pa.string())], names=[*names, "proof_sha256", "folded_root"])

    return found.mapInArrow(run, ", ".join([*fields, "proof_sha256 string", "folded_root string"]))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    source, lang, n_chars, text = (F.col(c) for c in ("source", "lang", "n_chars", "text"))
    doc_id = F.col("doc_id").cast("long")
    tampered = (F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0) & n_chars.isNotNull()
    leaves = docs.select(lang.alias("grp"), doc_id.alias("id"), leaf_digest(doc_id, source, lang, n_chars, text).alias("digest"),
                         F.when(tampered, leaf_digest(doc_id, source, lang, n_chars + 1, text)).alias("claim"))
    m = build(leaves, shared_folder(spark, "merkle"), ["claim"])
    found = check_proofs(proofs(m, ["claim"]), "claim")
    hexed = lambda c: F.lower(F.hex(c))
    root = F.lit(m.root.hex() if m.root else None).cast("string")
    return found.select(F.col("id").alias("doc_id"), hexed("digest").alias("leaf"), hexed("subroot").alias("subroot"), root.alias("root"),
                        "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), f AS (
  SELECT doc_id, lang, n_chars,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda a, b: xor(a >> 8, crc.t[(xor(a, b) % 256) + 1]))) % 7 = 0 AS tampered
  FROM documents, crc
), l AS (
  SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || tail) AS leaf,
         CASE WHEN tampered AND doc_id IS NOT NULL AND n_chars IS NOT NULL
              THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || tail) END AS claim FROM f
), p AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l
), tree AS (
  SELECT g, 0 AS lvl, i, leaf AS d, count(*) OVER (PARTITION BY g) AS n FROM p
  UNION ALL
  SELECT g, lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY g, lvl, i // 2, n
), top AS (
  SELECT 0 AS lvl, g - 1 AS i, d, count(*) OVER () AS n FROM tree WHERE n = 1
  UNION ALL
  SELECT lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, i // 2, n
), q AS (
  SELECT *, row_number() OVER () AS rid FROM p
), lv AS (
  SELECT DISTINCT g, lvl FROM tree WHERE n > 1
), sib AS (
  SELECT rid, 0 AS stage, lv.lvl, CASE WHEN t.d IS NULL THEN 'A' WHEN t.i < (q.i >> lv.lvl) THEN 'L' ELSE 'R' END AS side, coalesce(t.d, '') AS d
  FROM q JOIN lv USING (g) LEFT JOIN tree t ON t.g = q.g AND t.lvl = lv.lvl AND t.i = xor(q.i >> lv.lvl, 1)
  UNION ALL
  SELECT rid, 1, v.lvl, CASE WHEN t.d IS NULL THEN 'A' WHEN t.i < ((q.g - 1) >> v.lvl) THEN 'L' ELSE 'R' END, coalesce(t.d, '')
  FROM q CROSS JOIN (SELECT DISTINCT lvl FROM top WHERE n > 1) v LEFT JOIN top t ON t.lvl = v.lvl AND t.i = xor((q.g - 1) >> v.lvl, 1)
), path AS (
  SELECT rid, list(side || d ORDER BY stage, lvl) AS steps, sha256(string_agg(d, '' ORDER BY stage, lvl)) AS proof FROM sib GROUP BY rid
), r AS (
  SELECT q.*, s.d AS subroot, (SELECT d FROM top WHERE n = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256,
         list_reduce(list_prepend(coalesce(claim, leaf), coalesce(steps, [])), lambda a, x:
           sha256(CASE x[1] WHEN 'L' THEN x[2:] || a WHEN 'R' THEN a || x[2:] ELSE a END)) AS folded_root
  FROM q LEFT JOIN path USING (rid) JOIN (SELECT g, d FROM tree WHERE n = 1) s USING (g)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM r
"""
