"""Merkle manifest of a dataset: digests of rows, trees by group, a root and proofs.

A level is one slot pivot: the children of a parent are spread by conditional
aggregates into as many columns as the tree has children a node. The columns
one after another give the parent's digest; without a child's own column they
are its siblings. Several levels are built within one partitioning, as all
nodes under the same ancestor some levels up lie together; what leaves such a
step is one row per ancestor with the paths of the nodes under it, a bounded number.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.ranks import placed
from gaugeline.session import materialize

FANOUT = 2
MOST_BELOW = 256  # nodes that one row of a stored step may hold
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """A value in a form that runs into no other: byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def step(nodes: DataFrame, group: Sequence[str], fanout: int, levels: int) -> DataFrame:
    """Up to ``levels`` levels of every tree; one row per node reached.

    ``nodes`` has the group's columns, __place, __total (nodes of the level in
    this tree), digest and row (any struct). The result has __place, __total
    and digest of the level reached, and members: row and path of each node
    below. A tree that has come to one node stays as it is.
    """
    width = fanout ** levels
    now = nodes.select(
        *group, F.expr(f"__place div {width}").alias("__block"), "__place", "__total", "digest",
        F.array(F.struct("row", F.array().cast(PATH).alias("path"))).alias("members"),
    ).repartition(*group, "__block")
    slots = range(fanout)
    for _ in range(levels):
        slot = F.col("__place") % fanout
        children = now.withColumn("__parent", F.expr(f"__place div {fanout}")).groupBy(
            *group, "__block", "__parent", "__total"
        ).agg(*[F.max(F.when(slot == s, F.col("digest"))).alias(f"__digest{s}") for s in slots],
              *[F.first(F.when(slot == s, F.col("members")), True).alias(f"__members{s}") for s in slots])

        def joined(columns: Sequence[int]) -> Column:
            return F.concat(F.lit(""), *[F.coalesce(F.col(f"__digest{s}"), F.lit("")) for s in columns])

        def deeper(s: int) -> Column:
            siblings = F.struct(joined(range(s)).alias("before"), joined(range(s + 1, fanout)).alias("after"))
            longer = F.transform(F.col(f"__members{s}"), lambda m: F.struct(
                m["row"].alias("row"), F.concat(m["path"], F.array(siblings)).alias("path")))
            return F.coalesce(longer, F.slice(F.col("__members0"), 1, 0))

        alone = F.col("__total") == 1
        now = children.select(
            *group, "__block", F.col("__parent").alias("__place"),
            F.expr(f"(__total + {fanout - 1}) div {fanout}").alias("__total"),
            F.when(alone, F.col("__digest0")).otherwise(F.sha2(joined(slots), 256)).alias("digest"),
            F.when(alone, F.col("__members0")).otherwise(F.concat(*[deeper(s) for s in slots])).alias("members"))
    return now.drop("__block")


def trees(leaves: DataFrame, group: Sequence[str], order: Sequence[str], fanout: int = FANOUT) -> tuple[DataFrame, DataFrame]:
    """Rows with their paths, and the top node of every group.

    ``leaves`` has the columns ``group``, ``order`` and digest (none named
    with ``__``). The first result has all columns of ``leaves``, path (per
    level from the leaf: the siblings' digests before and after it) and top;
    the second has the group's columns and digest. Groups may be null; an
    empty table has no groups.
    """
    if fanout < 2:
        raise ValueError("a node needs two children at least")
    levels = 1
    while fanout ** (levels + 1) <= MOST_BELOW:
        levels += 1
    nodes = placed(leaves, group, order, "merkle").select(
        *group, "__place", "__total", "digest", F.struct(*leaves.columns).alias("row"))
    most = nodes.agg(F.max("__total")).first()[0] or 0
    steps: list[DataFrame] = []
    while not steps or most > 1:
        steps.append(materialize(step(nodes, group, fanout, levels), "merkle-step"))
        nodes = steps[-1].select(*group, "__place", "__total", "digest", F.struct("__place").alias("row"))
        most = -(-most // fanout ** levels)
    tops = steps[-1].select(*group, "digest")
    under = steps[-1].withColumnRenamed("digest", "top").withColumn("__above", F.array().cast(PATH))
    for below in reversed(steps[:-1]):
        above = materialize(opened(under, group), "merkle-paths").select(
            *[F.col(name).alias(f"__g{at}") for at, name in enumerate(group)],
            F.col("row.__place").alias("__p"), F.col("path").alias("__above"), "top")
        same = [F.col(name).eqNullSafe(F.col(f"__g{at}")) for at, name in enumerate(group)]
        under = below.drop("digest").join(above, reduce(lambda a, b: a & b, same, F.col("__place") == F.col("__p")))
    return opened(under, group).select("row.*", "path", "top"), tops


def opened(under: DataFrame, group: Sequence[str]) -> DataFrame:
    """The members of every row, their paths going on with the row's own."""
    member = F.col("__member")
    return under.select(*group, F.explode("members").alias("__member"), "__above", "top").select(
        *group, member["row"].alias("row"), F.concat(member["path"], "__above").alias("path"), "top")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its siblings."""
    return F.aggregate(path, leaf, lambda node, level: digest(level["before"], node, level["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf up."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), ""), 256)


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", key: str = "doc_id",
             fanout: int = FANOUT, more: Sequence[Column] = ()) -> DataFrame:
    """One row per row of ``docs``: key, leaf, subroot, root and path, and the columns ``more`` (named apart from these).

    ``leaf`` is the digest of ``columns``. Within a group leaves ascend by key
    (null first), equal keys by leaf; rows that are equal throughout have equal leaves
    and a place each. A null group is a group, the first. Only digests
    and ``more`` are moved, never texts. Columns that are not named are not read.
    """
    leaves = docs.select(
        F.col(key).alias("key"), F.col(group).cast("string").alias("part"),
        digest(*[field(F.col(name)) for name in columns]).alias("digest"), *more)
    rows, subroots = trees(leaves, ["part"], ["key", "digest"], fanout)
    parts, _ = trees(subroots, [], ["part"], fanout)
    upper = materialize(parts.select(
        F.col("part").alias("__part"), F.col("path").alias("__upper"), F.col("top").alias("root")), "merkle-roots")
    kept = [name for name in leaves.columns if name not in ("key", "part", "digest")]
    return rows.join(upper, F.col("part").eqNullSafe(F.col("__part"))).select(
        F.col("key").alias(key), F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root",
        F.concat("path", "__upper").alias("path"), *kept)


def manifest_report(docs: DataFrame) -> DataFrame:
    """The manifest with every path folded again, every seventh checksum's leaf from a tampered row.

    Where 7 divides the checksum of the id, the leaf is that of the row with 1
    added to n_chars (null stays null), and ``verified`` is false unless that
    changes nothing. A null id is not tampered with. Rows that repeat are rows
    of their own.
    """
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1  # the largest long has a successor too
    changed = digest(*[field(one_more if name == "n_chars" else F.col(name)) for name in COLUMNS])
    given = F.coalesce(F.when(hit & F.col("n_chars").isNotNull(), changed), F.lit("")).alias("tampered")
    found = manifest(docs, more=[given])
    leaf = F.when(F.col("tampered") == "", F.col("leaf")).otherwise(F.col("tampered"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        fold(leaf, F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _row_digest(n_chars: str) -> str:
    values = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in values) + ")"


SQL = rf"""
WITH RECURSIVE bits(byte, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL
  SELECT byte, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY byte) AS steps FROM bits WHERE k = 8
), leaves AS (
  SELECT doc_id, lang, {_row_digest("n_chars")} AS leaf,
         CASE WHEN n_chars IS NOT NULL AND xor(list_reduce(
                list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 7 = 0
              THEN {_row_digest("n_chars + 1")} END AS changed
  FROM documents, crc_table
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY lang) AS total
  FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, place, total, leaf AS digest FROM placed
  UNION ALL
  SELECT lang, level + 1, place // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE total > 1 GROUP BY lang, level, place // 2, total
), subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS total
  FROM nodes WHERE total = 1
), upper_nodes AS (
  SELECT 0 AS level, place, total, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM upper_nodes WHERE total > 1 GROUP BY level, place // 2, total
), climb AS (
  SELECT lang, place AS leaf_place, 0 AS level, place, total, coalesce(changed, leaf) AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT c.lang, leaf_place, c.level + 1, c.place // 2, (c.total + 1) // 2,
         sha256(CASE WHEN c.place % 2 = 0 THEN folded || coalesce(n.digest, '') ELSE n.digest || folded END),
         proof || coalesce(n.digest, '')
  FROM climb c LEFT JOIN nodes n
    ON n.lang IS NOT DISTINCT FROM c.lang AND n.level = c.level AND n.place = xor(c.place, 1)
  WHERE c.total > 1
), upper_climb AS (
  SELECT c.lang, leaf_place, 0 AS level, s.place, s.total, folded, proof, s.digest AS subroot
  FROM climb c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang WHERE c.total = 1
  UNION ALL
  SELECT c.lang, leaf_place, c.level + 1, c.place // 2, (c.total + 1) // 2,
         sha256(CASE WHEN c.place % 2 = 0 THEN folded || coalesce(n.digest, '') ELSE n.digest || folded END),
         proof || coalesce(n.digest, ''), subroot
  FROM upper_climb c LEFT JOIN upper_nodes n ON n.level = c.level AND n.place = xor(c.place, 1)
  WHERE c.total > 1
)
SELECT p.doc_id, p.leaf, c.subroot, r.digest AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root,
       c.folded = r.digest AS verified
FROM placed p JOIN upper_climb c ON p.lang IS NOT DISTINCT FROM c.lang AND p.place = c.leaf_place AND c.total = 1,
     (SELECT digest FROM upper_nodes WHERE total = 1) r
"""
