"""Merkle manifest of a dataset, with membership proofs by content-addressed descent.

Every row is a leaf digest. Inside a group (a source) the leaves stand in key
order; every ``FAN`` consecutive nodes become the digest of their concatenation,
level by level, until one is left: the group's root. The group roots are leaves
of a last tree of the same kind, whose root names the whole dataset.

The manifest is a store of records ``digest -> children``: a record is found by
what it contains, so equal runs are one record and a changed row changes the
records on its way to the root and no others. A proof is a descent: a request
starts at the root, the digits of its rank to the base ``FAN`` choose a child at
every record, the children that were not chosen become a path segment, and the
segments in reverse order are the proof. Requests whose digits agree so far
travel as one, so a record is read once for all leaves below it, and only the
last step, inside a run of ``FAN`` leaves, makes a row for each request.

Defined results: a null value counts as ``-`` in a leaf and is told apart from
an empty one; null groups are one group and come first; null keys come first in
their group, equal keys in the order of their leaf digests (equal leaves can
change places without changing any digest); a group of one leaf has that leaf as
its root; a dataset of one group has its root; an empty table gives no rows;
further columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import ranked, scratch, written

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the values, each ``-`` if null, else its UTF-8 length, a colon and itself."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


@dataclass(frozen=True)
class Manifest:
    """A stored manifest: records by level, the group roots, and the root (null for an empty dataset)."""

    #: ``group, key, extra..., leaf, rank`` of every row.
    leaves: DataFrame
    #: levels[l - 1] holds ``digest, children`` of the records whose children are l - 1 steps above the leaves.
    levels: list[DataFrame]
    #: ``group, place, n, subroot`` of every group; ``place`` is its rank among the groups.
    groups: DataFrame
    #: Records above the group roots, as ``levels``.
    top: list[DataFrame]
    root: str | None


def _record(children: Column) -> Column:
    return F.sha2(F.concat_ws("", children), 256)


def _grow(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Records over ``nodes`` (``group, n, idx, digest``) level by level, and the node that remains of each group.

    ``n`` is the number of nodes of the group on the level, ``most`` the largest.
    """
    spark = nodes.sparkSession
    levels, ended = [], []
    while most > 1:
        ended.append(nodes.where("n = 1").select("group", "digest"))
        run = nodes.where("n > 1").groupBy("group", "n", F.expr(f"idx div {FAN}").alias("up"))
        # At most FAN children, whatever the size of the group.
        children = F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda c: c["digest"])
        path = scratch(spark, name)
        built = run.agg(children.alias("children")).withColumn("digest", _record(F.col("children")))
        built.write.option("compression", "zstd").parquet(path)
        built = spark.read.schema(built.schema).parquet(path)
        levels.append(built.select("digest", "children"))
        nodes = built.select("group", F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), F.col("up").alias("idx"), "digest")
        most = -(-most // FAN)
    ended.append(nodes.select("group", "digest"))
    left = ended[0]
    for more in ended[1:]:
        left = left.unionByName(more)
    return levels, left


def manifest(docs: DataFrame, *, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS,
             extra: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``extra`` names further columns, computed from a row, that its leaf row carries."""
    leaf = leaf_digest(*[F.col(f) for f in fields])
    carried = [c.alias(name) for name, c in (extra or {}).items()]
    # Texts are read once: what follows sorts and joins digests only.
    leaves = written(docs.select(F.col(group).cast("string").alias("group"), F.col(key).alias("key"), *carried, leaf.alias("leaf")), "leaves")
    leaves = ranked(leaves, ["group"], [F.col("key").asc_nulls_first(), F.col("leaf").asc()])
    sizes = written(leaves.groupBy("group").agg(F.count("*").alias("n")), "group-sizes")
    most = sizes.agg(F.max("n")).first()[0]
    if most is None:
        return Manifest(leaves, [], sizes.select("group", F.lit(0).alias("place"), "n", F.lit(None).cast("string").alias("subroot")), [], None)
    same = F.col("l.group").eqNullSafe(F.col("s.group"))
    nodes = leaves.alias("l").join(sizes.alias("s"), same).select("l.group", "s.n", F.col("l.rank").alias("idx"), F.col("l.leaf").alias("digest"))
    levels, subroots = _grow(nodes, most, "records")
    same = F.col("r.group").eqNullSafe(F.col("s.group"))
    groups = subroots.alias("r").join(sizes.alias("s"), same).select("r.group", "s.n", F.col("r.digest").alias("subroot"))
    groups = written(ranked(groups, [], [F.col("group").asc_nulls_first()], out="place"), "groups")
    count = groups.count()
    over = groups.select(F.lit(None).cast("string").alias("group"), F.lit(count).cast("bigint").alias("n"), F.col("place").alias("idx"), F.col("subroot").alias("digest"))
    top, root = _grow(over, count, "top-records")
    return Manifest(leaves, levels, groups, top, root.first()["digest"])


def _segment(children: Column, digit: Column) -> Column:
    """The children that were not chosen, as text before and after the chosen one."""
    before = F.concat_ws("", F.slice(children, F.lit(1), digit))
    after = F.concat_ws("", F.slice(children, digit + 2, F.lit(FAN)))
    return F.struct(before.alias("before"), after.alias("after"))


_PATH = "array<struct<before: string, after: string>>"


def _descend(frontier: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """One step down: ``group, n, idx, digest, path`` of the children that lead to a wanted node (``group, idx``)."""
    read = frontier.alias("f").join(records.select("digest", "children").distinct().alias("r"), F.col("f.digest") == F.col("r.digest"))
    read = read.select("f.group", "f.n", "f.idx", "f.path", "r.children", F.posexplode("r.children").alias("digit", "child"))
    path = F.concat("path", F.array(_segment(F.col("children"), F.col("digit"))))
    below = read.select("group", "n", (F.col("idx") * FAN + F.col("digit")).alias("idx"), F.col("child").alias("digest"), path.alias("path"))
    same = F.col("b.group").eqNullSafe(F.col("w.group")) & (F.col("b.idx") == F.col("w.idx"))
    return below.alias("b").join(wanted.alias("w"), same, "left_semi")


def _levels_above(n: Column, level: int) -> Column:
    """Whether a group of ``n`` leaves has a record ``level`` steps above its leaves."""
    return n > FAN ** (level - 1)


def proofs(made: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (rows of ``made.leaves``, all or some) plus ``subroot``, ``root`` and ``path``.

    ``path`` is the proof from the leaf up: an array of the siblings ``before``
    and ``after`` on every level, each the concatenated hex digests.
    """
    spark = requests.sparkSession
    named = requests.alias("q").join(made.groups.alias("g"), F.col("q.group").eqNullSafe(F.col("g.group")))
    named = named.select("q.*", "g.n", "g.place", "g.subroot")
    if made.root is None:
        return named.select(*requests.columns, "subroot", F.lit(None).cast("string").alias("root"), F.array().cast(_PATH).alias("path"))
    # From the root to the roots of the groups that are asked for.
    asked = named.select("place").distinct()
    whole = F.lit(None).cast("string").alias("group")
    start = [(made.root,)]
    frontier = spark.createDataFrame(start, "digest string").select(
        whole, F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("idx"), "digest", F.array().cast(_PATH).alias("path")
    )
    for level in range(len(made.top), 0, -1):
        wanted = asked.select(whole, F.expr(f"place div {FAN ** (level - 1)}").alias("idx")).distinct()
        frontier = _descend(frontier, made.top[level - 1], wanted)
    at = made.groups.alias("g").join(frontier.alias("f"), F.col("g.place") == F.col("f.idx"))
    # One row for each group that is asked for; written, since every level below takes some of them.
    waiting = written(at.select("g.group", "g.n", F.lit(0).cast("bigint").alias("idx"), "f.digest", "f.path"), "group-paths")
    # From the group roots to the records over the leaves; smaller groups join in where their root stands.
    deepest = len(made.levels)
    going = waiting.where(F.lit(False))
    for level in range(deepest, 1, -1):
        enters = _levels_above(F.col("n"), level) & ~_levels_above(F.col("n"), level + 1)
        wanted = named.where(_levels_above(F.col("n"), level)).select("group", F.expr(f"rank div {FAN ** (level - 1)}").alias("idx")).distinct()
        going = _descend(going.unionByName(waiting.where(enters)), made.levels[level - 1], wanted)
    lone = waiting.where("n = 1").select("group", F.lit(0).cast("bigint").alias("run"), "path", F.array("digest").alias("children"), F.lit(True).alias("lone"))
    last = going.unionByName(waiting.where(_levels_above(F.col("n"), 1) & ~_levels_above(F.col("n"), 2)))
    if deepest:
        records = made.levels[0].distinct().alias("r")
        last = last.alias("f").join(records, F.col("f.digest") == F.col("r.digest"))
        runs = last.select("f.group", F.col("f.idx").alias("run"), "f.path", "r.children", F.lit(False).alias("lone")).unionByName(lone)
    else:
        runs = lone
    # Inside a run: the requests of a run meet its record as one row.
    own = F.collect_list(F.struct(*requests.columns, "subroot")).alias("asked")
    together = named.groupBy("group", F.expr(f"rank div {FAN}").alias("run")).agg(own)
    same = F.col("t.group").eqNullSafe(F.col("r.group")) & (F.col("t.run") == F.col("r.run"))
    met = together.alias("t").join(runs.alias("r"), same).select("r.path", "r.children", "r.lone", F.explode("t.asked").alias("q"))
    digit = F.expr(f"int(q.rank % {FAN})")
    path = F.when(F.col("lone"), F.col("path")).otherwise(F.concat("path", F.array(_segment(F.col("children"), digit))))
    return met.select("q.*", F.lit(made.root).alias("root"), F.reverse(path).alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf digest and its proof."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a proof as one text, from the leaf up, left to right on each level."""
    return F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"])))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Records ``level, digest, children`` of a manifest saved by ``write_manifest``."""
    return spark.read.parquet(f"{path}/records")


def write_manifest(made: Manifest, path: str) -> None:
    """Save a manifest: ``records`` by level (each digest once), ``groups``, and ``root`` as a one-row table."""
    spark = made.leaves.sparkSession
    schema = "level int, digest string, children array<string>"
    records = spark.createDataFrame([], schema)
    for k, level in enumerate([*made.levels, *made.top], 1):
        records = records.unionByName(level.distinct().select(F.lit(k).alias("level"), "digest", "children"))
    records.write.option("compression", "zstd").parquet(f"{path}/records")
    made.groups.write.parquet(f"{path}/groups")
    spark.createDataFrame([(made.root,)], "root string").write.parquet(f"{path}/root")
