"""A Merkle manifest of a table: digests of rows, joined in runs of eight up to one root, and proofs from it.

Rows of a group (a language) ascend by their key. The nodes of a level are joined eight by eight until one is
left, the group's subroot; the subroots, in the order of their groups, are joined likewise up to the root. The
manifest stores what each digest stands for: ``digest -> children``. A proof starts at the root and follows the
digits (base 8) of a row's rank down these records; at each it collects the children not taken. Requests that
share a prefix of digits go down as one row, so a record is met once and not once for each row below it.

Everything is DataFrame functions. Levels shrink by eight; there are as many as a rank has digits.

Defined results: NULL fields are hashed as ``-``; a NULL group comes first, a NULL key first in its group; rows with
one key are ordered by their digests, and repeated rows are leaves of their own. An empty table has an empty
manifest. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringspan.llm.scratch import Scratch

DIGIT_BITS = 3  # runs of eight
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest_of(values: Sequence[Column]) -> Column:
    """SHA-256 of fields written as byte count, colon and value; ``-`` for NULL."""
    texts = [value.cast("string") for value in values]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*fields), 256)


def _height(count: str) -> Column:
    """Levels above ``count`` nodes: the digits of the largest rank."""
    digits = F.ceil(F.length(F.bin(F.col(count) - 1)) / DIGIT_BITS).cast("int")
    return F.when(F.col(count) > 1, digits).otherwise(F.lit(0))


def _ranked(rows: DataFrame, group: str, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """Add ``at``, the rank in the group from 0, ``n``, the group's rows, and ``height``.

    Rows are sorted by ranges, so a group may hold any share of them; only counts per group and range are
    added up, and there are no more of those than ranges and groups.
    """
    placed = scratch.save(
        rows.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_seq")),
        "sorted",
    )
    here = placed.groupBy(group, "_part").agg(F.min("_seq").alias("_first"), F.count("*").alias("_size"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = here.select(
        group,
        "_part",
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
        F.sum("_size").over(whole).alias("n"),
    )
    return (
        placed.join(bases, [group, "_part"])
        .withColumn("at", F.col("_seq") + F.col("_base"))
        .withColumn("height", _height("n"))
        .drop("_part", "_seq", "_first", "_base")
    )


def _tallest(leaves: DataFrame) -> int:
    return leaves.agg(F.max("height")).first()[0] or 0


def _join_up(leaves: DataFrame, folder: str) -> list[DataFrame]:
    """Write the records of all levels above ``leaves`` (``lane, at, n, digest``), the lowest first."""
    spark, levels = leaves.sparkSession, []
    nodes = leaves.select("lane", "at", "n", "digest")
    for level in range(1, _tallest(leaves) + 1):
        run = F.sort_array(F.collect_list(F.struct("at", "digest")))
        parents = (
            nodes.where("n > 1")
            .groupBy("lane", F.shiftright("at", DIGIT_BITS).alias("at"))
            .agg(F.max("n").alias("n"), run["digest"].alias("children"))
            .select(
                "lane",
                "at",
                F.shiftright(F.col("n") + (1 << DIGIT_BITS) - 1, DIGIT_BITS).alias("n"),
                F.sha2(F.array_join("children", ""), 256).alias("digest"),
                "children",
            )
        )
        path = f"{folder}/{level:02d}"
        parents.write.parquet(path)
        levels.append(spark.read.schema(parents.schema).parquet(path))
        nodes = levels[-1].drop("children")
    return levels


@dataclass(frozen=True)
class Manifest:
    """``leaves``: ``lane, at, n, height, digest`` and the carried columns. ``records``, ``group_records``: a table
    for each level, the lowest first. ``groups``: a leaf of the upper tree for each group."""

    leaves: DataFrame
    records: list[DataFrame]
    groups: DataFrame
    group_records: list[DataFrame]


def write_manifest(
    docs: DataFrame,
    path: str,
    columns: Sequence[str] = COLUMNS,
    key: str = "doc_id",
    group: str = "lang",
    carry: Mapping[str, Column] | None = None,
) -> Manifest:
    """Digest every row of ``docs`` over ``columns`` and write the manifest below ``path``, a new shared folder.

    ``carry`` names values of the rows that are kept beside the leaves without being part of any digest. Texts
    are read once and never shuffled.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "merkle")
    group_value = F.col(f"`{group}`").cast("string")
    hashed = docs.select(
        F.col(f"`{key}`").alias("key"),
        # Orders as the group does, byte by byte and NULL first, and is never NULL.
        F.when(group_value.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), group_value)).alias("lane"),
        digest_of([F.col(f"`{c}`") for c in columns]).alias("digest"),
        *[value.alias(f"with_{name}") for name, value in (carry or {}).items()],
    )
    # Sorting by ranges looks at its input twice; saved digests spare the texts that.
    _ranked(scratch.save(hashed, "hashed"), "lane", ["key", "digest"], scratch).write.parquet(f"{path}/leaves")
    leaves = spark.read.parquet(f"{path}/leaves")
    records = _join_up(leaves, f"{path}/records")

    tops = leaves.where("n = 1").select("lane", "digest")
    for level in records:
        tops = tops.union(level.where("n = 1").select("lane", "digest"))
    # The groups are the leaves of one more tree.
    subroots = tops.select(F.lit("").alias("lane"), F.col("lane").alias("group"), "digest")
    _ranked(subroots, "lane", ["group"], scratch).write.parquet(f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")
    _join_up(groups, f"{path}/group_records")
    scratch.drop_all()
    return open_manifest(spark, path)


def open_manifest(spark: SparkSession, path: str) -> Manifest:
    """A manifest as ``write_manifest`` left it."""
    leaves, groups = (spark.read.parquet(f"{path}/{name}") for name in ("leaves", "groups"))

    def levels(rows: DataFrame, name: str) -> list[DataFrame]:
        kind = "lane string, at long, n long, digest string, children array<string>"
        return [spark.read.schema(kind).parquet(f"{path}/{name}/{at:02d}") for at in range(1, _tallest(rows) + 1)]

    return Manifest(leaves, levels(leaves, "records"), groups, levels(groups, "group_records"))


def root_of(manifest: Manifest) -> DataFrame:
    """``digest`` of the whole table: one row, none for an empty table."""
    top = manifest.group_records[-1] if manifest.group_records else manifest.groups
    return top.where("n = 1").select("digest")


def _descend(requests: DataFrame, roots: DataFrame, records: Sequence[DataFrame], scratch: Scratch) -> DataFrame:
    """Requests (``lane, at, height`` and their own columns) with ``found``, the digest at their place, ``path``,
    the segments from the root down, and the columns of ``roots`` (``lane, found, path, ..``)."""
    kept = [c for c in roots.columns if c not in ("lane", "found", "path")]
    wanted = [requests]
    for level in range(1, len(records)):
        prefixes = wanted[-1].where(F.col("height") > level).select(
            "lane", F.shiftright("at", DIGIT_BITS).alias("at"), "height"
        )
        wanted.append(scratch.save(prefixes.distinct(), "prefixes"))
    heights = requests.select("lane", "height").distinct()
    starts = scratch.save(roots.join(heights, "lane"), "roots")

    begin = [F.lit(0).cast("long").alias("node")]
    state = None
    for level in range(len(records), 0, -1):
        entering = starts.where(F.col("height") == level).select("lane", *begin, "found", "path", *kept)
        state = entering if state is None else state.unionByName(entering)
        store = records[level - 1].select(F.col("digest").alias("found"), "children").dropDuplicates(["found"])
        opened = state.join(store, "found").drop("found")
        asked = wanted[level - 1].where(F.col("height") >= level)
        asked = asked.withColumn("node", F.shiftright("at", DIGIT_BITS))
        digit = (F.col("at") - F.shiftleft("node", DIGIT_BITS)).cast("int")
        rest = F.size("children")
        segment = F.struct(
            F.array_join(F.slice("children", F.lit(1), digit), "").alias("left"),
            F.array_join(F.slice("children", digit + 2, rest), "").alias("right"),
        )
        taken = asked.join(opened, ["lane", "node"]).withColumns(
            {"found": F.get("children", digit), "path": F.concat("path", F.array(segment))}
        )
        if level > 1:
            state = taken.select("lane", F.col("at").alias("node"), "found", "path", *kept)
    alone = requests.where("height = 0").join(starts.drop("height"), "lane")
    if state is None:
        return alone
    return taken.drop("node", "children").unionByName(alone)


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Rows of ``manifest.leaves`` (all of them unless given) with ``subroot``, ``root``, and ``path``: the segments
    ``left, right`` of sibling digests on the way from the leaf up to the root."""
    scratch = Scratch(manifest.leaves.sparkSession, "proofs")
    requests = manifest.leaves if requests is None else requests
    top = root_of(manifest).select(
        F.lit("").alias("lane"),
        F.col("digest").alias("found"),
        F.array().cast(PATH).alias("path"),
        F.col("digest").alias("root"),
    )
    groups = manifest.groups.select("lane", "at", "height", "group")
    roots = _descend(groups, top, manifest.group_records, scratch).select(
        F.col("group").alias("lane"), "found", "path", F.col("found").alias("subroot"), "root"
    )
    found = _descend(requests, scratch.save(roots, "subroots"), manifest.records, scratch)
    return found.withColumn("path", F.reverse("path")).drop("n", "height")


def siblings(path: str = "path") -> Column:
    """All siblings on a path, from the leaf up, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: str, path: str = "path") -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(
        path, F.col(leaf), lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256)
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered_digest(columns: Sequence[str] = COLUMNS, key: str = "doc_id", text: str = "text") -> Column:
    """The digest of a row that lost its capitals if 3 divides the checksum of its key, else its own."""
    whole = F.col(f"`{text}`")
    # A text of single bytes has no other letters that lower() would change.
    plain = F.octet_length(whole) == F.length(whole)
    lowered = F.when(plain, F.lower(whole)).otherwise(F.translate(whole, _UPPER, _LOWER))
    changed = digest_of([lowered if c == text else F.col(f"`{c}`") for c in columns])
    own = digest_of([F.col(f"`{c}`") for c in columns])
    return F.when(F.crc32(F.col(f"`{key}`").cast("string")) % 3 == 0, changed).otherwise(own)


def manifest_report(docs: DataFrame, path: str) -> DataFrame:
    """Write a manifest of ``docs``, prove every row, and check a copy in which some texts were tampered with:
    ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``."""
    proofs = prove(write_manifest(docs, path, carry={"presented": tampered_digest()}))
    return proofs.select(
        F.col("key").alias("doc_id"),
        F.col("found").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings(), 256).alias("proof_sha256"),
        fold("with_presented").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
