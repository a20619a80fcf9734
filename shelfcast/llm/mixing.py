"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source is wanted ``ratio = target / source size`` times.
The whole part is taken at once; the fraction ``p`` in [0, 1) is rounded by
the pivotal method: pair two documents, move probability from one to the
other at random until one of the two is 0 or 1, and go on with the one left
over.  The move keeps ``p_a * size_a + p_b * size_b``, so the words taken
from a source stay equal to its target up to the last document left, and a
document's expected copies stay its ratio.

The rounding is a reduction tree.  Documents of a source are dealt to
chunks of about ``CHUNK``; a chunk folds its documents in one expression and
leaves at most one fractional document; the leftovers of all chunks are
dealt again until a source has one chunk, where the last documents are
rounded one by one, the larger first, each making up for those before.  A source with a third of all rows is only more chunks.
Each level is written to the shared folder, so a lost executor repeats one
level's part at most.  A document is told from others by its id, source, size,
a hash of its text and, among rows equal in those, a number counted in two
steps (inside an input partition, and the equal rows of those before).  All
draws and chunks are hashes of that key and the level: reruns agree, and equal
rows are drawn each on their own.

Defined results: null text has size 0, a document of size 0 takes 0 words;
null sources form one source, last in order; a null ``doc_id`` is an id like
any other; rows equal in id, source and text are interchangeable.  An empty
table gives an empty result; if all sizes are 0 all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import small_side
from .common import read_table, shared_path, stored, uniform, word_array

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
CHUNK = 64
SEED = 20
KEY = ("doc_id", "source", "size", "t", "number")  # of a row; without the number, equal rows share it


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size) rows; one row a source.

    Sources in code point order, null last, weigh 1, 2, 3, 1, ...  Targets
    are ``least(3 * size, level * weight)`` for the one level at which they
    add up to all sizes: what a source cannot take is shared by the others
    by weight.  The level follows from running sums over the sources ordered
    by the level at which each is full (one row per source in that window).
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    slot = F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS)))
    weighted = totals.withColumn("weight", F.get(F.array(*[F.lit(w) for w in WEIGHTS]), slot.cast("int")).cast("double"))
    full = weighted.withColumn("limit", (F.col("source_size") * MAX_COPIES).cast("double"))
    full = full.withColumn("full_at", F.col("limit") / F.col("weight"))
    before = Window.orderBy("full_at", F.encode("source", "UTF-8")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("full_at", F.encode("source", "UTF-8")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    shared = full.select(
        "source", "source_size", "limit", "weight", "full_at",
        F.sum("source_size").over(everything).cast("double").alias("all_size"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_left"),
        F.coalesce(F.sum("limit").over(before), F.lit(0.0)).alias("taken_before"),
    )
    level = (F.col("all_size") - F.col("taken_before")) / F.col("weight_left")
    shared = shared.withColumn("level", F.when(level <= F.col("full_at"), level))
    shared = shared.withColumn("level", F.max("level").over(everything))  # the first that holds is the highest
    target = F.least("limit", F.col("level") * F.col("weight"))
    return shared.select("source", "source_size", F.coalesce(target, F.col("limit")).alias("target"))


_DOC = "struct<doc_id:bigint,source:string,size:bigint,source_size:bigint,target:double,t:bigint,number:bigint,row:bigint>"
_ROW = f"struct<doc:{_DOC},draw:double,p:double>"


def _settled(r: Column, p: Column) -> Column:
    return F.struct(r["doc"].alias("doc"), r["draw"].alias("draw"), p.alias("p"))


def _fold(rows: Column) -> Column:
    """Pivotal rounding of one chunk: struct(done array, left struct or null).

    ``rows`` holds structs (doc, draw, p).  ``left`` is the document whose
    probability is still fractional.
    """
    zero = F.struct(F.array().cast(f"array<{_ROW}>").alias("done"), F.lit(None).cast(_ROW).alias("left"))

    def step(acc: Column, b: Column) -> Column:
        a = acc["left"]
        sa, sb = a["doc"]["size"].cast("double"), b["doc"]["size"].cast("double")
        mass_a, mass_b = a["p"] * sa, b["p"] * sb
        room_a, room_b = (F.lit(1.0) - a["p"]) * sa, (F.lit(1.0) - b["p"]) * sb
        to_a, to_b = F.least(room_a, mass_b), F.least(room_b, mass_a)  # mass that can move each way
        up = b["draw"] * (to_a + to_b) < to_b  # towards a with chance to_b / (to_a + to_b): keeps the mean
        a_fills, b_fills = room_a <= mass_b, room_b <= mass_a
        zero_p, one_p = F.lit(0.0), F.lit(1.0)
        done = (
            F.when(up & a_fills, _settled(a, one_p)).when(up, _settled(b, zero_p))
            .when(b_fills, _settled(b, one_p)).otherwise(_settled(a, zero_p))
        )
        left = (
            F.when(up & a_fills, _settled(b, b["p"] - to_a / sb)).when(up, _settled(a, a["p"] + to_a / sa))
            .when(b_fills, _settled(a, a["p"] - to_b / sa)).otherwise(_settled(b, b["p"] + to_b / sb))
        )
        paired = F.struct(F.concat(acc["done"], F.array(done)).alias("done"), left.alias("left"))
        alone = F.struct(acc["done"].alias("done"), b.alias("left"))
        return F.when(a.isNull(), alone).otherwise(paired)

    return F.aggregate(rows, zero, step)


def _land(rows: Column) -> Column:
    """Rounding of a source's last chunk, in the type of ``_fold``.

    From the largest document to the smallest, each takes the mass that the
    rounding of those before still owes on top of its own, and is drawn from
    what that gives; so the smaller documents make up for the larger ones and
    the source misses its target by the size of a small document.
    """
    zero = F.struct(F.array().cast(f"array<{_ROW}>").alias("done"), F.lit(0.0).alias("owed"))
    largest_first = F.reverse(F.array_sort(
        F.transform(rows, lambda r: F.struct(r["doc"]["size"].alias("size"), r.alias("row")))))

    def step(acc: Column, item: Column) -> Column:
        r = item["row"]
        size = r["doc"]["size"].cast("double")
        mass = r["p"] * size + acc["owed"]
        took = F.when(r["draw"] * size < mass, F.lit(1.0)).otherwise(F.lit(0.0))
        return F.struct(F.concat(acc["done"], F.array(_settled(r, took))).alias("done"), (mass - took * size).alias("owed"))

    return F.aggregate(largest_first, zero, step, lambda acc: F.struct(
        acc["done"].alias("done"), F.lit(None).cast(_ROW).alias("left")))


def _level(rows: DataFrame, level: int) -> DataFrame:
    """One level of the tree: the fractional rows dealt to chunks and rounded."""
    key = [F.col(f"doc.{c}") for c in KEY]
    chunk = F.pmod(F.xxhash64(F.lit(SEED + 100 + level), *key), F.col("chunks"))
    item = F.struct(F.col("doc").alias("doc"), uniform(*key, seed=SEED + 200 + level).alias("draw"), F.col("p").alias("p"))
    grouped = rows.groupBy(F.col("doc.source").alias("__source"), chunk.alias("__chunk")).agg(
        F.sort_array(F.collect_list(item)).alias("items"),
        F.max("chunks").alias("chunks"),
    )
    items = F.col("items")
    return grouped.select(F.when(F.col("chunks") == 1, _land(items)).otherwise(_fold(items)).alias("folded"), "chunks")


def numbered(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``number``, 0, 1, ... among the rows equal in the rest of ``KEY``.

    ``row`` is different everywhere and has the input partition above bit 33.
    """
    equal = [c for c in KEY if c != "number"]
    sizes = sizes.withColumn("part", F.shiftright("row", 33))
    counts = sizes.groupBy(*equal, "part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy(*equal).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a partition for equal rows; only those that go on in another partition count before it.
    counts = counts.withColumn("earlier", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).where("earlier > 0")
    counts = stored(counts.select(*[F.col(c).alias(f"__{c}") for c in (*equal, "part")], "earlier"), "mix-equal")
    same = F.lit(True)
    for c in (*equal, "part"):
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    inside = F.row_number().over(Window.partitionBy(*equal, "part").orderBy("row")) - 1
    ranked = sizes.withColumn("inside", inside).join(small_side(counts), same, "left")
    return ranked.select(*equal, "row", (F.col("inside") + F.coalesce("earlier", F.lit(0))).cast("long").alias("number"))


def mix(docs: DataFrame, row: str | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) per row of ``docs``, and ``row`` if given.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are
    ignored.  ``row`` names a column with a ``monotonically_increasing_id``
    of each row.
    """
    spark = docs.sparkSession
    sizes = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.size(word_array(F.col("text"))).cast("long").alias("size"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("t"),
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
    ), "mix-sizes")
    targets = stored(source_targets(sizes), "mix-targets")
    sizes = stored(numbered(sizes), "mix-numbered")
    t = targets.select(F.col("source").alias("__s"), "source_size", "target")
    doc = F.struct("doc_id", "source", "size", "source_size", "target", "t", "number", "row")
    ratio = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    wanted = sizes.join(small_side(t), F.col("source").eqNullSafe(F.col("__s"))).select(
        doc.alias("doc"), F.when(F.col("size") == 0, F.lit(0.0)).otherwise(F.coalesce(ratio, F.lit(0.0))).alias("ratio"))
    whole = F.floor("ratio")
    start = wanted.select("doc", whole.cast("long").alias("whole"), (F.col("ratio") - whole).alias("p"))

    rows = start.where("p > 0").select("doc", "p")
    counts = rows.groupBy(F.col("doc.source").alias("__s")).agg(
        F.ceil(F.count("*") / F.lit(CHUNK)).cast("long").alias("chunks"))
    counts = stored(counts, "mix-chunks")
    most = counts.agg(F.max("chunks")).first()[0]
    decided = start.where("p <= 0").select("doc", F.lit(0.0).alias("p"))
    if most is not None:
        rows = rows.join(small_side(counts), F.col("doc.source").eqNullSafe(F.col("__s"))).select("doc", "p", "chunks")
        level = 0
        while True:
            path = shared_path(spark, f"mix-level{level}")
            _level(rows, level).write.parquet(path)
            folded = spark.read.parquet(path)
            decided = decided.unionByName(
                folded.select(F.explode("folded.done").alias("d")).select("d.doc", F.col("d.p").alias("p")))
            left = folded.where("folded.left is not null").select("folded.left.doc", "folded.left.p", "chunks")
            if most <= 1:
                break
            most = -(-most // CHUNK)
            level += 1
            rows = left.withColumn("chunks", F.ceil(F.col("chunks") / F.lit(CHUNK)).cast("long"))
    ratio = F.when(F.col("size") == 0, F.lit(0.0)).otherwise(F.coalesce(ratio, F.lit(0.0)))
    return decided.select("doc.*", "p").select(
        "doc_id", "source", "size", "source_size", "target", *([F.col("row").alias(row)] if row else []),
        (F.floor(ratio) + F.round("p")).cast("long").alias("copies"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``."""
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
