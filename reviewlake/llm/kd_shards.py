"""Shards of near-equal bytes by a k-d tree over the documents' metadata.

A node of the tree is split along its widest metadata dimension at the
byte-weighted median (a node of an odd number of shards at the matching
quantile), until every leaf is one shard.  All of it is DataFrame code:

* A dimension is a number, a time or the first six bytes of a string, scaled
  by its extent over the whole table, so that widths can be compared.  Of
  equally wide dimensions the one named first is taken.
* Within a node rows are ordered by a 60-bit key: the place along the
  dimension (28 bits of the node's extent), then a hash of id and text, so a
  value that a third of all rows share is split like any other.  Rows equal
  in both are told apart by a hash of their row number.
* The median is found exactly, for all nodes of a level at once, by digits:
  the bytes per value of a key's next 15 bits are summed, and the digit
  where the running sum crosses the goal is fixed.  Sums are combined before
  the shuffle; no row moves and nothing is sorted.  The row at the crossing
  goes to the side that leaves the smaller difference.
* Slots count a shard's rows in the order of that hash, which is a shuffle
  of the shard: rows are dealt into ranges of hash, each is numbered in one
  task, and the counts of the ranges before it are added.

Levels and passes are written to the shared folder, so a lost executor costs
tasks.  The state of a pass is one row per node; a level holds at most as
many nodes as there are shards.

Cases: a null text is empty; a null (or not finite) coordinate is the
smallest; ids may be null or repeated, and repeated rows are placed one by
one; a document is never cut, so shards differ by up to about the largest
document; with fewer rows than shards some shards are empty; an empty table
gives an empty result; equal texts are not kept together (a text in a third
of the rows would not fit in a shard); columns not named are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType

from reviewlake.llm.common import free_name, shuffle_partitions, stage

DIGIT, DIGITS = 15, 4            # bits of a digit, digits of a key
PLACE, TIE = 28, 32              # bits of the place and of the hash in a key
SLOT_ROWS = 50_000               # rows that one task numbers, about


def coordinate(docs: DataFrame, name: str) -> Column:
    """Column ``name`` as a finite double, or null."""
    kind, c = docs.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, StringType):
        head = F.rpad(F.substring(F.hex(c.cast("binary")), 1, 12), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    x = c.cast("double") if isinstance(kind, NumericType) else c.cast("timestamp").cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def rows_to_place(docs: DataFrame, id_col: str, text_col: str, dims: tuple[str, ...], row: Column) -> DataFrame:
    """(id, size, crc, row, tie, c0, c1, ...): what the tree works on."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    ident = F.col(f"`{id_col}`")
    slim = docs.select(ident.alias("id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("crc"), row.alias("row"),
                       *[coordinate(docs, d).alias(f"c{k}") for k, d in enumerate(dims)])
    name = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("crc"))
    return slim.withColumn("tie", F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long"))


def crossing(rows: DataFrame, key: str, goals: DataFrame) -> DataFrame:
    """Per node the key at which the running sum of sizes reaches its goal.

    ``goals``: node, goal, before (bytes already on the left).  Returns node,
    goal, prefix (that key), before (bytes of smaller keys) and n (rows of
    that key)."""
    state = goals.select("node", "goal", "before", F.lit(0).cast("long").alias("prefix"))
    for p in range(DIGITS):
        high, low = DIGIT * (DIGITS - p), DIGIT * (DIGITS - p - 1)
        hit = rows.join(state, "node").where(F.shiftright(key, high) == F.col("prefix"))
        digit = F.shiftright(key, low).bitwiseAND((1 << DIGIT) - 1).alias("digit")
        sums = hit.groupBy("node", "goal", "before", "prefix", digit).agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy("node").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)   # at most 32,768 rows a node
        run = sums.withColumn("after", F.col("before") + F.sum("w").over(upto)).where("after >= goal")
        first = run.groupBy("node").agg(F.min_by(F.struct("goal", "after", "w", "prefix", "digit", "n"), "digit").alias("f"))
        state = stage(first.select("node", "f.goal", (F.col("f.after") - F.col("f.w")).alias("before"),
                                   (F.shiftleft("f.prefix", DIGIT) + F.col("f.digit")).alias("prefix"), "f.n"), "kd-digit")
    return state


def split_level(rows: DataFrame, n_dims: int) -> DataFrame:
    """``rows`` (node: first shard below, parts: shards below) one level down."""
    spans = [F.max(f"c{k}") - F.min(f"c{k}") for k in range(n_dims)]
    nodes = rows.where("parts > 1").groupBy("node", "parts").agg(
        F.sum("size").alias("bytes"), F.array(*spans, F.lit(-1.0)).alias("spans"),
        F.array(*[F.min(f"c{k}") for k in range(n_dims)], F.lit(0.0)).alias("lows"))
    nodes = nodes.withColumn("left", F.expr("parts div 2")) \
                 .withColumn("goal", F.expr("bytes div parts * left + (bytes % parts) * left div parts")) \
                 .withColumn("dim", (F.array_position("spans", F.array_max("spans")) - 1).cast("int")) \
                 .select("node", "left", "goal", "dim", F.col("lows")[F.col("dim")].alias("low"), F.col("spans")[F.col("dim")].alias("span"))
    nodes = stage(nodes, "kd-nodes")
    x = F.array(*[F.col(f"c{k}") for k in range(n_dims)], F.lit(0.0))[F.col("dim")]
    place = F.when(F.col("span") > 0, F.floor((x - F.col("low")) / F.col("span") * ((1 << PLACE) - 1))).otherwise(0).cast("long")
    keyed = rows.join(nodes.drop("goal"), "node", "left") \
                .withColumn("key", F.when(F.col("left").isNotNull(), F.shiftleft(place, TIE) + F.col("tie"))).drop("dim", "low", "span")
    keyed = stage(keyed, "kd-keys")

    edge = crossing(keyed, "key", nodes.select("node", "goal", F.lit(0).cast("long").alias("before")))
    if (edge.agg(F.max("n")).first()[0] or 0) > 1:              # equal keys at a crossing: by row
        many = edge.where("n > 1").withColumnRenamed("prefix", "edge").drop("n")
        equal = keyed.join(many.select("node", "edge"), "node").where("key = edge")
        fine = crossing(equal, "mix", many.drop("edge")).select("node", F.col("before").alias("fine_before"), F.col("prefix").alias("fine"))
        edge = edge.join(fine, "node", "left").withColumn("before", F.coalesce("fine_before", "before")).drop("fine_before")
    else:
        edge = edge.withColumn("fine", F.lit(None).cast("long"))
    at = keyed.join(edge.select("node", "goal", "before", F.col("prefix").alias("edge"), "fine"), "node", "left")
    on_edge, fits = F.col("key") == F.col("edge"), 2 * F.col("before") + F.col("size") <= 2 * F.col("goal")
    goes_left = (F.col("key") < F.col("edge")) | (on_edge & F.coalesce(F.col("mix") < F.col("fine"), F.lit(False))) \
        | (on_edge & F.coalesce(F.col("mix") == F.col("fine"), F.lit(True)) & fits)
    node = F.when(F.col("left").isNull() | goes_left, F.col("node")).otherwise(F.col("node") + F.col("left")).cast("int")
    parts = F.when(F.col("left").isNull(), F.col("parts")).when(goes_left, F.col("left")).otherwise(F.col("parts") - F.col("left")).cast("int")
    return at.select(*[c for c in rows.columns if c not in ("node", "parts")], node.alias("node"), parts.alias("parts"))


def with_slots(rows: DataFrame, n_rows: int, shards: int) -> DataFrame:
    """``rows`` (node, tie, mix, ...) with ``slot``, gapless from 0 in a node."""
    spark = rows.sparkSession
    ranges = max(n_rows // SLOT_ROWS, 4 * shuffle_partitions(spark)) // shards + 1
    rows = rows.withColumn("range", F.shiftright(F.col("tie") * ranges, TIE).cast("int"))
    deal = rows.groupBy("node", "range").agg(F.ceil(F.count(F.lit(1)) / (4 * SLOT_ROWS)).alias("deals"))   # > 1: a repeated row
    rows = rows.join(stage(deal, "kd-ranges"), ["node", "range"]).withColumn("deal", F.pmod(F.col("mix"), F.col("deals")).cast("int"))
    cell = ["node", "range", "deal"]
    before = Window.partitionBy("node").orderBy("range", "deal").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = rows.groupBy(*cell).count().withColumn("start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    own = F.row_number().over(Window.partitionBy(*cell).orderBy("tie", "id", "crc", "size", "row"))
    return rows.withColumn("own", own).join(stage(starts, "kd-starts"), cell) \
               .withColumn("slot", (F.col("start") + F.col("own") - 1).cast("long")).drop("range", "deals", "deal", "start", "own")


def place(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id",
          text_col: str = "text", dims: tuple[str, ...] = ("lang", "source", "n_chars"), row: Column | None = None) -> DataFrame:
    """(id, size, crc, row, shard, slot) of every row of ``docs``.

    The number of shards is given, or follows from the bytes that one is to
    hold.  ``row``: a column that numbers the rows and does not change when
    ``docs`` is read again (else the numbers are this function's own)."""
    if (shards is None) == (target_bytes is None) or (shards or target_bytes) < 1:
        raise ValueError("give either shards or target_bytes, 1 or more")
    slim = rows_to_place(docs, id_col, text_col, dims, F.monotonically_increasing_id() if row is None else row)
    slim = slim.withColumns({"mix": F.xxhash64("row").bitwiseAND((1 << DIGIT * DIGITS) - 1), "node": F.lit(0)})
    slim = stage(slim, "kd-rows")                # the root's number is a column too, so that nodes are joined on a key
    seen = slim.agg(F.count(F.lit(1)), F.sum("size"),
                    *[f(f"c{k}") for k in range(len(dims)) for f in (F.min, F.max)]).first()      # one row
    if shards is None:
        shards = max(1, -(-(seen[1] or 0) // target_bytes))
    rows = slim
    for k in range(len(dims)):
        low, high = seen[2 + 2 * k], seen[3 + 2 * k]
        scaled = (F.col(f"c{k}") - F.lit(low)) / F.lit(high - low) if low is not None and high > low else F.lit(0.0)
        rows = rows.withColumn(f"c{k}", F.coalesce(scaled, F.lit(0.0)))
    rows = rows.withColumn("parts", F.lit(shards))
    for _ in range((shards - 1).bit_length()):
        rows = split_level(rows, len(dims))
    placed = stage(rows.select("id", "size", "crc", "row", "tie", "mix", "node"), "kd-placed")
    return with_slots(placed, seen[0], shards).select("id", "size", "crc", "row", F.col("node").alias("shard"), "slot")


def write_shards(docs: DataFrame, path: str, shards: int | None = None, target_bytes: int | None = None,
                 files: int = 1, **names) -> DataFrame:
    """Write ``docs`` as Parquet under ``path``, a folder per shard with at
    most ``files`` files, sorted by slot, and return it as read back: the
    given columns, then shard and slot (under a free name)."""
    row, chunk, shard, slot = (free_name(docs, n) for n in ("_row", "_chunk", "shard", "slot"))
    kept = stage(docs.withColumn(row, F.monotonically_increasing_id()), "kd-docs")
    where = place(kept, shards, target_bytes, row=F.col(row), **names)
    sizes = where.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    where = where.join(sizes, "shard").select(F.col("row").alias(row), F.col("shard").alias(shard), F.col("slot").alias(slot),
                                              F.floor(F.col("slot") * files / F.col("rows")).alias(chunk))
    out = kept.join(where, row).drop(row)
    out.repartition(shard, chunk).drop(chunk).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
    return docs.sparkSession.read.parquet(path).select(*[f"`{c}`" for c in docs.columns], shard, slot)
