"""Numbering of sent and received records, and comparison by number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from syncspark.operators.reconcile import repeat_rows
from syncspark.schemas import SENT_BUFFER_ROWS
from syncspark.workspace import stage

SEQ = "seq"
# Layout of monotonically_increasing_id: partition number above 33 row bits.
_ROW_BITS = 33


def assign_sequence(
    df: DataFrame, order: Sequence[str], start: int = 0, name: str = SEQ, unique: bool = True
) -> DataFrame:
    """Number all rows ``start + 1, start + 2, ...`` in ``order``.

    A window without partitions would sort everything in one task. Here rows
    are range partitioned by ``order``, sorted per partition and staged with
    their place in it; the sizes of the earlier partitions are then added. Only
    one size per partition is broadcast. ``df`` is evaluated twice, once to
    sample the ranges, so costly inputs are better staged before.

    Rows that share a position follow by a hash of their content, so that many
    of them are spread over several partitions. Where very many rows are equal in
    all columns, ``unique=False`` numbers the copies as one record with a count.
    The running total of the counts then takes one more shuffle: files keep the
    order of the staged rows, but no function without a window sums along it.
    """
    if unique:
        hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        rows = df.withColumn("_content", F.xxhash64(*hashed))
        by, size = [*order, "_content"], F.max("_at") + 1
    else:
        rows = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
        rows = rows.withColumn("_content", F.xxhash64(*df.columns))
        by = [*order, "_content", *(c for c in df.columns if c not in order)]
        size = F.sum("_copies")
    placed = (
        rows.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    numbered = (
        stage(placed, "sequence")
        .withColumn("_part", F.shiftright("_place", _ROW_BITS))
        .withColumn("_at", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .agg(size.alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    shifted = numbered.join(F.broadcast(offsets), "_part")
    first = F.lit(start).cast("long") + F.col("_before")
    if unique:
        return shifted.withColumn(name, first + F.col("_at") + 1).select(*df.columns, name)
    earlier = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    shifted = shifted.withColumn("_first", first + F.coalesce(F.sum("_copies").over(earlier), F.lit(0)))
    copies = repeat_rows(shifted.select(*df.columns, "_first", "_copies"), "_copies", index="_nth")
    return copies.withColumn(name, F.col("_first") + F.col("_nth")).select(*df.columns, name)


def copies_before(df: DataFrame, keys: Sequence[str], copies: str, name: str, hot: int = 1_000_000) -> DataFrame:
    """Number of earlier copies in the group of each distinct row.

    The order inside a group is free but fixed: by a hash of the content, then
    by the content. Groups of up to ``hot`` rows are numbered in one window.
    Larger ones, found by one count, are first cut into salts by that hash,
    summed inside each salt, and shifted by the sizes of the earlier salts; the
    numbers are the same.
    """
    columns = [c for c in df.columns if c != copies]
    to_previous = (Window.unboundedPreceding, -1)
    hashed = df.withColumn("_hash", F.xxhash64(*columns))
    sum_before = lambda window: F.coalesce(F.sum(copies).over(window.rowsBetween(*to_previous)), F.lit(0))
    small = sum_before(Window.partitionBy(*keys).orderBy("_hash", *columns))
    large = stage(df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot).select(*keys), "hot-groups")
    if large.isEmpty():
        return hashed.select(*df.columns, small.alias(name))
    named = large.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rest = hashed.join(named, same, "left_anti").select(*df.columns, small.alias(name))
    salted = hashed.join(named, same, "left_semi").withColumn("_salt", F.shiftright("_hash", 52))
    inside = sum_before(Window.partitionBy(*keys, "_salt").orderBy("_hash", *columns))
    across = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(*to_previous)
    sizes = salted.groupBy(*keys, "_salt").agg(F.sum(copies).alias("_size"))
    shifts = sizes.select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)),
        F.col("_salt").alias("_s"),
        F.coalesce(F.sum("_size").over(across), F.lit(0)).alias("_shift"),
    )
    placed = salted.withColumn("_inside", inside).join(shifts, same & (F.col("_salt") == F.col("_s")))
    return rest.union(placed.select(*df.columns, (F.col("_shift") + F.col("_inside")).alias(name)))


def latest_rows(df: DataFrame, order: Sequence[str] = (SEQ,), rows: int = SENT_BUFFER_ROWS) -> DataFrame:
    """The last ``rows`` records: a per-partition top-n, not a full sort."""
    return df.orderBy(*(F.desc(c) for c in order)).limit(rows)


def distinct_numbers(df: DataFrame, name: str = SEQ) -> DataFrame:
    return df.select(name).distinct()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last record of each key in ``order``.

    ``max_by`` keeps one record per key and map task before the shuffle, so a
    hot key costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return (
        df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_last")).select(*keys, "_last.*")
        .select(*df.columns)
    )


def missing_by_number(sent: DataFrame, received: DataFrame, name: str = SEQ) -> DataFrame:
    """Sent records, payload included, whose number was never received.

    Repeated numbers on the received side, as after a resend, do no harm.
    Numbers on the sent side are unique when they come from
    :func:`assign_sequence`; otherwise apply :func:`latest_per_key` first.
    """
    return sent.join(received.select(name), name, "left_anti").select(*sent.columns)


def _number_sets(df: DataFrame, name: str, alias: str) -> DataFrame:
    """The numbers of ``df`` as a bitmap for each range of 32,768."""
    known = df.filter(F.col(name).isNotNull())
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(name)).alias(alias)
    return known.groupBy(F.bitmap_bucket_number(name).alias("_bucket")).agg(bits)


def missing_by_bitmap(sent: DataFrame, received: DataFrame, name: str = SEQ) -> DataFrame:
    """Numbers sent and never received, each once; nulls and repeats do no harm.

    Numbers that lie close together, as sequence numbers do, travel as bitmaps:
    each map task sends one row per range of 32,768 numbers, and a range that
    arrived whole is settled by one comparison.
    """
    pairs = _number_sets(sent, name, "_sent").join(_number_sets(received, name, "_received"), "_bucket", "left")
    open_ = pairs.filter(F.col("_received").isNull() | (F.col("_sent") != F.col("_received")))
    byte = lambda bits, at: F.conv(F.hex(F.substring(bits, at + 1, F.lit(1))), 16, 10).cast("int")
    lost = lambda at: byte(F.col("_sent"), at).bitwiseAND(F.bitwise_not(F.coalesce(byte(F.col("_received"), at), F.lit(0))))
    places = F.sequence(F.lit(0), F.octet_length("_sent") - 1)
    bytes_ = open_.select("_bucket", F.posexplode(F.transform(places, lost)).alias("_byte", "_bits")).filter("_bits <> 0")
    each = bytes_.select("_bucket", "_byte", "_bits", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_bit"))
    place = F.col("_byte").cast("long") * 8 + F.col("_bit")
    # Ranges above zero begin with their second number, those below count downwards.
    number = F.when(F.col("_bucket") > 0, (F.col("_bucket") - 1) * 32_768 + place + 1).otherwise(F.col("_bucket") * 32_768 - place)
    return each.filter(F.getbit(F.col("_bits").cast("long"), F.col("_bit")) == 1).select(number.alias(name))
