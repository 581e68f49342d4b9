"""Bottom-k sketches of word shingles: one small fingerprint a text, mergeable, in SQL functions only.

A fingerprint is the k least different hashes of a text's shingles, ascending, each as 16 hex
digits. Of two of them the k least hashes of both together are a fair sample of all shingles of both
texts, so the share of it that both hold estimates their resemblance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.frames import cut, texts_of

SHINGLE = 5
# Hashes that a fingerprint keeps. The standard error of a likeness of 0.6 is 0.04.
KEPT = 128
# Hex digits of a hash, of the 32 that a digest has.
DIGITS = 16
WORD = r"[\p{L}\p{N}]+"
# Ranges of neighbours that a partition of the sort is divided into, so that they can be dealt out evenly. Their bounds are one array.
TILES = 16
MOST_RANGES = 1 << 24


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def sketch(found: Column, width: int = SHINGLE, kept: int = KEPT) -> Column:
    """The fingerprint of an array of words; fewer than `width` of them are one shingle, none give an empty array.

    `found` is named many times here, so it should be a column and no longer expression.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size(found) - width, F.lit(0)))

    def shingle(i: Column) -> Column:
        held = F.concat_ws(" ", *[F.get(found, i + k if k else i) for k in range(width)])
        return F.substring(F.md5(held.cast("binary")), 1, DIGITS)

    least = F.slice(F.array_sort(F.array_distinct(F.transform(starts, shingle))), 1, kept)
    return F.when(F.size(found) > 0, least).otherwise(F.array().cast("array<string>"))


def merged(one: Column, other: Column, kept: int = KEPT) -> Column:
    """The fingerprint of all shingles that either fingerprint stands for, such as those of two parts of a text."""
    return F.slice(F.array_sort(F.array_union(one, other)), 1, kept)


def merge_all(frame: DataFrame, key: str, fingerprint: str, kept: int = KEPT) -> DataFrame:
    """One fingerprint for each key's parts: (key, fingerprint). Parts of parts are merged first, so a key may have any number.

    Equal hashes of a key collapse before they move, and only those that can be among the k least are kept: a hash is
    ranked within its task and key before the shuffle.
    """
    hashes = frame.select(key, F.explode_outer(fingerprint).alias("hash")).distinct()
    place = Window.partitionBy(key).orderBy(F.col("hash").asc_nulls_last())
    least = hashes.withColumn("place", F.row_number().over(place)).where(F.col("place") <= kept)
    return least.groupBy(key).agg(F.array_sort(F.collect_list("hash")).alias(fingerprint))


def resemblance(one: Column, other: Column, kept: int = KEPT) -> Column:
    """The estimated share of their joint shingles that both texts have; 1 for two texts without words."""
    both = merged(one, other, kept)
    shared = F.size(F.array_intersect(F.array_intersect(both, one), other))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def containment(one: Column, other: Column, kept: int = KEPT) -> Column:
    """The estimated share of the first text's shingles that the second one has, from the same sample; 1 if the first has none."""
    both = merged(one, other, kept)
    mine = F.array_intersect(both, one)
    share = F.size(F.array_intersect(mine, other)) / F.size(mine)
    return F.when(F.size(one) == 0, F.lit(1.0)).when(F.size(mine) == 0, F.lit(0.0)).otherwise(share)


def distinct_shingles(fingerprint: Column, kept: int = KEPT) -> Column:
    """The estimated number of different shingles; exact below `kept` of them."""
    last = F.element_at(fingerprint, -1)
    # The upper 13 digits are exact as a double and enough for the share of all hashes that lie below the last.
    share = (F.conv(F.substring(last, 1, 13), 16, 10).cast("double") + 1) / float(16**13)
    return F.when(F.size(fingerprint) < kept, F.size(fingerprint).cast("double")).otherwise((kept - 1) / share)


def fingerprints(documents: DataFrame, width: int = SHINGLE, kept: int = KEPT) -> DataFrame:
    """The fingerprint of each text: (doc_id, fingerprint). A null text is empty; repeated rows stay, other columns are ignored."""
    held = texts_of(documents).select("doc_id", words(F.col("text")).alias("words"))
    return held.select("doc_id", sketch(F.col("words"), width, kept).alias("fingerprint"))


def _entry() -> Column:
    """What entries are ordered by: null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")


def _bounds(entries: DataFrame) -> DataFrame:
    """One row: (bounds), the least entry of each range, ascending. entries: (doc_id, digest), each once.

    The ranges are TILES for each partition of a sort by Spark, so their number follows the session's partitions and not the rows.
    """
    spark = entries.sparkSession
    spread = entries.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("doc_id").isNull(), "doc_id", "digest")
    parts = spread.select(_entry().alias("entry"), F.spark_partition_id().alias("part"))
    tile = F.ntile(TILES).over(Window.partitionBy("part").orderBy("entry"))
    least = cut(parts.withColumn("tile", tile).groupBy("part", "tile").agg(F.min("entry").alias("entry")))
    return least.agg(F.array_sort(F.collect_list("entry")).alias("bounds"))


def _range_of(bounds: Column, entry: Column) -> Column:
    """The place of the last bound that is not above the entry, by halving."""
    strides = F.array(*[F.lit(1 << k) for k in range(MOST_RANGES.bit_length() - 1, -1, -1)])

    def further(at: Column, stride: Column) -> Column:
        return F.when(F.get(bounds, at + stride) <= entry, at + stride).otherwise(at)

    return F.aggregate(strides, F.lit(0), further)


def edited_fingerprints(documents: DataFrame, width: int = SHINGLE, kept: int = KEPT) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next document's are.

    The edited text has its last quarter (floor(n_chars / 4) code points) replaced by as many from the beginning of
    the next document, or all it has. Documents are in the order of their ids, null ids last, rows of one id in the order of their texts'
    digests; the first document follows the last. Returns doc_id, n_chars, edited_text, fingerprint, edited_fingerprint
    (arrays), near_edited, near_next.

    A null text is empty. Equal rows are one entry that is worked out once: each copy but the last has itself as the
    next document. A table of one row has itself as next. An empty table gives an empty table; other columns are ignored.

    Ids and digests alone are sorted first, which gives the bounds of many small ranges. Then whole texts move once, each
    to its range; the least of a range goes as a guest to the end of the range before it as well, where the last one
    finds it. Rows that repeat id and text, if there are any, are collapsed before that.
    """
    held = texts_of(documents).withColumn("digest", F.md5(F.col("text").cast("binary")))
    counted = cut(held.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("rows")))
    if counted.where("rows > 1").isEmpty():
        entries = held.withColumn("rows", F.lit(1).cast("long"))
    else:
        entries = held.groupBy("doc_id", "digest").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("rows"))

    bounds = _bounds(counted).scalar()
    placed = entries.select("*", _entry().alias("entry"), bounds.alias("bounds"))
    placed = placed.select("*", _range_of(F.col("bounds"), F.col("entry")).alias("range"))
    home = F.struct(F.col("range").alias("to"), F.lit(False).alias("guest"))
    away = F.struct(F.pmod(F.col("range") - 1, F.size("bounds")).alias("to"), F.lit(True).alias("guest"))
    first = F.get("bounds", F.col("range")) == F.col("entry")
    sent = placed.select("doc_id", "digest", "text", "rows", F.inline(F.when(first, F.array(home, away)).otherwise(F.array(home))))
    own = sent.repartition("to").withColumn("words", words(F.col("text")))
    own = own.select("*", sketch(F.col("words"), width, kept).alias("fingerprint"), F.char_length("text").alias("n_chars")).drop("words")

    order = Window.partitionBy("to").orderBy("guest", F.col("doc_id").isNull(), "doc_id", "digest")
    after = {"next_text": F.lead("text").over(order), "next_fingerprint": F.lead("fingerprint").over(order)}
    both = own.withColumns(after).where("NOT guest")
    last = F.struct(F.lit(1).cast("long").alias("copies"), F.col("next_text").alias("after"), F.col("next_fingerprint").alias("after_fingerprint"))
    others = F.struct((F.col("rows") - 1).alias("copies"), F.col("text").alias("after"), F.col("fingerprint").alias("after_fingerprint"))
    each = both.select("doc_id", "n_chars", "text", "fingerprint", F.inline(F.when(F.col("rows") > 1, F.array(last, others)).otherwise(F.array(last))))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - quarter), F.substring("after", F.lit(1), quarter))
    each = each.select("doc_id", "n_chars", "copies", "fingerprint", "after_fingerprint", edited.alias("edited_text"))
    each = each.withColumn("words", words(F.col("edited_text")))
    each = each.withColumn("edited_fingerprint", sketch(F.col("words"), width, kept))
    done = each.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "copies", "edited_text", "fingerprint", "edited_fingerprint",
        resemblance(F.col("fingerprint"), F.col("edited_fingerprint"), kept).alias("near_edited"),
        resemblance(F.col("fingerprint"), F.col("after_fingerprint"), kept).alias("near_next"),
    )
    return done.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copies", "copy")
