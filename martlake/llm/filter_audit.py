"""How five filters on documents interact, in every order.

A document's failures are a mask of five bits; all figures of all 120 orders
follow from the number of documents with each mask in each part, so that
documents are counted once and not once for each order.

Filter E (the text of a smaller id) needs the whole table. A counting Bloom
filter goes before it: each text hashes to ``PROBES`` cells of a block, and the
counters of all tasks add up in Spark's partial aggregation. A text with a cell
that nothing else hit is unique for sure. Cells that several rows hit are handed on as
bitmaps, a row for each block; blocks are at most ``MOST_BLOCKS`` (128 MB of
bitmaps), a proven bound for their broadcast. Only texts whose cells are all
shared are shuffled, for the exact step: the smallest id of each full text.
From some 100 million rows on the filter clears fewer and fewer texts; more are
shuffled then, and the results stay exact.

Rows whose text repeats fail E unless they have the smallest id of their text.
Rows are aggregated by id, part and mask before they meet the smallest ids and
the labels, so that a row that repeats is one, and the counts by mask are
additive after that.

Defined results: null texts count as empty, null parts as an empty string; a row
without id never fails E and makes no other fail; rows that repeat with their id
count each time and don't fail for one another; of several labels of a document
the larger value counts; other columns are ignored; an empty table has no parts,
so no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import stored, text_or_empty

# fixed values of the filters
FILTERS = "ABCDE"
SHORT_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 3
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "[#$%&*|]"

BLOCK_BITS = 15  # cells of a block: as many as the bits of Spark's bitmaps
CELLS_PER_ROW, PROBES = 8, 2
MOST_BLOCKS = 1 << 15


def own_failures(text: Column) -> Column:
    """Mask of the filters A to D (1, 2, 4, 8) that ``text`` fails."""
    words = F.filter(F.split(text, "[ \t-\r]+"), lambda w: w != "")

    def by_words(w: Column) -> Column:
        distinct = F.size(F.array_distinct(w))
        return F.when(F.size(w) < SHORT_WORDS, 1).otherwise(0) + F.when(100 * distinct < DISTINCT_PERCENT * F.size(w), 2).otherwise(0)

    capitals = F.char_length(text) - F.char_length(F.translate(text, CAPITALS, ""))
    return (
        F.get(F.transform(F.array(words), by_words), F.lit(0))  # a lambda's variable: the words are made once
        + F.when(100 * capitals > CAPITALS_PERCENT * F.char_length(text), 4).otherwise(0)
        + F.when(text.rlike(SYMBOLS), 8).otherwise(0)
    )


def _cells(text: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a text, and its cells in the block."""
    h = F.xxhash64(text)
    low = (1 << BLOCK_BITS) - 1
    block = F.pmod(F.shiftrightunsigned(h, BLOCK_BITS * PROBES), F.lit(blocks)).cast("int")
    return block, [F.shiftrightunsigned(h, BLOCK_BITS * i).bitwiseAND(F.lit(low).cast("long")) for i in range(PROBES)]


def shared_cells(docs: DataFrame, blocks: int, text: str = "text") -> DataFrame:
    """_block and bits: the cells of each block that several rows hit; blocks without such a cell are absent."""
    block, cells = _cells(F.col(text), blocks)
    hits = docs.select(block.alias("_block"), F.explode(F.array_distinct(F.array(*cells))).alias("cell"))
    counters = hits.groupBy("_block", "cell").agg(F.count("*").alias("n"))
    return counters.filter("n > 1").groupBy("_block").agg(F.bitmap_construct_agg("cell").alias("bits"))


def with_possible_repeats(docs: DataFrame, blocks: int, text: str = "text") -> DataFrame:
    """Adds ``possible``: false only where no other row has the text."""
    block, cells = _cells(F.col(text), blocks)
    shared = stored(shared_cells(docs, blocks, text), "shared-cells")
    possible = F.col("bits").isNotNull()
    for cell in cells:
        byte = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright(cell, 3).cast("int") + 1, F.lit(1))), 16, 10)
        possible = possible & (F.getbit(byte.cast("long"), F.pmod(cell, F.lit(8)).cast("int")) == 1)
    probed = docs.withColumn("_block", block).join(F.broadcast(shared), "_block", "left")  # a row for each of at most MOST_BLOCKS blocks
    return probed.withColumn("possible", possible).drop("_block", "bits")


def failures(docs: DataFrame, part: str = "lang", most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """doc_id, part, mask of the failed filters A to E and the number n of such rows."""
    rows = docs.count()
    blocks = max(1, min(most_blocks, -(-rows * CELLS_PER_ROW >> BLOCK_BITS)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_or_empty().alias("text"))
    texts = with_possible_repeats(texts, blocks)
    digest = lambda text: F.unhex(F.sha2(text.cast("binary"), 256))
    keys = ["doc_id", "part", "mask", "digest"]
    marked = texts.select(
        "doc_id",
        "part",
        own_failures(F.col("text")).alias("mask"),
        F.when(F.col("possible") & F.col("doc_id").isNotNull(), digest(F.col("text"))).alias("digest"),
    )
    marked = stored(marked.groupBy(*keys).agg(F.count("*").alias("n")), "filter-marks")
    first = texts.filter(F.col("possible") & F.col("doc_id").isNotNull()).groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    first = first.select("doc_id", digest(F.col("text")).alias("digest"), F.lit(0).alias("later"))
    repeated = marked.filter("digest is not null").join(first, ["doc_id", "digest"], "left")
    repeated = repeated.withColumn("mask", F.col("mask") + F.coalesce("later", F.lit(16)))
    columns = ["doc_id", "part", "mask", "n"]
    return marked.filter("digest is null").select(*columns).unionByName(repeated.select(*columns))


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask and the numbers of rows (n), of good (good) and of toxic ones (toxic)."""
    is_one = lambda c: (F.max(F.col(c).cast("int")) == 1).alias(c)
    labels = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_one("quality"), is_one("toxic"))
    ids = failed.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    both = ids.join(labels, "doc_id", "left")
    labelled = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return both.groupBy("part", "mask").agg(F.sum("n").alias("n"), labelled("quality").alias("good"), labelled("toxic").alias("toxic"))


def _steps(rows: DataFrame) -> DataFrame:
    """``rows`` for all steps of all orders: filter_order, step from 1, the bit of its filter and the filters ``before`` as a mask."""
    orders = F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")
    rows = rows.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = lambda step: F.pow(F.lit(2), F.instr(F.lit(FILTERS), F.substring("filter_order", step, F.lit(1))) - 1).cast("int")
    earlier = lambda a, step: a + F.when(step < F.col("step"), bit(step)).otherwise(0)
    before = F.aggregate(F.sequence(F.lit(1), F.lit(len(FILTERS))), F.lit(0), earlier)
    return rows.withColumns({"bit": bit(F.col("step")), "before": before})


def audit(counts: DataFrame) -> DataFrame:
    """The figures of each part, order and step, of counts by mask."""
    masks = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # at most 32 in each part
    rows = _steps(masks)

    def total(condition, value=lambda m: m["n"]) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda a, m: a + F.when(condition(m["mask"]), value(m)).otherwise(0).cast("long"))

    fails = lambda mask: mask.bitwiseAND(F.col("bit")) != 0
    earlier = lambda mask: mask.bitwiseAND(F.col("before")) != 0
    removed = lambda mask: fails(mask) & ~earlier(mask)
    # of all orders, those where the filter comes first among those that the document fails
    orders = len(list(permutations(FILTERS)))
    credit = lambda m: m["n"] * F.floor(F.lit(orders) / F.bit_count(m["mask"]))
    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda mask: ~fails(mask) & ~earlier(mask)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda mask: fails(mask) & earlier(mask)).alias("redundant"),
        total(lambda mask: mask == F.col("bit")).alias("unique_fails"),
        total(removed, lambda m: m["good"]).alias("good_lost"),
        total(removed, lambda m: m["toxic"]).alias("toxic_lost"),
        total(fails, credit).alias("shapley"),
    )
