"""Benchmark decontamination with SimHash over windows of the items' sizes.

Texts become words: lower-cased runs of letters and digits. A window has as
many words as the item it may hold. A window that reaches the similarity shares
shingles with its item, so windows are laid only where a shingle of an item
occurs, at the start which that occurrence implies (moved inside the text; a
shorter text is one window), and meet the items of that shingle only. For a
single run of matches no other window has more of the item's shingles.

Window and item are candidates if the SimHash of their words (by multiplicity)
differs in at most ``radius`` of 64 bits; the fingerprints are cut into
``radius + 1`` blocks, one of which then agrees, so a join of the item's blocks
finds every such pair. Candidates are verified exactly: their five-word
shingles, as multisets, must reach the similarity (sum of the smaller over sum
of the larger counts).

The radius is wide, as the items' shingles keep the windows few: at similarity
0.8 about a ninth of a window's words are others, which moves some 10 of the 64
bits, rarely more than 16 and, in tests with tens of thousands of copies cut to
just 0.8, never more than 24. No fixed radius below 64 is a proof.

Everything is DataFrame functions. Item shingles are broadcast up to
``broadcast_rows`` of them; then only windows leave the scan, and a window's
words are compared once however many documents hold them. Beyond that, hits
are found by a shuffled join of hashes, and the texts that have hits are joined
back.

Documents of any length are handled whole, in one row; an empty table gives no
rows. A null or empty text has no words and is clean; so is every text if there
are no items. An item without words matches nothing; one with fewer than five words
is one shingle, and a text is contaminated if it has a window with just these
words. Ids may be null or repeat: the result has a row for every row. Other
columns are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import keep

WORDS = 5


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _positions(column: str, shingle: int) -> Column:
    """Where shingles start: 0 alone in a sequence shorter than one, nowhere in an empty one."""
    return F.expr(f"IF(size({column}) = 0, NULL, sequence(0, greatest(size({column}) - {shingle}, 0)))")


def _hash_at(column: str, at: str, shingle: int) -> Column:
    """The hash of the shingle at a position; words beyond the end count as nulls."""
    return F.expr(f"xxhash64({', '.join(f'get({column}, {at} + {k})' for k in range(shingle))})")


def _shingles(column: str, shingle: int) -> Column:
    return F.expr(
        f"transform(sequence(1, greatest(size({column}) - {shingle - 1}, 1)), i -> array_join(slice({column}, i, {shingle}), ' '))"
    )


def simhash(column: str) -> Column:
    """A bit is 1 if over half of the words' hashes have it."""
    counts = (
        f"transform(sequence(0, 63), b -> aggregate({column}, 0, "
        "(n, w) -> n + CAST(shiftright(xxhash64(w), b) & 1L AS INT)))"
    )
    return F.expr(
        f"aggregate({counts}, named_struct('f', 0L, 'b', 0), (a, n) -> named_struct("
        f"'f', a.f | IF(2 * n > size({column}), shiftleft(1L, a.b), 0L), 'b', a.b + 1), a -> a.f)"
    )


def block_keys(fp: str, radius: int) -> Column:
    """One (block, bits) per block of the fingerprint; ``radius + 1`` of them."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    keys = []
    for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        mask = -1 if hi - lo == 64 else (1 << (hi - lo)) - 1
        bits = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit(mask).cast("long"))
        keys.append(F.struct(F.lit(i).alias("block"), bits.alias("bits")))
    return F.array(*keys)


def matches(
    docs: DataFrame,
    items: DataFrame,
    *,
    similarity: float = 0.8,
    radius: int = 24,
    shingle: int = WORDS,
    broadcast_rows: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, digest, item_id, start, n_words, similarity``: windows that hold an item.

    ``start`` counts words from 0. ``digest`` tells texts apart that share an
    id. Equal rows are told once.
    """
    if not 0 <= radius <= 63:
        raise ValueError("radius must be 0 to 63")
    known = items.select(F.col(item_id_col).alias("item_id"), words(item_text_col).alias("w")).where("size(w) > 0").distinct()
    known = keep(known, "items")
    each = known.select("item_id", "w", F.size("w").alias("m"), F.explode(_positions("w", shingle)).alias("j"))
    grams = keep(each.select("item_id", "m", "j", _hash_at("w", "j", shingle).alias("h")).distinct(), "item-shingles")
    small = grams.count() <= broadcast_rows

    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("digest"), words(text_col).alias("w")
    )
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("j"), F.size("w") - F.col("m"))).alias("start")
    window = F.array_join(F.slice("w", F.col("start") + 1, F.col("m")), " ").alias("window")
    # Items of fewer words are met by shingles of their own length.
    short = [r.m for r in known.select(F.size("w").alias("m")).where(F.col("m") < shingle).distinct().collect()]
    hits = [_hits(texts, grams, n, small) for n in [shingle, *sorted(short)]]
    hit = reduce(DataFrame.unionByName, hits)
    placed = hit.select("doc_id", "digest", "item_id", "m", "w", start).select("doc_id", "digest", "item_id", "m", "start", window)
    placed = keep(placed.distinct(), "windows")

    # A window is compared once with an item however many documents hold it. Item ids may be null.
    item = [F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_slot"), "m"]
    met = placed.select(*item, "window").distinct().withColumn("w", F.split("window", " ", -1))
    prints = keep(met.withColumn("fp", simhash("w")), "window-prints")
    targets = keep(known.select("item_id", "w", F.size("w").alias("m"), simhash("w").alias("fp")), "item-prints")
    left = prints.select("item_slot", "m", "window", "fp", F.explode(block_keys("fp", radius)).alias("k"))
    right = targets.select(*item, "item_id", F.col("w").alias("item"), F.col("fp").alias("item_fp"), F.explode(block_keys("fp", radius)).alias("k"))
    pairs = (
        left.join(F.broadcast(right) if small else right, ["item_slot", "m", "k"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
        .select("item_slot", "m", "window", "item")
        .distinct()
    )
    pairs = keep(pairs.withColumn("pair", F.monotonically_increasing_id()), "pairs")
    of_window = pairs.select("pair", F.split("window", " ", -1).alias("w"))
    sides = [
        pairs.select("pair", F.explode(_shingles("item", shingle)).alias("s"), F.lit(1).alias("a"), F.lit(0).alias("b")),
        of_window.select("pair", F.explode(_shingles("w", shingle)).alias("s"), F.lit(0).alias("a"), F.lit(1).alias("b")),
    ]
    counts = sides[0].unionByName(sides[1]).groupBy("pair", "s").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    same = counts.groupBy("pair").agg((F.sum(F.least("a", "b")) / F.sum(F.greatest("a", "b"))).alias("similarity"))
    checked = (
        pairs.join(same.where(F.col("similarity") >= similarity), "pair")
        .groupBy("item_slot", "m", "window")
        .agg(F.max("similarity").alias("similarity"))
    )
    return placed.select("*", item[0]).join(checked, ["item_slot", "m", "window"]).select(
        "doc_id", "digest", "item_id", "start", F.col("m").alias("n_words"), "similarity"
    )


def _hits(texts: DataFrame, grams: DataFrame, length: int, small: bool) -> DataFrame:
    """``doc_id, digest, w, pos, item_id, m, j``: where texts have a shingle of an item.

    Positions are exploded and hashed in generated code, with the join. The
    outer explode keeps Catalyst from inferring a filter on their number, which
    it would push below the projection, words and all.
    """
    rows = texts.select("doc_id", "digest", "w", F.explode_outer(_positions("w", length)).alias("pos")).where("pos IS NOT NULL")
    hashed = rows.withColumn("h", _hash_at("w", "pos", length))
    if small:
        return hashed.join(F.broadcast(grams), "h").select("doc_id", "digest", "w", "pos", "item_id", "m", "j")
    narrow = hashed.select("doc_id", "digest", "pos", "h").join(grams, "h").drop("h").distinct().alias("n")
    same = F.col("n.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("n.digest") == F.col("t.digest"))
    return narrow.join(texts.distinct().alias("t"), same).select("t.doc_id", "t.digest", "t.w", "n.pos", "n.item_id", "n.m", "n.j")


def decontaminate(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, contaminated, items, n_items, similarity`` for every row.

    ``items`` lists the ids of the items found, ascending; ``similarity`` is the
    largest (0 if none). ``options`` are those of ``matches``.
    """
    found = matches(docs, items, id_col=id_col, text_col=text_col, **options)
    each = found.groupBy("doc_id", "digest").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"), F.max("similarity").alias("similarity")
    )
    each = keep(each, "contaminated").alias("f")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("digest")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.digest") == F.col("f.digest"))
    return rows.join(each, same, "left").select(
        F.col("d.doc_id").alias("doc_id"),
        F.col("f.items").isNotNull().alias("contaminated"),
        F.coalesce("f.items", F.expr("CAST(array() AS ARRAY<BIGINT>)")).alias("items"),
        F.coalesce(F.size("f.items"), F.lit(0)).alias("n_items"),
        F.coalesce("f.similarity", F.lit(0.0)).alias("similarity"),
    )


def clean(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows in which no item was found, with all their columns."""

    def slot(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("null")).alias("slot")

    found = matches(docs, items, id_col=id_col, text_col=text_col, **options)
    found = keep(found.select(slot("doc_id"), "digest").distinct(), "contaminated")
    digest = F.xxhash64(F.col(text_col).cast("string")).alias("digest")
    rows = docs.select(F.struct("*").alias("row"), slot(id_col), digest)
    return rows.join(found, ["slot", "digest"], "left_anti").select("row.*")
