"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Every benchmark item is cut into windows of ``n`` consecutive words (a shorter
item is one window).  A document contains a window only if it contains the
window's rarest word, so that word alone is the window's join prefix:

1. count, over all documents, the words that occur in windows;
2. order each window's words by rarity; the rarest is its prefix token, and a
   window with a word that no document has can not occur and is dropped;
3. join document words with prefix tokens; the token's place in the window and
   the lengths of both sides bound where the window may lie;
4. verify the words at that place against the window exactly.

Windows of at most ``broadcast_bytes`` together are broadcast, without the items
that have them; the document side is then never shuffled before step 4, and its
word array never leaves the generated code of the scan stage.  More windows are
joined by a shuffle on the prefix token: only document words that are prefix
tokens take part, each with the words around it, and the documents are read no
more often than for few windows.  Which items a found window belongs to is
joined last, so an item list is only built per document.

Defined results: a null or word-less text has no words and is clean; a null
item id is not listed; texts of any length are read whole; equally rare words
rank by the word itself; repeated documents get equal rows; an empty table on
either side gives clean documents or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, lower_ascii, packed, row_key, same_key

#: Fixed value of the word rule: what separates words, ASCII other than letters and digits.
SEPARATORS = r"[[\W&&\p{ASCII}]_]+"


def raw_words(text: Column) -> Column:
    """Words of a text in their own case, as an array; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def item_windows(items: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``window`` (array of words) and ``item`` (id as string): each window of each item once."""
    w = items.select(F.col(id_col).cast("string").alias("item"), raw_words(lower_ascii(F.col(text_col))).alias("w"))
    return w.where(F.size("w") > 0).select(
        "item",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size("w") - (n - 1), F.lit(1))),
                lambda i: F.slice("w", i, n),
            )
        ).alias("window"),
    ).distinct()


def _document_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each word with its place, the document's words, and ``key``, the word in lower case.

    The outer form keeps Catalyst from adding a size filter that would split
    every text a second time; the null word of an empty text joins nothing.
    """
    d = docs.select(*row_key(id_col, text_col), raw_words(F.col(text_col)).alias("w"))
    d = d.select("_id", "_h", "w", F.posexplode_outer("w").alias("pos", "word"))
    return d.withColumn("key", F.lower("word"))


def _prefix_tokens(windows: DataFrame, doc_words: DataFrame, broadcast_bytes: int) -> DataFrame:
    """For each window that can occur: its rarest word (as ``key``) and that word's offset.

    Words are counted and joined in full lower case, which is a cheaper and
    coarser form than that of the windows; the exact form is verified later.
    """
    each = windows.select("window", F.posexplode("window").alias("off", "word")).withColumn("key", F.lower("word"))
    vocabulary = cut_lineage(each.select("key").distinct())
    counted = doc_words.select("key").join(_small(vocabulary, broadcast_bytes), "key").groupBy("key").agg(
        F.count(F.lit(1)).alias("n")
    )
    ranked = each.join(counted, "key", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "off")).alias("rarest")
    )
    return ranked.where("rarest.n > 0").select(
        F.col("rarest.key").alias("key"), F.col("rarest.off").alias("off"),
        F.array_join("window", " ").alias("window"), F.size("window").alias("len"),
    )


#: Bytes that a row takes in a broadcast besides its strings.
ROW_BYTES = 64


def _bytes(df: DataFrame) -> int:
    """What the rows of a written table would take in a broadcast."""
    strings = [F.octet_length(c) for c, t in df.dtypes if t == "string"]
    return df.agg(F.sum(sum(strings, F.lit(ROW_BYTES))).alias("n")).first()["n"] or 0


def _small(df: DataFrame, broadcast_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if it is within the bound, and as it is beyond."""
    return F.broadcast(df) if _bytes(df) <= broadcast_bytes else df


def occurrences(
    docs: DataFrame, items: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """Every place where a window lies in a document: ``_id, _h, start, len, window`` (0-based words; joined by spaces)."""
    windows = item_windows(items, item_id, item_text, n).select("window").distinct()
    return _placed(docs, windows, n, id_col, text_col, broadcast_bytes)


def _placed(docs: DataFrame, windows: DataFrame, n: int, id_col: str, text_col: str, broadcast_bytes: int) -> DataFrame:
    doc_words = _document_words(docs, id_col, text_col)
    prefix = cut_lineage(_prefix_tokens(windows, doc_words, broadcast_bytes))
    start, length = F.col("pos") - F.col("off"), F.col("len")
    if _bytes(prefix) <= broadcast_bytes:
        return (
            doc_words.join(F.broadcast(prefix), "key")
            .where((start >= 0) & (start + length <= F.size("w")))
            .where(lower_ascii(F.array_join(F.slice("w", start + 1, length), " ")) == F.col("window"))
            .select("_id", "_h", start.alias("start"), "len", "window")
        )
    keys = cut_lineage(prefix.select("key").distinct())
    first = F.greatest(F.col("pos") - (n - 1), F.lit(0))
    around = F.slice("w", first + 1, F.col("pos") - first + n)  # it ends with the document
    cut_out = ["_id", "_h", "key", "pos", first.alias("first"), around.alias("around")]
    if _bytes(keys) <= broadcast_bytes:
        met = doc_words.join(F.broadcast(keys), "key", "left_semi").select(*cut_out)
    else:  # a whole text must not travel with each of its words
        met = doc_words.select(*cut_out).join(keys.hint("merge"), "key", "left_semi")
    at = start - F.col("first")  # may lie before the first word that was cut out: then before the document
    inside = (at >= 0) & (at + length <= F.size("around"))
    return (
        met.join(prefix.hint("merge"), "key").where(inside)
        .where(lower_ascii(F.array_join(F.slice("around", at + 1, length), " ")) == F.col("window"))
        .select("_id", "_h", start.alias("start"), "len", "window")
    )


def contamination(
    docs: DataFrame, items: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per document: words, hit words, items found, and a digest of the item ids.

    Returns ``id_col, n_words, n_hit, n_items, items_sha256, contaminated``.
    """
    held = cut_lineage(item_windows(items, item_id, item_text, n))
    found = cut_lineage(
        _placed(docs, held.select("window").distinct(), n, id_col, text_col, broadcast_bytes)
    )
    hits = _covered(found).withColumnsRenamed({"_id": "_hid", "_h": "_hh"})
    listed = _items_found(found, held).withColumnsRenamed({"_id": "_iid", "_h": "_ih"})
    base = docs.select(
        *row_key(id_col, text_col),
        F.size(raw_words(F.col(text_col))).cast("long").alias("n_words"),
    )
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    joined = base.join(hits, F.col("_id").eqNullSafe(F.col("_hid")) & (F.col("_h") == F.col("_hh")), "left").join(
        listed, F.col("_id").eqNullSafe(F.col("_iid")) & (F.col("_h") == F.col("_ih")), "left"
    )
    covered = F.coalesce("covered", F.lit(0)).cast("long")
    return joined.select(
        F.col("_id").alias(id_col), "n_words", covered.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (covered > 0).alias("contaminated"),
    )


def _items_found(found: DataFrame, held: DataFrame) -> DataFrame:
    """Per document with hits: the sorted ids of the items that have its windows."""
    windows = held.where(F.col("item").isNotNull()).select(F.array_join("window", " ").alias("window"), "item")
    each = found.select("_id", "_h", "window").distinct().join(windows, "window")
    return each.groupBy("_id", "_h").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """``docs`` without the documents that contain a window of any item, columns as they were."""
    found = occurrences(docs, items, n, id_col, text_col, item_id, item_text, broadcast_bytes)
    hits = found.select("_id", "_h").distinct()
    keyed = packed(docs, *row_key(id_col, text_col))
    return keyed.join(hits, same_key(keyed, hits), "left_anti").select("_row.*")


def _covered(found: DataFrame) -> DataFrame:
    """Per document: length of the union of its hit ranges."""
    ranges = found.groupBy("_id", "_h", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = Window.partitionBy("_id", "_h").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(
        F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))), F.lit(0)
    )
    return ranges.select("_id", "_h", fresh.alias("fresh")).groupBy("_id", "_h").agg(F.sum("fresh").alias("covered"))
