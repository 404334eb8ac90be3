"""Benchmark decontamination by templates, also for re-parameterised questions.

Texts are reduced to words; numbers, names (capitalised words inside a
sentence) and units become typed placeholders. All windows of five words of
the documents are joined by hash with those of the benchmark. A document
leaks an item if it holds at least 0.8 of the item's distinct windows in
consistent places: within one alignment of document and item (the distance
between the places of a window in both), one value of the item must always
stand for one value of the document; or if it holds, within one such alignment, a
run of at least 13 words that windows of a benchmark row cover without a gap
(all that its windows cover, if that is less), however small the share. Such
an item is in the result with its share. DataFrame functions only.

With ``verbatim``, as in ``without_leaks``, a window also matches if its words
are the same in lower case, whatever looks like a name, and a value with two
counterparts in an alignment drops only the template windows that hold it.

Windows with fewer than two ordinary words say nothing and take no part. An
item without any window (too short, or placeholders only) matches nothing.

Cases: a null or empty text has no window; repeated rows and equal ids are
told apart by row number; repeated benchmark rows count as one item each
item_id (rows without item_id as one item); empty tables give an empty
result; other columns, whatever their names, are carried in a struct.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricekit.llm._stage import staged

WINDOW, THRESHOLD, LITERALS = 5, 0.8, 2
#: So many words in a row are a leak, whatever the share of the item.
RUN = 13
#: The benchmark's windows are broadcast up to this number (at most 40 bytes each), else shuffled.
BROADCAST_ROWS = 1_000_000
# Words that count as units.
UNITS = ("kg", "mg", "km", "cm", "mm", "ml", "mph", "kmh", "lb", "lbs", "oz", "ft", "usd", "eur", "gbp", "percent",
         "dollar", "dollars", "euro", "euros", "cent", "cents", "pound", "pounds", "meter", "meters", "metre", "metres",
         "kilometer", "kilometers", "mile", "miles", "litre", "litres", "liter", "liters", "gram", "grams", "kilogram",
         "kilograms", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month",
         "months", "year", "years", "degree", "degrees")
NAME = "__"


def words(text: Column) -> Column:
    """Lower-case words; names carry a mark, the parts of one number are one word."""
    marked = F.regexp_replace(text, r"([\p{Ll},;] )(\p{Lu}\p{Ll}+)", "$1" + NAME + "$2")
    number = F.when(marked.rlike("[0-9][.,][0-9]"), F.regexp_replace(marked, "([0-9])[.,]([0-9])", "$1_$2")).otherwise(marked)
    return F.split(F.trim(F.regexp_replace(F.lower(number), r"[^\p{L}\p{N}_]+", " ")), " ")


def _is_slot(word: Column) -> Column:
    return word.startswith(NAME) | ((word >= "0") & (word < ":"))


def _typed(word: Column) -> Column:
    return (F.when(word.startswith(NAME), "<name>").when((word >= "0") & (word < ":"), "<num>")
            .when(word.isin(*UNITS), "<unit>").otherwise(word))


def windows(df: DataFrame, key: str, text: Column, size: int = WINDOW) -> DataFrame:
    """``(key, at, window, slots)`` of all windows with enough ordinary words; slots: the placeholders' own words."""
    split = df.select(F.col(key), words(text).alias("w"))
    each = split.select(key, "w", F.explode(F.when(F.size("w") >= size, F.sequence(F.lit(0), F.size("w") - size))).alias("at"))
    here = [F.get("w", F.col("at") + k) for k in range(size)]
    plain = reduce(lambda a, b: a + b, [F.when(_is_slot(x) | x.isin(*UNITS), 0).otherwise(1) for x in here])
    return (each.filter(plain >= LITERALS)
            .select(key, "at", F.xxhash64(*[_typed(x) for x in here]).alias("window"),
                    F.concat_ws(" ", *[F.when(_is_slot(x), x) for x in here]).alias("slots")))


def _both(df: DataFrame, key: str, text: Column, size: int, every: bool) -> DataFrame:
    """As ``windows``, with the plain window beside each, and the template of both; ``every``: plain windows of all words."""
    each = df.select(F.col(key), words(text).alias("w")).select(
        key, "w", F.explode(F.when(F.size("w") >= size, F.sequence(F.lit(0), F.size("w") - size))).alias("at"))
    here = [F.get("w", F.col("at") + k) for k in range(size)]
    enough = reduce(lambda a, b: a + b, [F.when(_is_slot(x) | x.isin(*UNITS), 0).otherwise(1) for x in here]) >= LITERALS
    bare = F.xxhash64(F.lit("="), *[F.regexp_replace(x, "^" + NAME, "") for x in here])
    named = each.select(key, "at", F.when(enough, F.xxhash64(*[_typed(x) for x in here])).alias("template"), bare.alias("bare"),
                        F.concat_ws(" ", *[F.when(_is_slot(x), x) for x in here]).alias("own"))
    pair = F.array(F.struct(F.col("template").alias("window"), F.col("own").alias("slots")),
                   F.struct(F.col("bare").alias("window"), F.lit("").alias("slots")))
    named = named if every else named.filter(F.col("template").isNotNull())
    return named.select(key, "at", "template", F.explode(pair).alias("p")).select(key, "at", "template", "p.*").filter("window IS NOT NULL")


def leaks(docs: DataFrame, benchmark: DataFrame, row: str = "row", text: Column | str = "text",
          item_col: str = "item_id", item_text: str = "text", size: int = WINDOW,
          threshold: float = THRESHOLD, run: int = RUN, verbatim: bool = False) -> DataFrame:
    """``(row, item, matched, total, similarity)`` of documents and the items they leak.

    ``row`` must be unique in ``docs``. ``verbatim``: plain windows count too (see above).
    """
    text = F.col(text) if isinstance(text, str) else text
    each = F.struct(F.monotonically_increasing_id().alias("row"), F.col(item_col).alias("item")).alias("key")
    def named(df, key, every):
        if verbatim:
            return _both(df, key, F.col("t"), size, every)
        return windows(df, key, F.col("t"), size).withColumn("template", F.col("window"))

    items = staged(named(benchmark.select(each, F.col(item_text).alias("t")), "key", False)
                   .select("key.item", F.col("key.row").alias("item_row"), F.col("at").alias("item_at"), "window",
                           F.col("slots").alias("item_slots"), "template"), "benchmark")
    covered = items.groupBy("item_row").agg((F.max("item_at") - F.min("item_at") + size).alias("covered"))
    total = items.groupBy("item").agg(F.count_distinct("template").alias("total"))
    keyed = items.select("window").distinct()
    few = keyed.count() <= BROADCAST_ROWS
    found = named(docs.select(F.col(row).alias("row"), text.alias("t")), "row", True).drop("template")
    hits = staged(found.join(F.broadcast(keyed) if few else keyed, "window", "left_semi"), "hits").join(items, "window")
    diagonal = F.col("at") - F.col("item_at")
    hits = hits.select("row", "item", "item_row", "at", "template", diagonal.alias("diagonal"), "slots", "item_slots")
    pairs = (hits.select("row", "item", "diagonal",
                         F.explode(F.arrays_zip(F.split("item_slots", " ").alias("theirs"), F.split("slots", " ").alias("ours"))).alias("p"))
             .select("row", "item", "diagonal", "p.theirs", "p.ours").distinct()
             .groupBy("row", "item", "diagonal", "theirs").agg(F.count("*").alias("n"))
             .groupBy("row", "item", "diagonal").agg(F.max("n").alias("values"), F.collect_set(F.when(F.col("n") > 1, F.col("theirs"))).alias("clashing")))
    same = (F.col("h.row") == F.col("p.row")) & F.col("h.item").eqNullSafe(F.col("p.item")) & (F.col("h.diagonal") == F.col("p.diagonal"))
    if verbatim:
        good = (hits.alias("h").join(pairs.alias("p"), same)
                .filter(~F.arrays_overlap(F.split("h.item_slots", " "), F.col("p.clashing"))).select("h.*"))
    else:
        good = hits.alias("h").join(pairs.filter("values = 1").alias("p"), same, "left_semi")
    matched = good.select("row", "item", "template").distinct().groupBy("row", "item").agg(F.count("*").alias("matched"))
    # windows at most their size apart leave no word between them
    order = Window.partitionBy("row", "item_row", "diagonal").orderBy("at")
    runs = (good.select("row", "item", "item_row", "diagonal", "at",
                        F.when(F.col("at") - F.lag("at").over(order) <= size, 0).otherwise(1).alias("new"))
            .withColumn("island", F.sum("new").over(order))
            .groupBy("row", "item", "item_row", "diagonal", "island").agg((F.max("at") - F.min("at") + size).alias("words"))
            .join(covered, "item_row").filter(F.col("words") >= F.least(F.lit(run), F.col("covered")))
            .select("row", "item").distinct())
    return (matched.alias("m").join(total.alias("t"), F.col("m.item").eqNullSafe(F.col("t.item")))
            .join(runs.alias("r"), (F.col("m.row") == F.col("r.row")) & F.col("m.item").eqNullSafe(F.col("r.item")), "left")
            .select("m.row", "m.item", "matched", "total", (F.col("matched") / F.col("total")).alias("similarity"),
                    F.col("r.row").isNotNull().alias("in_a_row"))
            .filter((F.col("similarity") >= threshold) | F.col("in_a_row")).drop("in_a_row"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item."""
    base = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "documents", texts=True)
    found = leaks(base, benchmark, "row", F.col(f"doc.{text_col}"), verbatim=True).select("row").distinct()
    return base.join(found, "row", "left_anti").select("doc.*")
