"""Personal data by rules and by bootstrapped contextual extraction.

Base spans come from four patterns. Their values seed a graph of lexical
patterns (the one or two words before a value, and the word after it) and
instances (values that stand in such a context: base values, and words that
hold a digit or an at sign and grouped numbers, i.e. runs of digits, brackets,
dots, hyphens and single spaces, which overlap no base span). A word inside a
grouped number that looks like a kind can be found, but does not count in the
confidence of patterns, and the longest of nested added spans of a kind stays. In each round a pattern's confidence for a kind
is the share of its distinct instances known to be of that kind; instances
in patterns of high confidence, if they look like the kind, become known and
support more patterns. Their occurrences that no base span overlaps are the
added spans. DataFrame functions only; positions come from the lengths of
what lies between matches.

Cases: a null text counts as empty; a text without matches has counts 0, the
hash of nothing and no spans; overlapping spans of different base kinds are
all kept; equal ids and repeated rows are rows of their own; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricekit.llm._stage import staged

# The kinds in the order of the result, and their patterns. Written so that no
# match is tried from inside a run that already failed, and without backtracking; they match
# the same text as the plain patterns quoted beside them.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([ -]?[0-9])+
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    # \+[0-9][ ().0-9-]+[0-9]
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Words with a digit or an at sign, without the punctuation around them.
WORD = "word"
WORD_PATTERN = r"(?<![^\s])[^\s0-9@]*+[0-9@]\S*+"
#: Numbers in groups with single spaces between them.
GROUP = "group"
GROUP_PATTERN = r"(?<![^\s\"'\[{<,;:=])\(?[0-9][0-9().-]*+(?: \(?[0-9][0-9().-]*+)++"
#: What an added value of a kind must look like.
LOOKS = {
    "email": r"^[^@\s]+@[^@\s]+$",
    "ip": r"^[0-9]{1,5}([.:][0-9]{1,5}){3,}$",
    "card": r"^[0-9][0-9-]{11,}[0-9]$",
    "phone": r"^\(?[0-9][0-9().-]{5,}[0-9]$",
}
#: The same for values with spaces: 13 to 19 and 7 to 15 digits.
GROUP_LOOKS = {
    "card": r"^[0-9](?:[ -]*[0-9]){12,18}$",
    "phone": r"^\(?[0-9](?:[ ().-]*[0-9]){6,14}$",
}
ROUNDS, SUPPORT, CONFIDENCE, CONTEXT = 60, 5, 0.8, 80
BASE_TYPE = "array<struct<gap:int,tail:string,head:string,value:string>>"


def _events(text: Column, pattern: str) -> Column:
    """All matches with the length, last and first characters of the text before each; one more
    element for the text after the last match."""
    both = F.arrays_zip(F.split(text, pattern, -1).alias("part"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    return F.transform(both, lambda x: F.struct(
        F.length(x["part"]).alias("gap"), F.right(x["part"], F.lit(CONTEXT)).alias("tail"),
        F.left(x["part"], F.lit(CONTEXT)).alias("head"), x["value"].alias("value"))).cast(BASE_TYPE)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of at most 19 digits is a multiple of ten."""
    def part(i):
        d = F.substring(F.reverse(digits), i + 1, 1).try_cast("int")
        return F.coalesce(d if i % 2 == 0 else F.when(d > 4, 2 * d - 9).otherwise(2 * d), F.lit(0))
    return reduce(lambda a, b: a + b, [part(i) for i in range(19)]) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = _digits(value)
    parts = F.split(value, r"\.", -1)
    small = reduce(lambda a, b: a & b, [
        F.regexp_replace(F.get(parts, F.lit(i)), "^0+", "").rlike("^(|[0-9]|[0-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$")
        for i in range(4)])
    return (F.when(kind == "ip", small)
            .when(kind == "card", F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", F.length(digits).between(8, 15))
            .otherwise(True))


def _looks_like() -> Column:
    return reduce(lambda a, b: a | b, [(F.col("kind") == k) & F.col("value").rlike(v)
                                       for looks in (LOOKS, GROUP_LOOKS) for k, v in looks.items()])


def occurrences(rows: DataFrame) -> DataFrame:
    """``(row, kind, start, end, value, contexts)`` of all matches of staged rows, also those that a kind's test drops."""
    each = reduce(DataFrame.union, [
        rows.filter(F.col(k).isNotNull()).select("row", F.lit(k).alias("kind"), F.posexplode(k).alias("i", "e"))
        for k in (*KINDS, WORD, GROUP)]).select("row", "kind", "i", "e.*")
    order = Window.partitionBy("row", "kind").orderBy("i")
    size = F.coalesce(F.length("value"), F.lit(0))
    placed = each.select(
        "row", "kind", "value", "tail",
        F.lead("head").over(order).alias("after"),
        F.sum((F.col("gap") + size).cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"))
    before = F.lower(F.regexp_extract("tail", r"(\S+)\s*$", 1))
    two = F.lower(F.regexp_replace(F.regexp_extract("tail", r"(\S+\s+\S+)\s*$", 1), r"\s+", " "))
    after = F.lower(F.regexp_extract("after", r"^\s*(\S+)", 1))
    return placed.filter("value IS NOT NULL").select(
        "row", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value",
        F.filter(F.array(F.when(two != "", F.concat(F.lit("2 "), two)), F.when(before != "", F.concat(F.lit("1 "), before)),
                         F.when(after != "", F.concat(F.lit("a "), after))), lambda x: x.isNotNull()).alias("contexts"))


def _apart(blocks: Column) -> Column:
    """Whether a span overlaps none of the other spans of its row that are blocks.

    Both windows only grow (the second in the exact reverse order), so a row of many spans takes time in proportion to them.
    """
    places = ("start", "end", "kind")
    onward = Window.partitionBy("row").orderBy(*places)
    back = Window.partitionBy("row").orderBy(*[F.desc(c) for c in places])
    before = F.max(F.when(blocks, F.col("end"))).over(onward.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(blocks, F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(after >= F.col("end"), F.lit(True))


def bootstrap(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT,
              confidence: float = CONFIDENCE) -> DataFrame:
    """Known ``(kind, value)`` on a graph ``(pattern, value, counts)`` from seeds ``(kind, value)``, round by round until none is new.

    Known values only grow; a graph that has not settled after ``rounds`` rounds is an error, not a shorter answer.

    Edges that do not count can be found but say nothing about a pattern. A pattern counts for a kind from ``support`` distinct known values on. Scores are
    aggregated before they are shuffled; the frequency of one pattern does not matter.
    """
    edges = staged(edges.groupBy("pattern", "value").agg(F.max("counts").alias("counts")), "edges")
    counted = edges.filter("counts")
    known = staged(seeds.distinct(), "known")
    number = known.count()
    size = counted.groupBy("pattern").agg(F.count("*").alias("n"))
    for _ in range(rounds):
        patterns = (counted.join(known, "value").groupBy("pattern", "kind").agg(F.count("*").alias("k"))
                    .filter(F.col("k") >= support).join(size, "pattern")
                    .filter(F.col("k") / F.col("n") >= confidence).select("pattern", "kind"))
        found = edges.join(patterns, "pattern").filter(_looks_like()).select("kind", "value")
        known = staged(known.union(found).distinct(), "known")
        before, number = number, known.count()
        if number == before:
            return known
    raise RuntimeError(f"patterns did not settle in {rounds} rounds")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
                       support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Per row ``(<id>, base, spans)``: arrays of ``(rank, start, end, kind, value, added)`` in order of kind, then start."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    digit = F.col("_text").rlike("[0-9]")
    at = F.col("_text").contains("@")
    when = {"email": at, "ip": digit, "card": digit, "phone": F.col("_text").contains("+"), WORD: digit | at, GROUP: digit}
    patterns = {**PATTERNS, WORD: WORD_PATTERN, GROUP: GROUP_PATTERN}
    rows = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
                  .withColumn("row", F.monotonically_increasing_id())
                  .select("row", "doc_id", *[F.when(when[k], _events(text, patterns[k])).alias(k)
                                             for k in patterns]), "matches")
    every = occurrences(rows).withColumn("ok", _valid(F.col("kind"), F.col("value"))).filter("ok").drop("ok")
    # punctuation around a word is not part of it; its span shrinks with it; a group keeps a bracket that it closes
    is_word, is_group = F.col("kind") == WORD, F.col("kind") == GROUP
    opened = is_group & F.col("value").contains(")")
    lead = F.when(opened, 0).otherwise(F.length(F.regexp_extract("value", r"^([\"'(\[{<,;:]*)", 1)))
    bare = F.regexp_replace(F.when(opened, F.col("value")).otherwise(F.regexp_replace("value", r"^[\"'(\[{<,;:]+", "")),
                            r"[^A-Za-z0-9]+$", "")
    every = (every.withColumn("start", F.when(is_word | is_group, F.col("start") + lead).otherwise(F.col("start")))
             .withColumn("value", F.when(is_word | is_group, bare).otherwise(F.col("value")))
             .withColumn("end", F.col("start") + F.length("value")).filter("length(value) > 0")
             .filter(~is_group | reduce(lambda a, b: a | b, [F.col("value").rlike(v) for v in GROUP_LOOKS.values()])))
    # what overlaps a base span is a piece of it, not an instance of its own
    is_base = ~is_word & ~is_group
    every = every.withColumn("free", _apart(is_base)).filter(is_base | F.col("free")).drop("free")
    every = staged(every.withColumn("counts", ~is_word | _apart(is_group)), "spans")
    base, others = every.filter(is_base), every.filter(~is_base)

    known = bootstrap(every.select(F.explode("contexts").alias("pattern"), "value", "counts"),
                      base.select("kind", "value"), rounds, support, confidence)
    longest = Window.partitionBy("row", "kind").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    added = (others.select("row", "start", "end", "value").join(known, "value")
             .filter(_looks_like())
             .withColumn("inside", F.coalesce(F.max("end").over(longest) >= F.col("end"), F.lit(False))).filter("not inside")
             .select("row", "kind", "start", "end", "value", F.lit(True).alias("added")))
    spans = base.select("row", "kind", "start", "end", "value", F.lit(False).alias("added")).union(added)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    lists = spans.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct(rank.alias("rank"), "start", "end", "kind", "value", "added"))).alias("spans"))
    return (rows.select("row", "doc_id").join(lists, "row", "left")
            .select(F.col("doc_id").alias(id_col), F.filter("spans", lambda s: ~s["added"]).alias("base"), "spans"))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","), F.lit(""))
