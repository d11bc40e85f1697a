"""Benchmark items in documents, also with other numbers, names or units.

Texts are brought to a template: in each, numbers, units after a number, and
capitalised words inside a sentence carry a typed mark; the rest is lower-case
words.  Windows of ``WINDOW`` words of the template (marked words as their type only)
and, where a window holds marked words, of the plain words are hashed and joined
with the windows of the benchmark.  Where a window matches by its types, the marked
words of item and document must correspond one to one along the passage (one value
of the item, one value of the document); passages where they do not are dropped.
An item is in a document if ``SHARE`` of its windows are.

A window that is dense in marked words (fewer than ``LITERAL`` plain ones) is hashed by its
types with the next ``LITERAL`` plain words from its start on and how far away they are, and
with the last ones up to its end.  Capitalised words that open a sentence and are not in
``COMMON`` may be names: windows with one are also hashed with it marked.  These two ways
(``wide``) only add matches; the words marked in them must correspond as well.

A first pass finds the documents that can hold an item at all.  It hashes every word once as
it is, by its type, and by its type with opening words as names, and makes of each window the
hash of its five word hashes.  A window matched in any way above has the same words in one of
these three readings, so a document with fewer such windows than ``SHARE`` does not hold the item.
Only for the others, and there only at the places of such windows, are all ways of the windows made,
with the words to compare.

All of it is DataFrame functions.  The benchmark's windows are broadcast only while
they are at most ``BROADCAST_ROWS``; beyond that both sides are shuffled by the hash.

Defined results: null and empty texts match nothing; empty tables give no rows and other columns
are not read; a text shorter than a window is
one window, and such an item is also sought in windows of its length; texts with fewer
than ``LITERAL`` plain words match only as plain words; rows that repeat an id are judged each on its own text; rows with null ids
too (they come out with a null id); items that are null or empty match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import bounded_broadcast, stored

WINDOW, SHARE, LITERAL = 5, 0.6, 3
BROADCAST_ROWS = 200_000
MARK = "\x02"
# Unit words
UNITS = ("km", "m", "cm", "mm", "mi", "miles", "mile", "kg", "g", "mg", "lb", "lbs", "oz", "l", "ml", "h", "hours", "hour",
         "min", "minutes", "minute", "s", "seconds", "second", "days", "day", "weeks", "week", "months", "month", "years",
         "year", "dollars", "dollar", "cents", "euros", "euro", "percent", "degrees", "mph", "kmh", "feet", "foot", "ft",
         "inches", "inch", "meters", "metres", "meter", "metre", "liters", "litres", "grams", "kilograms", "kilometers")


#: Words that open a sentence and are no names.
COMMON = ("The", "An", "This", "That", "These", "Those", "He", "She", "It", "We", "You", "They", "His", "Her", "Its", "Our", "Your",
          "Their", "My", "There", "Here", "If", "When", "While", "Then", "After", "Before", "How", "What", "Which", "Who", "Whose",
          "Where", "Why", "Each", "Every", "All", "Both", "Some", "Many", "Most", "One", "Two", "Three", "In", "On", "At", "By", "For",
          "From", "To", "Of", "With", "And", "But", "Or", "So", "As", "Is", "Are", "Was", "Were", "Do", "Does", "Did", "Can", "Find",
          "Suppose", "Let", "Given", "Calculate", "Determine", "El", "La", "Los", "Las", "Un", "Una", "De", "En", "Que", "Le", "Les",
          "Une", "Des", "Et", "Il", "Elle", "Der", "Die", "Das", "Ein", "Eine", "Und", "Er", "Sie", "Es", "Ist", "Wie", "Was")


def marked_text(text: Column) -> Column:
    """A text in small letters with marks before numbers, units and names, and before capitalised words
    that open a sentence (``q``)."""
    name = F.regexp_replace(text, rf"(^\s*|[.!?:\n\"“”«(]\s*)(?!(?:{'|'.join(COMMON)})(?![\p{{L}}\p{{N}}]))(\p{{Lu}}\p{{Ll}}+)", f"$1{MARK}q$2")
    # after a small letter, comma or semicolon and a space
    name = F.regexp_replace(name, r"(\p{Lu}(?<=[\p{Ll},;] .)\p{Ll}+)", f"{MARK}p$1")
    number = F.regexp_replace(name, r"([0-9]+)", f" {MARK}n$1 ")
    unit = F.regexp_replace(F.lower(number), f"({MARK}n[0-9]+ +)({'|'.join(UNITS)})($|[^\\p{{L}}\\p{{N}}])", f"$1{MARK}u$2$3")
    return F.when(text.rlike("[0-9]"), unit).otherwise(F.lower(name))


def split_words(marked: Column) -> Column:
    """The words of a marked text; a marked word begins with the mark and its type."""
    return F.array_remove(F.split(marked, rf"[^\p{{L}}\p{{N}}{MARK}]+"), "")


def words(text: Column) -> Column:
    return split_words(marked_text(text))


def _hash(parts: Column, first: Column, plain: bool, n: int = WINDOW) -> Column:
    return F.xxhash64(*[_word(F.get(parts, first + (k - 1)), plain) for k in range(n)])


def _word(w: Column, plain: bool) -> Column:
    return F.when(F.startswith(w, F.lit(MARK)), F.substr(w, F.lit(3)) if plain else F.substr(w, F.lit(1), F.lit(2))).otherwise(w)


def _marked(w: Column) -> Column:
    return F.startswith(w, F.lit(MARK))


def _piece(parts: Column, first: Column, n: int = WINDOW) -> Column:
    """Up to ``n`` words from a place on (``slice`` would copy all words of the text for each window)."""
    return F.filter(F.array(*[F.get(parts, first + (k - 1)) for k in range(n)]), lambda w: w.isNotNull())


def windows(df: DataFrame, keys: list[str], text: str, lengths: list[int] | None = None, at: str | None = None) -> DataFrame:
    """``keys, place, h, slots, wide``: a row for each window and way to match it; slots
    holds the words of a window that is hashed by types, else null.  ``lengths``: of items
    shorter than a window; windows of that many words are given too.  ``at``: a column with the places
    that are wanted (of windows that may match); else all are."""
    extra = [at] if at else []
    opens = F.lit(MARK + "q")
    tokens = df.select(*keys, *extra, words(F.col(text)).alias("_a")).where(F.size("_a") > 0)
    has_opens = F.exists("_a", lambda w: F.startswith(w, opens))
    # _w: without marks of opening words; _v: with these as names
    tokens = tokens.select(
        *keys, *extra, F.when(has_opens, F.transform("_a", lambda x: F.when(F.startswith(x, opens), F.substr(x, F.lit(3))).otherwise(x)))
        .otherwise(F.col("_a")).alias("_w"),
        F.when(has_opens, F.transform("_a", lambda x: F.when(F.startswith(x, opens), F.concat(F.lit(MARK + "p"), F.substr(x, F.lit(3))))
                                      .otherwise(x))).otherwise(F.col("_a")).alias("_v"))
    tokens = tokens.withColumn("_p", F.when(F.exists("_v", _marked), F.filter(
        F.transform("_v", lambda x, i: F.when(_marked(x), 0).otherwise(i + 1)), lambda i: i > 0)))
    has_marks = F.exists("_w", _marked)

    def places_of(n):
        last = F.greatest(F.size("_w") - (n - 1), F.lit(1))
        return F.filter(at, lambda i: i <= last) if at else F.sequence(F.lit(1), last)

    def wanted(spots):
        return F.filter(spots, lambda i: F.array_contains(at, i)) if at else spots

    places = places_of(WINDOW)
    none = F.lit(None).cast("array<string>")
    w, v, p = F.col("_w"), F.col("_v"), F.col("_p")

    def marks(i, of=w, n=WINDOW):
        return F.size(F.filter(_piece(of, i, n), _marked))

    def row(i, h, slots, wide=False):
        return F.struct(i.cast("int").alias("place"), h.alias("h"), slots.alias("slots"), F.lit(wide).alias("wide"))

    simple = F.transform(places, lambda i: row(i, F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(WINDOW)]), none))
    plain = F.transform(places, lambda i: row(i, _hash(w, i, True), none))
    typed = F.transform(F.filter(places, lambda i: (marks(i) > 0) & (marks(i) <= WINDOW - LITERAL)),
                        lambda i: row(i, _hash(w, i, False), _piece(w, i)))
    found = F.when(has_marks, F.concat(plain, typed)).otherwise(simple)

    # windows with an opening word that hold enough plain words
    opened = F.transform(F.filter(places, lambda i: (_piece(v, i) != _piece(w, i)) & (marks(i, v) <= WINDOW - LITERAL)),
                         lambda i: row(i, _hash(v, i, False), _piece(v, i), True))

    def beyond(i, which, side):
        """A window and the plain words ``which`` (places in ``_p``)."""
        far = [F.get(p, j) for j in which]
        return row(i, F.xxhash64(F.lit(side), _hash(v, i, False), *[x - i for x in far], *[F.get(v, x - 1) for x in far]),
                   _piece(v, i), True)

    last = F.size(v) - (WINDOW - 1)

    def right(at, j):
        """Windows that begin after the plain word before and hold too few of the next ones."""
        begin = F.coalesce(F.get(p, F.greatest(j - 1, F.lit(0))) * F.when(j > 0, 1).otherwise(0), F.lit(0)) + 1
        end = F.least(at, F.get(p, j + (LITERAL - 1)) - WINDOW, last)
        return F.when(begin <= end, F.transform(wanted(F.sequence(begin, F.greatest(begin, end))),
                                                lambda i: beyond(i, [j + k for k in range(LITERAL)], "right")))

    def left(at, j):
        """Windows that end before the next plain word and hold too few of the ones before."""
        end = F.coalesce(F.get(p, j + 1), F.size(v) + 1) - 1 - (WINDOW - 1)
        begin = F.greatest(at - (WINDOW - 1), F.get(p, F.greatest(j - (LITERAL - 1), F.lit(0))) + 1, F.lit(1))
        return F.when((begin <= end) & (j >= LITERAL - 1), F.transform(wanted(F.sequence(begin, F.greatest(begin, end))),
                                                                       lambda i: beyond(i, [j - k for k in range(LITERAL)], "left")))

    def dense(way):
        return F.flatten(F.filter(F.transform(p, way), lambda x: x.isNotNull()))

    is_dense = F.exists(places, lambda i: marks(i, v) > WINDOW - LITERAL) & (F.size(v) >= WINDOW)
    ways = [found, F.when(v != w, opened), F.when(p.isNotNull() & is_dense & (F.size(p) >= LITERAL), F.concat(dense(right), dense(left)))]
    for n in lengths or []:
        spots = places_of(n)
        ways.append(F.when(F.size(w) > n, F.transform(spots, lambda i: row(i, _hash(w, i, True, n), none))))
        if n > LITERAL:
            ways.append(F.when((F.size(w) > n) & p.isNotNull(), F.transform(
                F.filter(spots, lambda i: (marks(i, v, n) > 0) & (marks(i, v, n) <= n - LITERAL)),
                lambda i: row(i, _hash(v, i, False, n), _piece(v, i, n), True))))
    own = F.when((F.size(v) < WINDOW) & (marks(F.lit(1), v) > 0) & (F.size(v) - marks(F.lit(1), v) >= LITERAL),
                 F.array(row(F.lit(1), _hash(v, F.lit(1), False), v, True)))
    kind = "array<struct<place:int,h:bigint,slots:array<string>,wide:boolean>>"
    every = F.concat(*[F.coalesce(x.cast(kind), F.array().cast(kind)) for x in [*ways, own]])
    return tokens.select(*keys, F.inline(every))


def _readings(df: DataFrame, keys: list[str], text: str, lengths: list[int], placed: bool) -> DataFrame:
    """``keys, [place,] g``: the hash of each window in each of its three readings (also of ``lengths`` words)."""
    opens = lambda x: F.startswith(x, F.lit(MARK + "q"))
    rest, kind = lambda x: F.substr(x, F.lit(3)), lambda x: F.substr(x, F.lit(1), F.lit(2))
    tokens = df.select(*keys, marked_text(F.col(text)).alias("_m")).select(
        *keys, split_words(F.col("_m")).alias("_a"), F.contains("_m", F.lit(MARK + "q")).alias("_q"),
        F.col("_m").rlike(f"{MARK}[npu]").alias("_o")).where(F.size("_a") > 0)
    none = F.lit(None).cast("array<bigint>")
    plain = F.when(F.col("_q") | F.col("_o"), F.transform("_a", lambda x: F.xxhash64(F.when(_marked(x), rest(x)).otherwise(x)))).otherwise(
        F.transform("_a", lambda x: F.xxhash64(x)))
    typed = F.when(F.col("_o"), F.transform("_a", lambda x: F.xxhash64(
        F.when(_marked(x), F.when(opens(x), rest(x)).otherwise(kind(x))).otherwise(x)))).otherwise(none)
    named = F.when(F.col("_q"), F.transform("_a", lambda x: F.xxhash64(
        F.when(_marked(x), F.when(opens(x), MARK + "p").otherwise(kind(x))).otherwise(x)))).otherwise(none)
    tokens = tokens.select(*keys, F.size("_a").alias("_n"), plain.alias("_r0"), typed.alias("_r1"), named.alias("_r2"))

    def windows_of(r, n):
        """The word hashes of each window of ``n`` words, side by side: slices are zipped and hashed as columns,
        which Spark compiles (a function of each place of the array would be interpreted)."""
        many = F.greatest(F.col("_n") - (n - 1), F.lit(1))
        sides = [F.slice(r, k + 1, many) if k < n else F.array().cast("array<bigint>") for k in range(WINDOW)]
        return F.arrays_zip(F.sequence(F.lit(1), many) if placed else F.slice(r, 1, 0), *sides)

    each = []
    for n in [WINDOW, *lengths]:
        for c in ("_r0", "_r1", "_r2"):
            known = F.col(c).isNotNull()
            each.append(F.when(known if n == WINDOW else known & (F.col("_n") > n), windows_of(F.col(c), n)))
    names = ["place", *[f"_w{k}" for k in range(WINDOW)]]
    kind = "array<struct<" + ",".join(f"{c}:{'int' if c == 'place' and placed else 'bigint'}" for c in names) + ">>"
    each = [F.coalesce(x.cast(kind), F.array().cast(kind)) for x in each]
    rows = tokens.select(*keys, F.inline(F.concat(*each)))
    return rows.select(*keys, *["place"] * placed, F.xxhash64(*names[1:]).alias("g"))


def _candidates(source: DataFrame, index: DataFrame, total: DataFrame, lengths: list[int], share: float) -> DataFrame:
    """``_id, _row`` of the documents that may hold an item; ``index``: the readings of the items."""
    hits = _readings(source, ["_id", "_row"], "_t", lengths, False).join(bounded_broadcast(index, BROADCAST_ROWS), "g")
    found = hits.select("_id", "_row", "_item", "_at").distinct().groupBy("_id", "_row", "_item").agg(F.count("*").alias("n"))
    found = found.join(bounded_broadcast(total, BROADCAST_ROWS), "_item").where(F.col("n") >= share * F.col("n_windows"))
    return stored(found.select("_id", "_row").distinct(), "candidates")


def _places(few: DataFrame, index: DataFrame, lengths: list[int]) -> DataFrame:
    """``_cid, _crow, _near``: the places of each document where a window has a reading of an item's window."""
    known = stored(index.select("g").distinct(), "known")
    hits = _readings(few, ["_id", "_row"], "_t", lengths, True).join(bounded_broadcast(known, BROADCAST_ROWS), "g")
    return stored(hits.groupBy(F.col("_id").alias("_cid"), F.col("_row").alias("_crow")).agg(F.collect_set("place").alias("_near")), "places")


def leaks(docs: DataFrame, benchmark: DataFrame, *, key="doc_id", text="text", item="item_id", item_text="text",
          share: float = SHARE) -> DataFrame:
    """``(key, row, item, n_windows, n_matched, share)``: items found in documents.
    ``row`` tells rows with the same id apart (a hash of the text)."""
    items = benchmark.where(F.col(item).isNotNull()).select(F.col(item).alias("_item"), F.col(item_text).alias("_t"))
    lengths = sorted(r["n"] for r in items.select(F.size(words(F.col("_t"))).alias("n")).where(f"n > 0 and n < {WINDOW}").distinct().collect())
    index = stored(windows(items, ["_item"], "_t").select("_item", F.col("place").alias("_at"), "h", F.col("slots").alias("_slots"),
                                                          F.col("wide").alias("_wide")).distinct(), "index")
    total = stored(index.groupBy("_item").agg(F.count_distinct("_at").alias("n_windows")), "total")
    source = docs.select(F.col(key).alias("_id"), F.xxhash64(text).alias("_row"), F.col(text).alias("_t"))
    readings = stored(_readings(items, ["_item"], "_t", [], True).select("_item", F.col("place").alias("_at"), "g").distinct(), "readings")
    some = bounded_broadcast(_candidates(source, readings, total, lengths, share).withColumnsRenamed({"_id": "_cid", "_row": "_crow"}), BROADCAST_ROWS)
    same_row = F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_row") == F.col("_crow"))
    few = stored(source.join(some, same_row, "left_semi"), "few")
    near = few.join(bounded_broadcast(_places(few, readings, lengths), BROADCAST_ROWS), same_row)
    seen = windows(near, ["_id", "_row"], "_t", lengths, "_near")
    # two windows with the same hash must be matched the same way
    hits = seen.join(bounded_broadcast(index, BROADCAST_ROWS), ["h"]).where(
        (F.col("slots").isNull() == F.col("_slots").isNull()) & (F.col("wide") == F.col("_wide")))
    hits = stored(hits.select("_id", "_row", "_item", "_at", (F.col("place") - F.col("_at")).alias("_shift"), "slots", "_slots", "wide")
                  .distinct(), "hits")
    passage = ["_id", "_row", "_item", "_shift"]
    pairs = (hits.where("slots is not null")
             .select(*passage, "wide", F.explode(F.arrays_zip(F.col("_slots").alias("of_item"), F.col("slots").alias("of_doc"))).alias("p"))
             .where(F.startswith("p.of_item", F.lit(MARK))).select(*passage, "wide", "p.of_item", "p.of_doc").distinct())

    def clashes(of):
        return (of.groupBy(*passage).agg(F.count("*").alias("n"), F.count_distinct("of_item").alias("a"),
                                         F.count_distinct("of_doc").alias("b")).where("n > a or n > b").select(*passage))

    # wide matches need all values to correspond, the others those marked without them
    clash = (clashes(pairs.where("not wide")).withColumn("wide", F.lit(False))
             .unionByName(clashes(pairs.drop("wide").distinct()).withColumn("wide", F.lit(True)))
             .select(*[F.col(c).alias(f"x{c}") for c in [*passage, "wide"]]))
    same = [F.col(c).eqNullSafe(F.col(f"x{c}")) for c in [*passage, "wide"]]
    # plain matches stand whatever the values; typed ones need values that correspond
    good = hits.join(clash, same, "left").where("slots is null or x_item is null")
    found = good.groupBy("_id", "_row", "_item").agg(F.count_distinct("_at").alias("n_matched"))
    rate = (F.col("n_matched") / F.col("n_windows")).alias("share")
    return (found.join(bounded_broadcast(total, BROADCAST_ROWS), "_item").where(F.col("n_matched") >= share * F.col("n_windows"))
            .select(F.col("_id").alias(key), F.col("_row").alias("row"), F.col("_item").alias(item), "n_windows", "n_matched", rate))
