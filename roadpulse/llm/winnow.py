"""Document fingerprints by winnowing, in Spark expressions only.

The hashes of all runs of ``gram`` units are built by rolling doubling (a run of 2n units from two runs
of n), and of every ``window`` neighbouring hashes the smallest is kept, the rightmost among equals. Two
texts that share ``gram + window - 1`` units in a row share a fingerprint there. Units are the characters
of the words, so scripts without spaces and texts of few words have as many as others, or the words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import NOT_WORD, ascii_lower, words

GRAM, WINDOW = 4, 8  # of words; powers of two
SIZES = {"words": (GRAM, WINDOW), "characters": (8, 16)}
_PRIME, _BASE = 2147483629, 1103515245  # below 2**31, so a product fits a long
_PLACES = 2147483648  # a kept value is hash * _PLACES + (_PLACES - 1 - position)


def _pairs(values: Column, gap: int, combine) -> Column:
    """combine(value, the value ``gap`` later) for every place that has both."""
    n = F.greatest(F.size(values) - gap, F.lit(0))
    return F.zip_with(F.slice(values, 1, n), F.slice(values, F.lit(gap + 1), n), combine)


def _letters(text: Column) -> Column:
    return F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, "")


def _units(text: Column, unit: str) -> tuple[Column, Callable[[Column], Column]]:
    """The units of a text, and the number of a unit ``w`` as a function of ``w``."""
    if unit == "words":
        return words(text), lambda w: F.pmod(F.xxhash64(w), F.lit(_PRIME))
    # Splitting at the empty string gives code points, in one pass.
    return F.array_remove(F.split(_letters(text), ""), ""), lambda c: F.ascii(c).cast("long")


def with_fingerprint(df: DataFrame, text: str, out: str, unit: str = "words") -> DataFrame:
    """The rows with ``out``, an array of kept values (hash and position) in order of position.

    A text of fewer units than a gram has one hash of all of them; one with fewer hashes than a
    window has their smallest. A null text and one without words have an empty array. Repeated rows
    stay, equal texts have equal values, and other columns pass through; ``out`` is replaced.
    """
    gram, window = SIZES[unit]
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    units, number = _units(F.col(f"`{text}`"), unit)
    own = F.pmod(F.xxhash64(F.array_join("__w", " ")), F.lit(_PRIME))
    rows = df.select(*kept, units.alias("__w")).withColumn("__n", F.size("__w"))
    grams = rows.withColumn("__g", F.transform("__w", number))
    run, power = 1, _BASE
    while run < gram:
        grams = grams.withColumn("__g", _pairs(F.col("__g"), run, _joined(power)))
        run, power = 2 * run, power * power % _PRIME
    hashes = F.when(F.col("__n") >= gram, F.col("__g")).otherwise(
        F.when(F.col("__n") > 0, F.array(own)).otherwise(F.array().cast("array<bigint>"))
    )
    least = grams.withColumn(
        "__h", F.transform(hashes, lambda g, i: g * F.lit(_PLACES) + F.lit(_PLACES - 1) - i)
    ).withColumn("__m", F.col("__h"))
    run = 1
    while run < window:
        least = least.withColumn("__m", _pairs(F.col("__m"), run, lambda a, b: F.least(a, b)))
        run *= 2
    few = F.when(F.size("__h") > 0, F.array(F.array_min("__h"))).otherwise(F.col("__h"))
    return least.select(
        *kept, F.when(F.size("__h") >= window, F.array_distinct("__m")).otherwise(few).alias(out)
    )


def _joined(power: int):
    return lambda a, b: (a * F.lit(power) + b) % F.lit(_PRIME)


def hashes(fingerprint: Column) -> Column:
    """The distinct hashes of a fingerprint, without their positions."""
    return F.array_distinct(F.transform(fingerprint, lambda v: F.shiftright(v, 31)))


def positions(fingerprint: Column) -> Column:
    """The number of the unit, from 0, at which each kept hash starts."""
    return F.transform(fingerprint, lambda v: F.lit(_PLACES - 1) - F.pmod(v, F.lit(_PLACES)))


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct hashes of two fingerprints that both have; 1 where both are empty."""
    common, together = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(together == 0, 1.0).otherwise(common / together)


def with_next(df: DataFrame, key: str, text: str, make) -> DataFrame:
    """Each row beside the next one in ascending order of a numeric ``key``; after the last comes the first.

    Columns: key, text, what ``make`` adds (a function of a frame), and ``next``, a struct of the next
    row's text and added columns. Rows of one key are in the order of their text's hash; null keys come
    first. Rows are dealt by ranges of the key that hold about the same number of rows, so a text is
    shuffled once; only the first row of each range crosses to its neighbour.
    """
    spark = df.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).alias("__k"), F.coalesce(F.col(text), F.lit("")).alias("__t"))
    steps = [i / ranges for i in range(1, ranges)]
    # One number per range reaches the driver; how many there are is a setting, not the data's size.
    cuts = rows.agg(F.percentile_approx("__k", steps).alias("c")).first()["c"] or []
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    ranged = rows.withColumn("__b", F.size(F.filter(cuts, lambda c: c < F.col("__k"))))
    # Dealt before the fingerprints are made, so that these are not shuffled.
    dealt = ranged.repartition("__b").withColumn("__o", F.xxhash64("__t"))
    made = make(dealt, "__t")
    added = [c for c in made.columns if c not in ("__k", "__b", "__o")]
    whole = F.struct(*added)
    ordered = Window.partitionBy("__b").orderBy("__k", "__o")
    following = made.withColumn("__next", F.lead(whole).over(ordered))
    firsts = dealt.withColumn("__first", F.row_number().over(ordered)).where("__first = 1")
    heads = make(firsts, "__t").select(F.col("__b").alias("__hb"), whole.alias("__head"))
    # A row per range: these meet in one task.
    line = Window.partitionBy(F.lit(0)).orderBy("__hb")
    neighbour = heads.select(
        "__hb", F.coalesce(F.lead("__head").over(line), F.first("__head").over(line)).alias("__head")
    )
    joined = following.join(neighbour, F.col("__b") == F.col("__hb"))
    return joined.select(
        F.col("__k").alias(key),
        F.col("__t").alias(text),
        *[c for c in added if c != "__t"],
        F.coalesce("__next", "__head").alias("next"),
    )


def _of_joined(df: DataFrame, head: Column, out: str) -> DataFrame:
    """The fingerprint of ``edited``: a text's ``head`` and the start of the next text, both with fingerprints.

    A value whose windows all lie in the head, or all in the next text's part, is kept there as in its own
    text. So only the windows over the seam and over the end are made anew; the values are the same as those
    of ``with_fingerprint``, which short parts go through whole.
    """
    gram, window = SIZES["characters"]
    edge = gram + window - 1  # characters of one window
    reach = edge + window - 2  # characters of all windows that hold a value of the outermost ones
    seamed = df.withColumn("__l", _letters(F.col("edited"))).withColumn("__a", F.length(_letters(head)))
    a, b = F.col("__a"), F.length("__l") - F.col("__a")
    first = F.when(a >= 2 * reach, a - reach).otherwise(0)
    last = F.when(b >= 2 * reach, a + reach).otherwise(a + b)
    cut = seamed.select("*", first.alias("__s"), last.alias("__z"), b.alias("__b")).select(
        "*",
        F.substring(F.col("__l"), F.col("__s") + 1, F.col("__z") - F.col("__s")).alias("__seam"),
        F.when(F.col("__b") >= 2 * reach, F.substring(F.col("__l"), a + F.col("__b") - reach + 1, F.lit(reach))).otherwise("").alias("__end"),
    )
    cut = cut.drop("__l")
    made = with_fingerprint(with_fingerprint(cut, "__seam", "__f", "characters"), "__end", "__g", "characters")

    def at(value: Column) -> Column:
        return F.lit(_PLACES - 1) - F.pmod(value, F.lit(_PLACES))

    def moved(values: Column, by: Column) -> Column:
        return F.transform(values, lambda v: v - by)

    none = F.array().cast("array<bigint>")
    a, b = F.col("__a"), F.col("__b")
    long_head, long_rest = a >= 2 * reach, b >= 2 * reach
    before = F.when(long_head, F.filter("fingerprint", lambda v: at(v) <= a - edge)).otherwise(none)
    seam = F.filter(
        moved(F.col("__f"), F.col("__s")),
        lambda v: (~long_head | (at(v) > a - edge)) & (~long_rest | (at(v) < a + window - 1)),
    )
    inside = F.filter(F.col("next.fingerprint"), lambda v: (at(v) >= window - 1) & (at(v) <= b - edge))
    after = F.filter(moved(F.col("__g"), a + b - reach), lambda v: at(v) > a + b - edge)
    rest = F.when(long_rest, F.concat(moved(inside, a), after)).otherwise(none)
    return made.withColumn(out, F.concat(before, seam, rest))


def edited_beside_next(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "characters") -> DataFrame:
    """Every text, its edited text, and the fingerprints of both and of the next document's text.

    The edited text has the last quarter of the code points replaced by the first as many, or all, of
    the next document. A null text is empty; a lone document is its own next. Only ``key`` and ``text``
    are read, so other columns may have any name. An empty table gives no rows.
    """
    both = with_next(docs, key, text, lambda df, t: with_fingerprint(df, t, "fingerprint", unit))
    n = F.length(text)
    part = F.floor(n / 4).cast("int")
    edited = both.withColumn(
        "edited", F.concat(F.substring(F.col(text), F.lit(1), n - part), F.substring(F.col("next.__t"), F.lit(1), part))
    )
    if unit == "characters":
        made = _of_joined(edited, F.substring(F.col(text), F.lit(1), n - part), "edited_fingerprint")
    else:
        made = with_fingerprint(edited, "edited", "edited_fingerprint", unit)
    return made.select(
        key,
        text,
        "edited",
        "fingerprint",
        "edited_fingerprint",
        F.col("next.fingerprint").alias("next_fingerprint"),
    )
