"""Phrases of a catalog in free text, as a join.

The catalog is a table of aliases (:func:`catalog_table`).  Every alias is keyed by
its first word, or by its first two words and what stands between them; a text is cut
once into runs of word characters and of others, every place where a key may stand (its
hash is marked in a small table) goes out with what stands around it, and an
equi-join on the key brings the aliases that could begin there.  What follows decides.
The plan is the same for ten aliases and a million: Spark broadcasts the catalog up to
its byte threshold and shuffles both sides beyond it.

A match stands between word boundaries: no letter, digit or underscore on
either side (``éai`` does not contain ``ai``).  Then every word of the alias, and what
stands between two of them, is a whole run of the text, which is why the key loses nothing, also with symbols in
front (``.net``), inside (``ci/cd``) or behind (``c++``).  Case is ignored by simple
folding, character by character, so places in the folded and the own text agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.text import ColumnOrName, col, fold_case, fold_simple

#: (skill name, category, aliases), in order of preference.
Catalog = Sequence[tuple[str, str, Sequence[str]]]

WORD = r"[\p{L}\p{N}_]"
RUNS = rf"(?s){WORD}++|[^\p{{L}}\p{{N}}_]++"
#: Keys of aliases are marked by their hash in 2**KEY_BITS booleans (128 KB).
KEY_BITS = 17
CATALOG_SCHEMA = "entry int, skill_name string, skill_category string, alias_rank int, alias string"


def catalog_table(spark: SparkSession, catalog: Catalog | DataFrame) -> DataFrame:
    """The catalog as one row per alias; a table with these columns is taken as it is."""
    if isinstance(catalog, DataFrame):
        return catalog.select("entry", "skill_name", "skill_category", "alias_rank", "alias")
    rows = [(e, name, category, r, a) for e, (name, category, aliases) in enumerate(catalog) for r, a in enumerate(aliases)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def first_entries(table: DataFrame) -> DataFrame:
    """Of entries whose names differ in case only, the first one."""
    name = fold_case("skill_name")
    first = table.groupBy(name.alias("__name")).agg(F.min("entry").alias("__first"))
    return (table.withColumn("__name", name).join(first, "__name").where(F.col("entry") == F.col("__first"))
            .drop("__name", "__first"))


def alias_index(table: DataFrame) -> DataFrame:
    """Aliases by their beginning: ``lead`` stands before the first word, ``core`` begins with it; ``size`` is the number of runs in the core.

    ``__key`` is the core's first word, or its first three runs (``word``, ``sep``, ``second``) where it has
    as many: these are whole runs of the text too.  An alias without a word character is an error.
    """
    folded = fold_simple("alias")
    runs = F.regexp_extract_all(folded, F.lit(RUNS), F.lit(0))
    t = table.select("*", folded.alias("__folded"), runs.alias("__runs"))
    leads = ~F.get("__runs", F.lit(0)).rlike(WORD)
    t = t.withColumn("lead", F.when(leads, F.get("__runs", F.lit(0))).otherwise(F.lit("")))
    at = F.when(F.col("lead") == "", 0).otherwise(1)
    word = F.get("__runs", at)
    word = F.when(word.isNull(), F.raise_error(F.concat(F.lit("alias without a word: "), F.col("alias")))).otherwise(word)
    t = t.select("entry", "skill_name", "skill_category", "alias_rank", word.alias("word"), "lead",
                 F.substring("__folded", F.length("lead") + 1, F.length("__folded")).alias("core"),
                 (F.size("__runs") - at).alias("size"),
                 *[F.when(F.size("__runs") - at > 2, F.get("__runs", at + n)).alias(c) for n, c in ((1, "sep"), (2, "second"))])
    return t.withColumn("__key", F.concat("word", F.coalesce("sep", F.lit("")), F.coalesce("second", F.lit(""))))


def known_words(index: DataFrame) -> DataFrame:
    """One row, whatever the catalog: ``__size`` of the longest core, and ``__marks``, in which the
    key of every alias has marked its hash (:func:`may_begin`)."""
    longest = index.agg(F.coalesce(F.max("size"), F.lit(1)).alias("__size"))
    return longest.crossJoin(hash_marks(index, ["word", "sep", "second"], KEY_BITS))


def hash_marks(df: DataFrame, cols: Sequence[ColumnOrName], bits: int) -> DataFrame:
    """One row, whatever the size of ``df``: ``__marks``, 2**bits booleans of which every row has set the one of its hash."""
    marks = df.select(_slot_of(cols, bits).alias("slot"), F.lit(True).alias("set"))
    none = df.sparkSession.range(1 << bits).select(F.col("id").cast("int").alias("slot"), F.lit(False).alias("set"))
    slots = marks.unionByName(none).groupBy("slot").agg(F.bool_or("set").alias("set"))
    return slots.agg(F.array_sort(F.collect_list(F.struct("slot", "set")))["set"].alias("__marks"))


def _slot_of(cols: Sequence[ColumnOrName], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - bits).cast("int")


def marked_in(marks: ColumnOrName, cols: Sequence[ColumnOrName], bits: int) -> Column:
    """False only for values that are no row's of :func:`hash_marks`."""
    return F.get(marks, _slot_of(cols, bits))


def may_begin(*runs: Column) -> Column:
    """False only for runs (one or three) that are no alias's key."""
    return marked_in("__marks", runs, KEY_BITS)


def occurrences(texts: DataFrame, keys: Sequence[str], text: ColumnOrName, table: DataFrame, extra: Column | None = None, every: bool = True) -> DataFrame:
    """Where aliases occur: ``keys`` with ``hit`` (entry, alias rank, place, matched text, name, category).

    Every row of ``texts`` also gives one row without a hit, which carries ``extra``
    (a struct or null), so that rows without any match are still there; without
    ``every`` there are only hits.  Only places where the key of an alias may stand leave their text.
    """
    index = alias_index(table)
    own = col(text)
    cut = texts.select(*keys, F.regexp_extract_all(own, F.lit(RUNS), F.lit(0)).alias("__own"),
                       F.regexp_extract_all(fold_simple(own), F.lit(RUNS), F.lit(0)).alias("__folded"),
                       F.when(own.rlike("^" + WORD), 0).otherwise(1).alias("__first"),
                       (F.lit(None).cast("string") if extra is None else extra).alias("__extra"))
    cut = cut.crossJoin(F.broadcast(known_words(index)))
    index = index.drop("word", "sep", "second")
    # the place -1 stands for the text itself; an outer explode, as for an inner one Spark would cut each text once more to see whether it has words
    size = F.size("__folded")
    places = F.when(F.col("__first") < size, F.sequence(F.col("__first"), size - 1, F.lit(2)))
    places = F.concat(F.array(F.lit(-1)), F.coalesce(places, F.array().cast("array<int>"))) if every else places
    place = F.col("place")
    placed = cut.select("*", F.explode_outer(places).alias("place"))
    three = [F.get("__folded", place + k) for k in range(3)]
    may = may_begin(three[0]) | may_begin(*three)
    placed = placed.where((place < 0) | may if every else place.isNotNull() & may)
    found = F.array(F.when(may_begin(three[0]), three[0]), F.when(may_begin(*three), F.concat(*three)))
    found = F.when(place < 0, F.array(F.lit(None).cast("string"))).otherwise(found) if every else found
    # one run more than the longest alias has makes the longest window
    after = F.array_join(F.slice("__own", place + 1, F.col("__size") + 1), "")
    tokens = placed.select(*keys, place, F.explode_outer(found).alias("__key"),
                           F.when(place < 0, F.lit(None)).when(place > 0, F.get("__own", place - 1)).otherwise(F.lit("")).alias("before"),
                           F.when(place >= 0, after).alias("after"), F.when(place < 0, F.col("__extra")).alias("extra"))
    tokens = tokens.where((place < 0) | F.col("__key").isNotNull())
    core, lead = F.col("core"), F.col("lead")
    rest = F.substring("after", F.length(core) + 1, F.lit(1))
    begins = (lead == "") | (fold_simple("before").endswith(lead) & ((F.length("before") > F.length(lead)) | (F.col("place") == 1)))
    fits = fold_simple("after").startswith(core) & ~rest.rlike(WORD) & begins
    matched = F.concat(F.right("before", F.length(lead)), F.left("after", F.length(core)))
    hit = F.when(F.col("entry").isNotNull(), F.struct(
        "entry", "alias_rank", "place", matched.alias("matched"), "skill_name", "skill_category"))
    joined = tokens.join(index, "__key", "left").where((F.col("place") < 0) | fits) if every else tokens.join(index, "__key").where(fits)
    return joined.select(*keys, hit.alias("hit"), "extra")


def first_places(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of all places with one matched text, the first: counted up before the shuffle, so a frequent phrase ships one row per text and task."""
    same = ["entry", "alias_rank", "matched", "skill_name", "skill_category"]
    rows = found.groupBy(*keys, "extra", F.col("hit").isNotNull().alias("__found"), *[F.col(f"hit.{c}").alias(f"__{c}") for c in same]).agg(F.min("hit.place").alias("__place"))
    hit = F.struct(*[F.col(f"__{c}").alias(c) for c in ("entry", "alias_rank", "place", "matched", "skill_name", "skill_category")])
    return rows.select(*keys, F.when(F.col("__found"), hit).alias("hit"), "extra")


def hits_per_text(texts: DataFrame, keys: Sequence[str], text: ColumnOrName, catalog: Catalog | DataFrame, extra: Column | None = None) -> DataFrame:
    """One row per ``keys``: ``hits``, of every entry found its first alias at its first place, by entry; ``extra``.

    Rows with the same keys count as one text; a null text has no hits.
    """
    table = first_entries(catalog_table(texts.sparkSession, catalog))
    found = first_places(occurrences(texts, keys, text, table, extra), keys)
    by_key = found.groupBy(*keys).agg(F.array_sort(F.collect_list("hit")).alias("hits"), F.max("extra").alias("extra"))
    return by_key.withColumn("hits", F.filter("hits", lambda h, i: (i == 0) | (F.get("hits", i - 1)["entry"] != h["entry"])))


def first_hit(texts: DataFrame, keys: Sequence[str], text: ColumnOrName, catalog: Catalog | DataFrame, every: bool = True) -> DataFrame:
    """One row per ``keys``: ``hit``, the first entry (by entry, then alias) that occurs in the text, or null;
    without ``every``, rows without a hit are left out."""
    found = first_places(occurrences(texts, keys, text, catalog_table(texts.sparkSession, catalog), every=every), keys)
    return found.groupBy(*keys).agg(F.min("hit").alias("hit"))
