"""Benchmark decontamination by template canonicalisation.

Numbers, units of measure and names become typed placeholders, so a question with other values has the same template.
Windows of an item are looked for in three readings: its lower-cased words, its template (names are capitalised words
inside a sentence), and a collapsed template, in which every capitalised word stands for a name and a run of placeholders
is one slot, so that values may change their number of words, and names may begin sentences. In each, the windows of one
occurrence lie on one diagonal; the slot values met on it must map each benchmark value to one value of the document. Of
a slot of the collapsed template, words that begin a sentence and are nowhere in the item a name must stay.

Every window has an anchor, its rarest pair of neighbouring words (in fewest benchmark items, then longest). An occurrence
holds ``COVERAGE`` of the windows of an item; so one of the best anchored windows, one more than the others, is among them,
and only texts with an anchor of those have their windows hashed. Nothing is lost by that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealens.functions.bind import bind
from arealens.operators.materialize import materialize

#: Items of fewer words are one window.
WINDOW = 8
#: Windows of fewer different words beside the placeholders match only with the same values; so do items of so few words.
LEAST_LITERALS = 3
#: Share of an item's windows that an occurrence must hold.
COVERAGE = 0.5
#: Benchmark windows up to which they are broadcast (about 150 MB); above, the join is shuffled.
BROADCAST_WINDOWS = 1_000_000
BROADCAST_HITS = 500_000
SLOTS = ("0", "1", "2", "#")
#: Units after a number.
UNITS = (
    "kg", "g", "mg", "lb", "lbs", "oz", "km", "m", "cm", "mm", "mi", "ft", "inches", "meters", "metres", "kilometers", "kilometres", "miles", "feet", "yards",
    "s", "sec", "seconds", "min", "minutes", "h", "hours", "days", "weeks", "months", "years", "liters", "litres", "ml", "l", "gallons",
    "mph", "kmh", "percent", "dollars", "euros", "cents", "degrees", "watts", "volts", "joules", "bytes", "kb", "mb", "gb",
)
_NUMBER = r"\d+(?:[.,]\d+)*"
_WORDS = _NUMBER + r"|\p{L}+"
#: In a text with single blanks.
_NAME = r"\p{Lu}(?<=[\p{Ll}0,;:] \p{Lu})\p{Ll}+(?!\p{L})"
_ANY_NAME = r"(?<!\p{L})\p{Lu}\p{Ll}+(?!\p{L})"
_CAPITALISED = r"^\p{Lu}\p{Ll}+$"


def raw_words(text: Column) -> Column:
    """Letters and numbers of a text in order, aligned with ``template_words``."""
    return F.regexp_extract_all(text, F.lit(_WORDS), F.lit(0))


def template_words(text: Column, name: str = _NAME) -> Column:
    """The same words lower-cased, with 0 for a number, 1 for a name, 2 for a unit."""
    folded = F.regexp_replace(F.regexp_replace(text, _NUMBER, " 0 "), r"[\s\p{Z}]+", " ")
    named = F.regexp_replace(folded, name, " 1 ")
    units = F.regexp_replace(named, r"(?i)(?<= 0 ) ?(?:" + "|".join(UNITS) + r")(?!\p{L})", "2")
    return _lowered(F.regexp_extract_all(units, F.lit(r"[012]|\p{L}+"), F.lit(0)))


def _codes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _lowered(raw: Column) -> Column:
    return F.transform(raw, lambda w: F.lower(w))


def _hash(codes: Column, exact: Column) -> Column:
    """One value of a window's word codes; ``exact`` tells windows of lower-cased words from those of templates."""
    return F.xxhash64(exact, codes)


def _windows(codes: Column, size: Column, exact: Column) -> Column:
    """Hashes of all runs of ``size`` words."""
    last = F.size(codes) - size
    hashes = F.transform(F.sequence(F.lit(1), last + 1), lambda i: _hash(F.slice(codes, i, size), exact))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def _read(rows: DataFrame, text: Column, keep: list[str], item: bool = False) -> DataFrame:
    """``keep`` and two readings a row: words, template, and ``places``, the number of the word where each begins.

    In the collapsed reading a run of placeholders is one word, its words joined by blanks. Of items there is also ``fixed``:
    those words of a run that only begin a sentence. Arrays are bound once, not built anew for each of their elements.
    """

    def fixed_words(t: Column, names: Column) -> Column:
        def kept(w: Column, i: Column) -> Column:
            begins = (F.get(t["wide"], i) == "1") & (F.get(t["template"], i) != "1") & ~F.array_contains(names, w)
            return F.when(begins, w)

        return F.transform(t["words"], kept)

    def runs(words: Column, places: Column, n: Column) -> Column:
        return F.transform(places, lambda p, k: F.array_join(F.slice(words, p + 1, F.coalesce(F.get(places, k + 1), n) - p), " "))

    def of_places(t: Column, numbers: Column, places: Column) -> Column:
        codes = F.transform(places, lambda i: F.when(F.get(t["wide"], i).isin(*SLOTS), F.lit("#")).otherwise(F.get(t["wide"], i)))
        fixed = [F.lit(None).cast("array<string>")] * 2
        if item:
            names = F.filter(t["words"], lambda w, i: F.get(t["template"], i) == "1")
            fixed = [F.transform(t["words"], lambda w: F.lit("")), bind(bind(names, lambda found: fixed_words(t, found)), lambda f: runs(f, places, t["n"]))]
        return F.array(
            F.struct(F.lit(False).alias("collapsed"), t["words"].alias("words"), t["template"].alias("template"), numbers.alias("places"), fixed[0].alias("fixed")),
            F.struct(F.lit(True).alias("collapsed"), runs(t["words"], places, t["n"]).alias("words"), codes.alias("template"), places.alias("places"), fixed[1].alias("fixed")),
        )

    def of_words(t: Column) -> Column:
        numbers = F.when(t["n"] > 0, F.sequence(F.lit(0), t["n"] - 1)).otherwise(F.array().cast("array<int>"))

        def begins(i: Column) -> Column:
            return ~F.get(t["wide"], i).isin(*SLOTS) | (i == 0) | ~F.get(t["wide"], i - 1).isin(*SLOTS)

        return bind(F.filter(numbers, begins), lambda places: of_places(t, numbers, places))

    given = F.struct(raw_words(text).alias("raw"), template_words(text).alias("template"), template_words(text, _ANY_NAME).alias("wide"))
    words = F.struct(
        _lowered(F.col("s.raw")).alias("words"), F.col("s.template").alias("template"), F.col("s.wide").alias("wide"), F.size("s.raw").alias("n")
    )
    columns = rows.select(*keep, F.explode(F.array(given)).alias("s")).select(*keep, F.size("s.raw").alias("n"), F.get("s.raw", F.lit(0)).alias("opener"), bind(words, of_words).alias("readings"))
    return columns.select(*keep, "n", "opener", F.explode("readings").alias("r")).select(*keep, "n", "opener", "r.*")


def _benchmark(items: DataFrame) -> DataFrame:
    """(item_id, collapsed, size, n_windows, at, exact, opening, hash, window, item_words, fixed, anchor, seed): windows of the items.

    Each window is there by its lower-cased words (``exact``) and, with enough literals, by its template.
    The first word of an item may look like a name where a text leads up to it: ``opening`` windows have
    a name in its place and match where the word is the same. Anchors of ``seed`` windows are enough to find the texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text"))
    sized = _read(given, F.col("text"), ["item_id"], item=True).withColumn("size", F.least(F.size("words"), F.lit(WINDOW))).where("size > 0")
    sized = sized.withColumn("n_windows", F.size("words") - F.col("size") + 1)
    each = sized.select("*", F.explode(F.sequence(F.lit(1), F.col("n_windows"))).alias("at"))
    window, words = F.slice("template", F.col("at"), F.col("size")), F.slice("words", F.col("at"), F.col("size"))
    opened = F.transform(window, lambda w, i: F.when(i == 0, F.lit("1")).otherwise(w))
    literal = F.transform(words, lambda w: F.lit("w"))

    def loose(template: Column) -> Column:
        return F.size(F.array_distinct(F.filter(template, lambda w: ~w.isin(*SLOTS)))) >= LEAST_LITERALS

    def form(codes: Column, shown: Column, exact: bool, opening: bool, taken: Column) -> Column:
        return F.when(taken, F.struct(F.lit(exact).alias("exact"), F.lit(opening).alias("opening"), _hash(_codes(codes), F.lit(exact)).alias("hash"), shown.alias("shown")))

    plain = ~F.col("collapsed")
    first = plain & (F.col("at") == 1) & F.col("opener").rlike(_CAPITALISED) & loose(opened)
    forms = F.array(form(words, literal, True, False, plain), form(window, window, False, False, loose(window)), form(opened, opened, False, True, first))
    names = ["item_id", "collapsed", "size", "n_windows", "at", "exact", "opening", "hash", "window", "item_words", "fixed"]
    kept = F.slice("fixed", F.col("at"), F.col("size"))
    rows = each.select("item_id", "collapsed", "size", "n_windows", "at", window.alias("window"), words.alias("item_words"), kept.alias("fixed"), F.explode(F.filter(forms, lambda f: f.isNotNull())).alias("form"))
    rows = rows.select("item_id", "collapsed", "size", "n_windows", "at", "form.*", "window", "item_words", "fixed")
    # two neighbouring words, or one, may be an anchor where the form holds them as they are
    def literal_at(i: Column) -> Column:
        return ~F.get("shown", i).isin(*SLOTS)

    singles = F.transform(F.filter(F.sequence(F.lit(0), F.col("size") - 1), literal_at), lambda i: F.array(F.get("item_words", i)))
    pairs = F.transform(
        F.filter(F.sequence(F.lit(0), F.greatest(F.col("size") - 2, F.lit(0))), lambda i: (i + 1 < F.col("size")) & literal_at(i) & literal_at(i + 1)),
        lambda i: F.array(F.get("item_words", i), F.get("item_words", i + 1)),
    )
    spread = rows.select(*names, F.explode(F.when(F.size(pairs) > 0, pairs).otherwise(singles)).alias("words"))
    items_of = spread.groupBy("words").agg(F.countDistinct("item_id").alias("items"))
    rarity = F.struct("items", (-F.length(F.array_join("words", ""))).alias("long"), "words")
    best = spread.join(items_of, "words").groupBy(*names).agg(F.min(rarity).alias("best"))
    # all forms of so many positions that an occurrence, which holds COVERAGE of them, cannot miss them all
    order = Window.partitionBy("item_id", "collapsed").orderBy("worst", "at")
    places = best.groupBy("item_id", "collapsed", "at", "n_windows").agg(F.max("best").alias("worst")).withColumn("rank", F.row_number().over(order))
    seeds = places.where(F.col("rank") <= F.col("n_windows") - F.ceil(F.col("n_windows") * COVERAGE) + 1)
    flagged = best.join(seeds.select("item_id", "collapsed", "at", "n_windows", F.lit(True).alias("seed")), ["item_id", "collapsed", "at", "n_windows"], "left")
    return flagged.select(*names, F.col("best.words").alias("anchor"), F.coalesce("seed", F.lit(False)).alias("seed"))


def _candidates(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, print) of the texts that hold an anchor of a seed window."""
    seeds = materialize(windows.where("seed").select(F.size("anchor").alias("size"), F.xxhash64("anchor").alias("seed")).distinct(), "seeds")
    counts = {r["size"]: r["n"] for r in seeds.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # sizes 1 and 2
    listed = seeds.select("seed")
    listed = F.broadcast(listed) if sum(counts.values()) <= BROADCAST_WINDOWS else listed
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), F.explode(F.array(raw_words(text))).alias("raw"))
    words = words.select("doc_id", "print", "raw", F.slice("raw", F.lit(2), F.greatest(F.size("raw"), F.lit(1))).alias("next"))
    words = words.select("doc_id", "print", F.explode(F.arrays_zip("raw", "next")).alias("z"))
    own = F.lower("z.raw")
    hashes = {1: F.xxhash64(F.array(own)), 2: F.xxhash64(F.array(own, F.lower("z.next")))}
    found = [hashes[size].alias("seed") for size in counts]
    hits = [words.select("doc_id", "print", h).join(listed, "seed", "left_semi").select("doc_id", "print") for h in found]
    if not hits:
        return materialize(words.where("false").select("doc_id", "print"), "candidates")
    return materialize(reduce(lambda a, b: a.unionByName(b), hits).distinct(), "candidates")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Occurrences (doc_id, print, item_id, start, n_words, coverage, same_values) of benchmark items in ``docs``.

    ``print`` is a hash of the text: repeated rows share their occurrences. ``same_values`` tells a copy
    from a question with other values. Null and empty texts, and such items, have no words; items of one or two
    words are found as they are, in any case of letters.
    """
    windows = materialize(_benchmark(benchmark), "benchmark")
    few = windows.count() <= BROADCAST_WINDOWS
    candidates = _candidates(docs, windows)
    listed = F.broadcast(candidates) if candidates.count() <= BROADCAST_HITS else candidates
    listed = listed.withColumnsRenamed({"doc_id": "hit_id", "print": "hit_print"})
    kinds = [(r["collapsed"], r["size"], r["exact"]) for r in windows.select("collapsed", "size", "exact").distinct().collect()]  # at most 24
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text"))
    given = given.join(listed, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("print") == F.col("hit_print")), "left_semi")
    read = materialize(_read(given, F.col("text"), ["doc_id", "print"]).drop("opener", "fixed"), "read")
    coded = read.select("doc_id", "print", "collapsed", _codes(F.col("words")).alias("lowered"), _codes(F.col("template")).alias("template"))
    forms = F.array(*[F.struct(F.lit(c).alias("of"), F.lit(size).alias("size"), F.lit(exact).alias("exact")) for c, size, exact in kinds or [(False, 1, True)]])
    each = coded.withColumn("form", F.explode(forms)).where(F.col("form.of") == F.col("collapsed"))
    codes = F.when(F.col("form.exact"), F.col("lowered")).otherwise(F.col("template"))
    # only numbers are spread out; the words of what is found are fetched below
    each = each.select("doc_id", "print", "collapsed", F.posexplode(_windows(codes, F.col("form.size"), F.col("form.exact"))).alias("begin", "hash"))
    targets = windows.drop("anchor", "seed")
    met = each.join(F.broadcast(targets) if few else targets, ["hash", "collapsed"]).withColumnsRenamed({"doc_id": "m_id", "print": "m_print", "collapsed": "m_collapsed"})
    columns = ["item_id", "at", "n_windows", "opening", "window", "item_words", "fixed", "begin", "size"]
    met = met.groupBy("m_id", "m_print", "m_collapsed").agg(F.collect_set(F.struct(*columns)).alias("met"))
    same_row = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("print") == F.col("m_print")) & (F.col("collapsed") == F.col("m_collapsed"))
    fetched = read.dropDuplicates(["doc_id", "print", "collapsed"]).join(met, same_row)

    def with_words(m: Column) -> Column:
        begin, end = F.get("places", m["begin"]), F.coalesce(F.get("places", m["begin"] + m["size"]), F.col("n"))
        return F.struct(*[m[c].alias(c) for c in columns], begin.alias("from"), end.alias("to"), F.slice("words", m["begin"] + 1, m["size"]).alias("doc_words"))

    found = fetched.select("doc_id", "print", "collapsed", F.explode(F.transform("met", with_words)).alias("m")).select("doc_id", "print", "collapsed", "m.*")
    stays = F.forall(
        F.arrays_zip("fixed", "doc_words"),
        lambda z: (z["fixed"] == "") | F.forall(F.split(z["fixed"], " "), lambda w: F.array_contains(F.split(z["doc_words"], " "), w)),
    )
    found = found.where(stays & (~F.col("opening") | (F.get("item_words", F.lit(0)) == F.get("doc_words", F.lit(0)))))
    zipped = F.filter(F.arrays_zip("window", "item_words", "doc_words"), lambda z: z["window"].isin(*SLOTS))
    slots = F.transform(zipped, lambda z: F.struct(F.concat(z["window"], z["item_words"]).alias("asked"), z["doc_words"].alias("got")))
    runs = found.select("doc_id", "print", "item_id", "collapsed", (F.col("begin") - F.col("at")).alias("shift"), "at", "n_windows", "from", "to", slots.alias("slots"))
    # an occurrence has at most as many windows as the item has words
    runs = runs.groupBy("doc_id", "print", "item_id", "collapsed", "shift").agg(
        F.size(F.collect_set("at")).alias("windows"), F.max("n_windows").alias("n_windows"), F.min("from").alias("from"), F.max("to").alias("to"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    consistent = F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["asked"])))
    coverage = F.col("windows") / F.col("n_windows")
    same = F.forall("slots", lambda s: F.substring(s["asked"], 2, 1 << 30) == s["got"])
    kept = runs.where(consistent & (coverage >= COVERAGE)).withColumn("plain", F.bool_or(~F.col("collapsed")).over(Window.partitionBy("doc_id", "print", "item_id")))
    # the collapsed reading only where the other found nothing
    return kept.where(~F.col("collapsed") | ~F.col("plain")).select(
        "doc_id", "print", "item_id", F.col("from").alias("start"), (F.col("to") - F.col("from")).alias("n_words"), coverage.alias("coverage"), same.alias("same_values")
    )


def mark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, contaminated, n_items, items (ids, sorted, comma-joined).

    A row is contaminated by an item (item_id, text) when some occurrence holds ``COVERAGE`` of the
    item's windows with consistent slots; an item of one or two words by its words in a row, in any case of
    letters. Null and empty texts are clean, whole texts are read however long; repeated rows share
    their result; further columns are ignored; an empty table gives no rows, an empty benchmark no item.
    """
    hits = find_leaks(docs, benchmark).groupBy("doc_id", "print").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    hits = materialize(hits, "leaks")
    listed = F.broadcast(hits) if hits.count() <= BROADCAST_HITS else hits
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"))
    joined = rows.join(listed.withColumnRenamed("doc_id", "hit_id").withColumnRenamed("print", "hit_print"), F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("print") == F.col("hit_print")), "left")
    return joined.select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.col("items").cast("array<string>"), ","), F.lit("")).alias("items"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with their columns."""
    hits = materialize(find_leaks(docs, benchmark).select("doc_id", "print").distinct(), "leaks")
    listed = F.broadcast(hits) if hits.count() <= BROADCAST_HITS else hits
    listed = listed.select(F.struct(F.col("doc_id").alias("id"), "print").alias("hit"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("print")).alias("key")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row)
    return keyed.join(listed, F.col("key") == F.col("hit"), "left_anti").select("row.*")
