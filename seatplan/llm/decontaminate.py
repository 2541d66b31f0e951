"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and units become typed placeholders, so a question asked again with other numbers and people keeps its
template. Windows of ``size`` template words of every text are hash-joined with the benchmark's. (An item with fewer words
is one window of its own length.) A window with fewer than ``literal`` words that are no placeholders is joined by its
words as written instead; one of placeholders only counts at full length only. Windows that meet are compared word by word.

A text holds an item if in one of these groups of windows ``least`` (all, where the item has fewer) match in distinct places of
the item and at least ``agree`` of the slot values are consistent, each of them in at least ``agree`` of its places: a
benchmark value must always stand for the same value of the same type.

- an occurrence: windows of one distance between the places in text and item, exact or within a few words (``SPANS``), so
  that neither a window which the item repeats nor another variant of the item in the text disturbs it;
- all windows of the text, for occurrences with more put in between;
- all windows that are equal as written, whatever the others say. These alone may have too few literal words.

A number is digits with marks, or number words of the four languages of the corpus, compounds included ("twenty-five",
"fünfundzwanzig"); a name is any capitalised word, at the start of a sentence too, but for ``STARTERS``; a unit is one of
``UNITS`` after a number. Words are compared lower-cased without ASCII punctuation.

Null and empty texts or items match nothing; null keys match nothing. Rows that share a key are one document.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatplan.llm import common

# Words of the four languages.
UNITS = (
    "percent kg g mg kilogram kilograms gram grams pound pounds ounce ounces ton tons tonnes km m cm mm mile miles kilometers kilometres "
    "meter meters metre metres foot feet inch inches yard yards liter liters litre litres ml gallon gallons cup cups second seconds "
    "minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros degrees mph "
    "kilos gramos metros kilómetros litros segundos minutos horas días semanas meses años pesos "
    "grammes mètres kilomètres secondes heures jours semaines mois ans"
)
NUMBER_WORDS = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen "
    "dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve "
    "veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien ciento mil "
    "deux trois quatre cinq sept huit neuf dix onze douze treize quatorze seize vingt trente quarante cinquante soixante cent mille "
    "zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn "
    "zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend"
)
STARTERS = (
    "The An This That These Those If When While After Before How What Which Who Where Why There Then In On At For From With And But Or So "
    "As It Its He She They We You His Her Their Each Every All Some Is Are Was Were Do Does Did Can Find Suppose Given Let "
    "El La Los Las Un Una Si Cuando Cuánto Cuántos Cuántas Qué En De Por Para Con Es Hay Se Su Cada "
    "Le Les Une Des Du Il Elle Ils Elles Quand Combien Que Dans Sur Avec Est Et "
    "Der Die Das Ein Eine Einen Wenn Wie Was Welche Wer Wo Im Am Mit Und Er Sie Es Ist Jeder"
)
#: Widths of the ranges of distances that count as one occurrence; each is laid twice, so that half a width is never cut.
SPANS = (4, 16)
_WHITE = "[\\x20\\x09-\\x0D]+"
_MARKS = "!\"#$%&'()*+,-./:;=?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Settings:
    size: int = 8
    literal: int = 4
    least: int = 4
    agree: float = 0.9


def _any_of(words: str | list[str]) -> str:
    """A pattern of the words, the longest first, that branches on the first letter."""
    by_letter: dict[str, set[str]] = {}
    for word in words.split() if isinstance(words, str) else words:
        by_letter.setdefault(word[0], set()).add(word[1:])
    return "(?:" + "|".join(f"{first}(?:{'|'.join(sorted(rest, key=lambda x: (-len(x), x)))})" for first, rest in by_letter.items()) + ")"


def _number_pattern() -> str:
    """Number words as written, or with a first capital; several that hyphens or German "und" join are one number."""
    both = [x for word in NUMBER_WORDS.split() for x in (word, word[0].upper() + word[1:])]
    digit, ten = "(?:[Ee]in|[Zz]wei|[Dd]rei|[Vv]ier|[Ff]ünf|[Ss]echs|[Ss]ieben|[Aa]cht|[Nn]eun)", "(?:zwanzig|dreißig|vierzig|fünfzig|sechzig|siebzig|achtzig|neunzig)"
    word = f"(?:{digit}und{ten}|{_any_of(both)})(?!\\p{{L}})"
    first = "".join(sorted({x[0] for x in both}))
    return f"(?=[{first}])(?<!\\p{{L}}){word}(?:-(?:et-)?{word})*"


# patterns begin with what fails soonest at most places
_NUMBER = _number_pattern()
_NAME = f"(?=\\p{{Lu}}\\p{{Ll}})(?<![\\p{{L}}\\p{{N}}])(?!{_any_of(STARTERS)}(?!\\p{{L}}))\\p{{Lu}}\\p{{Ll}}+(?:-?\\p{{Lu}}\\p{{Ll}}+)*"
_UNIT = f"<num> {_any_of(UNITS)}(?!\\p{{L}})"


def _typed(text: Column) -> Column:
    """The text with placeholders; white space stays as it is, so words keep their places."""
    text = F.regexp_replace(text, _NUMBER, "<num>")
    text = F.regexp_replace(text, _NAME, "<name>")
    text = F.regexp_replace(text, "[$€£]?[0-9][0-9.,:]*[0-9a-z%]*", "<num>")
    return F.regexp_replace(text, _UNIT, "<num> <unit>")


def _split(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.lower(text), _MARKS, ""), _WHITE), lambda w: w != "")


def template(text: Column) -> Column:
    """The template words of a text."""
    return _split(_typed(text))


def slotted(text: Column) -> Column:
    """The same words as structs of the template word ``t`` and the word as written ``w``."""
    typed = F.transform(F.split(_typed(text), _WHITE), lambda w: F.translate(F.lower(w), _MARKS, ""))
    plain = F.transform(F.split(text, _WHITE), lambda w: F.translate(F.lower(w), _MARKS, ""))
    both = F.zip_with(typed, plain, lambda t, w: F.named_struct(F.lit("t"), t, F.lit("w"), w))
    return F.filter(both, lambda x: x["t"] != "")


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once: a plain projection would be repeated inside each lambda."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _hash(words: Column) -> Column:
    return F.xxhash64(F.transform(words, lambda w: F.xxhash64(w)))


def _windows(text: Column, size: int, literal: int) -> Column:
    """Hashes of all windows, as an array: of template words, or of the words as written where too few are literal."""

    def each(x: Column) -> Column:
        t, h, at, last = x["t"], x["h"], x["open"], F.size(x["h"]) - size
        plain = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(h, i + 1, size)))

        def mixed(y: Column) -> Column:
            w, flags = y["w"], y["f"]

            def cut(i: Column) -> Column:
                open_ = F.size(F.filter(F.slice(flags, i + 1, size), lambda o: o))
                return F.xxhash64(F.when(open_ > size - literal, F.slice(w, i + 1, size)).otherwise(F.slice(h, i + 1, size)))

            return F.transform(F.sequence(F.lit(0), last), cut)

        # few texts have so many placeholders so near each other
        many = size - literal + 1
        dense = F.exists(F.sequence(F.lit(1), F.size(at) - many + 1), lambda j: F.element_at(at, j + many - 1) - F.element_at(at, j) < size)
        both = F.named_struct(F.lit("w"), F.transform(_split(text), lambda w: F.xxhash64(w)), F.lit("f"), F.transform(t, lambda w: w.startswith("<")))
        written = _once(both, mixed)
        return F.when(last < 0, F.array().cast("array<bigint>")).when(F.size(at) < many, plain).when(dense, written).otherwise(plain)

    def words(t: Column) -> Column:
        places = F.filter(F.transform(t, lambda w, i: F.when(w.startswith("<"), i)), lambda i: i.isNotNull())
        return F.named_struct(F.lit("t"), t, F.lit("h"), F.transform(t, lambda w: F.xxhash64(w)), F.lit("open"), places)

    return _once(_once(template(text), words), each)


def _literal(window: Column) -> Column:
    return F.size(F.filter(window, lambda w: ~w.startswith("<")))


def benchmark_windows(items: DataFrame, s: Settings, key: str = "item_id") -> DataFrame:
    """``(_hash, item_id, _at, _size, _window, _loose)`` of every window; ``_window`` holds words and values.

    ``_loose`` windows have enough literal words to be found with other values; the hash of the others is of the words as written.
    """
    words = items.filter(F.col(key).isNotNull() & F.col("text").isNotNull()).select(F.col(key).alias("item_id"), slotted(F.col("text")).alias("_words"))
    sized = words.withColumn("_size", F.least(F.lit(s.size), F.size("_words"))).filter("_size > 0")
    placed = sized.select("item_id", "_size", "_words", F.explode(F.sequence(F.lit(0), F.size("_words") - F.col("_size"))).alias("_at"))
    cut = placed.select("item_id", "_at", "_size", F.slice("_words", F.col("_at") + 1, F.col("_size")).alias("_window"))
    types, values = F.transform("_window", lambda x: x["t"]), F.transform("_window", lambda x: x["w"])
    loose = _literal(types) >= F.least(F.lit(s.literal), F.col("_size"))
    whole = cut.filter((_literal(types) > 0) | (F.col("_size") == s.size)).withColumn("_loose", loose)
    return whole.withColumn("_hash", F.when(F.col("_loose"), _hash(types)).otherwise(_hash(values)))


def _group(kind: int, place: Column) -> Column:
    return F.named_struct(F.lit("kind"), F.lit(kind), F.lit("place"), place.cast("long"))


def find(docs: DataFrame, items: DataFrame, settings: Settings | None = None, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """``(doc_id, item_id, n_windows, n_item_windows, n_slots, n_changed)`` of every text that holds an item.

    ``n_windows`` counts the places of the item that the text matches anywhere. ``n_slots`` counts the item's slot values that
    the agreeing group with the most windows fills (see above), ``n_changed`` those filled with other values.
    """
    s = settings or Settings()
    known = benchmark_windows(items, s, item)
    sizes = sorted(r[0] for r in known.select("_size").distinct().collect())  # size at most
    given = docs.filter(F.col(key).isNotNull() & F.col("text").isNotNull()).select(F.col(key).alias("doc_id"), F.col("text").alias("_text"))
    wanted = known.select("_hash").distinct()
    hits = None
    for size in sizes or [s.size]:
        each = given.select("doc_id", F.posexplode(_windows(F.col("_text"), size, min(s.literal, size))).alias("_pos", "_hash"))
        found = each.join(wanted, "_hash", "left_semi").withColumn("_size", F.lit(size))
        hits = found if hits is None else hits.unionByName(found)
    # what met by hash is a small part of the texts; only these are read again, with their values
    hits = common.written(hits, "template-hits")
    few = hits.select("doc_id").distinct()
    spots = hits.groupBy("doc_id").agg(F.collect_set(F.struct("_pos", "_size", "_hash")).alias("_spots"))
    again = given.join(common.written(few, "template-docs"), "doc_id", "left_semi").join(spots, "doc_id")

    def cut(words: Column) -> Column:
        names = ("_pos", "_size", "_hash")
        return F.transform(
            "_spots",
            lambda p: F.named_struct(*[x for n in names for x in (F.lit(n), p[n])], F.lit("_mine"), F.slice(words, p["_pos"] + 1, p["_size"])),
        )

    seen = again.select("doc_id", F.inline(_once(slotted(F.col("_text")), cut)))
    same = F.transform("_mine", lambda x: x["t"]) == F.transform("_window", lambda x: x["t"])
    equal = F.transform("_mine", lambda x: x["w"]) == F.transform("_window", lambda x: x["w"])
    met = common.written(
        seen.join(known, ["_hash", "_size"])
        .withColumn("_equal", equal)
        .filter(same & (F.col("_loose") | F.col("_equal")))
        .select("doc_id", "item_id", "_at", (F.col("_pos") - F.col("_at")).alias("_off"), "_loose", "_equal", "_window", "_mine"),
        "template-matches",
    )
    slots = F.filter(
        F.zip_with("_window", "_mine", lambda a, b: F.named_struct(F.lit("t"), a["t"], F.lit("asked"), a["w"], F.lit("got"), b["w"])),
        lambda x: x["t"].startswith("<"),
    )
    # groups of windows: kind 0 is one of all windows, 1 of equal ones, the others are occurrences
    pooled, as_written = _group(0, F.lit(0)), _group(1, F.lit(0))
    ranges = [(F.col("_off") + shift, width) for width in SPANS for shift in (0, width // 2)]
    near = [_group(2 + k, F.floor(off / width)) for k, (off, width) in enumerate([(F.col("_off"), 1), *ranges])]
    none = F.array().cast("array<struct<kind:int,place:bigint>>")
    groups = F.concat(F.when(F.col("_loose"), F.array(pooled, *near)).otherwise(none), F.when(F.col("_equal"), F.array(as_written)).otherwise(none))
    grouped = met.select("doc_id", "item_id", "_at", slots.alias("_slots"), F.inline(groups))
    group = ["doc_id", "item_id", "kind", "place"]
    # the most frequent filling of a value in a group is its meaning; others disagree
    filled = (
        grouped.select(*group, F.explode("_slots").alias("x"))
        .groupBy(*group, "x.t", "x.asked", "x.got")
        .agg(F.count("*").alias("n"))
        .groupBy(*group, "t", "asked")
        .agg(F.max("n").alias("most"), F.sum("n").alias("n"), F.max((F.col("got") != F.col("asked")).cast("int")).alias("changed"))
        .groupBy(*group)
        .agg(F.sum((F.col("most") >= s.agree * F.col("n")).cast("int")).alias("_good"), F.count("*").alias("n_slots"), F.sum("changed").alias("n_changed"))
    )
    size_of = known.groupBy("item_id").agg(
        F.countDistinct("_at").alias("n_item_windows"), F.countDistinct(F.when(F.col("_loose"), F.col("_at"))).alias("_n_loose")
    )
    enough = F.least(F.lit(s.least).cast("long"), F.when(F.col("kind") == 1, F.col("n_item_windows")).otherwise(F.col("_n_loose")))
    counted = grouped.groupBy(*group).agg(F.countDistinct("_at").alias("_n")).join(size_of, "item_id").filter(F.col("_n") >= enough)
    agreeing = (
        counted.join(filled, group, "left")
        .filter(F.col("n_slots").isNull() | (F.col("_good") >= s.agree * F.col("n_slots")))
        .withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_slots", "n_changed")})
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_item_windows").alias("n_item_windows"), F.max(F.struct("_n", (-F.col("n_changed")).alias("_same"), "n_slots", "n_changed")).alias("_best"))
    )
    held = met.groupBy("doc_id", "item_id").agg(F.countDistinct("_at").alias("n_windows")).join(agreeing, ["doc_id", "item_id"])
    return held.select("doc_id", "item_id", "n_windows", "n_item_windows", "_best.n_slots", "_best.n_changed")


def clean(docs: DataFrame, items: DataFrame, settings: Settings | None = None, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """The documents that hold no item, as they are, whatever their columns are called."""
    # written, so that Spark knows how few they are before it moves the texts to meet them
    held = common.written(find(docs, items, settings, key, item).select(F.col("doc_id").alias("_held")).distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("_doc"), F.col(key).alias("_key"))
    return rows.join(held, F.col("_key") == F.col("_held"), "left_anti").select("_doc.*")
