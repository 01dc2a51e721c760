"""Quality rules: distribution divergence of a document from its language.

All in DataFrame functions, one pass over the texts and no shuffle of them.
Each document gets two histograms: characters by class, and its common words
(the function words of four languages, and all others as one bin). Their sums
over all documents that pass the base rules are the reference of each language.
A document is kept if its Jensen-Shannon distances to the reference are small;
a histogram of too few characters or words proves nothing and is not held
against a document (minimum-length guards). Base rules come first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import write_once

#: Function words of the references, by language.
COMMON = {
    "en": "the of and to in is that it for was on are as with they at be this have from or had by not but".split(),
    "fr": "de la le et les des en un du une que est pour qui dans sur au par il elle ne pas plus ou avec".split(),
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an werden aus er".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero".split(),
}
VOCABULARY = sorted({w for ws in COMMON.values() for w in ws})
#: Character classes, by regex; what matches none is the last bin.
CLASSES = (r"\p{Ll}", r"\p{Lu}", r"\p{Nd}", r"[\x20\x09-\x0D]", r"[.,;:'\"?!()\-]", r"[#*$%&|<>@=+/\\_~^{}\[\]`]")
LEAST_CHARS, LEAST_WORDS = 300, 100
CHAR_LIMIT, WORD_LIMIT = 0.25, 0.3
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"


def _dropped(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` match a class."""
    return F.length(text) - F.length(F.regexp_replace(text, f"(?:{pattern})+", ""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != F.lit(""))


def repeated_words(w: Column) -> Column:
    """Words inside 5-word windows that a text holds twice or more, the first
    included. Windows are compared by a 64-bit hash inside one text; sorting
    them brings equal ones together, and the starts of the equal ones, in order,
    each cover up to five words more."""
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)]))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = F.transform(F.array(pairs), lambda p: F.filter(p, lambda x, k: (
            F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)))))[0]
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        start = F.struct(F.lit(-5).alias("at"), F.lit(0).alias("n"))
        return F.aggregate(starts, start, lambda a, s: F.struct(s.alias("at"), (a["n"] + F.least(F.lit(5), s - a["at"])).alias("n")),
                           lambda a: a["n"])

    has = F.transform(F.array(hashes), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))[0]
    return F.when(n >= 6, has).otherwise(0).cast("long")


def measures(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The base measures and both histograms of each document."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    split = base.withColumn("w", words(F.col("text"))).withColumn("lines", lines)
    cased = [v for w in VOCABULARY for v in (w, w[0].upper() + w[1:], w.upper())]
    common = F.filter("w", lambda x: x.isin(*dict.fromkeys(cased)))
    counted = split.select(
        "doc_id", "lang", F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _dropped(F.col("text"), r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        F.length("text").alias("n_chars"), F.array(*[_dropped(F.col("text"), c) for c in CLASSES]).alias("chars"),
        F.lower(F.concat(F.lit("|"), F.array_join(common, "||"), F.lit("|"))).alias("common"))
    per_word = [((F.length("common") - F.length(F.replace("common", F.lit(f"|{w}|"), F.lit("")))) / (len(w) + 2)).cast("int") for w in VOCABULARY]
    counted = counted.withColumn("some", F.array(*per_word))

    def closed(bins: str, total: str) -> Column:
        return F.concat(bins, F.array((F.col(total) - F.aggregate(bins, F.lit(0), lambda a, x: a + x)).cast("int")))

    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return counted.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
                          closed("chars", "n_chars").alias("chars"), closed("some", "n_words").alias("commons"), failed.alias("base_failed"))


def _distance(bins: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of counts from a distribution."""
    def part(x: Column, q: Column) -> Column:
        p = x / total
        return F.when(p > 0, p * F.log2(p * 2 / (p + q))).otherwise(0.0) + F.when(q > 0, q * F.log2(q * 2 / (p + q))).otherwise(0.0)
    q = F.array(*[F.lit(v) for v in reference])
    sums = F.aggregate(F.zip_with(bins, q, part), F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(sums / 2, F.lit(0.0)))


def references(measured: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Mean character and word distributions of each language of ``COMMON``, over
    all documents that pass the base rules and the length guards."""
    n_c, n_w = len(CLASSES) + 1, len(VOCABULARY) + 1
    ok = measured.where(F.col("lang").isin(*COMMON) & ~F.col("base_failed") & (F.col("n_chars") >= LEAST_CHARS) & (F.col("n_words") >= LEAST_WORDS))
    sums = ok.groupBy("lang").agg(*[F.sum(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(n_c)],
                                  *[F.sum(F.get("commons", F.lit(i))).alias(f"w{i}") for i in range(n_w)])
    out = {}
    for r in sums.collect():  # a row for each language of COMMON at most
        c, w = [r[f"c{i}"] for i in range(n_c)], [r[f"w{i}"] for i in range(n_w)]
        out[r["lang"]] = [x / sum(c) for x in c], [x / sum(w) for x in w]
    return out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept.

    Null texts are empty and fail the base rules. A document of no listed
    language (or null) is compared with the reference nearest to it. Without any
    reference, and below the length guards, distances are null and not counted.
    Repeated rows stay; an empty table gives no rows."""
    measured = write_once(measures(docs, id_col, text_col, lang_col), "rule-measures")
    known = references(measured)

    def nearest(bins: str, total: str, least: int, which: int) -> Column:
        if not known:
            return F.lit(None).cast("double")
        each = {k: _distance(F.col(bins), F.col(total), v[which]) for k, v in sorted(known.items())}
        own = reduce(lambda a, kv: a.when(F.col("lang") == kv[0], kv[1]), each.items(), F.when(F.lit(False), F.lit(0.0)))
        best = F.least(*each.values()) if len(each) > 1 else next(iter(each.values()))
        return F.when(F.col(total) >= least, F.round(own.otherwise(best), 9))

    scored = measured.withColumn("char_distance", nearest("chars", "n_chars", LEAST_CHARS, 0)) \
        .withColumn("word_distance", nearest("commons", "n_words", LEAST_WORDS, 1))
    far = F.coalesce(F.col("char_distance") > CHAR_LIMIT, F.lit(False)) | F.coalesce(F.col("word_distance") > WORD_LIMIT, F.lit(False))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "char_distance", "word_distance", (~F.col("base_failed") & ~far).alias("kept"))
