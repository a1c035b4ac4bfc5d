"""Quality rules with a distribution test against language references.

Base rules count words, symbols, repeated lines and repeated five-word windows. The test
compares two histograms of a document with those of its language, each by Jensen-Shannon
distance (base 2, 0 to 1): how its characters fall into classes, and how its words fall
on the language's commonest words. A reference is the mean over all documents of that
language that pass the base rules, every document counted with equal weight, and over
``POOLED`` documents more that look like the mean of all languages in the same kind of
script (with or without small and capital letters): a language of few documents is judged
by the pool, one of many by itself, and nothing changes at a count. A document that is too
short for a histogram is not judged by it, and this guard keeps it.

Everything is built-in column functions on one row; only the small references need a
shuffle. Defined results: a NULL or empty text has no words and fails the base rules;
rows that repeat an id with one text are judged alike; a NULL language is a language of its
own; a distance that equals its limit keeps the document; an empty table gives no rows; extra
columns are ignored. A long text is one row of one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.columns import whole_text

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5

#: Guards: shorter documents are not compared.
MIN_CLASS_CHARS = 200
MIN_COMMON_WORDS = 50
#: Weight of the mean of all languages in a reference, as a number of documents.
POOLED = 20
#: Greatest distance of prose of the language: of very long documents, and what is added to
#: it divided by the square root of the characters or words.
CLASS_LIMIT = (0.145, 1.6)
WORD_LIMIT = (0.27, 0.9)

# White space of the base rules, symbols, and common words by language.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
COMMON_WORDS = {
    "en": "the of and to a in is that was it for on are as with be at by",
    "de": "der die und in den von zu das mit sich des auf ist im dem ein eine nicht",
    "fr": "de la le et les des en un une du que est pour qui dans par sur au",
    "es": "de la que el en y a los se del las un por con una su para es",
}

#: Classes in the order in which they are taken out of the text; the rest is the last one.
CLASSES = {
    "lower": r"\p{Ll}++",
    "space": r"\s++",
    "upper": r"\p{Lu}++",
    "digit": r"\p{N}++",
    "mark": r"[.,;:!?'\"()\-]++",
}


def shares(counts: Column, enough: Column) -> Column:
    """A histogram as shares; NULL if it is empty or its document too short."""
    total = F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(enough & (total > 0), F.transform(counts, lambda x: x / total))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance of two histograms given as shares; NULL if one is missing."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x) / 2)))


def limit(at_large: float, noise: float, size: Column) -> Column:
    """Greatest distance of a document of ``size``: short ones differ more by chance."""
    return F.lit(at_large) + F.lit(noise) / F.sqrt(size.cast("double"))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice: sort windows by hash, keep those with
    an equal neighbour, and add up how far each reaches beyond the one before it."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i"))))

    def places(p: Column) -> Column:
        equal = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
        kept = F.filter(F.transform(p, lambda x, k: F.when(equal(x, k - 1) | equal(x, k + 1), x["i"])), lambda i: i.isNotNull())
        return F.array_sort(kept)

    def total(at: Column) -> Column:
        reach = lambda i, k: F.coalesce(F.least(F.lit(WINDOW), F.get(at, k + 1) - i), F.lit(WINDOW)).cast("long")
        return F.aggregate(F.transform(at, reach), F.lit(0).cast("long"), lambda acc, x: acc + x)

    # An array of one element binds the sorted array once for all uses of it.
    bound = F.transform(F.array(pairs), places)
    return F.coalesce(F.get(F.transform(bound, total), 0), F.lit(0).cast("long"))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts of the base rules and both histograms, one row per document, without a shuffle."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("words", _words(F.col("text")))
    windows = F.sequence(F.lit(0), F.size("words") - WINDOW)
    hashed = F.transform(windows, lambda i: F.xxhash64(*(F.get(F.col("words"), i + k) for k in range(WINDOW))))
    # Lower-case words without what is not a letter at their ends; only short ones can be common.
    plain = F.transform(F.filter("words", lambda w: F.char_length(w) <= 8), lambda w: F.lower(F.btrim(w, F.lit(".,;:!?'\"()"))))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    rows = rows.select(
        "doc_id",
        "lang",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(F.char_length(F.array_join("words", "")), F.lit(0)).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.when(F.size("words") >= WINDOW, hashed).alias("hashes"),
        _codes(plain).alias("codes"),
        F.regexp_replace("text", CLASSES["lower"], "").alias("no_lower"),
    )
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = rows.select(
        "doc_id",
        "lang",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, _covered(F.col("hashes"))).otherwise(0).cast("long").alias("n_repeat_words"),
        F.char_length("text").alias("n_chars"),
        "no_lower",
        "codes",
    )
    rows = rows.select(*rows.columns[:7], _class_counts().alias("classes"), _word_counts().alias("commons"))
    return rows.select(
        *rows.columns[:7],
        shares(F.col("classes"), F.col("word_chars") >= MIN_CLASS_CHARS).alias("class_share"),
        shares(F.col("commons"), (F.col("n_words") >= MIN_COMMON_WORDS) & F.col("lang").isin(*COMMON_WORDS)).alias("word_share"),
    )


def _letter(words: list[str]):
    """A lambda from a word to its letter, or NULL."""
    table = F.create_map(*(F.lit(x) for k, w in enumerate(words) for x in (w, chr(97 + k))))
    return lambda w: F.element_at(table, w)


def _codes(plain: Column) -> Column:
    """One letter for each common word of the document's language, in one string."""
    branches = F.lit("")
    for lang, words in COMMON_WORDS.items():
        found = F.array_join(F.transform(plain, _letter(words.split())), "")
        branches = F.when(F.col("lang") == lang, found).otherwise(branches)
    return branches


def _class_counts() -> Column:
    """Characters of each class, and of none, as an array of the counts."""
    left, counts = F.col("no_lower"), [F.col("n_chars") - F.char_length("no_lower")]
    for name in list(CLASSES)[1:]:
        rest = F.regexp_replace(left, CLASSES[name], "")
        counts.append(F.char_length(left) - F.char_length(rest))
        left = rest
    return F.array(*(c.cast("double") for c in [*counts, F.char_length(left)]))


def _word_counts() -> Column:
    """Words that are the first, second, ... common word, and all others."""
    size = max(len(w.split()) for w in COMMON_WORDS.values())
    each = [F.char_length("codes") - F.char_length(F.replace("codes", F.lit(chr(97 + k)), F.lit(""))) for k in range(size)]
    return F.array(*(c.cast("double") for c in [*each, F.col("n_words") - F.char_length("codes")]))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def uncased() -> Column:
    """Whether most letters of a document have no case, as far as its classes tell."""
    lower, upper, rest = (F.get(F.col("class_share"), k) for k in (0, list(CLASSES).index("upper"), len(CLASSES)))
    return F.coalesce(rest > lower + upper, F.lit(False))


def references(rows: DataFrame) -> DataFrame:
    """Mean histograms by language and kind of script, over all documents that pass the base rules
    and guards, with the pool of all languages mixed in."""
    sizes = {"class_share": len(CLASSES) + 1, "word_share": 1 + max(len(w.split()) for w in COMMON_WORDS.values())}

    def passed(name: str) -> Column:
        return F.when(~base_failed(), F.col(name))

    sums = [F.sum(F.get(passed(n), k)).alias(f"{n}_{k}") for n, size in sizes.items() for k in range(size)]
    each = rows.groupBy("lang", uncased().alias("uncased")).agg(*(F.count(passed(n)).alias(f"{n}_docs") for n in sizes), *sums)

    # These windows see one row for each language and kind of script.
    own, pool = Window.partitionBy("lang"), Window.partitionBy("uncased")

    def mixed(name: str, size: int) -> Column:
        n, all_ = F.sum(f"{name}_docs").over(own), F.sum(f"{name}_docs").over(pool)
        weight = F.when(all_ > 0, F.lit(float(POOLED))).otherwise(0.0)

        def share(k: int) -> Column:
            mine, theirs = (F.coalesce(F.sum(f"{name}_{k}").over(w), F.lit(0.0)) for w in (own, pool))
            return (mine + weight * F.coalesce(F.try_divide(theirs, all_), F.lit(0.0))) / (n + weight)

        return F.when(n + weight > 0, F.array(*map(share, range(size)))).alias(f"ref_{name}")

    return each.select(F.col("lang").alias("ref_lang"), F.col("uncased").alias("ref_uncased"), *(mixed(n, k) for n, k in sizes.items()))


def judged(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """The counts with both distances and the verdict ``kept``."""
    joined = rows.join(refs, rows["lang"].eqNullSafe(refs["ref_lang"]) & (uncased() == refs["ref_uncased"]), "left")
    joined = joined.withColumns({f"{n}_distance": jensen_shannon(F.col(f"{n}_share"), F.col(f"ref_{n}_share")) for n in ("class", "word")})
    far = (F.col("class_distance") > limit(*CLASS_LIMIT, F.col("word_chars"))) | (F.col("word_distance") > limit(*WORD_LIMIT, F.col("n_words")))
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & ~F.coalesce(far, F.lit(False))).alias("kept"),
        "class_distance",
        "word_distance",
    )
