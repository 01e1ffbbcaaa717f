"""Quality rules by distribution divergence (DataFrame operations only).

Base: counts of words (runs of characters other than space and \\x09-\\x0D),
their characters, symbols, repeated lines and words in repeated 3-word windows;
a text fails with fewer than 50 words, or with over half of its words in
repeated windows.

Method: two histograms of a text, of character classes and of its language's
most common words, are compared with the references of that language by the
Jensen-Shannon distance (root of the divergence in bits, 0 to 1). A text of
``min_words`` words or more goes if a distance is above its limit; shorter ones
are judged by the base alone, since their histograms say little.

References are fitted on every labelled row that passes the base; at most
``LANGS`` languages, the ones with most rows, have one of their own. Rows of no or
another language are compared with the pooled reference. References enter the plan
as literals: a few dozen numbers a language. Documents are measured once, and
staged with their words, for the references and the distances; texts are not
shuffled. Words are counted twice: all of them in ``SLOTS`` hash slots, then, by
themselves, those of a slot that holds enough for a common word. So a task sends
few counts however many words there are, and none of a common word is missing.

Windows are compared by 64-bit hashes within one text. Texts without equal
hashes are done; else equal ones stand side by side after a sort. With few
repeated windows their positions are looked up; with many, the 40 high bits of
a hash and the position share a long, sorted longs put equal windows side by
side, and whole hashes decide among those candidates (never a square of n).

Defined cases: a null text has no words, all counts 0, and fails; repeated rows
get a row each; with no labelled row that passes the base nothing is compared; ids
pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, staged

LANGS, COMMON, COMMON_SHARE, SLOTS = 64, 12, 0.002, 1 << 14
MIN_WORDS, CLASS_LIMIT, WORD_LIMIT = 100, 0.35, 0.55
_WS = " \t\n\x0b\f\r"
CLASSES = ["upper", "digit", "beyond_ascii", "punctuation", "symbol", "space", "other"]


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus words, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_chars_all and the counts of the character classes."""
    t = F.coalesce(quoted(text).cast("string"), F.lit(""))
    a = docs.select(*[quoted(c) for c in keep], t.alias("t"))
    a = a.select(*[quoted(c) for c in keep], "t", F.regexp_replace("t", r"[\x09-\x0D]", " ").alias("flat"))
    # what is neither a-z nor space is little: the other classes are counted in it
    a = a.select(*[quoted(c) for c in keep], "t", "flat", F.array_remove(F.split("flat", " "), "").alias("words"),
                 F.regexp_replace("flat", "[a-z ]+", "").alias("odd"))
    count = lambda rest: F.char_length(F.regexp_replace("odd", rest, "")).cast("long")
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(_WS)) != "")
    n = F.size("words") - 2
    three = F.arrays_zip(*[F.slice("words", i, n).alias(f"w{i}") for i in (1, 2, 3)])
    hashes = F.when(n > 0, F.transform(three, lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    return a.select(
        *[quoted(c) for c in keep], "words", F.size("words").cast("long").alias("n_words"),
        F.char_length("t").cast("long").alias("n_chars_all"),
        F.char_length(F.replace("flat", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        count(r"[^#*$%&|<>]+").alias("n_symbols"), count("[^A-Z]+").alias("upper"), count("[^0-9]+").alias("digit"),
        count(r"[\x00-\x7F]+").alias("beyond_ascii"), count(r"[^.,;:'\"!?()-]+").alias("punctuation"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _repeated(hashes).alias("n_repeat_words"))


def _repeated(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""
    high = F.lit(-(1 << 24))
    near = lambda x, y: F.shiftrightunsigned(x.bitwiseXOR(y), 24) == 0

    def candidates(h):
        packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(high).bitwiseOR(i.cast("long"))))
        return _let(packed, lambda p: F.transform(
            F.filter(p, lambda x, k: F.coalesce(near(x, F.get(p, k - 1)), F.lit(False))
                     | F.coalesce(near(x, F.get(p, k + 1)), F.lit(False))),
            lambda x: x.bitwiseAND(F.lit((1 << 24) - 1)).cast("int")))

    def by_sort(h):
        # beyond 2 ** 24 windows every position is a candidate
        cand = F.when(F.size(h) < (1 << 24), candidates(h)).otherwise(F.transform(h, lambda x, i: i))
        pairs = F.sort_array(F.transform(cand, lambda i: F.struct(F.get(h, i).alias("h"), i.alias("i"))))
        same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
        return _let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1))), lambda x: x["i"])))

    def covered(h):
        twice = _let(F.sort_array(h), lambda s: F.array_distinct(F.array_compact(F.zip_with(
            s, F.slice(s, F.lit(2), F.size(s)), lambda x, y: F.when(x == y, x)))))
        few = lambda d: F.filter(F.transform(
            h, lambda x, i: F.when(F.array_contains(d, x), i)), lambda i: i.isNotNull())
        at = _let(twice, lambda d: F.when(F.size(d) <= 64, few(d)).otherwise(by_sort(h)))
        return _let(at, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1), x + 3) - x)),
            F.lit(0).cast("long"), lambda s, x: s + x))
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                .otherwise(covered(h)))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def classes() -> Column:
    """Counts of the character classes, in the order of CLASSES."""
    space = F.col("n_chars_all") - F.col("word_chars")
    known = ["upper", "digit", "beyond_ascii", "punctuation", "n_symbols"]
    other = F.greatest(F.lit(0).cast("long"), F.col("word_chars") - sum((F.col(c) for c in known[1:]), F.col(known[0])))
    return F.array(*[F.col(c) for c in known], space, other)


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return _let(total, lambda n: F.transform(counts, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two share arrays (base 2)."""
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)))


def references(rows: DataFrame) -> dict:
    """lang (None: pooled) -> (class shares, common words, their shares and the
    rest's), from the staged rows of ``judged``."""
    rows = rows.where(F.col("lang").isNotNull() & ~base_failed())
    names = ["c%d" % i for i in range(len(CLASSES))]
    c = classes()
    per_row = rows.select("lang", "joined", "n_words", *[F.get(c, F.lit(i)).alias(n) for i, n in enumerate(names)])
    keyed = per_row.select(F.explode(F.array(F.col("lang"), F.lit(None).cast("string"))).alias("lang"),
                           "n_words", *names)
    sums = keyed.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_words").alias("n"),
                                     *[F.sum(n).alias(n) for n in names])
    sums = sums.orderBy(F.desc("rows"), "lang").limit(LANGS + 1).collect()
    totals = {r["lang"]: r for r in sums}
    if not totals:
        return {}
    size = F.create_map(*[x for k, r in totals.items() if k is not None for x in (F.lit(k), F.lit(r["n"]))])
    # a word with this share of a language: 1 / share of them at most, as of slots
    frequent = F.col("n") >= COMMON_SHARE * F.try_element_at(size, F.col("lang"))
    pooled = F.col("n") >= COMMON_SHARE * totals[None]["n"]

    def counted(words, by):
        n = words.groupBy("lang", by).agg(F.count(F.lit(1)).alias("n"))
        own = F.collect_list(F.when(frequent, F.struct("lang", "n"))).alias("own")
        return n.groupBy(by).agg(F.sum("n").alias("n"), own).where(pooled | (F.size("own") > 0))
    words = per_row.select("lang", F.explode(F.split("joined", " ")).alias("word"))
    words = words.withColumn("slot", F.pmod(F.xxhash64("word"), F.lit(SLOTS)).cast("int"))
    slots = [(r["slot"],) for r in counted(words, "slot").select("slot").collect()]
    full = rows.sparkSession.createDataFrame(slots, "slot int")
    common = counted(words.join(F.broadcast(full), "slot", "left_semi"), "word")
    found: dict = {k: [] for k in totals}
    for r in common.collect():
        if r["n"] >= COMMON_SHARE * totals[None]["n"]:
            found[None].append((-r["n"], r["word"]))
        for x in r["own"]:
            found[x["lang"]].append((-x["n"], r["word"]))
    out = {}
    for k, r in totals.items():
        top = sorted(found[k])[:COMMON]
        chars = sum(r[n] for n in names) or 1
        shares = [-n / r["n"] for n, _ in top]
        out[k] = ([r[n] / chars for n in names], [w for _, w in top], [*shares, max(0.0, 1 - sum(shares))])
    return out


def _choose(refs: dict, lang: Column, part: int, kind: str) -> Column:
    lit = lambda xs: F.array(*[F.lit(x) for x in xs]).cast(kind)
    own = [k for k in refs if k is not None]
    pooled = lit(refs[None][part]) if None in refs else F.lit(None).cast(kind)
    if not own:
        return pooled
    table = F.create_map(*[x for k in own for x in (F.lit(k), lit(refs[k][part]))])
    return F.coalesce(F.try_element_at(table, lang), pooled)


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
           min_words: int = MIN_WORDS, class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, class_distance, word_distance)."""
    named = docs.select(quoted(doc_id).alias("doc_id"), quoted(lang).cast("string").alias("lang"),
                        quoted(text).alias("text"))
    # written first: the text work is done once for references and distances, and
    # not pushed into their filters and lambdas
    rows = measured(named, ["doc_id", "lang"])
    rows = staged(rows.select(F.array_join("words", " ").alias("joined"), *[c for c in rows.columns if c != "words"]), "zstd")
    refs = references(rows)
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    if refs:
        key = F.col("lang")
        common = _choose(refs, key, 1, "array<string>")

        # two spaces between words, so each word has its own on both sides
        spaced = F.concat(F.lit(" "), F.replace("joined", F.lit(" "), F.lit("  ")), F.lit(" "))

        def shares_of(c):
            size = F.octet_length
            n = _let(spaced, lambda j: F.transform(c, lambda w: _let(F.concat(F.lit(" "), w, F.lit(" ")), lambda x: (
                (size(j) - size(F.replace(j, x, F.lit("")))) / size(x)))))
            return _let(n, lambda v: F.concat(v, F.array(
                F.col("n_words") - F.aggregate(v, F.lit(0.0), lambda s, x: s + x))))
        long = F.col("n_words") >= min_words
        by_class = js_distance(_shares(classes().cast("array<double>")), _choose(refs, key, 0, "array<double>"))
        by_word = js_distance(_shares(_let(common, shares_of)), _choose(refs, key, 2, "array<double>"))
        rows = rows.select("doc_id", *out, F.when(long, by_class).alias("class_distance"),
                           F.when(long, by_word).alias("word_distance"))
    else:
        none = F.lit(None).cast("double")
        rows = rows.select("doc_id", *out, none.alias("class_distance"), none.alias("word_distance"))
    fine = (F.coalesce(F.col("class_distance") <= class_limit, F.lit(True))
            & F.coalesce(F.col("word_distance") <= word_limit, F.lit(True)))
    return rows.select("doc_id", *out, base_failed().alias("base_failed"), (~base_failed() & fine).alias("kept"),
                       "class_distance", "word_distance")
