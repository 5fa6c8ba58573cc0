"""Quality rules: a table of thresholds compiled into one projection of JVM expressions.

Defined results: a null text counts as empty; an empty text has zero for every count and fails the word-count rule; repeated
rows are judged one by one; a table without rows gives none; other columns of the input are kept, and a column that bears the
name of an output column gives way to it. Texts may be of any length: the work is linear in the text but for one sort of 64-bit
numbers, taken only where a five-word window does repeat.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, let, text_of, words_of

WINDOW = 5
INDEX_BITS = 24
SYMBOLS = "#*$%&|<>"

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his are this at from but have an they which one you were all her she there would their we "
    "le la les de des et un une du que qui dans est pour pas sur au avec il ce ne se plus par son "
    "der die das und zu den von mit ist ein eine nicht auf im dem des sich auch es als für an "
    "el los las del y en que no una por con su para es lo al se como más"
).split()


@dataclass(frozen=True)
class Rule:
    """The document stays while least <= 100 * part / whole <= most; a rule with no whole bounds the part itself."""

    name: str
    part: str
    whole: str | None = None
    least: float | None = None
    most: float | None = None

    def holds(self) -> Column:
        value = F.col(self.part) if self.whole is None else 100 * F.col(self.part)
        scale = F.lit(1) if self.whole is None else F.col(self.whole)
        tests = [value >= self.least * scale] if self.least is not None else []
        tests += [value <= self.most * scale] if self.most is not None else []
        return reduce(lambda a, b: a & b, tests, F.lit(True))


#: The first two are the base; the others are the method's verdict. Percentages where there is a whole.
BASE = (Rule("enough words", "n_words", least=10), Rule("few repeated windows", "n_repeat_words", "n_words", most=20))
RULES = (
    Rule("words not too short", "word_chars", "n_words", least=200),
    Rule("words not too long", "word_chars", "n_words", most=1400),
    Rule("few symbols", "n_symbols", "n_words", most=20),
    Rule("stop words", "n_stop_words", "n_words", least=3),
    Rule("few repeated lines", "n_dup_lines", "n_lines", most=40),
)


def repeated_words(words: Column) -> Column:
    """Words in windows of five that occur at least twice in the array.

    Windows are compared by a 64-bit hash; when all hashes differ there is no repeat. Else the hashes, cut to 40 bits with the
    window's place in the low 24, are sorted and equal neighbours are compared word by word. One pair of equal hashes of
    different windows, or more windows than 24 bits can number, sends the text to a sort of the windows themselves.
    """

    def window(w, i):
        return [F.get(w, i + k) for k in range(WINDOW)]

    def covered(places):
        last = lambda p: F.transform(p, lambda x, k: F.least(F.lit(WINDOW).cast("long"), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW).cast("long"))))
        return let(F.sort_array(places), lambda p: F.aggregate(last(p), F.lit(0).cast("long"), lambda a, x: a + x))

    def exact(w):
        texts = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.struct(F.concat_ws(" ", *window(w, i)).alias("s"), i.cast("long").alias("i")))
        same = lambda s, k, x: F.coalesce(F.get(s, k)["s"] == x["s"], F.lit(False))
        return let(F.sort_array(texts), lambda s: covered(F.transform(F.filter(s, lambda x, k: ((k > 0) & same(s, F.greatest(k - 1, F.lit(0)), x)) | same(s, k + 1, x)), lambda x: x["i"])))

    def by_hash(w, hashes):
        packed = F.sort_array(F.transform(hashes, lambda x, i: F.shiftleft(x, INDEX_BITS).bitwiseOR(i.cast("long"))))
        place = lambda y: y.bitwiseAND(F.lit((1 << INDEX_BITS) - 1).cast("long"))
        key = lambda y: F.shiftright(y, INDEX_BITS)

        def places(s):
            before = lambda y, k: F.when(k > 0, key(F.get(s, k - 1)) == key(y)).otherwise(False)
            after = lambda y, k: F.coalesce(key(F.get(s, k + 1)) == key(y), F.lit(False))
            hits = F.filter(s, lambda y, k: before(y, k) | after(y, k))

            def verified(h):
                differ = lambda a, b: ~reduce(lambda p, q: p & q, [F.get(w, place(a).cast("int") + j) == F.get(w, place(b).cast("int") + j) for j in range(WINDOW)])
                clash = F.exists(F.sequence(F.lit(1), F.size(h) - 1), lambda k: (key(F.get(h, k)) == key(F.get(h, k - 1))) & differ(F.get(h, k), F.get(h, k - 1)))
                return F.when(F.size(h) < 2, F.lit(0).cast("long")).when(clash, exact(w)).otherwise(covered(F.transform(h, place)))

            return let(hits, verified)

        return let(packed, places)

    def counted(w):
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*window(w, i)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).when(F.size(w) < 1 << INDEX_BITS, by_hash(w, h)).otherwise(exact(w)))

    return let(words, lambda w: F.when(F.size(w) < WINDOW, F.lit(0).cast("long")).otherwise(counted(w)))


def without(text: Column, characters: str) -> Column:
    return reduce(lambda c, x: F.replace(c, F.lit(x), F.lit("")), characters, text)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with one column for each measure; words and lines are cut once."""
    t = text_of(text)
    own = ["n_words", "n_stop_words", "n_repeat_words", "n_lines", "n_dup_lines", "word_chars", "n_symbols"]

    def of_words(w):
        return F.struct(F.size(w).cast("long").alias("n_words"), F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop_words"), repeated_words(w).alias("n_repeat_words"))

    def of_lines(lines):
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    out = docs.drop(*own).withColumns(
        {
            "__w": let(words_of(t), of_words),
            "__l": let(lines, of_lines),
            "word_chars": F.length(without(t, SPACES)).cast("long"),
            "n_symbols": (F.length(t) - F.length(without(t, SYMBOLS))).cast("long"),
        }
    )
    return out.withColumns({k: F.col(f"__w.{k}") for k in own[:3]} | {k: F.col(f"__l.{k}") for k in own[3:5]}).drop("__w", "__l")


def quality_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Adds the measures, `base_failed` and `kept`; `failed_rules` lists the names of the rules that a document breaks."""
    every = [F.when(~r.holds(), F.lit(r.name)) for r in (*base, *rules)]
    out = measured(docs.drop("base_failed", "kept", "failed_rules"), text)
    out = out.withColumn("base_failed", ~reduce(lambda a, b: a & b, (r.holds() for r in base)))
    return out.withColumn("failed_rules", F.concat_ws(", ", *every)).withColumn("kept", F.col("failed_rules") == "")
