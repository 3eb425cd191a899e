"""Line-first cleaning: rules per line, failing lines go, then documents that lost too much go.

Only built-in functions: no row leaves the JVM and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50  # fewer words fail the base rule
MAX_REPEAT_PERCENT = 50  # more words in repeated windows fail the base rule
MIN_KEPT_SHARE = 0.5  # least share of a document's characters in lines that pass
MAX_MARKS_SHARE = 0.06  # most symbols and exclamation marks in a line, by its characters
MIN_SEPARATORS = 2  # menu separators that make a line navigation
FURNITURE_CHARS = 200  # longest line that a phrase of site furniture makes one: a paragraph may speak of cookies

# Marks that end a sentence and closing marks allowed after them; menu separators;
# phrases of site furniture and licences, in lower case.
SENTENCE_END = r'''[.!?…。:;]["'”’»)\]]*[\x20\x09-\x0D]*$'''
SEPARATORS = [" | ", " » ", " › ", " • ", " → "]
BOILERPLATE = [
    "lorem ipsum", "privacy policy", "terms of use", "terms of service", "all rights reserved", "released under the", "licensed under", "click here", "skip to content",
    "use cookies", "uses cookies", "accept cookies", "accept all cookies", "cookie policy", "cookie settings", "cookies policy", "enable javascript", "javascript is disabled", "requires javascript",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "impressum", "verwenden cookies", "verwendet cookies", "cookies akzeptieren", "cookie-einstellungen", "javascript aktivieren", "hier klicken", "zum inhalt springen",
    "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "mentions légales", "utilise des cookies", "utilisons des cookies", "accepter les cookies", "activer javascript", "cliquez ici", "aller au contenu",
    "todos los derechos reservados", "política de privacidad", "términos de uso", "condiciones de uso", "aviso legal", "utiliza cookies", "utilizamos cookies", "aceptar cookies", "aceptar las cookies", "activar javascript", "haga clic aquí", "haz clic aquí", "ir al contenido",
]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once for each row however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _count(text: Column, chars: str) -> Column:
    return F.size(F.split(text, f"[{chars}]")) - 1


def words_of(text: Column) -> Column:
    """The words of a text: its runs of characters other than 0x20 and 0x09-0x0D."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def repeated_words(words: Column) -> Column:
    """How many words stand in windows of three words that occur at least twice in the text.

    A text whose windows all differ has none. In the others windows are sorted,
    so equal ones meet as neighbours; each repeated window then adds the words
    up to the next one's start, three at most.
    """
    windows = F.regexp_extract_all(F.array_join(words, " "), F.lit(r"(?<![^ ])(?=([^ ]++ [^ ]++ [^ ]++))"), F.lit(1))
    same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
    twice = lambda s: F.filter(s, lambda x, k: same(x, F.get(s, k + 1)) | same(x, F.get(s, k - 1)))
    covered = lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)

    def count(w: Column) -> Column:
        placed = F.sort_array(F.arrays_zip(w.alias("w"), F.sequence(F.lit(0), F.size(w) - 1).alias("i")))
        placed = placed.cast("array<struct<w:string,i:int>>")
        starts = let(placed, lambda s: F.sort_array(F.transform(twice(s), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(starts, covered))

    return let(windows, count)


def _any(text: Column, phrases: list[str]) -> Column:
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(text, F.lit(phrase))
    return found


def line_passes(line: Column) -> Column:
    """Punctuation, navigation and boilerplate rules of one non-blank line.

    A line must end a sentence and hold few symbols; it must not be a menu
    (``MIN_SEPARATORS`` separators) or, with up to ``FURNITURE_CHARS`` characters, hold a phrase of site furniture.
    """
    ends = F.substring(line, -4, 4).rlike(SENTENCE_END) | line.rlike(SENTENCE_END)  # most lines need their last characters only
    marks = _count(line, SYMBOLS + "!") <= MAX_MARKS_SHARE * F.length(line)
    menu = _any(line, SEPARATORS) & (F.size(F.split(line, " [|»›•→] ")) > MIN_SEPARATORS)
    furniture = (F.length(line) <= FURNITURE_CHARS) & let(F.lower(line), lambda x: _any(x, BOILERPLATE))
    return ends & marks & ~menu & ~furniture


def with_quality(docs: DataFrame, *, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, min_kept_share: float = MIN_KEPT_SHARE, column: str = "quality") -> DataFrame:
    """docs with a struct column named ``column``: the counts, the verdict and the cleaned text.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all
    bigint), base_failed, n_lines (lines with a word), n_failed_lines,
    kept_share, kept, clean_text. A null text counts as empty. A text without
    words fails the base rules; its clean_text is empty. Lines equal to an earlier
    line of the text are removed with the failing ones. Repeated rows and
    ties need no rule: each row is judged alone. All columns of docs stay; one named ``column`` already is an error.
    """
    if column in docs.columns:
        raise ValueError(f"the rows have a column {column!r} already; name another one for the result")
    raw = F.coalesce(F.col("text").cast("string"), F.lit(""))
    blankless = lambda t: F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    longs = lambda c: c.cast("long")
    chars = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + F.length(x))

    def base(words: Column, lines: Column) -> Column:
        distinct = F.array_distinct(lines)
        return let(distinct, lambda d: let(F.filter(d, line_passes), lambda good: F.struct(
            longs(F.size(words)).alias("n_words"), longs(F.length(F.array_join(words, ""))).alias("word_chars"), repeated_words(words).alias("n_repeat_words"), longs(F.size(lines)).alias("n_lines"),
            longs(F.size(lines) - F.size(d)).alias("n_dup_lines"), longs(F.size(d) - F.size(good)).alias("n_failed_lines"),
            chars(lines).alias("line_chars"), chars(good).alias("good_chars"), F.array_join(good, "\n").alias("clean_text"))))

    counts = let(raw, lambda t: let(words_of(t), lambda w: let(blankless(t), lambda lines: base(w, lines))))
    found = docs.withColumn("__q", counts)
    q = lambda name: F.col(f"__q.{name}")
    failed = (q("n_words") < min_words) | (100 * q("n_repeat_words") > max_repeat_percent * q("n_words"))
    share = F.when(q("line_chars") > 0, q("good_chars") / q("line_chars")).otherwise(F.lit(0.0))
    return found.withColumn(column, F.struct(
        q("n_words").alias("n_words"), q("word_chars").alias("word_chars"), longs(_count(raw, SYMBOLS)).alias("n_symbols"),
        q("n_dup_lines").alias("n_dup_lines"), q("n_repeat_words").alias("n_repeat_words"), failed.alias("base_failed"),
        q("n_lines").alias("n_lines"), q("n_failed_lines").alias("n_failed_lines"), share.alias("kept_share"),
        (~failed & (share >= min_kept_share)).alias("kept"), q("clean_text").alias("clean_text"))).drop("__q")


def clean_documents(docs: DataFrame, **options) -> DataFrame:
    """Kept documents with their failing lines removed; the columns of docs, n_chars following the text."""
    names = docs.columns
    # One row out of each kept verdict: a filter on the verdict would be moved below it and judge each text twice.
    kept = F.explode(F.filter(F.array("__quality"), lambda q: q["kept"]))
    out = with_quality(docs, column="__quality", **options).select(*[F.col(f"`{x}`") for x in names], kept.alias("__kept"))
    text = F.col("__kept.clean_text")
    changed = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in names else {})
    return out.select(*[changed.get(x, F.col(f"`{x}`")).alias(x) for x in names])
