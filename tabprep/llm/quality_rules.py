"""Operator 5, quality rules: line-first cleaning, then rejection of documents that lose too much.

Every line is judged alone by the navigation, punctuation and boilerplate rules; lines that fail are removed. Boilerplate
is a line of which stock phrases of any of four languages make up `phrase_share` of the characters, a dated copyright
notice of `notice_words` words at most, or one with addresses as `address_share` of its words; a phrase within a long line
fails nothing. Lines that many documents share are no sign of a frame here: copies and shared passages would count as frames, and
removing those is another operator's work. A document
is rejected when it fails the base limits (too few words, too much repetition) or when the removed lines held more than
`max_lost` of its word characters. Everything is a row-local expression: one scan, no shuffle, no Python.

Defined cases: a null text counts as empty; an empty text has no words, fails the base limits and is not kept; lines
without a word are neither counted nor judged and stay; repeated rows and ids are judged row by row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.text import WORD, let, others, quoted, whole, with_outputs, words_of

SYMBOLS = "#*$%&|<>"
# What a page frame or a notice says in each language, lower case.
PHRASES = {
    "en": ("all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "terms and conditions",
           "enable javascript", "javascript is disabled", "subscribe to our newsletter", "sign up for our newsletter",
           "click here to", "skip to main content", "skip to content", "back to top", "powered by", "lorem ipsum",
           "is licensed under", "released under the", "this work is licensed", "copyright (c)", "page not found"),
    "de": ("alle rechte vorbehalten", "datenschutzerklärung", "cookie-richtlinie", "nutzungsbedingungen",
           "allgemeine geschäftsbedingungen", "javascript aktivieren", "newsletter abonnieren", "zum inhalt springen",
           "zum seitenanfang", "seite nicht gefunden"),
    "es": ("todos los derechos reservados", "política de privacidad", "política de cookies", "condiciones de uso",
           "términos y condiciones", "aviso legal", "activar javascript", "suscríbete a nuestro boletín", "saltar al contenido",
           "ir al contenido principal", "volver arriba", "página no encontrada"),
    "fr": ("tous droits réservés", "politique de confidentialité", "politique de cookies", "conditions d'utilisation",
           "conditions générales de vente", "mentions légales", "activer javascript", "abonnez-vous à notre newsletter",
           "aller au contenu", "haut de page", "page introuvable"),
}
BOILERPLATE = tuple(phrase for phrases in PHRASES.values() for phrase in phrases)


@dataclass(frozen=True)
class Limits:
    """The limits of the rules, in words, shares of words, of a line's characters and of word characters."""

    min_words: int = 50
    max_repeat_percent: int = 50
    separators: int = 3
    separator_share: float = 0.2
    marked_share: float = 0.2
    short_line: int = 3
    phrase_share: float = 0.15
    notice_words: int = 20
    address_share: float = 0.5
    max_lost: float = 0.5


SEPARATOR = r"(^|[\x20\x09-\x0D])[|»›•·]+(?=[\x20\x09-\x0D]|$)"
MARKED = r"(?:[#$%&*^~=<>|+]{2,}|!{2,}|\?{3,})"
MARKS = "[#$%&*^~=<>|+!?]"  # without one of these nothing is marked
TERMINAL = "[.!?…:;。！？][\"'”’»)\\]]*[\\x20\\x09-\\x0D]*$"
LETTER = r"\p{L}"
PLAIN = r"[\p{L}\p{N}]"
NOTICE = r"(?:©|\([Cc]\)|[Cc]opyright)[\x20,]*(?:19|20)[0-9]{2}"
ADDRESS = r"(?:https?://|www\.)[^\x20\x09-\x0D]+"


def windows(words: Column) -> Column:
    """A 64-bit hash of every three-word window, in order."""
    return F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(let(words, lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))))


def repeated_words(hashes: Column) -> Column:
    """How many words lie in a three-word window that the text holds at least twice, from the windows' hashes.

    Where there are repeats, hashes are sorted with their positions, equal neighbours keep theirs, and each position
    covers the words up to the next one, three at most.
    """
    def positions(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    count = let(let(ordered, positions), covered)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), count).otherwise(F.lit(0)).cast("bigint")


def line_fails(line: Column, limits: Limits = Limits()) -> Column:
    """Whether a line with words is navigation, broken punctuation or boilerplate.

    Each rule starts with a test that most lines end at once; counts follow only where it holds.
    """
    n = F.regexp_count(line, F.lit(WORD))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    marked = F.regexp_count(line, F.lit(MARKED))
    several_words = line.rlike(f"(?:{WORD}[\\x20\\x09-\\x0D]+){{{limits.short_line - 1}}}{WORD}")
    navigation = line.rlike("[|»›•·]") & (separators >= limits.separators) & (separators >= n * limits.separator_share)
    menu = ~several_words & ~line.rlike(TERMINAL)
    punctuation = line.rlike(MARKS) & (marked >= 2) & (marked >= n * limits.marked_share) | ~line.rlike(PLAIN)

    dated = F.contains(line, F.lit("©")) | F.contains(line, F.lit("(c)")) | F.contains(line, F.lit("(C)")) | F.contains(line, F.lit("opyright"))
    notice = dated & line.rlike(NOTICE) & (n <= limits.notice_words)
    addressed = F.contains(line, F.lit("://")) | F.contains(line, F.lit("www."))
    addresses = addressed & line.rlike(ADDRESS) & (F.regexp_count(line, F.lit(ADDRESS)) >= n * limits.address_share)

    def phrases(low: Column) -> Column:
        # Most lines hold no phrase: lengths are added up only where one is found.
        found = reduce(lambda a, b: a | b, [F.contains(low, F.lit(phrase)) for phrase in BOILERPLATE])
        said = reduce(lambda a, b: a + b, [
            F.when(F.contains(low, F.lit(phrase)), len(phrase)).otherwise(0) for phrase in BOILERPLATE])
        return found & (said >= F.length(line) * limits.phrase_share)

    return line.rlike(WORD) & (navigation | menu | punctuation | notice | addresses | let(F.lower(line), phrases))


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("bigint")


def symbols(text: Column) -> Column:
    found = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.when(text.rlike(f"[{SYMBOLS}]"), found).otherwise(F.lit(0)).cast("bigint")


OUTPUTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text", "lost_share", "kept")


def _judged(df: DataFrame, text_col: str, limits: Limits) -> DataFrame:
    """`df` with each output as a column `rules__<output>`."""
    staged = with_outputs(
        df, rules__text=whole(text_col), rules__words=words_of(whole(text_col)), rules__lines=F.split(whole(text_col), "\n", -1))
    staged = with_outputs(staged, rules__windows=windows(F.col("rules__words")))
    lines = F.col("rules__lines")
    spoken = F.filter(lines, lambda x: x.rlike(WORD))
    staged = with_outputs(
        staged,
        rules__n_words=F.size("rules__words").cast("bigint"),
        rules__word_chars=word_chars(F.col("rules__words")),
        rules__n_symbols=symbols(F.col("rules__text")),
        rules__n_dup_lines=let(spoken, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        rules__n_repeat_words=repeated_words(F.col("rules__windows")),
        rules__kept_lines=F.filter(lines, lambda x: ~line_fails(x, limits)),
    )
    untouched = F.size("rules__kept_lines") == F.size("rules__lines")
    staged = with_outputs(
        staged, rules__clean_text=F.when(untouched, F.col("rules__text")).otherwise(F.array_join("rules__kept_lines", "\n")),
        rules__left=F.when(untouched, F.col("rules__word_chars")).otherwise(
            word_chars(words_of(F.array_join("rules__kept_lines", "\n")))))
    n, total = F.col("rules__n_words"), F.col("rules__word_chars")
    staged = with_outputs(
        staged,
        rules__base_failed=(n < limits.min_words) | (F.col("rules__n_repeat_words") * 100 > n * limits.max_repeat_percent),
        rules__lost_share=F.when(total > 0, 1 - F.col("rules__left") / total).otherwise(0.0),
    )
    return with_outputs(staged, rules__kept=~F.col("rules__base_failed") & (F.col("rules__lost_share") <= limits.max_lost))


def judge(df: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Add the columns of OUTPUTS: the counts, the verdicts and the cleaned text."""
    judged = _judged(df, text_col, limits)
    return judged.select(*others(df, OUTPUTS), *[F.col(f"rules__{c}").alias(c) for c in OUTPUTS])


def clean(df: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The kept documents with their cleaned text; columns as in `df`, `n_chars` follows the text where there is one."""
    changed = {text_col: F.col("rules__clean_text"), "n_chars": F.length("rules__clean_text").cast("bigint")}
    # A filter is not moved below a projection with a row number, where it would compute all rules a second time.
    judged = _judged(df, text_col, limits).withColumn("rules__row", F.monotonically_increasing_id())
    judged = judged.where(F.col("rules__kept") & (F.col("rules__row") >= 0))
    return judged.select(*[(changed[c] if c in changed else quoted(c)).alias(c) for c in df.columns])
