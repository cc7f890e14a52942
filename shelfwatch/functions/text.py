"""Text cleaning as native column expressions (no UDF)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwatch.functions import fixed as K

_EDGES = rf"^{K.NOT_WORD}+|{K.NOT_WORD}+\z"
_NUMBER_ONLY = rf"^{K.DIGIT}+(?:[.,]{K.DIGIT}+)?\z"
# White space in an order that settles most letters with one comparison.
_ANY_SPACE = rf"[\x00-\x20\x7f-\x{{ffff}}&&{K.SPACE}]"
_ODD_SPACE = rf"[\x00-\x1f\x7f-\x{{ffff}}&&{K.SPACE}]"
# All that squeezing changes: odd white space, or a blank with more behind it.
_SQUEEZED = rf"{_ODD_SPACE}{_ANY_SPACE}*| {_ANY_SPACE}+"
# The lookahead for the first letters spares most positions the costlier tests.
SHIPPING_PATTERN = (
    rf"(?iu)(?=[sd])(?<!{K.WORD})(?:{'|'.join(K.SHIPPING_WORDS)})(?!{K.WORD})"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def squeeze(col: Column) -> Column:
    """Runs of Unicode white space become one blank; edges are trimmed."""
    return F.trim(F.regexp_replace(col, _SQUEEZED, " "))


def strip(col: Column) -> Column:
    """Edges trimmed of Unicode white space, the inside left alone."""
    return F.btrim(col, F.lit(K.SPACE_CHARS))


def is_blank(col: Column) -> Column:
    """Nothing but white space; null stays null."""
    return col.rlike(rf"^{_ANY_SPACE}*\z")


def is_word_of(col: Column, words: tuple[str, ...]) -> Column:
    """The stripped text is one of the words, whatever their case; null stays null.

    Anchored: text that starts differently is settled at once, without a copy of it.
    """
    listed = "|".join(re.escape(w) for w in words if w)
    end = "?" if "" in words else ""
    return col.rlike(rf"(?iu)^{_ANY_SPACE}*(?:{listed}){end}{_ANY_SPACE}*\z")


def clean_text(col: Column) -> Column:
    """``squeeze`` with empty text turned into null."""
    return F.nullif(squeeze(col), F.lit(""))


def is_missing(col: Column) -> Column:
    """True for null, blank and the missing-value markers of the cleaning step."""
    return F.coalesce(F.lower(squeeze(col)).isin(*K.CLEAN_MISSING), F.lit(True))


def or_placeholder(col: Column) -> Column:
    return F.when(is_missing(col), F.lit(K.PLACEHOLDER)).otherwise(col)


def mentions_shipping(col: Column) -> Column:
    """Whole-word shipping or delivery terms; null gives false."""
    return F.coalesce(col.rlike(SHIPPING_PATTERN), F.lit(False))


def _spells(text: Column, forms: tuple[str, ...]) -> Column:
    """The text's plain letters, other signs left out, spell one of the forms.

    Anchored, so a text that starts differently is settled at its first letters.
    """
    gap = "[^a-z]*"
    spelled = "|".join(gap.join(form) for form in forms)
    return F.lower(text).rlike(rf"^{gap}(?:{spelled}){gap}\z")


def clean_availability(col: Column) -> Column:
    """Stock status only: shipping promises and missing markers are replaced."""
    return let(
        clean_text(col),
        lambda text: F.when(text.isNull() | mentions_shipping(text), F.lit(K.PLACEHOLDER))
        .when(_spells(text, K.IN_STOCK_FORMS), F.lit(K.IN_STOCK))
        .when(_spells(text, K.OUT_OF_STOCK_FORMS), F.lit(K.OUT_OF_STOCK))
        .when(F.lower(text).isin(*K.CLEAN_MISSING), F.lit(K.PLACEHOLDER))
        .otherwise(text),
    )


def page_availability(col: Column) -> Column:
    """As ``clean_availability``, but an unknown status stays empty text."""
    return let(
        squeeze(col),
        lambda text: F.when(text.isNull() | mentions_shipping(text), F.lit(""))
        .when(_spells(text, K.IN_STOCK_FORMS), F.lit(K.IN_STOCK))
        .when(_spells(text, K.OUT_OF_STOCK_FORMS), F.lit(K.OUT_OF_STOCK))
        .otherwise(text),
    )


def capitalize(col: Column) -> Column:
    """First letter upper, all others lower (not per word)."""
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substr(col, F.lit(2))))


def word_count(col: Column) -> Column:
    """White-space separated words; 0 for null and blank."""
    return let(
        squeeze(col),
        lambda text: F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(
            F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
        ),
    ).cast("long")


def is_noise_word(word: Column) -> Column:
    """A stop word or a bare number, as it must not end a product name."""
    return F.lower(word).isin(*K.NAME_TRAILING_WORDS) | word.rlike(_NUMBER_ONLY)


def last_word(col: Column) -> Column:
    """The last white-space separated word, read from the end of the text."""
    tail = F.substring_index(strip(col), " ", -1)
    return F.regexp_extract(tail, rf"([^{K.SPACE[1:-1]}]*)\z", 1)


def has_trailing_noise(col: Column) -> Column:
    return let(
        last_word(col),
        lambda last: F.coalesce((last != "") & is_noise_word(last), F.lit(False)),
    )


def needs_new_name(col: Column) -> Column:
    """Null, blank, noisy at the end, or longer than the word limit."""
    return (
        F.coalesce(squeeze(col) == "", F.lit(True))
        | has_trailing_noise(col)
        | (word_count(col) > K.NAME_MAX_WORDS)
    )


def product_name(title: Column) -> Column:
    """Short name: at most five words, ending before the first break.

    One fold over the words of the title.  The state holds the words taken so far
    and whether the name is complete, after which later words cost nothing.
    """
    no_words = F.array().cast("array<string>")

    def take(state: Column, token: Column) -> Column:
        words = state["words"]
        split_here = token.rlike(K.NAME_SEPARATORS)

        def with_word(word: Column) -> Column:
            break_word = ~split_here & F.lower(word).isin(*K.NAME_BREAK_WORDS)
            keep = (word != "") & F.when(split_here, ~is_noise_word(word)).otherwise(~break_word)
            stop = split_here | break_word
            return let(
                F.when(keep, F.concat(words, F.array(word))).otherwise(words),
                lambda grown: F.struct(
                    grown.alias("words"),
                    (
                        (stop & (F.size(grown) > 0)) | (F.size(grown) >= K.NAME_MAX_WORDS)
                    ).alias("done"),
                ),
            )

        word = F.regexp_replace(F.regexp_extract(token, r"^[^,:\-_]*", 0), _EDGES, "")
        return F.when(state["done"], state).otherwise(let(word, with_word))

    def finish(state: Column) -> Column:
        words = state["words"]
        # Position of the last word that may stand at the end (0 if there is none).
        last = F.array_max(
            F.transform(words, lambda w, i: F.when(is_noise_word(w), 0).otherwise(i + 1))
        )
        return F.nullif(
            F.array_join(F.slice(words, 1, F.coalesce(last, F.lit(0))), " "), F.lit("")
        )

    start = F.struct(no_words.alias("words"), F.lit(False).alias("done"))
    return F.aggregate(F.split(title, K.SPACE + "+"), start, take, finish)


def load_text(col: Column) -> Column:
    """Value written to the warehouse: trimmed, placeholder if blank or null."""
    return F.coalesce(F.nullif(strip(col), F.lit("")), F.lit(K.PLACEHOLDER))
