"""Brand and device type from free text, by ordered rule tables.

A term matches when no ASCII letter or digit touches it.  Instead of one regex per
rule, a text is cut into words once; the rule of the best-ranked word wins.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwatch.functions import fixed as K
from shelfwatch.functions.text import let, squeeze

Rules = Mapping[str, Sequence[str]]


def whole_word(terms: Sequence[str]) -> str:
    ordered = sorted(terms, key=len, reverse=True)
    return rf"(?<![a-z0-9])(?:{'|'.join(re.escape(t) for t in ordered)})(?![a-z0-9])"


def has_alias(col: Column, alias: str) -> Column:
    """The alias stands alone in the lower-cased text."""
    return F.lower(squeeze(col)).rlike(whole_word([alias.lower()]))


def _ranked_terms(rules: Rules) -> list[tuple[str, str]]:
    """(term, class) in rule order, without terms that cannot decide anything.

    A phrase holding a single-word term of the same or an earlier class is dropped:
    wherever it matches, that word matches too and ranks at least as well.
    """
    rank = {name: i for i, name in enumerate(rules)}
    single: dict[str, str] = {}
    for name, terms in rules.items():
        for term in terms:
            if " " not in term:
                single.setdefault(term, name)
    kept = []
    for name, terms in rules.items():
        for term in terms:
            words = term.split()
            if len(words) > 1 and any(
                w in single and rank[single[w]] <= rank[name] for w in words
            ):
                continue
            kept.append((term, name))
    return kept


def best_class(text: Column, rules: Rules) -> Column:
    """Class of the first rule with a term in ``text`` (lower case); null if none.

    A single-word term stands alone exactly if it is one of the runs of ASCII letters
    and digits of the text, so these runs are intersected with all terms at once; only
    phrases are searched for.
    """
    ranked = _ranked_terms(rules)
    order = {t: i + 1 for i, (t, _) in enumerate(ranked)}
    terms = F.array(*[F.lit(t) for t in order if " " not in t])
    ranks = F.array(*[F.lit(i) for t, i in order.items() if " " not in t])
    classes = F.array(*[F.lit(n) for _, n in ranked])

    def found(lowered: Column) -> Column:
        hits = F.array_intersect(F.split(lowered, "[^a-z0-9]+"), terms)
        places = [F.array_min(F.transform(hits, lambda h: F.get(ranks, (F.array_position(terms, h) - 1).cast("int"))))]
        places += [
            F.when(lowered.contains(t) & lowered.rlike(whole_word([t])), F.lit(i))
            for t, i in order.items() if " " in t
        ]
        place = F.least(*places) if len(places) > 1 else places[0]
        return F.get(classes, place - 1)

    return let(text, found)


def _lowered(col: Column) -> Column:
    return F.lower(F.coalesce(squeeze(col), F.lit("")))


def infer_device_type(title: Column, category: Column | None = None) -> Column:
    """Device class of title and search category taken together."""
    text = F.coalesce(title, F.lit(""))
    if category is not None:
        text = F.concat_ws(" ", text, category)
    return best_class(_lowered(text), K.DEVICE_TERMS)


def infer_brand(title: Column, brand: Column, manufacturer: Column) -> Column:
    """First of scraped brand, manufacturer and title that names a known brand."""
    return F.coalesce(
        *[best_class(_lowered(c), K.BRAND_TERMS) for c in (brand, manufacturer, title)]
    )


def looks_like_device(col: Column) -> Column:
    return _lowered(col).rlike(whole_word([t for t, _ in _ranked_terms(K.DEVICE_TERMS)]))


def is_known_brand(col: Column) -> Column:
    return _lowered(col).rlike(whole_word([t for t, _ in _ranked_terms(K.BRAND_TERMS)]))


def corrected_device(title: Column, category: Column, given: Column) -> Column:
    """The inferred device type, else the given one."""
    return F.coalesce(
        infer_device_type(title, category), F.nullif(squeeze(given), F.lit(""))
    )


def corrected_brand(
    title: Column, brand: Column, manufacturer: Column, device: Column
) -> Column:
    """The inferred brand, else the scraped one unless it says nothing.

    Without an inferred brand the scraped text names no known brand, so it is kept
    only if it is neither generic nor a device word nor the device type itself.
    """
    def unless_empty(scraped: Column) -> Column:
        empty = (
            F.lower(scraped).isin(*K.GENERIC_BRANDS)
            | looks_like_device(scraped)
            | F.coalesce(F.lower(scraped) == F.lower(device), F.lit(False))
        )
        return F.when(~empty, scraped)

    return F.coalesce(
        infer_brand(title, brand, manufacturer), let(squeeze(brand), unless_empty)
    )
