"""Masking, replacing and redacting personal data."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.functions.columns import col
from tallywise.functions.hashing import hash_uniform, pick


def mask_name(text: Column) -> Column:
    """Keep the first letter of each word, in any script; a text without letters is masked wholly."""
    masked = F.regexp_replace(text, "(\\p{L})[\\p{L}\\p{M}]*", "$1***")
    return F.when(text.rlike("\\p{L}"), masked).when(text.isNotNull(), "***")


def mask_email(text: Column) -> Column:
    """Keep the first character and the domain; what is no address is masked wholly."""
    masked = F.regexp_replace(text, "^([^@]).*@", "$1***@")
    return F.when(text.rlike("^[^@].*@[^@]+$"), masked).when(text.isNotNull(), "***")


def mask_phone(text: Column) -> Column:
    """Keep the last four digits; what has other than seven to fifteen digits is masked wholly."""
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    kept = F.substring(text, -4, 4)
    hidden = F.regexp_replace(F.substring(text, F.lit(1), F.greatest(F.length(text) - 4, F.lit(0))), "[0-9]", "*")
    shaped = digits.between(7, 15) & ~text.rlike("\\p{L}") & kept.rlike("^[0-9]{4}$")
    return F.when(shaped, F.concat(hidden, kept)).when(text.isNotNull(), "***")


def mask_token(text: Column, key: str) -> Column:
    """A keyed hash: equal values stay equal and can still be joined on."""
    return F.sha2(F.concat(F.lit(key), F.lit(":"), text), 256)


_MASKS = {"name": mask_name, "email": mask_email, "phone": mask_phone}


def mask_columns(df: DataFrame, kinds: Mapping[str, str], key: str = "") -> DataFrame:
    """Mask columns by kind: ``name``, ``email``, ``phone`` or ``token``; others stay.

    Tokens need a ``key``: without one anybody could hash a guess and compare.
    """
    if "token" in kinds.values() and not key:
        raise ValueError("tokens need a key")
    return df.withColumns({
        c: mask_token(col(c).cast("string"), key) if kind == "token" else _MASKS[kind](col(c))
        for c, kind in kinds.items()
    })


# Surrogate names.
FIRST_NAMES = ["Alex", "Blair", "Casey", "Drew", "Emery", "Finley", "Gray", "Harper", "Indigo", "Jordan",
               "Kai", "Lee", "Morgan", "Noel", "Oakley", "Parker"]
LAST_NAMES = ["Adler", "Brook", "Carver", "Dale", "Ember", "Field", "Grove", "Hale", "Irving", "Jarvis",
              "Keller", "Lane", "Marsh", "North", "Olsen", "Price"]


def surrogate_pii(df: DataFrame, row_id: str, kinds: Mapping[str, str], jitter: Mapping[str, float] | None = None,
                  seed: int = 0) -> DataFrame:
    """Replace personal columns by made-up ones and shift numeric columns a little.

    Surrogates follow from a hash of ``row_id``, so a row gets the same ones each
    run. ``jitter`` maps a numeric column to the largest relative shift; shifts
    are symmetric, so means and spreads stay close.
    """
    ident = col(row_id)
    first = pick(hash_uniform(ident, "first", seed), FIRST_NAMES)
    last = pick(hash_uniform(ident, "last", seed), LAST_NAMES)
    number = F.floor(hash_uniform(ident, "phone", seed) * 10000).cast("string")
    made = {
        "name": F.concat(first, F.lit(" "), last),
        "email": F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@example.com")),
        "phone": F.concat(F.lit("555-010-"), F.lpad(number, 4, "0")),
    }
    changes = {c: made[kind] for c, kind in kinds.items()}
    for c, share in (jitter or {}).items():
        shift = 1 + F.lit(share) * (2 * hash_uniform(ident, c, seed) - 1)
        changes[c] = F.round(col(c) * shift, 2).cast(df.schema[c].dataType)
    return df.withColumns(changes)


# What personal data looks like. A number is matched up to its end or not at all, so none is cut in two.
EMAIL = "[\\p{L}\\p{M}\\p{N}._%+-]+@[\\p{L}\\p{M}\\p{N}-]+(?:\\.[\\p{L}\\p{M}\\p{N}-]+)+"
IP_ADDRESS = "(?:[0-9]{1,3}\\.){3}[0-9]{1,3}(?!\\.[0-9])"
CARD_NUMBER = "[0-9]{13,19}|[0-9]{4}(?:[ -]?[0-9]{4}){3}(?:[ -]?[0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
ACCOUNT_NUMBER = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
PHONE_NUMBER = (
    "(?:\\+?[0-9]{1,2}[ .-])?(?:\\([0-9]{3}\\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}"
)
SOCIAL_NUMBER = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
LABELLED_ID = "((ID|Id|id)[:#]? ?)[0-9]{4,}"
_WORD_START, _WORD_END = "(^|[^0-9A-Za-z])", "(?![0-9A-Za-z])"


# Steps in turn: pattern and replacement. All numbers are found in one pass.
REDACTIONS = [
    (EMAIL, "*"),
    (f"{_WORD_START}(?:{IP_ADDRESS}|{CARD_NUMBER}|{PHONE_NUMBER}|{SOCIAL_NUMBER}|{ACCOUNT_NUMBER}){_WORD_END}", "$1*"),
    (LABELLED_ID, "$1*"),
]


def name_pattern(names: Sequence[str]) -> str:
    """Listed names as whole words of any script, in one pass; of two that match the longer counts."""
    ordered = sorted(set(names), key=lambda n: (-len(n), n))
    return f"(?<![\\p{{L}}\\p{{N}}])(?:{'|'.join(map(re.escape, ordered))})(?![\\p{{L}}\\p{{M}}\\p{{N}}])"


def redact_text(text: Column, names: Sequence[str] = ()) -> Column:
    """Replace mails, addresses, cards, phones, ids and listed names by ``*``.

    Texts without an at sign or without digits skip the passes that need them.
    """
    mail, *numbers = REDACTIONS
    out = F.when(text.contains("@"), F.regexp_replace(text, *mail)).otherwise(text)
    numbered = out
    for step in numbers:
        numbered = F.regexp_replace(numbered, *step)
    out = F.when(text.rlike("[0-9]"), numbered).otherwise(out)
    return F.regexp_replace(out, name_pattern(names), "*") if names else out
