"""Text normalisers (five, not interchangeable), detectors and replacements."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: White space and digits of any script, where patterns of listing texts say white space and digit.
WHITE, DIGIT = r"[\p{IsWhite_Space}\x1c-\x1f]", r"\p{Nd}"
_ZEROS = "０٠۰०০"


def of_any_script(pattern: str) -> str:
    """The pattern with white space and digits of any script in place of the ASCII ones."""
    return pattern.replace(r"\s", WHITE).replace("[0-9]", DIGIT).replace("[0-9", "[" + DIGIT)


def ascii_digits(text: Column) -> Column:
    """Digits of other scripts (full-width, Arabic, Persian, Devanagari, Bengali) as ASCII ones."""
    return F.translate(text, "".join(chr(ord(z) + k) for z in _ZEROS for k in range(10)), "0123456789" * len(_ZEROS))


def lower_alnum(text: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def lower_alnum_py(text: str) -> str:
    return "".join(c.lower() for c in text if c.isalnum())


@F.pandas_udf(T.StringType())
def nfkc_word(text: pd.Series) -> pd.Series:
    """NFKC, case folded, word characters only (the underscore stays)."""
    return text.map(lambda t: None if t is None else re.sub(r"\W", "", unicodedata.normalize("NFKC", t).casefold()))


def fold_alnum_py(text: str) -> str:
    return "".join(c.casefold() for c in text if c.isalnum())


@F.pandas_udf(T.StringType())
def fold_alnum(text: pd.Series) -> pd.Series:
    """Case folded, letters and digits only."""
    return text.map(lambda t: None if t is None else fold_alnum_py(t))


@F.pandas_udf(T.StringType())
def strip_fold(text: pd.Series) -> pd.Series:
    """Case folded, without white space around."""
    return text.map(lambda t: None if t is None else t.strip().casefold())


def ascii_alnum(text: Column) -> Column:
    """Lower case, ASCII letters and digits only."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def is_cjk_key(text: Column) -> Column:
    """Three or more characters, all Han, Hiragana or Katakana."""
    return text.rlike(r"^[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]{3,}$")


def url_host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def fresh(date: Column, cutoff: Column, days: int = 366) -> Column:
    """Within so many days up to the cutoff; the future is not fresh, nor is a missing date."""
    return F.coalesce(date.between(F.date_sub(cutoff, days), cutoff), F.lit(False))


def safe_date(text: Column) -> Column:
    """An ISO date, null for anything else."""
    return F.try_to_date(text, "yyyy-MM-dd")


# Patterns of personal data, in the subset that all engines read alike.
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "url": r"https?://[^ \t\n]+",
    "phone": r"\+?[0-9]{2,4}[- ][0-9]{3,4}[- ][0-9]{3,4}",
    "long_digits": r"[0-9]{9,}",
    "handle": r"@[A-Za-z0-9_]{3,}",
    "ipv4": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "national_id": r"[A-Z][12][0-9]{8}",
}


def pii_codes(text: Column, kinds: dict[str, str] = PII) -> Column:
    """Names of the patterns that the text holds, in their order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(text, F.lit("")).rlike(p), F.lit(k)) for k, p in kinds.items()]))


def redact(text: Column, names: list[str], mark: str = "[redacted]", protected: tuple[str, ...] = ()) -> Column:
    """text with the names replaced, longest first; protected words (which may hold a name) stay."""
    if not names:
        return text
    order = sorted({*names, *protected}, key=lambda n: (-len(n), n))
    out, marks = text, {}
    for i, word in enumerate(order):
        if word in protected:
            marks[word] = f"\x00{i}\x00"
            out = F.replace(out, F.lit(word), F.lit(marks[word]))
        else:
            out = F.replace(out, F.lit(word), F.lit(mark))
    for word, code in marks.items():
        out = F.replace(out, F.lit(code), F.lit(word))
    return out


def title_variants(title: Column, wrappers: tuple[str, ...]) -> Column:
    """The title itself and without each wrapper (prefix or suffix), distinct."""
    parts = [F.trim(title), *[F.trim(F.regexp_replace(title, f"^{re.escape(w)}|{re.escape(w)}$", "")) for w in wrappers]]
    return F.array_distinct(F.array(*parts))
