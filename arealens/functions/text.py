"""Text and key cleaning as column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.constants import AGENCY_PHRASES, COUNTY_SUFFIXES, NULL_WORDS, PLACE_SUFFIXES

# Every Unicode white-space character, spelled out so that it does not depend on the regex engine.
SPACES = r"[\t-\r\x1c-\x1f\x85\p{Z}]+"
# ASCII punctuation together with blanks (text is already collapsed when this is used).
PUNCTUATION_RUNS = r"[!-/:-@\[-`{-~ ]+"
NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
# A "word character" is a letter, a digit-like number or an underscore.
WORD = r"[\p{L}\p{N}_]"
WORD_START, WORD_END = rf"(?<!{WORD})", rf"(?!{WORD})"


def as_text(value: Column) -> Column:
    return value.cast("string")


def strip_blanks(value: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(value, rf"^(?:{SPACES})|(?:{SPACES})$", "")


def squeeze(value: Column) -> Column:
    """Collapse white-space runs to one blank and trim."""
    return F.trim(F.regexp_replace(as_text(value), SPACES, " "))


def clean_text(value: Column) -> Column:
    """Blank text and the words nan / none / null become NULL, the rest is squeezed."""
    text = squeeze(value)
    missing = (text == "") | F.lower(as_text(value)).isin(NULL_WORDS)
    return F.when(~missing, text)


def match_text(value: Column) -> Column:
    """Lower-case text with ASCII punctuation as blanks; NULL becomes the empty string."""
    plain = F.trim(F.regexp_replace(F.lower(clean_text(value)), PUNCTUATION_RUNS, " "))
    return F.coalesce(plain, F.lit(""))


def clean_label(value: Column) -> Column:
    """Squeezed label, the empty string where missing."""
    text = squeeze(value)
    return F.when(text.isNull() | F.lower(text).isin(NULL_WORDS), F.lit("")).otherwise(text)


def five_digit_key(value: Column) -> Column:
    """First run of five digits anywhere in the text."""
    return F.nullif(F.regexp_extract(as_text(value), "([0-9]{5})", 1), F.lit(""))


def to_double(value: Column) -> Column:
    """Lenient number; NaN and anything unparseable become NULL."""
    text = as_text(value)
    number = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(number), number)


def number_column(df: DataFrame, name: str) -> Column:
    """A column as a number: a plain cast where it is numeric already, else the lenient parse."""
    kind = dict(df.dtypes)[name]
    if kind in NUMERIC_TYPES or kind.startswith("decimal"):
        number = F.col(f"`{name}`").cast("double")
        return F.when(~F.isnan(number), number) if kind in ("double", "float") else number
    return to_double(F.col(f"`{name}`"))


def to_count(value: Column) -> Column:
    """Incident weight: missing, non-numeric or non-positive is 1, otherwise rounded half-even."""
    number = F.coalesce(to_double(value), F.lit(1.0))
    return F.rint(F.when(number > 0, number).otherwise(F.lit(1.0))).try_cast("long")


def to_whole(value: Column) -> Column:
    """Table cell to integer: thousands commas dropped, dashes are missing, fraction truncated."""
    return to_double(F.regexp_replace(as_text(value), ",", "")).try_cast("long")


def drop_footnote(value: Column) -> Column:
    """Squeezed cell text without footnote digits glued to its end."""
    text = squeeze(value)
    kept = F.when((text != "") & ~F.lower(text).isin(NULL_WORDS), text)
    return F.trim(F.regexp_replace(kept, r"(?<=[^0-9])[0-9]+$", ""))


def header_name(value: Column, position: Column) -> Column:
    """Snake-case header cell; a stand-alone footnote 1 is dropped, blanks are numbered."""
    text = match_text(value)
    named = F.when(text == "student enrollment1", F.lit("student_enrollment")).otherwise(
        F.regexp_replace(F.regexp_replace(text, rf"{WORD_START}1$", ""), r"[^a-z0-9]+", "_")
    )
    snake = F.regexp_replace(named, r"^_+|_+$", "")
    return F.when(text == "", F.concat(F.lit("unnamed_"), position.cast("string"))).otherwise(snake)


def column_key(name: str) -> str:
    """Name form used to match source columns whatever their case and punctuation."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def filter_value(value: Column, case_sensitive: bool = False) -> Column:
    text = strip_blanks(F.coalesce(as_text(value), F.lit("")))
    return text if case_sensitive else F.upper(text)


def _drop_words(text: Column, words: list[str]) -> Column:
    return reduce(lambda t, w: F.regexp_replace(t, rf"{WORD_START}{w}{WORD_END}", " "), words, text)


def county_key(value: Column) -> Column:
    """County name for matching: st -> saint, administrative suffix words removed."""
    text = F.regexp_replace(match_text(value), rf"{WORD_START}st{WORD_END}", "saint")
    return squeeze(_drop_words(text, sorted(COUNTY_SUFFIXES, key=len, reverse=True)))


def place_key(value: Column) -> Column:
    """Place name for matching: a closing type word, then a closing number, removed."""
    text = F.regexp_replace(match_text(value), rf"{WORD_START}({'|'.join(PLACE_SUFFIXES)})$", " ")
    return squeeze(F.regexp_replace(text, rf"{WORD_START}[0-9]+$", " "))


def agency_key(value: Column) -> Column:
    """Agency name for matching: police and sheriff phrases removed."""
    return squeeze(_drop_words(match_text(value), AGENCY_PHRASES))


def agency_place_key(value: Column) -> Column:
    return place_key(agency_key(value))


def county_fips(value: Column) -> Column:
    """Digits only, left-padded to five, last five kept."""
    digits = F.regexp_replace(as_text(value), "[^0-9]", "")
    padded = F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(F.right(digits, F.lit(5)))
    return F.when(digits != "", padded)


def state_code(value: Column) -> Column:
    text = F.upper(clean_label(value))
    return F.when(text.rlike("^[A-Z]{2}$"), text).otherwise(F.lit(""))


def pad_key(value: Column, width: int = 5) -> Column:
    """Left-pad with zeros without ever truncating."""
    text = F.trim(as_text(value))
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def stable_hash(*parts: Column) -> Column:
    """sha256 of the parts joined by a bar, a missing part written as None."""
    texts = [F.coalesce(as_text(p), F.lit("None")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def notes_of(*pairs: tuple[Column, str]) -> Column:
    """Ordered '; '-joined notes for the conditions that hold, NULL if none does."""
    notes = F.array_compact(F.array(*[F.when(cond, F.lit(note)) for cond, note in pairs]))
    return F.nullif(F.array_join(notes, "; "), F.lit(""))


def append_note(notes: Column, note: str, condition: Column | None = None, whole_note: bool = True) -> Column:
    """Append a note once. ``whole_note`` compares '; '-separated notes, otherwise a substring."""
    blank = notes.isNull() | (F.trim(notes) == "")
    present = F.array_contains(F.split(notes, "; "), note) if whole_note else F.contains(notes, F.lit(note))
    appended = F.when(blank, F.lit(note)).when(present, notes).otherwise(F.concat(notes, F.lit(f"; {note}")))
    return appended if condition is None else F.when(condition, appended).otherwise(notes)
