"""Scalar encoders as native Catalyst expressions (no Python UDFs).

Each function takes and returns a ``Column`` so it stays inside whole-stage
codegen and lets filters and column pruning reach the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (AGE_CODES, AGE_LABELS, GENDER_CODES, GENDER_LABELS, GENRES,
                      OCCUPATION_LABELS, ZIP_UNKNOWN)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gender_idx(gender) -> Column:
    """M -> 0, F -> 1, anything else (null included) -> 0."""
    g = _col(gender)
    expr = F.lit(0)
    for i, code in enumerate(GENDER_CODES):
        if i:
            expr = F.when(g == code, F.lit(i)).otherwise(expr)
    return F.coalesce(expr, F.lit(0)).cast("int")


def age_idx(age) -> Column:
    """The seven age codes -> 0..6, anything else (null included) -> 0."""
    a = _col(age)
    expr = None
    for i, code in enumerate(AGE_CODES):
        expr = (F.when(a == code, F.lit(i)) if expr is None else expr.when(a == code, F.lit(i)))
    return expr.otherwise(F.lit(0)).cast("int")


def is_known_age(age) -> Column:
    return _col(age).isin(AGE_CODES)


def zip_region(zip_code) -> Column:
    """Leading digit after leading whitespace -> 0..9, else 10 (null, empty, letters)."""
    digit = F.regexp_extract(_col(zip_code), r"^\s*([0-9])", 1)
    return F.coalesce(F.when(digit != "", digit.cast("int")), F.lit(ZIP_UNKNOWN)).cast("int")


def strip(c) -> Column:
    """Python-style strip of surrounding whitespace."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def split_pipe(c) -> Column:
    """Split a pipe-joined list (``split`` takes a regex, so the pipe is escaped)."""
    return F.split(_col(c), r"\|")


def genre_set(genres) -> Column:
    """Distinct stripped names of a pipe-joined genre string (null -> empty)."""
    parts = F.transform(split_pipe(genres), strip)
    return F.coalesce(F.array_distinct(parts), F.array().cast("array<string>"))


def genre_overlap(genres, wanted) -> Column:
    """True when the movie's genre set shares a name with ``wanted`` (array<string>).
    Row-wise form; the bulk recommender uses the equi-join on genre masks instead."""
    return F.arrays_overlap(genre_set(genres), _col(wanted))


def genres_multihot(genres) -> Column:
    """array<float>[18]: 1.0 where the stripped name is one of the 18 genres.

    Unknown names are ignored, repeats are idempotent, matching is case-sensitive,
    null or empty gives all zeros.
    """
    parts = F.transform(split_pipe(F.coalesce(_col(genres), F.lit(""))), strip)
    return selected_genres_multihot(parts)


def selected_genres_multihot(names) -> Column:
    """Multi-hot from an ``array<string>`` of genre names (names are stripped)."""
    arr = F.transform(F.coalesce(_col(names), F.array().cast("array<string>")), strip)
    return F.array(*[F.array_contains(arr, g).cast("float") for g in GENRES])


def genre_mask(genres) -> Column:
    """The multi-hot as an int bit mask (bit i = genre i); a compact join key."""
    parts = F.transform(split_pipe(F.coalesce(_col(genres), F.lit(""))), strip)
    return mask_of_names(parts)


def mask_of_names(names) -> Column:
    arr = _col(names)
    bits = [F.when(F.array_contains(arr, g), F.lit(1 << i)).otherwise(F.lit(0))
            for i, g in enumerate(GENRES)]
    return reduce(lambda a, b: a + b, bits).cast("int")


def multihot_from_mask(mask) -> Column:
    m = _col(mask)
    return F.array(*[F.shiftright(m, i).bitwiseAND(1).cast("float") for i in range(len(GENRES))])


def multihot_string(multihot) -> Column:
    """'0'/'1' string of a multi-hot array, for oracle comparison."""
    return F.concat_ws("", F.transform(_col(multihot), lambda x: x.cast("int").cast("string")))


def mask_string(mask) -> Column:
    """``multihot_string`` of a genre mask, without the array: digits of six genres at a time from a constant array, the first genre first."""
    m, n = _col(mask), len(GENRES)
    digits = F.array(*[F.lit(f"{i:06b}"[::-1]) for i in range(64)])
    return F.concat(*[F.substring(part, 1, n - at) if n - at < 6 else part
                      for at in range(0, n, 6) for part in [digits[F.shiftright(m, at).bitwiseAND(63)]]])


def epoch_to_timestamp(ts) -> Column:
    return F.timestamp_seconds(_col(ts))


def epoch_to_date(ts) -> Column:
    """The UTC day of epoch seconds, whatever the session's time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(_col(ts) / 86400).cast("int"))


def month_end(date_col) -> Column:
    return F.last_day(_col(date_col))


def round3(x) -> Column:
    """Half-even at 3 places (agrees with Python's round on exact binary ties)."""
    return F.bround(_col(x), 3)


def _label_map(labels) -> Column:
    return F.create_map(*[v for i, lab in enumerate(labels) for v in (F.lit(i), F.lit(lab))])


def age_label(age) -> Column:
    """Age code -> label, null when the code is not one of the seven."""
    a = _col(age)
    expr = None
    for code, lab in zip(AGE_CODES, AGE_LABELS):
        expr = F.when(a == code, F.lit(lab)) if expr is None else expr.when(a == code, F.lit(lab))
    return expr


def occupation_label(occ) -> Column:
    o = _col(occ)
    return F.when(o.between(0, len(OCCUPATION_LABELS) - 1),
                  F.try_element_at(_label_map(OCCUPATION_LABELS), o))


def gender_label(gender) -> Column:
    g = _col(gender)
    expr = None
    for code, lab in zip(GENDER_CODES, GENDER_LABELS):
        expr = F.when(g == code, F.lit(lab)) if expr is None else expr.when(g == code, F.lit(lab))
    return expr


def ticket_fields(rank, genres, score) -> list[Column]:
    """Display fields of one recommendation: 2-digit rank, ' · '-joined genres,
    star width in percent (score/5*100 within 0..100) and a 1-decimal score."""
    return [
        F.lpad(_col(rank).cast("string"), 2, "0").alias("rank_label"),
        F.array_join(F.transform(split_pipe(_col(genres)), lambda x: F.trim(x)), " · ").alias("genre_label"),
        F.least(F.greatest(_col(score) / 5.0 * 100.0, F.lit(0.0)), F.lit(100.0)).alias("star_pct"),
        F.format_number(_col(score), 1).alias("score_label"),
    ]
