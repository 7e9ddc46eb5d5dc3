"""Encoders against a table of expected values, and the '::' reader on dirty text."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cinerank import schema
from cinerank.functions import encoders as E
from cinerank.sources import dat

ZIP_CASES = [("12345", 1), ("  90210", 9), ("V5K", 10), ("", 10), (None, 10), ("0-1234", 0), (" \t7", 7), ("x1", 10)]
GENDER_CASES = [("M", 0), ("F", 1), ("X", 0), (None, 0), ("m", 0)]
AGE_CASES = [(1, 0), (18, 1), (25, 2), (35, 3), (45, 4), (50, 5), (56, 6), (30, 0), (None, 0)]


def _one(spark, values, expr, typ):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_zip_region(spark):
    assert _one(spark, [z for z, _ in ZIP_CASES], E.zip_region, "string") == [r for _, r in ZIP_CASES]


def test_gender_idx(spark):
    assert _one(spark, [g for g, _ in GENDER_CASES], E.gender_idx, "string") == [r for _, r in GENDER_CASES]


def test_age_idx(spark):
    assert _one(spark, [a for a, _ in AGE_CASES], E.age_idx, "int") == [r for _, r in AGE_CASES]


@pytest.mark.parametrize("text,expected", [
    ("Action|Sci-Fi", {0, 14}),
    ("Action|Action", {0}),
    (" Drama |Unlisted", {7}),
    ("", set()),
    (None, set()),
    ("drama", set()),
    ("Children's|Film-Noir|Western", {3, 9, 17}),
])
def test_genres_multihot_and_mask(spark, text, expected):
    df = spark.createDataFrame([(text,)], "g string")
    row = df.select(E.genres_multihot("g").alias("mh"), E.genre_mask("g").alias("mask")).first()
    assert [i for i, v in enumerate(row.mh) if v == 1.0] == sorted(expected)
    assert len(row.mh) == 18
    assert row.mask == sum(1 << i for i in expected)


def test_read_dat_latin1_quotes_and_bad_lines(spark):
    d = tempfile.mkdtemp(prefix="cinerank-dat-")
    path = os.path.join(d, "movies.dat")
    lines = ['1::Am\xe9lie (2001)::Comedy|Romance', '2::"Quoted" Title::Drama', 'x::Bad id::Action',
             '3::Short line', '4::Trailing::']
    with open(path, "wb") as f:
        f.write("\n".join(lines).encode("latin-1"))
    rows = dat.read_dat(spark, path, schema.MOVIES_SCHEMA, ["movie_id"]).orderBy("movie_id").collect()
    assert [r.movie_id for r in rows] == [1, 2, 3, 4]
    assert rows[0].title == "Am\xe9lie (2001)"
    assert rows[1].title == '"Quoted" Title'
    assert rows[2].genres is None
    assert rows[3].genres is None


def test_load_tables_lists_missing_files(spark):
    d = tempfile.mkdtemp(prefix="cinerank-missing-")
    with pytest.raises(FileNotFoundError) as e:
        dat.load_tables(spark, d)
    assert "ratings.dat" in str(e.value) and "movies.dat" in str(e.value)


def test_write_then_read_dat_roundtrip(spark):
    df = spark.createDataFrame([(1, "M", 25, 4, "12345"), (2, "F", 56, 20, None)], schema.USERS_SCHEMA)
    d = os.path.join(tempfile.mkdtemp(prefix="cinerank-rt-"), "users")
    dat.write_dat(df, d)
    back = dat.read_dat(spark, d, schema.USERS_SCHEMA, ["user_id"]).orderBy("user_id").collect()
    assert [tuple(r) for r in back] == [(1, "M", 25, 4, "12345"), (2, "F", 56, 20, None)]


def test_parse_dat_lines_bad_and_short(spark):
    lines = spark.createDataFrame([("1::5::4::978300760",), ("x::5::4::1",), ("2::7",), ("3::8::five::9",)], "value string")
    rows = dat.parse_dat_lines(lines, schema.RATINGS_SCHEMA, ["user_id", "movie_id", "rating"]).collect()
    assert [(r.user_id, r.movie_id, r.rating, r.ts) for r in rows] == [(1, 5, 4.0, 978300760)]


def test_genre_overlap(spark):
    df = spark.createDataFrame([(" Drama |Comedy", ["Drama"]), ("Action", ["Drama"]), (None, ["Drama"])],
                               "g string, w array<string>")
    assert [r[0] for r in df.select(E.genre_overlap("g", "w")).collect()] == [True, False, False]


def test_load_tables_reads_what_write_dat_wrote(spark):
    """All three tables, with Latin-1 titles, nulls and rows without a key (which are dropped)."""
    d = tempfile.mkdtemp(prefix="cinerank-dat-")
    tables = {"ratings": [(1, 2, 5.0, 978300760), (1, 3, 3.5, 0), (None, 3, 1.0, 1)],
              "users": [(1, "F", 1, 10, "48067"), (2, "M", None, None, None), (None, "M", 1, 1, "x")],
              "movies": [(1, "Café: l'été (1995)", "Drama|War"), (2, 'The "Quoted"', None), (None, "No id", "Drama")]}
    for name, rows in tables.items():
        dat.write_dat(spark.createDataFrame(rows, dat.SCHEMAS[name]), os.path.join(d, dat.FILE_NAMES[name]))
    got = dat.load_tables(spark, d)
    for name, df in zip(("ratings", "users", "movies"), got):
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(tables[name][:2], key=repr)


@pytest.mark.parametrize("title", ["A::B", "日本", "a\nb", ":a", "a:"])
def test_write_dat_fails_on_what_it_cannot_hold(spark, title):
    df = spark.createDataFrame([(1, title, "Drama")], schema.MOVIES_SCHEMA)
    with pytest.raises(Exception, match="can't be written"):
        dat.write_dat(df, os.path.join(tempfile.mkdtemp(prefix="cinerank-dat-"), "m.dat"))


def test_mask_string_is_the_multihot_as_text(spark):
    masks = spark.createDataFrame([(m,) for m in (0, 1, 2, 1 << 17, (1 << 18) - 1, 0b101000000000000110)], "m int")
    rows = masks.select(E.mask_string("m").alias("a"), E.multihot_string(E.multihot_from_mask("m")).alias("b")).collect()
    assert all(r.a == r.b and len(r.a) == 18 for r in rows)
