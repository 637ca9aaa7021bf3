"""Column expressions against the edge cases their rules name."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from urllib.parse import quote_plus

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stormledger.functions import categories, codes, dates, keys, search, text, urls

FEW = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def test_strip_covers_every_white_space(evaluate):
    every = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
    assert evaluate(text.strip, every + "a b" + every, " x\x1c", "​z") == ["a b", "x", "​z"]
    assert evaluate(text.safe_trim, None, "  ") == ["", ""]


def test_blank_is_what_strips_to_nothing(evaluate):
    every = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
    rows = ["", every, every + "a", "a" + every, "\u200b", " x\x1c", "\u3000", None]
    assert evaluate(text.is_blank, *rows) == evaluate(lambda v: text.strip(v) == "", *rows)


def test_first_segment(evaluate):
    assert evaluate(text.first_segment, " A , B, C", "none", ",x", None) == ["A", "none", "", None]


@pytest.mark.parametrize(
    ("label", "name"),
    [
        ("Miami-Dade County, Florida", "Miami-Dade"),
        ("Juneau City and Borough, Alaska", "Juneau and"),
        ("District of Columbia, District of Columbia", "of Columbia"),
        ("Carson City, Nevada", "Carson"),
        ("Doña Ana County, New Mexico", "Doña Ana"),
        ("Capitol Planning Region, Connecticut", "Capitol Planning Region"),
        ("PiñCity, X", "PiñCity"),
        ("Nome  census area  West, Alaska", "Nome West"),
        ("COUNTY", ""),
    ],
)
def test_clean_name(evaluate, label, name):
    assert evaluate(text.clean_name, label) == [name]


NAME_PARTS = ["County", "city", "and", "Borough", "Census", "Area", "Census Area", "Bay", "é", "-", " "]


@FEW
@given(st.lists(st.lists(st.sampled_from(NAME_PARTS), max_size=7), min_size=1, max_size=40))
def test_one_pass_removal_equals_one_pass_per_word(evaluate, parts):
    # One removal after the other, in the published order of words.
    order = ["County", "Parish", "Borough", "Census Area", "Municipality", "City and Borough"]
    order += ["City", "Municipio", "District"]

    def one_by_one(label):
        for word in order:
            label = re.sub(rf"\b{word}\b", "", label, flags=re.IGNORECASE).strip()
        return re.sub(r"\s{2,}", " ", label)

    labels = [" ".join(p) for p in parts]
    assert evaluate(text.clean_name, *labels) == [one_by_one(label.strip()) for label in labels]


def test_zero_pad_keeps_long_codes(evaluate):
    assert evaluate(lambda c: codes.zero_pad(c, 3), "", "7", "123", "12345", None) == [
        "000", "007", "123", "12345", None,
    ]


def test_fips_key(evaluate):
    rows = [("1001", "", ""), ("US01001", "", ""), ("", "1", "1"), (None, "S1", "C1"), ("", "", ""),
            ("none", "1", "1"), ("", "", "5")]
    assert evaluate(codes.fips_key, *rows) == [
        "01001", "01001", "01001", "01001", None, None, "00005",
    ]
    assert evaluate(lambda s, c: codes.fips_key(state=s, county=c), ("6", "37")) == ["06037"]
    with pytest.raises(ValueError, match="geoid"):
        codes.fips_key(state=F.lit("1"))


def test_valid_code(evaluate):
    assert evaluate(
        lambda s, c: codes.valid_code(codes.compose_geoid(s, c)),
        ("1", "1"), ("", ""), ("1", "0A1"), ("-1", "001"),
    ) == [True, True, False, False]


def test_iso_prefix_is_not_validated(evaluate):
    assert evaluate(dates.iso_prefix, "2024-02-01T00:00", "nonsense date", "", None) == [
        "2024-02-01", "nonsense d", None, None,
    ]


DATES = {
    "2024-01-10T00:00:00.000Z": "2024-01-10",
    " 2024-01-10 \n": "2024-01-10",
    "2024-01-10T23:00:00-05:00": "2024-01-10",
    "2024-01-10T23:00:00+0530": "2024-01-10",
    "2024-01-10T23:00:00,5Z": "2024-01-10",
    "2024-01-10T00:00.00000000": "2024-01-10",
    "2024-01-10.0000000T": "2024-01-10",
    "2024-01-10 00:00:00": None,
    "2024-01-10T00:00": None,
    "2024-01-10T00:00:00ZZ": None,
    "2024-01-10T24:00:00Z": None,
    "2024-01-10T00:60:00Z": None,
    "2024-01-10T00:0000.000": None,
    "2024-02-30": None,
    "2023-02-29T00:00:00Z": None,
    "2024-1-1": None,
    "0000-01-01": None,
    "2024-01-10T": None,
    "": None,
    "   ": None,
}


def test_parse_date_lenient(evaluate):
    want = [v and dt.date.fromisoformat(v) for v in DATES.values()]
    assert evaluate(dates.parse_date_lenient, *DATES) == want
    assert evaluate(dates.parse_date_lenient, None) == [None]


def own_date(written: str) -> dt.date | None:
    """The rule in Python's own terms: whatever ``fromisoformat`` takes, kept to its date."""
    value = written.strip()
    instant = len(value) >= 19 and "T" in value
    value = value.partition(".")[0] if instant else f"{value}T00:00:00+00:00"
    try:
        return dt.datetime.fromisoformat(value).date()
    except ValueError:
        return None


PIECES = ["2024-01-10", "2024-02-30", "1999-12-31", "T", "t", " ", "00", ":", "23", "59", ":00",
          ":00:00", "Z", "+05:00", "-0830", ".", ".000", "000Z", "T10:20:30", "T10:20:30.5Z"]


@FEW
@given(st.lists(st.lists(st.sampled_from(PIECES), min_size=1, max_size=6), min_size=5, max_size=120))
def test_dates_parse_as_python_parses_them(evaluate, pieces):
    written = ["".join(p) for p in pieces]
    assert evaluate(dates.parse_date_lenient, *written) == [own_date(w) for w in written]


@pytest.mark.parametrize(
    ("begin", "end", "declared", "window"),
    [
        ("2024-01-10T00:00:00.000Z", "2024-01-12T00:00:00.000Z", "2024-02-01", ("2024-01-03", "2024-01-26")),
        (None, None, "2024-02-01", ("2024-01-25", "2024-02-15")),
        ("2024-01-10 00:00:00", None, "2024-02-01", ("2024-01-25", "2024-02-15")),
        ("2024-01-10T23:00:00-05:00", None, "2024-02-01", ("2024-01-03", "2024-02-15")),
        (None, "2023-01-01", "2024-02-01", ("2024-01-25", "2023-01-15")),
        (None, None, None, (None, None)),
        ("2024-01-10", None, None, ("2024-01-03", None)),
    ],
)
def test_event_window(evaluate, begin, end, declared, window):
    def both(b, e, d):
        start, stop = dates.event_window(*[dates.parse_date_lenient(c) for c in (b, e, d)])
        return F.array(dates.iso_text(start), dates.iso_text(stop))

    assert evaluate(both, (begin, end, declared)) == [list(window)]


def test_ymd8_and_compact(evaluate):
    assert evaluate(dates.ymd8_to_iso, "20240110123000", "20249999", " 20240110", "2024-01-10", "") == [
        "2024-01-10", "2024-99-99", "", "", "",
    ]
    assert evaluate(dates.compact_ts, "2024-01-10") == ["20240110000000"]


CATEGORIES = {
    "Severe Storm(s)": "storm",
    " Flash Flood ": "flood",
    "Tropical Storm": "storm",
    "Coastal Flooding": "flood",
    "Cyclone": "hurricane",
    "TYPHOON": "hurricane",
    "Biological": "storm",
    "   ": "storm",
    "Firestorm": "storm",
    "Fire": "wildfire",
    "Flood and fire": "flood",
    "": "",
    None: "",
}


def test_categories(evaluate):
    assert evaluate(categories.category_or_label, *CATEGORIES) == list(CATEGORIES.values())
    assert evaluate(categories.normalize_category, "", None, "x") == [None, None, "storm"]
    assert evaluate(lambda c: categories.normalize_category(c, default="other"), "Snow") == ["other"]
    assert evaluate(categories.is_default_category, "Biological", "Flood") == [True, False]


def test_event_label(evaluate):
    assert evaluate(
        categories.event_label, ("Travis", "Texas", "Flood"), ("Travis", "Texas", ""), ("A", "B", None)
    ) == ["Travis, Texas — Flood", "Travis, Texas — Disaster", "A, B — Disaster"]


def test_urls(evaluate):
    assert evaluate(urls.source_or_host, ("", "https://a.b:80/c"), (None, "see http://u@h/x"),
                    ("S", "http://h"), ("", "ftp://h")) == ["a.b:80", "u@h", "S", ""]
    assert evaluate(urls.url_base, "http://H/a?b?c#d", "http://h/#f", "") == ["http://H/a", "http://h/#f", ""]


@FEW
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=20), min_size=1, max_size=40))
def test_encode_query_equals_form_encoding(evaluate, queries):
    assert evaluate(urls.encode_query, *queries) == [quote_plus(q.strip()) for q in queries]


def test_theme_clause(evaluate):
    assert evaluate(search.theme_clause, "flood", "tornado", "Flood", "meteor") == [
        "(theme:NATURAL_DISASTER_FLOOD OR theme:FLOOD)", "(theme:TORNADO)", "Flood", "meteor",
    ]


@pytest.mark.parametrize(
    ("county", "state", "label"),
    [
        (" Travis ", "Texas", "Travis County"),
        ("Orleans Parish", "Louisiana", "Orleans Parish"),
        ("Juneau City and Borough", "Alaska", "Juneau City and Borough"),
        ("Carson City", "Nevada", "Carson City"),
        ("City", "X", "City"),
        ("Nome Census Area", "Alaska", "Nome Census Area"),
        ("of Columbia", " DC ", "of Columbia"),
        ("Travis county", "Texas", "Travis county"),
    ],
)
def test_location_clause(evaluate, county, state, label):
    assert evaluate(search.location_clause, (county, state)) == [f'location:"{label}, {state}, US"']


def test_synonym_query(evaluate):
    assert evaluate(
        search.synonym_query,
        ("Travis County, Texas", 'Travis "(County)"', "Drought"),
        ("A", "", "Snow"),
        ("", "", "tornado"),
    ) == [
        '("Travis County, Texas" OR "Travis (County)") AND ("drought")',
        '("A") AND ("snow")',
        '("") AND ("tornado" OR "twister")',
    ]


def test_keywords_and_hits(evaluate):
    query = '("Travis County, Texas" OR "Travis (County)") AND ("drought")'
    [words] = evaluate(search.keyword_set, query)
    assert sorted(words) == ["county", "county,", "drought", "texas", "travis"]
    # The letters of AND and OR go even inside words; short words go.
    assert evaluate(search.keyword_set, '("ORCHARD SANDY of") AND ("x")') == [["chard"]]
    hits = evaluate(
        lambda q, t: search.title_hits(search.keyword_set(q), t),
        (query, "Texas news"), (query, "TRAVIS COUNTY, drought"), (query, "nothing"),
    )
    assert hits == [1, 4, 0]


def test_hits_of_a_list_are_those_of_its_titles(spark):
    words, titles = ["flood", "texas", "x", "flood"], ["FLOOD in Texas", "", None, "xx", "calm"]
    rows = [(words, titles), ([], titles), (None, titles), (words, []), (words, None)]
    df = spark.createDataFrame(rows, "k array<string>, t array<string>")
    each = df.select(
        search.title_hits_of_each(F.col("k"), F.col("t")).alias("got"),
        *[search.title_hits(F.col("k"), F.get("t", F.lit(i))).alias(f"w{i}") for i in range(len(titles))],
    ).collect()
    assert [list(r.got) for r in each[:3]] == [list(r[1:]) for r in each[:3]]
    assert each[0].got == [4, 0, 0, 1, 0] and [r.got for r in each[3:]] == [[], None]


def test_title_is_lowered_once(spark):
    """Not once for each word."""
    hits = spark.range(1).select(search.title_hits(F.array(F.lit("a")), F.col("id").cast("string")))
    plan = hits._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "contains(" in plan and "contains(lower(" not in plan


def test_row_keys(evaluate):
    digest = hashlib.sha1(b"http://a/b").hexdigest()[:10]
    assert digest == "d213c5ed66"
    assert evaluate(keys.row_key, (" 4332 ", "48453", " http://a/b ")) == [f"4332_48453_{digest}"]
    with_fallback = evaluate(
        lambda n, f, u: keys.row_key_or_fallback(n, f, u, "csv", F.lit(3)),
        ("1", "2", ""), ("1", None, "u"), (" ", "2", "u"), ("1", "2", "http://a/b"),
    )
    assert with_fallback == ["missingpk_csv_3"] * 3 + [f"1_2_{digest}"]
    missing = evaluate(keys.missing_parts, ("1", "", "u"), ("1", None, " "), ("1", "2", "u"))
    assert missing == ["county_fips", "county_fips,url", None]


def test_field_fallback(evaluate):
    assert evaluate(text.field_fallback, ("a", "b"), ("", "b"), (None, "b"), (None, "")) == ["a", "b", "b", ""]
