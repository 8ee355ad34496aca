"""Star build on hand-made feeds shaped like the public-health inputs, with the edge cases
the pipeline must handle: NULL place kept, excluded place dropped, NULL code or position
dropped, float codes padded, a state-level code recoded, duplicates over days on both
join sides, two positions for one county, a state without hospitals, NULL measures, a
NULL zip, a hospital name with a comma and a quote, and a six-digit code."""

import datetime

import pytest

from covid_fixture import make_feeds
from starmart.plans import marts, star
from starmart.schemas import DIM_DATE, DIM_HOSPITAL, DIM_REGION, FACT_COVID


@pytest.fixture(scope="module")
def feeds(spark):
    return make_feeds(spark)


@pytest.fixture(scope="module")
def built(feeds):
    region = star.region_dimension(feeds["case"], feeds["county"])
    hosp = star.hospital_dimension(feeds["hospitals"])
    cal = star.calendar_dimension(feeds["daily"])
    fact = star.covid_fact(feeds["daily"], region, hosp)
    return {"region": region, "hosp": hosp, "cal": cal, "fact": fact}


def test_region_dimension(built):
    region = built["region"]
    assert region.columns == DIM_REGION.names
    rows = [tuple(r) for r in region.orderBy("region_sk").collect()]
    assert [(r[0], r[1], r[2], r[3], r[4], r[5], r[7]) for r in rows] == [
        (1, "01001", "01", "001", "Alabama", "Autauga", 32.5),
        (2, "01001", "01", "001", "Alabama", "Autauga", 32.6),
        (3, "01003", "01", "003", "Alabama", "Baldwin", 30.7),
        (4, "06037", "06", "037", None, "Los Angeles", 34.0),
        (5, "123456", "12", "456", "Nowhere", "Far", 1.0),
        (6, "00072", "72", "072", "Puerto Rico", "Puerto Rico", 18.2),
    ]


def test_hospital_dimension(built):
    hosp = built["hosp"]
    assert hosp.columns == DIM_HOSPITAL.names
    rows = {r.hosp_sk: r for r in hosp.collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[1].hospital_name == 'Prattville Baptist, "East"' and rows[1].hq_zip_code == "36067"
    assert rows[3].state_fips == "06" and rows[3].hq_zip_code is None


def test_calendar_covers_unfiltered_feed(built):
    cal = built["cal"]
    assert cal.columns == DIM_DATE.names
    dates = sorted(r.date for r in cal.collect())
    assert dates[0] == datetime.date(2020, 1, 12) and dates[-1] == datetime.date(2020, 1, 16)
    assert len(dates) == 5


def test_fact(built):
    fact = built["fact"]
    assert fact.columns == FACT_COVID.names
    rows = {(r.date, r.state_fips): r for r in fact.collect()}
    # PR has a region but no hospital; the NULL-code and NULL-state rows are dropped
    assert sorted(rows) == [(20200113, "01"), (20200113, "06"), (20200114, "01"), (20200115, "06")]
    al = rows[(20200113, "01")]
    assert (al.region_sk, al.hosp_sk, al.recovered, al.deathincrease) == (1, 1, 0.0, 0)
    ca = rows[(20200113, "06")]
    assert (ca.region_sk, ca.hosp_sk, ca.hospitalizedcurrently) == (4, 3, 0.0)


def test_marts_and_invariants(built):
    fact, region, cal = built["fact"], built["region"], built["cal"]
    totals = {r.state_abv: r for r in marts.state_totals(fact, region).collect()}
    assert sorted(totals) == ["AL", "CA"]
    assert (totals["AL"].state, totals["AL"].total_positive_cases, totals["AL"].total_deaths,
            totals["AL"].avg_hospitalized) == ("Alabama", 25.0, 3.0, 3.0)  # avg(2, 3) = 2.5 -> 3
    assert totals["CA"].state is None and totals["CA"].avg_hospitalized == 3.0  # avg(0, 5)
    us = marts.us_totals(fact).first()
    assert (us.postive_cases, us.deaths, us.begin_data, us.end_data) == (245.0, 19.0, 20200113, 20200115)
    assert sum(t.total_positive_cases for t in totals.values()) == us.postive_cases
    daily = marts.state_daily(fact, cal, region).collect()
    assert len(daily) == 4
    al = [r for r in daily if r.state_abv == "AL"][0]
    assert (al.lattitude, al.longitude, al.state) == (32.5, -86.6, "Alabama")
